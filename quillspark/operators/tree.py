"""Walking repository trees from directory listings (survey S6, O2).

A listing has one row for each entry of a directory: (repository, parent, name, type), the way a
repository answers for one directory at a time; ``parent`` is the directory's path, empty at the root.
The walk is one recursive query over the directories, each of which is judged once: every step joins
those reached by the last one with what they list, and goes on only into those that are worth it, so
nothing below an excluded directory is met.  The files, by far the most entries, are joined once, with
the directories that were entered.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.filters import (DEFAULT_EXCLUDE_EXTENSIONS, DEFAULT_EXCLUDE_PATHS, DEFAULT_INCLUDE_EXTENSIONS,
                                          DEFAULT_INCLUDE_FILENAMES, dir_traversable, entry_excluded, path_included)
from quillspark.session import written

#: Directory levels after which a walk is an error (a listing that contains itself).
MAX_LEVELS = 1000

_WALK = f"""
WITH RECURSIVE reached(repository, path, enter, depth) MAX RECURSION LEVEL {MAX_LEVELS} AS (
  SELECT repository, path, enter, 1 FROM {{dirs}} WHERE parent = ''
  UNION ALL
  SELECT d.repository, d.path, d.enter, r.depth + 1
  FROM reached r JOIN {{dirs}} d ON d.repository = r.repository AND d.parent = r.path
  WHERE r.enter
)
SELECT * FROM reached
"""


def listing_from_paths(files: DataFrame) -> DataFrame:
    """(repository, parent, name, type): the listings that hold the ``files`` (repository, path):
    each directory once, each file as often as it is given."""
    parts = F.split("path", "/")
    levels = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(
        F.array_join(F.slice(parts, 1, i - 1), "/").alias("parent"), F.get(parts, i - 1).alias("name"),
        F.when(i == F.size(parts), F.lit("blob")).otherwise(F.lit("tree")).alias("type")))
    entries = files.select("repository", F.explode(levels).alias("e")).select("repository", "e.*")
    return entries.where("type = 'blob'").unionByName(entries.where("type = 'tree'").distinct())


def walk_tree(listing: DataFrame, include_paths: Sequence[str] | None = None,
              exclude_extensions: Sequence[str] = DEFAULT_EXCLUDE_EXTENSIONS,
              exclude_paths: Sequence[str] = DEFAULT_EXCLUDE_PATHS,
              include_filenames: Sequence[str] = DEFAULT_INCLUDE_FILENAMES,
              include_extensions: Sequence[str] = DEFAULT_INCLUDE_EXTENSIONS) -> DataFrame:
    """Every entry that the walk meets: (repository, path, type, depth, outcome), where outcome is
    ``kept`` or ``passed`` for files and ``entered`` or ``pruned`` for directories.

    A directory is entered unless it is excluded or leads to no include path (F6); a file is kept if
    it is not excluded (F4) and included (F5).  What lies below a pruned directory is not met.
    Entries of other types are not followed; a repository without a root listing has none."""
    spark = listing.sparkSession
    path = F.when(F.col("parent") == "", F.col("name")).otherwise(F.concat("parent", F.lit("/"), "name"))
    entries = listing.withColumn("path", path)
    enter = dir_traversable("path", include_paths, exclude_extensions, exclude_paths)
    dirs = written(entries.where("type = 'tree'").select("repository", "parent", "path", enter.alias("enter")).distinct(), "walk-dirs")
    # The default of a million rows is meant for runaway recursion, which the level bound stops here.
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    reached = written(spark.sql(_WALK, dirs=dirs), "walk-reached")
    inside = reached.where("enter").select("repository", F.col("path").alias("parent"), "depth")
    files = entries.where("type = 'blob'")
    below = files.join(inside, ["repository", "parent"]).select("repository", "path", F.col("depth") + 1)
    met = files.where("parent = ''").select("repository", "path", F.lit(1).alias("depth")).union(below)
    kept = ~entry_excluded("path", exclude_extensions, exclude_paths) & path_included("path", include_paths, include_filenames, include_extensions)
    directories = reached.select("repository", "path", F.lit("tree").alias("type"), "depth", F.when(F.col("enter"), F.lit("entered")).otherwise(F.lit("pruned")).alias("outcome"))
    return directories.union(met.select("repository", "path", F.lit("blob"), "depth", F.when(kept, F.lit("kept")).otherwise(F.lit("passed"))))

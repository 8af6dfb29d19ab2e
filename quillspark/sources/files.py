"""File and repository sources (survey S5-S9).

Repository data is read from landed exports (tree listing, blobs, pull requests,
issues, commits) as DataFrames; the network client of the reference is not
rebuilt.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.filters import (DEFAULT_EXCLUDE_EXTENSIONS, DEFAULT_EXCLUDE_PATHS,
                                          DEFAULT_INCLUDE_EXTENSIONS, DEFAULT_INCLUDE_FILENAMES,
                                          drop_binary, select_repo_files)
from quillspark.operators.ordering import take_until_seen


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; an unreachable or forbidden store raises."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def scan_json_documents(spark: SparkSession, full_path: str, schema: T.StructType, delta_path: str | None = None,
                        mode: str = "INCREMENTAL", multiline: bool = True) -> DataFrame:
    """Read a JSON array of records (``multiLine``) or JSON lines with a declared
    schema; in INCREMENTAL mode a delta file is preferred when it exists."""
    path = full_path
    if mode.upper() == "INCREMENTAL" and delta_path and _exists(spark, delta_path):
        path = delta_path
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE").json(path)


def scan_repo_files(entries: DataFrame, blobs: DataFrame, include_paths: Sequence[str] | None = None,
                    exclude_extensions: Sequence[str] = DEFAULT_EXCLUDE_EXTENSIONS,
                    exclude_paths: Sequence[str] = DEFAULT_EXCLUDE_PATHS,
                    include_filenames: Sequence[str] = DEFAULT_INCLUDE_FILENAMES,
                    include_extensions: Sequence[str] = DEFAULT_INCLUDE_EXTENSIONS) -> DataFrame:
    """Blobs passing F4-F6, binary blobs dropped (F7), emitted as
    ``{id = repository:path, path, oid, content, byte_size, repository, branch}``.

    ``entries``: (repository, branch, path, type, oid); ``blobs``: (repository, path,
    oid, text, isBinary, byteSize).  The inner join on the full key keeps only blobs
    of the listed version; a missing blob is skipped like the reference's empty reply."""
    kept = select_repo_files(entries, include_paths, exclude_extensions, exclude_paths,
                             include_filenames, include_extensions)
    joined = drop_binary(kept.join(blobs, ["repository", "path", "oid"], "inner"))
    return joined.select(
        F.concat(F.col("repository"), F.lit(":"), F.col("path")).alias("id"), "path", "oid",
        F.coalesce(F.col("text"), F.lit("")).alias("content"),
        F.coalesce(F.col("byteSize"), F.lit(0)).cast("bigint").alias("byte_size"),
        "repository", "branch")


def scan_pull_requests(prs: DataFrame, last_sync: DataFrame | None = None) -> DataFrame:
    """Landed pull requests -> records: body NULL -> empty, all comments and
    reviews, ``id = repository:pr:N``; with checkpoints only rows updated after them."""
    out = prs.select(
        F.lit("pull_request").alias("type"),
        F.concat(F.col("repository"), F.lit(":pr:"), F.col("number").cast("string")).alias("id"),
        "number", "title", F.coalesce(F.col("body"), F.lit("")).alias("body"), "state",
        "created_at", "updated_at", "author",
        F.coalesce(F.col("comments"), F.array()).alias("comments"),
        F.coalesce(F.col("reviews"), F.array()).alias("reviews"),
        "repository")
    return _after_checkpoint(out, last_sync)


def scan_issues(issues: DataFrame, last_sync: DataFrame | None = None) -> DataFrame:
    """As S7 without reviews, ``id = repository:issue:N``."""
    out = issues.select(
        F.lit("issue").alias("type"),
        F.concat(F.col("repository"), F.lit(":issue:"), F.col("number").cast("string")).alias("id"),
        "number", "title", F.coalesce(F.col("body"), F.lit("")).alias("body"), "state",
        "created_at", "updated_at", "author",
        F.coalesce(F.col("comments"), F.array()).alias("comments"),
        "repository")
    return _after_checkpoint(out, last_sync)


def _after_checkpoint(df: DataFrame, last_sync: DataFrame | None) -> DataFrame:
    if last_sync is None:
        return df
    cp = last_sync.select(F.col("repository").alias("_cp_repo"), F.col("last_sync").alias("_cp"))
    return (df.join(cp, df["repository"] == cp["_cp_repo"], "left")
              .filter(F.col("_cp").isNull() | (F.col("updated_at") > F.col("_cp")))
              .drop("_cp_repo", "_cp"))


def scan_commits(history: DataFrame, seen: DataFrame | None = None,
                 order: Sequence[str] = ("committed_date", "sha"), carry: Sequence[str] = ()) -> DataFrame:
    """History newest first until a known sha (W3); ``id = repository:commit:SHA``.  ``carry``
    names further columns of the history to hand on."""
    h = history if seen is None else take_until_seen(history, seen, "repository", list(order))
    return h.select(F.lit("commit").alias("type"),
                    F.concat(F.col("repository"), F.lit(":commit:"), F.col("sha")).alias("id"),
                    "sha", "message", "committed_date", "author", "repository", *carry)


CORRUPT_COL = "_corrupt_record"


def scan_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a declared schema.  Each line is parsed with ``from_json``;
    a line that is not a JSON object keeps its text in ``_corrupt_record`` instead of
    failing the read."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    is_object = F.trim("value").startswith("{")
    parsed = F.from_json(F.when(is_object, F.col("value")), schema)
    return lines.select(parsed.alias("_rec"), F.when(~is_object | parsed.isNull(), F.col("value")).alias(CORRUPT_COL)) \
                .select("_rec.*", CORRUPT_COL)


def reject_wrong_type(records: DataFrame, policy: str, component: str) -> tuple[DataFrame, DataFrame]:
    """a payload that is not an object either fails the record (REST and file
    transformers: ``policy='fail'``) or is skipped (entity and discussion
    transformers: ``policy='skip'``).  Returns (objects, rejected-with-status)."""
    bad = F.col(CORRUPT_COL).isNotNull()
    ok = records.filter(~bad).drop(CORRUPT_COL)
    status = "failed" if policy == "fail" else "skipped"
    rejected = records.filter(bad).select(
        F.lit(component).alias("component"), F.lit(status).alias("status"),
        F.lit("TypeError" if policy == "fail" else None).cast("string").alias("error_type"),
        F.col(CORRUPT_COL).alias("payload"))
    return ok, rejected

"""Latest-wins dedupe, history slices, top-N, ordering and unions (survey W1-W4, O1, O2, U1, U2).

Skew note: a single id or repository may hold a large share of all rows.  The
operators here avoid funnelling a whole group into one task:

* ``latest_per_id`` is an aggregate (``max_by``) with a map-side partial step,
  so a hot id collapses to one row per input partition before the shuffle.
* ``take_until_seen`` reduces the "already seen" side to one row per key with a
  partial aggregate and then filters by comparison, instead of a running window
  over the whole history of a repository.
* ``newest_n_per_key`` is ``row_number() <= n``, which Spark plans with a partial
  ``WindowGroupLimit`` before the shuffle, so each map task ships at most ``n``
  rows per key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def latest_per_id(df: DataFrame, key: str | Sequence[str], order: Sequence) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` tuple (last arrival wins).

    ``order`` must make the choice deterministic (e.g. updatedAt then a sequence)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*_cols(order))
    payload = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys)
              .agg(F.max_by(payload, ordering).alias("_latest"))
              .select(*keys, "_latest.*"))


def incremental_slice(df: DataFrame, updated_col: str, last_sync) -> DataFrame:
    """The newest-first scan cut at a checkpoint is simply a strict filter."""
    if last_sync is None:
        return df
    return df.filter(F.col(updated_col) > F.lit(last_sync))


def take_until_seen(history: DataFrame, seen: DataFrame, key: str, order: Sequence[str],
                    seen_flag: str | None = None) -> DataFrame:
    """Per key, newest first, emit the prefix before the first already-seen row.

    Equivalently: the rows strictly newer (by the ``order`` tuple) than the newest
    seen row of the same key.  ``seen`` carries ``key`` and the ``order`` columns."""
    mark = F.struct(*_cols(order))
    newest_seen = (seen.groupBy(key).agg(F.max(mark).alias("_seen_max"))
                   .withColumnRenamed(key, "_seen_key"))
    joined = history.join(newest_seen, history[key] == newest_seen["_seen_key"], "left")
    return joined.filter(F.col("_seen_max").isNull() | (mark > F.col("_seen_max"))) \
                 .drop("_seen_key", "_seen_max")


def newest_n_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column], n: int,
                     pos_col: str = "pos") -> DataFrame:
    """First ``n`` rows per key by ``order`` (pass descending columns for newest
    first), with a 1-based position column."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(pos_col, F.row_number().over(w)).filter(F.col(pos_col) <= n)


def number_rows(sorted_df: DataFrame, name: str = "position") -> DataFrame:
    """Rows of a globally sorted frame numbered from 0 in its order.

    No single-partition window: each partition numbers its own rows and adds the row count
    of all earlier partitions, from a table with one row per partition.  The checkpoint in
    the shared folder pins which rows a partition has."""
    numbered = (sorted_df.withColumn("_pid", F.spark_partition_id())
                .withColumn("_mono", F.monotonically_increasing_id()).checkpoint(eager=True))
    local = numbered.withColumn("_local", F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    out = local.join(offsets, "_pid", "left")
    position = F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local")
    return out.withColumn(name, position.cast("bigint")).drop("_pid", "_mono", "_local", "_off")


def order_by_updated_desc(df: DataFrame, updated_col: str, *tiebreak: str) -> DataFrame:
    """O1: source order ``UPDATED_AT DESC`` (range-partitioned global sort)."""
    return df.orderBy(F.col(updated_col).desc(), *[F.col(t).desc() for t in tiebreak])


def path_depth(path) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.size(F.split(p, "/"))


def breadth_first_listing(df: DataFrame, repo_col: str = "repository", path_col: str = "path") -> DataFrame:
    """O2: files level by level (depth, then path) within each repository."""
    return df.orderBy(F.col(repo_col), path_depth(path_col), F.col(path_col))


def union_discussions(prs: DataFrame, issues: DataFrame, commits: DataFrame) -> DataFrame:
    """Pull requests, then issues, then commits as one frame (``kind_order`` keeps
    the reference's stream order available for sorting)."""
    return (prs.withColumn("kind_order", F.lit(1))
            .unionByName(issues.withColumn("kind_order", F.lit(2)), allowMissingColumns=True)
            .unionByName(commits.withColumn("kind_order", F.lit(3)), allowMissingColumns=True))


def skipped_tables(discovered: DataFrame, selected: DataFrame, col: str = "table_name") -> DataFrame:
    """Discovered minus selected, sorted."""
    return discovered.select(col).join(selected.select(col), col, "left_anti").distinct().orderBy(col)

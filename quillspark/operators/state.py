"""Sync state, checkpoints, quarantine and change application (survey I1-I7).

The state store is an ordinary table ``(key, value, expires_at)``; reads filter
on expiry, writes are keyed merges.  Nothing lives in driver memory.
"""

from __future__ import annotations

import enum
import os
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.ordering import latest_per_id

DEFAULT_TTL_SECONDS = 3600
CHECKPOINT_TTL_SECONDS = 86400 * 365
FILE_CACHE_TTL_SECONDS = 86400 * 30
READERS_TTL_SECONDS = 7200
CONTRIBUTORS_TTL_SECONDS = 86400


class SyncMode(str, enum.Enum):
    FULL = "FULL"
    INCREMENTAL = "INCREMENTAL"


def sync_mode(flag: str | None = None, env: Mapping[str, str] | None = None,
              pipeline_config: Mapping | None = None, env_var: str = "RECONCILIATION_MODE") -> SyncMode:
    """I4: flag / environment first, then the key inside the ``pipeline`` section, then
    INCREMENTAL.  FULL wins when both a flag and the environment name a mode."""
    env = os.environ if env is None else env
    candidates = [m.upper() for m in (flag, env.get(env_var)) if m]
    if "FULL" in candidates:
        return SyncMode.FULL
    if candidates:
        return SyncMode(candidates[0])
    cfg = (pipeline_config or {}).get("reconciliation_mode")
    return SyncMode(cfg.upper()) if cfg else SyncMode.INCREMENTAL


def state_live(state: DataFrame, now: float) -> DataFrame:
    """Entries with ``now < expires_at`` (strict); expired entries are gone."""
    return state.filter(F.col("expires_at") > F.lit(float(now)))


def state_get(df: DataFrame, state: DataFrame, key: Column, now: float, value_col: str = "state_value") -> DataFrame:
    """Attach the live value for each row's key (NULL on miss or expiry)."""
    live = state_live(state, now).select(F.col("key").alias("_s_key"), F.col("value").alias(value_col))
    return df.withColumn("_lookup_key", key).join(live, F.col("_lookup_key") == F.col("_s_key"), "left") \
             .drop("_lookup_key", "_s_key")


def state_put(state: DataFrame | None, entries: DataFrame, now: float, ttl_seconds: float = DEFAULT_TTL_SECONDS,
              order: list | None = None) -> DataFrame:
    """Insert or replace ``(key, value)`` entries with ``expires_at = now + ttl``.
    Expired entries are dropped on the way (I3); the newest write per key wins, and
    within one batch ``order`` (write order) decides."""
    order = order or []
    new = entries.select(F.col("key").cast("string"), F.col("value").cast("string"),
                         F.lit(float(now) + float(ttl_seconds)).alias("expires_at"),
                         F.struct(*order).alias("_ord") if order else F.lit(None).alias("_ord"))
    latest_new = latest_per_id(new, "key", [F.col("_ord")]).drop("_ord")
    if state is None:
        return latest_new
    # Written keys are usually few next to the store; Spark broadcasts them when their
    # size is under its threshold, and shuffles otherwise.
    untouched = state_live(state, now).select("key", "value", "expires_at") \
        .join(latest_new.select("key"), "key", "left_anti")
    return untouched.unionByName(latest_new)


def state_clear(state: DataFrame) -> DataFrame:
    """Empty store with the same schema."""
    return state.limit(0)


def commit_checkpoints(state: DataFrame, next_checkpoints: DataFrame, kind: str, now: float,
                       key_col: str = "repository", ttl_seconds: float = CHECKPOINT_TTL_SECONDS) -> DataFrame:
    """Store A6 per repository as ``<kind>:<repository>``.  Call only after the sink
    write succeeded, so a failed run re-reads the same slice."""
    entries = next_checkpoints.select(F.concat(F.lit(kind + ":"), F.col(key_col)).alias("key"),
                                      F.col("last_sync").cast("string").alias("value"))
    return state_put(state, entries, now, ttl_seconds)


def quarantine(df: DataFrame, error: Column, component: str) -> tuple[DataFrame, DataFrame]:
    """Split into (good, errors).  ``error`` is a string column: NULL for a good
    row, else the failure message.  Errors come out in the A3 shape."""
    tagged = df.withColumn("_error", error)
    good = tagged.filter(F.col("_error").isNull()).drop("_error")
    ids = [F.col(c).cast("string") for c in ("id", "doc_id") if c in df.columns]
    bad = tagged.filter(F.col("_error").isNotNull()).select(
        F.lit(component).alias("component"), F.coalesce(*ids, F.lit("unknown")).alias("item_id"),
        F.lit("ValidationError").alias("error_type"), F.col("_error").alias("message"))
    return good, bad


def enforce_error_policy(errors: DataFrame, policy: str) -> bool:
    """``skip_and_log`` -> run succeeds; ``fail_on_any_error`` / ``fail_fast`` ->
    raise when any error exists (checked with a bounded ``take(1)``)."""
    if policy == "skip_and_log":
        return True
    if len(errors.take(1)) > 0:
        raise RuntimeError(f"error policy {policy!r}: records failed")
    return True


def apply_changes(index: DataFrame, changes: DataFrame, order: list[str], key: str = "id",
                  action_col: str = "action", propagate_deletes: bool = False) -> DataFrame:
    """Apply upsert and delete events to an index that holds the ``order`` columns.  The
    newest of an id's row and events decides, so a late event never replaces a newer document.
    A delete leaves a tombstone (``_deleted``, with its order columns), so a late upsert does
    not bring the document back; ``live`` drops them.  With ``propagate_deletes=False`` delete
    events are ignored (reference behaviour).  An event as new as the row wins over it."""
    if "_deleted" not in index.columns:
        index = index.withColumn("_deleted", F.lit(False))
    deletes = F.coalesce(F.col(action_col), F.lit("upsert")) == "delete"
    events = changes if propagate_deletes else changes.filter(~deletes)
    events = events.withColumn("_deleted", deletes).drop(action_col).select(*index.columns)
    both = index.withColumn("_event", F.lit(0)).unionByName(events.withColumn("_event", F.lit(1)))
    return latest_per_id(both, key, [*[F.col(c) for c in order], F.col("_event")]).select(*index.columns)


def live(index: DataFrame) -> DataFrame:
    """An index without its tombstones."""
    return index.filter(~F.coalesce(F.col("_deleted"), F.lit(False))).drop("_deleted")

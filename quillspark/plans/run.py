"""

source frame -> transform chain (P15) -> validation (I6) -> one write of the outcome -> index write
(K1/K2 with K5 staging) -> metrics, breakdown and error table (A1-A3) -> checkpoint commit (I5) only
after the index write succeeded.

The source runs through the chain once, into a Parquet table in the shared folder; the counters are
observed on the rows as that table is written, so nothing is joined back to the fetched records.  The
sink, the error table and the breakdown read the written table.  Only the breakdown of *fetched*
records looks at the source again, at its source column alone.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import aggregates as AG
from quillspark.operators import state as ST
from quillspark.operators.project import chain_transforms
from quillspark.session import scratch_dir
from quillspark.sinks import index as K
from quillspark.sources.tables import Fetched

ERROR_FIELDS = "component string, item_id string, error_type string, message string"


@dataclass
class RunResult:
    run_id: str
    mode: str
    summary: dict
    metrics: DataFrame
    breakdown: DataFrame
    errors: DataFrame
    report: DataFrame
    state: DataFrame | None
    skipped_tables: list[str] = field(default_factory=list)


def _breakdown(records: DataFrame, outcomes: DataFrame, source_col: str | None) -> DataFrame:
    """A2 from two narrow aggregates, joined by source: no record meets another."""
    key = AG.breakdown_key(None, source_col)
    fetched = records.groupBy(key.alias("source_key")).agg(F.count(F.lit(1)).alias("fetched"))
    good = F.count_if(F.col("_error").isNull())
    done = outcomes.groupBy(F.col("_source_key").alias("source_key")).agg(good.alias("transformed"), F.count_if(F.col("_error").isNotNull()).alias("failed"))
    both = fetched.join(done, "source_key", "left")
    transformed, failed = (F.coalesce(c, F.lit(0)).cast("bigint") for c in ("transformed", "failed"))
    return both.select("source_key", F.col("fetched").cast("bigint").alias("fetched"), transformed.alias("transformed"),
                       failed.alias("failed"), transformed.alias("uploaded"))


def sync_run(spark: SparkSession, source: DataFrame | Callable[[SparkSession], DataFrame | Fetched],
             steps: Sequence[Callable[[DataFrame], DataFrame]], index_root: str, mode: str | None = None,
             validate: Column | None = None, order: Sequence[str] = ("_rec",), source_col: str | None = None,
             error_policy: str = "skip_and_log", state: DataFrame | None = None, checkpoint_kind: str | None = None,
             checkpoint_key: str = "repository", updated_col: str = "updated_at", component: str = "transformer",
             name: str = "sync", sink: Callable[..., dict] = K.sync_index, env: Mapping[str, str] | None = None,
             pipeline_config: Mapping | None = None) -> RunResult:
    """Run one sync.  ``source`` is a frame of records or a hook that returns one (or ``Fetched``);
    ``sink`` is called as ``sync_index`` is and returns its summary.  ``mode`` is the flag of I4: with
    none, the environment, then ``pipeline_config``, then INCREMENTAL decide.  ``validate`` is a string
    column (NULL = valid) evaluated on the transformed documents; rows dropped by the steps count as
    skipped.  Without another ``order`` the last record of an id, as fetched, wins.  Steps must keep
    underscore-prefixed columns (the projections in ``operators.project`` do)."""
    run_id = f"run-{uuid.uuid4().hex[:12]}"
    mode = ST.sync_mode(mode, env, pipeline_config).value
    started = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    found = source if isinstance(source, (DataFrame, Fetched)) else source(spark)
    found = found if isinstance(found, Fetched) else Fetched(found)

    read, wrote = Observation(), Observation()
    tagged = found.records.withColumn("_rec", F.monotonically_increasing_id()).withColumn("_source_key", AG.breakdown_key(None, source_col))
    docs = chain_transforms(tagged.observe(read, F.count(F.lit(1)).alias("fetched")), *steps)
    if not {"_rec", "_source_key"} <= set(docs.columns):
        raise ValueError("transform steps must carry underscore-prefixed bookkeeping columns (_rec, _source_key)")
    docs = docs.withColumn("_error", validate if validate is not None else F.lit(None).cast("string"))
    docs = docs.observe(wrote, F.count_if(F.col("_error").isNull()).alias("transformed"), F.count_if(F.col("_error").isNotNull()).alias("failed"))
    docs = K.written(docs, scratch_dir(spark, "run-outcome"))

    good = docs.filter(F.col("_error").isNull()).drop("_error", "_source_key")
    bad = docs.filter(F.col("_error").isNotNull())
    errors = bad.select(F.lit(component).alias("component"), F.coalesce(F.col("id").cast("string"), F.lit("unknown")).alias("item_id"),
                        F.lit("ValidationError").alias("error_type"), F.col("_error").alias("message"))
    errors = errors.unionByName(spark.createDataFrame(list(found.errors), ERROR_FIELDS))
    ST.enforce_error_policy(errors, "skip_and_log" if error_policy == "fail_on_any_error" else error_policy)

    sink_cols = [c for c in good.columns if not c.startswith("_") or c in order]
    if "_rec" in order and mode == "FULL":
        sink_cols.remove("_rec")
    summary = sink(spark, index_root, good.select(*sink_cols), mode=mode,
                   staging_root=f"{index_root.rstrip('/')}-staging", order=list(order))

    fetched, transformed, failed = read.get["fetched"], wrote.get["transformed"], wrote.get["failed"]
    # What the sink wrote, not what was handed to it, counts as uploaded; failures without a record
    # count as failed but were not fetched.
    counts = (fetched, transformed, failed + len(found.errors), fetched - transformed - failed, summary["records_synced_this_run"])
    metrics = spark.createDataFrame([counts], "fetched bigint, transformed bigint, failed bigint, skipped bigint, uploaded bigint")
    breakdown = _breakdown(found.records, docs, source_col)
    report = AG.run_report(metrics, breakdown, errors, run_id, name, started,
                           time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()))

    new_state = state
    if checkpoint_kind is not None:
        # Only now, after the sink write succeeded, do checkpoints advance.
        nxt = AG.next_checkpoint(good, checkpoint_key, updated_col)
        new_state = ST.commit_checkpoints(state, nxt, checkpoint_kind, time.time(), key_col=checkpoint_key)
    if error_policy == "fail_on_any_error":
        ST.enforce_error_policy(errors, "fail_on_any_error")
    return RunResult(run_id, mode, summary, metrics, breakdown, errors, report, new_state, sorted(found.skipped_tables))

"""One sync run end to end (§3.4): transform chain, validation split, index write,
metrics, breakdown and checkpoint commit."""

import pytest
from pyspark.sql import functions as F

from quillspark.operators import filters as FL
from quillspark.operators import project as P
from quillspark.plans.run import sync_run
from quillspark.session import scratch_dir
from quillspark.sinks import index as K

SCHEMA = ("id string, title string, content string, source string, repository string, updated_at string, "
          "permissions array<struct<email:string,type:string>>")
ROWS = [("a", "A", "alpha", "s1", "r1", "2024-01-02", [("u@x", "user")]),
        ("b", "B", "", "s1", "r1", "2024-01-05", [("u@x", "user")]),
        (None, "C", "gamma", "s2", "r2", "2024-01-03", [("u@x", "user")]),
        ("d", "D", "delta", "s2", "r2", "2024-01-04", [])]


def steps():
    keep = lambda df: df.select("id", "title", "content", "permissions", "source", "repository", "updated_at",
                                "_rec", "_source_key")
    project = lambda df: P.project_rest_document(df.withColumnRenamed("source", "_source")
                                                 .withColumnRenamed("repository", "_repository")
                                                 .withColumnRenamed("updated_at", "_updated_at"))
    return [keep, lambda df: FL.require_fields(df, "id"), project]


def test_sync_run_counts_and_checkpoints(spark):
    root = scratch_dir(spark, "run-index")
    recs = spark.createDataFrame(ROWS, SCHEMA)
    validate = F.when(F.octet_length(F.col("content")["raw_bytes"]) == 0, F.lit("empty content"))
    res = sync_run(spark, recs, steps(), root, mode="FULL", validate=validate, source_col="source",
                   checkpoint_kind="docs", checkpoint_key="_repository", updated_col="_updated_at")
    m = res.metrics.first().asDict()
    assert m == {"fetched": 4, "transformed": 2, "failed": 1, "skipped": 1, "uploaded": 2}
    assert res.summary["total_records_indexed"] == 2
    assert {r.id for r in K.read_index(spark, root).collect()} == {"a", "d"}
    assert [r.item_id for r in res.errors.collect()] == ["b"]
    br = {r.source_key: (r.fetched, r.transformed, r.failed) for r in res.breakdown.collect()}
    assert br == {"s1": (2, 1, 1), "s2": (2, 1, 0)}
    assert {r.key: r.value for r in res.state.collect()} == {"docs:r1": "2024-01-02", "docs:r2": "2024-01-04"}
    rep = res.report.first()
    assert rep.success is False and rep.error_count == 1 and rep.n_sources == 2


def test_sync_run_fail_on_any_error(spark):
    root = scratch_dir(spark, "run-index-fail")
    recs = spark.createDataFrame(ROWS, SCHEMA)
    validate = F.when(F.octet_length(F.col("content")["raw_bytes"]) == 0, F.lit("empty content"))
    with pytest.raises(RuntimeError):
        sync_run(spark, recs, steps(), root, mode="FULL", validate=validate, error_policy="fail_on_any_error")


def test_mode_precedence_source_and_sink_hooks(spark):
    """I4 decides the mode; a source hook reports skipped tables and failures; a sink hook is called."""
    from quillspark.plans.run import Fetched
    root, calls = scratch_dir(spark, "run-hooks"), []

    def source(session):
        return Fetched(session.createDataFrame(ROWS, SCHEMA), ["z_table", "a_table"], [("scan_tables", "lost", "AnalysisException", "no such table")])

    def sink(session, root, docs, mode, staging_root, order):
        calls.append((mode, staging_root, order))
        return K.sync_index(session, root, docs, mode=mode, staging_root=staging_root, order=order)

    def run(**how):
        return sync_run(spark, source, steps(), root, sink=sink, source_col="source", **how)

    first = run(env={"RECONCILIATION_MODE": "full"}, mode="incremental")
    assert first.mode == "FULL" and calls[0][0] == "FULL" and first.skipped_tables == ["a_table", "z_table"]
    assert first.metrics.first().asDict() == {"fetched": 4, "transformed": 3, "failed": 1, "skipped": 1, "uploaded": 3}
    assert [(r.component, r.item_id) for r in first.errors.collect()] == [("scan_tables", "lost")]
    assert run(env={}, pipeline_config={"reconciliation_mode": "full"}).mode == "FULL"
    last = run(env={})
    assert last.mode == "INCREMENTAL" and last.summary["total_records_indexed"] == 3
    assert {r.source_key: (r.fetched, r.transformed, r.failed) for r in last.breakdown.collect()} == {"s1": (2, 2, 0), "s2": (2, 1, 0)}


def test_the_source_is_written_once_and_not_joined(spark, tmp_path):
    """One pass: the source is evaluated for the outcome and, its source column alone, for the breakdown."""
    seen = spark.sparkContext.accumulator(0)
    recs = spark.createDataFrame(ROWS, SCHEMA)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    def source(_):
        return recs.mapInArrow(count, recs.schema)

    res = sync_run(spark, source, steps(), scratch_dir(spark, "run-once"), env={})
    assert seen.value == len(ROWS) and res.metrics.first().fetched == len(ROWS)

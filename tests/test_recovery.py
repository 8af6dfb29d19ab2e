"""A failed write never changes the published index, and the same delta again gives the same index;
scratch output follows the session's checkpoint folder."""

import pytest
from pyspark.sql import functions as F

from quillspark.session import ensure_checkpoint_dir, scratch_dir
from quillspark.sinks import index as K


def content(spark, root):
    return {r.id: r.v for r in K.read_index(spark, root).collect()}


def test_failed_publish_keeps_previous_version(spark):
    root = scratch_dir(spark, "recovery-index")
    v1 = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    K.publish(spark, v1, root)
    bad = spark.createDataFrame([("a", 10), ("boom", 0)], "id string, v int") \
        .withColumn("v", F.when(F.col("id") == "boom", F.raise_error(F.lit("simulated failure"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        K.sync_index(spark, root, bad, order=["v"])
    assert content(spark, root) == {"a": 1, "b": 2}
    # re-running with good input succeeds on top of the unchanged version
    K.sync_index(spark, root, spark.createDataFrame([("a", 10)], "id string, v int"), order=["v"])
    assert content(spark, root) == {"a": 10, "b": 2}


def test_a_repeated_delta_changes_nothing(spark):
    root = scratch_dir(spark, "recovery-repeat")
    K.publish(spark, spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("v")), root, bucket_bytes=300)
    delta = spark.createDataFrame([(str(v), v) for v in (1, 2, 3)], "id string, v int")
    for _ in range(2):
        K.sync_index(spark, root, delta, order=["v"])
        got = content(spark, root)
        assert len(got) == 200 and (got["1"], got["2"], got["3"], got["4"]) == (1, 2, 3, 0)


def test_a_failing_full_run_keeps_the_index(spark):
    root = scratch_dir(spark, "recovery-full")
    K.publish(spark, spark.createDataFrame([("a", 1)], "id string, v int"), root)
    bad = spark.createDataFrame([("b", 1)], "id string, v int").withColumn("v", F.raise_error(F.lit("simulated failure")).cast("int"))
    with pytest.raises(Exception):
        K.sync_index(spark, root, bad, mode="FULL", staging_root=root + "-stage")
    assert content(spark, root) == {"a": 1}


def test_no_index_and_an_empty_one(spark):
    root = scratch_dir(spark, "recovery-new")
    assert K.read_index(spark, root) is None
    nothing = spark.createDataFrame([], "id string, v int")
    assert K.sync_index(spark, root, nothing, order=["v"])["total_records_indexed"] == 0
    K.sync_index(spark, root, spark.createDataFrame([("a", 1)], "id string, v int"), order=["v"])
    assert K.sync_index(spark, root, nothing, order=["v"])["total_records_indexed"] == 1


def test_scratch_under_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    assert scratch_dir(spark, "x").startswith(root.rstrip("/") + "/quillspark/x-")

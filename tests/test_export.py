"""The export as a batch source, a stream with offsets over restarts, and a sink with a summary."""

import pytest
from pyspark.sql import functions as F

from quillspark.session import scratch_dir
from quillspark.sources.export import LandedExport, landed_files, read_summary

SCHEMA = "id long, text string, tags array<string>"


@pytest.fixture(scope="module")
def session(spark):
    spark.dataSource.register(LandedExport)
    return spark


def land(spark, path, landing, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    df.write.format("landed_export").option("landing", landing).mode("append").save(path)


def test_write_read_and_summary(session):
    path = scratch_dir(session, "export")
    land(session, path, "landing=0001", [(1, "a", ["x"]), (2, None, None), (3, "é", [])])
    land(session, path, "landing=0002", [(3, "again", [])])
    back = session.read.format("landed_export").load(path)
    assert back.schema.simpleString() == "struct<id:bigint,text:string,tags:array<string>>"
    assert sorted((r.id, r.text or "") for r in back.collect()) == [(1, "a"), (2, ""), (3, "again"), (3, "é")]
    assert back.rdd.getNumPartitions() == len(landed_files(path)) <= 4
    first = read_summary(path, "landing=0001")
    assert first["records_synced_this_run"] == 3 and first["status"] == "success" and read_summary(path, "landing=0002")["records_synced_this_run"] == 1


def test_a_stream_goes_on_after_its_offset(session):
    path, out, ckpt = (scratch_dir(session, n) for n in ("export-s", "export-out", "export-ckpt"))
    got = []
    for i in range(3):
        land(session, path, f"landing={i:04d}", [(10 * i + k, "t", []) for k in range(5)])
        stream = session.readStream.format("landed_export").schema(SCHEMA).load(path)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
        got.append(sorted(r.id for r in session.read.parquet(out).collect()))
    assert got[-1] == [10 * i + k for i in range(3) for k in range(5)] and [len(g) for g in got] == [5, 10, 15]


def test_failures_and_empty_exports(session):
    path = scratch_dir(session, "export-f")
    bad = session.createDataFrame([(1, "a", []), (2, "boom", [])], SCHEMA).repartition(2).withColumn(
        "text", F.when(F.col("text") == "boom", F.raise_error(F.lit("simulated"))).otherwise(F.col("text")))
    with pytest.raises(Exception):
        bad.write.format("landed_export").option("landing", "landing=0001").mode("append").save(path)
    assert landed_files(path) == []
    with pytest.raises(Exception):
        session.read.format("landed_export").load(path)
    assert session.read.format("landed_export").schema(SCHEMA).load(path).collect() == []
    land(session, path, "landing=0001", [])
    assert read_summary(path, "landing=0001")["records_synced_this_run"] == 0
    with pytest.raises(Exception):
        session.range(1).write.format("landed_export").mode("overwrite").save(path)

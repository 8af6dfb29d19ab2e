"""I7 streaming form: change files applied to the index through foreachBatch."""

from pyspark.sql import types as T

from quillspark.session import scratch_dir
from quillspark.operators import state as ST
from quillspark.sinks import index as K
from quillspark.streaming.changes import start_change_stream

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
                       T.StructField("action", T.StringType()), T.StructField("updatedAt", T.LongType())])


def test_change_stream_upserts_and_deletes(spark):
    changes, index, ckpt = (scratch_dir(spark, n) for n in ("changes", "stream-index", "stream-ckpt"))
    spark.createDataFrame([("a", "A1", None, 1), ("b", "B1", None, 1), ("c", "C1", None, 1)], SCHEMA) \
        .write.json(changes)
    q = start_change_stream(spark, changes, SCHEMA, index, ckpt)
    q.awaitTermination()
    assert {r.id: r.title for r in ST.live(K.read_index(spark, index)).collect()} == {"a": "A1", "b": "B1", "c": "C1"}
    spark.createDataFrame([("a", "A2", "update", 2), ("b", None, "delete", 2), ("d", "D1", None, 2),
                           ("a", "A0", "update", 0)], SCHEMA).write.mode("append").json(changes)
    q = start_change_stream(spark, changes, SCHEMA, index, ckpt)
    q.awaitTermination()
    assert {r.id: r.title for r in ST.live(K.read_index(spark, index)).collect()} == {"a": "A2", "c": "C1", "d": "D1"}


def test_change_stream_reference_mode_keeps_deleted(spark):
    changes, index, ckpt = (scratch_dir(spark, n) for n in ("changes2", "stream-index2", "stream-ckpt2"))
    spark.createDataFrame([("a", "A1", None, 1), ("a", None, "delete", 2)], SCHEMA).write.json(changes)
    start_change_stream(spark, changes, SCHEMA, index, ckpt, propagate_deletes=False).awaitTermination()
    assert {r.id: r.title for r in ST.live(K.read_index(spark, index)).collect()} == {"a": "A1"}


def test_late_events_across_batches(spark):
    changes, index, ckpt = (scratch_dir(spark, n) for n in ("changes3", "stream-index3", "stream-ckpt3"))
    batches = [[("a", "A10", None, 10), ("b", "B1", None, 1), ("c", "C1", None, 1)],
               [("a", "A5", "update", 5), ("b", None, "delete", 4)],
               [("b", "B3", "update", 3), ("c", "C2", "update", 2)]]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").json(changes)
        start_change_stream(spark, changes, SCHEMA, index, ckpt).awaitTermination()
    assert {r.id: r.title for r in ST.live(K.read_index(spark, index)).collect()} == {"a": "A10", "c": "C2"}
    start_change_stream(spark, changes, SCHEMA, index, ckpt).awaitTermination()
    assert {r.id: r.title for r in ST.live(K.read_index(spark, index)).collect()} == {"a": "A10", "c": "C2"}
    # the whole feed once more, as after a lost stream checkpoint
    start_change_stream(spark, changes, SCHEMA, index, scratch_dir(spark, "stream-ckpt4")).awaitTermination()
    assert {r.id: r.title for r in ST.live(K.read_index(spark, index)).collect()} == {"a": "A10", "c": "C2"}

"""REST projection and index sinks (P1, K1-K9) with a full + delta fixture."""

import base64

from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.operators import project as P
from quillspark.session import scratch_dir
from quillspark.sinks import index as K

SCHEMA = ("id string, title string, content string, content_base64 string, department_code string, mime string, "
          "version string, database_cluster_node string, permissions array<struct<email:string,type:string>>")
FULL = [
    ("doc-001", "Alpha", "alpha body", None, "ENG", None, None, None,
     [("a@x.com", "USER"), ("b@x.com", "user"), ("c@x.com", None)]),
    ("doc-002", None, "beta", None, None, "text/plain", None, None, [("g@x.com", "GROUP")]),
    ("doc-003", "Gamma", None, None, None, None, None, None, []),
]
DELTA = [
    ("doc-001", "Alpha v2", "alpha body 2", None, "ENG", None, None, None, [("a@x.com", "USER")]),
    ("doc-004", "D", "d", None, None, None, None, None, [("allUsers", "USER")]),
    ("doc-005", "E", "e", None, None, None, None, None, None),
    ("doc-006", "F", None, base64.b64encode(b"%PDF-1").decode(), None, "application/pdf", None, None, None),
]


def docs(spark, rows):
    return P.project_rest_document(spark.createDataFrame(rows, SCHEMA).withColumn("_seq", F.monotonically_increasing_id()))


def test_rest_projection_defaults_and_acl(spark):
    d = {r.id: r for r in docs(spark, FULL).select("id", "struct_data", "content",
                                                    A.acl_summary("acl_info").alias("acl")).collect()}
    assert d["doc-001"].acl == "user:a@x.com,user:b@x.com,user:c@x.com"
    assert d["doc-001"].struct_data.mimeType == "text/html" and d["doc-001"].struct_data.version == "1.0_rest"
    assert d["doc-002"].struct_data.title == "Untitled Document" and d["doc-002"].acl == "group:g@x.com"
    assert d["doc-003"].content is None and d["doc-003"].acl is None
    assert bytes(d["doc-001"].content.raw_bytes) == b"alpha body"


def test_full_then_incremental_merge(spark):
    root = scratch_dir(spark, "test-index")
    s1 = K.sync_index(spark, root, docs(spark, FULL), mode="FULL", staging_root=root + "-stage")
    assert s1["total_records_indexed"] == 3 and s1["records_synced_this_run"] == 3
    s2 = K.sync_index(spark, root, docs(spark, DELTA), mode="INCREMENTAL", order=["_seq"])
    assert s2["total_records_indexed"] == 6 and s2["records_synced_this_run"] == 4
    idx = {r.id: r for r in K.read_index(spark, root).collect()}
    assert idx["doc-001"].struct_data.title == "Alpha v2"
    assert bytes(idx["doc-006"].content.raw_bytes) == b"%PDF-1"
    assert idx["doc-006"].content.mime_type == "application/pdf"
    assert base64.b64encode(bytes(idx["doc-006"].content.raw_bytes)).decode().startswith("JVBERi0x")
    public = {r.id for r in K.read_index(spark, root).filter(A.acl_summary("acl_info") == "PUBLIC").collect()}
    assert public == {"doc-004"}


def test_full_requires_staging_and_keeps_duplicates(spark):
    import pytest
    with pytest.raises(ValueError):
        K.full_requires_staging("FULL", None)
    assert K.full_requires_staging("INCREMENTAL", None) is None
    dup = docs(spark, FULL + FULL[:1])
    assert K.index_replace(dup).count() == 4


def test_undecodable_content_fails_the_record(spark):
    rows = [("a", "A", None, "not base64!", "X", None, None, None, None), FULL[0]]
    d = {r.id: r._error for r in docs(spark, rows).collect()}
    assert d == {"a": P.REST_UNDECODABLE, "doc-001": None}


def test_upsert_needs_an_order_and_last_wins(spark):
    import pytest
    new = spark.createDataFrame([("a", v) for v in range(6)], "id string, v int")
    with pytest.raises(ValueError):
        K.index_upsert(None, new)
    assert [r.v for r in K.index_upsert(None, new, order=["v"]).collect()] == [5]


def test_summary_counts_what_was_written(spark):
    root = scratch_dir(spark, "test-summary")
    new = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("", 4), ("b", 5)], "id string, v int")
    s = K.sync_index(spark, root, new, order=["v"])
    assert (s["total_records_indexed"], s["records_synced_this_run"]) == (2, 2)
    assert K.upload_summary(spark, s).first().records_synced_this_run == 2


def files_of(spark, root):
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root).select("path").collect()
    out = {}
    for r in found:
        out.setdefault(r.path.split("_bucket=")[1].split("/")[0], set()).add(r.path)
    return out


def test_a_delta_rewrites_only_its_buckets_and_new_columns_are_kept(spark):
    root = scratch_dir(spark, "test-buckets")
    K.publish(spark, spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("v")), root, bucket_bytes=500)
    before = files_of(spark, root)
    assert len(before) > 4
    K.sync_index(spark, root, spark.createDataFrame([("7", 1)], "id string, v int"), order=["v"])
    after = files_of(spark, root)
    assert before.keys() == after.keys() and sum(before[b] != after[b] for b in before) == 1
    K.sync_index(spark, root, spark.createDataFrame([("9", 2, "x")], "id string, v int, extra string"), order=["v"])
    got = {r.id: (r.v, r.extra) for r in K.read_index(spark, root).collect()}
    assert len(got) == 500 and got["7"] == (1, None) and got["8"] == (0, None) and got["9"] == (2, "x")
    assert K.buckets_of(K.read_index(spark, root)) == len(before)


def test_buckets_and_tasks_follow_the_size(spark):
    """Ten times the documents make about ten times the buckets; copies of one id are spread."""
    made = []
    for n in (2_000, 20_000):
        root = scratch_dir(spark, "test-size")
        rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit(0).alias("v"))
        K.publish(spark, rows, root, bucket_bytes=20_000)
        made.append(K.buckets_of(K.read_index(spark, root)))
    assert 5 * made[0] < made[1] < 20 * made[0]
    root = scratch_dir(spark, "test-hot")
    K.publish(spark, spark.range(0, 1000, 1, 8).select(F.lit("same").alias("id"), F.col("id").alias("v")), root)
    assert 1 < len(files_of(spark, root)["0"]) <= K.WRITERS and K.read_index(spark, root).count() == 1000


def test_staging_inside_the_index_is_refused(spark):
    import pytest
    root = scratch_dir(spark, "test-inside")
    with pytest.raises(ValueError):
        K.sync_index(spark, root, docs(spark, FULL), mode="FULL", staging_root=root + "/stage")


def test_upsert_drops_missing_ids_and_keeps_others(spark):
    existing = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    new = spark.createDataFrame([("a", 2), (None, 9), ("", 9), ("c", 3), ("c", 4)], "id string, v int") \
        .withColumn("_seq", F.col("v"))
    got = {r.id: r.v for r in K.index_upsert(existing.withColumn("_seq", F.lit(0)), new, order=["_seq"]).collect()}
    assert got == {"a": 2, "b": 1, "c": 4}


def test_assign_batches_consecutive(spark):
    df = spark.range(0, 1005).select(F.format_string("id-%05d", "id").alias("id")).repartition(7)
    out = K.assign_batches(df, "id", 100).collect()
    by_batch = {}
    for r in out:
        by_batch.setdefault(r.batch_id, []).append(r.id)
    assert sorted(by_batch) == list(range(11)) and len(by_batch[10]) == 5
    assert all(len(v) == 100 for k, v in by_batch.items() if k < 10)
    assert max(by_batch[0]) < min(by_batch[1])


def test_index_delete(spark):
    idx = spark.createDataFrame([("a",), ("b",)], "id string")
    assert [r.id for r in K.index_delete(idx, spark.createDataFrame([("b",)], "id string")).collect()] == ["a"]


def test_ndjson_roundtrip(spark):
    path = scratch_dir(spark, "test-ndjson")
    K.write_ndjson(docs(spark, DELTA).select("id", "content"), path)
    back = spark.read.json(path)
    row = back.filter(F.col("id") == "doc-006").first()
    assert row.content.rawBytes == "JVBERi0x" and row.content.mimeType == "application/pdf"


def test_buckets_follow_the_values_and_tasks_get_equal_shares(spark, tmp_path):
    """Copies that Parquet packs into nothing still count; no task writes twice its share."""
    rows = spark.range(0, 4000, 1, 4).select(F.col("id").cast("string").alias("id"), F.struct(F.array(F.repeat(F.lit("same text "), 100)).alias("t")).alias("s"))
    staged, n, size = K.measured(rows, str(tmp_path / "rows"))
    assert n == 4000 and 4000 * 1000 < size < 4000 * 1010 and staged.count() == 4000
    root = scratch_dir(spark, "test-shares")
    K.publish(spark, rows, root, bucket_bytes=1 << 20)
    assert K.buckets_of(K.read_index(spark, root)) == 4
    per_file = [r["count"] for r in spark.read.parquet(root).groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 4 * K.WRITERS and max(per_file) < 2 * 4000 / len(per_file)

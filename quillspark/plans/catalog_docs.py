"""Registered queries over ``documents``: REST projection, index sinks, run telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.operators import aggregates as AG
from quillspark.operators import project as P
from quillspark.operators import state as ST
from quillspark.plans import bindings as B
from quillspark.plans.catalog import SQL_ENTITY, SQL_REST, SQL_REST_ALL, _t, query, rest_pipeline_outcomes, shared
from quillspark.plans.run import sync_run
from quillspark.session import scratch_dir
from quillspark.sinks import index as K
from quillspark.sources.export import LandedExport
from quillspark.sources.tables import Fetched
from quillspark.streaming.state import run_available

SQL_REST_ACL = """
CASE WHEN source = 'src0' THEN 'PUBLIC'
     ELSE 'user:' || source || '@docs.example.com,group:readers-' || lang || '@docs.example.com' END
"""


@shared
def rest_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that could be projected (the good side of I6)."""
    good, _bad = ST.quarantine(P.project_rest_document(B.rest_records(_t(spark, sf, "documents"))),
                               F.col("_error"), "rest_transformer")
    return good


@query("project_rest_document", f"""
SELECT id, title, lang AS department, 'text/html' AS mime_type, '1.0_rest' AS version, 'primary' AS node,
       octet_length(encode(text)) AS content_len, {SQL_REST_ACL} AS acl
FROM ({SQL_REST})
""")
def q_rest(spark, sf):
    d = rest_documents(spark, sf)
    sd = F.col("struct_data")
    return d.select("id", sd["title"].alias("title"), sd["department"].alias("department"),
                    sd["mimeType"].alias("mime_type"), sd["version"].alias("version"),
                    sd["sys_audit_node"].alias("node"),
                    F.octet_length(F.col("content")["raw_bytes"]).cast("bigint").alias("content_len"),
                    A.acl_summary("acl_info").alias("acl"))


@query("acl_from_permissions", f"""
SELECT id, {SQL_REST_ACL} AS acl,
       CASE WHEN source = 'src0' THEN 0 ELSE 2 END AS n_principals
FROM ({SQL_REST_ALL})
""")
def q_acl_perms(spark, sf):
    r = B.rest_records(_t(spark, sf, "documents"))
    acl = A.acl_from_permissions("permissions")
    return r.select("id", A.acl_summary(acl).alias("acl"), A.acl_principal_count(acl).alias("n_principals"))


@query("chain_transforms", f"""
SELECT id, title FROM ({SQL_REST})
""")
def q_chain(spark, sf):
    """Projections applied in order; a step returning no row drops the record."""
    steps = (
        B.rest_records,
        P.project_rest_document,
        lambda df: df.filter(F.col("_error").isNull()),
        lambda df: df.filter(F.col("acl_info").isNotNull()),
    )
    out = P.chain_transforms(_t(spark, sf, "documents"), *steps)
    return out.select("id", F.col("struct_data")["title"].alias("title"))


def _labelled_delta(spark: SparkSession, sf: str) -> DataFrame:
    """This run's changes: documents that received labels get a re-titled document."""
    docs = rest_documents(spark, sf)
    labels = _t(spark, sf, "labels")
    d = docs.join(labels, docs["_doc_id"] == labels["doc_id"], "inner")
    title = F.concat(F.lit("Q"), F.col("quality").cast("string"), F.lit("T"), F.col("toxic").cast("string"),
                     F.lit(": "), F.col("struct_data")["title"])
    return d.withColumn("struct_data", F.col("struct_data").withField("title", title)) \
            .select("id", "struct_data", "content", "acl_info", "_seq")


SQL_LABELLED = f"""
SELECT r.id, 'Q' || CAST(l.quality AS VARCHAR) || 'T' || CAST(l.toxic AS VARCHAR) || ': ' || r.title AS title
FROM ({SQL_REST}) r JOIN labels l ON r.doc_id = l.doc_id
"""


def _index_root(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, name)


@query("index_upsert", f"""
SELECT r.id, coalesce(d.title, r.title) AS title
FROM ({SQL_REST}) r LEFT JOIN ({SQL_LABELLED}) d ON r.id = d.id
""")
def q_index_upsert(spark, sf):
    """K1: full load of every document, then an incremental run with the labelled delta;
    the result is the published index read back."""
    root = _index_root(spark, "index-upsert")
    base = rest_documents(spark, sf).select("id", "struct_data", "content", "acl_info", "_seq")
    K.sync_index(spark, root, base, mode="FULL", staging_root=root + "-staging")
    K.sync_index(spark, root, _labelled_delta(spark, sf), mode="INCREMENTAL", order=["_seq"])
    idx = K.read_index(spark, root)
    return idx.select("id", F.col("struct_data")["title"].alias("title"))


@query("index_replace", SQL_LABELLED)
def q_index_replace(spark, sf):
    """K2 + K5: FULL run stages then replaces the index with exactly this run's documents."""
    root = _index_root(spark, "index-replace")
    base = rest_documents(spark, sf).select("id", "struct_data", "content", "acl_info", "_seq")
    K.sync_index(spark, root, base, mode="FULL", staging_root=root + "-staging")
    K.sync_index(spark, root, _labelled_delta(spark, sf), mode="FULL", staging_root=root + "-staging")
    return K.read_index(spark, root).select("id", F.col("struct_data")["title"].alias("title"))


@query("upload_summary", f"""
SELECT 'PARQUET' AS destination_format, (SELECT count(*) FROM ({SQL_REST})) AS total_records_indexed,
       (SELECT count(*) FROM ({SQL_LABELLED})) AS records_synced_this_run,
       'INCREMENTAL' AS reconciliation_mode, 'success' AS status
""")
def q_upload_summary(spark, sf):
    """K9: summary of an incremental run over an existing index."""
    root = _index_root(spark, "index-summary")
    base = rest_documents(spark, sf).select("id", "struct_data", "content", "acl_info", "_seq")
    K.sync_index(spark, root, base, mode="FULL", staging_root=root + "-staging")
    summary = K.sync_index(spark, root, _labelled_delta(spark, sf), mode="INCREMENTAL", order=["_seq"])
    return K.upload_summary(spark, summary)


@query("write_ndjson", f"""
SELECT id, title, 'text/html' AS mime_type, octet_length(encode(text)) AS content_len, {SQL_REST_ACL} AS acl FROM ({SQL_REST})
""")
def q_ndjson(spark, sf):
    """K3: NDJSON lines (camelCase names, bytes as base64), read back from the written files."""
    path = scratch_dir(spark, "ndjson")
    K.write_ndjson(rest_documents(spark, sf).select("id", "struct_data", "content", "acl_info"), path)
    back = spark.read.schema("id string, structData struct<title:string, mimeType:string>, "
                             "content struct<mimeType:string, rawBytes:string>, aclInfo struct<readers:array<struct<"
                             "idpWide:boolean, principals:array<struct<userId:string, groupId:string>>>>>").json(path)
    reader = F.element_at("aclInfo.readers", 1)
    principals = F.transform(reader["principals"], lambda p: F.coalesce(
        F.concat(F.lit("user:"), p["userId"]), F.concat(F.lit("group:"), p["groupId"])))
    return back.select("id", F.col("structData")["title"].alias("title"),
                       F.col("structData")["mimeType"].alias("mime_type"),
                       F.octet_length(F.unbase64(F.col("content")["rawBytes"])).cast("bigint").alias("content_len"),
                       F.when(reader["idpWide"], F.lit("PUBLIC")).otherwise(F.array_join(principals, ",")).alias("acl"))


@query("assign_batches", f"""
SELECT id, CAST((row_number() OVER (ORDER BY id) - 1) // 100 AS BIGINT) AS batch_id FROM ({SQL_REST})
""")
def q_batches(spark, sf):
    """K4: consecutive upload batches of 100 in id order."""
    return K.assign_batches(rest_documents(spark, sf).select("id"), "id", K.UPLOAD_BATCH_SIZE).select("id", "batch_id")


@query("index_delete", f"""
SELECT r.id FROM ({SQL_REST}) r WHERE r.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
""")
def q_index_delete(spark, sf):
    """K6: documents labelled toxic are removed from the index by id."""
    docs = rest_documents(spark, sf)
    toxic = _t(spark, sf, "labels").filter(F.col("toxic") == 1).select("doc_id")
    ids = docs.join(toxic, docs["_doc_id"] == toxic["doc_id"], "left_semi").select("id")
    return K.index_delete(docs.select("id"), ids)


@query("write_audit", f"""
SELECT id AS document_id, text AS content_text, 'FULL' AS reconciliation_mode, 'run-audit' AS run_id FROM ({SQL_REST})
""")
def q_audit(spark, sf):
    """K7: audit records with decoded content, written partitioned by run id, read back."""
    path = scratch_dir(spark, "audit")
    K.write_audit(rest_documents(spark, sf), path, "run-audit", "FULL")
    back = spark.read.schema("document_id string, content_text string, reconciliation_mode string, "
                             "run_id string").json(path)
    return back.select("document_id", "content_text", "reconciliation_mode", "run_id")


@query("split_by_entity", f"""
SELECT entityType AS entity_type, count(*) AS n FROM ({SQL_ENTITY})
WHERE entityType IN ('initiative', 'commitment', 'launch', 'person') GROUP BY entityType
""")
def q_split(spark, sf):
    """K8: one JSON-lines folder per listed entity type; unlisted types dropped."""
    path = scratch_dir(spark, "split")
    rows = B.entity_rows(_t(spark, sf, "orders"), _t(spark, sf, "customer")).select("entityType", "id", "title")
    K.split_by_entity(rows, path, ["initiative", "commitment", "launch", "person"])
    back = spark.read.json(path)
    return back.groupBy(F.col("entityType").alias("entity_type")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# ---------------------------------------------------------------- telemetry

@query("run_metrics", f"""
SELECT count(*) AS fetched, count(*) FILTER (WHERE NOT failed) AS transformed,
       count(*) FILTER (WHERE failed) AS failed, CAST(0 AS BIGINT) AS skipped,
       count(*) FILTER (WHERE NOT failed) AS uploaded
FROM ({SQL_REST_ALL})
""")
def q_metrics(spark, sf):
    return AG.run_metrics(rest_pipeline_outcomes(spark, sf))


@query("quarantine", f"""
SELECT id FROM ({SQL_REST})
""")
def q_quarantine(spark, sf):
    """Validation splits good rows from error rows; the good side continues."""
    return rest_documents(spark, sf).select("id")


@query("error_table", f"""
SELECT 'rest_transformer' AS component, id AS item_id, 'ValueError' AS error_type,
       'content is not valid base64' AS message
FROM ({SQL_REST_ALL}) WHERE failed
""")
def q_errors(spark, sf):
    """A3: one row per failed record, item id from ``id``."""
    failed = rest_pipeline_outcomes(spark, sf).filter(F.col("status") == "failed")
    return AG.error_table(failed, "rest_transformer")


@query("run_report", f"""
SELECT 'run-rest' AS run_id, 'rest documents' AS name, count(*) FILTER (WHERE failed) = 0 AS success,
       count(*) FILTER (WHERE failed) AS error_count, count(DISTINCT source) AS n_sources,
       count(*) AS fetched, count(*) FILTER (WHERE NOT failed) AS transformed
FROM ({SQL_REST_ALL})
""")
def q_report(spark, sf):
    """One-line run report."""
    out = rest_pipeline_outcomes(spark, sf)
    metrics = AG.run_metrics(out)
    breakdown = AG.source_breakdown(out, repo_col=None, source_col="_source")
    errors = out.filter(F.col("status") == "failed")
    rep = AG.run_report(metrics, breakdown, errors, "run-rest", "rest documents", "start", "end")
    parsed = AG.report_line(rep).select(F.from_json("line", "run_id string, name string, success boolean, error_count bigint, "
                                                           "n_sources bigint, metrics map<string,bigint>").alias("r")).select("r.*")
    return parsed.select("run_id", "name", "success", "error_count", "n_sources",
                         F.col("metrics")["fetched"].alias("fetched"), F.col("metrics")["transformed"].alias("transformed"))


@query("full_requires_staging", f"""
SELECT id, title, false AS left_behind FROM ({SQL_REST})
""")
def q_full_staging(spark, sf):
    """K5: a FULL run is written to a staging folder under the staging root and published from
    there; the folder goes afterwards (FULL without staging is an error)."""
    root = _index_root(spark, "index-staged")
    base = rest_documents(spark, sf).select("id", "struct_data", "content", "acl_info")
    K.sync_index(spark, root, base, mode="FULL", staging_root=root + "-staging")
    left = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root + "-staging").isEmpty()
    return K.read_index(spark, root).select("id", F.col("struct_data")["title"].alias("title"), F.lit(not left).alias("left_behind"))


# ---------------------------------------------------------------- own sources and sinks (§2.10)

@query("stream_export_documents", "SELECT doc_id, lang, length(text) AS n_chars FROM documents")
def q_stream_export(spark, sf):
    """W2 through an own data source: documents land in an export in three runs, each followed by a
    stream that starts anew and goes on after the offset it kept."""
    spark.dataSource.register(LandedExport)
    path, out, ckpt = (scratch_dir(spark, n) for n in ("export-in", "export-out", "export-ckpt"))
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "text")
    for i in range(3):
        part = docs.where(F.pmod("doc_id", F.lit(3)) == i)
        part.write.format("landed_export").option("landing", f"landing={i:04d}").mode("append").save(path)
        stream = spark.readStream.format("landed_export").schema(docs.schema).load(path)
        run_available(stream.select("doc_id", "lang", F.length("text").cast("bigint").alias("n_chars")), out, ckpt)
    return spark.read.schema("doc_id bigint, lang string, n_chars bigint").parquet(out)


@query("sync_run_hooks", f"""
SELECT 'indexed' AS kind, id AS name, title AS detail FROM ({SQL_REST})
UNION ALL SELECT 'failed', id, 'content is not valid base64' FROM ({SQL_REST_ALL}) WHERE failed
UNION ALL SELECT 'skipped', 'labels', NULL
UNION ALL SELECT 'uploaded', CAST(count(*) AS VARCHAR), 'FULL' FROM ({SQL_REST})
""")
def q_sync_run_hooks(spark, sf):
    """A run with its own source and sink (§2.10): the source reads an export and names the tables it
    passed over, the sink hands on to the index; the mode comes from the environment (I4)."""
    spark.dataSource.register(LandedExport)
    path, root = scratch_dir(spark, "hooks-export"), scratch_dir(spark, "hooks-index")
    records = B.rest_records(_t(spark, sf, "documents"))
    records.write.format("landed_export").option("landing", "landing=0001").mode("append").save(path)
    summary = {}

    def source(session):
        return Fetched(session.read.format("landed_export").schema(records.schema).load(path), ["labels"])

    def sink(session, where, docs, **how):
        summary.update(K.sync_index(session, where, docs, **how))
        return summary

    run = sync_run(spark, source, (P.project_rest_document,), root, validate=F.col("_error"), sink=sink,
                   component="rest_transformer", env={"RECONCILIATION_MODE": "FULL"})
    indexed = K.read_index(spark, root).select(F.lit("indexed").alias("kind"), F.col("id").alias("name"), F.col("struct_data")["title"].alias("detail"))
    failed = run.errors.select(F.lit("failed"), "item_id", "message")
    rest = [("skipped", t, None) for t in run.skipped_tables] + [("uploaded", str(summary["records_synced_this_run"]), run.mode)]
    return indexed.union(failed).union(spark.createDataFrame(rest, "kind string, name string, detail string"))

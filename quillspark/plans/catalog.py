"""Registered queries: one per operator of the survey inventory, bound to the driver tables.

Each entry pairs a Spark plan ``fn(spark, sf_dir) -> DataFrame`` with an ANSI SQL
text (DuckDB dialect) computing the same rows from the same tables; the SQL is
the independent oracle.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions import scalars as S
from quillspark.functions.sql import register_functions
from quillspark.operators import aggregates as AG
from quillspark.operators import filters as FL
from quillspark.operators import ordering as O
from quillspark.operators import project as P
from quillspark.plans import bindings as B
from quillspark.session import scratch_dir
from quillspark.sources import tables as ST_

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return B.load(spark, sf, name)


_SHARED: dict = {}


def shared(fn):
    """Memoise a DataFrame-building block per (session, data folder).  A DataFrame is
    an immutable logical plan, so queries that start from the same block reuse the
    already-analysed plan instead of rebuilding large expression trees."""
    def wrapper(spark: SparkSession, sf: str, *args):
        key = (fn.__module__, fn.__qualname__, id(spark._jsparkSession), spark._jsparkSession.toString(), sf, args)
        if key not in _SHARED:
            _SHARED[key] = fn(spark, sf, *args)
        return _SHARED[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


# ====================================================================== SQL fragments
# DuckDB forms of the bindings in ``bindings.py`` (kept textual: the oracle is independent).

# German texts of src7 arrive undecodable and fail.
SQL_REST_ALL = """
SELECT source || '/' || CAST(doc_id AS VARCHAR) AS id,
       split_part(text, chr(10), 1) AS title,
       text, lang, source, doc_id, n_chars, coalesce(lang = 'de' AND source = 'src7', false) AS failed
FROM documents
"""
SQL_REST = f"SELECT * FROM ({SQL_REST_ALL}) WHERE NOT failed"

SQL_CUSTOMER_EMAIL = "lower(replace(c_name, '#', '.')) || '@example.com'"

SQL_ENTITY = f"""
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'initiative' WHEN '2-HIGH' THEN 'commitment'
            WHEN '3-MEDIUM' THEN 'launch' WHEN '4-NOT SPECIFIED' THEN 'person' ELSE 'user' END AS entityType,
       CASE o_orderstatus WHEN 'P' THEN 'delete' WHEN 'O' THEN 'update' END AS action,
       CAST(o_custkey AS VARCHAR) AS id,
       'Order ' || CAST(o_orderkey AS VARCHAR) AS title,
       CASE WHEN o_orderstatus <> 'F' THEN 'Priority ' || o_orderpriority END AS description,
       CAST(epoch(o_orderdate) AS BIGINT) AS updatedAt,
       c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') AS private,
       CASE WHEN c_mktsegment = 'BUILDING' THEN [{SQL_CUSTOMER_EMAIL}] ELSE [] END AS allowedUsers,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN ['external_group:nation-' || CAST(c_nationkey AS VARCHAR)] END AS allowedGroups,
       CASE WHEN o_totalprice > 100000 THEN {SQL_CUSTOMER_EMAIL} END AS ownerEmail,
       o_orderkey AS seq, o_orderstatus, o_totalprice, o_orderdate, o_custkey, c_custkey, c_name, c_mktsegment,
       c_nationkey, {SQL_CUSTOMER_EMAIL} AS email
FROM orders JOIN customer ON o_custkey = c_custkey
"""

# Emitted entity documents (F2, F3, C12 / F8 applied), before latest-wins.
SQL_ENTITY_DOCS = f"""
WITH r AS ({SQL_ENTITY}),
k AS (
  SELECT *,
    CASE WHEN entityType = 'person' OR NOT private THEN 'PUBLIC'
         WHEN len(allowedUsers) + coalesce(len(allowedGroups), 0) > 0 THEN
           array_to_string(list_concat(list_transform(allowedUsers, lambda u: 'user:' || u),
                           list_transform(coalesce(allowedGroups, []), lambda g: 'group:' || g)), ',')
         WHEN coalesce(ownerEmail, '') <> '' THEN 'user:' || ownerEmail
    END AS acl
  FROM r
  WHERE coalesce(action, 'upsert') <> 'delete'
    AND entityType IN ('initiative', 'commitment', 'launch', 'person'))
SELECT entityType || '-' || id AS doc_id, * FROM k WHERE acl IS NOT NULL
"""

SQL_PAGES = r"""
SELECT page_id, url, html,
       regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
       regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '^([^.]+)\.', '\1/') AS repository,
       CASE WHEN regexp_extract(url, '^https?://[^/?#]+/([^?#]*)', 1) LIKE '%/'
              OR regexp_extract(url, '^https?://[^/?#]+/([^?#]*)', 1) = ''
            THEN regexp_extract(url, '^https?://[^/?#]+/([^?#]*)', 1) || 'index.html'
            ELSE regexp_extract(url, '^https?://[^/?#]+/([^?#]*)', 1) END AS path,
       sha256(html) AS oid, contains(url, '?') AS is_binary, octet_length(encode(html)) AS byte_size
FROM pages
"""

SQL_COMMITS = """
SELECT 'org/user-' || CAST(user_id AS VARCHAR) AS repository,
       sha256(CAST(event_id AS VARCHAR)) AS sha,
       event_type || ' ' || props AS message,
       CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS committed_date,
       'user' || CAST(user_id AS VARCHAR) AS author_name,
       CASE WHEN event_type <> 'view' THEN 'user' || CAST(user_id AS VARCHAR) END AS login,
       CASE WHEN event_type = 'error' THEN 'user' || CAST(user_id AS VARCHAR) || '.' || event_type
            ELSE 'user' || CAST(user_id AS VARCHAR) || '.' || event_type || '@example.com' END AS email,
       ts, event_id, event_type, user_id, props
FROM events
"""


# ====================================================================== flagship (A2)

@shared
def rest_pipeline_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """documents -> REST records -> P1 -> quarantine (I6) -> status per record."""
    records = B.rest_records(_t(spark, sf, "documents"))
    docs = P.project_rest_document(records)
    return docs.withColumn("status", F.when(F.col("_error").isNotNull(), F.lit("failed")).otherwise(F.lit("transformed"))) \
               .withColumn("error_type", F.lit("ValueError")).withColumn("message", F.col("_error"))


@query("source_breakdown", f"""
SELECT source AS source_key, count(*) AS fetched,
       count(*) FILTER (WHERE NOT failed) AS transformed,
       count(*) FILTER (WHERE failed) AS failed,
       count(*) FILTER (WHERE NOT failed) AS uploaded,
       count(DISTINCT doc_id) FILTER (WHERE NOT failed) AS unique_ids,
       sum(octet_length(encode(text))) FILTER (WHERE NOT failed) AS content_bytes
FROM ({SQL_REST_ALL}) GROUP BY source
""")
def q_source_breakdown(spark, sf):
    """Flagship: scan -> P1 projection (ACL, content) -> F1 -> I6 split -> W1 -> A2."""
    out = rest_pipeline_outcomes(spark, sf)
    # Content is decoded once and only its length goes on; copies of an id are combined before the shuffle.
    rows = out.select("id", F.col("_source").alias("source_key"), "status", "_seq", F.octet_length(F.col("content")["raw_bytes"]).alias("size"))
    good = (F.col("status") == "transformed") & FL.present("id")
    per_id = rows.groupBy("id", "source_key").agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if(F.col("status") == "transformed").alias("transformed"),
        F.count_if(F.col("status") == "failed").alias("failed"), F.max(F.when(good, F.col("_seq"))).alias("last"),
        F.max_by("size", F.when(good, F.col("_seq"))).alias("size"))
    newest = F.col("last") == F.max("last").over(Window.partitionBy("id"))
    counted = per_id.withColumn("newest", F.coalesce(newest, F.lit(False)))
    return counted.groupBy("source_key").agg(
        F.sum("fetched").alias("fetched"), F.sum("transformed").alias("transformed"), F.sum("failed").alias("failed"),
        F.sum("transformed").alias("uploaded"), F.count_if("newest").alias("unique_ids"),
        F.sum(F.when(F.col("newest"), F.col("size"))).cast("bigint").alias("content_bytes"))


# ====================================================================== scalar functions

@query("sanitize_doc_id", r"""
SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9_-]', '_', 'g') AS doc_id FROM pages
""")
def q_sanitize(spark, sf):
    return _t(spark, sf, "pages").select("page_id", S.sanitize_doc_id("url").alias("doc_id"))


SQL_TICKET_TEXT = """
'Ticket ORD-' || CAST(o_orderkey AS VARCHAR) || ' blocks P' || substr(o_orderpriority, 3, 3) || '-'
 || CAST(o_custkey AS VARCHAR) || ' (dup ORD-' || CAST(o_orderkey AS VARCHAR) || ', x-1, a' || o_orderstatus || '-9)'
"""


@query("extract_tickets", rf"""
SELECT o_orderkey,
       array_to_string(list_sort(list_distinct(regexp_extract_all({SQL_TICKET_TEXT},
                       '\b([A-Z][A-Z0-9]{{1,9}}-\d+)\b', 1))), ',') AS tickets
FROM orders
""")
def q_tickets(spark, sf):
    o = _t(spark, sf, "orders")
    text = F.concat(F.lit("Ticket ORD-"), F.col("o_orderkey").cast("string"), F.lit(" blocks P"),
                    F.substring("o_orderpriority", 3, 3), F.lit("-"), F.col("o_custkey").cast("string"),
                    F.lit(" (dup ORD-"), F.col("o_orderkey").cast("string"), F.lit(", x-1, a"),
                    F.col("o_orderstatus"), F.lit("-9)"))
    return o.select("o_orderkey", F.array_join(S.extract_tickets(text), ",").alias("tickets"))


SQL_API_URL = """
CASE WHEN starts_with(regexp_extract(url, '^https?://([^/?#]+)', 1), 'www.') THEN 'https://api.github.com'
     WHEN starts_with(regexp_extract(url, '^https?://([^/?#]+)', 1), 'blog.')
       THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/api/v3'
     ELSE regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/api/v3/' END
"""


@query("web_base_url", f"""
SELECT page_id,
       CASE WHEN contains({SQL_API_URL}, 'api.github.com') THEN 'https://github.com'
            ELSE regexp_replace({SQL_API_URL}, '/api/v3/?$', '') END AS web_base
FROM pages
""")
def q_web_base(spark, sf):
    p = _t(spark, sf, "pages")
    host = B.page_host(F.col("url"))
    origin = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    api = (F.when(host.startswith("www."), F.lit("https://api.github.com"))
           .when(host.startswith("blog."), F.concat(origin, F.lit("/api/v3")))
           .otherwise(F.concat(origin, F.lit("/api/v3/"))))
    return p.select("page_id", S.web_base_url(api).alias("web_base"))


@query("int_or_null", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_int,
       TRY_CAST('k' || json_extract_string(props, '$.k') AS BIGINT) AS bad_int,
       TRY_CAST(user_id AS BIGINT) AS user_int
FROM events
""")
def q_int_or_null(spark, sf):
    e = _t(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", S.int_or_null(k).alias("k_int"), S.int_or_null(F.concat(F.lit("k"), k)).alias("bad_int"),
                    S.int_or_null(F.col("user_id")).alias("user_int"))


@query("prefix_id", """
SELECT o_orderkey,
       CASE WHEN starts_with(raw, 'commitment-') THEN raw ELSE 'commitment-' || raw END AS prefixed
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'commitment-' || CAST(o_orderkey AS VARCHAR)
                              ELSE CAST(o_orderkey AS VARCHAR) END AS raw FROM orders)
""")
def q_prefix(spark, sf):
    o = _t(spark, sf, "orders")
    raw = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("commitment-"), F.col("o_orderkey").cast("string"))) \
        .otherwise(F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", S.prefix_id("commitment", raw).alias("prefixed"))


@query("iso_datetimes", """
SELECT event_id,
       CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts_iso,
       strftime(ts, '%Y-%m-%d') AS day_iso
FROM events
""")
def q_iso(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", S.iso_datetime("ts").alias("ts_iso"), S.iso_date(F.to_date("ts")).alias("day_iso"))


@query("json_text", """
SELECT event_id, '{"user":' || CAST(user_id AS VARCHAR) || ',"type":"' || event_type || '","k":'
                 || json_extract_string(props, '$.k') || '}' AS payload
FROM events
""")
def q_json_text(spark, sf):
    e = _t(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select("event_id", S.json_text(F.struct(F.col("user_id").alias("user"),
                                                     F.col("event_type").alias("type"), k.alias("k"))).alias("payload"))


@query("base64_decode", """
SELECT doc_id, decode(from_base64(to_base64(encode(text)))) = text AS roundtrip_ok,
       octet_length(from_base64(to_base64(encode(text)))) AS n_bytes
FROM documents
""")
def q_base64(spark, sf):
    d = _t(spark, sf, "documents")
    raw = S.base64_decode(S.base64_encode(S.encode_text("text")))
    return d.select("doc_id", (S.decode_text(raw) == F.col("text")).alias("roundtrip_ok"),
                    F.octet_length(raw).cast("bigint").alias("n_bytes"))


@query("encode_text", """
SELECT doc_id, octet_length(encode(text)) AS n_bytes, length(decode(encode(text))) AS n_chars FROM documents
""")
def q_encode(spark, sf):
    d = _t(spark, sf, "documents")
    b = S.encode_text("text")
    return d.select("doc_id", F.octet_length(b).cast("bigint").alias("n_bytes"),
                    F.length(S.decode_text(b)).cast("bigint").alias("n_chars"))


@query("config_hash", """
SELECT c_custkey, substr(sha256('{"nation": ' || CAST(c_nationkey AS VARCHAR) || ', "segment": "' || c_mktsegment || '"}'), 1, 16)
       AS cache_key
FROM customer
""")
def q_config_hash(spark, sf):
    c = _t(spark, sf, "customer")
    cfg = {"segment": F.col("c_mktsegment"), "nation": F.col("c_nationkey")}
    return c.select("c_custkey", S.config_hash(S.sorted_json(cfg)).alias("cache_key"))


@query("basename", f"""
SELECT page_id, path, list_last(string_split(path, '/')) AS title,
       split_part(repository, '/', 1) AS owner,
       substr(repository, strpos(repository, '/') + 1) AS name
FROM ({SQL_PAGES})
""")
def q_basename(spark, sf):
    e = B.repo_entries(_t(spark, sf, "pages"))
    return e.select("page_id", "path", S.basename("path").alias("title"), S.repo_owner("repository").alias("owner"),
                    S.repo_name("repository").alias("name"))


@query("author_email", f"""
SELECT event_id,
       coalesce(nullif(CASE WHEN event_type = 'signup' THEN 'sso-' || CAST(user_id AS VARCHAR) || '@corp.example.com' END, ''),
                email) AS author_email,
       coalesce(nullif(coalesce(nullif(CASE WHEN event_type = 'signup' THEN 'sso-' || CAST(user_id AS VARCHAR)
                || '@corp.example.com' END, ''), CASE WHEN event_type <> 'click' THEN email END), ''), login, 'Unknown') AS display
FROM ({SQL_COMMITS})
""")
def q_author(spark, sf):
    c = B.commit_history(_t(spark, sf, "events"))
    name_id = F.when(F.col("event_type") == "signup",
                     F.concat(F.lit("sso-"), F.col("user_id").cast("string"), F.lit("@corp.example.com")))
    profile = F.when(F.col("event_type") != "click", F.col("email"))
    return c.select("event_id", S.author_email(name_id, F.col("email")).alias("author_email"),
                    S.author_display(S.author_email(name_id, profile), F.col("login")).alias("display"))


# ====================================================================== table sources

ENTITY_TABLES = {
    "customer": ("c_custkey", "c_name"),
    "supplier": ("s_suppkey", "s_name"),
    "part": ("p_partkey", "p_name"),
    "orders": ("o_orderkey", "o_orderpriority"),
    "nation": ("n_nationkey", "n_name"),
    "region": ("r_regionkey", "r_name"),
}


@query("scan_tables", """
SELECT 'customer' AS entity_type, CAST(c_custkey AS VARCHAR) AS record_id, c_name AS title FROM customer
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_name FROM part
UNION ALL SELECT 'order', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders
UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation
UNION ALL SELECT 'region', CAST(r_regionkey AS VARCHAR), r_name FROM region
""")
def q_scan_tables(spark, sf):
    readers = {t: (lambda t=t, k=k, v=v: _t(spark, sf, t).select(F.col(k).cast("string").alias("record_id"),
                                                                 F.col(v).alias("title")))
               for t, (k, v) in ENTITY_TABLES.items()}
    return ST_.scan_tables(readers).select(F.col("entityType").alias("entity_type"), "record_id", "title")


SELECT_PATTERN = r"(customer|orders|part.*|.*ion)"


@query("select_tables", """
SELECT 'customer' AS table_name, true AS selected, count(*) AS n_rows FROM customer
UNION ALL SELECT 'orders', true, count(*) FROM orders
UNION ALL SELECT 'part', true, count(*) FROM part
UNION ALL SELECT 'nation', true, count(*) FROM nation
UNION ALL SELECT 'region', true, count(*) FROM region
UNION ALL SELECT t, false, NULL FROM (VALUES ('supplier'), ('lineitem'), ('events'), ('documents'), ('embeddings'),
                                             ('pages'), ('benchmark'), ('labels'), ('conversations')) v(t)
""")
def q_select_tables(spark, sf):
    """S2 + U2: full-match pattern over the catalog listing; selected tables are read
    whole (row counts), skipped ones reported."""
    selected, skipped = ST_.select_tables(ST_.discover_tables(spark, sf), pattern=SELECT_PATTERN)
    frames = [_t(spark, sf, t).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
              .select(F.lit(t).alias("table_name"), F.lit(True).alias("selected"), "n_rows") for t in selected]
    frames.append(spark.createDataFrame([(t, False, None) for t in skipped],
                                        "table_name string, selected boolean, n_rows bigint"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


SCAN_QUERY_SQL = """
SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS total, o_custkey AS customer
FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 150000
"""


@query("scan_query", SCAN_QUERY_SQL)
def q_scan_query(spark, sf):
    _t(spark, sf, "orders").createOrReplaceTempView("orders")
    return ST_.scan_query(spark, SCAN_QUERY_SQL)


FUNCTION_SQL = """
SELECT sanitize_doc_id(prefix_id('order', CAST(o_orderkey AS STRING))) AS doc_id,
       entity_type_for_table(lower(c_mktsegment)) AS entity_type, author_display(o_owner, c_name) AS author,
       acl_summary(acl_from_row(c_mktsegment <> 'BUILDING', filter(array(o_owner), o -> o IS NOT NULL), NULL, c_name)) AS acl,
       iso_date(o_orderdate) AS day, config_hash(concat(c_mktsegment, '/', o_orderpriority)) AS cache_key,
       array_join(extract_tickets(concat('ORD-', o_orderkey, ' ', o_orderpriority, ' C', c_nationkey, '-', o_custkey)), ',') AS tickets,
       int_or_null(substring(o_orderpriority, 1, 1)) AS priority
FROM (SELECT *, CASE WHEN o_totalprice > 100000 THEN lower(c_name) END AS o_owner FROM orders JOIN customer ON o_custkey = c_custkey)
WHERE int_or_null(substring(o_orderpriority, 1, 1)) <= 3
"""


@query("scan_query_functions", r"""
SELECT regexp_replace('order-' || CAST(o_orderkey AS VARCHAR), '[^a-zA-Z0-9_-]', '_', 'g') AS doc_id,
       lower(c_mktsegment) AS entity_type,
       CASE WHEN o_totalprice > 100000 THEN lower(c_name) ELSE c_name END AS author,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'PUBLIC' WHEN o_totalprice > 100000 THEN 'user:' || lower(c_name) ELSE 'user:' || c_name END AS acl,
       strftime(o_orderdate, '%Y-%m-%d') AS day, substr(sha256(c_mktsegment || '/' || o_orderpriority), 1, 16) AS cache_key,
       array_to_string(list_sort(list_distinct(regexp_extract_all('ORD-' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority || ' C'
         || CAST(c_nationkey AS VARCHAR) || '-' || CAST(o_custkey AS VARCHAR), '\b([A-Z][A-Z0-9]{1,9}-\d+)\b', 1))), ',') AS tickets,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority
FROM orders JOIN customer ON o_custkey = c_custkey WHERE TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) <= 3
""")
def q_scan_query_functions(spark, sf):
    """S3 with the library's functions in the query's own text."""
    register_functions(spark)
    for t in ("orders", "customer"):
        _t(spark, sf, t).createOrReplaceTempView(t)
    return ST_.scan_query(spark, FUNCTION_SQL)


@query("entity_type_for_table", """
WITH w AS (SELECT DISTINCT unnest(string_split(lower(p_name || ' ' || p_type || ' ' || p_brand), ' ')) AS word FROM part)
SELECT word,
       CASE WHEN word = 'part' THEN 'launch'
            WHEN word IN ('person', 'user') THEN word
            WHEN suffix(word, 'ies') AND length(word) > 3 THEN left(word, length(word) - 3) || 'y'
            WHEN suffix(word, 'ses') AND length(word) > 3 THEN left(word, length(word) - 3) || 's'
            WHEN suffix(word, 's') AND length(word) > 1 THEN left(word, length(word) - 1)
            ELSE word END AS entity_type
FROM w
""")
def q_entity_type(spark, sf):
    p = _t(spark, sf, "part")
    words = p.select(F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand")), " ")).alias("word")).distinct()
    return words.select("word", ST_.entity_type_column("word", {"part": "launch"}).alias("entity_type"))


@query("scan_table_minus_protected", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
""")
def q_cls(spark, sf):
    """``c_acctbal`` carries a policy tag the reader lacks; it is dropped before the
    scan is planned, so Parquet never reads it."""
    c = ST_.tag_columns(_t(spark, sf, "customer"), {"c_acctbal": ["finance.restricted"]})
    kept, _denied = ST_.scan_table_minus_protected(c, granted_tags=["public"])
    return kept


@query("scan_database", """
SELECT 'read' AS kind, 'customer' AS table_name, 'c_custkey,c_name,c_nationkey' AS detail, count(*) AS n FROM customer
UNION ALL SELECT 'read', 'nation', 'n_name,n_nationkey,n_regionkey', count(*) FROM nation
UNION ALL SELECT 'error', 'customer', 'read without account, c_acctbal', 1
UNION ALL SELECT 'skipped', 'region', NULL, 0
UNION ALL SELECT 'skipped', 'supplier', NULL, 0
""")
def q_scan_database(spark, sf):
    """S1, S2, S10 and U2 from a catalog: the tables of a database by a pattern; protected columns, one
    by a tag on a leaf inside it, are known from the written table's schema and recorded as errors
    of the run."""
    root = scratch_dir(spark, "database")
    database = "quill_" + root[-12:]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    c = _t(spark, sf, "customer")
    c = c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.struct("c_mktsegment", F.col("c_acctbal").alias("balance")).alias("account"))
    tables = {"customer": ST_.tag_columns(c, {"c_acctbal": ["finance"], "account.balance": ["finance"], "c_name": ["public"]}),
              "nation": _t(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"),
              "region": _t(spark, sf, "region"), "supplier": _t(spark, sf, "supplier")}
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
        spark.catalog.createTable(f"{database}.{name}", path=f"{root}/{name}", source="parquet")
    got = ST_.fetch_database(spark, database, pattern="customer|nat.*", granted_tags=["public"])
    columns = [c for c in got.records.columns if c not in ("entityType", "_table")]
    seen = F.array_sort(F.array_compact(F.array(*[F.max(F.when(F.col(c).isNotNull(), F.lit(c))) for c in columns])))
    read = got.records.groupBy(F.col("_table").alias("table_name")).agg(F.array_join(seen, ",").alias("detail"), F.count(F.lit(1)).alias("n"))
    told = [("error", t, message, 1) for _, t, _, message in got.errors] + [("skipped", t, None, 0) for t in got.skipped_tables]
    rest = spark.createDataFrame(told, "kind string, table_name string, detail string, n bigint")
    return read.select(F.lit("read").alias("kind"), "table_name", "detail", "n").unionByName(rest)


def registry() -> tuple[dict[str, QueryFn], dict[str, str]]:
    # Import the remaining query modules for their registrations.
    from quillspark.plans import catalog_docs, catalog_entities, catalog_repo  # noqa: F401
    return QUERIES, ORACLE

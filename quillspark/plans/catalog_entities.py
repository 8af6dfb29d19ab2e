"""Registered queries over entity rows (orders + customer): projections, ACL, dedupe,
drift, skip reasons, visibility and change application."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.operators import aggregates as AG
from quillspark.operators import filters as FL
from quillspark.operators import joins as J
from quillspark.operators import ordering as O
from quillspark.operators import project as P
from quillspark.operators import state as ST
from quillspark.operators.access import access_index
from quillspark.plans import bindings as B
from quillspark.session import scratch_dir
from quillspark.sources import mixed as MX
from quillspark.plans.catalog import SQL_CUSTOMER_EMAIL, SQL_ENTITY, SQL_ENTITY_DOCS, _t, query, shared

KNOWN = list(P.ENTITY_OBJECT_TYPES)


@shared
def rows(spark: SparkSession, sf: str) -> DataFrame:
    return B.entity_rows(_t(spark, sf, "orders"), _t(spark, sf, "customer"))


@shared
def emitted(spark: SparkSession, sf: str) -> DataFrame:
    """F2 -> F3 -> P8-P13 -> P14 (drops rows without ACL, i.e. F8)."""
    r = FL.drop_unmapped_entities(FL.drop_deletes(rows(spark, sf)), KNOWN)
    return P.finalize_documents(P.project_entities(r, KNOWN))


def latest(spark: SparkSession, sf: str, *cols) -> DataFrame:
    """W1 over emitted documents; ``cols`` narrows the carried payload (the dedupe
    aggregate then moves only what the query reads)."""
    e = emitted(spark, sf).withColumn("_updated", F.col("envelope")["updatedAt"])
    if cols:
        e = e.select("id", "_updated", "_seq", *cols)
    return O.latest_per_id(e, "id", [F.col("_updated"), F.col("_seq")])


def _props_text(env) -> F.Column:
    return F.array_join(F.transform(env["customProperties"], lambda p: F.concat(p["name"], F.lit("="), p["value"])), ";")


SQL_PROPS = f"""
CASE entityType
  WHEN 'initiative' THEN 'programStatus=' || o_orderstatus || ';activeQuarters=["Q' || CAST(quarter(o_orderdate) AS VARCHAR)
       || '"];hierarchyTeam=["' || c_mktsegment || '"]'
       || ';statusLogsJSONString=[{{"at":"' || strftime(o_orderdate, '%Y-%m-%d') || '","status":"' || o_orderstatus || '"}}]'
       || ';linksJSONString=[{{"title":"Order","url":"https://orders.example.com/' || CAST(seq AS VARCHAR) || '"}}]'
  WHEN 'commitment' THEN 'quarter=' || CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR)
       || ';commitmentStatus=' || o_orderstatus || ';isClosedOut=' || CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END
       || ';statusHistoryJsonString=[{{"status":"' || o_orderstatus || '","changedAt":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '"}}]'
  WHEN 'launch' THEN 'launchDate=' || strftime(o_orderdate, '%Y-%m-%d')
       || CASE WHEN o_totalprice > 200000 THEN ';platforms=["web","ios"]' ELSE '' END
       || ';reviewsJsonString=[{{"by":"' || email || '","at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '"}}]'
       || ';commitmentID=["commitment-' || CAST(seq AS VARCHAR) || '","commitment-' || CAST(o_custkey AS VARCHAR) || '"]'
       || ';links=["{{\\"title\\":\\"Order\\",\\"url\\":\\"https://orders.example.com/' || CAST(seq AS VARCHAR) || '\\"}}"]'
       || ';statusLogsJsonString=[{{"at":"' || strftime(o_orderdate, '%Y-%m-%d') || '","status":"' || o_orderstatus || '"}}]'
  WHEN 'person' THEN 'email=' || email || ';displayName=' || c_name || ';positionId=' || CAST(seq AS VARCHAR)
       || ';employeeId=' || CAST(c_custkey AS VARCHAR) || ';level=' || c_mktsegment || ';hierarchyTeam=' || c_mktsegment
END
"""

SQL_VIEW_URL = """
'https://entities.example.com' || CASE entityType WHEN 'initiative' THEN '/programs/' || id
  WHEN 'commitment' THEN '/commitment/' || id WHEN 'launch' THEN '/launch/' || id
  ELSE '/org?u=' || CAST(c_custkey AS VARCHAR) END
"""

SQL_AUTHOR = """
CASE WHEN entityType = 'person' THEN email ELSE coalesce(ownerEmail, 'internal.author@example.com') END
"""


@query("project_entities", f"""
SELECT seq, doc_id,
       CASE entityType WHEN 'initiative' THEN 'Initiatives' WHEN 'commitment' THEN 'Commitments'
                       WHEN 'launch' THEN 'Launches' ELSE 'OrgData' END AS object_type,
       title, {SQL_VIEW_URL} AS view_url, {SQL_AUTHOR} AS author_email, acl,
       coalesce(description, '') AS body_text, updatedAt AS updated_at,
       entityType = 'person' OR NOT private AS allow_anonymous,
       CASE WHEN entityType <> 'person' AND private THEN len(allowedUsers) ELSE 0 END AS n_allowed_users,
       {SQL_PROPS} AS props,
       CASE WHEN o_orderstatus = 'O' THEN 0 END AS likes,
       CASE WHEN o_orderstatus = 'O' THEN seq % 10 END AS comments,
       CASE WHEN o_orderstatus = 'O' THEN CAST(floor(o_totalprice) AS BIGINT) END AS views
FROM ({SQL_ENTITY_DOCS})
""")
def q_project_entities(spark, sf):
    """P7-P14 (+C12, C13): every emitted document before dedupe, flattened."""
    e = emitted(spark, sf)
    env = F.col("envelope")
    perms = env["permissions"]
    inter = env["interactions"]
    return e.select(F.col("_seq").alias("seq"), F.col("id").alias("doc_id"), env["objectType"].alias("object_type"),
                    env["title"].alias("title"), env["viewURL"].alias("view_url"),
                    env["author"]["email"].alias("author_email"), A.acl_summary("acl_info").alias("acl"),
                    env["body"]["textContent"].alias("body_text"), env["updatedAt"].alias("updated_at"),
                    perms["allowAnonymousAccess"].alias("allow_anonymous"),
                    F.coalesce(F.size(perms["allowedUsers"]), F.lit(0)).cast("bigint").alias("n_allowed_users"),
                    _props_text(env).alias("props"),
                    inter["numLikes"].alias("likes"), inter["numComments"].alias("comments"),
                    inter["numViews"].alias("views"))


@query("custom_properties", f"""
SELECT seq, {SQL_PROPS} AS props FROM ({SQL_ENTITY_DOCS})
""")
def q_custom_props(spark, sf):
    """Properties kept only when non-empty, values coerced to text."""
    e = emitted(spark, sf)
    return e.select(F.col("_seq").alias("seq"), _props_text(F.col("envelope")).alias("props"))


@query("acl_from_row", f"""
WITH r AS ({SQL_ENTITY})
SELECT seq,
  CASE WHEN NOT private THEN 'PUBLIC'
       WHEN len(allowedUsers) + coalesce(len(allowedGroups), 0) > 0 THEN
         array_to_string(list_concat(list_transform(allowedUsers, lambda u: 'user:' || u),
                         list_transform(coalesce(allowedGroups, []), lambda g: 'group:' || g)), ',')
       WHEN coalesce(ownerEmail, '') <> '' THEN 'user:' || ownerEmail END AS acl
FROM r
""")
def q_acl_row(spark, sf):
    """C12 over every entity row (NULL = nobody to grant to)."""
    r = rows(spark, sf)
    acl = A.acl_from_row("private", "allowedUsers", "allowedGroups", "ownerEmail")
    return r.select(F.col("_seq").alias("seq"), A.acl_summary(acl).alias("acl"))


@query("permissions_block", f"""
WITH r AS ({SQL_ENTITY})
SELECT seq, NOT private AS allow_anonymous,
       CASE WHEN private AND len(allowedUsers) > 0 THEN len(allowedUsers) END AS n_users,
       CASE WHEN private AND coalesce(len(allowedGroups), 0) > 0 THEN len(allowedGroups) END AS n_groups
FROM r
""")
def q_perm_block(spark, sf):
    """Anonymous flag; user/group lists only when private and non-empty."""
    r = rows(spark, sf)
    pb = A.permissions_block("private", "allowedUsers", "allowedGroups")
    return r.select(F.col("_seq").alias("seq"), pb["allowAnonymousAccess"].alias("allow_anonymous"),
                    F.size(pb["allowedUsers"]).cast("bigint").alias("n_users"),
                    F.size(pb["allowedGroups"]).cast("bigint").alias("n_groups"))


@query("interactions", f"""
WITH r AS ({SQL_ENTITY})
SELECT seq, CASE WHEN o_orderstatus = 'O' THEN 0 END AS likes,
       CASE WHEN o_orderstatus = 'O' THEN seq % 10 END AS comments,
       CASE WHEN o_orderstatus = 'O' THEN CAST(floor(o_totalprice) AS BIGINT) END AS views
FROM r
""")
def q_interactions(spark, sf):
    """Counters as integers, missing ones 0, only when present."""
    r = rows(spark, sf)
    i = P.interactions(r)
    return r.select(F.col("_seq").alias("seq"), i["numLikes"].alias("likes"), i["numComments"].alias("comments"),
                    i["numViews"].alias("views"))


@query("latest_per_id", f"""
SELECT doc_id, title, updatedAt AS updated_at, acl FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY updatedAt DESC, seq DESC) AS rn
  FROM ({SQL_ENTITY_DOCS})) WHERE rn = 1
""")
def q_latest(spark, sf):
    """Last arrival per document id wins (order: updatedAt, then source sequence)."""
    l = latest(spark, sf, F.col("envelope")["title"].alias("title"), A.acl_summary("acl_info").alias("acl"))
    return l.select(F.col("id").alias("doc_id"), "title", F.col("_updated").alias("updated_at"), "acl")


@query("drop_deletes", f"""
SELECT seq, entityType AS entity_type, coalesce(action, 'upsert') AS action
FROM ({SQL_ENTITY}) WHERE coalesce(action, 'upsert') <> 'delete'
""")
def q_drop_deletes(spark, sf):
    """delete actions skipped; missing action = upsert."""
    r = FL.drop_deletes(rows(spark, sf))
    return r.select(F.col("_seq").alias("seq"), F.col("entityType").alias("entity_type"),
                    FL.action_of("action").alias("action"))


@query("drop_unmapped_entities", f"""
SELECT seq, entityType AS entity_type FROM ({SQL_ENTITY})
WHERE entityType IN ('initiative', 'commitment', 'launch', 'person')
""")
def q_drop_unmapped(spark, sf):
    """rows whose entity type has a projection."""
    r = FL.drop_unmapped_entities(rows(spark, sf), KNOWN)
    return r.select(F.col("_seq").alias("seq"), F.col("entityType").alias("entity_type"))


@query("unmapped_entities", f"""
SELECT DISTINCT entityType AS entity_type FROM ({SQL_ENTITY})
WHERE coalesce(entityType, '') <> '' AND entityType NOT IN ('initiative', 'commitment', 'launch', 'person')
""")
def q_unmapped(spark, sf):
    """Distinct entity types without a projection (reported once each)."""
    return AG.unmapped_entities(rows(spark, sf), KNOWN)


SQL_REJECTED = f"""
SELECT seq, entityType,
  CASE WHEN coalesce(action, 'upsert') = 'delete' THEN 'deleted'
       WHEN entityType NOT IN ('initiative', 'commitment', 'launch', 'person') THEN 'unmapped_type'
       WHEN entityType <> 'person' AND private AND len(allowedUsers) + coalesce(len(allowedGroups), 0) = 0
            AND coalesce(ownerEmail, '') = '' THEN 'private_without_principals' END AS reason
FROM ({SQL_ENTITY})
"""


def rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Every row that produced no document, with the first reason in transform order."""
    r = rows(spark, sf)
    acl = A.acl_from_row("private", "allowedUsers", "allowedGroups", "ownerEmail")
    reason = (F.when(FL.action_of("action") == "delete", F.lit("deleted"))
              .when(~F.col("entityType").isin(*KNOWN), F.lit("unmapped_type"))
              .when((F.col("entityType") != "person") & acl.isNull(), F.lit("private_without_principals")))
    return r.withColumn("reason", reason).filter(F.col("reason").isNotNull())


SQL_JSON_DOCS = f"""
SELECT seq, doc_id, updatedAt,
       CASE entityType WHEN 'initiative' THEN 'Initiatives' WHEN 'commitment' THEN 'Commitments'
                       WHEN 'launch' THEN 'Launches' ELSE 'OrgData' END AS object_type,
       title, {SQL_VIEW_URL} AS view_url, {SQL_AUTHOR} AS author_email, {SQL_PROPS} AS props, acl
FROM ({SQL_ENTITY_DOCS})
"""


def _from_json(df: DataFrame, *more) -> DataFrame:
    """The fields of a document's ``json_data``, parsed back."""
    payload = F.from_json("json_data", "objectType string, title string, viewURL string, author struct<email:string>, "
                                       "customProperties array<struct<name:string,value:string>>")
    return df.select("*", payload.alias("_p")).select(
        *more, F.col("id").alias("doc_id"), F.col("_p.objectType").alias("object_type"), F.col("_p.title").alias("title"),
        F.col("_p.viewURL").alias("view_url"), F.col("_p.author.email").alias("author_email"),
        _props_text(F.col("_p")).alias("props"), A.acl_summary("acl_info").alias("acl"))


@query("finalize_document", f"SELECT * EXCLUDE (updatedAt) FROM ({SQL_JSON_DOCS})")
def q_finalize(spark, sf):
    """The serialised payload (``json_data``) of every document with an ACL, parsed back."""
    r = FL.drop_unmapped_entities(FL.drop_deletes(rows(spark, sf)), KNOWN)
    done = P.finalize_documents(P.project_entities(r, KNOWN), with_json=True)
    return _from_json(done, F.col("_seq").alias("seq"))


@query("sync_run_entities", f"""
SELECT * EXCLUDE (updatedAt, seq, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY updatedAt DESC, seq DESC) AS rn FROM ({SQL_JSON_DOCS})) WHERE rn = 1
""")
def q_sync_run_entities(spark, sf):
    """The end-to-end run: warehouse rows -> entity documents with ``json_data`` -> index, read back."""
    from quillspark.plans.run import sync_run
    from quillspark.session import scratch_dir
    from quillspark.sinks import index as K
    root = scratch_dir(spark, "sync-entities")
    steps = (
        FL.drop_deletes, lambda df: FL.drop_unmapped_entities(df, KNOWN),
        lambda df: P.finalize_documents(P.project_entities(df, KNOWN), with_json=True),
        lambda df: df.select("id", "json_data", "acl_info", F.col("envelope")["updatedAt"].alias("_updated"), "_seq", "_rec", "_source_key"),
    )
    sync_run(spark, rows(spark, sf), steps, root, mode="INCREMENTAL", order=["_updated", "_seq"])
    return _from_json(K.read_index(spark, root))


@query("drop_private_without_principals", f"SELECT seq, doc_id FROM ({SQL_ENTITY_DOCS})")
def q_drop_private(spark, sf):
    """F8: the documents left when the private ones with nobody to grant to are dropped."""
    r = FL.drop_unmapped_entities(FL.drop_deletes(rows(spark, sf)), KNOWN)
    kept = FL.drop_private_without_principals(P.project_entities(r, KNOWN))
    return kept.select(F.col("_seq").alias("seq"), F.col("id").alias("doc_id"))


@query("skip_reasons", f"""
SELECT reason, entityType AS entity_type, count(*) AS n FROM ({SQL_REJECTED}) WHERE reason IS NOT NULL
GROUP BY reason, entityType
""")
def q_skip_reasons(spark, sf):
    """Rows not emitted, counted by reason and entity type."""
    return AG.skip_reasons(rejected(spark, sf).withColumnRenamed("entityType", "entity_type"),
                           entity_col="entity_type")


@query("schema_drift", f"""
SELECT DISTINCT entityType AS entity, 'sourceTable' AS key, 'str' AS value_type FROM ({SQL_ENTITY_DOCS})
UNION ALL
SELECT DISTINCT entityType, 'totalPrice', 'float' FROM ({SQL_ENTITY_DOCS})
""")
def q_drift(spark, sf):
    """Unexpected keys with a value, per entity type, over the emitted rows."""
    r = FL.drop_unmapped_entities(FL.drop_deletes(rows(spark, sf)), KNOWN)
    acl = A.acl_from_row("private", "allowedUsers", "allowedGroups", "ownerEmail")
    ok = r.filter((F.col("entityType") == "person") | acl.isNotNull())
    return AG.schema_drift_typed(ok, P.ENTITY_KEYS)


SQL_MIXED = f"""
SELECT *, seq % 2 = 0 AS even, seq % 3 = 0 AS third FROM ({SQL_ENTITY}) WHERE seq % 11 <> 0
  AND entityType IN ('initiative', 'commitment', 'launch', 'person')
"""
SQL_MIXED_ACL = """
CASE WHEN entityType = 'person' OR NOT private THEN 'PUBLIC'
     WHEN len(allowedUsers) + coalesce(len(allowedGroups), 0) > 0 THEN
       array_to_string(list_concat(list_transform(allowedUsers, lambda u: 'user:' || u),
                       list_transform(coalesce(allowedGroups, []), lambda g: 'group:' || g)), ',')
     WHEN coalesce(ownerEmail, '') <> '' THEN 'user:' || ownerEmail END
"""


@shared
def mixed(spark: SparkSession, sf: str) -> DataFrame:
    """The records of mixed shape, landed as text files and read back as VARIANT."""
    path = scratch_dir(spark, "mixed-records")
    lines = B.mixed_records(_t(spark, sf, "orders"), _t(spark, sf, "customer"))
    lines.select(F.concat(F.col("_seq").cast("string"), F.lit("\t"), F.col("value"))).write.text(path)
    landed = spark.read.text(path).select(F.split_part("value", F.lit("\t"), F.lit(1)).cast("bigint").alias("_seq"),
                                          F.substr("value", F.instr("value", "\t") + 1).alias("value"))
    return MX.parse_records(landed)


@query("project_mixed_entities", f"""
SELECT seq, entityType || '-' || id AS doc_id, {SQL_MIXED_ACL} AS acl, updatedAt AS updated_at,
  CASE entityType
    WHEN 'initiative' THEN 'hierarchyTeam=' || CASE WHEN third THEN '"' || c_mktsegment || '"' ELSE '["' || c_mktsegment || '","Core"]' END
      || ';linksJSONString=[{{"address":"https://a.example.com/' || CAST(seq AS VARCHAR) || '","name":"Spec"}}]'
    WHEN 'commitment' THEN 'quarter=' || CASE WHEN even THEN '3' ELSE 'Q3' END || ';commitmentStatus=' || o_orderstatus
      || ';isClosedOut=' || CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END
    WHEN 'launch' THEN CASE WHEN third THEN '' ELSE 'platforms=["web","ios"];' END
      || 'commitmentID=["commitment-' || CAST(seq AS VARCHAR) || '","commitment-7"]'
      || ';links=["{{\\"name\\":\\"Plan\\",\\"url\\":\\"https://a.example.com/' || CAST(seq AS VARCHAR) || '\\"}}"]'
    ELSE 'positionId=' || CAST(seq AS VARCHAR) || ';level=0;hierarchyTeam=' || c_mktsegment END AS props,
  CASE WHEN third THEN 4 END AS likes, CASE WHEN third THEN 0 END AS comments, CASE WHEN third THEN seq END AS views
FROM ({SQL_MIXED}) WHERE {SQL_MIXED_ACL} IS NOT NULL
""")
def q_mixed(spark, sf):
    """P8-P14 over records whose keys change type, held as VARIANT."""
    r = FL.drop_unmapped_entities(MX.entity_columns(mixed(spark, sf).where("_raw IS NOT NULL")), KNOWN)
    e = P.finalize_documents(P.project_entities(r, KNOWN))
    env = F.col("envelope")
    return e.select(F.col("_seq").alias("seq"), F.col("id").alias("doc_id"), A.acl_summary("acl_info").alias("acl"),
                    env["updatedAt"].alias("updated_at"), _props_text(env).alias("props"), env["interactions"]["numLikes"].alias("likes"),
                    env["interactions"]["numComments"].alias("comments"), env["interactions"]["numViews"].alias("views"))


@query("schema_drift_raw", f"""
SELECT DISTINCT 'initiative' AS entity, 'budget' AS key, CASE WHEN even THEN 'int' ELSE 'str' END AS value_type
FROM ({SQL_MIXED}) WHERE entityType = 'initiative'
""")
def q_drift_raw(spark, sf):
    """A7 in its raw form, over the records of mixed shape: a key with two types is two rows."""
    r = mixed(spark, sf).where("_raw IS NOT NULL").select("_raw", MX.value_at(F.col("_raw"), "entityType", "string").alias("entityType"))
    return AG.schema_drift(FL.drop_unmapped_entities(r, KNOWN), P.ENTITY_KEYS)


@query("referenced_users", f"""
WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY updatedAt DESC, seq DESC) AS rn
                          FROM ({SQL_ENTITY_DOCS})) WHERE rn = 1),
e AS (SELECT {SQL_AUTHOR} AS email FROM l
      UNION SELECT unnest(allowedUsers) FROM l WHERE private AND entityType <> 'person'),
u AS (SELECT {SQL_CUSTOMER_EMAIL} AS email, c_name, c_acctbal > 0 AS active FROM customer)
SELECT e.email, e.email AS user_id, u.c_name AS name, coalesce(u.active, true) AS is_active
FROM e LEFT JOIN u ON e.email = u.email
""")
def q_referenced_users(spark, sf):
    """A10: users referenced by synced documents (authors and allowed users)."""
    c = _t(spark, sf, "customer")
    users = c.select(B.customer_email(F.col("c_name")).alias("email"), F.col("c_name").alias("name"),
                     (F.col("c_acctbal") > 0).alias("isActive"))
    out = AG.referenced_users(latest(spark, sf, "envelope"), users)
    return out.select("email", F.col("userId").alias("user_id"), "name", F.col("isActive").alias("is_active"))


@query("resolve_external_groups", f"""
WITH g AS (SELECT DISTINCT unnest(allowedGroups) AS group_id FROM ({SQL_ENTITY_DOCS}) WHERE entityType <> 'person')
SELECT DISTINCT g.group_id, {SQL_CUSTOMER_EMAIL} AS member_user_id
FROM g JOIN customer ON replace(g.group_id, 'external_group:', '') = 'nation-' || CAST(c_nationkey AS VARCHAR)
""")
def q_external_groups(spark, sf):
    """External-group principals of emitted documents -> member users."""
    e = emitted(spark, sf)
    first = F.element_at(F.col("acl_info")["readers"], 1)
    groups = (e.select(F.explode(first["principals"]).alias("p")).filter(F.col("p.group_id").isNotNull())
              .select(F.col("p.group_id").alias("group_id")).distinct())
    members = B.group_memberships(_t(spark, sf, "customer"))
    resolved = J.resolve_external_groups(groups, members, "group_id")
    return resolved.filter(F.col("member_user_id").isNotNull()).select("group_id", "member_user_id").distinct()


@query("visible_to", f"""
WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY updatedAt DESC, seq DESC) AS rn
                          FROM ({SQL_ENTITY_DOCS})) WHERE rn = 1),
p AS (SELECT doc_id, unnest(string_split(acl, ',')) AS principal FROM l WHERE acl <> 'PUBLIC'),
u AS (SELECT {SQL_CUSTOMER_EMAIL} AS user_id,
             'group:external_group:nation-' || CAST(c_nationkey AS VARCHAR) AS grp FROM customer),
v AS (SELECT DISTINCT u.user_id, p.doc_id FROM u JOIN p ON p.principal = 'user:' || u.user_id OR p.principal = u.grp)
SELECT u.user_id, (SELECT count(*) FROM l WHERE acl = 'PUBLIC')
       + (SELECT count(*) FROM v WHERE v.user_id = u.user_id) AS visible
FROM u
""")
def q_visible(spark, sf):
    """Number of (latest) documents each customer may read: public, granted to
    the user, or granted to the user's external group."""
    c = _t(spark, sf, "customer")
    users = c.select(B.customer_email(F.col("c_name")).alias("user_id"),
                     F.array(F.concat(F.lit("external_group:nation-"), F.col("c_nationkey").cast("string"))).alias("groups"))
    return J.visible_counts(latest(spark, sf, "acl_info"), users)


READER = ["user:customer.000000001@example.com", "group:external_group:nation-7"]


@query("visible_documents", f"""
SELECT seq, doc_id FROM ({SQL_ENTITY_DOCS})
WHERE acl = 'PUBLIC' OR list_has_any(string_split(acl, ','), {READER})
""")
def q_visible_documents(spark, sf):
    """J12 as a list: the documents that one user may read, by own grant, group or for everyone."""
    return J.visible_to(emitted(spark, sf), READER).select(F.col("_seq").alias("seq"), F.col("id").alias("doc_id"))


SQL_RESTRICTED = f"""
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY updatedAt DESC, seq DESC) AS rn
                     FROM ({SQL_ENTITY_DOCS})) WHERE rn = 1),
p AS (SELECT doc_id, unnest(string_split(acl, ',')) AS principal FROM l WHERE acl <> 'PUBLIC')
"""


@query("readable_documents", f"""
WITH {SQL_RESTRICTED},
u AS (SELECT {SQL_CUSTOMER_EMAIL} AS user_id, 'group:external_group:nation-' || CAST(c_nationkey AS VARCHAR) AS grp
      FROM customer WHERE c_custkey % 50 = 0)
SELECT DISTINCT u.user_id, p.doc_id FROM u JOIN p ON p.principal = 'user:' || u.user_id OR p.principal = u.grp
""")
def q_readable_documents(spark, sf):
    """J12 as the search path does it, for many readers at once: every fiftieth customer against all
    (latest) documents, through the signatures; public documents are not listed again for each."""
    c = _t(spark, sf, "customer").where(F.col("c_custkey") % 50 == 0)
    readers = c.select(B.customer_email(F.col("c_name")).alias("user_id"),
                       F.array(F.concat(F.lit("external_group:nation-"), F.col("c_nationkey").cast("string"))).alias("groups"))
    index = access_index(latest(spark, sf, "acl_info"))
    return index.documents(readers).withColumnRenamed("id", "doc_id")


# The newest row of an id decides, whether it is in the index or in the feed; at the same time the feed wins.
SQL_APPLY_CHANGES = f"""
WITH r AS ({SQL_ENTITY}),
m AS (SELECT *, entityType || '-' || id AS doc_id FROM r WHERE entityType IN ('initiative', 'commitment', 'launch', 'person'))
SELECT doc_id, title FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY updatedAt DESC, seq DESC, action IS NOT NULL DESC) rn FROM m)
WHERE rn = 1 AND coalesce(action, 'upsert') <> 'delete'
"""


@query("apply_changes", SQL_APPLY_CHANGES)
def q_apply_changes(spark, sf):
    """Closed orders form the index; open (update) and pending (delete) orders are a
    change feed applied with deletes propagated."""
    r = FL.drop_unmapped_entities(rows(spark, sf), KNOWN) \
        .withColumn("doc_id", F.concat(F.col("entityType"), F.lit("-"), F.col("id")))
    base = r.filter(F.col("action").isNull()).select("doc_id", "title", "updatedAt", "_seq")
    index = O.latest_per_id(base, "doc_id", [F.col("updatedAt"), F.col("_seq")])
    changes = r.filter(F.col("action").isNotNull()).select("doc_id", "title", "action", "updatedAt", "_seq")
    applied = index
    for part in range(3):  # three batches, with late events in each
        batch = changes.filter(F.pmod(F.col("_seq"), F.lit(3)) == part)
        applied = ST.apply_changes(applied, batch, ["updatedAt", "_seq"], key="doc_id", propagate_deletes=True)
    return ST.live(applied).select("doc_id", "title")


@query("apply_changes_stream", SQL_APPLY_CHANGES)
def q_apply_changes_stream(spark, sf):
    """I7 as Structured Streaming: the change feed lands as JSON files, a
    ``foreachBatch`` stream (available-now trigger, checkpointed) applies it to the
    published index, and the resulting index version is read back."""
    from quillspark.session import scratch_dir
    from quillspark.sinks import index as K
    from quillspark.streaming.changes import start_change_stream
    r = FL.drop_unmapped_entities(rows(spark, sf), KNOWN) \
        .withColumn("doc_id", F.concat(F.col("entityType"), F.lit("-"), F.col("id")))
    root, changes_dir, ckpt = (scratch_dir(spark, n) for n in ("stream-index", "stream-changes", "stream-ckpt"))
    base = r.filter(F.col("action").isNull()).select("doc_id", "title", "updatedAt", "_seq")
    newest = O.latest_per_id(base, "doc_id", [F.col("updatedAt"), F.col("_seq")])
    K.publish(spark, newest.withColumn("_deleted", F.lit(False)), root, key="doc_id")
    feed = r.filter(F.col("action").isNotNull()).select("doc_id", "title", "action", "updatedAt", "_seq")
    for part in range(2):  # two batches, with late events in both
        feed.filter(F.pmod(F.col("_seq"), F.lit(2)) == part).write.mode("append").json(changes_dir)
        q = start_change_stream(spark, changes_dir, feed.schema, root, ckpt, key="doc_id",
                                order=("updatedAt", "_seq"), propagate_deletes=True)
        q.awaitTermination()
    return ST.live(K.read_index(spark, root)).select("doc_id", "title")

"""Bindings of the reference's record shapes onto the driver tables.

The reference pulls records from warehouse tables and a code-hosting API; the
driver tables are TPC-H-like plus text tables.  Each function here derives one
reference record shape from whole driver tables with plain column expressions,
so every registered query does work proportional to its inputs:

* documents      -> REST records (P1, K1-K9, A1-A3, I6)
* orders+customer -> entity rows (P7-P14, F2, F3, F8, W1, A7, A8, A11, J11, J12, I7)
* customer+nation+region -> repository policy (J6, J8) and group memberships (J11, J12)
* pages          -> repository tree entries and blobs (S6, F4-F7, J1-J3, P2, C3, C16)
* conversations  -> pull requests and issues with comment threads (S7, S8, P3, P4, C15)
* events         -> commit histories per repository (S9, W3, W4, A4-A6, J4, J5, J10, J13, F10, I1-I5)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.scalars import iso_datetime

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Epoch seconds and ISO text of zone-less timestamps must not depend on where the
    # driver runs: pin the session time zone to UTC.
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- documents -> REST records

def rest_records(documents: DataFrame) -> DataFrame:
    """REST record per document: id ``source/doc_id`` (unsanitized), title = first line,
    German texts arrive base64-encoded, but source ``src7`` sends its own marker and plain
    text in that field, which does not decode; readers = the source's user plus the language
    group; source ``src0`` is published to everyone."""
    d = documents
    perms = F.array(
        F.struct(F.concat(F.col("source"), F.lit("@docs.example.com")).alias("email"), F.lit("user").alias("type")),
        F.struct(F.concat(F.lit("readers-"), F.col("lang"), F.lit("@docs.example.com")).alias("email"),
                 F.lit("group").alias("type")),
        F.struct(F.when(F.col("source") == "src0", F.lit("allUsers")).alias("email"), F.lit("user").alias("type")),
    )
    return d.select(
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("id"),
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        F.when(F.col("lang") != "de", F.col("text")).alias("content"),
        F.when(F.col("lang") == "de", F.when(F.col("source") == "src7", F.concat(F.lit("raw:"), "text"))
               .otherwise(F.base64(F.encode(F.col("text"), "UTF-8")))).alias("content_base64"),
        F.col("lang").alias("department_code"),
        F.lit(None).cast("string").alias("mime"),
        F.lit(None).cast("string").alias("version"),
        F.lit(None).cast("string").alias("database_cluster_node"),
        perms.alias("permissions"),
        F.col("doc_id").alias("_seq"), F.col("source").alias("_source"), F.col("n_chars").alias("_n_chars"),
        F.col("doc_id").alias("_doc_id"),
    )


# ---------------------------------------------------------------- orders + customer -> entity rows

def customer_email(name: Column) -> Column:
    return F.concat(F.lower(F.regexp_replace(name, "#", ".")), F.lit("@example.com"))


# Fixed binding choices (ours): order priority -> entity type, status -> action.
PRIORITY_ENTITY = [("1-URGENT", "initiative"), ("2-HIGH", "commitment"), ("3-MEDIUM", "launch"),
                   ("4-NOT SPECIFIED", "person")]
UNMAPPED_ENTITY = "user"


def entity_rows(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One entity row per order, as a warehouse export would land them.  The entity id
    is the customer key, so several orders update the same entity (latest wins)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    etype = None
    for prio, ent in PRIORITY_ENTITY:
        cond = F.col("o_orderpriority") == prio
        etype = F.when(cond, F.lit(ent)) if etype is None else etype.when(cond, F.lit(ent))
    etype = etype.otherwise(F.lit(UNMAPPED_ENTITY))
    email = customer_email(F.col("c_name"))
    epoch = F.unix_timestamp(F.col("o_orderdate")).cast("bigint")
    status = F.col("o_orderstatus")
    seg = F.col("c_mktsegment")
    q = F.quarter("o_orderdate").cast("string")
    et = etype

    def only(entity: str, col: Column) -> Column:
        return F.when(et == entity, col)

    return j.select(
        etype.alias("entityType"),
        F.when(status == "P", F.lit("delete")).when(status == "O", F.lit("update")).alias("action"),
        F.col("o_custkey").cast("string").alias("id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.when(status != "F", F.concat(F.lit("Priority "), F.col("o_orderpriority"))).alias("description"),
        F.lit(None).cast("string").alias("url"),
        epoch.alias("createdAt"), epoch.alias("updatedAt"),
        seg.isin("BUILDING", "MACHINERY", "FURNITURE").alias("private"),
        F.when(seg == "BUILDING", F.array(email)).otherwise(F.array().cast("array<string>")).alias("allowedUsers"),
        F.when(seg == "FURNITURE", F.array(F.concat(F.lit("external_group:nation-"), F.col("c_nationkey").cast("string"))))
         .alias("allowedGroups"),
        F.when(F.col("o_totalprice") > 100000, email).alias("ownerEmail"),
        F.when(status == "O", F.struct(F.lit(None).cast("bigint").alias("numLikes"),
                                       (F.col("o_orderkey") % 10).cast("bigint").alias("numComments"),
                                       F.col("o_totalprice").cast("bigint").alias("numViews"))).alias("interactions"),
        # initiative
        only("initiative", status).alias("programStatus"),
        only("initiative", F.array(F.concat(F.lit("Q"), q))).alias("activeQuarters"),
        # hierarchyTeam: a list for initiatives (landed as JSON text), a string for people
        F.when(et == "initiative", F.to_json(F.array(seg))).when(et == "person", seg).alias("hierarchyTeam"),
        # commitment
        only("commitment", F.concat(F.year("o_orderdate").cast("string"), F.lit("-Q"), q)).alias("quarter"),
        only("commitment", status).alias("commitmentStatus"),
        only("commitment", status == "F").alias("isClosedOut"),
        # launch
        only("launch", F.to_date("o_orderdate")).alias("launchDate"),
        F.when(et.isin("initiative", "launch"), F.array(F.struct(F.to_date("o_orderdate").alias("at"), status.alias("status"))))
         .alias("statusLogs"),
        F.when(et.isin("initiative", "launch"), F.array(F.struct(F.lit("Order").alias("title"), F.concat(
            F.lit("https://orders.example.com/"), F.col("o_orderkey").cast("string")).alias("url")))).alias("links"),
        only("launch", F.array(F.struct(email.alias("by"), F.col("o_orderdate").cast("timestamp").alias("at")))).alias("reviews"),
        only("commitment", F.array(F.struct(status.alias("status"), F.col("o_orderdate").cast("timestamp_ntz").alias("changedAt"))))
         .alias("statusHistory"),
        only("launch", F.when(F.col("o_totalprice") > 200000, F.array(F.lit("web"), F.lit("ios")))
             .otherwise(F.array().cast("array<string>"))).alias("platforms"),
        only("launch", F.array(F.col("o_orderkey").cast("string"),
                               F.concat(F.lit("commitment-"), F.col("o_custkey").cast("string")))).alias("commitmentIds"),
        # person
        only("person", email).alias("email"), only("person", F.col("c_name")).alias("displayName"),
        only("person", F.col("o_orderkey").cast("string")).alias("positionId"),
        only("person", F.col("c_custkey").cast("string")).alias("employeeId"), only("person", seg).alias("level"),
        # columns the projections do not know (schema drift)
        F.lit("orders").alias("sourceTable"), F.col("o_totalprice").alias("totalPrice"),
        F.col("o_orderkey").alias("_seq"), F.col("c_nationkey").alias("_nation"), seg.alias("_segment"),
    )


def mixed_records(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The same orders as JSON lines of mixed shape: (_seq, value).  Numbers arrive as numbers or
    as text, lists as lists or as one text, links in two shapes, and some lines are no objects."""
    e = entity_rows(orders, customer)
    et, seq = F.col("entityType"), F.col("_seq")
    even, third = seq % 2 == 0, seq % 3 == 0

    def either(cond: Column, a: Column, b: Column) -> Column:
        """JSON text of ``a`` or of ``b``, whose types differ."""
        return F.when(cond, json_value(a)).otherwise(json_value(b))

    def json_value(c: Column) -> Column:
        text = F.to_json(F.struct(c.alias("v")))
        return F.when(c.isNotNull(), F.substring(text, F.lit(6), F.length(text) - 6))

    def when(kind: str, c: Column) -> Column:
        return F.when(et == kind, c)

    team = F.when(et == "initiative", either(third, F.col("_segment"), F.array("_segment", F.lit("Core")))).when(et == "person", json_value(F.col("_segment")))
    address = F.concat(F.lit("https://a.example.com/"), seq.cast("string"))
    links = F.when(et == "initiative", json_value(F.array(F.struct(address.alias("address"), F.lit("Spec").alias("name"))))) \
        .when(et == "launch", json_value(F.array(F.struct(F.lit("Plan").alias("name"), address.alias("url")))))
    values = {
        "entityType": json_value(et), "id": either(even, F.col("id").cast("bigint"), F.col("id")), "title": json_value(F.col("title")),
        "updatedAt": either(third, F.col("updatedAt"), F.col("updatedAt").cast("string")),
        "private": either(even, F.col("private"), F.when(F.col("private"), F.lit(1)).otherwise(F.lit(0))),
        "allowedUsers": F.when(F.size("allowedUsers") > 0, either(even, F.col("allowedUsers"), F.get("allowedUsers", F.lit(0)))),
        "allowedGroups": json_value(F.col("allowedGroups")), "ownerEmail": json_value(F.col("ownerEmail")),
        "hierarchyTeam": team, "links": links,
        "quarter": when("commitment", either(even, F.lit(3), F.lit("Q3"))), "commitmentStatus": when("commitment", json_value(F.col("commitmentStatus"))),
        "isClosedOut": when("commitment", json_value(F.col("isClosedOut"))),
        "platforms": when("launch", either(third, F.array().cast("array<string>"), F.array(F.lit("web"), F.lit("ios")))),
        "commitmentIds": when("launch", F.concat(F.lit("["), seq.cast("string"), F.lit(',"commitment-7"]'))),
        "positionId": when("person", either(even, seq, seq.cast("string"))), "level": when("person", json_value(F.lit(0))),
        "budget": when("initiative", either(even, F.lit(10), F.lit("ten"))),
        "interactions": F.when(third, F.concat(F.lit('{"numLikes":"4","numViews":'), seq.cast("string"), F.lit("}"))),
    }
    members = [F.concat(F.lit(f'"{k}":'), v) for k, v in values.items()]
    line = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    return e.select("_seq", F.when(seq % 11 == 0, F.lit("[1, 2]")).otherwise(line).alias("value"))


# ---------------------------------------------------------------- policy from customer / nation / region

def policy_groups(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Groups = regions; members = the region's nation mailboxes in nation-key order."""
    return (nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "inner")
            .select(F.col("r_name").alias("name"), F.col("n_nationkey").alias("pos"),
                    F.concat(F.lower("n_name"), F.lit("@example.com")).alias("email")))


def policy_mappings(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One mapping per BUILDING or AUTOMOBILE customer (repository = customer name):
    AUTOMOBILE is public; BUILDING grants its region's group plus the customer.  A
    wildcard entry covers everyone else."""
    c = customer.filter(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"))
    j = (c.join(nation, c["c_nationkey"] == nation["n_nationkey"], "inner")
         .join(region, nation["n_regionkey"] == region["r_regionkey"], "inner"))
    m = j.select(F.col("c_custkey").cast("int").alias("seq"), F.col("c_name").alias("repository"),
                 (F.col("c_mktsegment") == "AUTOMOBILE").alias("is_public"),
                 F.array(F.col("r_name")).alias("groups"),
                 F.array(customer_email(F.col("c_name"))).alias("emails"))
    star = customer.sparkSession.createDataFrame(
        [(-1, "*", False, [], ["fallback-readers@example.com"])],
        "seq int, repository string, is_public boolean, groups array<string>, emails array<string>")
    return m.unionByName(star)


def group_memberships(customer: DataFrame) -> DataFrame:
    """External groups ``nation-<k>`` -> member users (customers of that nation)."""
    return customer.select(F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("external_identity"),
                           customer_email(F.col("c_name")).alias("user_id"))


# ---------------------------------------------------------------- pages -> repository tree

def page_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://([^/?#]+)", 1)


def page_repository(url: Column) -> Column:
    """``owner/name`` from the host: first label is the owner."""
    return F.regexp_replace(page_host(url), r"^([^.]+)\.", "$1/")


def page_path(url: Column) -> Column:
    p = F.regexp_extract(url, r"^https?://[^/?#]+/([^?#]*)", 1)
    return F.when(p.endswith("/") | (p == ""), F.concat(p, F.lit("index.html"))).otherwise(p)


def repo_entries(pages: DataFrame) -> DataFrame:
    return pages.select(page_repository(F.col("url")).alias("repository"), F.lit("main").alias("branch"),
                        page_path(F.col("url")).alias("path"), F.lit("blob").alias("type"),
                        F.sha2(F.col("html"), 256).alias("oid"), F.col("page_id"))


def repo_blobs(pages: DataFrame) -> DataFrame:
    """Blobs; pages whose address carries a query string are treated as binary exports."""
    return pages.select(page_repository(F.col("url")).alias("repository"), page_path(F.col("url")).alias("path"),
                        F.sha2(F.col("html"), 256).alias("oid"), F.col("html").alias("text"),
                        F.col("url").contains("?").alias("isBinary"),
                        F.octet_length(F.col("html")).cast("bigint").alias("byteSize"))


# ---------------------------------------------------------------- conversations -> pull requests / issues

def _turn_struct(with_state: bool) -> Column:
    fields = [F.concat(F.lit("turn-"), F.col("turn").cast("string")).alias("createdAt"),
              F.col("text").alias("body"), F.struct(F.col("role").alias("login")).alias("author")]
    if with_state:
        fields.insert(2, F.lit("COMMENTED").alias("state"))
    return F.struct(F.col("turn"), *fields)


def _thread(cond: Column, with_state: bool) -> Column:
    """The turns that meet ``cond``, in order: they are the text of one document."""
    return F.array_sort(F.collect_list(F.when(cond, _turn_struct(with_state))))


def pull_requests(conversations: DataFrame, with_reviews: bool = True) -> DataFrame:
    """Conversation = pull request (issue when ``with_reviews`` is False): its first turn
    opens it, the others are comments; with reviews, later system turns are reviews.

    One aggregate by conversation; the first turn is told from the others afterwards."""
    conv = conversations.select("conv_id", "turn", "role", "text")
    system = F.col("role") == "system" if with_reviews else F.lit(False)
    by = conv.groupBy("conv_id").agg(
        F.min(F.struct("turn", "text", "role")).alias("head"),
        _thread(~system, False).alias("comments"), _thread(system, True).alias("reviews"))
    first = F.col("head")["turn"]

    def later(name: str) -> Column:
        return F.transform(F.filter(name, lambda s: s["turn"] > first), lambda s: s.dropFields("turn"))

    out = by.select(
        "conv_id", F.substring_index("head.text", "\n", 1).alias("title"), F.col("head.text").alias("body"),
        F.struct(F.col("head.role").alias("login"), F.lit(None).cast("string").alias("email")).alias("author"),
        later("comments").alias("comments"), later("reviews").alias("reviews"))
    kind = "pr" if with_reviews else "issue"
    return out.select(
        F.concat(F.lit("org/threads:" + kind + ":"), F.col("conv_id").cast("string")).alias("id"),
        F.col("conv_id").alias("number"), "title", "body", F.lit("OPEN").alias("state"),
        F.lit(None).cast("string").alias("created_at"), F.lit(None).cast("string").alias("updated_at"),
        "author", "comments", *(["reviews"] if with_reviews else []),
        F.lit("org/threads").alias("repository"))


# ---------------------------------------------------------------- events -> commit history

def commit_history(events: DataFrame) -> DataFrame:
    """Each event is a commit of repository ``org/user-<id>``; ``view`` commits have no
    linked login and ``error`` commits carry an address without ``@``."""
    e = events.select("event_id", "ts", "user_id", "event_type", "props")
    login = F.when(F.col("event_type") != "view", F.concat(F.lit("user"), F.col("user_id").cast("string")))
    local = F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("."), F.col("event_type"))
    email = F.when(F.col("event_type") == "error", local).otherwise(F.concat(local, F.lit("@example.com")))
    return e.select(
        F.concat(F.lit("org/user-"), F.col("user_id").cast("string")).alias("repository"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("sha"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("message"),
        iso_datetime("ts").alias("committed_date"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("name"), email.alias("email"),
                 F.struct(login.alias("login")).alias("user")).alias("author"),
        login.alias("login"), email.alias("email"),
        F.col("ts"), F.col("event_id"), F.col("event_type"), F.col("user_id"))


def newest_first() -> list[Column]:
    return [F.col("ts").desc(), F.col("event_id").desc()]


def age() -> Column:
    """A value that is largest for the oldest commit."""
    return F.struct(-F.unix_micros(F.col("ts").cast("timestamp")), -F.col("event_id"))

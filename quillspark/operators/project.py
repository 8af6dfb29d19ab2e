"""Record -> document projections (survey P1-P15).

A projection is a ``DataFrame -> DataFrame`` function built from column
expressions only (``struct``, ``transform``, ``filter``, ``concat_ws``...), so a
whole chain compiles into one whole-stage-codegen span with the scan.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.acl import (acl_from_permissions, acl_from_row, permissions_block,
                                      public_acl)
from quillspark.functions.scalars import (author_display, author_email, base64_decode, basename, encode_text,
                                          extract_tickets, has_dates, int_or_null, iso_deep, prefix_id, sanitize_doc_id,
                                          thread_lines)

# Fixed values that must equal the reference's.
REST_DEFAULTS = {
    "title": "Untitled Document",
    "department": "General",
    "mime": "text/html",
    "version": "1.0_rest",
    "node": "primary",
}
# Deployment settings of the entity sync (the next three) (the datasource name written into each
# payload, the author used when a row names none, the base of generated view URLs):
# set them to the values of the deployment being replaced.
ENTITY_DATASOURCE = "entity-catalog"
INTERNAL_AUTHOR_FALLBACK = "internal.author@example.com"
ENTITY_URL_BASE = "https://entities.example.com"
# Fixed values that must equal the reference's: object types, URL paths, payload keys, kinds.
ENTITY_OBJECT_TYPES = {
    "initiative": "Initiatives",
    "commitment": "Commitments",
    "launch": "Launches",
    "person": "OrgData",
}
ENTITY_URL_PATHS = {
    "initiative": "/programs/",
    "commitment": "/commitment/",
    "launch": "/launch/",
    "person": "/org?u=",
}
ENTITY_KEYS = {
    "initiative": ["startDate", "endDate", "programStatus", "primaryPillar",
                   "activeQuarters", "linkedLaunchIds", "linkedCommitmentIds",
                   "hierarchyTeam", "statusLogs", "links", "decisions",
                   "risks", "resources"],
    "commitment": ["responsibleUser", "accountableUser", "quarter", "pillar",
                   "commitmentStatus", "isClosedOut", "statusHistory"],
    "launch": ["launchDate", "committedQuarter", "platforms", "productSurfaces",
               "pillars", "reviews", "commitmentIds", "links", "statusLogs"],
    "person": ["managerEmail", "directorEmail", "executiveEmail", "function",
               "specialties", "pillar", "email", "displayName", "positionId",
               "positionStatus", "employeeId", "level", "hierarchyTeam",
               "assignedToTeam"],
}
DISCUSSION_TYPES = {
    "pull_request": "discussion_pr",
    "issue": "discussion_issue",
    "commit": "discussion_commit",
}


def _opt(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """Column if present, else a typed NULL (landed tables differ in their columns)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType if name in df.columns else T.StringType()


# ---------------------------------------------------------------- P1 REST

REST_UNDECODABLE = "content is not valid base64"


def project_rest_document(records: DataFrame) -> DataFrame:
    """REST record -> document.  The id is required and *not* sanitized; content is
    base64-decoded if given, else UTF-8 text, else none; ACL from C11.  A body that does
    not decode fails the record: ``_error`` says so, NULL on all others, and
    ``state.quarantine(docs, F.col("_error"), ...)`` parts the two."""
    r = records
    mime = F.coalesce(_opt(r, "mime"), F.lit(REST_DEFAULTS["mime"]))
    b64 = _opt(r, "content_base64")
    text = _opt(r, "content")
    raw = F.when(b64.isNotNull(), base64_decode(b64)).when(text.isNotNull(), encode_text(text))
    content = F.when(b64.isNotNull() | text.isNotNull(),
                     F.struct(mime.alias("mime_type"), raw.alias("raw_bytes")))
    struct_data = F.struct(
        F.coalesce(_opt(r, "title"), F.lit(REST_DEFAULTS["title"])).alias("title"),
        F.coalesce(_opt(r, "department_code"), F.lit(REST_DEFAULTS["department"])).alias("department"),
        mime.alias("mimeType"),
        F.coalesce(_opt(r, "version"), F.lit(REST_DEFAULTS["version"])).alias("version"),
        F.coalesce(_opt(r, "database_cluster_node"), F.lit(REST_DEFAULTS["node"])).alias("sys_audit_node"),
    )
    perms = _opt(r, "permissions", "array<struct<email:string,type:string>>")
    error = F.when(b64.isNotNull() & raw.isNull(), F.lit(REST_UNDECODABLE))
    keep = [c for c in r.columns if c.startswith("_") and c != "_error"]  # carry bookkeeping columns (_seq, _source...)
    return (r.filter(F.coalesce(F.col("id").cast("string"), F.lit("")) != "")
             .select(F.col("id").cast("string").alias("id"), struct_data.alias("struct_data"),
                     content.alias("content"), acl_from_permissions(perms).alias("acl_info"), *keep, error.alias("_error")))


# ---------------------------------------------------------------- repository documents

def project_file_document(files: DataFrame, web_base: Column | str) -> DataFrame:
    """Repository file -> document.  Expects (id, path, oid, content, byte_size,
    repository, branch) plus optional ``contributors`` and ``acl_info`` columns."""
    base = F.lit(web_base) if isinstance(web_base, str) else web_base
    f = files
    url = F.concat_ws("/", base, F.col("repository"), F.lit("blob"),
                      F.coalesce(F.nullif(F.col("branch"), F.lit("")), F.lit("main")), F.col("path"))
    sd = F.struct(
        basename("path").alias("title"), F.col("path").alias("filePath"), F.col("oid").alias("gitOid"),
        F.col("repository").alias("repository"),
        F.coalesce(F.col("byte_size"), F.lit(0)).cast("bigint").alias("byteSize"),
        F.lit("text/plain").alias("mimeType"), url.alias("sourceUrl"),
        extract_tickets(F.col("content")).alias("jiraTickets"),
        _opt(f, "contributors", "array<string>").alias("contributors"),
    )
    content = F.struct(F.lit("text/plain").alias("mime_type"),
                       encode_text(F.coalesce(F.col("content"), F.lit(""))).alias("raw_bytes"))
    return (f.filter(F.coalesce(F.col("id"), F.lit("")) != "")
             .filter(F.coalesce(F.col("path"), F.lit("")) != "")
             .filter(F.coalesce(F.col("repository"), F.lit("")) != "")
             .select(sanitize_doc_id("id").alias("id"), F.col("repository"), sd.alias("struct_data"),
                     content.alias("content"), _opt(f, "acl_info", "struct<readers:array<struct<idp_wide:boolean,principals:array<struct<user_id:string,group_id:string>>>>>").alias("acl_info")))


def pull_request_text(number: Column, title: Column, state: Column, author: Column, created: Column,
                      body: Column, comments: Column, reviews: Column | None, kind: str = "PULL REQUEST") -> Column:
    """C15/P3 body: header, state, author, created, description, then comment and review
    sections when non-empty.  Lines are joined with newlines."""
    head = F.array(
        F.concat(F.lit(f"{kind} #"), number.cast("string"), F.lit(": "), F.coalesce(title, F.lit("None"))),
        F.concat(F.lit("State: "), F.coalesce(state, F.lit("None"))),
        F.concat(F.lit("Author: "), author),
        F.concat(F.lit("Created At: "), F.coalesce(created, F.lit(""))),
        F.lit(""), F.lit("--- Description ---"), F.coalesce(body, F.lit("")), F.lit(""))
    c_lines = thread_lines(comments)
    c_section = F.when(F.size(c_lines) > 0,
                       F.concat(F.array(F.lit("--- Comments & Discussions ---")), c_lines, F.array(F.lit(""))))
    parts = [head, F.coalesce(c_section, F.array().cast("array<string>"))]
    if reviews is not None:
        r_lines = thread_lines(reviews, with_state=True)
        parts.append(F.coalesce(F.when(F.size(r_lines) > 0,
                                       F.concat(F.array(F.lit("--- Reviews ---")), r_lines)),
                                F.array().cast("array<string>")))
    return F.array_join(F.concat(*parts), "\n")


def _struct_field(df: DataFrame, col: str, field: str) -> Column:
    dt = df.schema[col].dataType if col in df.columns else None
    if isinstance(dt, T.StructType) and field in dt.fieldNames():
        return F.col(col)[field]
    return F.lit(None).cast("string")


def _discussion_common(df: DataFrame, kind: str, url_part: str, web_base: str, with_reviews: bool) -> DataFrame:
    # C14: SSO name id when landed, else the author's profile e-mail, else login, else Unknown.
    email = author_email(_opt(df, "author_name_id"), _struct_field(df, "author", "email"))
    author = author_display(email, _struct_field(df, "author", "login"))
    comments = F.coalesce(F.col("comments"), F.array())
    reviews = F.coalesce(F.col("reviews"), F.array()) if with_reviews else None
    text = pull_request_text(F.col("number"), F.col("title"), F.col("state"), author, F.col("created_at"),
                             F.col("body"), comments, reviews,
                             "PULL REQUEST" if with_reviews else "ISSUE")
    scan = F.concat_ws("\n", F.coalesce(F.col("title"), F.lit("None")), F.coalesce(F.col("body"), F.lit("")),
                       F.array_join(F.transform(comments, lambda c: F.coalesce(c["body"], F.lit(""))), "\n"))
    url = F.concat(F.lit(web_base + "/"), F.col("repository"), F.lit(f"/{url_part}/"), F.col("number").cast("string"))
    number_field = "prNumber" if kind == "pull_request" else "issueNumber"
    sd = F.struct(F.lit(kind).alias("type"), F.col("number").alias(number_field), F.col("title").alias("title"),
                  F.col("state").alias("state"), F.col("repository").alias("repository"),
                  F.coalesce(F.col("created_at"), F.lit("")).alias("createdAt"),
                  F.lit("text/markdown").alias("mimeType"), url.alias("sourceUrl"),
                  extract_tickets(scan).alias("jiraTickets"),
                  _opt(df, "contributors", "array<string>").alias("contributors"))
    content = F.struct(F.lit("text/plain").alias("mime_type"), encode_text(text).alias("raw_bytes"))
    kept = df.filter((F.coalesce(F.col("id"), F.lit("")) != "")
                     & F.coalesce(F.col("number") != 0, F.lit(False))
                     & (F.coalesce(F.col("repository"), F.lit("")) != ""))
    return kept.select(sanitize_doc_id("id").alias("id"), F.col("repository"), sd.alias("struct_data"),
                       content.alias("content"), text.alias("text"),
                       _opt(df, "acl_info", "struct<readers:array<struct<idp_wide:boolean,principals:array<struct<user_id:string,group_id:string>>>>>").alias("acl_info"))


def project_pull_request_document(prs: DataFrame, web_base: str = "https://github.com") -> DataFrame:
    """Pull request -> document (tickets scan title + body + comments, not reviews)."""
    return _discussion_common(prs, "pull_request", "pull", web_base, with_reviews=True)


def project_issue_document(issues: DataFrame, web_base: str = "https://github.com") -> DataFrame:
    """Issue -> document (as P3 without reviews, url ``/issues/N``)."""
    return _discussion_common(issues, "issue", "issues", web_base, with_reviews=False)


def commit_text(sha: Column, name: Column, email: Column, date: Column, message: Column) -> Column:
    return F.concat_ws("\n",
                       F.concat(F.lit("COMMIT: "), sha),
                       F.concat(F.lit("Author: "), F.coalesce(name, F.lit("Unknown")), F.lit(" <"),
                                F.coalesce(F.nullif(email, F.lit("")), F.lit("Unknown")), F.lit(">")),
                       F.concat(F.lit("Date: "), F.coalesce(date, F.lit(""))),
                       F.lit(""), F.lit("--- Commit Message ---"), F.coalesce(message, F.lit("None")))


def project_commit_document(commits: DataFrame, web_base: str = "https://github.com") -> DataFrame:
    """P5: commit -> document: ``COMMIT:`` / ``Author: name <email>`` / ``Date:`` / message."""
    c = commits
    email = F.coalesce(F.nullif(_opt(c, "author_name_id"), F.lit("")), F.col("author")["email"])
    text = commit_text(F.col("sha"), F.col("author")["name"], email, F.col("committed_date"), F.col("message"))
    url = F.concat(F.lit(web_base + "/"), F.col("repository"), F.lit("/commit/"), F.col("sha"))
    sd = F.struct(F.lit("commit").alias("type"), F.col("sha").alias("sha"), F.col("repository").alias("repository"),
                  F.coalesce(F.col("committed_date"), F.lit("")).alias("committedDate"),
                  F.lit("text/plain").alias("mimeType"), url.alias("sourceUrl"),
                  extract_tickets(F.col("message")).alias("jiraTickets"),
                  _opt(c, "contributors", "array<string>").alias("contributors"))
    content = F.struct(F.lit("text/plain").alias("mime_type"), encode_text(text).alias("raw_bytes"))
    kept = c.filter((F.coalesce(F.col("id"), F.lit("")) != "") & (F.coalesce(F.col("sha"), F.lit("")) != "")
                    & (F.coalesce(F.col("repository"), F.lit("")) != ""))
    return kept.select(sanitize_doc_id("id").alias("id"), F.col("repository"), sd.alias("struct_data"),
                       content.alias("content"), text.alias("text"),
                       _opt(c, "acl_info", "struct<readers:array<struct<idp_wide:boolean,principals:array<struct<user_id:string,group_id:string>>>>>").alias("acl_info"))


def route_discussion(df: DataFrame, type_col: str = "type") -> DataFrame:
    """Keep known discussion kinds and rewrite the type (unknown kinds dropped)."""
    mapping = F.create_map(*[x for k, v in DISCUSSION_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return (df.withColumn("discussion_type", mapping[F.col(type_col)])
              .filter(F.col("discussion_type").isNotNull()))


def project_discussions(records: dict[str, DataFrame], web_base: str = "https://github.com") -> DataFrame:
    """Each kind of record (``pull_request``, ``issue``, ``commit``) goes to its own projection;
    other kinds are dropped.  ``contributors`` and ``acl_info`` are taken along where the records
    have them.  The payloads differ by kind, so ``struct_data`` comes as JSON beside the fields
    that all have."""
    project = {"pull_request": project_pull_request_document, "issue": project_issue_document, "commit": project_commit_document}
    out = None
    for kind, rows in records.items():
        if kind not in DISCUSSION_TYPES:
            continue
        docs = project[kind](rows, web_base)
        part = docs.select(
            "id", "repository", F.lit(DISCUSSION_TYPES[kind]).alias("discussion_type"),
            F.col("struct_data.sourceUrl").alias("url"), F.col("struct_data.jiraTickets").alias("tickets"),
            F.col("struct_data.contributors").alias("contributors"), F.to_json("struct_data").alias("struct_json"),
            "content", "text", "acl_info")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no known kind of discussion")
    return out


# ---------------------------------------------------------------- entity documents

def prop_value(df: DataFrame, name: str) -> Column:
    """P12 value coercion by type: string as is; bool -> True/False; number -> text;
    array/struct -> JSON.  NULL, empty text and empty arrays give NULL (skipped);
    ``0`` and ``false`` are kept."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    c, t = F.col(name), _dtype(df, name)
    if isinstance(t, T.StringType):
        v = c
    elif isinstance(t, T.BooleanType):
        v = F.when(c, F.lit("True")).when(~c, F.lit("False"))
    elif isinstance(t, (T.IntegralType, T.FractionalType, T.DecimalType)):
        v = c.cast("string")
    elif isinstance(t, T.ArrayType):
        v = F.when(F.size(c) > 0, F.to_json(c))
    elif isinstance(t, T.VariantType):  # the value's own type decides
        kind, text = F.schema_of_variant(c), F.try_variant_get(c, "$", "string")
        v = (F.when(kind == "BOOLEAN", F.initcap(text)).when(kind.startswith("ARRAY"), F.when(text != "[]", F.to_json(c)))
             .when(kind.startswith("OBJECT"), F.to_json(c)).otherwise(text))
    else:
        v = F.to_json(c)
    return F.when(v != "", v)


def json_prop(df: DataFrame, name: str) -> Column:
    """A property that is always JSON-encoded, present only when the value is truthy."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    c, t = F.col(name), _dtype(df, name)
    if isinstance(t, T.ArrayType):
        return F.when(F.size(c) > 0, F.to_json(c))
    if isinstance(t, T.VariantType):
        falsy = F.coalesce(F.try_variant_get(c, "$", "string"), F.lit("")).isin("", "[]", "{}", "0", "0.0", "false")
        return F.when(~falsy, F.to_json(c))
    if isinstance(t, T.StringType):
        # Columns of mixed type are landed as JSON text of lists and objects; plain text is encoded.
        quoted = F.to_json(F.array(c))
        return F.when(c != "", F.when(F.ltrim(c).rlike(r"^[\[{]"), c).otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2)))
    return F.to_json(c)


def custom_properties(pairs: Sequence[tuple[str, Column]]) -> Column:
    """``[{name, value}]`` with NULL/empty values removed, in declaration order."""
    # Lists of one or none, joined: unlike a filter with a lambda, this is compiled with all it holds.
    none = F.array().cast("array<struct<name:string,value:string>>")
    own = [(v.cast("string"), F.lit(n).alias("name")) for n, v in pairs]
    return F.flatten(F.array(*[F.when(v != "", F.array(F.struct(n, v.alias("value")))).otherwise(none) for v, n in own]))


def interactions(df: DataFrame) -> Column:
    """Counters as integers (missing -> 0), only when the struct is present."""
    if "interactions" not in df.columns:
        return F.lit(None).cast("struct<numLikes:bigint,numComments:bigint,numViews:bigint>")
    i = F.col("interactions")
    return F.when(i.isNotNull(), F.struct(
        *[F.coalesce(int_or_null(i[k]), F.lit(0)).cast("bigint").alias(k)
          for k in ("numLikes", "numComments", "numViews")]))


def _entity_props(df: DataFrame, entity: str) -> list[tuple[str, Column]]:
    pv = lambda n: prop_value(df, n)
    jp = lambda n: json_prop(df, n)
    if entity == "initiative":
        return [("startDate", pv("startDate")), ("endDate", pv("endDate")),
                ("programStatus", pv("programStatus")), ("primaryPillar", pv("primaryPillar")),
                ("activeQuarters", pv("activeQuarters")), ("linkedLaunchIds", pv("linkedLaunchIds")),
                ("linkedCommitmentIds", pv("linkedCommitmentIds")), ("hierarchyTeam", jp("hierarchyTeam")),
                ("statusLogsJSONString", jp("statusLogs")), ("linksJSONString", jp("links")),
                ("decisionsJSONString", jp("decisions")), ("risksJsonString", jp("risks")),
                ("resourcesJsonString", jp("resources"))]
    if entity == "commitment":
        return [("responsibleUser", pv("responsibleUser")), ("accountableUser", pv("accountableUser")),
                ("quarter", pv("quarter")), ("pillar", pv("pillar")),
                ("commitmentStatus", pv("commitmentStatus")), ("isClosedOut", pv("isClosedOut")),
                ("statusHistoryJsonString", jp("statusHistory"))]
    if entity == "launch":
        ids = _opt(df, "commitmentIds", "array<string>")
        prefixed = F.when(F.size(ids) > 0, F.to_json(F.transform(ids, lambda x: prefix_id("commitment", x))))
        link_texts = F.lit(None).cast("string")
        if "links" in df.columns:
            link_type = _dtype(df, "links")
            mixed = isinstance(link_type, T.VariantType)
            links = F.try_variant_get("links", "$", "array<variant>") if mixed else F.col("links")
            if isinstance(link_type, T.ArrayType) and isinstance(link_type.elementType, T.StringType):
                as_text = lambda x: F.to_json(F.array(x)).substr(F.lit(2), F.length(F.to_json(F.array(x))) - 2)
            else:
                as_text = lambda x: F.to_json(x)  # noqa: E731  (one-argument lambda for transform)
            # Each link is JSON-encoded, then the list of those strings is encoded again.
            link_texts = F.when(F.size(links) > 0, F.to_json(F.transform(links, as_text)))
        return [("launchDate", pv("launchDate")), ("committedQuarter", pv("committedQuarter")),
                ("platforms", pv("platforms")), ("productSurfaces", pv("productSurfaces")),
                ("pillars", pv("pillars")), ("reviewsJsonString", jp("reviews")),
                ("commitmentID", prefixed), ("links", link_texts),
                ("statusLogsJsonString", jp("statusLogs"))]
    if entity == "person":
        pos = _opt(df, "positionId")
        pos_int = int_or_null(pos)
        pos_v = F.when(F.coalesce(pos_int, F.lit(0)) != 0, pos_int.cast("string")).otherwise(pos.cast("string"))
        return [("managerEmail", pv("managerEmail")), ("directorEmail", pv("directorEmail")),
                ("executiveEmail", pv("executiveEmail")), ("function", pv("function")),
                ("specialties", pv("specialties")), ("pillar", pv("pillar")), ("email", pv("email")),
                ("displayName", pv("displayName")), ("positionId", F.when(pos_v != "", pos_v)),
                ("positionStatus", pv("positionStatus")), ("employeeId", pv("employeeId")),
                ("level", pv("level")), ("hierarchyTeam", pv("hierarchyTeam")),
                ("assignedToTeam", pv("assignedToTeam"))]
    raise ValueError(f"no projection for entity type {entity!r}")


def iso_dates(df: DataFrame) -> DataFrame:
    """C6 over a frame: dates and timestamps become ISO text before anything is projected."""
    return df.select(*[iso_deep(f.name, f.dataType).alias(f.name) if has_dates(f.dataType) else F.col(f.name) for f in df.schema])


def build_envelope(df: DataFrame, entity_types: Sequence[str], doc_id: Column) -> Column:
    """The payload of all entity types.  What they share is built once; only what differs
    (object type, URL path, author rule, permissions, properties) is a CASE on the type.
    ``title`` defaults to empty only when the column is absent (an explicit NULL stays NULL);
    description NULL -> empty."""
    et = F.col("entityType")

    def lookup(mapping):
        return F.create_map(*[x for e in entity_types for x in (F.lit(e), F.lit(mapping[e]))])[et]

    properties = None
    for e in entity_types:
        own = custom_properties(_entity_props(df, e))
        properties = F.when(et == e, own) if properties is None else properties.when(et == e, own)
    raw_id = F.col("id").cast("string")
    is_person = et == "person"
    tail = F.when(is_person, F.coalesce(_opt(df, "employeeId"), F.lit(""))).otherwise(F.coalesce(raw_id, F.lit("None")))
    view_url = F.coalesce(F.nullif(_opt(df, "url"), F.lit("")),
                          F.concat(F.lit(ENTITY_URL_BASE), lookup(ENTITY_URL_PATHS), tail))
    owner = F.nullif(_opt(df, "ownerEmail"), F.lit(""))
    own_email = F.when(is_person, F.nullif(_opt(df, "email"), F.lit("")))
    author = F.coalesce(own_email, owner, F.lit(INTERNAL_AUTHOR_FALLBACK))
    title = F.col("title") if "title" in df.columns else F.lit("")
    perms = F.when(is_person, F.struct(F.lit(True).alias("allowAnonymousAccess"),
                                       F.lit(None).cast("array<struct<email:string>>").alias("allowedUsers"),
                                       F.lit(None).cast("array<struct<id:string>>").alias("allowedGroups"))) \
        .otherwise(permissions_block(_opt(df, "private", "boolean"), _opt(df, "allowedUsers", "array<string>"),
                                     _opt(df, "allowedGroups", "array<string>")))
    return F.struct(
        F.lit(ENTITY_DATASOURCE).alias("datasource"), lookup(ENTITY_OBJECT_TYPES).alias("objectType"),
        doc_id.alias("id"), title.cast("string").alias("title"),
        F.struct(F.lit("text/plain").alias("mimeType"),
                 F.coalesce(_opt(df, "description"), F.lit("")).alias("textContent")).alias("body"),
        view_url.alias("viewURL"),
        int_or_null(_opt(df, "createdAt")).alias("createdAt"), int_or_null(_opt(df, "updatedAt")).alias("updatedAt"),
        perms.alias("permissions"), F.struct(author.alias("email")).alias("author"),
        properties.alias("customProperties"), interactions(df).alias("interactions"))


def finalize_documents(projected: DataFrame, with_json: bool = False) -> DataFrame:
    """No ACL -> no document.  ``with_json`` adds the serialised payload; leave it
    to the sink so dedupe and joins do not carry the JSON text."""
    kept = projected.filter(F.col("acl_info").isNotNull())
    return kept.withColumn("json_data", F.to_json("envelope")) if with_json else kept


def project_entities(rows: DataFrame, entity_types: Sequence[str] = tuple(ENTITY_OBJECT_TYPES)) -> DataFrame:
    """P8-P11 dispatch on ``entityType`` in a single pass over the input: dates to ISO text (C6),
    then id, payload (P7) and ACL."""
    et = F.col("entityType")
    df = iso_dates(rows.filter(et.isin(*entity_types)))
    doc_id = F.concat(et, F.lit("-"), F.coalesce(F.col("id").cast("string"), F.lit("None")))
    acl = F.when(et == "person", public_acl()).otherwise(
        acl_from_row(_opt(df, "private", "boolean"), _opt(df, "allowedUsers", "array<string>"),
                     _opt(df, "allowedGroups", "array<string>"), _opt(df, "ownerEmail")))
    keep = [c for c in df.columns if c.startswith("_")]
    return df.select(sanitize_doc_id(doc_id).alias("id"), et.alias("entityType"),
                     build_envelope(df, entity_types, doc_id).alias("envelope"), acl.alias("acl_info"), *keep)


# ---------------------------------------------------------------- P15

def chain_transforms(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply projections in order; each step may drop rows (NULL = filtered).
    An empty chain produces no documents, as in the reference."""
    if not steps:
        return df.limit(0)
    for step in steps:
        df = df.transform(step)
    return df

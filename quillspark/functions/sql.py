"""The library's functions in SQL text (survey C1-C17 for S3).

``register_functions`` makes them temporary functions of a session, so that a raw query (S3) can use
them.  Each is a SQL expression that Spark puts in place of the call: nothing leaves the JVM, and
filters over them are planned like any others.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quillspark.functions import scalars as S
from quillspark.functions.acl import PUBLIC_MARKERS
from quillspark.sources.tables import UNSINGULARIZED_TABLES

_PRINCIPAL = "STRUCT<user_id: STRING, group_id: STRING>"
_ACL = f"STRUCT<readers: ARRAY<STRUCT<idp_wide: BOOLEAN, principals: ARRAY<{_PRINCIPAL}>>>>"
_MARKERS = ", ".join(f"'{m}'" for m in PUBLIC_MARKERS)
_PUBLIC = f"named_struct('readers', array(named_struct('idp_wide', true, 'principals', CAST(array() AS ARRAY<{_PRINCIPAL}>))))"
_GRANTED = "named_struct('readers', array(named_struct('idp_wide', false, 'principals', {0})))"
_USER = f"CAST(named_struct('user_id', {{0}}, 'group_id', NULL) AS {_PRINCIPAL})"
_GROUP = f"CAST(named_struct('user_id', NULL, 'group_id', {{0}}) AS {_PRINCIPAL})"
_LISTED = f"concat(transform(coalesce(users, array()), u -> {_USER.format('u')}), transform(coalesce(grps, array()), g -> {_GROUP.format('g')}))"
_PERMISSIONS = "ARRAY<STRUCT<email: STRING, type: STRING>>"
_ITEM = "createdAt: STRING, body: STRING, author: STRUCT<login: STRING>"


def _text(value: str) -> str:
    """A string literal of SQL, backslashes taken as they are."""
    return "r'" + value + "'"


#: name -> (arguments, result type, expression)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "sanitize_doc_id": ("id STRING", "STRING", f"regexp_replace(id, {_text(S.DOC_ID_INVALID_CHARS)}, '_')"),
    "extract_tickets": ("body STRING", "ARRAY<STRING>",
                        f"coalesce(array_sort(array_distinct(regexp_extract_all(body, {_text(S.TICKET_PATTERN)}, 1))), CAST(array() AS ARRAY<STRING>))"),
    "web_base_url": ("url STRING", "STRING",
                     f"CASE WHEN contains(url, '{S.PUBLIC_WEB_HOST_MARKER}') THEN '{S.PUBLIC_WEB_BASE}' ELSE regexp_replace(url, {_text(S.ENTERPRISE_API_SUFFIX)}, '') END"),
    "int_or_null": ("value STRING", "BIGINT", "try_cast(value AS BIGINT)"),
    "prefix_id": ("prefix STRING, id STRING", "STRING",
                  "CASE WHEN startswith(id, concat(prefix, '-')) THEN id ELSE concat(prefix, '-', id) END"),
    "iso_datetime": ("ts TIMESTAMP", "STRING",
                     "date_format(ts, CASE WHEN unix_micros(ts) % 1000000 = 0 THEN \"yyyy-MM-dd'T'HH:mm:ss\" ELSE \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\" END)"),
    "iso_date": ("day DATE", "STRING", "date_format(day, 'yyyy-MM-dd')"),
    "json_text": ("value VARIANT", "STRING", "to_json(value)"),
    "base64_decode": ("value STRING", "BINARY", "try_to_binary(value, 'base64')"),
    "base64_encode": ("value BINARY", "STRING", "base64(value)"),
    "encode_text": ("value STRING", "BINARY", "encode(value, 'UTF-8')"),
    "decode_text": ("value BINARY", "STRING", "make_valid_utf8(CAST(value AS STRING))"),
    "acl_from_principals": (f"principals ARRAY<{_PRINCIPAL}>", _ACL,
                            f"CASE WHEN principals IS NULL OR size(principals) = 0 THEN NULL WHEN exists(principals, p -> coalesce(p.user_id IN ({_MARKERS}), false))"
                            f" THEN {_PUBLIC} ELSE {_GRANTED.format('principals')} END"),
    "permissions_to_principals": (f"permissions {_PERMISSIONS}", f"ARRAY<{_PRINCIPAL}>",
                                  f"transform(filter(coalesce(permissions, array()), p -> coalesce(p.email, '') <> ''), p ->"
                                  f" CASE WHEN upper(coalesce(p.type, 'USER')) = 'GROUP' THEN {_GROUP.format('p.email')} ELSE {_USER.format('p.email')} END)"),
    "acl_from_permissions": (f"permissions {_PERMISSIONS}", _ACL,
                             f"CASE WHEN size(permissions_to_principals(permissions)) = 0 THEN NULL"
                             f" WHEN exists(permissions_to_principals(permissions), p -> coalesce(p.user_id IN ({_MARKERS}), false) OR coalesce(p.group_id IN ({_MARKERS}), false))"
                             f" THEN {_PUBLIC} ELSE {_GRANTED.format('permissions_to_principals(permissions)')} END"),
    "row_principals": ("users ARRAY<STRING>, grps ARRAY<STRING>, owner STRING", f"ARRAY<{_PRINCIPAL}>",
                       f"CASE WHEN size({_LISTED}) = 0 AND coalesce(owner, '') <> '' THEN array({_USER.format('owner')}) ELSE {_LISTED} END"),
    "acl_from_row": ("private BOOLEAN, users ARRAY<STRING>, grps ARRAY<STRING>, owner STRING", _ACL,
                     f"CASE WHEN NOT coalesce(private, false) THEN {_PUBLIC} WHEN size(row_principals(users, grps, owner)) > 0"
                     f" THEN {_GRANTED.format('row_principals(users, grps, owner)')} END"),
    "permissions_block": ("private BOOLEAN, users ARRAY<STRING>, grps ARRAY<STRING>",
                          "STRUCT<allowAnonymousAccess: BOOLEAN, allowedUsers: ARRAY<STRUCT<email: STRING>>, allowedGroups: ARRAY<STRUCT<id: STRING>>>",
                          "named_struct('allowAnonymousAccess', NOT coalesce(private, false),"
                          " 'allowedUsers', CASE WHEN private AND size(users) > 0 THEN transform(users, u -> named_struct('email', u)) END,"
                          " 'allowedGroups', CASE WHEN private AND size(grps) > 0 THEN transform(grps, g -> named_struct('id', g)) END)"),
    "acl_summary": (f"acl {_ACL}", "STRING",
                    "CASE WHEN acl IS NULL THEN NULL WHEN coalesce(get(acl.readers, 0).idp_wide, false) THEN 'PUBLIC' ELSE"
                    " array_join(transform(get(acl.readers, 0).principals, p -> coalesce(concat('user:', p.user_id), concat('group:', p.group_id))), ',') END"),
    "author_email": ("name_id STRING, email STRING", "STRING", "coalesce(nullif(name_id, ''), email)"),
    "author_display": ("email STRING, login STRING", "STRING", "coalesce(nullif(email, ''), login, 'Unknown')"),
    "thread_lines": (f"items ARRAY<STRUCT<{_ITEM}>>", "ARRAY<STRING>",
                     "transform(coalesce(items, array()), i -> concat('- [', coalesce(i.createdAt, ''), '] ', coalesce(i.author.login, 'anonymous'), ': ', coalesce(i.body, '')))"),
    "review_lines": (f"items ARRAY<STRUCT<{_ITEM}, state: STRING>>", "ARRAY<STRING>",
                     "transform(coalesce(items, array()), i -> concat('- [', coalesce(i.createdAt, ''), '] ', coalesce(i.author.login, 'anonymous'), ' (', coalesce(i.state, ''), '): ', coalesce(i.body, '')))"),
    "basename": ("path STRING", "STRING", "element_at(split(path, '/'), -1)"),
    "repo_owner": ("full_name STRING", "STRING", "substring_index(full_name, '/', 1)"),
    "repo_name": ("full_name STRING", "STRING", r"regexp_extract(full_name, r'^[^/]*/(.*)$', 1)"),
    "config_hash": ("config STRING", "STRING", "substring(sha2(config, 256), 1, 16)"),
    "singularize": ("name STRING", "STRING",
                    "CASE WHEN endswith(name, 'ies') AND length(name) > 3 THEN regexp_replace(name, 'ies$', 'y')"
                    " WHEN endswith(name, 'ses') AND length(name) > 3 THEN regexp_replace(name, 'ses$', 's')"
                    " WHEN endswith(name, 's') AND length(name) > 1 THEN regexp_replace(name, 's$', '') ELSE name END"),
    "entity_type_for_table": ("name STRING", "STRING",
                              f"CASE WHEN name IN ({', '.join(repr(t) for t in UNSINGULARIZED_TABLES)}) THEN name ELSE singularize(name) END"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make every function of ``FUNCTIONS`` a temporary function of the session; returns their names.
    Made again, they are replaced."""
    for name, (arguments, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)

"""Scalar column functions (survey C1-C9, C14-C17).

All are built-in Catalyst expressions, so they stay inside whole-stage codegen;
none needs a Python UDF.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's.
DOC_ID_INVALID_CHARS = r"[^a-zA-Z0-9_-]"
TICKET_PATTERN = r"\b([A-Z][A-Z0-9]{1,9}-\d+)\b"
PUBLIC_WEB_HOST_MARKER = "api.github.com"
PUBLIC_WEB_BASE = "https://github.com"
ENTERPRISE_API_SUFFIX = r"/api/v3/?$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sanitize_doc_id(col) -> Column:
    """Every character outside ``[a-zA-Z0-9-_]`` becomes ``_``."""
    return F.regexp_replace(_c(col).cast("string"), DOC_ID_INVALID_CHARS, "_")


def extract_tickets(text) -> Column:
    """Distinct, sorted ticket keys such as ``ABC-12``; null/empty text -> []."""
    found = F.regexp_extract_all(_c(text), F.lit(TICKET_PATTERN), 1)
    return F.coalesce(F.array_sort(F.array_distinct(found)), F.array().cast("array<string>"))


def web_base_url(api_url) -> Column:
    """API base URL -> web UI base URL."""
    u = _c(api_url)
    return F.when(u.contains(PUBLIC_WEB_HOST_MARKER), F.lit(PUBLIC_WEB_BASE)).otherwise(
        F.regexp_replace(u, ENTERPRISE_API_SUFFIX, ""))


def int_or_null(col) -> Column:
    """C4: integer value or NULL (strings that are not integers give NULL)."""
    return _c(col).try_cast("bigint")


def prefix_id(prefix: str, col) -> Column:
    """Add ``prefix-`` unless the value already starts with it (idempotent)."""
    s = _c(col).cast("string")
    return F.when(s.startswith(f"{prefix}-"), s).otherwise(F.concat(F.lit(f"{prefix}-"), s))


def iso_datetime(col) -> Column:
    """Timestamp -> ISO-8601 text; fraction only when non-zero (Python isoformat)."""
    ts = _c(col)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(ts.isNull(), F.lit(None).cast("string")).when(
        F.unix_micros(ts.cast("timestamp")) % 1_000_000 == 0, whole).otherwise(frac)


def iso_date(col) -> Column:
    """C6 for DATE values."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def iso_deep(col, dtype: T.DataType) -> Column:
    """C6 at any depth: every date and timestamp inside structs, arrays and map values as
    ISO text; other values as they are, and a NULL stays NULL."""
    c = _c(col)
    if isinstance(dtype, T.DateType):
        return iso_date(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_datetime(c)
    if not has_dates(dtype):
        return c
    if isinstance(dtype, T.StructType):
        fields = [iso_deep(c[f.name], f.dataType).alias(f.name) for f in dtype]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: iso_deep(x, dtype.elementType))
    return F.transform_values(c, lambda k, v: iso_deep(v, dtype.valueType))


def has_dates(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(has_dates(f.dataType) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return has_dates(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return has_dates(dtype.valueType)
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def json_text(col) -> Column:
    """JSON text of a value (compact form; compare parsed, not byte-wise)."""
    return F.to_json(_c(col))


def base64_decode(col) -> Column:
    """Lenient base64 decode; malformed input gives NULL instead of failing."""
    return F.try_to_binary(_c(col), F.lit("base64"))


def base64_encode(col) -> Column:
    return F.base64(_c(col))


def encode_text(col) -> Column:
    """Text -> UTF-8 bytes."""
    return F.encode(_c(col), "UTF-8")


def decode_text(col) -> Column:
    """UTF-8 bytes -> text, malformed sequences replaced by U+FFFD."""
    return F.make_valid_utf8(_c(col).cast("string"))


def author_email(name_id, email) -> Column:
    """C14: nested SSO name id if present, else the profile e-mail."""
    return F.coalesce(F.nullif(_c(name_id), F.lit("")), _c(email))


def author_display(email, login) -> Column:
    """C14: display falls back to login, then ``Unknown``."""
    return F.coalesce(F.nullif(_c(email), F.lit("")), _c(login), F.lit("Unknown"))


def thread_lines(items, with_state: bool = False) -> Column:
    """``- [createdAt] login: body`` (reviews: ``login (state): body``).

    ``items`` is an array of structs with fields createdAt, body, author.login
    (and state for reviews).  Null login becomes ``anonymous``; null body/date empty.
    """
    def line(c):
        head = [F.lit("- ["), F.coalesce(c["createdAt"], F.lit("")), F.lit("] "),
                F.coalesce(c["author"]["login"], F.lit("anonymous"))]
        if with_state:
            head += [F.lit(" ("), F.coalesce(c["state"], F.lit("")), F.lit(")")]
        return F.concat(*head, F.lit(": "), F.coalesce(c["body"], F.lit("")))
    return F.transform(F.coalesce(_c(items), F.array()), line)


def basename(path) -> Column:
    """Last path segment."""
    return F.element_at(F.split(_c(path), "/"), -1)


def repo_owner(full_name) -> Column:
    """Owner part of ``owner/name`` (split at the first ``/``)."""
    return F.substring_index(_c(full_name), "/", 1)


def repo_name(full_name) -> Column:
    """Name part of ``owner/name`` (everything after the first ``/``)."""
    return F.regexp_extract(_c(full_name), r"^[^/]*/(.*)$", 1)


def sorted_json(fields: dict) -> Column:
    """JSON text of an object with its keys in order, whatever order they are given in, and
    the separators ``", "`` and ``": "``."""
    def value(c) -> Column:
        text = F.to_json(F.struct(_c(c).alias("v")), {"ignoreNullFields": "false"})
        return F.substring(text, F.lit(6), F.length(text) - 6)  # without {"v": and }

    members = [F.concat(F.lit(json.dumps(k) + ": "), value(fields[k])) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


def config_hash(text) -> Column:
    """C17: first 16 hex digits of SHA-256 of the configuration's JSON with sorted keys."""
    return F.substring(F.sha2(_c(text), 256), 1, 16)


def singularize(name) -> Column:
    """S4 helper: ``ies``->``y``, ``ses``->``s``, ``s``->'' in that order, only when
    the word is longer than the suffix."""
    n = _c(name)
    return (F.when(n.endswith("ies") & (F.length(n) > 3), F.regexp_replace(n, "ies$", "y"))
            .when(n.endswith("ses") & (F.length(n) > 3), F.regexp_replace(n, "ses$", "s"))
            .when(n.endswith("s") & (F.length(n) > 1), F.regexp_replace(n, "s$", ""))
            .otherwise(n))

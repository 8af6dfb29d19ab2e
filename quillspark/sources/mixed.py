"""Records whose fields change type (survey S1, S5, §1.3).

A record is landed as JSON text and kept as one VARIANT.  Keys that every entity has, and whose type
the operators rely on, become columns of that type, whatever scalar the record holds; all other keys
of the entity types stay VARIANT columns, so a list in one record and a text in the next are both
kept as they are and the projections (P8-P13) decide by the value's own type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.project import ENTITY_KEYS

#: Keys read as text and as whole numbers, whichever scalar type a record gives them.
TEXT_KEYS = ["entityType", "action", "id", "title", "description", "url", "ownerEmail", "email", "employeeId", "positionId"]
NUMBER_KEYS = ["createdAt", "updatedAt"]
LIST_KEYS = ["allowedUsers", "allowedGroups", "commitmentIds"]
COUNTERS = ["numLikes", "numComments", "numViews"]


def parse_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """``lines`` with ``_raw`` (VARIANT) in place of the text, and ``_corrupt_record``: the text of a
    line that is no JSON object, else NULL.

    The text is parsed in a generator of one row, below which Spark moves no filter: as a plain
    expression it would be parsed anew for each mention of a key in the filters that follow."""
    text = F.col(col)
    parsed = F.when(F.ltrim(text, F.lit(" \t\r\n")).startswith("{"), F.try_parse_json(text))
    kept = [F.col(c) for c in lines.columns if c != col]
    once = lines.select(*kept, F.inline(F.array(F.struct(parsed.alias("_raw"), text.alias("_text")))))
    return once.select(*kept, "_raw", F.when(F.col("_raw").isNull(), F.col("_text")).alias("_corrupt_record"))


def value_at(raw: Column, key: str, dtype: str) -> Column:
    """A key's value as ``dtype``, NULL where it is absent, null or can't be one."""
    return F.try_variant_get(raw, f"$.{key}", dtype)


def truth_of(found: Column) -> Column:
    """Whether a VARIANT counts as true: as the sources' own language has it, any text but the empty
    one (so the text ``false`` too), any number but 0, any list or object but the empty one."""
    text = F.try_variant_get(found, "$", "string")
    kind = F.schema_of_variant(found)
    number = F.coalesce(F.try_variant_get(found, "$", "double") != 0, F.lit(True))
    truth = F.when(kind == "BOOLEAN", F.try_variant_get(found, "$", "boolean")).when(kind == "STRING", text != "") \
        .when(kind.startswith("ARRAY"), text != "[]").when(kind.startswith("OBJECT"), text != "{}").otherwise(number)
    return F.coalesce(truth, F.lit(False)) & F.coalesce(kind != "VOID", F.lit(False))


def list_of(found: Column) -> Column:
    """A list of texts: a list's elements (numbers as text), or a single scalar as its only element."""
    many = F.try_variant_get(found, "$", "array<string>")
    one = F.try_variant_get(found, "$", "string")
    return F.when(many.isNotNull(), many).when(one.isNotNull() & (one != ""), F.array(one)).otherwise(F.array().cast("array<string>"))


def entity_columns(records: DataFrame, raw: str = "_raw") -> DataFrame:
    """The columns that ``project_entities`` reads, from ``_raw``; underscore columns are kept.

    A record is taken apart in one cast to a struct, whose fields are NULL where a key is absent or
    can't be of the type; a look-up for each of the keys, most of which a record has not, takes
    several times as long.  Both steps are generators for the reason that
    ``parse_records`` has one."""
    keys = dict.fromkeys(k for own in ENTITY_KEYS.values() for k in own)
    types = {k: "string" for k in TEXT_KEYS} | {k: "bigint" for k in NUMBER_KEYS}
    types |= {k: "variant" for k in [*LIST_KEYS, "private", "interactions", *keys] if k not in types}
    kept = [F.col(c) for c in records.columns if c.startswith("_") and c != raw]
    fields = F.try_variant_get(F.col(raw), "$", f"struct<{', '.join(f'{k}: {t}' for k, t in types.items())}>")
    found = records.select(*kept, F.inline(F.array(fields)))
    counters = F.try_variant_get(F.col("interactions"), "$", f"struct<{', '.join(f'{k}: bigint' for k in COUNTERS)}>")
    typed = {k: list_of(F.col(k)) for k in LIST_KEYS} | {"private": truth_of(F.col("private"))}
    typed["interactions"] = F.when(truth_of(F.col("interactions")), F.struct(*[counters[k].alias(k) for k in COUNTERS]))
    plain = [F.col(k) for k in types if k not in typed]
    once = found.select(*plain, *kept, F.inline(F.array(F.struct(*[c.alias(k) for k, c in typed.items()]))))
    return once.select(*types, *kept)

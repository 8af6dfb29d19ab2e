"""Run metrics, breakdowns, drift and other aggregates (survey A1-A11).

Every aggregate here is a ``groupBy().agg()`` of built-in functions, planned as
partial (map-side) + final aggregation, so a hot group is combined before the
shuffle.  Collected lists hold the distinct values that one document carries.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.ordering import newest_n_per_key
from quillspark.schemas import COMMON_ENTITY_KEYS

STATUSES = ("transformed", "failed", "skipped")


def _count_status(status: str) -> Column:
    return F.count_if(F.col("status") == status).cast("bigint")


def run_metrics(outcomes: DataFrame, extra_failures: DataFrame | None = None) -> DataFrame:
    """A1: fetched = transformed + failed + skipped; uploaded = transformed rows handed
    to the sink.  ``extra_failures`` (non-record errors) add to ``failed`` only."""
    m = outcomes.agg(
        F.count(F.lit(1)).cast("bigint").alias("fetched"),
        _count_status("transformed").alias("transformed"),
        _count_status("failed").alias("failed"),
        _count_status("skipped").alias("skipped"),
        _count_status("transformed").alias("uploaded"),
    )
    if extra_failures is not None:
        extra = extra_failures.agg(F.count(F.lit(1)).cast("bigint")).scalar()  # scalar subquery
        m = m.withColumn("failed", F.col("failed") + extra)
    return m


def breakdown_key(repo_col: str | None = "repository", source_col: str | None = "source") -> Column:
    parts = []
    for c in (repo_col, source_col):
        if c is not None:
            parts.append(F.nullif(F.col(c).cast("string"), F.lit("")))
    return F.coalesce(*parts, F.lit("default"))


def source_breakdown(outcomes: DataFrame, repo_col: str | None = None, source_col: str | None = "source") -> DataFrame:
    """A2: the A1 counters per repository, else source, else ``default``."""
    return (outcomes.withColumn("source_key", breakdown_key(repo_col, source_col))
            .groupBy("source_key")
            .agg(F.count(F.lit(1)).cast("bigint").alias("fetched"),
                 _count_status("transformed").alias("transformed"),
                 _count_status("failed").alias("failed"),
                 _count_status("transformed").alias("uploaded")))


def error_table(failed: DataFrame, component: str) -> DataFrame:
    """A3: one row per failure; item id = id, else doc_id, else ``unknown``."""
    ids = [F.col(c).cast("string") for c in ("id", "doc_id") if c in failed.columns]
    return failed.select(
        F.lit(component).alias("component"),
        F.coalesce(*ids, F.lit("unknown")).alias("item_id"),
        F.coalesce(F.col("error_type"), F.lit("Error")).alias("error_type") if "error_type" in failed.columns
        else F.lit("Error").alias("error_type"),
        F.col("message").cast("string").alias("message") if "message" in failed.columns
        else F.lit("").alias("message"),
    )


def contributor_rows(commits: DataFrame, window: int | None = None, order: list | None = None) -> DataFrame:
    """A4 as rows: the distinct (repository, email) pairs with an ``@`` in the e-mail, over the
    whole history (``window=None``) or the newest ``window`` commits, ``order`` giving newest
    first (default: ``pos`` ascending, pos 1 = newest).  A distinct has a map-side step, so a
    repository with a third of all commits is no hot key."""
    if window is not None:
        commits = newest_n_per_key(commits, "repository", order or [F.col("pos").asc()], window, pos_col="_cwpos")
    usable = commits.filter(F.coalesce(F.col("email").contains("@"), F.lit(False)))
    return usable.select("repository", "email").distinct()


def repo_contributors(commits: DataFrame, window: int | None = None, order: list | None = None) -> DataFrame:
    """A4: ``contributor_rows`` as one sorted list per repository, the shape of a document's
    field; it holds each person once, however many commits they made."""
    return (contributor_rows(commits, window, order).groupBy("repository")
            .agg(F.array_sort(F.collect_list("email")).alias("contributors")))


def next_checkpoint(emitted: DataFrame, key: str = "repository", updated_col: str = "updated_at") -> DataFrame:
    """Newest ``updated_at`` per key, the next run's checkpoint."""
    return emitted.groupBy(key).agg(F.max(updated_col).alias("last_sync"))


# Spark variant type names -> the reference's Python type names.
_VARIANT_TYPE_NAMES = [
    ("STRING", "str"), ("BOOLEAN", "bool"), ("BIGINT", "int"), ("INT", "int"), ("SMALLINT", "int"),
    ("TINYINT", "int"), ("DOUBLE", "float"), ("FLOAT", "float"), ("DECIMAL", "float"),
    ("ARRAY", "list"), ("OBJECT", "dict"),
]


def _python_type_name(schema_text: Column) -> Column:
    expr = None
    for prefix, name in _VARIANT_TYPE_NAMES:
        cond = schema_text.startswith(prefix)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lower(schema_text))


def schema_drift(rows: DataFrame, expected: Mapping[str, Sequence[str]], raw_col: str = "_raw",
                 entity_col: str = "entityType") -> DataFrame:
    """Distinct (entity, key, value type) for keys that are not expected for the
    entity and whose value is not NULL / empty text / empty list.  Keys are read from
    each row's record, JSON text or VARIANT (only keys present can be seen).  Expected
    keys are configuration, a few dozen names: a filter drops them before any value's
    type is told, and what remains is combined before the shuffle."""
    raw, entity, members = F.col(raw_col), F.col(entity_col), "map<string,variant>"
    if isinstance(rows.schema[raw_col].dataType, T.VariantType):
        found = F.try_variant_get(raw, "$", members)
    else:
        found = F.from_json(raw, members)
    pairs = rows.select(entity.alias("entity"), F.explode(found).alias("key", "value"))
    ent, key = F.col("entity"), F.col("key")
    known = F.lit(False)
    for e, ks in expected.items():
        known = known | ((ent == e) & key.isin(*COMMON_ENTITY_KEYS, *ks))
    vt = F.schema_of_variant(F.col("value"))
    text = F.variant_get(F.col("value"), "$", "string")
    keep = (F.col("value").isNotNull() & (vt != "VOID")
            & ~((vt == "STRING") & (text == ""))
            & ~(vt.startswith("ARRAY") & (text == "[]")))
    drift = pairs.filter(~F.coalesce(known, F.lit(False))).filter(keep)
    return drift.select("entity", "key", _python_type_name(vt).alias("value_type")).distinct()


_SPARK_TYPE_NAMES = [
    (T.StringType, "str"), (T.BooleanType, "bool"), (T.IntegralType, "int"), (T.FractionalType, "float"),
    (T.DecimalType, "float"), (T.ArrayType, "list"), (T.StructType, "dict"), (T.MapType, "dict"),
]


def _type_name(dt) -> str:
    for cls, name in _SPARK_TYPE_NAMES:
        if isinstance(dt, cls):
            return name
    return dt.simpleString()


def schema_drift_typed(rows: DataFrame, expected: Mapping[str, Sequence[str]],
                       entity_col: str = "entityType") -> DataFrame:
    """A7 for typed (landed) frames: per entity type, columns that are not expected for
    it and hold a non-empty value in at least one row.  One aggregation with a
    presence flag per column (partial aggregation, one row per entity type), then an
    unpivot to (entity, key, value_type)."""
    common = set(COMMON_ENTITY_KEYS)
    cols = [f for f in rows.schema.fields
            if f.name not in common and f.name != entity_col and not f.name.startswith("_")]
    if not cols:
        return rows.sparkSession.createDataFrame([], "entity string, key string, value_type string")

    def present(f) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            return c.isNotNull() & (c != "")
        if isinstance(f.dataType, (T.ArrayType, T.MapType)):
            return c.isNotNull() & (F.size(c) > 0)
        return c.isNotNull()

    ent = F.col(entity_col)
    flags = []
    for f in cols:
        allowed = [e for e, ks in expected.items() if f.name in ks]
        unexpected = ~ent.isin(*allowed) if allowed else F.lit(True)
        flags.append(F.max((present(f) & unexpected).cast("int")).alias(f.name))
    per_entity = rows.groupBy(ent.alias("entity")).agg(*flags)
    stacked = F.explode(F.array(*[F.struct(F.lit(f.name).alias("key"), F.lit(_type_name(f.dataType)).alias("value_type"),
                                           F.col(f.name).alias("flag")) for f in cols])).alias("kv")
    return (per_entity.select("entity", stacked)
            .filter(F.col("kv.flag") == 1)
            .select("entity", F.col("kv.key").alias("key"), F.col("kv.value_type").alias("value_type")))


def unmapped_entities(rows: DataFrame, known: Sequence[str], col: str = "entityType") -> DataFrame:
    """Distinct non-empty entity types that have no projection."""
    return (rows.filter(F.coalesce(F.col(col), F.lit("")) != "")
            .filter(~F.col(col).isin(*known)).select(F.col(col).alias("entity_type")).distinct())


def run_report(metrics: DataFrame, breakdown: DataFrame, errors: DataFrame, run_id: str, name: str,
               started: str, ended: str) -> DataFrame:
    """One row with run id, name, times, success, metrics map, error count and the
    number of sources.  The per-source breakdown stays its own frame (A2): the number of
    sources is unbounded, so it is never folded into a single row."""
    err = errors.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    n_src = breakdown.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    m = metrics.select(F.create_map(*[x for c in metrics.columns for x in (F.lit(c), F.col(c))]).alias("metrics"))
    return m.select(F.lit(run_id).alias("run_id"), F.lit(name).alias("name"),
                    F.lit(started).alias("start_time"), F.lit(ended).alias("end_time"),
                    (err == 0).alias("success"), "metrics", err.alias("error_count"), n_src.alias("n_sources"))


def report_line(report: DataFrame) -> DataFrame:
    """A9 as it is logged: one JSON object on one line."""
    return report.select(F.to_json(F.struct("*")).alias("line"))


def skip_reasons(rejected: DataFrame, reason_col: str = "reason", entity_col: str = "entityType") -> DataFrame:
    """Counts of rows not emitted, by reason and entity type."""
    return rejected.groupBy(reason_col, entity_col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def referenced_users(docs: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """A10: distinct author e-mails and allowed users of synced documents as user
    records ``{email, userId = email, name, isActive}`` (name/isActive from ``users``)."""
    env = F.col("envelope")
    emails = F.array_union(F.array(env["author"]["email"]),
                           F.coalesce(F.transform(env["permissions"]["allowedUsers"], lambda u: u["email"]),
                                      F.array().cast("array<string>")))
    refs = docs.select(F.explode(emails).alias("email")).filter(F.col("email").isNotNull()).distinct()
    if users is None:
        return refs.select("email", F.col("email").alias("userId"), F.lit(None).cast("string").alias("name"),
                           F.lit(True).alias("isActive"))
    u = users.select(F.col("email").alias("_u_email"), "name", "isActive")
    return (refs.join(u, refs["email"] == u["_u_email"], "left")
            .select("email", F.col("email").alias("userId"), "name",
                    F.coalesce("isActive", F.lit(True)).alias("isActive")))

"""Index sinks (survey K1-K9).

The index is one plain Parquet table keyed by ``id`` and partitioned by ``_bucket``, a hash of the id.
How many buckets it has follows the size of the run that made it (``BUCKET_BYTES`` of values each, not of
Parquet, which may pack them many times smaller) and is kept in the key column's metadata.  A delta is merged with the buckets that its ids fall into, which
Spark replaces by dynamic partition overwrite; the others are not read or written.  A bucket is
written by ``WRITERS`` tasks; each row is told its task, as tasks
drawn by a hash of few values would get several shares or none.  The rows of one id that come from
different tasks go to different ones, so that an id with very many rows is no single task.

A job that fails before its commit leaves the index as it was.  Spark commits bucket by bucket: a run
that ends between two of them is repeated with the same documents, which gives the same index.  One
writer at a time.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.scalars import decode_text
from quillspark.operators.ordering import latest_per_id, number_rows
from quillspark.session import scratch_dir

UPLOAD_BATCH_SIZE = 100
#: Bytes (of values) that a bucket of a new index holds, and the tasks that write that much.
BUCKET_BYTES, WRITERS = 256 << 20, 4
_BUCKET = "_bucket"


def newest_documents(new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """This run's documents: those with an id, the last one per id by ``order``."""
    if not order:
        raise ValueError("an order column is needed to tell which document of an id is the last")
    missing = [c for c in order if c not in new.columns]
    if missing:
        raise ValueError(f"order column {missing[0]!r} missing")
    return latest_per_id(new.filter(F.coalesce(F.col(key), F.lit("")) != ""), key, [F.col(c) for c in order])


def index_upsert(existing: DataFrame | None, new: DataFrame, key: str = "id", order: list[str] | None = None) -> DataFrame:
    """K1 (INCREMENTAL): existing index overlaid by this run's documents; last one per
    id by ``order`` (required) wins; documents without id are dropped; nothing is deleted."""
    fresh = newest_documents(new, key, order or [])
    if existing is None:
        return fresh
    untouched = existing.join(fresh.select(key), key, "left_anti")
    return untouched.unionByName(fresh, allowMissingColumns=True)


def index_replace(new: DataFrame) -> DataFrame:
    """K2 (FULL): the index becomes exactly this run's documents; duplicates are kept."""
    return new


def full_requires_staging(mode: str, staging_root: str | None) -> str | None:
    """K5: FULL without a staging location is an error; INCREMENTAL never stages."""
    if mode.upper() == "FULL":
        if not staging_root:
            raise ValueError("FULL reconciliation requires a staging location")
        return f"{staging_root.rstrip('/')}/stage-{uuid.uuid4().hex[:12]}"
    return None


def index_delete(index: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """K6: remove documents by (sanitized) id."""
    return index.join(ids.select(key).distinct(), key, "left_anti")


def written(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written as Parquet and read back: computed once, kept when executors are lost."""
    df.write.mode("errorifexists").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def value_bytes(c: Column, t: T.DataType) -> Column:
    """Bytes of a value: texts and binaries by their length, all else that is flat as 8."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        own = F.octet_length(c).cast("bigint")
    elif isinstance(t, T.VariantType):
        own = F.octet_length(F.to_json(c)).cast("bigint")
    elif isinstance(t, T.StructType):
        own = sum((value_bytes(c[f.name], f.dataType) for f in t), F.lit(0).cast("bigint"))
    elif isinstance(t, T.ArrayType):
        own = F.aggregate(c, F.lit(0).cast("bigint"), lambda total, x: total + value_bytes(x, t.elementType))
    elif isinstance(t, T.MapType):
        own = value_bytes(F.map_keys(c), T.ArrayType(t.keyType)) + value_bytes(F.map_values(c), T.ArrayType(t.valueType))
    else:
        own = F.lit(8).cast("bigint")
    return F.coalesce(own, F.lit(0).cast("bigint"))


def measured(df: DataFrame, folder: str) -> tuple[DataFrame, int, int]:
    """``df`` written and read back, its rows and the bytes of their values, counted as they are written."""
    seen = Observation()
    size = sum((value_bytes(df[f.name], f.dataType) for f in df.schema), F.lit(0).cast("bigint"))
    out = written(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")), folder)
    return out, seen.get["rows"], seen.get["bytes"] or 0


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, root: str) -> DataFrame | None:
    """The table as it lies, with its bucket column; None if nothing was written yet."""
    try:
        return spark.read.parquet(root)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_index(spark: SparkSession, root: str) -> DataFrame | None:
    """The index, or None for a root without any document."""
    found = _stored(spark, root)
    return None if found is None else found.drop(_BUCKET)


def buckets_of(index: DataFrame, key: str = "id") -> int:
    return int(index.schema[key].metadata["buckets"])


def _write(df: DataFrame, root: str, key: str, buckets: int, only_touched: bool) -> None:
    """Write ``df`` over the whole index, or over the buckets that it has rows in."""
    named = df.withColumn(key, F.col(key).alias(key, metadata={"buckets": buckets})).withColumn(_BUCKET, bucket_of(key, buckets))
    own = F.pmod(F.xxhash64(F.lit("share"), F.col(key).cast("string")), F.lit(WRITERS)).cast("int")
    task = F.col(_BUCKET) * WRITERS + F.pmod(own + F.spark_partition_id(), F.lit(WRITERS))
    spread = named.withColumn("_task", task).repartitionById(buckets * WRITERS, "_task").drop("_task")
    how = "dynamic" if only_touched else "static"
    spread.write.mode("overwrite").option("partitionOverwriteMode", how).partitionBy(_BUCKET).parquet(root)


def publish(spark: SparkSession, df: DataFrame, root: str, key: str = "id", bucket_bytes: int = BUCKET_BYTES,
            staging: str | None = None) -> int:
    """Make ``df`` the whole index, by way of a staging folder that goes afterwards; returns its rows.
    Rows repeating an id stay."""
    staging = staging or scratch_dir(spark, "index-stage")
    staged, rows, size = measured(df, staging)
    _write(staged, root, key, max(1, -(-size // bucket_bytes)), only_touched=False)
    path = spark._jvm.org.apache.hadoop.fs.Path(staging)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return rows


def merge_into(spark: SparkSession, root: str, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
               key: str = "id", bucket_bytes: int = BUCKET_BYTES) -> int:
    """Replace the buckets that ``changes`` fall into by ``merge(their rows, changes)``; returns the
    number of changes.  Columns that the index does not have yet are added, for which it is written
    anew as a whole, so that all its files have one schema."""
    fresh, rows, size = measured(changes, scratch_dir(spark, "index-changes"))
    stored = _stored(spark, root)
    if stored is None:
        nothing = spark.createDataFrame([], fresh.schema)
        _write(merge(nothing, fresh), root, key, max(1, -(-size // bucket_bytes)), only_touched=False)
        return rows
    buckets = buckets_of(stored, key)
    touched = fresh.select(bucket_of(key, buckets).alias(_BUCKET)).distinct()
    widened = merge(stored.drop(_BUCKET).limit(0), fresh.limit(0)).schema
    if set(widened.names) - set(stored.columns):
        everything = written(merge(stored.drop(_BUCKET), fresh), scratch_dir(spark, "index-widened"))
        _write(everything, root, key, buckets, only_touched=False)
    else:
        _write(merge(stored.join(touched, _BUCKET, "left_semi").drop(_BUCKET), fresh), root, key, buckets, only_touched=True)
    return rows


def sync_index(spark: SparkSession, root: str, docs: DataFrame, mode: str = "INCREMENTAL",
               staging_root: str | None = None, order: list[str] | None = None, key: str = "id") -> dict:
    """K1/K2/K5/K9 end to end: merge (or replace), and summarise what was written."""
    stage = full_requires_staging(mode, staging_root)
    if stage is not None:
        if stage.startswith(root.rstrip("/") + "/"):
            raise ValueError("the staging location must not lie inside the index")
        synced = publish(spark, index_replace(docs), root, key, staging=stage)
    else:
        def merge(existing: DataFrame, fresh: DataFrame) -> DataFrame:
            untouched = existing.join(fresh.select(key), key, "left_anti")
            return untouched.unionByName(fresh, allowMissingColumns=True)

        synced = merge_into(spark, root, newest_documents(docs, key, order or []), merge, key)
    index = read_index(spark, root)
    return {"destination_format": "PARQUET", "total_records_indexed": 0 if index is None else index.count(),
            "records_synced_this_run": synced, "reconciliation_mode": mode.upper(), "status": "success"}


def upload_summary(spark: SparkSession, summary: dict) -> DataFrame:
    """K9 as a row: ``{destination_format, total_records_indexed, records_synced_this_run, mode, status}``,
    the counts of what a run of ``sync_index`` wrote."""
    return spark.createDataFrame([tuple(summary[k] for k in _SUMMARY)], ", ".join(f"{k} {t}" for k, t in _SUMMARY.items()))


_SUMMARY = {"destination_format": "string", "total_records_indexed": "bigint", "records_synced_this_run": "bigint",
            "reconciliation_mode": "string", "status": "string"}


def _camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(x.capitalize() for x in rest)


def camel_case(t: T.DataType) -> T.DataType:
    """The same type with the document's own field names in camelCase; a document's ``struct_data``
    holds the source's names and keeps them."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(_camel(f.name), f.dataType if f.name == "struct_data" else camel_case(f.dataType), f.nullable) for f in t])
    return T.ArrayType(camel_case(t.elementType), t.containsNull) if isinstance(t, T.ArrayType) else t


def write_ndjson(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    """K3: one JSON document per line, UTF-8, bytes as base64, field names in camelCase."""
    named = df.select(*[F.col(f.name).cast(g.dataType).alias(g.name) for f, g in zip(df.schema, camel_case(df.schema))])
    named.write.mode("errorifexists").option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def assign_batches(df: DataFrame, order_col: str = "id", batch_size: int = UPLOAD_BATCH_SIZE) -> DataFrame:
    """K4: consecutive batches of ``batch_size`` in ``order_col`` order, last one short."""
    numbered = number_rows(df.orderBy(order_col), "row_index")
    return numbered.withColumn("batch_id", F.floor(F.col("row_index") / batch_size).cast("bigint"))


def write_audit(docs: DataFrame, path: str, run_id: str, mode: str) -> DataFrame:
    """K7: per document id, ACL, structured data and content decoded as UTF-8 with
    replacement, plus run metadata; written partitioned by ``run_id``."""
    audit = audit_records(docs, run_id, mode)
    audit.write.mode("append").partitionBy("run_id").json(path)
    return audit


def audit_records(docs: DataFrame, run_id: str, mode: str) -> DataFrame:
    cols = docs.columns
    sd = F.to_json("struct_data") if "struct_data" in cols else F.lit(None).cast("string")
    text = decode_text(F.col("content")["raw_bytes"]) if "content" in cols else F.lit(None).cast("string")
    return docs.select(F.col("id").alias("document_id"), F.to_json("acl_info").alias("acl_info"),
                       sd.alias("struct_data"), text.alias("content_text"),
                       F.lit(mode.upper()).alias("reconciliation_mode"), F.lit(run_id).alias("run_id"))


def split_by_entity(df: DataFrame, path: str, entity_types: list[str], col: str = "entityType") -> None:
    """K8: one JSON-lines output per listed entity type; unlisted types are dropped and
    empty types write nothing."""
    df.filter(F.col(col).isin(*entity_types)).write.mode("errorifexists").partitionBy(col).json(path)

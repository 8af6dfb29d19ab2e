"""I7 as a stream: change files landing in a folder are applied to the index.

``readStream`` picks up new files; each micro-batch rewrites the index buckets that its
ids fall into (``foreachBatch``).  The newest of an id's row and events decides, so a batch that
is run again after a restart changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.state import apply_changes
from quillspark.sinks import index as K


def start_change_stream(spark: SparkSession, changes_dir: str, schema: T.StructType, index_root: str,
                        checkpoint_dir: str, key: str = "id", order: tuple[str, ...] = ("updatedAt",),
                        propagate_deletes: bool = True, file_format: str = "json", trigger_once: bool = True):
    """Start the stream; returns the ``StreamingQuery``.  ``schema`` must include
    ``key``, ``action`` and the ``order`` columns."""
    stream = spark.readStream.schema(schema).format(file_format).load(changes_dir)

    def merge(existing: DataFrame, batch: DataFrame) -> DataFrame:
        known = existing if "_deleted" in existing.columns else existing.drop("action").withColumn("_deleted", F.lit(False))
        return apply_changes(known, batch, list(order), key=key, propagate_deletes=propagate_deletes)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        K.merge_into(spark, index_root, batch, merge, key)

    writer = stream.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="1 minute")
    return writer.start()

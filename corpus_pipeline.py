"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, as it leaves them;
the last returns the places of their pieces in the sequences.  ``run`` writes each stage's result as
Parquet in the shared folder and reads it again, so a lost executor never repeats a whole stage.

Defined cases: an empty table passes through every stage; rows without a ``doc_id`` are judged by the
quality rules like any others and left alone by the stages that compare documents, which name
documents by id; rows repeating an id are one document, of which MinHash keeps one row.  Columns
beside those that a stage reads are handed on unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.decontaminate import contaminated
from quillspark.llm.lines import drop_repeated_lines
from quillspark.llm.minhash import near_duplicates
from quillspark.llm.packing import pack_pieces, tokenize
from quillspark.llm.quality import judge, measures
from quillspark.llm.queries import table, tokenizer_path
from quillspark.llm.shared import cut


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` is not in ``ids``; rows without an id stay."""
    gone = cut(ids.select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the risk-controlled cutoffs reject go."""
    verdicts = judge(docs, table(spark, sf_dir, "labels"))
    verdicts = cut(verdicts.select("doc_id", "kept"), "verdicts")
    known = _without(docs.where("doc_id IS NOT NULL"), verdicts.where("NOT kept"))
    nameless = docs.where("doc_id IS NULL")
    if nameless.isEmpty():
        return known
    # Rows without an id cannot be looked up: the base rules alone are applied to them.
    row = "_row_" + "_".join(docs.columns)  # no column of the table has this name
    marked = nameless.withColumn(row, F.monotonically_increasing_id())
    marked = cut(marked, "nameless")
    passed = measures(marked, id_col=row).where("NOT base_failed").select(F.col("id").alias(row))
    return known.unionByName(marked.join(passed, row, "left_semi").drop(row))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines much like an earlier line of the corpus are taken out; every document stays."""
    return drop_repeated_lines(docs, min_words=5, percent=80)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    found = near_duplicates(docs, width=5, percent=80)
    gone = found.where("doc_id IS NOT NULL AND NOT kept")
    left = _without(docs, gone)
    once = left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return once.unionByName(left.where("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.withColumnRenamed("id", "doc_id"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, placed in sequences of 4096 tokens."""
    pieces = tokenize(docs, tokenizer_path(), capacity=4096, end_id=1)
    return pack_pieces(pieces, 4096).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL expresses neither the stage of latent retrieval nor best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs

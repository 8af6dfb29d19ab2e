"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each text has a few measures, and a rule rejects a document whose measure is above a cutoff.  The
cutoffs come from labelled documents: for each stratum (language), rule and cutoff of a fixed grid,
an exact binomial test asks whether the share of good documents that the rule rejects is under the
rule's part of ``risk``.  Of the cutoffs that pass, the one that rejects most bad documents less good
ones is taken, the most lenient among equals; where none passes and gains, the rule does nothing.  The level is ``error`` over the number of all tests (Bonferroni), so with probability
1 - ``error`` no stratum loses more than ``risk`` of its good documents.

Defined cases: a null text has no words and fails the base rules; a null stratum is one of its own;
a stratum without labels has no cutoffs; labels repeated for an id count once, as good if any says
so; labels without a document are ignored; a repeated row is judged again; an empty table gives no
rows; further columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.shared import cut, word_array

#: Cutoffs of the rules, from lenient to strict: start * ratio**k for k below ``STEPS``.
STEPS = 20
RULES = {
    "symbols": (0.9, 0.8),
    "punctuation": (0.9, 0.8),
    "upper_case": (0.9, 0.8),
    "duplicate_lines": (0.9, 0.8),
    "repeated_words": (0.5, 0.8),
    "word_length": (40.0, 0.9),
}


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(hashes: Column) -> Column:
    """Words covered by 3-word windows found at least twice, from the windows' hashes."""

    def covered(s: Column) -> Column:
        def again(x, i):
            near = [F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False)) for j in (i - 1, i + 1)]
            return near[0] | near[1]

        starts = F.transform(F.filter(s, again), lambda x: x["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(ordered, covered))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(id, stratum, counts, base_failed, scores) of every row; scores is one value for each rule."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"), text.alias("t"))
    rows = rows.select("id", "stratum", "t", word_array(F.col("t")).alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w = F.col("w")
    windows = F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2])))
    rows = rows.select(
        "id", "stratum",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit(r"[!-/:-@\[-`{-~]")).cast("long").alias("n_punctuation"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        lines.alias("lines"),
        windows.alias("windows"),
    )
    rows = rows.select(
        "id", "stratum", "n_words", "word_chars", "n_symbols", "n_punctuation", "n_upper",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("windows")).cast("long").alias("n_repeat_words"),
    )

    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return rows.select(
        "id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        F.array(
            share("n_symbols", "word_chars"), share("n_punctuation", "word_chars"), share("n_upper", "word_chars"),
            share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), share("word_chars", "n_words"),
        ).alias("scores"),
    )


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """ln P(X <= k) for X binomial(n, p), exact to rounding, for k up to the mean.

    The last term is a product of ratios; the sum over it is 1 + (sum before) / ratio."""
    start = F.struct((n * F.lit(math.log1p(-p))).alias("t"), F.lit(1.0).alias("r"))

    def step(acc, i):
        ratio = (n - i + 1) / i * F.lit(p / (1 - p))
        return F.struct((acc["t"] + F.log(ratio)).alias("t"), (1 + acc["r"] / ratio).alias("r"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1)).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, start, step, lambda a: a["t"] + F.log(a["r"]))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.03, error: float = 0.05, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """(stratum, rule, cutoff, n_good, good_rejected, bad_rejected) of the rules that pass."""
    known = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(quality_col).alias("q")).where("q IS NOT NULL")
    rows = measured.where("NOT base_failed").join(known, "id")
    grids = [[a * b**k for k in range(STEPS)] for a, b in RULES.values()]
    # A measure is above its first cutoffs only from its ``at``-th on.
    placed = [
        F.struct(F.lit(i).alias("rule"), sum(((F.col("scores")[i] <= c).cast("int") for c in grid), F.lit(0)).alias("at"))
        for i, grid in enumerate(grids)
    ]
    counts = (
        rows.select("stratum", "q", F.explode(F.array(*placed)).alias("x")).groupBy("stratum", "x.rule", "x.at")
        .agg(F.count_if(F.col("q") == 1).alias("good"), F.count_if(F.col("q") != 1).alias("bad"))
    )

    def rejected(kind: str) -> Column:
        """Cutoff k rejects the documents that lie at most at place k."""
        return F.aggregate(F.sequence(F.lit(0), F.col("k")), F.lit(0).cast("long"), lambda s, i: s + F.coalesce(F.col("by")[i][kind], F.lit(0)))

    tested = (
        counts.groupBy("stratum", "rule").agg(
            F.sum("good").alias("n"), F.map_from_entries(F.collect_list(F.struct("at", F.struct("good", "bad")))).alias("by"))
        .select("stratum", "rule", "n", "by", F.posexplode(F.element_at(F.array(*[F.array(*map(F.lit, g)) for g in grids]), F.col("rule") + 1)).alias("k", "cutoff"))
        .select("stratum", "rule", "n", "k", "cutoff", rejected("good").alias("good"), rejected("bad").alias("bad"))
    )
    part = risk / len(RULES)
    strata = counts.select("stratum").distinct().agg(F.count("*"))
    tests = strata.scalar() * F.lit(len(RULES) * STEPS)
    certain = (F.col("good") <= F.col("n") * part) & (log_binomial_cdf(F.col("good"), F.col("n"), part) <= F.log(F.lit(error) / tests))
    passed = tested.where(certain & (F.col("bad") > F.col("good")))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc(F.col("bad") - F.col("good")), "k")
    return passed.withColumn("r", F.row_number().over(best)).where("r = 1").select(
        "stratum", "rule", "cutoff", F.col("n").alias("n_good"), F.col("good").alias("good_rejected"), F.col("bad").alias("bad_rejected"))


def judge(docs: DataFrame, labels: DataFrame, risk: float = 0.03, error: float = 0.05, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", quality_col: str = "quality") -> DataFrame:
    """Per row: id, the counts, base_failed, kept, failed_rules (names)."""
    measured = cut(measures(docs, id_col, text_col, stratum_col), "measures")
    found = cutoffs(measured, labels, risk, error, id_col, quality_col)
    limits = found.groupBy(F.col("stratum").alias("s")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    limits = cut(limits, "cutoffs")
    joined = measured.join(limits, F.col("stratum").eqNullSafe(F.col("s")), "left")
    failed = F.array_compact(F.array(*[F.when(F.col("scores")[i] > F.col("limits")[i], F.lit(name)) for i, name in enumerate(RULES)]))
    return joined.withColumn("failed_rules", failed).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), F.array_join("failed_rules", ",").alias("failed_rules"))

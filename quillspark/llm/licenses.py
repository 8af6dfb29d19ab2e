"""Licence scan of paragraphs, in DataFrame functions only.

A paragraph is a line of a text.  A multinomial logistic regression over the word 1- to 3-grams of
``LEAST_ROWS`` training rows or more (sparse: most weights are driven to zero) tells licence families and
an ``unknown`` class apart.  It scores every paragraph.  It is fitted on variants of the families' templates (words left out, text of the corpus
before and after) and, as unknown, on ``sample`` distinct whole paragraphs of the corpus, the least by
hash, without those that have much of a template's 3-grams.  A held-out fifth of these sets the probability
from which a family is believed, so that at most ``false_share`` of the unknown paragraphs pass.  A
prediction is confirmed if the paragraph has at least ``similarity`` of the 3-grams of a template of the
predicted family.

A notice may be wrapped over lines.  Where a line's end and the words after it, up to a blank line, have
``similarity`` of a template's 3-grams and more of them than the line and the words after it have
alone, they are scored as one further paragraph, under the number of the line.  Such a span must hold one of the
*anchors*: the fewest, rarest words without which less than ``similarity`` of each template's
3-grams are left.  So only lines with an anchor in or after them are tested for spans; that loses none.

Defined cases: null or empty texts have no paragraphs; a repeated row is scanned again; a row without
an id is reported with a null id; a corpus without plain paragraphs trains on templates and their
fragments; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.shared import cut

#: Usual wordings by which texts name their licence.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version 2.1"),
    ("agpl", "licensed under the gnu affero general public license version 3"),
    ("bsd", "released under the bsd 3 clause license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "subject to the terms of the mozilla public license version 2.0"),
    ("cc-by", "licensed under cc by 4.0"),
    ("cc-by", "licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4.0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4.0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4.0 international license"),
    ("cc0", "this work is dedicated to the public domain under cc0 1.0 universal"),
    ("gpl", "gnu gpl v3"),
    ("lgpl", "gnu lgpl v3"),
    ("agpl", "gnu agpl v3"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "all rights reserved no part of this work may be reproduced without permission"),
]
UNKNOWN = "unknown"
#: A gram is a feature if so many training rows have it; each of a template's is in some thirty.  The driver
#: holds some thirty numbers for each feature and family while it fits.
LEAST_ROWS = 8


def tokens(text: Column) -> Column:
    """Lower-case words and numbers; digits are one sign, so that versions and years look alike."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), r"\d+(\.\d+)*", "0"), F.lit(r"[\p{L}0]+"), F.lit(0))


def _plain(text: str) -> list[str]:
    return re.findall(r"[a-z0]+", re.sub(r"\d+(\.\d+)*", "0", text.lower()))


def _trigrams(words: Column) -> Column:
    some = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(some, lambda w, i: F.concat_ws(" ", w, words[i + 1], words[i + 2]))


def grams(words: Column) -> Column:
    """The distinct 1-, 2- and 3-grams."""
    two = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, words[i + 1]))
    return F.array_distinct(F.concat(words, two, _trigrams(words)))


def anchors(similarity: float) -> list[str]:
    """Words one of which any paragraph with ``similarity`` of a template's 3-grams must have."""
    split = [_plain(t) for _, t in TEMPLATES]
    known, chosen = Counter(w for s in split for w in set(s)), set()
    for s in split:
        three = {tuple(s[i : i + 3]) for i in range(len(s) - 2)}
        left = {g for g in three if not chosen & set(g)}
        while len(left) >= similarity * len(three):
            word = min({w for g in left for w in g if w != "0"}, key=lambda w: (len(w) < 3, known[w], -sum(w in g for g in left), w))
            chosen.add(word)
            left = {g for g in left if word not in g}
    return sorted(chosen)


LONGEST = max(len(_plain(t)) for _, t in TEMPLATES)


def paragraphs(docs: DataFrame, id_col: str, text_col: str, pattern: str) -> DataFrame:
    """(id, paragraph, text, anchor, next): the lines, whether ``pattern`` is in one, and, where it is in that or
    the lines that follow, what of those, up to a blank line, a notice that starts in it can reach."""
    # A notice's later words lie in as many lines at most; a blank one ends it.
    heads = F.transform(F.split(text_col, "\n"), lambda t: F.when(F.trim(t) == "", "\n").otherwise(F.substring_index(F.trim(t), " ", LONGEST)))
    found = F.transform(F.split(text_col, "\n"), lambda t: t.rlike(pattern))

    def lines(b: Column) -> Column:
        after = lambda i: F.substring_index(F.array_join(F.slice(b["heads"], i + 2, LONGEST), " "), "\n", 1)
        near = lambda i: F.array_contains(F.slice(b["found"], i + 1, LONGEST + 1), True)
        return F.transform(F.split(text_col, "\n"), lambda t, i: F.struct(t.alias("text"), F.get(b["found"], i).alias("anchor"), F.when(near(i), after(i)).alias("next")))

    both = F.transform(F.array(F.struct(heads.alias("heads"), found.alias("found"))), lines)[0]
    rows = docs.select(F.col(id_col).alias("id"), F.posexplode(both).alias("paragraph", "t"))
    return rows.select("id", "paragraph", "t.text", "t.anchor", "t.next")


def template_shares(grams: Column) -> list[tuple[str, Column]]:
    """(family, the share of the 3-grams that are among ``grams``) for each template."""
    split = [(f, _plain(t)) for f, t in TEMPLATES]
    threes = [(f, [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]) for f, w in split]
    return [(f, F.size(F.array_intersect(grams, F.array(*map(F.lit, three)))) / len(three)) for f, three in threes]


def nearest_template(words: Column) -> Column:
    """The largest share of a template; the words and their 3-grams are bound, so that each is computed once."""
    threes = F.transform(F.array(words), _trigrams)
    return F.transform(threes, lambda g: F.greatest(*[share for _, share in template_shares(g)]))[0]


def wrapped(words: Column, after: Column, similarity: float) -> Column:
    """The words of a notice that starts in a line and goes on after it, as an array of one or none."""
    end = F.slice(words, F.greatest(F.size(words) - LONGEST + 2, F.lit(1)), LONGEST - 1)
    span = F.concat(end, after)
    whole = nearest_template(span)
    apart = F.greatest(nearest_template(words), nearest_template(after))
    none = F.array().cast("array<array<string>>")
    return F.when((F.size(after) > 0) & (whole >= similarity) & (whole > apart), F.array(span)).otherwise(none)


def training_set(spark: SparkSession, plain: DataFrame, variants: int) -> DataFrame:
    """(family, words, held_out): variants of templates, and plain paragraphs as unknown."""
    templates = spark.createDataFrame([(f, _plain(t), i) for i, (f, t) in enumerate(TEMPLATES)], "family string, words array<string>, number int")
    numbered = plain.withColumn("place", F.pmod(F.xxhash64("words"), F.lit(variants)).cast("int"))
    fillers = numbered.groupBy("place").agg(F.min(F.struct("words")).alias("w")).select("place", F.slice("w.words", 1, 40).alias("filler"))
    drawn = templates.select("*", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))).alias("place")).join(fillers, "place", "left")
    drawn = drawn.withColumn("filler", F.coalesce("filler", F.array().cast("array<string>")))

    def stays(w: Column, i: Column) -> Column:
        return F.pmod(F.xxhash64(w, i, F.col("place"), F.col("number")), F.lit(12)) != 0

    # A short form is only itself with all its words.
    kept = F.when((F.col("place") < 4) | (F.size("words") < 5), F.col("words")).otherwise(F.filter("words", stays))
    size = F.size("filler")
    before = F.slice("filler", 1, F.pmod(F.col("place"), size + 1))
    after = F.slice("filler", F.pmod(F.col("place"), size + 1) + 1, size)
    around = F.pmod(F.col("place"), F.lit(4))
    none = F.array().cast("array<string>")
    whole = F.concat(F.when(around >= 2, before).otherwise(none), kept, F.when(around % 2 == 1, after).otherwise(none))
    positive = drawn.select("family", whole.alias("words"), (F.pmod(F.col("place"), F.lit(5)) == 0).alias("held_out"))
    # Half templates are no licence: their words alone must not be believed.
    half = F.slice("words", 1, F.greatest(F.size("words").cast("int") / 3, F.lit(2)).cast("int"))
    broken = drawn.where(F.col("place") < 8).select(F.lit(UNKNOWN).alias("family"), F.concat(before, half, after).alias("words"), (F.pmod(F.col("place"), F.lit(5)) == 0).alias("held_out"))
    negative = numbered.select(F.lit(UNKNOWN).alias("family"), "words", (F.pmod(F.xxhash64("words"), F.lit(5)) == 0).alias("held_out"))
    return positive.unionByName(broken).unionByName(negative)


class LicenceModel:
    """Fitted classifier: families, features, the regression and the probability to believe."""

    def __init__(self, spark: SparkSession, plain: DataFrame, variants: int, false_share: float):
        families = [UNKNOWN, *dict.fromkeys(f for f, _ in TEMPLATES)]
        self.families = families
        label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
        rows = cut(training_set(spark, plain, variants).select(label.cast("double").alias("label"), grams(F.col("words")).alias("grams"), "held_out"), "licence-training")
        fit = LogisticRegression(maxIter=40, regParam=2e-4, elasticNetParam=0.9, family="multinomial")
        train = rows.where("NOT held_out")
        self.features = CountVectorizer(minDF=LEAST_ROWS, binary=True, inputCol="grams", outputCol="features").fit(train)
        self.model = fit.fit(self.features.transform(train))
        held = self.predict(rows.where("held_out AND label = 0"))
        # The unknown paragraphs' highest family probabilities; at most false_share lie above.
        self.least = held.agg(F.coalesce(F.percentile(F.col("family_probability"), 1 - false_share), F.lit(0.5))).first()[0]

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds the likeliest family and its probability, the unknown class left aside."""
        scored = self.model.transform(self.features.transform(rows)).withColumn("p", F.slice(vector_to_array("probability"), 2, len(self.families) - 1))
        best = F.array_max("p")
        return scored.withColumn("family_probability", best).withColumn(
            "family", F.element_at(F.array(*map(F.lit, self.families[1:])), F.array_position("p", best).cast("int")))


def scan(docs: DataFrame, similarity: float = 0.6, sample: int = 4000, variants: int = 60, false_share: float = 0.002, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, paragraph, family, probability, template_similarity, confirmed) of every paragraph whose family is
    believed or that holds an anchor; family is ``unknown`` where the probability is not believed."""
    spark = docs.sparkSession
    found = anchors(similarity)
    pattern = rf"(?i)(?<!\p{{L}})(?:{'|'.join(map(re.escape, found))})(?!\p{{L}})"
    hashed = docs.select(F.explode(F.split(text_col, "\n")).alias("text")).select("text", F.xxhash64("text").alias("h")).where(F.col("text").rlike(r"[\p{L}0-9]"))
    least = cut(hashed.select("h").distinct().orderBy("h").limit(sample), "licence-hashes")
    taken = hashed.join(F.broadcast(least), "h", "left_semi").dropDuplicates(["h"])
    plain = taken.select(tokens(F.col("text")).alias("words")).where(nearest_template(F.col("words")) < similarity / 2)
    model = LicenceModel(spark, cut(plain, "licence-sample"), variants, false_share)
    parts = paragraphs(docs, id_col, text_col, pattern)
    rows = parts.select("id", "paragraph", "anchor", tokens(F.col("text")).alias("words"), F.slice(tokens(F.col("next")), 1, LONGEST - 1).alias("after"))
    spans = F.when(F.col("after").isNotNull(), wrapped(F.col("words"), F.col("after"), similarity)).otherwise(F.array().cast("array<array<string>>"))
    rows = rows.select("id", "paragraph", "anchor", F.explode(F.concat(F.array("words"), spans)).alias("words")).where(F.size("words") > 0)
    rows = rows.select("id", "paragraph", "anchor", grams(F.col("words")).alias("grams"))
    scored = model.predict(rows)
    believed = F.col("family_probability") > F.lit(max(model.least, 0.5))
    scored = scored.where(believed | F.col("anchor"))
    shares = [F.when(F.col("family") == f, share) for f, share in template_shares(F.col("grams"))]
    alike = F.coalesce(F.greatest(*shares), F.lit(0.0))
    return scored.select(
        F.col("id").alias(id_col), "paragraph",
        F.when(believed, F.col("family")).otherwise(UNKNOWN).alias("family"),
        F.col("family_probability").alias("probability"),
        alike.alias("template_similarity"),
        (believed & (alike >= similarity)).alias("confirmed"))

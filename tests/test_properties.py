"""Property tests: C1 and C2 on random text against Python's ``re`` (the reference's
own regex engine) as a brute-force oracle."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.functions import scalars as S

ALPHABET = "ABCXYZabcxyz0123456789-_ /:.#éÉ\n"
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=60)


def _spark_map(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return {r.i: r.r for r in df.select("i", expr.alias("r")).collect()}


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_tickets_match_python_re(spark, texts):
    got = _spark_map(spark, texts, S.extract_tickets("x"))
    for i, t in enumerate(texts):
        assert got[i] == sorted(set(re.findall(r"\b([A-Z][A-Z0-9]{1,9}-\d+)\b", t))), t


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_sanitize_matches_python_re(spark, texts):
    got = _spark_map(spark, texts, S.sanitize_doc_id("x"))
    for i, t in enumerate(texts):
        assert got[i] == re.sub(r"[^a-zA-Z0-9-_]", "_", t), t

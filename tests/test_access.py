"""Visibility by access signatures against a plain loop over readers and documents."""

import random

import pytest
from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.operators.access import access_index


def frames(spark, docs, users):
    df = spark.createDataFrame(docs, "id string, users array<string>, groups array<string>, pub boolean")
    acl = F.when(F.col("pub"), A.public_acl()).otherwise(A.acl_from_row(F.lit(True), "users", "groups", F.lit(None).cast("string")))
    return df.select("id", acl.alias("acl_info")), spark.createDataFrame(users, "user_id string, groups array<string>")


def readable(docs, user, groups):
    return {d for d, u, g, pub in docs if pub or user in (u or []) or set(g or []) & set(groups or [])}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_counts_and_lists_match_a_loop(spark, seed):
    rng = random.Random(seed)
    names, groups = [f"u{i}" for i in range(30)], ["hot", "warm", *(f"g{i}" for i in range(6))]

    def some(of, most):
        return rng.sample(of, rng.randrange(0, most))

    docs = [(f"d{i}", some(names, 4), some(groups, 4) + ["hot"] * (rng.random() < 0.4), rng.random() < 0.1) for i in range(300)]
    docs += [(f"same{i}", ["u1", "u1"], ["hot", "warm"], False) for i in range(50)] + [("none", [], [], False), ("null", None, None, False)]
    users = [(u, some(groups, 5)) for u in names] + [("u1", None), ("u2", ["hot", "hot"]), ("stranger", [])]
    df, u = frames(spark, docs, users)
    index = access_index(df)
    got = sorted((r.user_id, r.visible) for r in index.count(u).collect())
    assert got == sorted((x, len(readable(docs, x, g))) for x, g in users)
    listed, public = {}, {r.id for r in index.public().collect()}
    for r in index.documents(u).collect():
        listed.setdefault(r.user_id, []).append(r.id)
    assert all(len(x) == len(set(x)) for x in listed.values())
    for x in {x for x, _ in users}:
        whole = set().union(*[readable(docs, x, g) for y, g in users if y == x])
        assert set(listed.get(x, [])) | public == whole
    assert index.signatures.count() < df.count()


def test_a_hot_group_does_not_multiply(spark, tmp_path):
    """100 times the documents and readers of the hot group: no join gives more rows than those two tables."""
    docs = [(f"d{i}", [f"u{i % 500}"], ["hot"] + [f"g{i % 5}"] * (i % 2), False) for i in range(20000)]
    users = [(f"u{i}", ["hot", f"g{i % 5}"]) for i in range(500)]
    df, u = frames(spark, docs, users)
    index = access_index(df)
    got = {r.user_id: r.visible for r in index.count(u).collect()}
    assert got == {f"u{i}": 20000 for i in range(500)}
    parts = index.parts.count()
    assert parts <= 11 and index.postings.count() <= 3 * index.signatures.count() and index.signatures.count() <= 5000


def test_no_documents_and_no_readers(spark):
    df, u = frames(spark, [("d", ["a"], [], False)], [("a", [])])
    assert access_index(df).count(u.limit(0)).collect() == []
    assert [tuple(r) for r in access_index(df.limit(0)).count(u).collect()] == [("a", 0)]
    assert [tuple(r) for r in access_index(df).count(u).collect()] == [("a", 1)]

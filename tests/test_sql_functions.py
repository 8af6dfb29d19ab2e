"""The functions in SQL text against the same functions as columns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.functions import scalars as S
from quillspark.functions.sql import FUNCTIONS, register_functions
from quillspark.sources.tables import entity_type_column

TEXTS = [None, "", "a/b", "org/repo/x.md", "ABC-12 and XY9-3, ABC-12 x-1", "https://api.github.com/x", "https://git.x.com/api/v3/",
         "https://git.x.com/api/v3", "12", " 12 ", "12.5", "order-7", "cities", "buses", "cats", "s", "ies", "person", "aGk=", "not base64!", "é ü\\d'"]
PLAIN = {"sanitize_doc_id": S.sanitize_doc_id, "extract_tickets": S.extract_tickets, "web_base_url": S.web_base_url, "int_or_null": S.int_or_null,
         "base64_decode": S.base64_decode, "encode_text": S.encode_text, "basename": S.basename, "repo_owner": S.repo_owner,
         "repo_name": S.repo_name, "config_hash": S.config_hash, "singularize": S.singularize, "entity_type_for_table": entity_type_column}


@pytest.fixture(scope="module")
def names(spark):
    register_functions(spark)
    return register_functions(spark)  # a second time replaces them


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_functions_of_a_text(spark, names, name):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for r in df.select("t", PLAIN[name]("t").alias("a"), F.expr(f"{name}(t)").alias("b")).collect():
        assert r.a == r.b, (name, r.t)


def test_two_texts_dates_and_bytes(spark, names):
    df = spark.createDataFrame([(a, b) for a in TEXTS[:5] for b in (None, "", "x", "order-7")], "a string, b string")
    for r in df.select(S.author_email("a", "b").alias("p"), F.expr("author_email(a, b)").alias("q"), S.author_display("a", "b").alias("r"),
                       F.expr("author_display(a, b)").alias("s"), S.prefix_id("order", "b").alias("u"), F.expr("prefix_id('order', b)").alias("v")).collect():
        assert (r.p, r.r, r.u) == (r.q, r.s, r.v)
    times = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),), (dt.datetime(2024, 1, 2, 3, 4, 5, 670),), (None,)], "t timestamp")
    for r in times.select(S.iso_datetime("t").alias("a"), F.expr("iso_datetime(t)").alias("b"), S.iso_date(F.to_date("t")).alias("c"), F.expr("iso_date(to_date(t))").alias("d")).collect():
        assert (r.a, r.c) == (r.b, r.d)
    raw = spark.createDataFrame([(bytearray(b"ok \xff"),), (None,)], "b binary")
    for r in raw.select(S.decode_text("b").alias("a"), F.expr("decode_text(b)").alias("b"), S.base64_encode("b").alias("c"), F.expr("base64_encode(b)").alias("d")).collect():
        assert (r.a, r.c) == (r.b, r.d)
    assert spark.sql("SELECT json_text(parse_json('{\"a\": [1, null]}')) AS j").first().j == '{"a":[1,null]}'


def test_access_control(spark, names):
    lists = [None, [], ["a"], ["a", "", None, "b"]]
    rows = [(p, u, g, o) for p in (None, True, False) for u in lists for g in lists for o in (None, "", "me")]
    df = spark.createDataFrame(rows, "p boolean, u array<string>, g array<string>, o string")
    got = df.select(A.acl_from_row("p", "u", "g", "o").alias("a"), F.expr("acl_from_row(p, u, g, o)").alias("b"),
                    A.acl_summary(A.acl_from_row("p", "u", "g", "o")).alias("c"), F.expr("acl_summary(acl_from_row(p, u, g, o))").alias("d"),
                    A.permissions_block("p", "u", "g").alias("e"), F.expr("permissions_block(p, u, g)").alias("f")).collect()
    assert all((r.a, r.c, r.e) == (r.b, r.d, r.f) for r in got)
    perms = [None, [], [("a", "group"), ("b", None), ("", "USER"), (None, "USER")], [("allUsers", "USER")], [("allUsers", "GROUP")], [("x", "user")]]
    df = spark.createDataFrame([(p,) for p in perms], "p array<struct<email: string, type: string>>")
    got = df.select(A.acl_from_permissions("p").alias("a"), F.expr("acl_from_permissions(p)").alias("b"),
                    A.acl_from_principals(A.permissions_to_principals("p")).alias("c"), F.expr("acl_from_principals(permissions_to_principals(p))").alias("d")).collect()
    assert all((r.a, r.c) == (r.b, r.d) for r in got)


def test_threads_and_plan(spark, names):
    items = [None, [], [("d", "b", ("me",), "OPEN"), (None, None, None, None)]]
    df = spark.createDataFrame([(i,) for i in items], "i array<struct<createdAt: string, body: string, author: struct<login: string>, state: string>>")
    short = "transform(i, x -> named_struct('createdAt', x.createdAt, 'body', x.body, 'author', x.author))"
    for r in df.select(S.thread_lines("i").alias("a"), F.expr(f"thread_lines({short})").alias("b"), S.thread_lines("i", True).alias("c"), F.expr("review_lines(i)").alias("d")).collect():
        assert (r.a, r.c) == (r.b, r.d)
    plan = df.select(F.expr("thread_lines(NULL)"), F.expr("basename('a/b')"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and len(names) == len(FUNCTIONS) >= 25

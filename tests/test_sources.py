"""Sources and cache/group lookups: S1 error handling, S5 delta preference, S10
nested policy tags, J3 FULL mode, J11 external groups."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators import joins as J
from quillspark.session import scratch_dir
from quillspark.sources import files as SF
from quillspark.sources import tables as TB


def test_scan_tables_records_failures_and_continues(spark):
    errors = []
    readers = {
        "launches": lambda: spark.createDataFrame([("1", None), ("2", "launch")], "id string, entityType string"),
        "people": lambda: spark.createDataFrame([("3", "")], "id string, entityType string"),
        "missing": lambda: spark.read.parquet("/nonexistent/path/quillspark"),
    }
    out = TB.scan_tables(readers, overrides={"people": "person"}, errors=errors)
    got = sorted((r.id, r.entityType) for r in out.collect())
    # singularize('launches') is 'launche' (reference quirk): untyped rows get it, typed rows keep theirs
    assert got == [("1", "launche"), ("2", "launch"), ("3", "person")]
    assert [e[1] for e in errors] == ["missing"]


def test_select_tables_full_match():
    selected, skipped = TB.select_tables(["launches", "launch_reviews", "people"], pattern="launch.*s")
    assert selected == ["launches", "launch_reviews"] and skipped == ["people"]
    selected, _ = TB.select_tables(["a", "b"], explicit=["b"])
    assert selected == ["b"]


def test_a_missing_table_raises_without_an_error_list(spark):
    with pytest.raises(AnalysisException):
        TB.scan_tables({"missing": lambda: spark.read.parquet("/nonexistent/path/quillspark")})


def test_entity_types_of_table_names(spark):
    names = spark.createDataFrame([("user",), ("houses",), ("people",)], "t string")
    got = [r[0] for r in names.select(TB.entity_type_column("t", {"people": "person"})).collect()]
    assert got == ["user", "hous", "person"]


def test_json_documents_prefer_delta_incrementally(spark):
    root = scratch_dir(spark, "json-src")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType())])
    spark.createDataFrame([("doc-001", "full")], schema).write.json(root + "/full")
    assert SF.scan_json_documents(spark, root + "/full", schema, root + "/delta", multiline=False).count() == 1
    spark.createDataFrame([("doc-001", "delta"), ("doc-004", "new")], schema).write.json(root + "/delta")
    inc = SF.scan_json_documents(spark, root + "/full", schema, root + "/delta", "INCREMENTAL", multiline=False)
    assert {r.title for r in inc.collect()} == {"delta", "new"}
    full = SF.scan_json_documents(spark, root + "/full", schema, root + "/delta", "FULL", multiline=False)
    assert [r.title for r in full.collect()] == ["full"]


def test_json_array_file_multiline(spark):
    root = scratch_dir(spark, "json-array")
    spark.createDataFrame([('[{"id": "a", "title": "x"}, {"id": "b"}]',)], "value string").coalesce(1) \
        .write.text(root)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType())])
    assert sorted(r.id for r in SF.scan_json_documents(spark, root, schema, mode="FULL").collect()) == ["a", "b"]


def test_protected_columns_nested_leaf(spark):
    inner = T.StructType([T.StructField("ssn", T.StringType(), metadata={"policy_tags": ["pii"]}),
                          T.StructField("city", T.StringType())])
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("profile", inner),
                           T.StructField("notes", T.ArrayType(inner)), T.StructField("open", T.StringType())])
    df = spark.createDataFrame([], schema)
    assert TB.protected_columns(df.schema) == ["profile", "notes"]
    kept, denied = TB.scan_table_minus_protected(TB.tag_columns(df, {"open": ["finance"]}), granted_tags=["finance"])
    assert denied == ["notes", "profile"] and kept.columns == ["id", "open"]


def test_tags_are_kept_by_the_written_table(spark):
    root = scratch_dir(spark, "tagged")
    df = spark.createDataFrame([(1, "a", [("x", 2)])], "id int, name string, notes array<struct<who: string, n: int>>")
    TB.tag_columns(df, {"notes.n": ["pii"], "name": ["pii", "hr"]}).write.parquet(root)
    back = spark.read.parquet(root)
    assert TB.protected_columns(back.schema) == ["name", "notes"]
    for granted, columns in [([], ["id"]), (["pii"], ["id", "notes"]), (["pii", "hr"], ["id", "name", "notes"])]:
        assert TB.scan_table_minus_protected(back, granted)[0].columns == columns


def test_fetch_database(spark):
    root = scratch_dir(spark, "fetchdb")
    db = "t_" + root[-12:]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    for name in ("launches", "cities", "users"):
        TB.tag_columns(spark.createDataFrame([(1, "s")], "id int, secret string"), {"secret": ["pii"]} if name == "cities" else {}) \
            .write.parquet(f"{root}/{name}")
        spark.catalog.createTable(f"{db}.{name}", path=f"{root}/{name}", source="parquet")
    got = TB.fetch_database(spark, db, pattern="launches|cities")
    assert sorted((r.entityType, r.secret) for r in got.records.collect()) == [("city", None), ("launche", "s")]
    assert got.skipped_tables == ["users"] and [e[:3] for e in got.errors] == [("scan_tables.protected", "cities", "ColumnDenied")]
    named = TB.fetch_database(spark, db, explicit=["users", "gone"], pattern="ignored")
    assert named.records.count() == 1 and [e[1:3] for e in named.errors] == [("gone", "AnalysisException")]
    with __import__("pytest").raises(ValueError):
        TB.fetch_database(spark, db, pattern="none")


def test_content_cache_full_mode_ignores_hits(spark):
    entries = spark.createDataFrame([("r", "a.md", "o1"), ("r", "b.md", "o2")], "repository string, path string, oid string")
    cache = spark.createDataFrame([("r", "a.md", "o1", "cached")], "repository string, path string, oid string, content string")
    hits, misses = J.content_cache_lookup(entries, cache)
    assert [r.content for r in hits.collect()] == ["cached"] and [r.path for r in misses.collect()] == ["b.md"]
    hits, misses = J.content_cache_lookup(entries, cache, full_mode=True)
    assert hits.count() == 0 and misses.count() == 2


def test_resolve_external_groups(spark):
    principals = spark.createDataFrame([("external_group:eng",), ("plain-group",)], "group_id string")
    members = spark.createDataFrame([("eng", "a@x"), ("eng", "b@x")], "external_identity string, user_id string")
    got = sorted((r.group_id, r.member_user_id) for r in J.resolve_external_groups(principals, members).collect())
    assert got == [("external_group:eng", "a@x"), ("external_group:eng", "b@x"), ("plain-group", None)]

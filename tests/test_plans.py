"""Physical-plan properties the scale design relies on."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name, mode="formatted"):
    df = E.queries()[name](spark, SF)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_top_n_uses_partial_group_limit(spark):
    p = plan(spark, "newest_n_per_repo")
    assert "WindowGroupLimit" in p and p.count("WindowGroupLimit") >= 2  # partial before, final after exchange


def test_latest_wins_is_combined_map_side(spark):
    assert "partial_max_by" in plan(spark, "latest_per_id", "simple")


def test_checkpoint_filter_reaches_parquet(spark):
    p = plan(spark, "incremental_slice")
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_protected_column_is_never_read(spark):
    p = plan(spark, "scan_table_minus_protected")
    assert "c_acctbal" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_pattern_match_needs_no_join(spark):
    p = plan(spark, "match_repositories", "simple")
    assert "Join" not in p and "NestedLoop" not in p


@pytest.mark.parametrize("name", ["visible_to", "run_report", "upload_summary", "expand_groups",
                                  "map_repository_acl", "attach_repository_acl", "take_until_seen"])
def test_no_cross_joins(spark, name):
    p = plan(spark, name, "simple")
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p

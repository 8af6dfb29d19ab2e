"""Records whose keys change type: columns and properties by the value's own type."""

import json

import pytest
from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.operators import aggregates as AG
from quillspark.operators import project as P
from quillspark.sources import mixed as MX

RECORDS = [
    {"entityType": "initiative", "id": 101, "title": "A", "private": True, "allowedUsers": ["a@x", "b@x"], "hierarchyTeam": ["Core", "Feed"],
     "links": [{"address": "https://e/1", "name": "Spec"}], "activeQuarters": [], "decisions": {}, "startDate": "2026-10-01", "updatedAt": 5},
    {"entityType": "person", "id": "p@x", "private": 0, "email": "p@x", "positionId": 9001, "employeeId": "E1", "hierarchyTeam": "Infra",
     "specialties": ["Py", "Sys"], "level": 0, "interactions": {"numLikes": "7", "numViews": 2.0, "numComments": "many"}, "updatedAt": "6"},
    {"entityType": "launch", "id": "801", "private": "false", "ownerEmail": "o@x", "commitmentIds": [1, "commitment-2"], "platforms": "iOS",
     "links": ["https://e/2", {"url": "u", "name": "n"}], "reviews": [], "interactions": {}, "createdAt": "2026-01-01"},
    {"entityType": "commitment", "id": 5, "private": None, "isClosedOut": False, "quarter": 3, "pillar": 2.5, "statusHistory": [{"a": None}],
     "responsibleUser": True, "note": {"x": 1}, "flag": False, "none": None, "empty": ""},
]


@pytest.fixture(scope="module")
def records(spark):
    lines = [(i, json.dumps(r)) for i, r in enumerate(RECORDS)] + [(90, "[1]"), (91, "no json {"), (92, None), (93, "3"), (94, "{}")]
    return MX.parse_records(spark.createDataFrame(lines, "_seq int, value string"))


def test_lines_that_are_no_objects_keep_their_text(records):
    bad = {r._seq: r._corrupt_record for r in records.where("_raw IS NULL").select("_seq", "_corrupt_record").collect()}
    assert bad == {90: "[1]", 91: "no json {", 92: None, 93: "3"}


def test_documents(records):
    e = P.finalize_documents(P.project_entities(MX.entity_columns(records.where("_raw IS NOT NULL")))).withColumn("acl", A.acl_summary("acl_info"))
    got = {r.id: r for r in e.collect()}
    props = {k: {p.name: p.value for p in r.envelope.customProperties} for k, r in got.items()}
    assert {k: r.acl for k, r in got.items()} == {"initiative-101": "user:a@x,user:b@x", "person-p_x": "PUBLIC", "launch-801": "user:o@x", "commitment-5": "PUBLIC"}
    assert props["initiative-101"] == {"startDate": "2026-10-01", "hierarchyTeam": '["Core","Feed"]', "linksJSONString": '[{"address":"https://e/1","name":"Spec"}]'}
    assert props["person-p_x"] == {"specialties": '["Py","Sys"]', "email": "p@x", "positionId": "9001", "employeeId": "E1", "level": "0", "hierarchyTeam": "Infra"}
    launch = props["launch-801"]
    assert launch["platforms"] == "iOS" and json.loads(launch["commitmentID"]) == ["commitment-1", "commitment-2"]
    assert [json.loads(x) for x in json.loads(launch["links"])] == ["https://e/2", {"name": "n", "url": "u"}]
    assert props["commitment-5"] == {"responsibleUser": "True", "quarter": "3", "pillar": "2.5", "isClosedOut": "False", "statusHistoryJsonString": '[{"a":null}]'}
    inter = got["person-p_x"].envelope.interactions
    assert (inter.numLikes, inter.numComments, inter.numViews) == (7, 0, 2) and got["launch-801"].envelope.interactions is None
    assert [got[k].envelope.updatedAt for k in ("initiative-101", "person-p_x")] == [5, 6] and got["launch-801"].envelope.createdAt is None


def test_drift_sees_each_type(records):
    r = records.where("_raw IS NOT NULL").select(F.to_json("_raw").alias("_raw"), MX.value_at(F.col("_raw"), "entityType", "string").alias("entityType"))
    got = sorted(tuple(x) for x in AG.schema_drift(r.where("entityType IS NOT NULL"), P.ENTITY_KEYS).collect())
    assert got == [("commitment", "flag", "bool"), ("commitment", "note", "dict")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_record_is_parsed_and_taken_apart_once(records):
    e = P.finalize_documents(P.project_entities(MX.entity_columns(records.where("_raw IS NOT NULL"))))
    plan = _plan(e)
    assert plan.count("parseJson") == 1 and "$.entityType" not in plan


def test_drift_of_variants_drops_expected_keys_before_any_shuffle(records):
    r = records.where("_raw IS NOT NULL").select("_raw", MX.value_at(F.col("_raw"), "entityType", "string").alias("entityType"))
    drift = AG.schema_drift(r.where("entityType IS NOT NULL"), P.ENTITY_KEYS)
    assert sorted(tuple(x) for x in drift.collect()) == [("commitment", "flag", "bool"), ("commitment", "note", "dict")]
    plan = _plan(AG.schema_drift(r.where("entityType IS NOT NULL"), P.ENTITY_KEYS))
    assert "Join" not in plan and "from_json" not in plan


def test_an_object_after_white_space(spark):
    rows = MX.parse_records(spark.createDataFrame([(1, ' \t{"a": 1}'), (2, "{"), (3, " []")], "_seq int, value string"))
    assert [(r._seq, r._raw is None, r._corrupt_record) for r in rows.orderBy("_seq").collect()] == [(1, False, None), (2, True, "{"), (3, True, " []")]

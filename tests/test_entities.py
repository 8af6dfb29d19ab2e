"""Entity rows -> documents: the reference's fixture counts (17 rows -> 11 documents ->
7 ids) and visibility recomputed from its ACLs (5 public, lead.one 6, exec.one 5)."""

from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.operators import aggregates as AG
from quillspark.operators import filters as FL
from quillspark.operators import joins as J
from quillspark.operators import ordering as O
from quillspark.operators import project as P

SCHEMA = ("scenario string, entityType string, action string, id string, title string, private boolean, "
          "allowedUsers array<string>, allowedGroups array<string>, ownerEmail string, updatedAt bigint, "
          "_seq int, email string")
INTERNAL = "internal.author@example.com"
ROWS = [
    ("initiative_private_full", "initiative", None, "101", "I", True, ["lead.one@example.com", "exec.one@example.com"],
     ["external_group:pillar-growth-leads"], "lead.one@example.com", 1762676400, 1, None),
    ("initiative_public_minimal", "initiative", None, "102", "I2", False, [], None, INTERNAL, 1762237200, 2, None),
    ("commitment_private_at_risk", "commitment", None, "501", "C", True,
     ["owner.commitment@example.com", "accountable.commitment@example.com"], None, "owner.commitment@example.com",
     1762586400, 3, None),
    ("commitment_public_closed_out", "commitment", None, "502", "C2", False, [], None, INTERNAL, 1762064400, 4, None),
    ("launch_private_full", "launch", None, "801", "L", True, ["owner.launch@example.com", "reviewer.security@example.com"],
     None, "owner.launch@example.com", 1762669200, 5, None),
    ("launch_public_minimal", "launch", None, "802", "L2", False, [], None, INTERNAL, 1761723600, 6, None),
    ("person_full", "person", None, "9001", "P", False, [], None, "engineer.one@example.com", 1762586400, 7,
     "engineer.one@example.com"),
    ("initiative_update", "initiative", "update", "101", "I'", True, ["lead.one@example.com"], None,
     "lead.one@example.com", 1762762800, 8, None),
    ("commitment_update", "commitment", "update", "501", "C'", False, [], None, "owner.commitment@example.com",
     1762762800, 9, None),
    ("launch_update", "launch", "update", "801", "L'", True, ["owner.launch@example.com"], None,
     "owner.launch@example.com", 1762762800, 10, None),
    ("person_update", "person", "update", "9001", "P'", False, [], None, "engineer.one@example.com", 1762762800, 11,
     "engineer.one@example.com"),
    ("initiative_delete", "initiative", "delete", "101", None, None, None, None, None, None, 12, None),
    ("commitment_delete", "commitment", "delete", "501", None, None, None, None, None, None, 13, None),
    ("launch_delete", "launch", "delete", "801", None, None, None, None, None, None, 14, None),
    ("person_delete", "person", "delete", "9001", None, None, None, None, None, None, 15, None),
    ("indexed_active_user", "user", None, "lead.one@example.com", None, None, None, None, None, None, 16, None),
    ("indexed_inactive_user", "user", None, "former.user@example.com", None, None, None, None, None, None, 17, None),
]
KNOWN = list(P.ENTITY_OBJECT_TYPES)


def documents(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    kept = FL.drop_unmapped_entities(FL.drop_deletes(rows), KNOWN)
    return rows, P.finalize_documents(P.project_entities(kept, KNOWN))


def test_emitted_and_unique_counts(spark):
    rows, docs = documents(spark)
    assert docs.count() == 11
    latest = O.latest_per_id(docs.withColumn("_u", F.col("envelope")["updatedAt"]), "id", [F.col("_u"), F.col("_seq")])
    assert latest.count() == 7
    assert [r.entity_type for r in AG.unmapped_entities(rows, KNOWN).collect()] == ["user"]


def test_visibility_recomputed(spark):
    _rows, docs = documents(spark)
    latest = O.latest_per_id(docs.withColumn("_u", F.col("envelope")["updatedAt"]), "id", [F.col("_u"), F.col("_seq")])
    users = spark.createDataFrame([("lead.one@example.com", []), ("exec.one@example.com", []), ("nobody@example.com", [])],
                                  "user_id string, groups array<string>")
    got = {r.user_id: r.visible for r in J.visible_counts(latest, users).collect()}
    assert got == {"lead.one@example.com": 6, "exec.one@example.com": 5, "nobody@example.com": 5}
    assert J.visible_to(latest, []).count() == 5


def test_visibility_through_groups_counts_once(spark):
    docs = spark.createDataFrame([("d1", ["u1"], ["g1"]), ("d2", [], ["g1", "g2"]), ("d3", ["u2"], []), ("d4", [], [])],
                                 "id string, users array<string>, groups array<string>")
    docs = docs.select("id", A.acl_from_row(F.lit(True), "users", "groups", F.lit(None).cast("string")).alias("acl_info"))
    docs = docs.unionByName(docs.sparkSession.createDataFrame([("p1",)], "id string").select("id", A.public_acl().alias("acl_info")))
    users = docs.sparkSession.createDataFrame([("u1", ["g1", "g2"]), ("u2", ["g2"]), ("u3", [])],
                                              "user_id string, groups array<string>")
    got = {r.user_id: r.visible for r in J.visible_counts(docs, users).collect()}
    # brute force: u1 -> p1, d1, d2; u2 -> p1, d2, d3; u3 -> p1 (d4 grants nobody)
    assert got == {"u1": 3, "u2": 3, "u3": 1}


def test_envelope_shape(spark):
    _rows, docs = documents(spark)
    person = docs.filter(F.col("entityType") == "person").orderBy("_seq").first()
    env = person.envelope
    assert person.id == "person-9001" and env.objectType == "OrgData"
    assert env.permissions.allowAnonymousAccess is True and env.author.email == "engineer.one@example.com"
    init = docs.filter(F.col("_seq") == 1).first()
    assert init.envelope.viewURL == "https://entities.example.com/programs/101"
    perms = init.envelope.permissions
    assert perms.allowAnonymousAccess is False and [u.email for u in perms.allowedUsers] == [
        "lead.one@example.com", "exec.one@example.com"]


def test_private_without_principals_dropped_and_reported(spark):
    rows = spark.createDataFrame([("commitment", None, "7", "t", True, [], None, None, 1, 1, None)],
                                 "entityType string, action string, id string, title string, private boolean, "
                                 "allowedUsers array<string>, allowedGroups array<string>, ownerEmail string, "
                                 "updatedAt bigint, _seq int, email string")
    assert P.finalize_documents(P.project_entities(rows, KNOWN)).count() == 0


def test_schema_drift_typed(spark):
    rows = spark.createDataFrame([("initiative", "x", None, 1.5), ("person", "", "t", None)],
                                 "entityType string, newCol string, quarter string, price double")
    got = sorted(tuple(r) for r in AG.schema_drift_typed(rows, P.ENTITY_KEYS).collect())
    assert got == [("initiative", "newCol", "str"), ("initiative", "price", "float"), ("person", "quarter", "str")]


def test_schema_drift_raw_json(spark):
    rows = spark.createDataFrame([("initiative", '{"id": 1, "k": 3, "e": "", "l": [], "quarter": "Q1"}')],
                                 "entityType string, _raw string")
    got = sorted(tuple(r) for r in AG.schema_drift(rows, P.ENTITY_KEYS).collect())
    assert got == [("initiative", "k", "int"), ("initiative", "quarter", "str")]

"""Identity mapping (J5, J6, J8, J10, J13), state table (I1-I5) and sync mode (I4)."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.operators import aggregates as AG
from quillspark.operators import joins as J
from quillspark.operators import state as ST


def test_commit_mining_golden(spark):
    logins = spark.createDataFrame([("Acme/test-repo", 1, "user-a"), ("Acme/test-repo", 2, "user-b")],
                                   "repository string, pos int, login string")
    commits = spark.createDataFrame([("Acme/test-repo", 1, "user-a", "user-a@acme.example")],
                                    "repository string, pos int, login string, email string")
    got = [r.email for r in J.mine_login_emails(logins, commits).orderBy("pos").collect()]
    assert got == ["user-a@acme.example", None]


def test_commit_mining_window_and_oldest(spark):
    rows = [("r", i, "u", f"u{i}@x") for i in range(1, 61)] + [("r", 61, "v", "v@x")]
    commits = spark.createDataFrame(rows, "repository string, pos int, login string, email string")
    logins = spark.createDataFrame([("r", 1, "u"), ("r", 2, "v")], "repository string, pos int, login string")
    got = {r.login: r.email for r in J.mine_login_emails(logins, commits, window=50).collect()}
    # the oldest e-mail inside the newest-50 window; commits beyond the window are not seen
    assert got == {"u": "u50@x", "v": None}


def test_domain_pass_through(spark):
    df = spark.createDataFrame([("sandra_martinez",), ("admin",), (None,)], "login string")
    got = [r[0] for r in df.select(J.domain_emails("login", "@corp.example")).collect()]
    assert got == ["sandra_martinez@corp.example", "admin@corp.example", None]
    with pytest.raises(ValueError):
        J.domain_emails("login", "   ")


def test_unified_policy_golden(spark):
    groups, mappings = J.policy_frames(
        spark,
        {"mygroup1": ["email1@email.com", "email2@email.com"], "mygroup2": ["default-audit@email.com"]},
        [{"repository": "Acme/repo-1", "permissions": {"groups": ["mygroup1"], "emails": ["extra@email.com"]}},
         {"repository": "Acme/repo-public", "isPublic": True},
         {"repository": "*", "permissions": {"groups": ["mygroup2"]}}])
    readers = J.expand_groups(groups, mappings)
    repos = spark.createDataFrame([("Acme/repo-1",), ("acme/repo-1",), ("Acme/repo-public",),
                                   ("Acme/some-other-repo",)], "repository string")
    got = {r.repository: r.readers for r in J.map_repository_acl(repos, readers).collect()}
    assert got["Acme/repo-1"] == ["email1@email.com", "email2@email.com", "extra@email.com"]
    assert got["acme/repo-1"] == ["email1@email.com", "email2@email.com", "extra@email.com"]
    assert got["Acme/repo-public"] == ["allUsers"]
    assert got["Acme/some-other-repo"] == ["default-audit@email.com"]
    acl = J.attach_repository_acl(repos, J.map_repository_acl(repos, readers).select("repository", "readers"))
    public = {r.repository: r.a for r in acl.select("repository", A.acl_summary("acl_info").alias("a")).collect()}
    assert public["Acme/repo-public"] == "PUBLIC"


def test_resolve_repo_readers_and_contributors(spark):
    collab = spark.createDataFrame([("r", i, f"l{i}") for i in range(1, 105)], "repository string, pos int, login string")
    mapper = lambda df: df.select("repository", "pos", F.when(F.col("pos") % 2 == 0, F.concat("login", F.lit("@x")))  # noqa
                                  .alias("email"))
    r = J.resolve_repo_readers(collab, mapper).first()
    assert r.readers[:2] == ["l2@x", "l4@x"] and len(r.readers) == 52  # all of them
    assert len(J.resolve_repo_readers(collab, mapper, limit=100).first().readers) == 50
    many = spark.createDataFrame([("r", i, "l", f"a{i}@x") for i in range(1, 151)],
                                 "repository string, pos int, login string, email string")
    assert len(AG.repo_contributors(many).first().contributors) == 150
    one = spark.createDataFrame([("r", 1, "l")], "repository string, pos int, login string")
    assert J.mine_login_emails(one, many).first().email == "a150@x"
    commits = spark.createDataFrame([("r", 1, "b@x"), ("r", 2, "a@x"), ("r", 3, "nope"), ("r", 4, "a@x")],
                                    "repository string, pos int, email string")
    assert AG.repo_contributors(commits).first().contributors == ["a@x", "b@x"]


def test_state_miss_hit_expiry_clear(spark):
    empty = spark.createDataFrame([], "key string, value string, expires_at double")
    s = ST.state_put(empty, spark.createDataFrame([("k1", "v1")], "key string, value string"), now=100.0,
                     ttl_seconds=10)
    probe = spark.createDataFrame([("k1",), ("k2",)], "k string")
    hit = {r.k: r.v for r in ST.state_get(probe, s, F.col("k"), now=105.0, value_col="v").collect()}
    assert hit == {"k1": "v1", "k2": None}
    expired = {r.k: r.v for r in ST.state_get(probe, s, F.col("k"), now=110.0, value_col="v").collect()}
    assert expired == {"k1": None, "k2": None}  # strict: now < expires_at
    assert ST.state_clear(s).count() == 0
    s2 = ST.state_put(s, spark.createDataFrame([("k1", "v2")], "key string, value string"), now=106.0, ttl_seconds=10)
    assert [(r.value, r.expires_at) for r in s2.collect()] == [("v2", 116.0)]


def test_commit_checkpoints_and_next(spark):
    emitted = spark.createDataFrame([("r1", "2024-01-02"), ("r1", "2024-01-05"), ("r2", "2024-01-01")],
                                    "repository string, updated_at string")
    nxt = AG.next_checkpoint(emitted)
    st = ST.commit_checkpoints(None, nxt, "prs", now=0.0)
    assert {r.key: r.value for r in st.collect()} == {"prs:r1": "2024-01-05", "prs:r2": "2024-01-01"}


def test_sync_mode_precedence():
    assert ST.sync_mode(None, {}, {}) == ST.SyncMode.INCREMENTAL
    assert ST.sync_mode("incremental", {"RECONCILIATION_MODE": "FULL"}) == ST.SyncMode.FULL
    assert ST.sync_mode(None, {}, {"reconciliation_mode": "full"}) == ST.SyncMode.FULL


def test_scale_conf_sizes_partitions():
    from quillspark.session import scale_conf
    conf = scale_conf(100 * 1024 ** 4, executors=1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2) + 1
    assert int(scale_conf(1024, executors=10)["spark.sql.shuffle.partitions"]) == 80


def test_policy_groups_as_list_and_scalar_member(spark):
    groups, mappings = J.policy_frames(
        spark, [{"g1": "solo@x"}, {"g2": ["a@x", "b@x"]}],
        [{"repository": "o/r", "permissions": [{"groups": ["g2", "g1", "nope"]}, {"emails": ["a@x", "c@x"]}]}])
    got = {r.repo_key: r.readers for r in J.expand_groups(groups, mappings).collect()}
    assert got == {"o/r": ["a@x", "b@x", "solo@x", "c@x"]}

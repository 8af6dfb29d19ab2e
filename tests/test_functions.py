"""Column functions C1-C17 against the reference's golden cases."""

from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.functions import scalars as S


def one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_sanitize_doc_id(spark):
    assert one(spark, S.sanitize_doc_id("x"), value="owner/repo:docs/a b.md") == "owner_repo_docs_a_b_md"
    assert one(spark, S.sanitize_doc_id("x"), value="ok-id_1") == "ok-id_1"


def test_extract_tickets_golden(spark):
    cases = {"Fix GEP-123": ["GEP-123"], "CC-456 GEP-123 CC-456": ["CC-456", "GEP-123"],
             "Invalid GEP-abc, 123-GEP": [], None: [], "": []}
    for text, expected in cases.items():
        assert one(spark, S.extract_tickets("x"), value=text) == expected


def test_web_base_url(spark):
    assert one(spark, S.web_base_url("x"), value="https://api.github.com") == "https://github.com"
    assert one(spark, S.web_base_url("x"), value="https://git.corp/api/v3") == "https://git.corp"
    assert one(spark, S.web_base_url("x"), value="https://git.corp/api/v3/") == "https://git.corp"


def test_int_or_null(spark):
    assert one(spark, S.int_or_null("x"), value="12") == 12
    assert one(spark, S.int_or_null("x"), value="12.5") is None
    assert one(spark, S.int_or_null("x"), value="2024-01-01T00:00:00") is None
    assert one(spark, S.int_or_null("x"), "x double", 12.9) == 12


def test_prefix_id_is_idempotent(spark):
    assert one(spark, S.prefix_id("commitment", "x"), value="501") == "commitment-501"
    assert one(spark, S.prefix_id("commitment", "x"), value="commitment-501") == "commitment-501"


def test_iso_datetime(spark):
    assert one(spark, S.iso_datetime(F.col("x").cast("timestamp")), value="2024-01-01 10:00:00") == "2024-01-01T10:00:00"
    assert (one(spark, S.iso_datetime(F.col("x").cast("timestamp")), value="2024-01-01 10:00:00.5")
            == "2024-01-01T10:00:00.500000")


def test_base64_and_text_codec(spark):
    assert one(spark, S.base64_decode("x"), value="JVBERi0x") == bytearray(b"%PDF-1")
    assert one(spark, S.base64_decode("x"), value="!!not base64") is None
    assert one(spark, S.decode_text(S.encode_text("x")), value="héllo") == "héllo"
    assert one(spark, S.decode_text("x"), "x binary", bytearray(b"a\xffb")) == "a�b"


def test_basename_and_repo_split(spark):
    assert one(spark, S.basename("x"), value="docs/guide.txt") == "guide.txt"
    assert one(spark, S.repo_owner("x"), value="owner/repo/x") == "owner"
    assert one(spark, S.repo_name("x"), value="owner/repo/x") == "repo/x"


def test_config_hash(spark):
    import hashlib
    assert one(spark, S.config_hash("x"), value='{"a":1}') == hashlib.sha256(b'{"a":1}').hexdigest()[:16]


def test_singularize(spark):
    cases = {"launches": "launche", "houses": "hous", "commitments": "commitment", "stories": "story",
             "s": "s", "ies": "ie", "person": "person"}
    for word, expected in cases.items():
        assert one(spark, S.singularize("x"), value=word) == expected


def test_acl_from_principals(spark):
    df = spark.createDataFrame([(["a@x.com", "b@x.com"],), (["a@x.com", "allUsers"],), ([],), (None,)],
                               "e array<string>")
    got = [r[0] for r in df.select(A.acl_summary(A.acl_from_emails("e"))).collect()]
    assert got == ["user:a@x.com,user:b@x.com", "PUBLIC", None, None]


def test_acl_from_permissions(spark):
    df = spark.createDataFrame([
        ([("u1@x.com", "user"), ("u2@x.com", None), ("g@x.com", "group"), (None, "user"), ("", "user")],),
        ([("allUsers", "group")],),
        ([],)], "p array<struct<email:string,type:string>>")
    got = [r[0] for r in df.select(A.acl_summary(A.acl_from_permissions("p"))).collect()]
    assert got == ["user:u1@x.com,user:u2@x.com,group:g@x.com", "PUBLIC", None]


def test_acl_from_row_owner_fallback_and_drop(spark):
    df = spark.createDataFrame([
        (False, None, None, None),
        (True, ["a@x"], ["external_group:g"], "o@x"),
        (True, [], None, "o@x"),
        (True, [], None, None),
        (None, None, None, None),
    ], "private boolean, users array<string>, groups array<string>, owner string")
    got = [r[0] for r in df.select(A.acl_summary(A.acl_from_row("private", "users", "groups", "owner"))).collect()]
    assert got == ["PUBLIC", "user:a@x,group:external_group:g", "user:o@x", None, "PUBLIC"]


def test_permissions_block(spark):
    df = spark.createDataFrame([(True, ["a@x"], []), (False, ["a@x"], ["g"])],
                               "private boolean, users array<string>, groups array<string>")
    rows = df.select(A.permissions_block("private", "users", "groups").alias("p")).collect()
    assert rows[0].p.allowAnonymousAccess is False and rows[0].p.allowedUsers[0].email == "a@x"
    assert rows[0].p.allowedGroups is None
    assert rows[1].p.allowAnonymousAccess is True and rows[1].p.allowedUsers is None


def test_thread_lines_null_handling(spark):
    df = spark.createDataFrame(
        [([("2024-01-01", "hi", ("ann",)), (None, None, (None,)), ("d", "x", None)],)],
        "c array<struct<createdAt:string,body:string,author:struct<login:string>>>")
    got = df.select(S.thread_lines("c").alias("l")).first().l
    assert got == ["- [2024-01-01] ann: hi", "- [] anonymous: ", "- [d] anonymous: x"]
    reviews = spark.createDataFrame([([("t", "ok", "APPROVED", ("bob",))],)],
                                    "r array<struct<createdAt:string,body:string,state:string,author:struct<login:string>>>")
    assert reviews.select(S.thread_lines("r", with_state=True)).first()[0] == ["- [t] bob (APPROVED): ok"]


def test_author_rules(spark):
    df = spark.createDataFrame([("sso@x", "p@x", "lg"), ("", "p@x", "lg"), (None, None, "lg"), (None, None, None)],
                               "n string, e string, l string")
    got = [tuple(r) for r in df.select(S.author_email("n", "e"), S.author_display(S.author_email("n", "e"), "l")).collect()]
    assert got == [("sso@x", "sso@x"), ("p@x", "p@x"), (None, "lg"), (None, "Unknown")]

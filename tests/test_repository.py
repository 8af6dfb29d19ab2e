"""Repository files (F4-F7, S6), patterns (J1, J2) and discussion text."""

from pyspark.sql import functions as F

from quillspark.operators import filters as FL
from quillspark.operators import joins as J
from quillspark.operators import project as P
from quillspark.sources import files as SF

TREE = [("owner/repo-a", "main", "README.md", "blob", "oid-readme"),
        ("owner/repo-a", "main", "main.py", "blob", "oid-mainpy"),
        ("owner/repo-a", "main", "docs/guide.txt", "blob", "oid-guide"),
        ("owner/repo-a", "main", "docs/unsupported.png", "blob", "oid-png"),
        ("owner/repo-a", "main", "node_modules/x/readme.md", "blob", "oid-nm"),
        ("owner/repo-a", "main", "src/notes.md", "blob", "oid-src"),
        ("owner/repo-a", "main", "pkg.bin/inner.md", "blob", "oid-binDir"),
        ("owner/repo-a", "main", "deep/a/node_modules/b.md", "blob", "oid-deep")]
BLOBS = [("owner/repo-a", p, oid, "text of " + p, False, 10) for (_, _, p, _, oid) in TREE]


def frames(spark):
    entries = spark.createDataFrame(TREE, "repository string, branch string, path string, type string, oid string")
    blobs = spark.createDataFrame(BLOBS, "repository string, path string, oid string, text string, "
                                         "isBinary boolean, byteSize bigint")
    return entries, blobs


def test_scan_repo_files_defaults(spark):
    entries, blobs = frames(spark)
    out = SF.scan_repo_files(entries, blobs, exclude_paths=["node_modules/", ".git/"],
                             include_extensions=[".md", ".txt"])
    paths = {r.path for r in out.collect()}
    # A directory named like an excluded extension prunes its subtree.
    assert paths == {"README.md", "docs/guide.txt", "src/notes.md"}
    readme = out.filter(F.col("path") == "README.md").first()
    assert readme.id == "owner/repo-a:README.md" and readme.content == "text of README.md"


def test_scan_repo_files_include_paths(spark):
    entries, blobs = frames(spark)
    out = SF.scan_repo_files(entries, blobs, include_paths=["docs/", "README.md"],
                             exclude_paths=["node_modules/", ".git/"], include_extensions=[".md", ".txt"])
    assert {r.path for r in out.collect()} == {"README.md", "docs/guide.txt"}


def test_dir_traversable(spark):
    df = spark.createDataFrame([("src",), ("docs",), ("node_modules",), ("a",)], "d string")
    got = {r.d: r.t for r in df.select("d", FL.dir_traversable("d", ["docs/", "a/b"]).alias("t")).collect()}
    assert got == {"src": False, "docs": True, "node_modules": False, "a": True}


def test_drop_binary(spark):
    entries, blobs = frames(spark)
    blobs = blobs.withColumn("isBinary", F.col("path") == "README.md")
    out = SF.scan_repo_files(entries, blobs, exclude_paths=["node_modules/"], include_extensions=[".md", ".txt"])
    assert "README.md" not in {r.path for r in out.collect()}


def test_match_repositories_golden(spark):
    repos = spark.createDataFrame([("Acme/demo-app",), ("Acme/connectors",),
                                   ("Acme/test_bot",), ("OtherOrg/other-repo",)], "name string")
    pats = [("^Acme/demo-app", "master"), ("^Acme/connectors", "develop"), ("(?P<o>Acme)/", "python-only"),
            ("^Acme/.*", "main"), ("(", "bad")]
    got = {r.name: r.branch for r in J.match_repositories(repos, pats).collect()}
    assert got == {"Acme/demo-app": "master", "Acme/connectors": "develop",
                   "Acme/test_bot": "main"}
    assert J.single_repository("Acme/test_bot:master") == ("Acme/test_bot", "master")


def test_resolve_branch(spark):
    t = spark.createDataFrame([("a/x", "HEAD"), ("a/y", "HEAD"), ("a/z", "dev")], "repository string, branch string")
    d = spark.createDataFrame([("a/x", "main")], "repository string, default_branch string")
    got = {r.repository: r.branch for r in J.resolve_branch(t, d).collect()}
    assert got == {"a/x": "main", "a/z": "dev"}


PR_SCHEMA = ("type string, id string, number bigint, title string, body string, state string, created_at string, "
             "updated_at string, author struct<login:string,email:string>, "
             "comments array<struct<createdAt:string,body:string,author:struct<login:string>>>, "
             "reviews array<struct<createdAt:string,body:string,state:string,author:struct<login:string>>>, "
             "repository string")


def test_pull_request_document_tickets_and_text(spark):
    pr = spark.createDataFrame([("pull_request", "pr-1", 42, "Fix GEP-789 ticket", "Resolves issue described in GEP-123.",
                                 "OPEN", "2026-06-09T00:00:00Z", None, ("author-user", "author@acme.example"),
                                 [("2026-06-09T01:00:00Z", "This also touches CC-456.", ("commenter",))],
                                 [("2026-06-09T02:00:00Z", "LGTM XY-9", "APPROVED", (None,))],
                                 "Acme/test-repo")], PR_SCHEMA)
    doc = P.project_pull_request_document(pr).first()
    assert doc.struct_data.jiraTickets == ["CC-456", "GEP-123", "GEP-789"]
    assert doc.text.splitlines()[:4] == ["PULL REQUEST #42: Fix GEP-789 ticket", "State: OPEN",
                                         "Author: author@acme.example", "Created At: 2026-06-09T00:00:00Z"]
    assert "- [2026-06-09T01:00:00Z] commenter: This also touches CC-456." in doc.text
    assert doc.text.endswith("- [2026-06-09T02:00:00Z] anonymous (APPROVED): LGTM XY-9")
    assert doc.struct_data.sourceUrl == "https://github.com/Acme/test-repo/pull/42"


def test_commit_document(spark):
    c = spark.createDataFrame([("commit-1", "sha-123456", "GEP-101: Initial commit for CC-202", "2026-06-09T00:00:00Z",
                                ("Author Name", "author@acme.example", ("author",)), "Acme/test-repo")],
                              "id string, sha string, message string, committed_date string, "
                              "author struct<name:string,email:string,user:struct<login:string>>, repository string")
    doc = P.project_commit_document(c).first()
    assert doc.struct_data.jiraTickets == ["CC-202", "GEP-101"]
    assert doc.text.split("\n")[1] == "Author: Author Name <author@acme.example>"


def test_route_discussion_drops_unknown(spark):
    df = spark.createDataFrame([("pull_request",), ("issue",), ("commit",), ("wiki",)], "type string")
    got = sorted(r.discussion_type for r in P.route_discussion(df).collect())
    assert got == ["discussion_commit", "discussion_issue", "discussion_pr"]

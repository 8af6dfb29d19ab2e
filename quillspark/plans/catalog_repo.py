"""Registered queries over repository-shaped data: files (pages), discussions
(conversations), commit histories (events), reader resolution and sync state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import acl as A
from quillspark.functions import scalars as S
from quillspark.operators import aggregates as AG
from quillspark.operators import filters as FL
from quillspark.operators import joins as J
from quillspark.operators import ordering as O
from quillspark.operators import project as P
from quillspark.operators import state as ST
from quillspark.operators import tree as TR
from quillspark.plans import bindings as B
from quillspark.plans.catalog import SQL_COMMITS, SQL_CUSTOMER_EMAIL, SQL_PAGES, _t, query, shared
from quillspark.session import scratch_dir
from quillspark.sources import files as SF
from quillspark.streaming import state as SS

# ---------------------------------------------------------------- repository files (pages)

EXCLUDE_PATHS = FL.DEFAULT_EXCLUDE_PATHS + ["es/"]
INCLUDE_PATHS = ["en/", "fr/"]

SQL_EXCL_EXT = r"(\.png|\.jpg|\.jpeg|\.gif|\.pdf|\.zip|\.gz|\.tar|\.lock|\.log|\.exe|\.bin)$"
SQL_EXCL_DIR = r"(^|/)(node_modules|\.venv|venv|\.git|dist|build|bin|es)(/|$)"
SQL_INCL_EXT = r"(\.md|\.markdown|\.txt|\.html|\.htm)$"


def _sql_excluded(p: str) -> str:
    return f"(regexp_matches(lower({p}), '{SQL_EXCL_EXT}') OR regexp_matches({p}, '{SQL_EXCL_DIR}'))"


_SQL_PREFIX_I = "array_to_string(string_split(path, '/')[1:i], '/')"
SQL_PATH_EXCLUDED = ("len(list_filter(generate_series(1, len(string_split(path, '/'))), "
                     f"lambda i: {_sql_excluded(_SQL_PREFIX_I)})) > 0")
SQL_PATH_INCLUDED = (f"(regexp_matches(lower(path), '{SQL_INCL_EXT}') OR lower(list_last(string_split(path, '/'))) = 'readme'"
                     " OR starts_with(lower(list_last(string_split(path, '/'))), 'readme.'))")


@shared
def files(spark: SparkSession, sf: str) -> DataFrame:
    pages = _t(spark, sf, "pages")
    return SF.scan_repo_files(B.repo_entries(pages), B.repo_blobs(pages), exclude_paths=EXCLUDE_PATHS)


@query("scan_repo_files", f"""
SELECT repository || ':' || path AS id, path, oid, byte_size, repository, 'main' AS branch
FROM ({SQL_PAGES}) WHERE NOT is_binary AND {SQL_PATH_INCLUDED} AND NOT ({SQL_PATH_EXCLUDED})
""")
def q_scan_files(spark, sf):
    """S6 (+F4-F7): tree entries filtered, joined to blobs, binary blobs dropped."""
    return files(spark, sf).select("id", "path", "oid", "byte_size", "repository", "branch")


@query("path_excluded", f"""
SELECT page_id, path, {SQL_PATH_EXCLUDED} AS excluded FROM ({SQL_PAGES})
""")
def q_path_excluded(spark, sf):
    """excluded when the path or any ancestor directory is excluded."""
    e = B.repo_entries(_t(spark, sf, "pages"))
    return e.select("page_id", "path", FL.path_excluded("path", FL.DEFAULT_EXCLUDE_EXTENSIONS, EXCLUDE_PATHS)
                    .alias("excluded"))


@query("path_included", f"""
SELECT page_id, path,
       (lower(path) IN ('en', 'fr') OR starts_with(lower(path), 'en/') OR starts_with(lower(path), 'fr/'))
       AND {SQL_PATH_INCLUDED} AS included
FROM ({SQL_PAGES})
""")
def q_path_included(spark, sf):
    """under an include path, then README name or whitelisted extension."""
    e = B.repo_entries(_t(spark, sf, "pages"))
    return e.select("page_id", "path", FL.path_included("path", INCLUDE_PATHS).alias("included"))


@query("dir_traversable", f"""
SELECT page_id, dir,
       NOT {_sql_excluded('dir')} AND (lower(dir) IN ('en', 'fr') OR starts_with(lower(dir), 'en/')
       OR starts_with(lower(dir), 'fr/') OR starts_with('en', lower(dir) || '/') OR starts_with('fr', lower(dir) || '/'))
       AS traversable
FROM (SELECT page_id, regexp_replace(path, '/[^/]*$', '') AS dir FROM ({SQL_PAGES}) WHERE contains(path, '/'))
""")
def q_dir_traversable(spark, sf):
    """the parent directory of each file: not excluded and inside (or above) an include path."""
    e = B.repo_entries(_t(spark, sf, "pages")).filter(F.col("path").contains("/"))
    d = e.select("page_id", F.regexp_replace("path", "/[^/]*$", "").alias("dir"))
    return d.select("page_id", "dir", FL.dir_traversable("dir", INCLUDE_PATHS, FL.DEFAULT_EXCLUDE_EXTENSIONS,
                                                          EXCLUDE_PATHS).alias("traversable"))


@query("drop_binary", f"""
SELECT page_id, path FROM ({SQL_PAGES}) WHERE NOT is_binary
""")
def q_drop_binary(spark, sf):
    """binary blobs skipped."""
    pages = _t(spark, sf, "pages")
    blobs = pages.select("page_id", F.col("url").contains("?").alias("isBinary"),
                         B.page_path(F.col("url")).alias("path"))
    return FL.drop_binary(blobs).select("page_id", "path")


@query("content_cache_lookup", f"""
SELECT page_id, CASE WHEN contains(url, '#') THEN 'miss' ELSE 'hit' END AS status FROM ({SQL_PAGES})
""")
def q_cache(spark, sf):
    """(repository, path, oid) against a cache written by an earlier run in which
    pages with a fragment had other content; hits re-emit cached records, misses are fetched."""
    pages = _t(spark, sf, "pages")
    entries = B.repo_entries(pages)
    cache = (pages.select(B.page_repository(F.col("url")).alias("repository"), B.page_path(F.col("url")).alias("path"),
                          F.when(F.col("url").contains("#"), F.sha2(F.concat("html", F.lit("v0")), 256))
                          .otherwise(F.sha2("html", 256)).alias("oid"), F.col("page_id").alias("cached_page"))
             .dropDuplicates(["repository", "path", "oid"]))
    hits, misses = J.content_cache_lookup(entries, cache)
    hit_ids = hits.select(F.col("cached_page").alias("page_id"), F.lit("hit").alias("status"))
    return hit_ids.unionByName(misses.select("page_id", F.lit("miss").alias("status")))


REPO_PATTERNS = [("blog/th", "develop"), ("m/", "mobile"), ("www/", None), ("th", None), ("[", "broken")]

# Written by hand: the broken pattern is skipped, a missing branch is HEAD.
SQL_CASE_PATTERNS = """
CASE WHEN starts_with(repository, 'blog/th') THEN 'develop' WHEN starts_with(repository, 'm/') THEN 'mobile'
     WHEN starts_with(repository, 'www/') THEN 'HEAD' WHEN starts_with(repository, 'th') THEN 'HEAD' END
"""


@query("match_repositories", f"""
SELECT repository, branch FROM (SELECT DISTINCT repository, {SQL_CASE_PATTERNS} AS branch FROM ({SQL_PAGES}))
WHERE branch IS NOT NULL
""")
def q_match_repos(spark, sf):
    """Ordered, start-anchored patterns; first match supplies the branch; an invalid
    pattern is skipped."""
    repos = B.repo_entries(_t(spark, sf, "pages")).select("repository").distinct()
    return J.match_repositories(repos, REPO_PATTERNS, "repository")


@query("resolve_branch", f"""
WITH m AS (SELECT DISTINCT repository, host, {SQL_CASE_PATTERNS} AS branch FROM ({SQL_PAGES})),
d AS (SELECT repository, CASE WHEN suffix(host, '.com') THEN 'trunk' WHEN suffix(host, '.net') THEN 'main' END
      AS default_branch FROM m)
SELECT m.repository, CASE WHEN m.branch = 'HEAD' THEN d.default_branch ELSE m.branch END AS branch
FROM m JOIN d ON m.repository = d.repository
WHERE m.branch IS NOT NULL AND (CASE WHEN m.branch = 'HEAD' THEN d.default_branch ELSE m.branch END) IS NOT NULL
""")
def q_resolve_branch(spark, sf):
    """HEAD replaced by the repository's default branch; unresolvable -> skipped."""
    pages = _t(spark, sf, "pages")
    repos = pages.select(B.page_repository(F.col("url")).alias("repository"), B.page_host(F.col("url")).alias("host")).distinct()
    targets = J.match_repositories(repos.select("repository"), REPO_PATTERNS, "repository")
    defaults = repos.select("repository", F.when(F.col("host").endswith(".com"), F.lit("trunk"))
                            .when(F.col("host").endswith(".net"), F.lit("main")).alias("default_branch"))
    return J.resolve_branch(targets, defaults).select("repository", "branch")


@query("breadth_first_listing", f"""
SELECT repository, len(string_split(path, '/')) AS depth, path,
       row_number() OVER (ORDER BY repository, len(string_split(path, '/')), path) - 1 AS position
FROM ({SQL_PAGES}) WHERE NOT is_binary AND {SQL_PATH_INCLUDED} AND NOT ({SQL_PATH_EXCLUDED})
""")
def q_bfs(spark, sf):
    """O2: files level by level (depth, then path) per repository."""
    f = O.number_rows(O.breadth_first_listing(files(spark, sf).select("repository", "path")))
    return f.select("repository", O.path_depth("path").cast("bigint").alias("depth"), "path", "position")


@query("walk_repo_tree", f"""
WITH f AS (SELECT repository, path, string_split(path, '/') AS parts FROM ({SQL_PAGES})),
d AS (SELECT DISTINCT repository, array_to_string(parts[1:i], '/') AS path, i AS depth
      FROM (SELECT repository, parts, unnest(generate_series(1, len(parts) - 1)) AS i FROM f)),
j AS (SELECT *, {_sql_excluded('path')} OR NOT (regexp_matches(lower(path), '^(en|fr)(/|$)') OR lower(path) IN ('en', 'fr')) AS stop FROM d),
below AS (SELECT x.repository, x.path FROM j x JOIN j y ON x.repository = y.repository AND y.stop AND starts_with(x.path, y.path || '/')),
m AS (SELECT * FROM j WHERE (repository, path) NOT IN (SELECT (repository, path) FROM below))
SELECT repository, path, 'tree' AS type, depth, CASE WHEN stop THEN 'pruned' ELSE 'entered' END AS outcome FROM m
UNION ALL
SELECT repository, path, 'blob', len(parts),
       CASE WHEN NOT {_sql_excluded('path')} AND {SQL_PATH_INCLUDED} AND regexp_matches(lower(path), '^(en|fr)(/|$)') THEN 'kept' ELSE 'passed' END
FROM f WHERE len(parts) = 1 OR (repository, array_to_string(parts[1:len(parts) - 1], '/')) IN (SELECT (repository, path) FROM m WHERE NOT stop)
""")
def q_walk_tree(spark, sf):
    """S6 + O2 as a walk: the directories and files of every repository that are met from its root,
    level by level, into ``en`` and ``fr`` only and not into excluded directories."""
    entries = B.repo_entries(_t(spark, sf, "pages"))
    walked = TR.walk_tree(TR.listing_from_paths(entries), INCLUDE_PATHS, exclude_paths=EXCLUDE_PATHS)
    return walked.withColumn("depth", F.col("depth").cast("bigint"))


@query("project_file_document", f"""
SELECT regexp_replace(repository || ':' || path, '[^a-zA-Z0-9_-]', '_', 'g') AS id,
       list_last(string_split(path, '/')) AS title,
       'https://github.com/' || repository || '/blob/main/' || path AS source_url,
       byte_size, 'PUBLIC' AS acl
FROM ({SQL_PAGES}) WHERE NOT is_binary AND {SQL_PATH_INCLUDED} AND NOT ({SQL_PATH_EXCLUDED})
""")
def q_file_doc(spark, sf):
    """File documents of a public pipeline (``idp_wide`` readers)."""
    f = J.attach_repository_acl(files(spark, sf), None, is_public=True)
    d = P.project_file_document(f, "https://github.com")
    sd = F.col("struct_data")
    return d.select("id", sd["title"].alias("title"), sd["sourceUrl"].alias("source_url"),
                    sd["byteSize"].alias("byte_size"), A.acl_summary("acl_info").alias("acl"))


# ---------------------------------------------------------------- discussions (conversations)

SQL_THREAD = """
SELECT conv_id, string_agg('- [turn-' || CAST(turn AS VARCHAR) || '] ' || role || ': ' || text, chr(10) ORDER BY turn) AS lines,
       count(*) AS n
FROM conversations WHERE {cond} GROUP BY conv_id
"""

SQL_REVIEWS = """
SELECT conv_id, string_agg('- [turn-' || CAST(turn AS VARCHAR) || '] ' || role || ' (COMMENTED): ' || text, chr(10) ORDER BY turn)
       AS lines, count(*) AS n
FROM conversations WHERE turn >= 1 AND role = 'system' GROUP BY conv_id
"""


def _sql_discussion(kind: str) -> str:
    cond = "turn >= 1 AND role <> 'system'" if kind == "pr" else "turn >= 1"
    header = "PULL REQUEST #" if kind == "pr" else "ISSUE #"
    reviews = (" || CASE WHEN coalesce(r.n, 0) > 0 THEN chr(10) || '--- Reviews ---' || chr(10) || r.lines ELSE '' END"
               if kind == "pr" else "")
    join_r = f" LEFT JOIN ({SQL_REVIEWS}) r ON h.conv_id = r.conv_id" if kind == "pr" else ""
    return f"""
SELECT 'org/threads:{kind}:' || CAST(h.conv_id AS VARCHAR) AS raw_id, h.conv_id AS number, coalesce(c.n, 0) AS n_comments,
       {'coalesce(r.n, 0)' if kind == 'pr' else '0'} AS n_reviews, octet_length(encode(h.text)) AS body_len,
       '{header}' || CAST(h.conv_id AS VARCHAR) || ': ' || split_part(h.text, chr(10), 1) || chr(10) || 'State: OPEN'
       || chr(10) || 'Author: ' || h.role || chr(10) || 'Created At: ' || chr(10) || chr(10) || '--- Description ---'
       || chr(10) || h.text || chr(10)
       || CASE WHEN coalesce(c.n, 0) > 0 THEN chr(10) || '--- Comments & Discussions ---' || chr(10) || c.lines || chr(10)
               ELSE '' END{reviews} AS text
FROM (SELECT * FROM conversations WHERE turn = 0) h
LEFT JOIN ({SQL_THREAD.format(cond=cond)}) c ON h.conv_id = c.conv_id{join_r}
"""


@shared
def prs(spark: SparkSession, sf: str) -> DataFrame:
    return SF.scan_pull_requests(B.pull_requests(_t(spark, sf, "conversations"), with_reviews=True))


@shared
def issues(spark: SparkSession, sf: str) -> DataFrame:
    return SF.scan_issues(B.pull_requests(_t(spark, sf, "conversations"), with_reviews=False))


@query("scan_pull_requests", f"""
SELECT raw_id AS id, number, n_comments, n_reviews, body_len FROM ({_sql_discussion('pr')})
""")
def q_scan_prs(spark, sf):
    """Pull-request records with all their comments and reviews."""
    p = prs(spark, sf)
    return p.select("id", "number", F.size("comments").cast("bigint").alias("n_comments"),
                    F.size("reviews").cast("bigint").alias("n_reviews"),
                    F.octet_length("body").cast("bigint").alias("body_len"))


@query("scan_issues", f"""
SELECT raw_id AS id, number, n_comments FROM ({_sql_discussion('issue')})
""")
def q_scan_issues(spark, sf):
    """Issue records with all their comments."""
    i = issues(spark, sf)
    return i.select("id", "number", F.size("comments").cast("bigint").alias("n_comments"))


@query("require_fields", f"""
SELECT raw_id AS id FROM ({_sql_discussion('pr')}) WHERE number <> 0
""")
def q_require(spark, sf):
    """records missing id, number (0 counts as missing) or repository are skipped."""
    return FL.require_fields(prs(spark, sf), "id", "repository", nonzero=["number"]).select("id")


@query("project_pull_request_document", f"""
SELECT regexp_replace(raw_id, '[^a-zA-Z0-9_-]', '_', 'g') AS id, text FROM ({_sql_discussion('pr')}) WHERE number <> 0
""")
def q_pr_doc(spark, sf):
    """P3 (+C14, C15): compiled pull-request text."""
    return P.project_pull_request_document(prs(spark, sf)).select("id", "text")


@query("project_issue_document", f"""
SELECT regexp_replace(raw_id, '[^a-zA-Z0-9_-]', '_', 'g') AS id, text FROM ({_sql_discussion('issue')}) WHERE number <> 0
""")
def q_issue_doc(spark, sf):
    """Compiled issue text."""
    return P.project_issue_document(issues(spark, sf)).select("id", "text")


@query("thread_lines", f"""
SELECT conv_id, lines FROM ({SQL_THREAD.format(cond='turn >= 1')})
""")
def q_thread(spark, sf):
    """``- [createdAt] login: body`` lines of each conversation thread."""
    i = issues(spark, sf).filter(F.size("comments") > 0)
    return i.select(F.col("number").alias("conv_id"), F.array_join(S.thread_lines("comments"), "\n").alias("lines"))


# ---------------------------------------------------------------- commit histories (events)

@shared
def commits(spark: SparkSession, sf: str) -> DataFrame:
    return B.commit_history(_t(spark, sf, "events"))


SQL_EMITTED_COMMITS = f"""
WITH c AS ({SQL_COMMITS}),
s AS (SELECT repository, max((ts, event_id)) AS m FROM c WHERE event_type = 'purchase' GROUP BY repository)
SELECT c.* FROM c LEFT JOIN s ON c.repository = s.repository WHERE s.m IS NULL OR (c.ts, c.event_id) > s.m
"""


@shared
def emitted_commits(spark: SparkSession, sf: str) -> DataFrame:
    """S9 + W3: history newest first up to the first already-synced commit (purchases
    mark what an earlier run synced)."""
    c = commits(spark, sf)
    seen = c.filter(F.col("event_type") == "purchase")
    return O.take_until_seen(c, seen, "repository", ["ts", "event_id"])


@query("take_until_seen", f"""
SELECT repository, event_id FROM ({SQL_EMITTED_COMMITS})
""")
def q_take_until_seen(spark, sf):
    """Per repository, the commits newer than the newest already-seen one."""
    return emitted_commits(spark, sf).select("repository", "event_id")


@query("scan_commits", f"""
SELECT repository || ':commit:' || sha AS id, sha, repository, committed_date FROM ({SQL_EMITTED_COMMITS})
""")
def q_scan_commits(spark, sf):
    """Commit records ``repository:commit:SHA`` of the unseen history prefix."""
    c = commits(spark, sf)
    seen = c.filter(F.col("event_type") == "purchase")
    return SF.scan_commits(c, seen, order=["ts", "event_id"]).select("id", "sha", "repository", "committed_date")


@query("project_commit_document", f"""
SELECT regexp_replace(repository || ':commit:' || sha, '[^a-zA-Z0-9_-]', '_', 'g') AS id,
       'COMMIT: ' || sha || chr(10) || 'Author: ' || author_name || ' <' || email || '>' || chr(10) || 'Date: '
       || committed_date || chr(10) || chr(10) || '--- Commit Message ---' || chr(10) || message AS text
FROM ({SQL_EMITTED_COMMITS})
""")
def q_commit_doc(spark, sf):
    """P5: compiled commit text."""
    e = emitted_commits(spark, sf)
    recs = SF.scan_commits(e)
    return P.project_commit_document(recs).select("id", "text")


@query("newest_n_per_repo", f"""
SELECT repository, event_id, pos FROM (
  SELECT repository, event_id, row_number() OVER (PARTITION BY repository ORDER BY ts DESC, event_id DESC) AS pos
  FROM ({SQL_COMMITS})) WHERE pos <= 5
""")
def q_newest_n(spark, sf):
    """The newest 5 commits per repository (planned with a partial group limit)."""
    n = O.newest_n_per_key(commits(spark, sf), "repository", B.newest_first(), 5)
    return n.select("repository", "event_id", F.col("pos").cast("bigint").alias("pos"))


SQL_CONTRIB = f"""
SELECT repository, array_to_string(list_sort(list_distinct(list(email) FILTER (WHERE contains(email, '@')))), ',')
       AS contributors
FROM ({SQL_COMMITS}) GROUP BY repository HAVING count(*) FILTER (WHERE contains(email, '@')) > 0
"""


@query("repo_contributors", SQL_CONTRIB)
def q_contrib(spark, sf):
    """A4: sorted distinct author e-mails with ``@`` over all commits."""
    c = AG.repo_contributors(commits(spark, sf))
    return c.select("repository", F.array_join("contributors", ",").alias("contributors"))


@query("attach_contributors", f"""
SELECT e.repository || ':commit:' || e.sha AS id, k.contributors
FROM ({SQL_EMITTED_COMMITS}) e LEFT JOIN ({SQL_CONTRIB}) k ON e.repository = k.repository
""")
def q_attach_contrib(spark, sf):
    """Documents carry their repository's contributor list."""
    recs = SF.scan_commits(emitted_commits(spark, sf))
    contrib = AG.repo_contributors(commits(spark, sf))
    out = J.attach_contributors(recs, contrib)
    return out.select("id", F.array_join("contributors", ",").alias("contributors"))


@query("email_per_login", f"""
SELECT repository, login, email FROM (
  SELECT repository, login, email,
         row_number() OVER (PARTITION BY repository, login ORDER BY ts, event_id) AS rn
  FROM ({SQL_COMMITS}) WHERE login IS NOT NULL AND contains(email, '@')) WHERE rn = 1
""")
def q_email_per_login(spark, sf):
    """A5: per login the e-mail written last when reading newest first (the oldest)."""
    c = commits(spark, sf).filter(F.col("login").isNotNull() & F.col("email").contains("@"))
    return J.email_per_login(c, B.age())


def collaborators(spark: SparkSession, sf: str) -> DataFrame:
    """Per repository: the owner's login, then a login that never commits."""
    users = _t(spark, sf, "events").select("user_id").distinct()
    repo = F.concat(F.lit("org/user-"), F.col("user_id").cast("string"))
    return users.select(repo.alias("repository"), F.explode(F.array(
        F.struct(F.lit(1).alias("pos"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login")),
        F.struct(F.lit(2).alias("pos"), F.concat(F.lit("ghost"), F.col("user_id").cast("string")).alias("login")))
    ).alias("c")).select("repository", "c.pos", "c.login")


SQL_MINED = f"""
WITH c AS (SELECT *, row_number() OVER (PARTITION BY repository ORDER BY ts DESC, event_id DESC) AS pos FROM ({SQL_COMMITS})),
w AS (SELECT * FROM c WHERE login IS NOT NULL AND contains(email, '@')),
e AS (SELECT repository, login, email FROM (SELECT *, row_number() OVER (PARTITION BY repository, login ORDER BY pos DESC) rn
                                            FROM w) WHERE rn = 1),
u AS (SELECT DISTINCT user_id FROM events),
l AS (SELECT 'org/user-' || CAST(user_id AS VARCHAR) AS repository, 1 AS pos, 'user' || CAST(user_id AS VARCHAR) AS login FROM u
      UNION ALL SELECT 'org/user-' || CAST(user_id AS VARCHAR), 2, 'ghost' || CAST(user_id AS VARCHAR) FROM u)
SELECT l.repository, l.pos, l.login, e.email FROM l LEFT JOIN e ON l.repository = e.repository AND l.login = e.login
"""


@query("mine_login_emails", SQL_MINED)
def q_mine(spark, sf):
    """Collaborator logins -> e-mail mined from all commits."""
    return J.mine_login_emails(collaborators(spark, sf), commits(spark, sf), oldest=B.age())


@query("domain_emails", f"""
SELECT event_id, CASE WHEN coalesce(login, '') <> '' THEN login || '@corp.example.com' END AS email FROM ({SQL_COMMITS})
""")
def q_domain(spark, sf):
    """``login@domain``; NULL login stays NULL."""
    c = commits(spark, sf)
    return c.select("event_id", J.domain_emails("login", " @corp.example.com ").alias("email"))


@query("resolve_repo_readers", f"""
SELECT repository, array_to_string(list(email ORDER BY pos), ',') AS readers,
       array_to_string(list('user:' || email ORDER BY pos), ',') AS acl
FROM ({SQL_MINED}) WHERE coalesce(email, '') <> '' GROUP BY repository
""")
def q_readers(spark, sf):
    """J13 (+C10): collaborators -> commit-mining mapper -> reader list -> ACL."""
    c = commits(spark, sf)
    mapper = lambda logins: J.mine_login_emails(logins, c, oldest=B.age())
    r = J.resolve_repo_readers(collaborators(spark, sf), mapper)
    return r.select("repository", F.array_join("readers", ",").alias("readers"),
                    A.acl_summary(A.acl_from_emails("readers")).alias("acl"))


SQL_READERS = f"""
SELECT repository, array_to_string(list('user:' || email ORDER BY pos), ',') AS acl
FROM ({SQL_MINED}) WHERE coalesce(email, '') <> '' GROUP BY repository
"""


@query("project_discussions", f"""
WITH d AS (
  SELECT raw_id AS id, 'org/threads' AS repository, 'discussion_pr' AS discussion_type,
         'https://github.com/org/threads/pull/' || CAST(number AS VARCHAR) AS url, text
  FROM ({_sql_discussion('pr')}) WHERE number <> 0
  UNION ALL SELECT raw_id, 'org/threads', 'discussion_issue',
         'https://github.com/org/threads/issues/' || CAST(number AS VARCHAR), text
  FROM ({_sql_discussion('issue')}) WHERE number <> 0
  UNION ALL SELECT repository || ':commit:' || sha, repository, 'discussion_commit',
         'https://github.com/' || repository || '/commit/' || sha,
         'COMMIT: ' || sha || chr(10) || 'Author: ' || author_name || ' <' || email || '>' || chr(10) || 'Date: '
         || committed_date || chr(10) || chr(10) || '--- Commit Message ---' || chr(10) || message
  FROM ({SQL_EMITTED_COMMITS}))
SELECT regexp_replace(d.id, '[^a-zA-Z0-9_-]', '_', 'g') AS id, discussion_type, url, text, r.acl, k.contributors
FROM d LEFT JOIN ({SQL_READERS}) r ON d.repository = r.repository LEFT JOIN ({SQL_CONTRIB}) k ON d.repository = k.repository
""")
def q_project_discussions(spark, sf):
    """P6 (P3-P5, J7, J9): pull requests, issues and commits dispatched to their projections,
    with their repository's readers and contributors."""
    c = commits(spark, sf)
    readers = J.resolve_repo_readers(collaborators(spark, sf), lambda logins: J.mine_login_emails(logins, c, oldest=B.age()))
    contributors = AG.repo_contributors(c)
    kinds = {"pull_request": prs(spark, sf), "issue": issues(spark, sf), "commit": SF.scan_commits(emitted_commits(spark, sf)),
             "status": c.limit(0)}
    attached = {k: J.attach_contributors(J.attach_repository_acl(v, readers), contributors) if k in P.DISCUSSION_TYPES else v
                for k, v in kinds.items()}
    out = P.project_discussions(attached)
    return out.select("id", "discussion_type", "url", "text", A.acl_summary("acl_info").alias("acl"),
                      F.array_join("contributors", ",").alias("contributors"))


@query("acl_from_principals", f"""
SELECT repository, CASE WHEN list_contains(list(email), 'allUsers') THEN 'PUBLIC'
                        ELSE array_to_string(list('user:' || email ORDER BY pos), ',') END AS acl
FROM (SELECT repository, pos, CASE WHEN pos = 2 AND repository LIKE '%7' THEN 'allUsers' ELSE email END AS email
      FROM ({SQL_MINED}))
WHERE coalesce(email, '') <> '' GROUP BY repository
""")
def q_acl_principals(spark, sf):
    """Reader lists become principals; an ``allUsers`` reader makes the document public."""
    c = commits(spark, sf)
    mined = J.mine_login_emails(collaborators(spark, sf), c, oldest=B.age())
    marked = mined.withColumn("email", F.when((F.col("pos") == 2) & F.col("repository").endswith("7"),
                                              F.lit("allUsers")).otherwise(F.col("email")))
    kept = marked.filter(F.coalesce("email", F.lit("")) != "")
    lists = kept.groupBy("repository").agg(F.array_sort(F.collect_list(F.struct("pos", "email"))).alias("_r"))
    principals = F.transform("_r", lambda s: A.user_principal(s["email"]))
    return lists.select("repository", A.acl_summary(A.acl_from_principals(principals)).alias("acl"))


# ---------------------------------------------------------------- policy-driven ACL (customers)

SQL_POLICY = f"""
WITH grp AS (SELECT r_name AS name, n_nationkey AS gpos, lower(n_name) || '@example.com' AS email
             FROM nation JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT lower(c_name) AS repo_key, c_mktsegment = 'AUTOMOBILE' AS is_public, r_name AS gname,
             {SQL_CUSTOMER_EMAIL} AS own
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')),
items AS (SELECT m.repo_key, grp.gpos AS ord, grp.email FROM m JOIN grp ON m.gname = grp.name WHERE NOT m.is_public
          UNION ALL SELECT repo_key, 1000000, own FROM m WHERE NOT is_public),
firsts AS (SELECT repo_key, email, min(ord) AS ord FROM items GROUP BY repo_key, email),
readers AS (SELECT repo_key, array_to_string(list(email ORDER BY ord), ',') AS readers FROM firsts GROUP BY repo_key
            UNION ALL SELECT repo_key, 'allUsers' FROM m WHERE is_public
            UNION ALL SELECT '*', 'fallback-readers@example.com')
"""


@shared
def policy_readers(spark: SparkSession, sf: str) -> DataFrame:
    nation, region, customer = _t(spark, sf, "nation"), _t(spark, sf, "region"), _t(spark, sf, "customer")
    return J.expand_groups(B.policy_groups(nation, region), B.policy_mappings(customer, nation, region))


@query("expand_groups", f"""
{SQL_POLICY}
SELECT repo_key, readers FROM readers
""")
def q_expand(spark, sf):
    """Group names -> members, explicit e-mails appended, order-preserving distinct."""
    return policy_readers(spark, sf).select("repo_key", F.array_join("readers", ",").alias("readers"))


@query("map_repository_acl", f"""
{SQL_POLICY}
SELECT c_custkey, coalesce(r.readers, (SELECT readers FROM readers WHERE repo_key = '*')) AS readers
FROM customer LEFT JOIN readers r ON lower(upper(c_name)) = r.repo_key
""")
def q_map_acl(spark, sf):
    """Case-insensitive repository lookup, else the ``*`` entry, else empty."""
    repos = _t(spark, sf, "customer").select("c_custkey", F.upper("c_name").alias("repository"))
    out = J.map_repository_acl(repos, policy_readers(spark, sf))
    return out.select("c_custkey", F.array_join("readers", ",").alias("readers"))


@query("attach_repository_acl", f"""
{SQL_POLICY}
SELECT o_orderkey, CASE WHEN rd = 'allUsers' OR contains(rd, 'allUsers,') OR suffix(rd, ',allUsers') THEN 'PUBLIC'
                        ELSE 'user:' || replace(rd, ',', ',user:') END AS acl
FROM (SELECT o_orderkey, coalesce(r.readers, (SELECT readers FROM readers WHERE repo_key = '*')) AS rd
      FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN readers r ON lower(upper(c_name)) = r.repo_key)
""")
def q_attach_acl(spark, sf):
    """Documents inherit their repository's reader list (C10 rules)."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer").select("c_custkey", F.upper("c_name").alias("repository"))
    docs = o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "repository")
    readers = J.map_repository_acl(docs.select("repository").distinct(), policy_readers(spark, sf))
    out = J.attach_repository_acl(docs, readers, is_public=False)
    return out.select("o_orderkey", A.acl_summary("acl_info").alias("acl"))


# ---------------------------------------------------------------- incremental slices and checkpoints

SQL_CHECKPOINTS = f"""
SELECT repository, min(ts) AS last_sync FROM ({SQL_COMMITS}) WHERE event_type = 'signup' GROUP BY repository
"""

SQL_CHANGED = f"""
SELECT c.* FROM ({SQL_COMMITS}) c LEFT JOIN ({SQL_CHECKPOINTS}) k ON c.repository = k.repository
WHERE k.last_sync IS NULL OR c.ts > k.last_sync
"""


def checkpoints(c: DataFrame) -> DataFrame:
    return c.filter(F.col("event_type") == "signup").groupBy("repository").agg(F.min("ts").alias("last_sync"))


def changed(spark: SparkSession, sf: str) -> DataFrame:
    c = commits(spark, sf)
    return FL.changed_since(c, checkpoints(c), "repository", "ts")


@query("changed_since", f"SELECT event_id, repository FROM ({SQL_CHANGED})")
def q_changed(spark, sf):
    """rows updated strictly after the repository's checkpoint; none -> all."""
    return changed(spark, sf).select("event_id", "repository")


@query("checkpoint_lookup", f"""
SELECT c.event_id, k.last_sync FROM ({SQL_COMMITS}) c LEFT JOIN ({SQL_CHECKPOINTS}) k ON c.repository = k.repository
""")
def q_cp_lookup(spark, sf):
    """The last checkpoint of each row's repository."""
    c = commits(spark, sf)
    return J.checkpoint_lookup(c, checkpoints(c)).select("event_id", "last_sync")


@query("incremental_slice", """
SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
""")
def q_slice(spark, sf):
    """A newest-first scan cut at a checkpoint is a strict filter (pushed to Parquet)."""
    e = _t(spark, sf, "events")
    return O.incremental_slice(e, "ts", F.lit("2024-01-15 00:00:00").cast("timestamp")).select("event_id")


@query("next_checkpoint", f"""
SELECT repository, max(ts) AS last_sync FROM ({SQL_CHANGED}) GROUP BY repository
""")
def q_next_cp(spark, sf):
    """Newest change per repository, the next checkpoint."""
    return AG.next_checkpoint(changed(spark, sf), "repository", "ts")


@query("order_by_updated_desc", """
SELECT event_id, ts, row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1 AS position FROM events
""")
def q_order_desc(spark, sf):
    """O1: newest first (a range-partitioned global sort)."""
    return O.number_rows(O.order_by_updated_desc(_t(spark, sf, "events").select("event_id", "ts"), "ts", "event_id"))


@query("union_discussions", f"""
SELECT 'org/threads:pr:' || CAST(conv_id AS VARCHAR) AS id, 'discussion_pr' AS discussion_type
FROM conversations WHERE turn = 0
UNION ALL SELECT 'org/threads:issue:' || CAST(conv_id AS VARCHAR), 'discussion_issue' FROM conversations WHERE turn = 0
UNION ALL SELECT repository || ':commit:' || sha, 'discussion_commit' FROM ({SQL_EMITTED_COMMITS}) WHERE event_type <> 'error'
""")
def q_union(spark, sf):
    """U1 + P6: PRs, issues and commits as one stream; kinds rewritten, unknown kinds
    (status events) dropped."""
    c = SF.scan_commits(emitted_commits(spark, sf), carry=["event_type"])
    c = c.withColumn("type", F.when(F.col("event_type") == "error", F.lit("status")).otherwise(F.col("type")))
    u = O.union_discussions(prs(spark, sf), issues(spark, sf), c)
    return P.route_discussion(u).select("id", "discussion_type")


# ---------------------------------------------------------------- state table

T10 = 1704844800.0   # 2024-01-10T00:00:00Z
T18 = 1705536000.0   # 2024-01-18T00:00:00Z
T19H = 1705665600.0  # 2024-01-19T12:00:00Z


def _state_key() -> F.Column:
    """User, kind and a day of the month modulo 20, so that some keys are written by both runs."""
    return F.concat(F.lit("user:"), F.col("user_id").cast("string"), F.lit(":"), F.col("event_type"), F.lit(":"),
                    (F.dayofmonth("ts") % 20).cast("string"))


def _entries(e: DataFrame, lo: str | None, hi: str | None) -> DataFrame:
    cond = F.lit(True)
    if hi:
        cond = cond & (F.col("ts") < F.lit(hi).cast("timestamp"))
    if lo:
        cond = cond & (F.col("ts") >= F.lit(lo).cast("timestamp"))
    return e.filter(cond).select(
        _state_key().alias("key"),
        F.col("props").alias("value"), "ts", "event_id")


def state_after_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    e = _t(spark, sf, "events")
    s1 = ST.state_put(None, _entries(e, None, "2024-01-10"), T10, 10 * 86400, order=[F.col("ts"), F.col("event_id")])
    return ST.state_put(s1, _entries(e, "2024-01-10", None), T18, 86400, order=[F.col("ts"), F.col("event_id")])


SQL_STATE = f"""
WITH e AS (SELECT 'user:' || CAST(user_id AS VARCHAR) || ':' || event_type || ':' || CAST(day(ts) % 20 AS VARCHAR) AS key, props AS value, ts, event_id FROM events),
p1 AS (SELECT key, value, {T10 + 10 * 86400} AS expires_at FROM (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) rn FROM e
        WHERE ts < TIMESTAMP '2024-01-10') WHERE rn = 1),
p2 AS (SELECT key, value, {T18 + 86400} AS expires_at FROM (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) rn FROM e
        WHERE ts >= TIMESTAMP '2024-01-10') WHERE rn = 1),
st AS (SELECT * FROM p1 WHERE expires_at > {T18} AND key NOT IN (SELECT key FROM p2) UNION ALL SELECT * FROM p2)
"""


@query("state_put", f"{SQL_STATE} SELECT key, value, CAST(expires_at AS DOUBLE) AS expires_at FROM st")
def q_state_put(spark, sf):
    """Two runs write entries (newest per key wins; expiry = write time + ttl)."""
    return state_after_two_runs(spark, sf)


@query("state_get", f"""{SQL_STATE}
SELECT k.key, st.value FROM (SELECT DISTINCT key FROM e) k LEFT JOIN st ON k.key = st.key AND st.expires_at > {T19H}
""")
def q_state_get(spark, sf):
    """Look up every key at a later time: live value or NULL (miss / expired)."""
    e = _t(spark, sf, "events")
    keys = e.select(_state_key().alias("key")).distinct()
    got = ST.state_get(keys, state_after_two_runs(spark, sf), F.col("key"), T19H, "value")
    return got.select("key", "value")


@query("state_expire", f"{SQL_STATE} SELECT key, CAST(expires_at AS DOUBLE) AS expires_at FROM st WHERE expires_at > {T19H}")
def q_state_expire(spark, sf):
    """Expired entries dropped (the store is rewritten with the live rows)."""
    return ST.state_live(state_after_two_runs(spark, sf), T19H).select("key", "expires_at")


@query("commit_checkpoints", f"""
SELECT 'commits:' || repository AS key,
       CASE WHEN epoch_us(max(ts)) % 1000000 = 0 THEN strftime(max(ts), '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') END AS value
FROM ({SQL_CHANGED}) GROUP BY repository
""")
def q_commit_cp(spark, sf):
    """Next checkpoints stored in the state table after the sink write."""
    nxt = AG.next_checkpoint(changed(spark, sf), "repository", "ts").withColumn("last_sync", S.iso_datetime("last_sync"))
    st = ST.commit_checkpoints(None, nxt, "commits", T19H)
    return st.select("key", "value")


# ---------------------------------------------------------------- JSON source

@query("scan_json_documents", """
SELECT doc_id, lang, source, n_chars, text FROM documents
""")
def q_json_source(spark, sf):
    """Documents landed as JSON lines, read back with a declared schema (the delta
    file is preferred in INCREMENTAL mode when present; here only the full file exists)."""
    path = scratch_dir(spark, "json-docs")
    _t(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", "text").write.json(path)
    schema = "doc_id bigint, lang string, source string, n_chars bigint, text string"
    from pyspark.sql.types import _parse_datatype_string
    return SF.scan_json_documents(spark, path, _parse_datatype_string(schema), delta_path=path + "-delta",
                                  multiline=False)


@query("reject_wrong_type", """
SELECT CASE WHEN lang = 'es' THEN 'failed' ELSE 'ok' END AS status, count(*) AS n FROM documents GROUP BY 1
""")
def q_reject_wrong_type(spark, sf):
    """a landed export where Spanish documents arrived as JSON arrays instead of
    objects; the REST transformer fails those records, the rest are read."""
    path = scratch_dir(spark, "wrong-type")
    d = _t(spark, sf, "documents")
    line = F.when(F.col("lang") == "es", F.to_json(F.array("text"))).otherwise(
        F.to_json(F.struct("doc_id", "lang", "source", "text")))
    d.select(line.alias("value")).write.text(path)
    from pyspark.sql.types import _parse_datatype_string
    recs = SF.scan_json_records(spark, path, _parse_datatype_string("doc_id bigint, lang string, source string, text string"))
    ok, rejected = SF.reject_wrong_type(recs, "fail", "rest_transformer")
    counts_ok = ok.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit("ok").alias("status"), "n")
    counts_bad = rejected.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return counts_ok.unionByName(counts_bad).filter(F.col("n") > 0)


@query("route_discussion", f"""
SELECT repository || ':commit:' || sha AS id, 'discussion_commit' AS discussion_type
FROM ({SQL_COMMITS}) WHERE event_type <> 'error'
""")
def q_route(spark, sf):
    """Records are dispatched on their type and the type rewritten; unknown kinds
    (status events in the commit feed) are dropped."""
    recs = SF.scan_commits(commits(spark, sf), carry=["event_type"])
    recs = recs.withColumn("type", F.when(F.col("event_type") == "error", F.lit("status")).otherwise(F.col("type")))
    return P.route_discussion(recs).select("id", "discussion_type")


# ---------------------------------------------------------------- state carried by a stream (events)

STREAM_TTL_SECONDS = 6 * 3600


def _in_time_order(spark: SparkSession, sf: str, parts: int = 3):
    """The events in ``parts`` runs by time: for each, the events that land with it."""
    e = _t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = e.agg(F.min("ts"), F.max("ts")).first()
    for i in range(parts):
        since = first + (last - first) * i / parts
        until = first + (last - first) * (i + 1) / parts
        yield e.where((F.col("ts") >= F.lit(since)) & ((F.col("ts") < F.lit(until)) | F.lit(i == parts - 1)))


@query("stream_unseen_commits", "SELECT event_id, user_id, event_type FROM events")
def q_stream_unseen(spark, sf):
    """W3 / J4 as streaming state: every run lands new events and, once more, those of the run
    before; the stream, started anew each time from its checkpoint, hands on each only once."""
    landed, out, ckpt = (scratch_dir(spark, n) for n in ("seen-landed", "seen-out", "seen-ckpt"))
    before = None
    for part in _in_time_order(spark, sf):
        (part if before is None else part.unionByName(before)).write.mode("append").parquet(landed)
        before = part
        stream = spark.readStream.schema(part.schema).parquet(landed)
        SS.run_available(SS.unseen(stream, "event_id", "ts"), out, ckpt)
    return spark.read.schema(before.schema).parquet(out).select("event_id", "user_id", "event_type")


@query("stream_expiring_state", f"""
SELECT 'user-' || CAST(user_id AS VARCHAR) AS key, event_id AS id,
       coalesce(epoch_us(ts) < epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) + CAST({STREAM_TTL_SECONDS} AS BIGINT) * 1000000, false) AS hit
FROM events
""")
def q_stream_state(spark, sf):
    """I1-I3 as streaming state: each event looks its user's entry up and writes it for six hours;
    the stream is stopped and started again between the runs."""
    landed, out, ckpt = (scratch_dir(spark, n) for n in ("ttl-landed", "ttl-out", "ttl-ckpt"))
    for part in _in_time_order(spark, sf):
        part.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(part.schema).parquet(landed)
        keyed = stream.withColumn("key", F.concat(F.lit("user-"), F.col("user_id").cast("string")))
        SS.run_available(SS.lookups(keyed, "key", "ts", "event_id", STREAM_TTL_SECONDS), out, ckpt)
    return spark.read.schema("key string, id bigint, hit boolean").parquet(out)

"""Lookups and reader resolution (survey J1-J13).

The reference does these as dictionary lookups inside loops; here they are
joins.  No broadcast hints are forced on data-sized sides: Spark broadcasts a
side only when its measured or estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime), and falls
back to a shuffle join otherwise.  Policy/config frames built from driver-side
lists are bounded by the config itself.
"""

from __future__ import annotations

import json
from typing import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.acl import acl_from_emails, public_acl
from quillspark.operators.access import access_index, is_public, principal_keys
from quillspark.operators.ordering import latest_per_id, newest_n_per_key

# Fixed values that must equal the reference's.
DEFAULT_BRANCH = "HEAD"
DEFAULT_PUBLIC_EMAIL = "allUsers"
EXTERNAL_GROUP_PREFIX = "external_group:"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def usable_patterns(spark: SparkSession, patterns: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """The (pattern, branch) pairs whose pattern Spark's own regular expressions accept; the
    others are skipped.  Each is tried on one constant row, by the engine that will run it."""
    def accepted(pattern: str) -> bool:
        try:
            spark.range(1).select(F.lit("").rlike(f"^(?:{pattern})")).collect()
        except PySparkException:
            return False
        return True

    return [(p, b or DEFAULT_BRANCH) for p, b in patterns if accepted(p)]


def match_repositories(repos: DataFrame, patterns: Sequence[tuple[str, str]], name_col: str = "name",
                       branch_col: str = "branch") -> DataFrame:
    """Ordered patterns, regex anchored at the start only, first match wins and
    supplies the branch; unmatched repositories are dropped.

    The pattern list is configuration, so the theta join is written as one CASE
    chain evaluated inside the scan stage: no join, no shuffle, no broadcast.  Patterns
    that Spark cannot compile are skipped."""
    patterns = usable_patterns(repos.sparkSession, patterns)
    if not patterns:
        raise ValueError("Either a single repository or repository patterns must be given.")
    name = _c(name_col)
    expr = None
    for pat, branch in patterns:
        cond = name.rlike(f"^(?:{pat})")
        expr = F.when(cond, F.lit(branch)) if expr is None else expr.when(cond, F.lit(branch))
    return repos.withColumn(branch_col, expr).filter(F.col(branch_col).isNotNull())


def single_repository(spec: str, default_branch: str = DEFAULT_BRANCH) -> tuple[str, str]:
    """J1 bypass: a single ``repo[:branch]`` skips matching."""
    return tuple(spec.split(":", 1)) if ":" in spec else (spec, default_branch)  # type: ignore[return-value]


def resolve_branch(targets: DataFrame, default_branches: DataFrame, repo_col: str = "repository",
                   branch_col: str = "branch", default_col: str = "default_branch") -> DataFrame:
    """``HEAD`` is replaced by the repository's default branch; if that cannot be
    resolved the repository is skipped."""
    d = default_branches.select(F.col(repo_col).alias("_d_repo"), F.col(default_col).alias("_d_branch"))
    joined = targets.join(d, targets[repo_col] == d["_d_repo"], "left")
    resolved = F.when(F.col(branch_col) == DEFAULT_BRANCH, F.col("_d_branch")).otherwise(F.col(branch_col))
    return (joined.withColumn(branch_col, resolved).filter(F.col(branch_col).isNotNull())
            .drop("_d_repo", "_d_branch"))


def content_cache_lookup(entries: DataFrame, cache: DataFrame, keys: Sequence[str] = ("repository", "path", "oid"),
                         full_mode: bool = False) -> tuple[DataFrame, DataFrame]:
    """Equi join on (repository, path, oid).  Returns ``(hits, to_fetch)``: hits
    re-emit the cached record, misses must be fetched (and then stored).  FULL mode
    ignores hits."""
    keys = list(keys)
    if full_mode:
        return cache.limit(0), entries
    cached_cols = [c for c in cache.columns if c not in keys]
    hits = entries.select(*keys).join(cache, keys, "inner").select(*keys, *cached_cols)
    to_fetch = entries.join(cache.select(*keys), keys, "left_anti")
    return hits, to_fetch


def checkpoint_lookup(df: DataFrame, checkpoints: DataFrame, key: str = "repository",
                      value_col: str = "last_sync") -> DataFrame:
    """Attach the last checkpoint per key (NULL when none)."""
    cp = checkpoints.select(F.col(key).alias("_cp_key"), F.col(value_col))
    return df.join(cp, df[key] == cp["_cp_key"], "left").drop("_cp_key")


def mine_login_emails(logins: DataFrame, commits: DataFrame, window: int | None = None,
                      oldest: Column | None = None, order: list | None = None) -> DataFrame:
    """J5 (+A5): per repository, each collaborator login gets an e-mail of a commit where the
    login matches and the e-mail contains ``@``; reading newest first with the last write
    winning means the *oldest* such e-mail.  Output keeps every login (unresolved -> NULL)
    with its position.

    ``logins``: (repository, pos, login); ``commits``: (repository, login, email) and either
    ``pos`` (1 = newest) or the columns of ``oldest``, a value that is largest for the oldest
    commit.  ``window`` looks only at that many newest commits, in ``order``."""
    oldest = F.col("pos") if oldest is None else oldest
    if window is not None:
        commits = newest_n_per_key(commits, "repository", order or [F.col("pos").asc()], window, pos_col="_wpos")
        oldest = F.col("_wpos")
    usable = commits.filter(F.col("login").isNotNull() & (F.col("login") != "")
                            & F.coalesce(F.col("email").contains("@"), F.lit(False)))
    per_login = email_per_login(usable, oldest)
    return logins.join(per_login, ["repository", "login"], "left").select("repository", "pos", "login", "email")


def email_per_login(commits: DataFrame, oldest: Column | None = None) -> DataFrame:
    """A5: per (repository, login) the e-mail seen last when reading newest first, i.e. the one
    with the greatest ``oldest`` value (default: the position, 1 = newest)."""
    return commits.groupBy("repository", "login").agg(F.max_by("email", F.col("pos") if oldest is None else oldest).alias("email"))


def domain_emails(login, domain: str) -> Column:
    """``login@domain``; a NULL/empty login stays NULL.  An empty domain is an error."""
    d = domain.strip().lstrip("@")
    if not d:
        raise ValueError("Domain pass-through mapping requires a non-empty domain.")
    lg = _c(login)
    return F.when(F.coalesce(lg, F.lit("")) != "", F.concat(lg, F.lit("@" + d)))


_PERMISSION = "struct<groups:array<string>,emails:array<string>>"


def policy_frames(spark: SparkSession, groups: dict | list, mappings: list[dict]) -> tuple[DataFrame, DataFrame]:
    """Policy document -> (groups, mappings) frames, taken apart by Spark from its JSON text.
    ``groups``: name -> member or members, as one mapping or a list of them; ``mappings``:
    entries with repository, isPublic, permissions (one or a list of ``groups`` / ``emails``)."""
    policy = spark.createDataFrame([(json.dumps(groups or []), json.dumps(mappings or []))], "g string, m string")

    def one_or_many(text: Column, kind: str) -> Column:
        return F.from_json(F.when(F.ltrim(text).startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))),
                           f"array<{kind}>")

    named = policy.select(F.explode(one_or_many(F.col("g"), "map<string,string>")).alias("entry")) \
        .select(F.explode("entry").alias("name", "members"))
    # A single member is plain text, several are a JSON list.
    members = F.when(F.col("members").startswith("["), F.from_json("members", "array<string>")).otherwise(F.array("members"))
    g = named.select("name", F.posexplode(members).alias("pos", "email"))
    entries = policy.select(F.posexplode(F.from_json(
        "m", "array<struct<repository:string,isPublic:boolean,permissions:string>>")).alias("seq", "e")).select("seq", "e.*")
    permissions = one_or_many(F.coalesce("permissions", F.lit("[]")), _PERMISSION)

    def all_of(field: str) -> Column:
        lists = F.transform(permissions, lambda p: F.coalesce(p[field], F.array().cast("array<string>")))
        return F.flatten(lists)

    m = entries.filter(F.coalesce("repository", F.lit("")) != "").select(
        "seq", "repository", F.coalesce("isPublic", F.lit(False)).alias("is_public"),
        all_of("groups").alias("groups"), all_of("emails").alias("emails"))
    return g, m


def expand_groups(groups: DataFrame, mappings: DataFrame, public_email: str = DEFAULT_PUBLIC_EMAIL) -> DataFrame:
    """Per repository key (lower-cased): public -> ``[public_email]``; else group
    members in group order, then explicit e-mails, order-preserving distinct; unknown
    groups add nothing; a later mapping for the same repository replaces an earlier one.

    ``groups``: (name, pos, email); ``mappings``: (seq, repository, is_public, groups[], emails[])."""
    latest = latest_per_id(mappings.withColumn("repo_key", F.lower("repository")).drop("repository"),
                           "repo_key", [F.col("seq")])
    exploded = latest.select("repo_key", F.posexplode_outer("groups").alias("gpos", "gname"))
    members = (exploded.join(groups, exploded["gname"] == groups["name"], "inner")
               .groupBy("repo_key")
               .agg(F.array_sort(F.collect_list(F.struct("gpos", "pos", "email"))).alias("_m")))
    out = latest.join(members, "repo_key", "left")
    expanded = F.array_distinct(F.concat(
        F.transform(F.coalesce(F.col("_m"), F.array()), lambda s: s["email"]),
        F.coalesce(F.col("emails"), F.array().cast("array<string>"))))
    readers = F.when(F.col("is_public"), F.array(F.lit(public_email))).otherwise(expanded)
    return out.select("repo_key", readers.alias("readers"))


def map_repository_acl(repos: DataFrame, repo_readers: DataFrame, repo_col: str = "repository") -> DataFrame:
    """Case-insensitive repository lookup, else the ``*`` entry, else empty.

    ``repo_readers`` has one row per repository key (J8 dedupes), so the exact lookup
    is a join that Spark broadcasts only if it is small, and the wildcard entry is a scalar subquery."""
    # The expanded policy feeds the exact lookup and the wildcard subquery: materialise it
    # once in the shared checkpoint folder.
    repo_readers = repo_readers.select("repo_key", "readers").checkpoint(eager=True)
    exact = repo_readers.select(F.col("repo_key").alias("_k"), F.col("readers").alias("_exact"))
    star = repo_readers.filter(F.col("repo_key") == "*").select("readers").scalar()
    out = repos.join(exact, F.lower(repos[repo_col]) == exact["_k"], "left").drop("_k")
    return (out.withColumn("readers", F.coalesce(F.col("_exact"), star, F.array().cast("array<string>")))
               .drop("_exact"))


def attach_repository_acl(docs: DataFrame, repo_readers: DataFrame, is_public: bool = False,
                          repo_col: str = "repository", readers_col: str = "readers",
                          on_empty_acl: str = "emit") -> DataFrame:
    """Every document inherits its repository's reader list (C10 rules), or
    ``idp_wide`` when the pipeline is public.  ``on_empty_acl='drop'`` removes
    documents with nobody to grant to; ``'emit'`` keeps them without ACL (reference)."""
    if is_public:
        return docs.withColumn("acl_info", public_acl())
    r = repo_readers.select(F.col(repo_col).alias("_r_repo"), F.col(readers_col).alias("_readers"))
    out = (docs.join(r, docs[repo_col] == r["_r_repo"], "left")
           .withColumn("acl_info", acl_from_emails(F.col("_readers")))
           .drop("_r_repo", "_readers"))
    return out.filter(F.col("acl_info").isNotNull()) if on_empty_acl == "drop" else out


def attach_contributors(docs: DataFrame, contributors: DataFrame, repo_col: str = "repository") -> DataFrame:
    """Documents get the repository's contributor list; NULL when there is none."""
    c = contributors.select(F.col(repo_col).alias("_c_repo"), F.col("contributors"))
    out = docs.join(c, docs[repo_col] == c["_c_repo"], "left").drop("_c_repo")
    return out.withColumn("contributors",
                          F.when(F.size(F.coalesce("contributors", F.array())) > 0, F.col("contributors")))


def repo_reader_rows(collaborators: DataFrame, mapper: Callable[[DataFrame], DataFrame],
                     limit: int | None = None) -> DataFrame:
    """J13 as rows (repository, pos, email): every collaborator, or the first ``limit`` per
    repository -> identity mapper -> empty e-mails dropped.

    ``collaborators``: (repository, pos, login); ``mapper`` returns (repository, pos, email)."""
    if limit is not None:
        collaborators = newest_n_per_key(collaborators, "repository", [F.col("pos").asc()], limit,
                                         pos_col="_cpos").drop("_cpos")
    return mapper(collaborators).filter(F.coalesce(F.col("email"), F.lit("")) != "")


def resolve_repo_readers(collaborators: DataFrame,
                         mapper: Callable[[DataFrame], DataFrame],
                         limit: int | None = None) -> DataFrame:
    """``repo_reader_rows`` as the ordered reader list that a document's ACL holds."""
    mapped = repo_reader_rows(collaborators, mapper, limit)
    return (mapped.groupBy("repository")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "email"))).alias("_r"))
            .select("repository", F.transform("_r", lambda s: s["email"]).alias("readers")))


def resolve_external_groups(principals: DataFrame, memberships: DataFrame,
                            principal_col: str = "group_id") -> DataFrame:
    """``external_group:<name>`` principals -> member users.  ``memberships``:
    (external_identity, user_id).  Non-external principals pass through unchanged."""
    p = principals.withColumn("_ext", F.when(F.col(principal_col).startswith(EXTERNAL_GROUP_PREFIX),
                                             F.regexp_replace(principal_col, "^" + EXTERNAL_GROUP_PREFIX, "")))
    m = memberships.select(F.col("external_identity").alias("_ext"), F.col("user_id").alias("member_user_id"))
    return p.join(m, "_ext", "left").drop("_ext")


def visible_to(docs: DataFrame, principals: Sequence[str], acl_col: str = "acl_info") -> DataFrame:
    """The documents one user may read: public ones, and those whose ACL names one of the
    user's ``principals`` (``user:<email>`` and ``group:<g>`` for each group of the user).  A
    filter on each document: no join and no (user, document) pairs."""
    return docs.filter(is_public(acl_col) | F.arrays_overlap(principal_keys(acl_col), F.array(*map(F.lit, principals))))


def visible_counts(docs: DataFrame, users: DataFrame, id_col: str = "id", acl_col: str = "acl_info") -> DataFrame:
    """J12 as counts, by access signatures: (user_id, visible) for ``users`` (user_id, groups
    ARRAY<STRING> of group principal ids).  No (user, document) pairs arise."""
    return access_index(docs, id_col, acl_col, keep_members=False).count(users)

"""Row filters and path predicates (survey F1-F10).

All predicates are column expressions, so Catalyst can push the simple ones
(equality, comparisons, null checks) into the Parquet scan.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's defaults for repository files.
DEFAULT_EXCLUDE_EXTENSIONS = [".png", ".jpg", ".jpeg", ".gif", ".pdf", ".zip", ".gz", ".tar",
                              ".lock", ".log", ".exe", ".bin"]
DEFAULT_EXCLUDE_PATHS = ["node_modules/", ".venv/", "venv/", ".git/", "dist/", "build/", "bin/"]
DEFAULT_INCLUDE_EXTENSIONS = [".md", ".markdown", ".txt", ".html", ".htm"]
DEFAULT_INCLUDE_FILENAMES = ["readme"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _any(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def present(col) -> Column:
    """True when a value is neither NULL nor empty text."""
    return F.coalesce(_c(col).cast("string"), F.lit("")) != ""


def require_fields(df: DataFrame, *cols: str, nonzero: Sequence[str] = ()) -> DataFrame:
    """rows missing a required field are skipped; ``nonzero`` fields also treat 0 as missing."""
    cond = reduce(lambda a, b: a & b, [present(c) for c in cols], F.lit(True))
    for c in nonzero:
        cond = cond & F.coalesce(_c(c) != 0, F.lit(False))
    return df.filter(cond)


def action_of(col="action") -> Column:
    return F.coalesce(_c(col), F.lit("upsert"))


def drop_deletes(df: DataFrame, action_col: str = "action") -> DataFrame:
    """``action == 'delete'`` is skipped; a missing action means upsert."""
    return df.filter(action_of(action_col) != "delete")


def drop_unmapped_entities(df: DataFrame, known: Sequence[str], col: str = "entityType") -> DataFrame:
    """keep rows whose entity type has a projection; null/empty types skip silently."""
    return df.filter(present(col) & _c(col).isin(*known))


def _either(texts: Sequence[str]) -> str:
    return "(" + "|".join(re.escape(t) for t in texts) + ")"


def _excluded(path: Column, exclude_extensions: Sequence[str], exclude_paths: Sequence[str], suffix_end: str) -> Column:
    """One match for all suffixes (in any case) and one for all directory names (in their own)."""
    tests = []
    if exclude_extensions:
        tests.append(F.lower(path).rlike(_either([e.lower() for e in exclude_extensions]) + suffix_end))
    if exclude_paths:
        tests.append(path.rlike("(^|/)" + _either([d.rstrip("/") for d in exclude_paths]) + "(/|$)"))
    return _any(tests)


def entry_excluded(path, exclude_extensions: Sequence[str] = DEFAULT_EXCLUDE_EXTENSIONS,
                   exclude_paths: Sequence[str] = DEFAULT_EXCLUDE_PATHS) -> Column:
    """F4 for one entry alone, as a walk meets it: its ending, or a directory name anywhere in it."""
    return _excluded(_c(path), exclude_extensions, exclude_paths, "$")


def path_excluded(path, exclude_extensions: Sequence[str] = DEFAULT_EXCLUDE_EXTENSIONS,
                  exclude_paths: Sequence[str] = DEFAULT_EXCLUDE_PATHS) -> Column:
    """F4 for a full path: it or any directory above it is excluded (a directory named ``x.bin``
    prunes its whole subtree), so a suffix counts wherever a name ends."""
    return _excluded(_c(path), exclude_extensions, exclude_paths, "(/|$)")


def _clean_includes(include_paths: Sequence[str] | None) -> list[str]:
    return [i.lower().rstrip("/") for i in (include_paths or [])]


def path_included(path, include_paths: Sequence[str] | None = None,
                  include_filenames: Sequence[str] = DEFAULT_INCLUDE_FILENAMES,
                  include_extensions: Sequence[str] = DEFAULT_INCLUDE_EXTENSIONS) -> Column:
    """under an include path (if any are set), then README-like name or whitelisted extension."""
    low, inside = F.lower(_c(path)), _clean_includes(include_paths)
    wanted = []
    if include_filenames:
        wanted.append(low.rlike("(^|/)" + _either(include_filenames) + r"(\.[^/]*)?$"))
    if include_extensions:
        wanted.append(low.rlike(_either([e.lower() for e in include_extensions]) + "$"))
    return (low.rlike("^" + _either(inside) + "(/|$)") if inside else F.lit(True)) & _any(wanted)


def dir_traversable(dir_path, include_paths: Sequence[str] | None = None,
                    exclude_extensions: Sequence[str] = DEFAULT_EXCLUDE_EXTENSIONS,
                    exclude_paths: Sequence[str] = DEFAULT_EXCLUDE_PATHS) -> Column:
    """not excluded, and inside an include path or above one."""
    low, inside = F.regexp_replace(F.lower(_c(dir_path)), "/+$", ""), _clean_includes(include_paths)
    above = sorted({"/".join(i.split("/")[:n]) for i in inside for n in range(1, i.count("/") + 1)})
    leads_in = (low.rlike("^" + _either(inside) + "(/|$)") | low.isin(above)) if inside else F.lit(True)
    return ~entry_excluded(dir_path, exclude_extensions, exclude_paths) & leads_in


def select_repo_files(entries: DataFrame, include_paths: Sequence[str] | None = None,
                      exclude_extensions: Sequence[str] = DEFAULT_EXCLUDE_EXTENSIONS,
                      exclude_paths: Sequence[str] = DEFAULT_EXCLUDE_PATHS,
                      include_filenames: Sequence[str] = DEFAULT_INCLUDE_FILENAMES,
                      include_extensions: Sequence[str] = DEFAULT_INCLUDE_EXTENSIONS) -> DataFrame:
    """F4 + F5 over a flat tree listing: blobs that the breadth-first walk would reach
    and ingest.  A file is reached iff no ancestor is excluded (F6 is then implied by F5)."""
    return entries.filter(
        (F.col("type") == "blob")
        & ~path_excluded("path", exclude_extensions, exclude_paths)
        & path_included("path", include_paths, include_filenames, include_extensions))


def drop_binary(df: DataFrame, col: str = "isBinary") -> DataFrame:
    """binary blobs are skipped."""
    return df.filter(~F.coalesce(_c(col), F.lit(False)))


def drop_private_without_principals(df: DataFrame, acl_col: str = "acl_info") -> DataFrame:
    """F8: rows whose ACL could not be built (private, nobody to grant to) are skipped."""
    return df.filter(_c(acl_col).isNotNull())


def changed_since(df: DataFrame, checkpoints: DataFrame, key: str, updated_col: str,
                  last_sync_col: str = "last_sync", inclusive: bool = False) -> DataFrame:
    """F10 (+J4): keep rows updated strictly after the key's checkpoint; no checkpoint
    -> everything.  The checkpoint frame has one row per key, so the join never
    multiplies rows; AQE broadcasts it at runtime when it is measured small."""
    cp = checkpoints.select(F.col(key).alias("_cp_key"), F.col(last_sync_col).alias("_last_sync"))
    joined = df.join(cp, df[key] == cp["_cp_key"], "left")
    newer = (_c(updated_col) >= F.col("_last_sync")) if inclusive else (_c(updated_col) > F.col("_last_sync"))
    return joined.filter(F.col("_last_sync").isNull() | newer).drop("_cp_key", "_last_sync")

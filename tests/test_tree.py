"""The repository walk against a plain breadth-first loop, and path predicates against each other."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from quillspark.operators import filters as FL
from quillspark.operators import tree as TR


def entry_excluded(path, extensions=FL.DEFAULT_EXCLUDE_EXTENSIONS, names=FL.DEFAULT_EXCLUDE_PATHS):
    names = [n.rstrip("/") for n in names]
    return any(path.lower().endswith(e) for e in extensions) or any(f"/{n}/" in f"/{path}/" for n in names)


def included(path, inside):
    low = path.lower()
    name = low.split("/")[-1]
    under = not inside or any(low == i or low.startswith(i + "/") for i in inside)
    return under and (name == "readme" or name.startswith("readme.") or any(low.endswith(e) for e in FL.DEFAULT_INCLUDE_EXTENSIONS))


def enters(path, inside):
    low = path.lower()
    return not entry_excluded(path) and (not inside or any(low == i or low.startswith(i + "/") or i.startswith(low + "/") for i in inside))


def loop(listing, inside):
    """Queue of directories per repository; judged when met."""
    children, out = {}, []
    for repo, parent, name, kind in listing:
        children.setdefault((repo, parent), []).append((name, kind))
    queue = deque((r, "", 0) for r in {x[0] for x in listing})
    while queue:
        repo, at, depth = queue.popleft()
        for name, kind in children.get((repo, at), []):
            path = f"{at}/{name}" if at else name
            if kind == "tree":
                go = enters(path, inside)
                out.append((repo, path, kind, depth + 1, "entered" if go else "pruned"))
                if go:
                    queue.append((repo, path, depth + 1))
            else:
                keep = not entry_excluded(path) and included(path, inside)
                out.append((repo, path, kind, depth + 1, "kept" if keep else "passed"))
    return sorted(out)


def random_paths(seed):
    rng = random.Random(seed)
    names = ["src", "docs", "Docs", "build", "node_modules", "assets.bin", "a b", "x.PNG", "guide", ".git", "deep"]
    files = ["README", "readme.rst", "a.md", "b.TXT", "pic.png", "c.lock", "index.html", "noext", "readmenot", "build"]
    paths = {("/".join(rng.choices(names, k=rng.randrange(0, 5)) + [rng.choice(files)]), f"r{rng.randrange(3)}") for _ in range(250)}
    return [(r, p) for p, r in sorted(paths) if not any(q.startswith(p + "/") for q, s in paths if s == r)]


@pytest.mark.parametrize("inside", [[], ["docs", "src/guide"]])
def test_walk_matches_a_loop(spark, inside):
    files = spark.createDataFrame(random_paths(len(inside)), "repository string, path string")
    listing = TR.listing_from_paths(files)
    rows = [tuple(r) for r in listing.collect()]
    assert len({r for r in rows if r[3] == "tree"}) == sum(r[3] == "tree" for r in rows)
    got = sorted(tuple(r) for r in TR.walk_tree(listing, inside).collect())
    assert got == loop(rows, inside)
    # what the walk keeps is what the predicates on whole paths keep
    flat = files.withColumn("type", F.lit("blob")).withColumn("branch", F.lit("main"))
    kept = sorted((r.repository, r.path) for r in FL.select_repo_files(flat, inside).collect())
    assert kept == sorted((r, p) for r, p, _, _, o in got if o == "kept")


def test_deep_trees_empty_listings_and_unreached_entries(spark):
    path = "/".join(f"d{i}" for i in range(130)) + "/a.md"
    listing = TR.listing_from_paths(spark.createDataFrame([("r", path)], "repository string, path string"))
    assert [(r.depth, r.outcome) for r in TR.walk_tree(listing).where("type = 'blob'").collect()] == [(131, "kept")]
    assert TR.walk_tree(listing.limit(0)).collect() == []
    lost = spark.createDataFrame([("r", "nowhere", "a.md", "blob"), ("r", "", "top.md", "blob"), ("r", "", "sub", "commit")],
                                 "repository string, parent string, name string, type string")
    assert [(r.path, r.outcome) for r in TR.walk_tree(lost).collect()] == [("top.md", "kept")]


def test_path_rules_without_lists(spark):
    df = spark.createDataFrame([("a/b.md",), ("build/x.png",)], "p string")
    none = df.select(FL.path_excluded("p", [], []).alias("e"), FL.path_included("p", None, [], []).alias("i")).collect()
    assert [(r.e, r.i) for r in none] == [(False, False)] * 2

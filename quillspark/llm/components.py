"""Connected components of a link table, in DataFrame operations only.

Each round hooks every root to the smallest root it is linked to, follows the pointers to their
end and contracts the links, so the link table shrinks at least by half in roots.  All per-node
state stays in tables; the driver sees only row counts.  Every step is an aggregate with map-side
combine or a join against a table with one row per node, which AQE splits when a node is hot.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import cut, passing

#: So many of a node's buckets, the smallest, travel with each of its rows.
FIRST = 8


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; the component is its smallest node.

    Nulls on either side and self links are ignored; repeated links count once; an empty link
    table gives an empty result."""
    pairs = (
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    pairs = cut(pairs, "links")
    labels = None
    while not pairs.isEmpty():
        hooks = cut(pairs.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("p")), "hooks")
        hooks = _flatten(hooks)
        # Every root of the pairs either hooked or stays its own root.
        new = cut(_relabel(pairs, hooks), "links")
        if labels is None:
            labels = hooks
        else:
            old = labels.join(hooks.select(F.col("n").alias("p"), F.col("p").alias("q")), "p", "left")
            # A root hooks once, so the new pointers are of nodes not labelled before.
            labels = cut(old.select("n", F.coalesce("q", "p").alias("p")).unionByName(hooks), "labels")
        pairs = new
    if labels is None:
        kind = links.schema[a].dataType
        return links.sparkSession.createDataFrame([], "x int").select(
            F.lit(None).cast(kind).alias("node"), F.lit(None).cast(kind).alias("component"))
    roots = labels.select(F.col("p").alias("n")).distinct().withColumn("p", F.col("n"))
    return labels.unionByName(roots).select(F.col("n").alias("node"), F.col("p").alias("component"))


def _flatten(hooks: DataFrame) -> DataFrame:
    """Pointers followed to their end; they fall strictly, so this ends after log(depth) steps."""
    while True:
        up = hooks.select(F.col("n").alias("p"), F.col("p").alias("q"))
        step = cut(hooks.join(up, "p", "left").select("n", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")), "jump")
        hooks = step.select("n", "p")
        if step.where("moved").isEmpty():
            return hooks


def _relabel(pairs: DataFrame, hooks: DataFrame) -> DataFrame:
    left = hooks.select(F.col("n").alias("u"), F.col("p").alias("pu"))
    right = hooks.select(F.col("n").alias("v"), F.col("p").alias("pv"))
    ends = pairs.join(left, "u", "left").join(right, "v", "left").select(
        F.coalesce("pu", "u").alias("u"), F.coalesce("pv", "v").alias("v"))
    return ends.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _with_hubs(sized: DataFrame) -> DataFrame:
    """(bucket, node, low, high): the members with their bucket's smallest and its most central one."""
    central = sized.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = sized.join(central, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node"))["node"].alias("high"))
    return sized.join(hubs, "bucket").select("bucket", "node", "low", "high")


def bucket_groups(buckets: DataFrame, prepare, traits=None, linked=None, settle=None) -> DataFrame:
    """``components`` of all members that any confirmed pair of members of a bucket connects.  ``buckets`` has (bucket, node), repeats do no harm; ``prepare(nodes)`` returns a filter of
    candidate pairs (a, b) of these nodes.

    All members of a bucket are first compared with its smallest node and with its most central one,
    the node whose buckets hold most members (the text that many others were copied from).  Then only
    pairs of members that these links leave in different groups remain, and all are compared.  With
    ``settle`` that names them; else the join within a bucket confirms them by ``linked(x, y)``, which gets
    the two sides' columns of ``traits(nodes)``, a row for each of these nodes, so that only links become rows.  A pair
    with a smaller common bucket among the ``FIRST`` smallest of either is left to that one.  Their links are followed
    between the groups that there are, not once more from the single nodes."""
    buckets = cut(buckets, "buckets")
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("low")).where("size > 1")
    held = ExitStack()
    sized = held.enter_context(passing(buckets.join(sizes, "bucket"), "shared"))
    # Tables go when what is made of them is written.
    with passing(_with_hubs(sized), "hubs") as shared:
        held.close()
        stars = shared.select(F.explode(F.array("low", "high")).alias("hub"), "node").where("hub != node")
        stars = stars.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
        check = prepare(shared.select("node").distinct())
        with passing(stars, "stars") as pairs:
            links = cut(check(pairs), "star-links")
        groups = cut(components(links), "groups")
        member = cut(
            shared.join(groups, "node", "left").select("bucket", "node", "low", "high", F.coalesce("component", "node").alias("g")),
            "members",
        )
    if settle is not None:
        mixed = member.groupBy("bucket").agg(F.min("g").alias("g1"), F.max("g").alias("g2")).where("g1 < g2").select("bucket")
        inner = member.where("node != low AND node != high").join(mixed, "bucket", "left_semi").drop("low", "high")
        rest = settle(cut(inner, "mixed")).distinct()
        more = check(cut(rest, "rest"))
        for end in ("a", "b"):
            more = more.join(groups.select(F.col("node").alias(end), F.col("component").alias("g")), end, "left").withColumn(end, F.coalesce("g", end)).drop("g")
        return _joined_groups(groups, cut(more, "more-links"))
    inner = member.where("node != low AND node != high").drop("low", "high")
    mixed = inner.groupBy("bucket").agg(F.min("g").alias("g1"), F.max("g").alias("g2")).where("g1 < g2").select("bucket")
    inner = inner.join(mixed, "bucket", "left_semi")
    # A node's rows are gathered, so that its traits are looked up once.
    owned = cut(inner.groupBy("node", "g").agg(F.sort_array(F.collect_list("bucket")).alias("all")), "mixed")
    rows = owned.join(traits(owned.select("node")), "node").withColumn("first", F.slice("all", 1, FIRST))
    rows = rows.withColumn("bucket", F.explode("all")).drop("all")
    x, y = rows.alias("x"), rows.alias("y")
    apart = F.expr("x.bucket = y.bucket AND x.node < y.node AND x.g != y.g")
    here = F.expr("coalesce(array_min(array_intersect(x.first, y.first)) >= x.bucket, true)")
    close, confirmed = linked(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"))
    found = x.join(y, apart & close & here & confirmed).select(F.col("x.g").alias("a"), F.col("y.g").alias("b"))
    return _joined_groups(groups, cut(found, "more-links"))


def _joined_groups(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (node, component) joined by links between components; a node of no group is one by itself."""
    joined = cut(components(links), "joined")
    if joined.isEmpty():
        return groups
    up = joined.select(F.col("node").alias("component"), F.col("component").alias("top"))
    known = groups.join(up, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return known.unionByName(joined.join(groups.select("node"), "node", "left_anti").select("node", "component"))

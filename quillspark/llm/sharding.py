"""Minimax contiguous partition of documents into shards.

Documents with equal texts form one atomic group.  Groups are ordered by a 64-bit hash of the
text, and the order is cut into ``shards`` contiguous runs whose largest size is as small as
possible: a binary search over the capacity, checked greedily, finds it.  The driver never holds
the groups.  It holds sums of *cells* (hash prefixes, 4096 at first); only cells that a cut of the
best solution may fall into are split further, each time by one aggregate, until the capacity found
with whole cells equals the bound that holds when cells could be cut anywhere.

Defined cases: a null text has size 1 and checksum 0 and forms a group of its own, apart from the
empty text; a repeated row is a row; an empty table gives no rows; a null id sorts first; further
columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.shared import cut

#: Bits of the group key that the first cells and each later level of cells take.
FIRST_BITS, MORE_BITS = 12, 8


def reach(sums: np.ndarray, whole: np.ndarray, capacity: int, shards: int) -> list[float]:
    """Greedy cut positions in bytes; cells that are not ``whole`` can be cut anywhere."""
    ends = np.cumsum(sums)
    starts, total, at, out = ends - sums, int(ends[-1]), 0, []
    for _ in range(shards):
        goal = at + capacity
        if goal >= total:
            at = total
        else:
            k = int(np.searchsorted(ends, goal, "right"))
            at = int(starts[k]) if whole[k] else goal
        out.append(at)
    return out


def smallest_capacity(sums: np.ndarray, whole: np.ndarray, shards: int) -> int:
    """The smallest capacity for which the greedy check uses up all cells."""
    total = int(sums.sum())
    low = max(-(-total // shards), int(sums[whole].max(initial=0)))
    high = max(low, total)
    while low < high:
        middle = (low + high) // 2
        if reach(sums, whole, middle, shards)[-1] >= total:
            high = middle
        else:
            low = middle + 1
    return low


def balanced_cuts(sums: np.ndarray, capacity: int, shards: int) -> list[int]:
    """First cell of each shard: within the capacity, each shard as near as can be to an equal
    part of what is left, so that a large group leaves the other shards alike."""
    ends = np.concatenate([[0], np.cumsum(sums)])
    total = int(ends[-1])
    latest = [len(sums)]  # first cells from which the rest still fits, from the back
    for _ in range(shards):
        latest.append(int(np.searchsorted(ends, ends[latest[-1]] - capacity, "left")))
    latest = latest[::-1]
    cuts, at = [0], 0
    for j in range(1, shards):
        want = ends[at] + (total - ends[at]) / (shards - j + 1)
        k = int(np.searchsorted(ends, want, "left"))
        if k > at and (k >= len(ends) or abs(ends[k - 1] - want) <= abs(ends[k] - want)):
            k -= 1
        most = int(np.searchsorted(ends, ends[at] + capacity, "right")) - 1
        at = max(at, min(max(k, latest[j]), most, len(sums)))
        cuts.append(at)
    return cuts


class Cells:
    """Sums of sizes by prefix of the group key, in key order."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        first = self._sums(rows, FIRST_BITS)
        self.cells = [(FIRST_BITS, *r) for r in first]

    @staticmethod
    def _sums(rows: DataFrame, bits: int) -> list[tuple]:
        prefix = F.shiftright("key", 64 - bits)
        got = rows.groupBy(prefix.alias("cell")).agg(F.sum("size"), F.min("key"), F.max("key")).collect()
        return sorted((tuple(r) for r in got), key=lambda r: r[2])

    def arrays(self):
        sums = np.array([c[2] for c in self.cells], np.int64)
        return sums, np.array([c[3] == c[4] for c in self.cells], bool)

    def split(self, which: set[int]) -> None:
        """Replace the cells at these places by their parts."""
        out = {}
        for bits in {self.cells[i][0] for i in which}:
            prefixes = [self.cells[i][1] for i in which if self.cells[i][0] == bits]
            finer = min(64, bits + MORE_BITS)
            inside = self.rows.where(F.shiftright("key", 64 - bits).isin(prefixes))
            for r in self._sums(inside, finer):
                out.setdefault((bits, r[0] >> (finer - bits)), []).append((finer, *r))
        self.cells = [
            part
            for i, c in enumerate(self.cells)
            for part in (out[c[0], c[1]] if i in which else [c])
        ]


def cut_keys(rows: DataFrame, shards: int) -> tuple[list[int], int]:
    """(first key of shards 1.., smallest possible largest shard) for rows (key, size)."""
    cells = Cells(rows)
    if not cells.cells:
        return [], 0
    while True:
        sums, whole = cells.arrays()
        high = smallest_capacity(sums, np.ones_like(whole), shards)
        low = smallest_capacity(sums, whole, shards)
        if high == low:
            break
        # The j-th cut of the best solution lies between these two.
        after = reach(sums, whole, high, shards)
        ends = np.cumsum(sums)
        starts, at, which = ends - sums, 0, set()
        for j in range(shards):
            goal = at + low
            k = int(np.searchsorted(ends, goal, "right"))
            at = max(at, int(starts[k])) if k < len(ends) else int(ends[-1])
            span = np.nonzero((ends > at) & (starts < after[j]) & ~whole)[0]
            which.update(int(i) for i in span)
        if not which:
            break
        cells.split(which)
    sums, _ = cells.arrays()
    firsts = balanced_cuts(sums, high, shards)
    keys = [cells.cells[i][3] if i < len(sums) else None for i in firsts[1:]]
    return keys, high


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, group_key, shard, slot (gapless from 0 in its shard)."""
    spark = docs.sparkSession
    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    rows = cut(
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(text_col).alias("key"),
            (F.octet_length(data) + 1).cast("long").alias("size"),
            F.crc32(data).alias("crc"),
        ),
        "sizes",
    )
    keys, _ = cut_keys(rows, shards)
    shard = F.lit(0)
    for k in keys:
        if k is not None:
            shard = shard + (F.col("key") >= k).cast("int")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Sorted by (key, id), each shard is a run; a large group spreads over partitions by id.
    ordered = cut(
        rows.withColumn("shard", shard.cast("int"))
        .repartitionByRange(parts, "key", "id")
        .sortWithinPartitions("key", "id")
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33).cast("int")),
        "ordered",
    )
    runs = ordered.groupBy("shard", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).drop("first", "n")
    placed = ordered.join(runs, ["shard", "part"])
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.col("key").alias("group_key"),
        "shard",
        (F.col("place") + F.col("offset")).alias("slot"),
    )

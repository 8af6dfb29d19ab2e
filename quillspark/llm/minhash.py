"""Near-duplicate groups of documents by SuperMinHash.

A document's set is its distinct word shingles.  Documents with the same set form a class and only
its smallest id goes on.  Signatures come from SuperMinHash: each element visits the slots in an
order of its own (a Fisher-Yates walk), the value of a slot is the smallest rank plus fraction over
all elements, and the walk stops once no later rank can lower a slot.  Bands of the signature are
buckets.  In each bucket all members are compared with two hubs; after the groups of these links are
known, only pairs of members that lie in different groups are left (``components.bucket_groups``).  So
a bucket of one large group costs two comparisons a member.  The pairs left are compared where the
bucket lies, in blocks of its members, and never become rows: many texts that share a long passage
but are no duplicates make very many of them.  Of these pairs, those go unchecked whose sizes cannot
reach the similarity or whose sketches, one bit of each slot, differ in over 32 of 128 places; the
others are compared on their sets, hashed to 32 bits, which never lowers an intersection, and only
those that pass are confirmed on the full sets.

With 32 bands of 4 slots, two sets of similarity 0.8 share no band once in twenty million times;
their sketches differ in 13 places on average, and in over 32 once in three million times.

Defined cases: without words or text a document's set is empty and linked with nothing; with fewer
words than a shingle the whole sequence is the one shingle; rows repeating an id and text share a
result; a null id is never a representative: its component is null, and it is kept, unless its set
has a copy with an id; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.components import bucket_groups
from quillspark.llm.shared import arrow_map, cut, mix, word_hashes

U = np.uint64
#: Elements whose walks are held together; a longer document is taken in parts.
ELEMENTS = 150_000
#: Members of a bucket that are compared in one task with as many others.
BLOCK = 4096


def shingles_of(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles, as ascending 64-bit hashes, of the hashes of a text's words."""
    if not len(words):
        return words
    if len(words) < width:
        # With the length: never equal to a full shingle.
        h = np.array([len(words)], U)
        for w in words:
            h = mix(h * U(0x9E3779B97F4A7C15) + w)
        return h
    total = np.zeros(len(words) - width + 1, U)
    for j in range(width):
        total = mix(total + words[j : len(words) - width + 1 + j] * U(2 * j + 0x9E3779B1))
    return np.unique(total)


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """``shingles_of`` a text; A-Z are lower-cased."""
    return shingles_of(word_hashes(text.lower())[1], width)


def super_minhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures (documents x slots) of non-empty sets: rank in the high half, fraction in the low."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets)
    signature = np.full(len(sets) * slots, np.iinfo(np.int64).max, np.int64)
    walk = np.tile(np.arange(slots, dtype=np.uint16), len(elements))
    active = np.arange(len(elements))
    for rank in range(slots):
        x = mix(elements[active] + U((rank + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1))
        k = rank + ((x >> U(32)) * U(slots - rank) >> U(32)).astype(np.int64)
        base = active * slots
        slot = walk[base + k]
        walk[base + k] = walk[base + rank]
        value = (rank << 32) + (x & U(0xFFFFFFFF)).astype(np.int64)
        np.minimum.at(signature, owner[active] * slots + slot, value)
        open_ = signature.reshape(-1, slots).max(1) >= (rank + 1) << 32
        if not open_.any():
            break
        if not open_.all():
            active = active[open_[owner[active]]]
    return signature.reshape(-1, slots)


def band_hashes(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = signature.view(U).reshape(len(signature), bands, -1)
    h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U)), rows.shape[:2])
    for j in range(rows.shape[2]):
        h = mix(h * U(0x9E3779B97F4A7C15) + rows[:, :, j])
    return h.view(np.int64)


def signatures(docs: DataFrame, width: int, slots: int, bands: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, k1, k2, bands, sketch): size of the set, its 128-bit fingerprint, its buckets and one
    bit of each slot."""
    import xxhash

    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        keys, texts, weight = [], [], 0

        def done():
            places, hashed = word_hashes(b"\n".join(texts))
            ends = np.searchsorted(places, np.cumsum([len(t) + 1 for t in texts])).tolist()
            sets = [shingles_of(hashed[a:b], width) for a, b in zip([0, *ends], ends)]
            some = [s for s in sets if len(s)]
            parts = [(i, s[a : a + ELEMENTS]) for i, s in enumerate(some) for a in range(0, len(s), ELEMENTS)]
            sig = np.full((len(some), slots), np.iinfo(np.int64).max, np.int64)
            at = 0
            while at < len(parts):
                to, n = at, 0
                while to < len(parts) and (to == at or n + len(parts[to][1]) <= ELEMENTS):
                    n += len(parts[to][1])
                    to += 1
                own = super_minhash([p for _, p in parts[at:to]], slots)
                np.minimum.at(sig, [i for i, _ in parts[at:to]], own)
                at = to
            bucket = iter(band_hashes(sig, bands).tolist() if some else [])
            bits = iter(np.packbits(sig.astype(np.uint8) & 1, axis=1).view(np.int64).tolist())
            for key, s in zip(keys, sets):
                d = xxhash.xxh3_128_digest(s.tobytes())
                yield key, len(s), int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), next(bucket) if len(s) else [], next(bits) if len(s) else []

        for r in rows:
            keys.append(r["id"])
            texts.append((r["text"] or b"").lower())
            weight += len(texts[-1])
            if weight > 8 * ELEMENTS or len(keys) >= 2048:
                yield from done()
                keys, texts, weight = [], [], 0
        if keys:
            yield from done()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return arrow_map(rows, run, f"id {kind}, n long, k1 long, k2 long, bands array<long>, sketch array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles, small) of the documents named in ``nodes``; small: the set in 32-bit hashes."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("binary").alias("text")).join(nodes, "node", "left_semi")

    def run(rows):
        for r in rows:
            found = shingle_hashes(r["text"] or b"", width)
            yield r["node"], found.view(np.int64).tolist(), np.unique(found.astype(np.uint32)).tobytes()

    return arrow_map(rows, run, f"node {kind}, shingles array<long>, small binary").dropDuplicates(["node"])


def close_pairs(bucket: int, members: list[dict], percent: int, slots: int):
    """Pairs (a, b) of a block's members that may reach ``percent`` and whose first common band is
    ``bucket``.  A member has side (which of the two blocks), node, g, n, sketch, bands and small."""
    members = sorted(members, key=lambda m: m["side"])
    groups = {g: i for i, g in enumerate(dict.fromkeys(m["g"] for m in members))}
    g, n = np.array([groups[m["g"]] for m in members]), np.array([m["n"] for m in members])
    # Unsigned: numpy counts the bits of a signed number's absolute value.
    sketch = np.array([m["sketch"] for m in members], np.int64).view(U)
    bands = np.array([m["bands"] for m in members], np.int64)
    sets = [np.frombuffer(m["small"], np.uint32) for m in members]
    first = sum(m["side"] == 0 for m in members)
    two = first < len(members)
    for x in range(first if two else len(members)):
        rest = slice(first, None) if two else slice(x + 1, None)
        start = rest.start
        far = np.bitwise_count(sketch[rest] ^ sketch[x]).sum(1)
        fits = (g[rest] != g[x]) & (far <= slots // 4) & (100 * np.minimum(n[rest], n[x]) >= percent * np.maximum(n[rest], n[x]))
        ys = start + np.flatnonzero(fits)
        before = int(np.flatnonzero(bands[x] == bucket)[0])
        ys = ys[~(bands[ys, :before] == bands[x, :before]).any(1)] if before else ys
        for part in np.array_split(ys, -(-len(ys) // 2048)) if len(ys) else ():
            several = [sets[y] for y in part]
            sizes = np.array([len(v) for v in several])
            values = np.concatenate(several)
            at = np.searchsorted(sets[x], values)
            at[at == len(sets[x])] = 0
            common = np.add.reduceat((sets[x][at] == values).astype(np.int64), np.cumsum(sizes) - sizes)
            # 32-bit hashes may coincide within a set as well: that only lowers the sizes, not n.
            lost = n[part] - sizes + n[x] - len(sets[x])
            for y in part[100 * (common + lost) >= percent * (n[part] + n[x] - common - lost)].tolist():
                a, b = members[x]["node"], members[y]["node"]
                yield (a, b) if a < b else (b, a)


def settle_in_blocks(members: DataFrame, traits: DataFrame, sets: DataFrame, percent: int, slots: int) -> DataFrame:
    """``close_pairs`` of all buckets: a bucket's members are dealt into blocks by hash, and each pair of
    blocks is one group of rows."""
    kind = members.schema["node"].dataType.simpleString()
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("bucket", "node", "g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    full = dealt.join(traits, "node").join(sets.select("node", "small"), "node")
    grouped = full.groupBy("bucket", "i", "j").agg(F.collect_list(F.struct("side", "node", "g", "n", "sketch", "bands", "small")).alias("members"))

    def run(rows):
        for r in rows:
            yield from close_pairs(r["bucket"], r["members"], percent, slots)

    return arrow_map(grouped, run, f"a {kind}, b {kind}")


def confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    sized = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("i"), (F.size("x") + F.size("y")).alias("s"))
    return sized.where(F.expr(f"100 * i >= {int(percent)} * (s - i)")).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, slots: int = 128, bands: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``slots`` is a multiple of 64.  Per row: id, n_shingles, component_id (smallest id of the group), kept (it is that id)."""
    sigs = cut(signatures(docs, width, slots, bands, id_col, text_col), "signatures")
    full = sigs.where("n > 0")
    classes = cut(full.groupBy("k1", "k2").agg(F.min("id").alias("node")), "classes")
    chosen = full.join(classes, ["k1", "k2"]).where("id = node")
    buckets = chosen.select(F.explode("bands").alias("bucket"), "node")

    prepared = {}

    def prepare(nodes: DataFrame):
        prepared["sets"] = cut(full_sets(docs, nodes, width, id_col, text_col), "sets")
        return lambda pairs: confirm(prepared["sets"], pairs, percent)

    traits = chosen.dropDuplicates(["node"]).select("node", "n", "sketch", "bands")
    found = bucket_groups(buckets, prepare, settle=lambda m: settle_in_blocks(m, traits, prepared["sets"], percent, slots))
    groups = classes.join(found, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component"))
    found = full.join(groups, ["k1", "k2"]).select("id", "n", "component")
    alone = sigs.where("n = 0").select("id", "n", F.col("id").alias("component"))
    return found.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.expr("id <=> component").alias("kept"))

"""Scoring of documents by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``order`` with counts from the training rows.  A byte is
coded in the longest context seen; if it was not seen there, an escape (method D: half a count for
each different symbol of the context, taken from that symbol) leads to the next shorter context, where the symbols already
refused no longer count (exclusion).  Below the empty context all symbols left are alike.  Texts
are lower-cased (A-Z) and end with an end symbol, so the probabilities of all texts sum to one.

A count of an (order+1)-gram of bytes holds the whole trie: dropping the oldest byte gives the
counts one order lower.  With a fixed model, the cost of a byte depends on its gram alone.  So:

1. Each block (see ``shared``) counts the grams of its training rows and lists those of the others.
2. Grams are merged by their two latest context bytes; a shard then holds all contexts of order 2
   and more of its grams, orders 0 and 1 are a table of at most 65,536 counts.  Each shard works
   out the cost of every gram that some block has.
3. Each block gets back the costs of its own grams and adds them up by document.

The words of the base score take the same way.  Nothing that grows with the input is collected or
broadcast, and all rows are read.

Defined cases: a null text is empty and has the end alone; a row without an id trains and is not
held out; a repeated row trains and is scored again; without training rows every cost is that of the
uniform model and the base score is 0 for an empty text; an empty table gives no rows; further
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import (
    arrow_map, blocks, cut, gather, mix, pack, planes, read_block, split_ranges, stage, summed, unplanes, unpack, word_hashes)

U = np.uint64
#: Context bytes; a gram and the number of a document then fit in 64 bits.
ORDER = 5
#: Stands for the time before a text and for its end; no UTF-8 text has it.
EDGE = 255
CHUNK = 1 << 20


def grams(data: np.ndarray) -> np.ndarray:
    """For each byte from the ``ORDER``-th on: latest context byte first, the byte itself last."""
    n = len(data) - ORDER
    wide = data.astype(U)
    out = wide[ORDER:].copy()
    for back in range(1, ORDER + 1):
        out |= wide[ORDER - back : ORDER - back + n] << U(8 * (ORDER + 1 - back))
    return out


class Chunk:
    """Some documents of a block, or a part of a long one."""

    def __init__(self, texts: list[tuple[int, bytes, bytes, bool]]):
        """texts: (row number, context before, text, whether it ends here)."""
        parts, sizes = [], []
        for _, before, text, last in texts:
            parts += [before, text, b"\xff" if last else b""]
            sizes.append(len(text) + last)
        self.rows = np.array([t[0] for t in texts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array(sizes)
        ends = np.cumsum(sizes + ORDER) - ORDER
        keep = np.ones(len(data) - ORDER, bool)
        for e in ends[:-1].tolist():  # grams that would reach over the start of a text
            keep[e : e + ORDER] = False
        self.grams = grams(data)[keep]
        self.owner = np.repeat(np.arange(len(sizes)), sizes)


def read(block: str) -> Iterator[tuple[list, list[np.ndarray], Iterator[Chunk]]]:
    """Batches of rows: (id, train) of each, word hashes of each, and the chunks of their texts."""
    rows, texts, weight = [], [], 0

    def done():
        places, hashed = word_hashes(b"\n".join(texts))
        ends = np.searchsorted(places, np.cumsum([len(t) + 1 for t in texts])).tolist()
        words = [hashed[a:b] for a, b in zip([0, *ends], ends)]

        def chunks():
            some, held = [], 0
            for i, t in enumerate(texts):
                for a in range(0, max(1, len(t)), CHUNK):
                    b = min(len(t), a + CHUNK)
                    before = (b"\xff" * ORDER + t[max(0, a - ORDER) : a])[-ORDER:]
                    some.append((i, before, t[a:b], b == len(t)))
                    held += b - a
                    if held >= CHUNK:
                        yield Chunk(some)
                        some, held = [], 0
            if some:
                yield Chunk(some)

        return rows, words, chunks()

    for batch in read_block(block, ["id", "text", "train"]):
        for key, text, train in zip(batch["id"], batch["text"], batch["train"]):
            rows.append((key, train))
            texts.append((text or "").encode().lower())
            weight += len(texts[-1])
            if weight >= CHUNK or len(rows) >= 32_768:
                yield done()
                rows, texts, weight = [], [], 0
    if rows:
        yield done()


class Tally:
    """Distinct keys with summed counts, in bounded memory apart from the distinct keys."""

    def __init__(self):
        self.keys, self.counts, self.new, self.size = np.zeros(0, U), np.zeros(0, np.int64), [], 0

    def add(self, values: np.ndarray, train: bool) -> None:
        keys, counts = np.unique(values, return_counts=True)
        self.new.append((keys, counts if train else np.zeros(len(keys), np.int64)))
        self.size += len(keys)
        if self.size > max(1_000_000, len(self.keys)):
            self.settle()

    def settle(self) -> "Tally":
        both = [(self.keys, self.counts), *self.new]
        self.keys, self.counts = summed(np.concatenate([k for k, _ in both]), np.concatenate([c for _, c in both]))
        self.new, self.size = [], 0
        return self


def shards(keys: np.ndarray, ranges: int) -> list[tuple[int, np.ndarray]]:
    """(shard, places of its keys in order), by the two latest context bytes."""
    shard = (mix(keys >> U(8 * (ORDER - 1))) >> U(32)).astype(np.int64) % ranges
    order = np.argsort(shard.astype(np.uint16), kind="stable")
    edges = np.searchsorted(shard[order], np.arange(ranges + 1)).tolist()
    return [(r, order[a:b]) for r, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]


def gram_costs(needed: np.ndarray, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, step: int = 2048) -> np.ndarray:
    """log10 probability of the needed grams (ascending) under the trie of ``keys`` and ``counts``
    (training grams, ascending) and ``pairs``, the 256 x 256 counts of (context byte, symbol)."""
    tables = {}
    for k in range(2, ORDER + 1):
        prefix = keys >> U(8 * (ORDER + 1 - k))
        tables[k] = summed(prefix << U(8) | keys & U(255), counts)
    contexts, start = np.unique(needed >> U(8), return_index=True)
    ends = np.append(start[1:], len(needed))
    out = np.empty(len(needed), np.float32)
    empty = pairs.sum(0).astype(float)
    for at in range(0, len(contexts), step):
        some = contexts[at : at + step]
        left = np.ones((len(some), 256), bool)
        escape, logs = np.zeros(len(some)), np.zeros((len(some), 256))
        for k in range(ORDER, -1, -1):
            if k >= 2:
                names, own = np.unique(some >> U(8 * (ORDER - k)), return_inverse=True)
                table, amount = tables[k]
                a = np.searchsorted(table, names << U(8))
                b = np.searchsorted(table, (names << U(8)) + U(256))
                dense = np.zeros((len(names), 256))
                which = np.repeat(np.arange(len(names)), b - a)
                place = np.arange(len(which)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
                dense[which, (table[place] & U(255)).astype(int)] = amount[place]
                dense = dense[own]
            elif k == 1:
                dense = pairs[(some >> U(8 * (ORDER - 1))).astype(int)].astype(float)
            else:
                dense = np.broadcast_to(empty, left.shape).copy()
            dense[~left] = 0
            seen = dense > 0
            kinds, total = seen.sum(1), dense.sum(1)
            with np.errstate(divide="ignore", invalid="ignore"):
                value = escape[:, None] + np.log10((dense - 0.5) / total[:, None])
                logs[seen] = value[seen]
                active = kinds > 0
                escape[active] += np.log10(0.5 * kinds[active] / total[active])
            left &= ~seen
        rest = left.sum(1)
        logs = np.where(left, (escape - np.log10(np.maximum(rest, 1)))[:, None], logs)
        a, b = start[at], ends[at + len(some) - 1]
        row = np.repeat(np.arange(len(some)), ends[at : at + len(some)] - start[at : at + len(some)])
        out[a:b] = logs[row, (needed[a:b] & U(255)).astype(int)]
    return out


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, train, n_tokens, n_known, train_tokens, base_score, score, n_bytes.

    ``train``: which rows the model learns from (null: it does).  Scores are log10 probabilities."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    path = stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(True)).alias("train")), "lm")
    where = blocks(spark, path)
    ranges = 1 << min(16, max(0, where.count() - 1).bit_length())
    learnt = spark.read.parquet(path).where("train").count()

    def count(rows):
        for r in rows:
            words, bytes_ = Tally(), Tally()
            for own, hashed, chunks in read(r["block"]):
                for train_too in (True, False):
                    some = [h for (_, t), h in zip(own, hashed) if t == train_too]
                    if some:
                        words.add(np.concatenate(some), train_too)
                flags = np.array([t for _, t in own])
                for c in chunks:
                    mask = flags[c.rows][c.owner]
                    bytes_.add(c.grams[mask], True)
                    bytes_.add(c.grams[~mask], False)
            words.settle()
            for k, a, b in split_ranges(words.keys, ranges):
                yield 0, k, r["block"], pack(words.keys[a:b]), planes(words.counts[a:b]), [], []
            bytes_.settle()
            for k, at in shards(bytes_.keys, ranges):
                yield 1, k, r["block"], pack(bytes_.keys[at]), planes(bytes_.counts[at]), [], []
            pair = ((bytes_.keys >> U(8 * ORDER)) << U(8) | bytes_.keys & U(255)).astype(np.int64)
            n = np.bincount(pair, weights=bytes_.counts, minlength=1).astype(np.int64)
            there = np.nonzero(n)[0]
            yield 2, 0, r["block"], b"", b"", there.tolist(), n[there].tolist()

    counted = cut(arrow_map(where, count, "kind int, part int, block string, keys binary, counts binary, pairs array<int>, ns array<long>"), "lm-counts")
    each = counted.where("kind = 2").select(F.explode(F.arrays_zip("pairs", "ns")).alias("x")).groupBy("x.pairs").agg(F.sum("x.ns").alias("n"))
    pairs = np.zeros((256, 256), np.int64)
    for pair, n in each.collect():  # at most 65,536 rows
        pairs[pair >> 8, pair & 255] = n

    def merge(rows):
        for r in rows:
            keys = [unpack(x["keys"]) for x in r["found"]]
            all_keys, total = summed(np.concatenate(keys), np.concatenate([unplanes(x["counts"]) for x in r["found"]]).astype(np.int64))
            if r["kind"] == 0:
                value = total
                yield 0, None, None, None, int((total > 0).sum()), int(total.sum())
            else:
                known = total > 0
                value = gram_costs(all_keys, all_keys[known], total[known], pairs)
            for x, k in zip(r["found"], keys):
                own = value[np.searchsorted(all_keys, k)]
                yield r["kind"], x["block"], x["keys"], planes(own) if r["kind"] == 0 else own.tobytes(), 0, 0

    found = gather(counted.where("kind < 2"), ["kind", "part"], "block", "keys", "counts")
    merged = cut(arrow_map(found, merge, "kind int, block string, keys binary, data binary, v long, n long"), "lm-costs")
    v, n = (int(x or 0) for x in merged.where("block IS NULL").agg(F.sum("v"), F.sum("n")).first())
    total, distinct = n + learnt, v + (learnt > 0)

    def base(counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (total + 0.5 * (distinct + 1)))

    end = float(base(np.array([learnt]))[0])

    def add_up(rows):
        for r in rows:
            parts = {k: [x for x in r["found"] or () if x["kind"] == k] for k in (0, 1)}
            table = {}
            for k in (0, 1):
                keys = np.concatenate([np.zeros(0, U), *[unpack(x["keys"]) for x in parts[k]]])
                data = [unplanes(x["data"]).astype(np.int64) if k == 0 else np.frombuffer(x["data"], np.float32) for x in parts[k]]
                order = np.argsort(keys, kind="stable")
                table[k] = keys[order], np.concatenate([np.zeros(0), *data])[order]
            for own, hashed, chunks in read(r["block"]):
                sums = np.zeros(len(own))
                for c in chunks:
                    both = np.sort(c.grams << U(16) | c.owner.astype(U))
                    gram = both >> U(16)
                    new = np.concatenate([[True], gram[1:] != gram[:-1]])
                    cost = table[1][1][np.searchsorted(table[1][0], gram[new])]
                    cost = np.repeat(cost, np.diff(np.nonzero(new)[0], append=len(gram)))
                    each = np.bincount((both & U(65535)).astype(np.int64), cost, len(c.rows))
                    np.add.at(sums, c.rows, each)
                sizes = np.array([len(h) for h in hashed])
                at = np.searchsorted(table[0][0], np.concatenate(hashed))
                counts = table[0][1][at]
                owner = np.repeat(np.arange(len(own)), sizes)
                plain = np.bincount(owner, base(counts), len(own)) + end
                known = np.bincount(owner, counts > 0, len(own)).astype(np.int64) + (learnt > 0)
                for i, (key, t) in enumerate(own):
                    yield key, t, int(sizes[i]) + 1, int(known[i]), total, float(plain[i]), float(sums[i])

    side = where.join(gather(merged.where("block IS NOT NULL"), ["block"], "kind", "keys", "data"), "block", "left")
    return arrow_map(side, add_up, f"id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

"""Removal of repeated word windows with a count-min prefilter.

The input is staged once as blocks (see ``shared``).  Three passes over the blocks:

1. Each block counts its windows in a count-min sketch of ``depth`` rows whose width follows the
   input's size.  The sketch is sparse: only touched counters are sent, as sorted integers, by
   range of the counter.  Each range is merged over all blocks; a merged count is never below the
   true one, so no repeated window is lost.
2. Each block gets back its own counters of 2 and more and sends the 96-bit fingerprints of just
   the windows that all rows estimate as repeated.  These are grouped exactly, again by range.
3. Each block gets back its windows found twice and drops the words that they cover.

Nothing is collected or broadcast; a task holds one block's part or one range.  A window found
thousands of times in a block is sent once, with a mark, so hot passages do not gather anywhere.

Defined cases: a null text has no words; a text shorter than a window keeps all; every row counts
as a document of its own, so a repeated row repeats its windows; windows overlapping themselves
count; an empty table gives no rows; a null id is kept; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import arrow_map, blocks, gather, mix, pack, powers, read_block, split_ranges, stage, unpack, word_hashes

U = np.uint64
#: Text bytes that a task looks at together.
CHUNK = 3 << 20
#: Rows of a chunk at most, for tables of empty and very short texts.
CHUNK_ROWS = 65_536
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _windows(words: np.ndarray, base: int, starts: np.ndarray, window: int) -> np.ndarray:
    """64-bit hashes of the windows at these starts."""
    up, down = powers(base, len(words) + 1)
    sums = np.zeros(len(words) + 1, U)
    np.cumsum(words * up[: len(words)], dtype=U, out=sums[1:])
    return mix((sums[starts + window] - sums[starts]) * down[starts])


class Chunk:
    """Some documents of a block: the hashes of their words and where windows start."""

    def __init__(self, number: int, ids: list, texts: list[bytes], window: int):
        self.number, self.ids, self.texts, self.window = number, ids, texts, window
        places, self.hashed = word_hashes(b"\n".join(texts))
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.ends = np.searchsorted(places, begins[1:])
        self.lengths = np.diff(self.ends, prepend=0)
        last = np.repeat(self.ends - window, self.lengths)
        self.starts = np.nonzero(np.arange(len(self.hashed)) <= last)[0]

    def first(self) -> np.ndarray:
        return _windows(self.hashed, _BASES[0], self.starts, self.window)

    def second(self, which: np.ndarray) -> np.ndarray:
        return _windows(mix(self.hashed ^ U(0xA5A5A5A5A5A5A5A5)), _BASES[1], self.starts[which], self.window) >> U(32)


def chunks(block: str, window: int) -> Iterator[Chunk]:
    number, ids, texts, weight = 0, [], [], 0
    for batch in read_block(block, ["id", "text"]):
        for key, text in zip(batch["id"], batch["text"]):
            text = (text or "").encode()
            ids.append(key)
            texts.append(text)
            weight += len(text)
            if weight >= CHUNK or len(ids) >= CHUNK_ROWS:
                yield Chunk(number, ids, texts, window)
                number, ids, texts, weight = number + 1, [], [], 0
    if ids:
        yield Chunk(number, ids, texts, window)


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(hashes ^ U(0x5851F42D4C957F2D * (row + 1) & (1 << 64) - 1)) >> U(64 - bits)


def _split(values: np.ndarray, bits: int, ranges: int) -> list[tuple[int, int, int]]:
    """(range, from, to) of ascending ``values`` below 2**bits."""
    step = (1 << bits) // ranges
    edges = np.searchsorted(values, np.arange(1, ranges, dtype=U) * U(step)).tolist()
    return [(r, a, b) for r, (a, b) in enumerate(zip([0, *edges], [*edges, len(values)])) if b > a]


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    if len(values) < 300_000:
        at = np.searchsorted(among, values)
        at[at == len(among)] = 0
        return among[at] == values
    # Most values are not there: a table of their hashes' low bits spares them the search.
    low = U((1 << 24) - 1)
    table = np.zeros(1 << 24, bool)
    table[mix(among) & low] = True
    out = table[mix(values) & low]
    left = values[out]
    at = np.searchsorted(among, left)
    at[at == len(among)] = 0
    out[out] = among[at] == left
    return out


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def _by_chunk(found: list[dict] | None) -> dict[int, list[dict]]:
    out: dict[int, list[dict]] = {}
    for x in found or ():
        out.setdefault(x["chunk"], []).append(x)
    return out


def remove_repeated(docs: DataFrame, window: int = 35, depth: int = 2, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256[, kept] after removing every word that a
    window found at another start, anywhere, covers."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    path = stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "substrings")
    size = spark.read.parquet(path).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    where = blocks(spark, path)
    bits = max(16, math.ceil(math.log2(size + 1)))
    # Four ranges for each block: a range's counters from all blocks are then a quarter of a block's.
    ranges = min(1 << 16, 4 << max(0, where.count() - 1).bit_length())

    def sketch(rows):
        for r in rows:
            for c in chunks(r["block"], window):
                hashes = c.first()
                for row in range(depth):
                    cells, counts = np.unique(_cells(hashes, row, bits), return_counts=True)
                    for k, a, b in _split(cells, bits, ranges):
                        yield row, k, r["block"], c.number, pack(cells[a:b]), _bits(counts[a:b] > 1)

    def merge(rows):
        for r in rows:
            each = [unpack(x["cells"]) for x in r["found"]]
            marks = [_flags(x["twice"], len(e)) for x, e in zip(r["found"], each)]
            cells = np.sort(np.concatenate(each + [e[m] for e, m in zip(each, marks)]))
            often = np.unique(cells[1:][cells[1:] == cells[:-1]])
            flags, at = _member(np.concatenate(each), often), 0
            for x, e in zip(r["found"], each):
                hit = e[flags[at : at + len(e)]]
                at += len(e)
                if len(hit):
                    yield x["block"], x["chunk"], r["row"], pack(hit)

    sketches = arrow_map(where, sketch, "row int, part int, block string, chunk int, cells binary, twice binary")
    merged = arrow_map(gather(sketches, ["row", "part"], "block", "chunk", "cells", "twice"), merge, "block string, chunk int, row int, cells binary")

    def candidates(rows):
        for r in rows:
            found = _by_chunk(r["found"])
            for c in chunks(r["block"], window):
                hashes, which = c.first(), None
                for row in range(depth):
                    own = [unpack(x["cells"]) for x in found.get(c.number, ()) if x["row"] == row]
                    often = np.sort(np.concatenate(own)) if own else np.zeros(0, U)
                    left = np.arange(len(hashes)) if which is None else which
                    which = left[_member(_cells(hashes[left], row, bits), often)]
                if not len(which):
                    continue
                one, two = hashes[which], c.second(which)
                order = np.lexsort((two, one))
                one, two = one[order], two[order]
                new = np.ones(len(one), bool)
                new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
                at = np.nonzero(new)[0]
                twice = np.diff(at, append=len(one)) > 1
                one, two = one[at], two[at]
                for k, a, b in split_ranges(one, ranges):
                    yield k, r["block"], c.number, pack(one[a:b]), two[a:b].astype(np.uint32).tobytes(), _bits(twice[a:b])

    def group(rows):
        for r in rows:
            ones = [unpack(x["one"]) for x in r["found"]]
            one = np.concatenate(ones)
            two = np.concatenate([np.frombuffer(x["two"], np.uint32) for x in r["found"]])
            more = np.concatenate([_flags(x["twice"], len(e)) for x, e in zip(r["found"], ones)])
            order = np.lexsort((two, one))
            a, b = one[order], two[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            at = np.nonzero(new)[0]
            often = np.add.reduceat(1 + more[order].astype(np.int64), at) > 1
            flag = np.zeros(len(a), bool)
            flag[order] = np.repeat(often, np.diff(at, append=len(a)))
            start = 0
            for x, e in zip(r["found"], ones):
                own = flag[start : start + len(e)]
                start += len(e)
                if own.any():
                    yield x["block"], x["chunk"], pack(e[own])

    side = where.join(gather(merged, ["block"], "chunk", "row", "cells"), "block", "left")
    chosen = arrow_map(side, candidates, "part int, block string, chunk int, one binary, two binary, twice binary")
    exact = arrow_map(gather(chosen, ["part"], "block", "chunk", "one", "two", "twice"), group, "block string, chunk int, one binary")

    def keep(rows):
        for r in rows:
            found = _by_chunk(r["found"])
            for c in chunks(r["block"], window):
                own = [unpack(x["one"]) for x in found.get(c.number, ())]
                cover = np.zeros(len(c.hashed) + 1, np.int32)
                if own:
                    hit = c.starts[_member(c.first(), np.sort(np.concatenate(own)))]
                    np.add.at(cover, hit, 1)
                    np.add.at(cover, hit + window, -1)
                stay = np.cumsum(cover[:-1]) == 0
                for key, text, end, n in zip(c.ids, c.texts, c.ends.tolist(), c.lengths.tolist()):
                    own = stay[end - n : end]
                    left = int(own.sum())
                    words = text.split()
                    text = b" ".join(words if left == n else compress(words, own.tolist()))
                    row = (key, n, n - left, hashlib.sha256(text).hexdigest())
                    yield (*row, text.decode()) if with_text else row

    side = where.join(gather(exact, ["block"], "chunk", "one"), "block", "left")
    return arrow_map(side, keep, f"id {kind}, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else ""))

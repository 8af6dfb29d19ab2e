"""Alignment of two tokenizers: which tokens of A cover the same bytes as which tokens of B.

Byte offsets at which tokens of both end cut a text into groups; every A token of a group is linked
to every B token of it.  For an id pair the corpus-wide count is the number of documents that hold
it linked.

Tasks take documents a chunk (a few megabytes of text) at a time.  Words are looked up in a bounded
store of the two tokenizers' ids: neither merges across a single space between visible characters,
so a text's ids are those of its words in a row.  All documents of a chunk are then merged in
lockstep: one state vector holds, for each document, its place in A and in B; each step moves the
side that ends first (both, at a cut), emits the cuts that were met, and takes finished documents
out of the vector.  Long documents enter as several lanes, each starting at an A token further on;
such a lane first seeks its first cut, and the lane before it stops at that same cut.

A chunk leaves its documents (one row each, their distinct pairs as places in the chunk's list of
pairs) and that list with the number of its documents that hold each pair.  Only the lists are
summed over the corpus; the answers come back to each chunk by a co-group, so nothing grows with the
corpus in one task.

Defined cases: texts that are null, empty, or that either tokenizer's tokens don't spell out exactly
have no tokens: all counts are zero and the digest is empty.  A null id is kept, repeated rows are
documents of their own, an empty table gives no rows, further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspark.llm.shared import cut, pack, planes, unpack, unplanes

#: A's tokens in one lane at first; links of a group that are listed one by one.
LANE, SMALL_GROUP = 128, 1024
#: Bytes of text and rows of a chunk.
CHUNK_BYTES, CHUNK_ROWS = 3 << 20, 8192
#: B's ids are below 2**B_BITS; a pair is ``a << B_BITS | b``.
B_BITS = 15


class TwoTokenizers:
    """Ids and byte lengths of both tokenizers' tokens for the words of a text.

    A is a byte-level file of the tokenizers library and is given space + text; B is a SentencePiece
    model that adds the space itself.  The store of words is bounded; long words are not kept."""

    words_bound, kept_length = 400_000, 48
    #: A single space between visible characters: no token of either side reaches across it.
    between = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        n_b = self.b.get_piece_size()
        if n_b > 1 << B_BITS:
            raise ValueError("B has too many pieces")
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [self._piece(i) for i in range(n_b)]
        if any(" " in x.lstrip(" ") for x in (self.b.id_to_piece(i).replace("▁", " ") for i in range(n_b))):
            raise ValueError("a piece of B reaches across a space")
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_starts, self.b_starts = (np.array([x[:1] == b" " for x in side]) for side in (self.a_bytes, self.b_bytes))
        self.a_ranks, self.b_ranks = self._ranked()
        self.a_ids: dict[str, bytes] = {}
        self.b_ids: dict[str, bytes] = {}
        self.bad: set[str] = set()
        names = [str(i) for i in range(max(len(self.a_bytes), n_b))]
        n_a = len(self.a_bytes)
        self.spelled = [*(x + "," for x in names[:n_a]), *(x + "|" for x in names[:n_a]),
                        *(x + "," for x in names[:n_b]), *(x + ";" for x in names[:n_b])]

    def _ranked(self):
        """Rank encoders of A and of B, which are quicker and are used for ASCII words without white
        space.  A merges by the order of its merges, B by its scores; where that is the order of the
        ids, merging the lowest id first gives the same ids.  None for a side where it is not."""
        import tiktoken

        model = json.loads(self.a.to_str())["model"]
        made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
        added = set(self.a.get_added_tokens_decoder())
        plain = [i for i in range(len(self.b_bytes)) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))]
        plain = [i for i in plain if self.b_bytes[i].strip() or self.b_bytes[i] == b" "]  # runs of spaces don't arise
        longer = [i for i in plain if len(self.b.id_to_piece(i)) > 1]
        scores = [self.b.get_score(i) for i in longer]
        a = b = None
        if made == sorted(made) and min(made, default=-1) >= 256:
            from public_tokenizers import PATTERN

            ranks = {x: i for i, x in enumerate(self.a_bytes) if i not in added}
            a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        if all(x > y for x, y in zip(scores, scores[1:])):
            ranks = {self.b_bytes[i]: i for i in range(len(self.b_bytes)) if self.b.is_byte(i)} | {self.b_bytes[i]: i for i in plain}
            b = tiktoken.Encoding("b", pat_str=r" ?[^ ]+", mergeable_ranks=ranks, special_tokens={})
        return a, b

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def _learn(self, new: list[str]) -> None:
        """Store the ids of ``new`` words; a word that is not spelled out exactly is a bad one."""
        if not self._learn_joined(new):
            a = self.a.encode_batch([" " + w for w in new], add_special_tokens=False)
            b = self.b.encode(new, num_threads=1)
            for w, x, y in zip(new, a, b):
                x, text = x.ids, (" " + w).encode()
                if not b"".join([self.a_bytes[i] for i in x]) == text == b"".join([self.b_bytes[i] for i in y]):
                    self.bad.add(w)
                self.a_ids[w], self.b_ids[w] = array("H", x).tobytes(), array("H", y).tobytes()

    def _learn_joined(self, new: list[str]) -> bool:
        """The same for words without white space, as one text; False if that can't be told apart."""
        if any(len(w.split()) > 1 for w in new):
            return False
        line = " ".join(new)
        text, found = (" " + line).encode(), []
        plain = line.isascii()
        a = self.a_ranks.encode_ordinary(" " + line) if self.a_ranks and plain else self.a.encode(" " + line, add_special_tokens=False).ids
        b = self.b_ranks.encode_ordinary(" " + line) if self.b_ranks and plain else self.b.encode(line, num_threads=1)
        for ids, pieces, starts in ((a, self.a_bytes, self.a_starts), (b, self.b_bytes, self.b_starts)):
            if b"".join([pieces[i] for i in ids]) != text:
                return False
            cuts = (2 * np.flatnonzero(starts[np.array(ids)])).tolist()
            if len(cuts) != len(new):
                return False
            data = array("H", ids).tobytes()
            found.append([data[i:j] for i, j in zip(cuts, [*cuts[1:], len(data)])])
        self.a_ids.update(zip(new, found[0]))
        self.b_ids.update(zip(new, found[1]))
        return True

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A through all texts, how many of them each text has, the same for B); texts that
        are not spelled out exactly have none."""
        split = [self.between.split(t) if t else [] for t in texts]
        words = list(chain.from_iterable(split))
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
        self._know(numbers)
        of = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        code = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        bad = np.zeros(len(numbers), bool)
        bad[[numbers[w] for w in self.bad if w in numbers]] = True
        out = np.zeros(len(texts), bool)
        out[of[bad[code]]] = True
        of, code = of[~out[of]], code[~out[of]]
        found = []
        for ids in (self.a_ids, self.b_ids):
            stored = [ids[w] for w in numbers]
            flat = np.frombuffer(b"".join(stored), np.uint16).astype(np.int64)
            length = np.fromiter(map(len, stored), np.int64, len(stored)) // 2
            start = np.cumsum(length) - length
            n = length[code]
            found.append(flat[np.repeat(start[code] - np.cumsum(n) + n, n) + np.arange(n.sum())])
            found.append(np.bincount(of, weights=n, minlength=len(texts)).astype(np.int64))
        for w in [w for w in numbers if len(w) > self.kept_length]:
            del self.a_ids[w], self.b_ids[w]
            self.bad.discard(w)
        return found[0], found[1], found[2], found[3]

    def _know(self, words) -> None:
        """Have the ids of all ``words`` in the store."""
        new = [w for w in words if w not in self.a_ids]
        if len(self.a_ids) + len(new) > self.words_bound:
            for ids in (self.a_ids, self.b_ids):
                kept = {w: ids[w] for w in words if w in ids}
                ids.clear()
                ids.update(kept)
            self.bad.intersection_update(words)
        new.sort(key=len)
        kinds: tuple[list[str], ...] = ([], [], [])
        for w in new:
            kinds[2 if len(w.split()) != 1 else 0 if w.isascii() else 1].append(w)
        for some in kinds:
            for i in range(0, len(some), 2000):
                self._learn(some[i : i + 2000])


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level files write for each byte: visible Latin-1 characters stand for
    themselves, the other bytes, in order, for the characters from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def two_tokenizers(a_path: str, b_path: str) -> TwoTokenizers:
    return TwoTokenizers(a_path, b_path)


def lockstep_groups(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Rows (first A, first B, past A, past B) of all groups, in order.

    ``a_end`` and ``b_end`` are the byte offsets at which tokens end, through all documents in a row;
    ``a_from`` is each document's first A token.  Documents end at a cut by themselves."""
    if not len(a_from):
        return np.zeros((0, 4), np.int64)
    past = np.append(a_from[1:], len(a_end))
    lanes = -(-(past - a_from) // lane)
    first = np.cumsum(lanes) - lanes
    ia = np.repeat(a_from, lanes) + lane * (np.arange(lanes.sum()) - np.repeat(first, lanes))
    ib = np.searchsorted(b_end, a_end[ia])
    # A lane ends with the first cut not before its successor's first token (its document's end, for the last).
    limit = a_end[np.append(ia[1:], 0)]
    last = np.append(first[1:], len(ia)) - 1
    limit[last] = a_end[past - 1]
    begins = np.zeros(len(ia), bool)
    begins[first] = True
    ib[first] = np.searchsorted(b_end, np.where(a_from > 0, a_end[a_from - 1], 0), side="right")
    if len(a_end) + len(b_end) < 1 << 31 and a_end[-1] < 1 << 31:  # half the memory to move
        ia, ib, a_end, b_end, limit = (v.astype(np.int32) for v in (ia, ib, a_end, b_end, limit))
    sa, sb = np.where(begins, ia, -1), ib.copy()
    out: list[list[np.ndarray]] = [[], [], [], []]
    while len(ia):
        ea, eb = a_end[ia], b_end[ib]
        at = np.flatnonzero(ea == eb)
        ia += ea <= eb
        ib += eb <= ea
        if len(at):
            met = at[sa[at] >= 0]
            for column, v in zip(out, (sa, sb, ia, ib)):
                column.append(v[met])
            sa[at], sb[at] = ia[at], ib[at]
            done = ea[at] >= limit[at]
            if done.any():
                stay = np.ones(len(ia), bool)
                stay[at[done]] = False
                ia, ib, sa, sb, limit = ia[stay], ib[stay], sa[stay], sb[stay], limit[stay]
    groups = np.column_stack([np.concatenate(c) for c in out]).astype(np.int64) if out[0] else np.zeros((0, 4), np.int64)
    return groups[np.argsort(groups[:, 0], kind="stable")]


def linked_pairs(a: np.ndarray, b: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times) of the links: each A token of a group with each B token of it."""
    sa, sb, ta, tb = groups.T
    na, nb = ta - sa, tb - sb
    small = np.flatnonzero(na * nb <= SMALL_GROUP)
    n = (na * nb)[small]
    g = np.repeat(small, n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    of, pair, times = [g], [a[sa[g] + at // nb[g]] << B_BITS | b[sb[g] + at % nb[g]]], [np.ones(len(g), np.int64)]
    for i in np.flatnonzero(na * nb > SMALL_GROUP).tolist():
        x, nx = np.unique(a[sa[i] : ta[i]], return_counts=True)
        y, ny = np.unique(b[sb[i] : tb[i]], return_counts=True)
        pair.append((x[:, None] << B_BITS | y).ravel())
        times.append((nx[:, None] * ny).ravel())
        of.append(np.full(len(pair[-1]), i))
    return np.concatenate(of), np.concatenate(pair), np.concatenate(times)


def spell_groups(tokenizers: TwoTokenizers, a: np.ndarray, b: np.ndarray, groups: np.ndarray, bounds: np.ndarray):
    """For documents that end after ``bounds`` groups, their groups as ``a1,a2|b1;a3|b2,b3``."""
    sa, sb, ta, tb = groups.T
    n_a, n_b = len(tokenizers.a_length), len(tokenizers.b_length)
    codes = np.empty(len(a) + len(b), np.int64)
    at_a, at_b = np.arange(len(a)) + np.repeat(sb, ta - sa), np.arange(len(b)) + np.repeat(ta, tb - sb)
    codes[at_a], codes[at_b] = a, b + 2 * n_a
    codes[at_a[ta - 1]] += n_a
    codes[at_b[tb - 1]] += n_b
    spell, start = tokenizers.spelled.__getitem__, 0
    for g in bounds.tolist():
        end = int(ta[g - 1] + tb[g - 1])
        yield "".join(map(spell, codes[start:end].tolist()))[:-1]
        start = end


_DOC = "slot int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _align_chunk(tokenizers: TwoTokenizers, texts: list[bytes], with_groups: bool):
    """(columns of the chunk's documents, its distinct pairs, the number of documents with each)."""
    # What is no valid UTF-8 can't be spelled out.
    a, n_a, b, n_b = tokenizers.encode([t.decode("utf-8") if _valid(t) else "" for t in texts])
    full = np.flatnonzero(n_a)
    a_past = np.cumsum(n_a[full])
    groups = lockstep_groups(np.cumsum(tokenizers.a_length[a]), np.cumsum(tokenizers.b_length[b]), a_past - n_a[full])
    bounds = np.searchsorted(groups[:, 2], a_past, side="right")
    n_groups = np.zeros(len(texts), np.int64)
    n_groups[full] = np.diff(bounds, prepend=0)
    group, pair, times = linked_pairs(a, b, groups)
    slot = full[np.searchsorted(bounds, group, side="right")] if len(group) else group
    n_links = np.bincount(slot, weights=times, minlength=len(texts)).astype(np.int64)
    key = slot << 32 | pair
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    key, times = key[first], np.add.reduceat(times, first) if len(first) else times
    pairs, place, docs = np.unique(key & 0xFFFFFFFF, return_inverse=True, return_counts=True)
    ends = np.searchsorted(key >> 32, np.arange(len(texts)), side="right").tolist()
    places, repeats = [], []
    for s, e in zip([0, *ends], ends):
        places.append(pack(place[s:e].astype(np.uint64)))
        repeats.append(planes(times[s:e].astype(np.uint64)))
    digests, spelled = [""] * len(texts), [""] * len(texts)
    for i, text in zip(full.tolist(), spell_groups(tokenizers, a, b, groups, bounds)):
        digests[i] = hashlib.sha256(text.encode()).hexdigest()
        if with_groups:
            spelled[i] = text
    columns = {"slot": np.arange(len(texts), dtype=np.int32), "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
               "n_links": n_links, "groups_sha256": digests, "places": places, "repeats": repeats}
    if with_groups:
        columns["groups"] = spelled
    return columns, pairs, docs


def _valid(data: bytes) -> bool:
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) of each row.

    ``n_best`` counts the links whose pair has the highest count of all pairs of its A id, ties
    included; ``count_sum`` adds up the counts over the links; ``groups`` lists the ids of each group
    as ``a1,a2|b1;a3|b2,b3`` and ``groups_sha256`` is its digest."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    result = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" + (", groups string" if with_groups else "")
    staged = StructType.fromDDL(f"chunk long, pair long, place int, docs long, id {kind}, {_DOC}, places binary, repeats binary" + (", groups string" if with_groups else ""))
    schema, out_schema = _arrow_schema(staged), _arrow_schema(StructType.fromDDL(result))

    def batch(columns: dict, n: int) -> pa.RecordBatch:
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
        return pa.record_batch(arrays, schema=schema)

    def run(batches):
        tokenizers = two_tokenizers(a_path, b_path)
        chunk, keys, texts, weight = TaskContext.get().partitionId() << 32, [], [], 0

        def done():
            columns, pairs, n_docs = _align_chunk(tokenizers, texts, with_groups)
            yield batch({**columns, "id": keys, "chunk": np.full(len(keys), chunk)}, len(keys))
            for i in range(0, len(pairs), 65536):
                some = pairs[i : i + 65536]
                yield batch({"chunk": np.full(len(some), chunk), "pair": some, "place": np.arange(i, i + len(some), dtype=np.int32), "docs": n_docs[i : i + 65536]}, len(some))

        for b in batches:
            for i in range(b.num_rows):
                keys.append(b.column("id")[i].as_py())
                texts.append(b.column("text")[i].as_py() or b"")
                weight += len(texts[-1])
                if weight > CHUNK_BYTES or len(keys) >= CHUNK_ROWS:
                    yield from done()
                    chunk, keys, texts, weight = chunk + 1, [], [], 0
        if keys:
            yield from done()

    work = cut(rows.mapInArrow(run, staged), "aligned")
    pairs = work.where("pair IS NOT NULL").select("chunk", "pair", "place", "docs")
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    counts = counts.withColumn("a", F.shiftright("pair", B_BITS))
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    counts = counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    answers = pairs.select("chunk", "pair", "place").join(counts, "pair").select(F.col("chunk").alias("of"), "place", "count", "best")
    own = work.where("slot IS NOT NULL").drop("pair", "place", "docs")

    def back(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place] = right.column("count").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for p, r in zip(left.column("places"), left.column("repeats")):
            at, times = unpack(p.as_py()).astype(np.int64), unplanes(r.as_py()).astype(np.int64)
            n_best.append(int(times @ best[at]))
            count_sum.append(int(times @ count[at]))
        columns = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table([columns.get(f.name) or left.column(f.name).cast(f.type) for f in out_schema], schema=out_schema)

    return own.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(back, StructType.fromDDL(result))

"""Best-fit-decreasing packing of tokenised documents into sequences.

Each document is its token ids and an end id; longer ones are cut into full pieces.  Pieces are
dealt by hash into blocks of about ``block_pieces`` and each block is packed in one task: from the
longest piece down, each goes to the open sequence with the least room that still holds it, found
with a segment tree over remaining capacities.  The loss against packing everything at once is
under one sequence for each block.

Defined cases: a null or empty text is the end id alone; a repeated row is packed again; an empty
table gives no rows; a null id is kept; further columns are not looked at.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import arrow_map, cut

#: Code points below this are split into pieces here; words with others go whole to the tokenizer.
LATIN = 0x250


class WordIds:
    """Little-endian 32-bit ids of white-space separated words, from a word-level BPE file.

    The file's rules join nothing across white space, so a text's ids are its words' ids in a row.
    Words of ASCII and Latin letters are split by the file's own pattern and their parts looked up;
    parts not seen yet are given to the tokenizer many at a time.  Both stores are bounded."""

    words_bound, parts_bound = 400_000, 900_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        last = {i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")}
        self.last = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.last[list(last)] = True
        kinds = [unicodedata.category(chr(c))[0] for c in range(LATIN)]
        letters = "".join(re.escape(chr(c)) for c in range(LATIN) if kinds[c] == "L")
        digits = "".join(re.escape(chr(c)) for c in range(LATIN) if kinds[c] == "N")
        self.ascii = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+").findall
        self.latin = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{letters}{digits}]+").findall
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _learn(self, new: set[bytes]) -> None:
        split: dict[bytes, tuple | list] = {}
        for w in new:
            s = w.decode("utf-8")
            if s.isascii() and s.isalpha():
                split[w] = (s.lower(),)
            elif not s.isprintable() or max(s) >= chr(LATIN) or "<|" in s:
                ids = self.tokenizer.encode(s, add_special_tokens=False).ids
                self.words[w] = array("I", ids).tobytes()
            elif s.isascii() and "'" not in s:
                split[w] = self.ascii(s.lower())
            else:
                split[w] = self.latin(s.lower())
        missing = set().union(*split.values()).difference(self.parts)
        if len(self.parts) + len(missing) > self.parts_bound:
            self.parts.clear()
            missing = {x for p in split.values() for x in p}
        todo = list(missing)
        for i in range(0, len(todo), 500):
            some = todo[i : i + 500]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.nonzero(self.last[ids])[0] + 1
            if len(ends) != len(some):  # not one word each: ask for each alone
                self.parts |= {x: array("I", self.tokenizer.encode(x, add_special_tokens=False).ids).tobytes() for x in some}
                continue
            data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.parts |= {x: data[a:b] for x, a, b in zip(some, cuts, cuts[1:])}
        parts, words = self.parts, self.words
        for w, p in split.items():
            words[w] = parts[p[0]] if len(p) == 1 else b"".join([parts[x] for x in p])

    def encode(self, texts: list[bytes]):
        """The ids of each text, as bytes."""
        split = [t.split() for t in texts]
        words = set().union(*split)
        if len(self.words) + len(words) > self.words_bound:
            self.words = {w: self.words[w] for w in words & self.words.keys()}
        self._learn(words.difference(self.words))
        for s in split:
            yield b"".join(map(self.words.__getitem__, s))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenize(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces (id, piece, start, length, ids_crc32[, ids]) of each document."""
    end = array("I", [end_id]).tobytes()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        ids = word_ids(tokenizer_path)
        keys, texts, weight = [], [], 0

        def done():
            for key, data in zip(keys, ids.encode(texts)):
                data += end
                n = len(data) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = data[4 * start : 4 * (start + capacity)]
                    row = (key, piece, start, len(part) // 4, zlib.crc32(part))
                    yield (*row, part) if with_ids else row

        for r in rows:
            keys.append(r["id"])
            texts.append(r["text"] or b"")
            weight += len(texts[-1])
            if weight > 4 << 20 or len(keys) >= 65_536:
                yield from done()
                keys, texts, weight = [], [], 0
        yield from done()

    return arrow_map(rows, run, f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))


class TightestFit:
    """Segment tree over remaining capacities: which amounts of room some open sequence has."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: dict[int, list[int]] = {}

    def add(self, room: int, sequence: int) -> None:
        self.open.setdefault(room, []).append(sequence)
        i = room + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) with the smallest room of at least ``least``."""
        count, i = self.count, least + self.leaves
        while not count[i]:
            while i & 1:  # a right child: nothing further right under this parent
                i >>= 1
            if i == 0:
                return None
            i += 1
            if i & (i - 1) == 0:  # past the last leaf of this level
                return None
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """(sequence and offset of each piece in the given order, number of sequences)."""
    tree, n = TightestFit(capacity), 0
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        got = tree.take(lengths[i])
        room, k = got if got else (capacity, n)
        n += got is None
        sequence[i], offset[i] = k, capacity - room
        if room > lengths[i]:
            tree.add(room - lengths[i], k)
    return sequence, offset, n


def pack_pieces(pieces: DataFrame, capacity: int = 4096, block_pieces: int = 32_768) -> DataFrame:
    """``pieces`` (a table with ``length`` of 1 to ``capacity``, ``id``, ``piece`` and any others)
    with ``sequence_id`` and ``offset``."""
    pieces = cut(pieces, "pieces")
    blocks = max(1, -(-pieces.count() // block_pieces))
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64("id", "piece", "length"), F.lit(blocks)).cast("int"))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        block = int(frame["_block"].iloc[0])
        sequence, offset, _ = best_fit_decreasing(frame["length"].tolist(), capacity)
        frame = frame.drop(columns="_block")
        frame["sequence_id"] = np.array(sequence, np.int64) + (block << 32)
        frame["offset"] = np.array(offset, np.int64)
        return frame

    return dealt.groupBy("_block").applyInPandas(run, schema)

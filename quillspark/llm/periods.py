"""Periodic runs of words, found by multi-scale minimizers, and texts with the repeats taken out.

A run is a stretch of consecutive words with smallest period ``q`` (words q apart are equal), at
least ``max(min_length, 2 * q)`` words long, that no neighbouring word extends.  Tasks take many
documents at a time, as one array of word numbers with a separator of its own after each document,
so that no run crosses documents and every step works on the whole array.

Periods below ``SHORT`` are found by comparing the array with itself at each lag.  Longer ones are
found scale by scale.  At scale ``k`` (periods of 2k to 4k) the grams of k words get a hash, and a
gram is picked if its hash is the least in some window of k grams.  A run of period q of this scale
holds a whole window twice, q apart, so a picked gram is picked again q words on: equal picked
grams 2k to 4k apart are seeds, which are extended both ways.  Grams inside a run of a period up to
k/4 (known from the scales before) would give too many pairs; there the ends of the short run take
their place: both ends of a short run come again q words on, unless two short runs of one period
touch, and then every q of the right remainder is tried.  Extension asks prefix hashes; each run is
then compared word by word, so no hash decides a result.  At most a few seeds arise for each k
words, so work stays in proportion to the text (times the number of scales).

Defined cases: a null or empty text has no words and no runs; a null id is kept; repeated rows are
each answered; an empty table gives no rows; further columns are not looked at; one very long text
is a batch of its own and needs memory in proportion to its words.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import arrow_map, mix, powers

#: Periods below this are found by direct lag scans; the first scale is half of it.
SHORT = 32
_BASE = 0xD6E8FEB86659FD93
#: Bytes of text and rows taken at a time.
BATCH_BYTES, BATCH_ROWS = 2 << 20, 4096


def sliding(op: np.ufunc, x: np.ndarray, k: int, neutral) -> np.ndarray:
    """``op`` over each window of ``k`` values of ``x`` (minimum or maximum), in three passes."""
    n = len(x)
    wide = np.full(-(-n // k) * k, neutral, x.dtype)
    wide[:n] = x
    rows = wide.reshape(-1, k)
    before = op.accumulate(rows, axis=1).ravel()
    after = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(after[: n - k + 1], before[k - 1 : n])


class Sequence:
    """An array of word numbers with prefix hashes over it."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.up, self.down = powers(_BASE, len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mix(words.astype(np.uint64) + np.uint64(1)) * self.up[: len(words)], dtype=np.uint64, out=self.sums[1:])

    def grams(self, k: int, size: int) -> np.ndarray:
        """Hash of the k words from each position on, within the first ``size`` words."""
        n = size - k + 1
        return mix((self.sums[k : size + 1] - self.sums[:n]) * self.down[:n])

    def alike(self, x: np.ndarray, y: np.ndarray, n) -> np.ndarray:
        return (self.sums[x + n] - self.sums[x]) * self.up[y - x] == self.sums[y + n] - self.sums[y]

    def extend(self, x: np.ndarray, q: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the stretch of period ``q`` around each ``x`` with words[x] == words[x+q]."""
        n, start, end = len(self.words), x.copy(), x + q
        step = 1 << max(1, longest).bit_length()
        while step:
            at = np.flatnonzero(end + step <= n)
            at = at[self.alike(end[at] - q[at], end[at], step)]
            end[at] += step
            at = np.flatnonzero(start >= step)
            at = at[self.alike(start[at] - step, start[at] - step + q[at], step)]
            start[at] -= step
            step >>= 1
        return start, end

    def exact(self, x: int, q: int, start: int, end: int) -> tuple[int, int]:
        """The stretch again, comparing words; differs only where hashes of different words agree."""
        w = self.words
        wrong = np.flatnonzero(w[start : end - q] != w[start + q : end])
        if not len(wrong):
            return start, end
        at = int(np.searchsorted(wrong, x - start))
        return (start + int(wrong[at - 1]) + 1 if at else start), (start + int(wrong[at]) + q if at < len(wrong) else end)


def lag_scan(words: np.ndarray, q: int, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches of period ``q``, by comparing the array with itself q words on."""
    same = np.flatnonzero(words[:-q] == words[q:])
    if not len(same):
        return same, same
    first = np.flatnonzero(np.concatenate([[True], np.diff(same) > 1]))
    last = np.concatenate([first[1:], [len(same)]]) - 1
    start, end = same[first], same[last] + 1 + q
    long = end - start >= max(min_length, 2 * q)
    return start[long], end[long]


def _pairs_within(position: np.ndarray, group: np.ndarray | None, least: int, most: int):
    """Index pairs (i, j), i before j in the given order, ``least <= distance < most``, groups equal."""
    left, right, t = [], [], 1
    while t < len(position):
        apart = position[t:] - position[:-t]
        near = apart < most
        if group is not None:
            near &= group[t:] == group[:-t]
        if not near.any():
            break
        found = np.flatnonzero(near & (apart >= least))
        left.append(found)
        right.append(found + t)
        t += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


class _Runs:
    """Runs found so far; of equal stretches the one with the smallest period stays."""

    def __init__(self):
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: np.ndarray, end: np.ndarray, period) -> None:
        for key in zip(start.tolist(), end.tolist()):
            if self.period.get(key, period + 1) > period:
                self.period[key] = period

    def arrays(self) -> np.ndarray:
        return np.array([(a, b, q) for (a, b), q in self.period.items()], np.int64).reshape(-1, 3)


def _short_run_seeds(seq: Sequence, short: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds (x, q) at the ends of short runs, and where two short runs of one period touch."""
    by_end = short[np.argsort(short[:, 1], kind="stable")]
    i, j = _pairs_within(by_end[:, 1], None, 2 * k, 4 * k)
    xs, qs = [by_end[i, 1]], [by_end[j, 1] - by_end[i, 1]]
    by_start = short[np.argsort(short[:, 0], kind="stable")]
    i, j = _pairs_within(by_start[:, 0], None, 2 * k, 4 * k)
    xs.append(by_start[i, 0] - 1)
    qs.append(by_start[j, 0] - by_start[i, 0])
    own = short[np.lexsort((short[:, 0], short[:, 2]))]
    touching = np.flatnonzero((own[1:, 2] == own[:-1, 2]) & (own[1:, 0] <= own[:-1, 1]))
    for t in touching.tolist():
        (a, b, d), (a2, b2, _) = own[t].tolist(), own[t + 1].tolist()
        # The word pattern of the second run's first period, looked for in the first run's last two.
        z = np.arange(b - 2 * d + 1, b - d + 1)
        z = z[seq.alike(z, np.full(len(z), a2), d)]
        if not len(z):
            continue
        q = np.arange(2 * k + (a2 - int(z[0]) - 2 * k) % d, min(4 * k, max(b - a, b2 - a2) + d), d)
        x = np.maximum(a, a2 - q)
        fits = x + q < b2
        xs.append(x[fits])
        qs.append(q[fits])
    return np.concatenate(xs), np.concatenate(qs)


def _scale(seq: Sequence, size: int, k: int, longest: int, runs: _Runs) -> None:
    """Add the runs with periods of 2k to 4k words within the first ``size`` words."""
    grams = seq.grams(k, size)
    least = sliding(np.minimum, grams, k, np.uint64(2**64 - 1))
    edge = np.zeros(k - 1, np.uint64)
    picked = grams == sliding(np.maximum, np.concatenate([edge, least, edge]), k, np.uint64(0))
    known = runs.arrays()
    short = known[(known[:, 2] * 4 <= k) & (known[:, 1] - known[:, 0] >= k) & (known[:, 1] <= size)]
    if len(short):
        steps = np.zeros(len(grams) + 1, np.int32)
        np.add.at(steps, short[:, 0], 1)
        np.add.at(steps, short[:, 1] - k + 1, -1)
        picked &= np.cumsum(steps[:-1]) == 0
    at = np.flatnonzero(picked)
    at = at[np.argsort(grams[at], kind="stable")]
    i, j = _pairs_within(at, grams[at], 2 * k, 4 * k)
    x, q = at[i], at[j] - at[i]
    if len(short):
        more = _short_run_seeds(seq, short, k)
        x, q = np.concatenate([x, more[0]]), np.concatenate([q, more[1]])
    inside = (x >= 0) & (x + q < size)
    x, q = x[inside], q[inside]
    same = seq.words[x] == seq.words[x + q]
    x, q = x[same], q[same]
    start, end = seq.extend(x, q, longest)
    long = np.flatnonzero(end - start >= 2 * q)
    seen = set()
    for a, b, p, at in sorted(zip(start[long].tolist(), end[long].tolist(), q[long].tolist(), x[long].tolist())):
        if (a, b) in seen or (a, b) in runs.period:  # the first has the smallest period
            continue
        seen.add((a, b))
        a2, b2 = seq.exact(at, p, a, b)
        if b2 - a2 >= 2 * p and runs.period.get((a2, b2), p + 1) > p:
            runs.period[a2, b2] = p


def find_runs(words: np.ndarray, lengths: list[int], min_length: int = 12) -> np.ndarray:
    """Rows (start, end, period) of the runs in ``words``: documents of the given lengths, longest
    first, each followed by a number that occurs nowhere else."""
    runs = _Runs()
    low = min(min_length, SHORT // 2)  # the first scale leans on all short runs of its grams' length
    ends = np.cumsum(np.array(lengths, np.int64) + 1)
    descending = -np.array(lengths, np.int64)

    def size(least: int) -> int:
        """Where the documents of at least so many words end."""
        n = int(np.searchsorted(descending, -least, side="right"))
        return int(ends[n - 1]) if n else 0

    for q in range(1, SHORT):
        n = size(max(low, 2 * q))
        if n:
            runs.add(*lag_scan(words[:n], q, low), q)
    k, longest = SHORT // 2, max(lengths, default=0)
    if longest >= 4 * k:
        seq = Sequence(words[: size(4 * k)])
        while longest >= 4 * k:
            _scale(seq, size(4 * k), k, longest, runs)
            k *= 2
    found = runs.arrays()
    found = found[found[:, 1] - found[:, 0] >= min_length]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of_texts(texts: list[bytes], min_length: int = 12):
    """For each text: its words, its runs [(start, length, period)] by start then period, and which
    words stay (a 0/1 list; None: all) when the words after each run's first period are dropped."""
    split = [t.split() for t in texts]  # bytes: exactly space and \t..\r are white space
    order = sorted((i for i in range(len(split)) if len(split[i]) >= min_length), key=lambda i: -len(split[i]))
    numbers: dict[bytes, int] = {}
    parts = []
    for rank, i in enumerate(order):
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in split[i]), np.int64, len(split[i])))
        parts.append(np.array([-1 - rank], np.int64))
    words = np.concatenate([np.zeros(0, np.int64), *parts])
    separators = words < 0
    words[separators] = len(numbers) - 1 - words[separators]
    found = find_runs(words, [len(split[i]) for i in order], min_length)
    gone = np.zeros(len(words) + 1, np.int32)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 1], -1)
    stays = (np.cumsum(gone[:-1]) == 0).tolist() if len(found) else []
    starts = np.cumsum([0, *(len(split[i]) + 1 for i in order)])
    of = (np.searchsorted(starts, found[:, 0], side="right") - 1).tolist()
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for rank, (a, b, q) in zip(of, found.tolist()):
        runs[order[rank]].append((a - int(starts[rank]), b - a, q))
    place = {i: int(starts[rank]) for rank, i in enumerate(order)}
    for i, own in enumerate(split):
        yield own, runs[i], stays[place[i] : place[i] + len(own)] if runs[i] else None


def periodic_runs(docs: DataFrame, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of each row: the runs as an array of (start, length, period) by
    start then period, and the text's words, joined by one space, without those that any run contains
    after its first period."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        keys, texts, weight = [], [], 0

        def done():
            for key, (words, runs, stays) in zip(keys, runs_of_texts(texts, min_length)):
                kept = words if stays is None else compress(words, stays)
                spans = [{"start": a, "length": n, "period": q} for a, n, q in runs]
                yield key, len(words), spans, b" ".join(kept).decode("utf-8", "replace")

        for r in rows:
            keys.append(r["id"])
            texts.append(r["text"] or b"")
            weight += len(texts[-1])
            if weight > BATCH_BYTES or len(keys) >= BATCH_ROWS:
                yield from done()
                keys, texts, weight = [], [], 0
        yield from done()

    return arrow_map(rows, run, f"id {kind}, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")

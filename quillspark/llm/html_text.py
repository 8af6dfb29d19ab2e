"""The main text of web pages, by a recurrent labeller of their leaf blocks.

A page is read as the sequence of its leaf blocks (``markup.page_blocks``).  Each block becomes a
vector: the tag path (element names and the words of their classes and ids, hashed, once for the
whole path and once for its end), its words (hashed) and a few measures (length, share of links,
punctuation, place in the page).  A bidirectional LSTM in numpy reads the sequence, so that every
block is classed as article or not with the whole page as context; the article's blocks, joined in
page order, are the text.

The network is fitted on ``layouts.training_pages``, pages drawn from a grammar of layouts whose
article is known: ``pages`` of them (a fixed bound, like the network's size, whatever the table
holds).  It is fitted once in a driver process and sent to the tasks (under 1 MB).

Defined cases: null or empty html gives an empty text; a page without any block of the article too;
pages cut anywhere and broken markup are read as far as they go; repeated rows and null ids are
kept; an empty table gives no rows; a page of any length is read whole, in memory in proportion to
its blocks.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.layouts import MAIN, REST, training_pages
from quillspark.llm.markup import Page, page_blocks
from quillspark.llm.shared import arrow_map

#: Hash buckets of path names and of words, sizes of their vectors, measures, and of the LSTM's state.
PATH_BUCKETS, WORD_BUCKETS, PATH_SIZE, WORD_SIZE, MEASURES, STATE = 2048, 512, 24, 8, 12, 24
INPUT = 2 * PATH_SIZE + WORD_SIZE + MEASURES
#: Pages are labelled in batches of this many bytes of html or rows.
BATCH_BYTES, BATCH_ROWS = 2 << 20, 512

_buckets: dict[str, int] = {}


def _bucket(name: str, size: int) -> int:
    found = _buckets.get(name)
    if found is None:
        if len(_buckets) > 300_000:
            _buckets.clear()
        found = _buckets[name] = zlib.crc32(name.encode("utf-8", "surrogatepass"))
    return found % size


class Blocks:
    """The blocks of some pages as arrays: path names, words and measures of each block, and the
    first block of each page."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.blocks) for p in pages]
        self.first = np.cumsum([0, *sizes])
        n = int(self.first[-1])
        # One row for each element: its own names' buckets and its parent (rows of one page follow another's).
        names, lengths, parents, own, shift = [], [], [], np.zeros(n, np.int64), 0
        words, counts = [], []
        measures = np.zeros((n, MEASURES), np.float32)
        i = 0
        for page in pages:
            for parent, tokens in page.elements:
                names += [_bucket(t, PATH_BUCKETS) for t in tokens]
                lengths.append(len(tokens))
                parents.append(parent + shift if parent >= 0 else -1)
            longest = max((len(t) for _, t, _ in page.blocks), default=1)
            total = sum(len(t) for _, t, _ in page.blocks)
            before = 0
            for k, (element, text, linked) in enumerate(page.blocks):
                own[i] = element + shift
                split = text.split()
                words += [_bucket(w, WORD_BUCKETS) for w in split]
                counts.append(len(split))
                size = len(text)
                stops = text.count(".") + text.count(",") + text.count("!") + text.count("?")
                measures[i] = (
                    np.log1p(len(split)) / 4, np.log1p(size) / 6, linked / size, min(1.0, stops / len(split)),
                    text[-1] in ".!?:;\"'", text[0].isupper(), sum(map(text.count, "0123456789")) / size,
                    k / len(page.blocks), before / total, size / longest, np.log1p(len(page.blocks)) / 5, 1.0)
                before += size
                i += 1
            shift += len(page.elements)
        self.names, self.lengths = np.array(names, np.int64), np.array(lengths, np.int64)
        self.parents, self.own = np.array(parents, np.int64), own
        self.words, self.counts, self.measures = np.array(words, np.int64), np.array(counts, np.int64), measures

    def levels(self) -> list[np.ndarray]:
        """Elements by depth: parents come before their children."""
        depth = np.zeros(len(self.parents), np.int64)
        for e, parent in enumerate(self.parents.tolist()):
            if parent >= 0:
                depth[e] = depth[parent] + 1
        order = np.argsort(depth, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []


def _sums(table: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of ``table``'s rows for each stretch of ``rows`` (stretches may be empty)."""
    out = np.zeros((len(lengths), table.shape[1]), np.float32)
    full = np.flatnonzero(lengths)
    if len(full):
        starts = (np.cumsum(lengths) - lengths)[full]
        out[full] = np.add.reduceat(table[rows], starts, axis=0)
    return out


class Network:
    """A bidirectional LSTM over block vectors with a logistic output for each block."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.weights = {"path": normal(PATH_BUCKETS, PATH_SIZE, scale=0.3), "end": normal(PATH_BUCKETS, PATH_SIZE, scale=0.3),
                        "word": normal(WORD_BUCKETS, WORD_SIZE, scale=0.2),
                        "out": normal(2 * STATE + INPUT, scale=0.1), "bias": np.zeros(1, np.float32)}
        for side in ("f", "b"):
            self.weights["x" + side] = normal(INPUT, 4 * STATE, scale=INPUT**-0.5)
            self.weights["h" + side] = normal(STATE, 4 * STATE, scale=STATE**-0.5)
            self.weights["c" + side] = np.concatenate([np.zeros(STATE), np.ones(STATE), np.zeros(2 * STATE)]).astype(np.float32)

    def _paths(self, b: Blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Vectors of whole paths and of paths' ends for each element, and how many names they add up."""
        own = _sums(self.weights["path"], b.names, b.lengths)
        end = _sums(self.weights["end"], b.names, b.lengths)
        n_path, n_end = b.lengths.copy(), b.lengths.copy()
        path = own.copy()
        for level in b.levels()[1:]:
            up = b.parents[level]
            path[level] += path[up]
            n_path[level] += n_path[up]
        inner = np.flatnonzero(b.parents >= 0)
        both, n_both = end.copy(), n_end.copy()
        both[inner] += end[b.parents[inner]]
        n_both[inner] += n_end[b.parents[inner]]
        return path, n_path, both, n_both

    def vectors(self, b: Blocks) -> np.ndarray:
        path, n_path, end, n_end = self._paths(b)
        o = b.own
        word = _sums(self.weights["word"], b.words, b.counts)
        return np.hstack([
            path[o] / np.sqrt(np.maximum(n_path[o], 1))[:, None], end[o] / np.sqrt(np.maximum(n_end[o], 1))[:, None],
            word / np.maximum(b.counts, 1).astype(np.float32)[:, None], b.measures]).astype(np.float32)

    def _steps(self, first: np.ndarray):
        """The rows of each step, forwards and backwards: longest pages first, so that the pages that
        go on are a prefix."""
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        sizes, starts = sizes[order], first[:-1][order]
        live = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
        forwards = [starts[:n] + t for t, n in enumerate(live.tolist())]
        backwards = [starts[:n] + sizes[:n] - 1 - t for t, n in enumerate(live.tolist())]
        return forwards, backwards

    def _read(self, side: str, x: np.ndarray, steps: list[np.ndarray], keep: list | None) -> np.ndarray:
        w = self.weights
        gates_in = x @ w["x" + side] + w["c" + side]
        out = np.zeros((len(x), STATE), np.float32)
        n = len(steps[0]) if steps else 0
        h, c = np.zeros((n, STATE), np.float32), np.zeros((n, STATE), np.float32)
        for rows in steps:
            n = len(rows)
            g = gates_in[rows] + h[:n] @ w["h" + side]
            s = 1 / (1 + np.exp(-g[:, : 3 * STATE]))
            i, f, o, u = s[:, :STATE], s[:, STATE : 2 * STATE], s[:, 2 * STATE :], np.tanh(g[:, 3 * STATE :])
            before = c[:n], h[:n]
            c = f * c[:n] + i * u
            t = np.tanh(c)
            h = o * t
            out[rows] = h
            if keep is not None:
                keep.append((rows, i, f, o, u, t, before))
        return out

    def scores(self, b: Blocks, keep: dict | None = None) -> np.ndarray:
        """The log odds of each block to belong to the article."""
        x = self.vectors(b)
        forwards, backwards = self._steps(b.first)
        kept: tuple[list | None, list | None] = ([], []) if keep is not None else (None, None)
        z = np.hstack([self._read("f", x, forwards, kept[0]), self._read("b", x, backwards, kept[1]), x])
        if keep is not None:
            keep.update(x=x, z=z, f=kept[0], b=kept[1])
        return z @ self.weights["out"] + self.weights["bias"][0]

    def gradients(self, b: Blocks, label: np.ndarray) -> dict[str, np.ndarray]:
        w, kept = self.weights, {}
        d_score = ((1 / (1 + np.exp(-self.scores(b, kept))) - label) / max(1, len(label))).astype(np.float32)
        x, z = kept["x"], kept["z"]
        grads = {"out": z.T @ d_score, "bias": np.array([d_score.sum()], np.float32)}
        dz = d_score[:, None] * w["out"]
        dx = dz[:, 2 * STATE :].copy()
        for side, part in (("f", dz[:, :STATE]), ("b", dz[:, STATE : 2 * STATE])):
            d_gates = np.zeros((len(x), 4 * STATE), np.float32)
            d_hidden = np.zeros_like(w["h" + side])
            dh = dc = np.zeros((0, STATE), np.float32)
            for rows, i, f, o, u, t, (c0, h0) in reversed(kept[side]):
                here, more = part[rows].copy(), np.zeros((len(rows), STATE), np.float32)
                here[: len(dh)] += dh
                more[: len(dc)] += dc
                dc = more + here * o * (1 - t * t)
                dg = np.hstack([dc * u * i * (1 - i), dc * c0 * f * (1 - f), here * t * o * (1 - o), dc * i * (1 - u * u)])
                d_gates[rows] = dg
                d_hidden += h0.T @ dg
                dh, dc = dg @ w["h" + side].T, dc * f
            grads["x" + side], grads["h" + side], grads["c" + side] = x.T @ d_gates, d_hidden, d_gates.sum(0)
            dx += d_gates @ w["x" + side].T
        _, n_path, _, n_end = self._paths(b)
        d_path, d_end = np.zeros((len(b.parents), PATH_SIZE), np.float32), np.zeros((len(b.parents), PATH_SIZE), np.float32)
        np.add.at(d_path, b.own, dx[:, :PATH_SIZE] / np.sqrt(np.maximum(n_path[b.own], 1))[:, None])
        np.add.at(d_end, b.own, dx[:, PATH_SIZE : 2 * PATH_SIZE] / np.sqrt(np.maximum(n_end[b.own], 1))[:, None])
        inner = np.flatnonzero(b.parents >= 0)
        up = np.zeros_like(d_end)
        np.add.at(up, b.parents[inner], d_end[inner])
        d_end = d_end + up
        for level in reversed(b.levels()[1:]):
            np.add.at(d_path, b.parents[level], d_path[level])
        for name, d in (("path", d_path), ("end", d_end)):
            grads[name] = np.zeros_like(w[name])
            np.add.at(grads[name], b.names, np.repeat(d, b.lengths, axis=0))
        grads["word"] = np.zeros_like(w["word"])
        d_word = dx[:, 2 * PATH_SIZE : 2 * PATH_SIZE + WORD_SIZE] / np.maximum(b.counts, 1).astype(np.float32)[:, None]
        np.add.at(grads["word"], b.words, np.repeat(d_word, b.counts, axis=0))
        return grads


def labelled(pages: list[str]) -> list[tuple[Page, np.ndarray]]:
    """Pages with marks as blocks without them, and which blocks belong to the article."""
    out = []
    for html in pages:
        page = page_blocks(html)
        page.blocks = [(e, t, n) for e, t, n in page.blocks if t[0] in (MAIN, REST)]
        label = np.array([t[0] == MAIN for _, t, _ in page.blocks], np.float32)
        page.blocks = [(e, t, n) for e, t, n in ((e, " ".join(t.replace(MAIN, "").replace(REST, "").split()), n) for e, t, n in page.blocks)]
        kept = [i for i, x in enumerate(page.blocks) if x[1]]
        page.blocks = [page.blocks[i] for i in kept]
        if kept:
            out.append((page, label[kept]))
    return out


@lru_cache(maxsize=2)
def fitted(pages: int = 2400, rounds: int = 6, batch: int = 64, seed: int = 7) -> Network:
    """The network fitted on ``pages`` drawn pages, ``rounds`` times each, by Adam."""
    data, net, rng = labelled(training_pages(pages, seed)), Network(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.weights.items()}
    v = {k: np.zeros_like(x) for k, x in net.weights.items()}
    total, step = rounds * -(-len(data) // batch), 0
    for _ in range(rounds):
        order = rng.permutation(len(data))
        for i in range(0, len(order), batch):
            some = [data[j] for j in order[i : i + batch]]
            grads = net.gradients(Blocks([p for p, _ in some]), np.concatenate([x for _, x in some]))
            step += 1
            rate = 0.01 * min(1.0, 2 * (1 - (step - 1) / total))
            for k, g in grads.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                net.weights[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def main_texts(network: Network, pages: list[str]):
    """For each page (text of the article, number of blocks, number of blocks kept)."""
    read = [page_blocks(p) for p in pages]
    blocks = Blocks(read)
    kept = (network.scores(blocks) > 0).tolist() if len(blocks.own) else []
    for page, a in zip(read, blocks.first.tolist()):
        own = kept[a : a + len(page.blocks)]
        yield " ".join([t for (_, t, _), k in zip(page.blocks, own) if k]), len(own), sum(own)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", network: Network | None = None) -> DataFrame:
    """(id, text, n_blocks, n_kept) of each row: the main text, and how many of the page's leaf
    blocks it is made of."""
    weights = network or fitted()
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("binary").alias("html"))
    kind = pages.schema[id_col].dataType.simpleString()

    def run(rows):
        keys, texts, weight = [], [], 0

        def done():
            for key, found in zip(keys, main_texts(weights, texts)):
                yield key, *found

        for r in rows:
            keys.append(r["id"])
            texts.append((r["html"] or b"").decode("utf-8", "replace"))
            weight += len(texts[-1])
            if weight > BATCH_BYTES or len(keys) >= BATCH_ROWS:
                yield from done()
                keys, texts, weight = [], [], 0
        yield from done()

    return arrow_map(rows, run, f"id {kind}, text string, n_blocks int, n_kept int")

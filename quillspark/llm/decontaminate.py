"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages.  Their TF-IDF matrix, with document frequencies counted over
all documents, is reduced by a randomised SVD: two passes over the passages sum A'(A X) by block of
terms in Spark, and only these sums (terms x ``rank``) reach the driver.  Documents are cut into
overlapping windows; a window's latent vector is compared with the latent passages by their product
over the passage's norm and the smaller of the two norms: the cosine, or how much of the passage a
window that outweighs it contains, so the text around a leak does not hide it.  A model has at
least as many directions as passages, so projecting loses nothing of them, and a window is
longer than a passage by the words between windows, so a verbatim copy always reaches 1 in some
window.  The products of all windows with all passages are first bounded together, by sums over steps of
words (a repeated word counted again); only windows that can reach the threshold are projected.
Candidates are checked on words: the longest common subsequence of the item and the text around the
window, and for middling shares (paraphrases) that of the item's answer, which is its last sentence.

The SVD is of the benchmark's passages, not of the documents': a few hundred directions of a large
corpus are its function words, and the rare words by which passages are told apart would be lost.

The benchmark is the stated query set and is taken in blocks of at most ``block_items`` items and
``rank`` passages (an item of more passages is a block with as many directions); a block's model is broadcast.  Documents are read twice for
each block, in map tasks only, so a passage that very many documents share costs nothing extra.

Defined cases: null or empty texts and items without words match nothing; items repeated under
other ids are each reported; a repeated document row is reported again; a row without an id is
reported with a null id; empty tables give no rows; further columns are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import arrow_map, gather, word_hashes

#: Words of a passage, words of a window and words between window starts.
PASSAGE, WINDOW, STRIDE = 48, 64, 16
#: Windows that are bounded together.
WINDOWS = 1024
#: Terms whose sums travel together.
TERMS = 256
#: ASCII punctuation and control signs to spaces; words are what lies between.
_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def plain(text: bytes) -> bytes:
    """A-Z in lower case, and only words and white space left."""
    return text.lower().translate(_PLAIN)


def words_of(text: str) -> list[bytes]:
    return plain(text.encode()).split()


def answer_of(text: str) -> list[bytes]:
    """The last sentence's words; the last quarter if there is one sentence or it is very short."""
    sentences = [s for s in (words_of(x) for x in re.split(r"[.?!\n]+(?:\s|$)", text)) if s]
    words = words_of(text)
    if len(sentences) > 1 and len(sentences[-1]) >= 3:
        return sentences[-1]
    return words[-max(3, len(words) // 4) :]


def lcs(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, one big-integer step for each word of ``b``."""
    places: dict[bytes, int] = defaultdict(int)
    for i, w in enumerate(a):
        places[w] |= 1 << i
    full = (1 << len(a)) - 1
    state = full
    for w in b:
        hit = state & places.get(w, 0)
        if hit:
            state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def passages_of(terms: np.ndarray) -> list[np.ndarray]:
    """The distinct terms of each passage of an item: parts of about equal length."""
    return [np.unique(t) for t in np.array_split(terms, max(1, -(-len(terms) // PASSAGE)))]


class Terms:
    """The benchmark's terms as ascending 64-bit hashes; a term's number is its place."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.table = np.zeros(1 << 20, bool)
        self.table[hashes & np.uint64((1 << 20) - 1)] = True

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word's term, -1 for words that no item has."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.table[hashes & np.uint64((1 << 20) - 1)])
        at = np.searchsorted(self.hashes, hashes[maybe])
        at[at == len(self.hashes)] = 0
        found = self.hashes[at] == hashes[maybe]
        out[maybe[found]] = at[found]
        return out

    def batches(self, rows, most: int = 2 << 20):
        """(row, its plain text, the numbers of its words) for all rows, looked up many at a time."""
        some, texts, weight = [], [], 0

        def done():
            places, hashes = word_hashes(b"\n".join(texts))
            ends = np.searchsorted(places, np.cumsum([len(t) + 1 for t in texts])).tolist()
            numbers = self.of(hashes)
            return [(r, t, numbers[a:b]) for r, t, a, b in zip(some, texts, [0, *ends], ends)]

        for r in rows:
            some.append(r)
            texts.append(plain(r["text"] or b""))
            weight += len(texts[-1])
            if weight > most:
                yield from done()
                some, texts, weight = [], [], 0
        if some:
            yield from done()


def document_frequencies(docs: DataFrame, terms: np.ndarray, text_col: str) -> tuple[np.ndarray, int]:
    """In how many documents each term is, over all documents, and how many documents there are."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(rows):
        n, total = np.zeros(len(shared.value), np.int64), 0
        for _, _, numbers in Terms(shared.value).batches(rows):
            n[np.unique(numbers[numbers >= 0])] += 1
            total += 1
        at = np.nonzero(n)[0]
        yield at.tolist(), n[at].tolist(), total

    counted = arrow_map(docs.select(F.col(text_col).cast("binary").alias("text")), run, "term array<int>, n array<long>, total long")
    # One row with the total for each task beside its terms: the term -1.
    pairs = counted.select(F.explode(F.arrays_zip(F.concat("term", F.array(F.lit(-1))).alias("term"), F.concat("n", F.array("total")).alias("n"))).alias("x"))
    out, total = np.zeros(len(terms), np.int64), 0
    for term, n in pairs.groupBy("x.term").agg(F.sum("x.n")).collect():  # one row a term
        if term < 0:
            total = n
        else:
            out[term] = n
    return out, total


def sketch_products(passages: DataFrame, weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A'(A X) for the matrix A of weighted, normalised passages, summed by block of terms."""
    given = passages.sparkSession.sparkContext.broadcast((weights, x))

    def run(rows):
        weights, x = given.value
        sums: dict[int, np.ndarray] = {}
        for r in rows:
            t = np.array(r["terms"])
            a = weights[t]
            a = a / max(np.linalg.norm(a), 1e-12)
            z = a @ x[t]
            for i, v in zip(t.tolist(), a.tolist()):
                if i // TERMS not in sums:
                    sums[i // TERMS] = np.zeros((TERMS, x.shape[1]))
                sums[i // TERMS][i % TERMS] += v * z
        for k, s in sums.items():
            yield k, s.tobytes()

    def add(rows):
        for r in rows:
            yield r["part"], sum(np.frombuffer(f["data"]) for f in r["found"]).tobytes()

    parts = arrow_map(passages, run, "part int, data binary")
    summed = arrow_map(gather(parts, ["part"], "data"), add, "part int, data binary")
    out = np.zeros((-(-len(weights) // TERMS) * TERMS, x.shape[1]))
    for part, data in summed.collect():  # terms x rank numbers
        out[part * TERMS : (part + 1) * TERMS] = np.frombuffer(bytes(data)).reshape(TERMS, -1)
    return out[: len(weights)]


def latent_space(passages: DataFrame, weights: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (terms x at most ``rank``) of the passages' TF-IDF matrix."""
    width = min(len(weights), rank + 16)
    x = np.random.default_rng(seed).standard_normal((len(weights), width))
    q, _ = np.linalg.qr(sketch_products(passages, weights, x))
    small = q.T @ sketch_products(passages, weights, q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[:rank]
    return (q @ vectors[:, order[values[order] > 1e-9]]).astype(np.float32)


def windows_bound(number: np.ndarray, products: np.ndarray) -> np.ndarray:
    """(windows, passages): at least the product of each window's vector and each passage's.  ``products`` has a
    term's with the passages as rows, and zeros at the end, for the number -1.  None is below zero, but for
    rounding: the model holds the passages whole."""
    n = len(number)
    steps = np.full(-(-n // STRIDE) * STRIDE, -1, np.int64)
    steps[:n] = number
    steps = steps.reshape(-1, STRIDE)
    sums = np.zeros((len(steps) + WINDOW // STRIDE - 1, products.shape[1]), np.float32)
    for at in range(0, len(steps), 64):
        part = steps[at : at + 64]
        sums[at : at + len(part)] = products[part].sum(axis=1)
    count = len(range(0, max(1, n - WINDOW + STRIDE), STRIDE))
    return sum(sums[i : i + count] for i in range(WINDOW // STRIDE))


def _search(docs: DataFrame, items: list[tuple], passages: DataFrame, terms: np.ndarray, rank: int, cosine: float, share: float, paraphrase: float, answer: float, id_col: str, text_col: str, schema: str) -> DataFrame:
    spark = docs.sparkSession
    seen, total = document_frequencies(docs, terms, text_col)
    weights = np.log1p(total / (1.0 + seen)).astype(np.float32)
    space = latent_space(passages, weights, rank)
    model, unseen = spark.sparkContext.broadcast((terms, items, weights, space)), float(np.log1p(total))

    def run(rows):
        terms, items, weights, space = model.value
        lookup = Terms(terms)
        owner, vectors, norms = [], [], []
        for k, (_, words, _) in enumerate(items):
            numbers = lookup.of(word_hashes(b" ".join(words))[1])
            for t in passages_of(numbers):
                z = weights[t] @ space[t]
                owner.append(k)
                vectors.append(z / max(np.linalg.norm(weights[t]), 1e-12))
                norms.append(np.linalg.norm(weights[t]))
        owner, vectors, norms = np.array(owner), np.array(vectors, np.float32), np.array(norms)
        products = np.vstack([(weights[:, None] * space) @ vectors.T, np.zeros((1, len(vectors)), np.float32)])
        # Words that no item has (the number -1) weigh as much as a word found nowhere.
        square = np.append(weights**2, unseen**2)
        for r, raw, number in lookup.batches(rows):
            n = len(number)
            if not (number >= 0).any():
                continue
            weight = square[number]
            all_ = np.concatenate([[0.0], np.cumsum(weight)])
            starts = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)
            ends = np.minimum(starts + WINDOW, n)
            norm = all_[ends] - all_[starts]
            which = []
            for at in range(0, len(starts), WINDOWS):  # a long text's windows, some at a time
                some = slice(at, at + WINDOWS)
                least = 0.98 * cosine * np.minimum(norms, np.sqrt(np.maximum(norm[some], 0))[:, None])
                bound = windows_bound(number[starts[at] : ends[some][-1]], products)
                which.append(at + np.flatnonzero((bound >= least).any(axis=1)))
            which = np.concatenate(which)
            if not len(which):
                continue
            spans: dict[int, list] = defaultdict(list)
            texts: list[bytes] = []
            for w in which.tolist():
                t = number[starts[w] : ends[w]]
                t = np.unique(t[t >= 0])
                z = weights[t] @ space[t]
                near = vectors @ z / np.minimum(norms, np.sqrt(norm[w]))
                for p in np.nonzero(near >= cosine)[0].tolist():
                    spans[int(owner[p])].append((int(starts[w]), int(ends[w]), float(near[p])))
            for k, found in spans.items():
                item_id, words, last = items[k]
                texts = texts or raw.split()
                best = None
                around: list[list] = []
                for a, b, c in found:
                    a, b = max(0, a - len(words)), min(n, b + len(words))
                    if around and a <= around[-1][1]:
                        around[-1][1] = b
                        around[-1][2] = max(around[-1][2], c)
                    else:
                        around.append([a, b, c])
                for a, b, c in around:
                    text = texts[a:b]
                    whole = lcs(words, text) / len(words)
                    end = lcs(last, text) / len(last)
                    if whole >= share or whole >= paraphrase and end >= answer:
                        best = max(best or (0,), (whole, end, c, a, b))
                if best:
                    yield r["id"], item_id, best[2], best[0], best[1], best[3], best[4]

    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")), run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = 256, cosine: float = 0.35, share: float = 0.8, paraphrase: float = 0.6, answer: float = 0.6, block_items: int = 1024, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, cosine, lcs_share, answer_share, first_word, end_word) of each document and item
    it contains: by a common subsequence of at least ``share`` of the item's words, or of
    ``paraphrase`` with ``answer`` of the answer's.  The span is where it was searched."""
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"id {kinds[0]}, item_id {kinds[1]}, cosine double, lcs_share double, answer_share double, first_word int, end_word int"
    block = F.pmod(F.xxhash64(item_col, item_text_col), F.lit(max(1, -(-benchmark.count() // block_items))))
    given = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"), block.alias("block"))
    out = spark.createDataFrame([], schema)
    for (b,) in given.select("block").distinct().orderBy("block").collect():
        parts, held = [[]], 0
        for r in given.where(F.col("block") == b).collect():  # a block of the query set
            words = words_of(r["text"] or "")
            if not words:
                continue
            count = -(-len(words) // PASSAGE)
            if parts[-1] and (held + count > rank or len(parts[-1]) >= block_items):
                parts.append([])
                held = 0
            parts[-1].append((r["item"], words, answer_of(r["text"])))
            held += count
        for items in filter(None, parts):
            hashed = [word_hashes(b" ".join(words))[1] for _, words, _ in items]
            terms = np.unique(np.concatenate(hashed))
            rows = [(t.tolist(),) for h in hashed for t in passages_of(np.searchsorted(terms, h))]
            passages = spark.createDataFrame(rows, "terms array<int>")
            out = out.unionByName(_search(docs, items, passages, terms, max(rank, len(rows)), cosine, share, paraphrase, answer, id_col, text_col, schema))
    return out

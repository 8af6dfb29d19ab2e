import math
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from cases import corpus, documents, empty, split  # noqa: E402

from quillspark.llm import decontaminate as D  # noqa: E402
from quillspark.llm import quality as Q  # noqa: E402
from quillspark.llm.licenses import TEMPLATES, _plain, anchors, scan  # noqa: E402
from quillspark.llm.lm import ORDER, gram_costs, score  # noqa: E402


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 1


class BruteForcePPM:
    """The same model as dictionaries, one symbol at a time."""

    def __init__(self, texts):
        self.seen = defaultdict(Counter)
        for t in texts:
            for context, s in self.steps(t):
                for k in range(ORDER + 1):
                    self.seen[context[ORDER - k :]][s] += 1

    @staticmethod
    def steps(text):
        data = b"\xff" * ORDER + text + b"\xff"
        return [(data[i - ORDER : i], data[i]) for i in range(ORDER, len(data))]

    def cost(self, context, s):
        p, refused = 1.0, set()
        for k in range(ORDER, -1, -1):
            own = {x: n for x, n in self.seen.get(context[ORDER - k :], {}).items() if x not in refused}
            total = sum(own.values())
            if s in own:
                return math.log10(p * (own[s] - 0.5) / total)
            if own:
                p *= 0.5 * len(own) / total
                refused |= own.keys()
        return math.log10(p / (256 - len(refused)))

    def score(self, text):
        return sum(self.cost(*x) for x in self.steps(text))


def test_scores_match_brute_force(spark):
    rows = corpus(5, 25) + [(12, "ABC abc"), (None, "no id")]
    texts = [(i, (t or "").encode().lower()) for i, t in rows]
    model = BruteForcePPM([t for i, t in texts if i is None or not held_out(i)])
    count = Counter(w for i, t in texts if i is None or not held_out(i) for w in [*t.split(), None])
    n, v = sum(count.values()), len(count)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    got = sorted(score(documents(spark, rows), train).collect(), key=lambda r: (str(r.id), r.n_tokens))
    assert len(got) == len(rows)
    for (i, t), r in zip(sorted(texts, key=lambda x: (str(x[0]), len(x[1].split()))), got):
        w = [*t.split(), None]
        assert (r.id, r.train, r.n_tokens, r.n_known, r.train_tokens) == (i, i is None or not held_out(i), len(w), sum(count[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
        assert math.isclose(r.score, model.score(t), rel_tol=1e-5), i


def test_the_model_is_a_distribution_and_knows_its_language(spark):
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 48, 50).astype(np.uint64))
    pairs = np.zeros((256, 256), np.int64)
    for k in keys.tolist():
        pairs[k >> 40, k & 255] += 1
    context = int(keys[3]) >> 8
    needed = (np.uint64(context) << np.uint64(8)) + np.arange(256, dtype=np.uint64)
    assert math.isclose((10.0 ** gram_costs(needed, keys, np.ones(len(keys), np.int64), pairs)).sum(), 1, rel_tol=1e-5)
    rng = random.Random(1)
    plain = [(i, " ".join(rng.choice(["the", "of", "stone", "river"]) for _ in range(60))) for i in range(40)]
    odd = (100, "".join(rng.choice("qxzjkvw ") for _ in range(len(plain[0][1]))))
    got = {r.id: r.score / len(dict([*plain, odd])[r.id]) for r in score(documents(spark, [*plain, odd]), F.col("doc_id") < 30).collect()}
    assert all(got[i] > 3 * got[100] for i in range(30, 40))


def test_scores_without_training_rows_and_without_rows(spark):
    got = score(documents(spark, [(1, None), (2, "ab")]), F.lit(False)).orderBy("id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(1, 0, 0), (2, 0, 0)]
    assert math.isclose(got[1].score, -3 * math.log10(256), rel_tol=1e-6)
    assert score(empty(spark), F.lit(True)).count() == 0


def counts(text):
    w, t = split(text), text or ""
    lines = [x for x in t.split("\n") if x.encode().split()]
    three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often, cover = Counter(three), set()
    for i, g in enumerate(three):
        if often[g] > 1:
            cover |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_counts_match_brute_force(spark):
    rows = corpus(9) + [(600, "# a|b <c>\nx y\nx y\n\n\nx y " * 5), (601, "a\x0bb\x0cc\x1cd \xa0e")]
    got = Q.judge(documents(spark, rows), labels(spark, [])).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {r.doc_id: tuple(r[n] for n in names) for r in got} == {i: counts(t) for i, t in rows}
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)
    assert Q.judge(empty(spark), labels(spark, [])).count() == 0


def test_binomial_tail_is_exact(spark):
    cases = [(k, n, p) for n in (1, 7, 50, 400) for p in (0.005, 0.05, 0.3) for k in range(0, int(n * p) + 1, 3)]
    for k, n, p in cases:
        want = math.log(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
        got = spark.range(1).select(Q.log_binomial_cdf(F.lit(k), F.lit(n), p).alias("x")).first().x if n in (7, 400) else want
        assert math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-12), (k, n, p)


def test_cutoffs_reject_junk_and_keep_their_promise(spark):
    rng = random.Random(4)
    rows, known = [], []
    for i in range(2600):
        w = [f"{rng.choice('abcdefgh')}{rng.randrange(900)}x" for _ in range(60)]
        junk = i % 5 == 0
        rows.append((i, " ".join(x + ("###" if junk else "") for x in w), "aa" if i % 40 else None))
        known.append((i, int(not junk), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in Q.judge(docs, labels(spark, known + [(0, None, None), (99999, 1, 0)])).collect()}
    assert all(got[i].kept == bool(i % 5) for i in range(2600) if i % 40)
    assert "symbols" in got[5].failed_rules
    assert all(got[i].kept for i in range(0, 2600, 40))  # too few labels there for any promise


def test_lcs_matches_dynamic_programming():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.choice("abcd") for _ in range(rng.randrange(1, 30))]
        b = [rng.choice("abcde") for _ in range(rng.randrange(0, 40))]
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(row[j] + 1 if x == y else 0, row[j + 1], new[-1]))
            row = new
        assert D.lcs(a, b) == row[-1]


def test_randomised_svd_spans_the_passages(spark):
    rng = np.random.default_rng(3)
    rows = [([int(x) for x in rng.integers(0, 300, 20)],) for _ in range(12)]
    weights = rng.uniform(1, 3, 300).astype(np.float32)
    space = D.latent_space(spark.createDataFrame(rows, "terms array<int>"), weights, 12)
    for (t,) in rows:
        a = np.zeros(300)
        np.add.at(a, t, weights[t])
        assert np.linalg.norm(a @ space) > 0.999 * np.linalg.norm(a)


def test_leaks_are_found_and_clean_documents_left(spark):
    rng = random.Random(6)

    def text(n):
        return [f"t{rng.randrange(5000)}" for _ in range(n)]

    items = [(i, " ".join(text(rng.randrange(12, 60))).capitalize() + ". " + " ".join(text(5)) + ".") for i in range(30)]
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, items[0][1])], "item_id long, text string")
    rows, want = [(1, None), (2, ""), (3, "t1")], set()
    for i in range(30):
        body = text(rng.randrange(0, 300))
        leak = items[i][1].split()
        if i % 3 == 0:
            want.add((100 + i, i))
        elif i % 3 == 1:  # a paraphrase: a fifth of the words changed, the answer kept
            for j in rng.sample(range(len(leak) - 5), (len(leak) - 5) // 5):
                leak[j] = f"u{rng.randrange(999)}"
            want.add((100 + i, i))
        else:  # half of it is no leak
            leak = leak[: len(leak) // 3]
        rows.append((100 + i, " ".join(body[: len(body) // 2] + leak + body[len(body) // 2 :])))
    want.add((100, 92))
    rows += [(100, rows[3][1])]
    got = D.contaminated(documents(spark, rows), bench).collect()
    assert {(r.id, r.item_id) for r in got} == want
    assert len(got) == len(want) + 2  # the repeated row is reported again
    assert {(r.id, r.item_id) for r in D.contaminated(documents(spark, rows), bench, block_items=7).collect()} == want
    assert D.contaminated(empty(spark), bench).count() == 0 and D.contaminated(documents(spark, rows), bench.limit(0)).count() == 0


def test_leaks_are_found_when_passages_outnumber_the_rank(spark):
    rng = random.Random(61)

    def text(n):
        return [f"t{rng.randrange(9000)}" for _ in range(n)]

    items = [(i, " ".join(text(rng.randrange(12, 90))) + ". " + " ".join(text(5)) + ".") for i in range(300)]
    items += [(300 + i, f"s{i}a s{i}b s{i}c s{i}d.") for i in range(10)]  # short ones
    rows = []
    for i, t in items:
        leak, body = t.split(), text(200)
        for j in rng.sample(range(len(leak) - 5), (len(leak) - 5) * (i % 5) // 10) if i < 300 else ():
            leak[j] = f"u{rng.randrange(9999)}"
        rows.append((i, " ".join(body[: i % 200] + leak + body[i % 200 :])))
    got = D.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), rank=256)
    assert {(r.id, r.item_id) for r in got.collect()} == {(i, i) for i, _ in items}


def test_anchors_lose_no_paragraph_that_could_be_confirmed():
    found = set(anchors(0.6))
    for _, t in TEMPLATES:
        w = _plain(t)
        three = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
        assert len({g for g in three if not found & set(g)}) < 0.6 * len(three)


def test_licences_are_found_and_prose_is_not(spark):
    rng = random.Random(7)
    prose = [" ".join(rng.choice(["under", "the", "mit", "stone", "river", "public", "any", "blue", "work"]) for _ in range(30)) for _ in range(60)]
    rows = [(i, p + "\n" + prose[-1 - i]) for i, p in enumerate(prose)]
    rows += [(100 + i, f"{prose[i]}\n{t.upper() if i % 2 else t}.\n{prose[i + 1]}") for i, (_, t) in enumerate(TEMPLATES)]
    rows += [(200, "Released under the MIT License."), (200, "Released under the MIT License."), (None, "Licensed under CC BY-NC 4.0."), (300, None), (301, "")]
    got = scan(documents(spark, rows)).where("confirmed").collect()
    named = Counter((r.doc_id, r.paragraph, r.family) for r in got)
    want = Counter({(100 + i, 1, f): 1 for i, (f, _) in enumerate(TEMPLATES)})
    want.update({(200, 0, "mit"): 2, (None, 0, "cc-by-nc"): 1})
    assert named == want
    assert scan(empty(spark)).count() == 0


def test_short_and_wrapped_notices_are_found(spark):
    rng = random.Random(9)
    prose = [" ".join(rng.choice(["under", "the", "any", "stone", "river", "copy", "file", "work", "general", "blue"]) for _ in range(rng.randrange(8, 60))) for _ in range(150)]
    rows = [(i, p) for i, p in enumerate(prose)]
    rows += [(200, f"{prose[0]}\nAll rights reserved.\n{prose[1]}"), (201, "GNU GPL v3"), (202, f"{prose[2]}\nThis work is licensed under the GNU\nGeneral Public License, version 3.\n{prose[3]}")]
    rows += [(203, "Permission is hereby granted,\nfree of charge, to any\nperson obtaining a copy of\nthis software"), (204, "This work is licensed under the GNU\n\nGeneral Public License, version 3.")]
    got = scan(documents(spark, rows)).collect()
    confirmed = {(r.doc_id, r.paragraph, r.family) for r in got if r.confirmed}
    assert {(200, 1, "proprietary"), (201, 0, "gpl"), (202, 1, "gpl"), (203, 0, "mit")} <= confirmed
    assert (204, 0, "gpl") not in confirmed


def test_plain_paragraphs_with_anchor_words_are_seldom_believed(spark):
    rng = random.Random(10)
    kinds = ["under", "the", "any", "general", "copy", "file", "work", "part", "subject", "public", "terms", "version", "license"]
    rows = [(i, " ".join(rng.choice(kinds + ["stone", "river"]) for _ in range(rng.randrange(8, 300)))) for i in range(600)]
    got = scan(documents(spark, rows), sample=300).collect()
    assert sum(r.family != "unknown" for r in got) <= 12


def test_the_licence_model_has_no_slots_that_training_does_not_fill(spark):
    from quillspark.llm.licenses import LicenceModel

    rng = random.Random(11)
    plain = [([rng.choice(["stone", "river", "blue", f"own{i}"]) for _ in range(40)],) for i in range(100)]
    model = LicenceModel(spark, spark.createDataFrame(plain, "words array<string>"), 60, 0.002)
    vocabulary = set(model.features.vocabulary)
    # The driver's vectors have a place for each feature and family: none for grams of a few rows.
    assert model.model.numFeatures == len(vocabulary) < 5000
    for _, t in TEMPLATES:
        w = _plain(t)
        assert {" ".join(w[i : i + 3]) for i in range(len(w) - 2)} | set(w) <= vocabulary
    assert {"stone river blue", "stone"} <= vocabulary and "own7" not in vocabulary

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import corpus, documents, empty, split  # noqa: E402

from quillspark.llm import periods  # noqa: E402
from quillspark.llm.periods import periodic_runs, runs_of_texts, sliding  # noqa: E402


def brute(words, least=12):
    """Every period tried at every place; of equal stretches the smallest period stays."""
    out, a = {}, np.array([hash(w) for w in words])
    for q in range(1, len(words) // 2 + 1):
        same = np.flatnonzero(np.diff(np.concatenate([[0], (a[:-q] == a[q:]).astype(int), [0]])))
        for start, end in zip(same[::2].tolist(), same[1::2].tolist()):
            if end - start + q >= max(least, 2 * q):
                out.setdefault((start, end - start + q), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def thue_morse(n):
    return ["ab"[i.bit_count() & 1] for i in range(n)]


def texts():
    rng = random.Random(11)
    out = [fibonacci(2500), thue_morse(2200), fibonacci(300) * 5, thue_morse(64) * 9, []]
    for m in (3, 8, 9, 15, 40, 90):
        out += [list(("ab" * m + "a") * 2) + ["z"] + list(("ab" * m + "ac") * 3), list("a" * m + "b") * 6, list("aab" * m + "aa") * 2]
    for _ in range(250):
        k = rng.choice([1, 2, 2, 3, 30])
        base, w = [str(rng.randrange(k)) for _ in range(rng.randrange(1, 260))], []
        for _ in range(rng.randrange(1, 7)):
            kind = rng.random()
            if kind < 0.4:
                i = rng.randrange(len(base))
                w += base[i : rng.randrange(i, len(base)) + 1] * rng.randrange(1, 4)
            elif kind < 0.7:
                w += base
            else:
                u = [rng.choice("xy") for _ in range(rng.randrange(1, 6))]
                v = (u * 60)[: rng.randrange(1, 150)]
                w += v + (v if rng.random() < 0.5 else base[: rng.randrange(9)]) + v
        out.append(w[:1500])
    return out


@pytest.mark.parametrize("least", [12, 1, 40])
def test_runs_match_every_period_at_every_place(least):
    docs = texts() if least == 12 else texts()[:60]
    found = list(runs_of_texts([" ".join(d).encode() for d in docs], least))
    for d, (words, runs, stays) in zip(docs, found):
        want = brute(d, least)
        assert runs == want
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        kept = [True] * len(words) if stays is None else stays
        assert [i for i, k in enumerate(kept) if not k] == sorted(gone)


def test_runs_do_not_rest_on_hashes(monkeypatch):
    """With a hash that tells few grams apart the results are the same."""
    docs = [d for d in texts() if len(d) < 500][:80]
    data = [" ".join(d).encode() for d in docs]
    want = [r for _, r, _ in runs_of_texts(data)]
    monkeypatch.setattr(periods, "mix", lambda x: x % np.uint64(3))
    assert [r for _, r, _ in runs_of_texts(data)] == want


def test_sliding_extremes():
    rng = np.random.default_rng(0)
    for k in (1, 2, 5, 16):
        x = rng.integers(0, 50, 200).astype(np.uint64)
        windows = np.lib.stride_tricks.sliding_window_view(x, k)
        assert (sliding(np.minimum, x, k, np.uint64(99)) == windows.min(1)).all()
        assert (sliding(np.maximum, x, k, np.uint64(0)) == windows.max(1)).all()


def test_table_cases(spark):
    rows = corpus(2) + [(700, "a b\n" * 40), (701, "x\x1fy z " * 30), (12, "r " * 20), (12, "r " * 20), (None, "n m " * 9)]
    got = sorted(map(tuple, periodic_runs(documents(spark, rows)).collect()), key=str)
    want = []
    for i, t in rows:
        w = split(t)
        runs = brute(w) if len(w) > 1 else []
        gone = {j for s, n, q in runs for j in range(s + q, s + n)}
        want.append((i, len(w), runs, " ".join(x for j, x in enumerate(w) if j not in gone)))
    assert [(a, b, [tuple(r) for r in c], d) for a, b, c, d in got] == sorted(want, key=str)
    assert periodic_runs(empty(spark)).collect() == []


def test_query_plants_and_digests(spark, tmp_path):
    from quillspark.llm.queries import QUERIES

    rows = corpus(4, 120) + [(1000 + i, " ".join(f"w{j * i % 50}" for j in range(i * 7))) for i in range(60)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    planted = 0
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a, planted = g % n, planted + 1
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = brute(w) if n > 1 else []
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert got[i] == (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                          hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
    assert planted > 5

"""The bound by which decontamination passes over windows loses none and leaves few."""

import numpy as np

from quillspark.llm import decontaminate as D


def test_bound_is_at_least_the_product_and_tight_without_repeats():
    rng = np.random.default_rng(5)
    products = np.vstack([rng.random((300, 7)) * (rng.random((300, 7)) < 0.2), np.zeros((1, 7))]).astype(np.float32)
    for n in (1, 15, 16, 48, 49, 64, 65, 80, 81, 500, 5000):
        number = rng.integers(-1, 300, n)
        starts = np.arange(0, max(1, n - D.WINDOW + D.STRIDE), D.STRIDE)
        bound = D.windows_bound(number, products)
        assert bound.shape == (len(starts), 7)
        for a, b in zip(starts, bound):
            t = number[a : a + D.WINDOW]
            t = np.unique(t[t >= 0])
            assert (b >= products[t].sum(axis=0) - 1e-3).all()
    number = rng.permutation(300)[:64]
    assert np.allclose(D.windows_bound(number, products)[0], products[number].sum(axis=0), atol=1e-4)


def test_scattered_benchmark_words_are_not_projected(spark, monkeypatch):
    """Every window is made of benchmark words, but of no passage's."""
    rng = np.random.default_rng(7)
    items = [" ".join(f"t{i}x{k}" for k in range(40)) for i in range(30)]
    pool = " ".join(items).split()
    texts = [" ".join(rng.choice(pool, 2000)) for _ in range(3)] + [" ".join(["own"] * 70000) + " " + items[4]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    runs, plain = [], D.arrow_map
    monkeypatch.setattr(D, "arrow_map", lambda df, f, schema: runs.append(f) or plain(df, f, schema))
    found = D.contaminated(docs, bench)
    projected = []
    unique = np.unique
    monkeypatch.setattr(D.np, "unique", lambda x, *a, **k: projected.append(len(x)) or unique(x, *a, **k))
    got = list(runs[-1](iter({"id": i, "text": t.encode()} for i, t in enumerate(texts))))
    monkeypatch.undo()
    # One call for each of the 30 passages, the others are of projected windows.
    assert len(projected) - 30 < 40
    assert [(r[0], r[1]) for r in got] == [(3, 4)] == [(r.id, r.item_id) for r in found.collect()]

"""Small tables with every awkward case, and brute-force helpers."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, n int, kept string, node int, block string, length int, bucket int, key string, found int"
REST = (None, "x", 0, "clash", 1, "c", 2, "b", 3, 4, "k", 5)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=0, n=60):
    """(doc_id, text): random texts, exact and edited copies, shared passages and edge cases."""
    rng = random.Random(seed)
    out = [(1, None), (2, ""), (3, " \n\t \x0b"), (4, "one"), (5, "One two"), (6, "one"), (7, "one\x1ftwo three")]
    passage = " ".join(words(rng, 60))
    for i in range(10, 10 + n):
        w = words(rng, rng.randrange(1, 160))
        kind = rng.random()
        if kind < 0.2 and len(out) > 12:
            w = (rng.choice(out[8:])[1] or "").split()
        elif kind < 0.45 and len(out) > 12:
            w = (rng.choice(out[8:])[1] or "").split()
            for _ in range(rng.randrange(0, 1 + len(w) // 12)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(999)}"
        elif kind < 0.55:
            w = w + passage.split()
        elif kind < 0.6:
            w = w[:20] * 4
        text = ""
        for x in w:
            text += x + rng.choice([" ", " ", " ", "\n", ". ", "  "])
        out.append((i, text))
    out.append((500, " ".join(words(rng, 6000, 3000))))
    out.append((501, " ".join(words(rng, 40)) + " Ünïcödé 中文 😀 it's don't"))
    return out


def documents(spark, rows, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), *REST[1:4], 1, "b", 3, 4, "k", 5) for i, t in rows], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def classes(nodes, links):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {x: root(x) for x in nodes}


def split(text):
    return [w.decode() for w in (text or "").encode().split()]

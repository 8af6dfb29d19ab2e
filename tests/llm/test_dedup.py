import hashlib
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import classes, corpus, documents, empty, split  # noqa: E402

from quillspark.llm.components import components  # noqa: E402
from quillspark.llm.lines import drop_repeated_lines, least_sizes, line_groups  # noqa: E402
from quillspark.llm.minhash import band_hashes, close_pairs, near_duplicates, shingle_hashes, super_minhash  # noqa: E402
from quillspark.llm.substrings import remove_repeated  # noqa: E402


def lower(t):
    return (t or "").encode().lower().decode()


def shingles(text, k):
    w = split(lower(text))
    if not w:
        return set()
    return {tuple(w)} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)] + [(7, 7)]
    df = spark.createDataFrame(links + [(None, 4)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == classes({x for p in real for x in p}, real)


def test_components_of_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [3, 4096])
def test_near_duplicates_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr("quillspark.llm.minhash.BLOCK", block)
    for k in (2,) if block == 3 else (2, 5):
        rows = corpus(k)
        sets = {i: shingles(t, k) for i, t in rows}
        links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        want = classes(sets, links)
        got = near_duplicates(documents(spark, rows), width=k).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
            i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_near_duplicates_of_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (None, text), (None, "only here x y z"), (None, None), (9, text + " i")]
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_duplicates(documents(spark, rows), width=2).collect())
    assert got == sorted([("5", "5", True), ("5", "5", True), ("None", "5", False), ("None", "None", True), ("None", "None", True), ("9", "5", False)])
    assert near_duplicates(empty(spark)).count() == 0


def test_a_group_linked_only_through_its_middle_is_found(spark):
    base = [f"b{i}" for i in range(60)]
    rows = [(100, " ".join(base))]
    for k in range(30):  # each differs from the base in two places of its own: pairwise under 0.8
        w = list(base)
        w[2 * k], w[(2 * k + 31) % 60] = f"x{k}", f"y{k}"
        rows.append((k, " ".join(w)))
    sets = {i: shingles(t, 2) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = classes(sets, links)
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(spark, rows), width=2).collect()}
    assert got == want


def test_super_minhash_estimates_similarity_with_low_variance():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        a = rng.integers(0, 2**63, 120).astype(np.uint64)
        b = np.concatenate([a[:90], rng.integers(0, 2**63, 30).astype(np.uint64)])
        s = super_minhash([a, b], 128)
        errors.append((s[0] == s[1]).mean() - 0.6)
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < (0.6 * 0.4 / 128) ** 0.5 * 1.1


def test_super_minhash_stops_early_without_changing_the_result():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 3000).astype(np.uint64)
    whole = super_minhash([a], 64)[0]
    parts = np.minimum(super_minhash([a[:1000]], 64)[0], super_minhash([a[1000:]], 64)[0])
    assert (whole == parts).all() and len(shingle_hashes(b"", 2)) == 0


def test_block_comparison_finds_every_link_once():
    rng, base = np.random.default_rng(0), np.random.default_rng(1).integers(0, 2**63, 300).astype(np.uint64)
    sets = []
    for _ in range(90):
        s = base.copy()
        m = int(rng.integers(0, 60))
        s[rng.choice(300, m, replace=False)] = rng.integers(0, 2**63, m).astype(np.uint64)
        sets.append(np.unique(s))
    signature = super_minhash(sets, 128)
    bands, sketch = band_hashes(signature, 32), np.packbits(signature.astype(np.uint8) & 1, axis=1).view(np.int64)
    want = []
    for a in range(90):
        for b in range(a + 1, 90):
            common = len(np.intersect1d(sets[a], sets[b]))
            if a % 3 != b % 3 and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                want.append((a, b))

    def member(k, side):
        return {"side": side, "node": k, "g": k % 3, "n": len(sets[k]), "sketch": sketch[k].tolist(), "bands": bands[k].tolist(),
                "small": np.unique(sets[k].astype(np.uint32)).tobytes()}

    buckets = {}
    for k in range(90):
        for h in bands[k].tolist():
            buckets.setdefault(h, []).append(k)
    whole, halves = [], []
    for h, v in buckets.items():
        whole += close_pairs(h, [member(k, 0) for k in v], 80, 128)
        even, odd = [k for k in v if k % 2 == 0], [k for k in v if k % 2]
        for part in (even, odd):
            halves += close_pairs(h, [member(k, 0) for k in part], 80, 128)
        if even and odd:
            halves += close_pairs(h, [member(k, 0) for k in even] + [member(k, 1) for k in odd], 80, 128)
    assert sorted(whole) == sorted(halves) == want and len(want) > 100


def removed(rows, k):
    w = [split(t) for _, t in rows]
    count = Counter(tuple(x[i : i + k]) for x in w for i in range(len(x) - k + 1))
    out = []
    for (key, _), x in zip(rows, w):
        cover = set()
        for i in range(len(x) - k + 1):
            if count[tuple(x[i : i + k])] > 1:
                cover.update(range(i, i + k))
        left = " ".join(y for j, y in enumerate(x) if j not in cover)
        out.append((str(key), len(x), len(cover), hashlib.sha256(left.encode()).hexdigest(), left))
    return sorted(out)


@pytest.mark.parametrize("k", [5, 35])
def test_repeated_windows_match_brute_force(spark, k):
    rows = corpus(k) + [(10, "a b " * 60), (None, "a b " * 60), (10, "a b " * 60)]
    got = remove_repeated(documents(spark, rows), window=k, with_text=True).collect()
    assert sorted((str(r.id), r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got) == removed(rows, k)


def test_repeated_windows_of_an_empty_table(spark):
    assert remove_repeated(empty(spark)).count() == 0


def norm(line):
    return re.sub(r"[\x00-/:-`{-\x7f]+", " ", line.lower()).strip()


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_corpus():
    rng = random.Random(8)
    base = [[f"w{rng.randrange(3000)}" for _ in range(rng.randrange(5, 60))] for _ in range(40)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
            lines.append(rng.choice([" ", ", ", " -- "]).join(w).upper() if rng.random() < 0.3 else " ".join(w))
        lines.append(rng.choice(["", "short one", "  "]))
        rows.append((i, "\n".join(lines)))
    return rows + [(98, None), (99, "")]


def repeated_lines(rows):
    """({(id, line): normalised line}, {normalised line: its group}, {group: first (id, line)})."""
    found = {}
    for i, t in rows:
        for j, line in enumerate((t or "").split("\n")):
            if len(norm(line).split()) >= 5:
                found[i, j] = norm(line)
    texts = sorted(set(found.values()))
    links = []
    for x, a in enumerate(texts):
        for b in texts[:x]:
            m, n = len(a.split()), len(b.split())
            if edits(a.split(), b.split()) <= max(m, n) * 20 // 100:
                links.append((a, b))
    group = classes(texts, links)
    first = {}
    for place in sorted(found):
        first.setdefault(group[found[place]], place)
    return found, group, first


def without_repeated_lines(rows):
    found, group, first = repeated_lines(rows)
    gone = {p for p, t in found.items() if p != first[group[t]]}
    return [(i, t and "\n".join(x for j, x in enumerate(t.split("\n")) if (i, j) not in gone)) for i, t in rows]


def test_line_groups_match_brute_force(spark):
    rows = line_corpus()
    found, group, first = repeated_lines(rows)
    got = line_groups(documents(spark, rows)).collect()
    assert {(r.doc_id, r.line): (r.first_id, r.first_line, r.kept) for r in got} == {
        p: (*first[group[t]], p == first[group[t]]) for p, t in found.items()}
    assert len(set(group.values())) < len(group)
    out = drop_repeated_lines(documents(spark, rows))
    assert out.columns == documents(spark, rows).columns
    assert {r.doc_id: r.text for r in out.collect()} == dict(without_repeated_lines(rows))


def test_lines_without_ids_repeated_rows_and_no_rows(spark):
    line = "one two three four five six"
    rows = [(None, line), (3, line), (3, line), (4, line + "\nown words here are these ones")]
    out = drop_repeated_lines(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == [("3", line), ("3", line), ("4", "own words here are these ones"), ("None", line)]
    assert line_groups(empty(spark)).count() == 0 and drop_repeated_lines(empty(spark)).count() == 0


@pytest.mark.parametrize("percent", [70, 80, 90])
def test_line_groups_match_plain_edit_similarity(spark, percent):
    rng = random.Random(percent)
    texts = []
    for n in [5, 6, 7, 8, 9, 10, 11, 14, 15, 19, 20, 21, 25, 40, 60, 130] * 3:
        base = [f"{'abcd'[rng.randrange(4)]}word{rng.randrange(3000)}" if rng.random() < 0.6 else rng.choice(["a", "of", "the", "in"]) for _ in range(n)]
        w, most = list(base), n * (100 - percent) // 100
        if rng.random() < 0.5:
            for e in range(most):  # evenly spread
                w[(2 * e + 1) * n // (2 * most)] = f"new{rng.randrange(10**6)}"
        else:
            for e in range(rng.randrange(most + 2)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = [f"new{rng.randrange(10**6)}"] * rng.randrange(2)
        texts += [" ".join(base), " ".join(w)]
    kept = [t for t in dict.fromkeys(texts) if len(t.split()) >= 5]
    links = [(i, j) for j, b in enumerate(kept) for i, a in enumerate(kept[:j])
             if edits(a.split(), b.split()) <= max(len(a.split()), len(b.split())) * (100 - percent) // 100]
    want = classes(range(len(kept)), links)
    got = {r.doc_id: r.first_id for r in line_groups(documents(spark, list(enumerate(kept))), percent=percent).collect()}
    assert got == want and len(links) > 20


def test_lines_within_the_similarity_share_a_gram_of_the_stated_width():
    for percent in (51, 67, 70, 75, 80, 90, 100):
        for q, low in enumerate(least_sizes(percent), 1):
            assert all(m - q + 1 - q * (m * (100 - percent) // 100) >= 1 for m in range(low, low + 5000))
    assert least_sizes(80) == [1, 2, 6] and len(least_sizes(60)) == 2


def test_long_words_are_told_apart():
    """The words that a sum modulo 2**64 takes for one: Thue and Morse's, and its complement."""
    from quillspark.llm.shared import LONG_WORD, word_hashes

    for n in (1024, 2048, 8192):
        word = bytes(97 + (i.bit_count() & 1) for i in range(n))
        other = bytes(97 + 98 - c for c in word)
        _, hashes = word_hashes(b"x " + word + b" y " + other + b" x")
        assert len(set(hashes.tolist())) == 4 and hashes[0] == hashes[4]
    edge = b"a" * LONG_WORD
    assert len(set(word_hashes(edge + b" " + edge + b"a " + edge + b"b")[1].tolist())) == 3


def test_repeated_windows_of_long_words(spark):
    from quillspark.llm.substrings import remove_repeated

    word = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([word] * 35)), (2, " ".join([other] * 35)), (3, " ".join([word] * 36))]
    got = {r.id: r.n_removed for r in remove_repeated(documents(spark, rows), window=35).collect()}
    assert got == {1: 35, 2: 0, 3: 36}

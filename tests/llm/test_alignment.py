import hashlib
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import corpus, documents, empty  # noqa: E402

from quillspark.llm.alignment import TwoTokenizers, align, lockstep_groups  # noqa: E402
from quillspark.llm.queries import tokenizer_path  # noqa: E402

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = [
    "x", " ", "  two  spaces ", "tab\there\n\nline \r\n end", "a<|endoftext|>b <s>x</s> <unk>", "▁ is no space", " nbsp  em x",
    "\x1c \x85 y ​", "日本語 テキスト 🙂🙂 é é", "=" * 3000, "a" * 999 + " b", "it's don't 'S 1234567 12 3", "ﬁ ²½ \x00 \x07 ﻿", "<0x41> <0xFF>",
    " leading", "trailing  ", "ーーーーーーーー" * 40, "\n" * 70 + "x",
]


@pytest.fixture(scope="module")
def plain():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    two = TwoTokenizers(A, B)
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return two, a, SentencePieceProcessor(model_file=B)


def brute(plain, texts):
    two, a, b = plain
    made = []
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        data = (" " + (t or "")).encode()
        if not t or b"".join(two.a_bytes[i] for i in x) != data or b"".join(two.b_bytes[i] for i in y) != data:
            made.append([])
            continue
        ends = set(np.cumsum([len(two.a_bytes[i]) for i in x]).tolist()) & set(np.cumsum([len(two.b_bytes[i]) for i in y]).tolist())
        groups, at = [], 0
        for i, side in [(0, x), (1, y)]:
            at, g = 0, 0
            for k in side:
                if len(groups) <= g:
                    groups.append(([], []))
                groups[g][i].append(k)
                at += len((two.a_bytes, two.b_bytes)[i][k])
                g += at in ends
        made.append(groups)
    links = [[(p, q) for x, y in g for p in x for q in y] for g in made]
    count = Counter(pair for one in links for pair in set(one))
    top = defaultdict(int)
    for (p, _), n in count.items():
        top[p] = max(top[p], n)
    out = []
    for g, one in zip(made, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(one),
                    sum(count[p] == top[p[0]] for p in one), sum(count[p] for p in one),
                    hashlib.sha256(text.encode()).hexdigest() if g else "", text))
    return out


def test_alignment_matches_whole_texts_and_all_links(spark, plain):
    rows = corpus(3) + [(800 + i, t) for i, t in enumerate(ODD)] + [(12, "again"), (12, "again"), (None, "no id")]
    got = align(documents(spark, rows), A, B, with_groups=True).collect()
    want = brute(plain, [t for _, t in rows])
    assert Counter(tuple(r) for r in got) == Counter((i, *w) for (i, _), w in zip(rows, want))
    assert sum(w[2] == 0 for w in want) >= 3  # null, empty and inexact texts


def test_bytes_that_are_no_text_have_no_tokens(spark):
    df = spark.createDataFrame([(1, bytearray(b"ab \xff cd")), (2, bytearray(b"fine"))], "doc_id long, text binary")
    got = {r.id: r for r in align(df, A, B).collect()}
    assert got[1].n_a == 0 and got[1].groups_sha256 == "" and got[2].n_a > 0


def test_empty_table(spark):
    assert align(empty(spark), A, B).collect() == []


@pytest.mark.parametrize("lane", [1, 3, 16, 1000])
def test_lanes_give_the_groups_of_a_set_intersection(lane):
    rng = random.Random(lane)
    for _ in range(60):
        a_end, b_end, a_from, base = [], [], [], 0
        for _ in range(rng.randrange(1, 6)):
            n = rng.randrange(1, 120)
            rate = rng.choice([0.05, 0.4, 0.9])
            a_from.append(len(a_end))
            for ends in (a_end, b_end):
                ends += [base + i for i in range(1, n) if rng.random() < rate] + [base + n]
            base += n
        groups = lockstep_groups(np.array(a_end), np.array(b_end), np.array(a_from), lane)
        ends = sorted(set(a_end) & set(b_end))
        past_a, past_b = [a_end.index(e) + 1 for e in ends], [b_end.index(e) + 1 for e in ends]
        want = list(zip([0, *past_a], [0, *past_b], past_a, past_b))
        assert [tuple(g) for g in groups.tolist()] == want


def test_groups_without_common_ends_are_linked_in_full(spark, plain):
    # One long unsynchronised stretch: more links than are listed one by one.
    two = plain[0]
    from quillspark.llm.alignment import linked_pairs

    a, b = np.array([5, 6, 5] * 40), np.array([7, 8] * 30)
    group, pair, times = linked_pairs(a, b, np.array([[0, 0, 120, 60]]))
    got = Counter()
    for p, n in zip(pair.tolist(), times.tolist()):
        got[p] += n
    assert got == Counter(x << 15 | y for x in a.tolist() for y in b.tolist()) and set(group.tolist()) == {0}
    assert two.a_length.min() > 0

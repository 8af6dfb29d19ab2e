import gzip
import hashlib
import io
import random
import sys
import zlib
from array import array
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import corpus, documents, empty  # noqa: E402

from quillspark.llm.packing import best_fit_decreasing, pack_pieces, tokenize  # noqa: E402
from quillspark.llm.queries import tokenizer_path  # noqa: E402
from quillspark.llm.sharding import cut_keys, shard_documents  # noqa: E402
from quillspark.llm.warc import read_records, record_bytes, round_trip  # noqa: E402


def test_best_fit_decreasing_matches_a_plain_search():
    rng = random.Random(0)
    for _ in range(100):
        capacity = rng.choice([10, 63, 64, 4096])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(60))]
        rooms = []
        for n in sorted(lengths, reverse=True):
            fits = [i for i, r in enumerate(rooms) if r >= n]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= n
            else:
                rooms.append(capacity - n)
        sequence, offset, count = best_fit_decreasing(lengths, capacity)
        got = [capacity] * count
        for s, n in zip(sequence, lengths):
            got[s] -= n
        assert sorted(got) == sorted(rooms)


def test_packing_is_gapless_and_exact(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    plain = Tokenizer.from_file(path)
    rows = corpus(1) + [(900, "word " * 9000), (901, "A<|endoftext|>b 's ''S O'Neill's ²½ ªº Ŀ İ \x85 \xad x\x1cy ﬁ 中"), (12, "again"), (12, "again"), (None, "x")]
    pieces = tokenize(documents(spark, rows), path, 512, 1, with_ids=True)
    got = pack_pieces(pieces, 512, block_pieces=40).collect()
    by = {}
    for r in got:
        by.setdefault((r.id, r.piece), []).append(r)
    for i, t in rows:
        ids = array("I", [*plain.encode(t or "", add_special_tokens=False).ids, 1]).tobytes()
        for p, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            mine = [r for r in by[i, p] if r.ids == part]
            assert mine and all((r.start, r.length, r.ids_crc32) == (a // 4, len(part) // 4, zlib.crc32(part)) for r in mine)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 512
    assert pack_pieces(tokenize(empty(spark), path)).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash") for r in rows], "page_id long, url string, html string, id int, digest string").repartition(3)


def test_archives_come_back_as_written(spark):
    big, other = "<p>" + "é" * 900, "z" * 1000
    rows = [(1, "http://a", big), (2, "http://b", big), (9, None, big), (3, "u", other), (4, "u", "z" * 999), (5, "u", "z" * 999), (6, "u", None), (7, "u", ""), (3, "u", other), (None, "u", other), (8, "a b\r\nc", "\r\n\r\nx" * 400)]
    back = round_trip(pages(spark, rows), )
    got = sorted((str(r["id"]), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect())
    main = {big: 9, other: 3}
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = main.get(html)
        revisit = to is not None and to != i
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    assert got == sorted(want)
    assert round_trip(pages(spark, [])).count() == 0


def archive(*payloads):
    return b"".join(record_bytes(str(i), "u", p, hashlib.sha1(p).hexdigest(), None) for i, p in enumerate(payloads))


def test_reader_streams_members_and_checks_digests():
    data = archive(b"", b"x" * 300_000, random.Random(1).randbytes(200_000))
    assert [len(r["payload"]) for r in read_records(io.BytesIO(data), True)] == [0, 300_000, 200_000]
    assert len(gzip.decompress(data)) > 500_000
    plain = gzip.decompress(archive(b"hello world"))
    for bad in (plain.replace(b"hello", b"jello"), plain.replace(b"Content-Length: 9", b"Content-Length: 8"), plain[:-2]):
        if bad != plain:
            with pytest.raises(ValueError):
                list(read_records(io.BytesIO(gzip.compress(bad))))
    with pytest.raises(ValueError):
        list(read_records(io.BytesIO(data[:-20])))


def smallest(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def test_cuts_are_minimax(spark):
    rng = random.Random(5)
    for case in range(4):
        n = [3, 40, 3000, 400][case]
        keys = sorted({rng.randrange(-(2**63), 2**63) for _ in range(n)}) if case < 3 else sorted(rng.sample(range(10**6), n))
        sizes = [rng.choice([1, 50, 1000]) if case != 2 else rng.randrange(1, 90) for _ in keys]
        if case == 1:
            sizes[17] = sum(sizes)
        rows = spark.createDataFrame(list(zip(keys, sizes)), "key long, size long")
        cuts, best = cut_keys(rows, 16)
        assert best == smallest(sizes, 16)
        shard = [0] * 17
        for k, s in zip(keys, sizes):
            shard[sum(k >= c for c in cuts if c is not None)] += s
        assert max(shard) <= best


def test_shards_hold_whole_groups_and_gapless_slots(spark):
    rows = corpus(2, 150) + [(700 + i, "same text") for i in range(90)] + [(5, "One two"), (None, "z")]
    got = shard_documents(documents(spark, rows), 16).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    groups = {}
    for r in got:
        groups.setdefault(r.group_key, set()).add(r.shard)
    assert all(len(s) == 1 for s in groups.values())
    assert shard_documents(empty(spark)).count() == 0


def test_a_long_url_and_ids_that_are_text(spark):
    url = "http://example.org/" + "x" * (2 << 20)
    same = "p" * 1500
    rows = [("a/b c", url, same), ("zé", "u", same), (None, "v", "short"), ("1", "w", None)]
    back = round_trip(spark.createDataFrame(rows, "page_id string, url string, html string"))
    got = {r.id: (r.url, r.payload_bytes, r.record_type, r.refers_to) for r in back.collect()}
    assert got == {"a/b c": (url, 1500, "revisit", "zé"), "zé": ("u", 1500, "response", None), None: ("v", 5, "response", None), "1": ("w", 0, "response", None)}


@pytest.mark.parametrize("piece", [1, 2, 3, 5, 64])
def test_headers_across_pieces(monkeypatch, piece):
    from quillspark.llm import warc

    monkeypatch.setattr(warc, "PIECE", piece)
    payloads = [b"", b"a\r\n\r\nb", b"\r\n" * 9]
    data = b"".join(record_bytes(str(i), "u", p, hashlib.sha1(p).hexdigest(), None) for i, p in enumerate(payloads))
    assert [r["payload"] for r in read_records(io.BytesIO(data), True)] == payloads

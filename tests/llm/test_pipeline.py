import random
import sys
import zlib
from array import array
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import classes, split, words  # noqa: E402
from test_dedup import shingles, without_repeated_lines  # noqa: E402
from test_models import counts  # noqa: E402

import corpus_pipeline  # noqa: E402
from quillspark.llm.queries import QUERIES, SQL, tokenizer_path  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, folder, rows, items):
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, COLUMNS).repartition(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in rows[:5] if i is not None], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def corpus():
    rng = random.Random(11)

    def text(n):
        w = words(rng, n, 6000)
        return "\n".join(" ".join(w[i : i + 20]) for i in range(0, n, 20))

    items = [(i, " ".join(words(rng, 30, 6000)) + ".") for i in range(4)]
    rows = [(i, text(rng.randrange(60, 200))) for i in range(24)]
    rows += [(30, text(10)), (31, None), (32, ""), (33, "same words again " * 40)]  # the base rules reject these
    rows += [(40, rows[3][1]), (41, rows[4][1])]  # exact copies lose all lines
    near = rows[5][1].split()
    near[7] = "changed"
    rows.append((42, "\n".join(" ".join(near[i : i + 13]) for i in range(0, len(near), 13))))  # other lines, same words
    rows += [(50 + i, f"{text(60)}\n{items[i][1]}\n{text(40)}") for i in range(3)]
    return rows, items


def expected(rows, items):
    from tokenizers import Tokenizer

    def failed(t):
        n, _, _, _, repeated = counts(t)
        return n < 50 or 100 * repeated > 50 * n

    rows = [(i, t) for i, t in rows if not failed(t)]
    rows = without_repeated_lines(rows)
    sets = {i: shingles(t, 5) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    group = classes(sets, links)
    rows = [(i, t) for i, t in rows if group[i] == i]
    plain = [" ".join(split(t)).strip(".") for _, t in items]
    rows = [(i, t) for i, t in rows if not any(x in " ".join(split(t)).replace(".", "") for x in plain)]
    tokenizer, out = Tokenizer.from_file(tokenizer_path()), set()
    for i, t in rows:
        ids = array("I", [*tokenizer.encode(t, add_special_tokens=False).ids, 1]).tobytes()
        for p, a in enumerate(range(0, len(ids), 4 * 4096)):
            out.add((i, p, a // 4, len(ids[a : a + 16384]) // 4, zlib.crc32(ids[a : a + 16384])))
    return out


def test_the_pipeline_matches_brute_force(spark, tmp_path):
    rows, items = corpus()
    got = corpus_pipeline.run(spark, tables(spark, tmp_path, rows, items)).collect()
    want = expected(rows, items)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    left = {x[0] for x in want}
    assert not left & {30, 31, 32, 33, 42, 50, 51, 52} and {0, 3, 5, 40} <= left


def test_stages_keep_columns_and_take_awkward_tables(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text), (None, "short"), (7, text + " more"), (7, text + " more"), (8, None)]
    folder = tables(spark, tmp_path, rows, [(1, None)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["7", "None"]
    assert corpus_pipeline.best_fit_packing(spark, docs.limit(0), folder).count() == 0


def test_columns_with_inner_names_do_no_harm(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    folder = tables(spark, tmp_path, [(None, text), (1, text)], [])
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 AS _row", "2 AS id", "3 AS kept")
    out = corpus_pipeline.quality_rules(spark, docs, folder)
    assert out.columns == docs.columns and out.count() == 2


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and SQL.keys() <= QUERIES.keys()
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_rules" and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df = QUERIES[name](spark, folder)
    want = con.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))

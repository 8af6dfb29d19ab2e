"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op3_best_fit_packing(spark, sf_dir):
    from quillspark.llm.packing import pack_pieces, tokenize

    pieces = tokenize(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096, end_id=1)
    return pack_pieces(pieces, 4096).withColumnRenamed("id", "doc_id")


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS main FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN main IS NOT NULL AND main <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN main <> page_id THEN main END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)
""")
def op6_warc(spark, sf_dir):
    from quillspark.llm.warc import round_trip

    back = round_trip(table(spark, sf_dir, "pages"), min_revisit=1000)
    return back.select(back["id"].alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_minimax_shards(spark, sf_dir):
    from pyspark.sql import functions as F

    from quillspark.llm.sharding import shard_documents

    placed = shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


#: Words of a text in DuckDB; the class is space and \\t..\\r.
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 1 THEN ws
        ELSE list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * i >= 80 * (nx.n + ny.n - i)),
e2 AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e2.y, r.c FROM r JOIN e2 ON r.doc_id = e2.x),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)
""")
def op1_near_duplicates(spark, sf_dir):
    from quillspark.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query(f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 34], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS p FROM w)),
rep AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
cov AS (SELECT DISTINCT doc_id, p + k AS q FROM win JOIN rep USING (g), generate_series(0, 34) t(k)),
pos AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS q FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS t FROM pos ANTI JOIN cov USING (doc_id, q) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""")
def op10_repeated_windows(spark, sf_dir):
    from quillspark.llm.substrings import remove_repeated

    found = remove_repeated(table(spark, sf_dir, "documents"), window=35)
    return found.withColumnRenamed("id", "doc_id")


@query()
def op4_quality_rules(spark, sf_dir):
    from quillspark.llm.quality import judge

    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op8_fuzzy_lines(spark, sf_dir):
    from quillspark.llm.lines import line_groups

    return line_groups(table(spark, sf_dir, "documents"), min_words=5, percent=80)


@query()
def op2_ppm_scores(spark, sf_dir):
    from pyspark.sql import functions as F

    from quillspark.llm.lm import score

    docs = table(spark, sf_dir, "documents")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    scored = score(docs, rest != 1)
    return scored.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op5_latent_decontamination(spark, sf_dir):
    from quillspark.llm.decontaminate import contaminated

    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@query()
def op7_licence_scan(spark, sf_dir):
    from quillspark.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """``documents`` with a run planted in about a tenth: where crc32(doc_id) is divisible by ten, the
    words from word g % n on repeat a pattern to the end (g is the crc32 over ten)."""
    from pyspark.sql import functions as F

    from quillspark.llm.shared import word_array

    hashed = docs.withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words = hashed.withColumn("_w", F.when(F.col("_h") % 10 == 0, word_array(F.col("text"))))
    sized = words.withColumn("_n", F.size("_w")).withColumn("_g", F.floor(F.col("_h") / 10))
    placed = sized.withColumn("_a", F.expr("CASE WHEN _n > 0 THEN _g % _n END"))
    placed = placed.withColumn("_p", F.expr("1 + floor((_n - _a) / (3 + _g % 8))"))
    planted = F.expr(
        "array_join(concat(slice(_w, 1, int(_a)), transform(sequence(_a, _n - 1), i -> _w[int(_a + (i - _a) % _p)])), ' ')")
    return placed.select("doc_id", F.when(F.col("_n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark, sf_dir):
    from pyspark.sql import functions as F

    from quillspark.llm.periods import periodic_runs

    found = periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")), min_length=12)
    best = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))"
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", F.expr(best)).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(F.expr("1000 * best.length / -best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query()
def op11_tokenizer_alignment(spark, sf_dir):
    from quillspark.llm.alignment import align

    found = align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


@query()
def op13_main_text(spark, sf_dir):
    from pyspark.sql import functions as F

    from quillspark.llm.html_text import extract

    found = extract(table(spark, sf_dir, "pages").withColumn("key", F.struct("page_id", "url")), id_col="key")
    return found.select("id.page_id", "id.url", "text", F.length("text").cast("long").alias("n_chars"))

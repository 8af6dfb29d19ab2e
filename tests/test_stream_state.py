"""State that a stream carries over restarts, against a plain loop over the rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quillspark.session import scratch_dir
from quillspark.streaming import state as SS

START = dt.datetime(2024, 1, 1)
SCHEMA = "id long, key string, ts timestamp"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(folder)


def test_unseen_over_restarts_and_forgotten_keys(spark):
    landed, out, ckpt = (scratch_dir(spark, n) for n in ("u-in", "u-out", "u-ckpt"))
    day = dt.timedelta(days=1)
    runs = [[(1, "a", START), (2, "b", START), (3, "a", START)],
            [(4, "a", START + day), (5, "c", START + day)],
            [(6, "x", START + 40 * day)],  # the clock moves on: a, b and c are forgotten
            [(7, "a", START + 41 * day), (8, "x", START + 41 * day), (9, "late", START)]]
    got = []
    for rows in runs:
        land(spark, landed, rows)
        stream = spark.readStream.schema(SCHEMA).parquet(landed)
        SS.run_available(SS.unseen(stream, "key", "ts", "10 days"), out, ckpt)
        found = sorted(r.key for r in spark.read.parquet(out).collect())
        got.append(found)
    assert got == [["a", "b"], ["a", "b", "c"], ["a", "b", "c", "x"], ["a", "a", "b", "c", "x"]]


def test_lookups_match_a_loop(spark):
    rng, ttl = random.Random(4), 3600
    rows, at = [], START
    for i in range(600):
        at += dt.timedelta(seconds=rng.choice([0, 1, 600, 1200]))
        rows.append((i, rng.choice(["hot", "hot", "k1", "k2", "k3", None]), at))
    rows.append((600, "k1", None))
    want, live = {}, {}
    for i, key, t in rows:
        if key is not None and t is not None:
            want[i] = key in live and t < live[key]
            live[key] = t + dt.timedelta(seconds=ttl)
    landed, out, ckpt = (scratch_dir(spark, n) for n in ("l-in", "l-out", "l-ckpt"))
    for part in range(3):  # a restart between the parts
        land(spark, landed, rows[part * 200 : part * 200 + 200] + rows[600:] * (part == 2))
        stream = spark.readStream.schema(SCHEMA).parquet(landed)
        SS.run_available(SS.lookups(stream, "key", "ts", "id", ttl), out, ckpt)
    back = spark.read.parquet(out).collect()
    assert len(back) == len(want) and {r.id: r.hit for r in back} == want
    assert any(want.values()) and not all(want.values())


def test_expired_entries_leave_the_state(spark):
    landed, out, ckpt = (scratch_dir(spark, n) for n in ("e-in", "e-out", "e-ckpt"))
    for i in range(4):
        land(spark, landed, [(i * 10 + k, f"k{i}-{k}", START + dt.timedelta(days=i)) for k in range(10)])
        stream = spark.readStream.schema(SCHEMA).parquet(landed)
        result = SS.lookups(stream, "key", "ts", "id", 60)
        q = result.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
        alive = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert alive <= 20 and spark.read.parquet(out).where(F.col("hit")).count() == 0

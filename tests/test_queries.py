"""Every registered query against its DuckDB oracle on the smallest driver tables,
compared like the driver does (sorted column names, row count, order-insensitive
value hash)."""

import datetime as dt
import decimal
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from quillspark.plans.catalog import registry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_survey_query_has_an_oracle():
    missing = set(registry()[0]) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(registry()[0]))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(cols, rows) == _digest(ocols, orows)

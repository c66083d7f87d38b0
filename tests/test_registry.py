"""Every registered query of the library runs on driver tables (sf 0.01, where all
freshness states occur) and equals the DuckDB result of its SQL, types included. The
training-data queries have tests of their own."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from netcap.plans import ORACLE_SQL, QUERIES
from conftest import SF_MID

TABLES = ["customer", "orders", "lineitem", "events"]


KINDS = {  # of values, as both engines hand them to Python
    "LongType()": int, "IntegerType()": int, "DoubleType()": float, "StringType()": str,
    "BooleanType()": bool, "DateType()": dt.date, "TimestampNTZType()": dt.datetime,
    "TimestampType()": dt.datetime,
}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return (type(v).__name__, v)


def _key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(_norm(r[i]) for i in order) for r in rows], key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "freshness_status" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_MID)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    assert not any("Decimal" in str(f.dataType) for f in df.schema.fields)
    for i, f in enumerate(df.schema.fields):
        assert all(r[i] is None or type(r[i]) is KINDS[str(f.dataType)] for r in rows), f.name
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    want = res.fetchall()
    assert not any(isinstance(v, decimal.Decimal) for r in want for v in r)
    assert _key(df.columns, rows) == _key(cols, want)


def test_all_freshness_states_occur(spark):
    states = {r[0] for r in QUERIES["freshness"](spark, SF_MID)
              .select("freshness_status").distinct().collect()}
    assert states == {"LIVE", "PARTIAL", "DELAYED"}

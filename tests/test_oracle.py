"""Every registered query against its DuckDB oracle on the smallest
tables (the driver runs the same compare at sf0.01)."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from segmentflow.plans import testdata

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(testdata.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = testdata.queries()[name](spark, SF)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.sql(testdata.oracle_sql()[name])
    assert sorted(cols) == sorted(rel.columns)
    exp = rel.fetchall()
    assert len(got) == len(exp)
    assert _digest(cols, got) == _digest(rel.columns, exp)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "list_of_segments" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    assert set(testdata.queries()) == set(testdata.oracle_sql())
    assert set(testdata.queries()) <= set(entry.queries())

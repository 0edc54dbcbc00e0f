"""Every registered query against its DuckDB oracle on the smallest shared tables (as the driver does)."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from martpulse.plans import catalog
from martpulse.sources.tables import SHARED_TABLES, table_path

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return "None" if v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in SHARED_TABLES:
        if os.path.exists(table_path(SF, t)):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


def test_every_query_has_an_oracle():
    missing = set(catalog.QUERIES) - set(oracle_sql())
    assert not missing, f"queries without oracle SQL: {missing}"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, orows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["log_hour", "today", "yesterday"]
    assert df.count() > 0

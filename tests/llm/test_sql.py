"""Corpus queries that SQL can express, against DuckDB over the same tables."""

import duckdb
import pytest

from martpulse.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)

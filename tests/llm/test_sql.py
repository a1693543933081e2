"""Queries of this subpackage against their DuckDB oracles on the smallest tables."""

import duckdb
import pytest

from fleetloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(SQL[name])
    names = list(want.columns)
    assert sorted(names) == columns
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key) == sorted((tuple(x[names.index(c)] for c in columns) for x in want.fetchall()), key=key)

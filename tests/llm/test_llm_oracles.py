"""The queries of the package that SQL can express, against it."""

import duckdb
import pytest

from termwright.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.sql(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=str)

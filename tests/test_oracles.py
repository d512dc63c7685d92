"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from termwright.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if type(value).__name__ == "Decimal":
        return round(float(value), 6)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    found = oracle.sql(registry.ORACLE_SQL[name])
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=str)

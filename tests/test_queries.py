"""Registered queries against their SQL in DuckDB on the smallest tables."""

import duckdb
import pytest

from locusmill.plans.handed import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = ("customer", "documents", "events", "lineitem", "nation", "orders", "part", "region", "supplier")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    return round(float(v), 6) + 0.0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) if not isinstance(r[c], dict) else str(r[c]) for c in cols) for r in df.collect()], key=repr)
    if name not in SQL:
        assert got
        return
    r = duck.execute(SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    want = sorted([tuple(plain(row[names.index(c)]) for c in cols) for row in r.fetchall()], key=repr)
    assert got == want

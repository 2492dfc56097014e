"""Every named query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tramline.plans.queries import QUERIES, SQL

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(x):
    if x is None or x != x:
        return "null"
    if isinstance(x, bool) or not hasattr(x, "__float__"):
        return str(x)
    return f"{float(x):.10g}"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    relation = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    at = [relation.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in relation.fetchall())


def test_sample_is_the_same_each_time(spark):
    a, b = (sorted(map(tuple, QUERIES["hash_sample"](spark, DATA).collect())) for _ in range(2))
    assert a == b and a

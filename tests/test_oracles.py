"""Registered panel queries against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from tidemark.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def norm(v):
    return round(v, 5) + 0.0 if isinstance(v, float) else v


FAST = sorted(ORACLES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    want = sorted(repr([norm(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
    assert sorted(repr([norm(r[c]) for c in columns]) for r in df.collect()) == want

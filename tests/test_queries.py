"""Every query against DuckDB, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from loomspark.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return repr(v)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())

"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(round(r[i], 6) if isinstance(r[i], float) and math.isfinite(r[i]) else r[i] for i in order))
    return sorted(out, key=repr)


def test_every_oracle_belongs_to_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["set_id", "begin", "end"]
    assert df.count() == 5830

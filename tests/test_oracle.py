"""Every registered query against its DuckDB oracle on sf0.001 (the driver runs sf0.01)."""

import os

import duckdb
import pytest

from conftest import SF_SMALL
from termdex.plans.registry import ORACLE_SQL, QUERIES

TABLES = ("documents", "conversations", "pages", "benchmark")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = _norm([tuple(r) for r in df.collect()], df.columns)
    res = con.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert got == _norm(res.fetchall(), res.columns)

"""Every registered query of the library equals its DuckDB oracle on the sf0.001 tables
(row count, column names and the multiset of rows)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ledger_analytics.plans import oracle, registry
from ledger_analytics.standins import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(E.queries()) and set(oracle.oracle_sql()) <= set(E.oracle_sql())
    assert len(registry.queries()) == 49


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _bag(got, df.columns) == _bag(want, cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0

"""Rows by rank: any page, no sort or heap that grows with its number."""

import random
from collections import Counter

import pytest

from ledger_analytics.operators.ranks import rows_at
from ledger_analytics.plans import analytics as A

BIG = (1 << 63) - 1


def pages_of(rows, key=lambda r: (r[0] is None, r[0] or 0)):
    return sorted(rows, key=key)


def test_unique_keys_over_the_whole_range_of_bigint(spark):
    r = random.Random(4)
    keys = [-BIG - 1, BIG, 0, -1, 1, *[r.randrange(-BIG, BIG) for _ in range(60)], *range(5000, 5100)]
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k bigint, v string").repartition(4)
    want = sorted(keys)
    for offset, limit in ((0, 1), (0, 10), (41, 7), (len(keys) - 3, 10), (len(keys) - 1, 1), (len(keys), 5), (10**30, 10**30)):
        rows, total = rows_at(df, "k", offset, limit)
        assert total == len(keys)
        assert [x.k for x in rows.collect()] == want[offset:offset + limit], (offset, limit)


def test_equal_keys_null_keys_and_equal_rows_give_every_row_once(spark):
    # a third of all rows under one key, some of them equal in all columns, and some without a key
    rows = [(7, f"a{i % 9}") for i in range(60)] + [(k, "x") for k in range(50)] + [(None, f"n{i % 3}") for i in range(30)] + [(9, "same")] * 40
    df = spark.createDataFrame(rows, "k bigint, v string").repartition(5)
    for limit in (50, 180):
        got = []
        for offset in range(0, len(rows), limit):
            page, total = rows_at(df, "k", offset, limit)
            page = [tuple(x) for x in page.collect()]
            assert total == len(rows) and len(page) == min(limit, len(rows) - offset)
            assert [x[0] for x in page] == [x[0] for x in pages_of(rows)[offset:offset + limit]]
            got += page
        assert Counter(got) == Counter(rows)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k bigint, v string")
    rows, total = rows_at(df, "k", 0, 10)
    assert rows.count() == 0 and total == 0


@pytest.mark.parametrize("page", [1, 4, 10, 11, 100_000_000, 10**25])
def test_no_top_n_in_the_plan(spark, page):
    ops = spark.range(1, 100).selectExpr("id AS cod_operadora", "concat('o', id) AS razao_social")
    out = A.operators_page(ops, page, 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan
    got = out.collect()
    if page <= 10:
        assert [x.cod_operadora for x in got] == list(range(10 * page - 9, min(10 * page, 99) + 1))
    else:
        assert [x.cod_operadora for x in got] == [None]
    assert {x.total for x in got} == {99}

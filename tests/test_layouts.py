"""Clustered files are read by range; bucketed tables join as they lie."""

import tempfile
import uuid
from collections import Counter

import pytest

from ledger_analytics import standins as S
from ledger_analytics.plans import analytics as A
from ledger_analytics.plans.registry import LOOKUP_CNPJ
from ledger_analytics.sinks.layouts import files_with, read_at, save_bucketed, write_clustered

from .conftest import SF_SMALL


def folder():
    return tempfile.mkdtemp(prefix="ledger test é%20-") + "/t"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_a_look_up_opens_one_file(spark):
    ops, path = S.operadoras(spark, SF_SMALL), folder()
    write_clustered(ops, path, "cnpj", files=12, blooms=["cnpj"])
    assert len(spark.read.parquet(path).inputFiles()) == 12
    got = A.operator_by_cnpj_clustered(spark, path, LOOKUP_CNPJ)
    assert len(got.inputFiles()) == 1 and "EqualTo(cnpj" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(A.operator_by_cnpj(ops, LOOKUP_CNPJ)) and got.count() == 1
    for cnpj in ("", "zzz", "0000010554343"):
        assert A.operator_by_cnpj_clustered(spark, path, cnpj).count() == 0 and len(files_with(spark, path, [cnpj])) <= 1
    assert rows(spark.read.parquet(path)) == rows(ops)


def test_history_from_clustered_files(spark):
    ops, facts, a, b = S.operadoras(spark, SF_SMALL), S.despesas(spark, SF_SMALL), folder(), folder()
    write_clustered(ops, a, "cnpj", files=4)
    write_clustered(facts, b, A.KEY, files=10)
    got = A.expense_history_clustered(spark, b, a, LOOKUP_CNPJ)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in A.expense_history(facts, ops, LOOKUP_CNPJ).collect()] and got.count() > 3
    assert len(read_at(spark, b, A.KEY, [7]).inputFiles()) <= 2
    assert A.expense_history_clustered(spark, b, a, "none").count() == 0


def test_a_key_with_many_rows_is_in_several_files(spark):
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 WHEN id % 3 = 1 THEN id ELSE NULL END AS k", "id AS v")
    path = folder()
    write_clustered(df, path, "k", files=30)
    hot = read_at(spark, path, "k", [5])
    assert rows(hot) == rows(df.where("k = 5")) and len(hot.inputFiles()) >= 5
    assert len(read_at(spark, path, "k", [4000]).inputFiles()) == 1
    sizes = [r.n_rows for r in spark.read.parquet(f"{path}/_ranges").collect()]
    assert max(sizes) < 1500 and sum(sizes) == 9000
    write_clustered(df.limit(0), path, "k")
    assert read_at(spark, path, "k", [5]).count() == 0


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    keep = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_bucketed_tables_join_without_an_exchange(spark, no_broadcast):
    path, own = folder(), uuid.uuid4().hex
    facts, ops = (save_bucketed(df, f"{name}_{own}", A.KEY, 8, f"{path}/{name}") for name, df in (("f", S.despesas(spark, SF_SMALL)), ("o", S.operadoras(spark, SF_SMALL))))
    try:
        out = A.state_distribution(facts, ops)
        plan = out._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("SortMergeJoin"):]
        assert "Bucketed: true" in below and "Exchange" not in below
        assert rows(out) == rows(A.state_distribution(S.despesas(spark, SF_SMALL), S.operadoras(spark, SF_SMALL)))
        joined = facts.join(ops, A.KEY)
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("f", "o"):
            spark.sql(f"DROP TABLE {name}_{own}")

"""Physical-plan checks: no Python in query plans, top-k as
TakeOrderedAndProject, partition pruning on the period, partial
aggregation before the fact meets the dimension, bounded window limits."""

import tempfile

import __spark_entry__ as E
from ledger_analytics import standins as S
from ledger_analytics.operators.dedup import dedup_first
from ledger_analytics.plans import analytics as A
from ledger_analytics.plans import registry

from .conftest import SF_SMALL

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_registered_queries(spark):
    for name, fn in registry.queries().items():
        p = plan(fn(spark, SF_SMALL))
        assert not any(n in p for n in PYTHON_NODES), name


def test_topk_is_take_ordered(spark):
    for name in ("state_distribution", "top_operators", "top_growth"):
        assert "TakeOrderedAndProject" in plan(E.queries()[name](spark, SF_SMALL)), name


def test_period_filter_prunes_partitions(spark):
    path = tempfile.mkdtemp(prefix="ledger-fact-") + "/despesas"
    S.despesas(spark, SF_SMALL).write.partitionBy("ano", "trimestre").parquet(path)
    fact = spark.read.parquet(path)
    p = plan(A.top_growth(fact, S.operadoras(spark, SF_SMALL), 1996, 1, last_quarter=3))
    assert "PartitionFilters: [isnotnull(ano" in p and "(trimestre" in p


def test_fact_is_aggregated_before_the_join(spark):
    df = A.state_distribution(S.despesas(spark, SF_SMALL), S.operadoras(spark, SF_SMALL))
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = opt.find("Join Inner")
    # the per-operator sum sits below the join
    assert join_at >= 0 and "sum(valor_despesa" in opt[join_at:]


def test_dedup_uses_group_limit(spark):
    r = S.registry(spark, SF_SMALL)
    assert "WindowGroupLimit" in plan(dedup_first(r, ["CNPJ"], ["reg_order"]))


def test_no_cross_or_nested_loop_joins(spark):
    for name, fn in registry.queries().items():
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_leaf_filter_scans_its_input_once(spark):
    from ledger_analytics.operators.normalize import leaf_accounts

    p = plan(leaf_accounts(S.raw_accounts(spark, SF_SMALL)))
    assert p.count("FileScan parquet") == 1
    assert "WindowGroupLimit" in p
    # no rows are made per prefix of a code: the only Generate is the stand-in's
    assert p.count("Generate explode") <= plan(S.raw_accounts(spark, SF_SMALL)).count("Generate explode")


def test_top_growth_scans_the_fact_twice(spark):
    path = tempfile.mkdtemp(prefix="ledger-fact-") + "/despesas"
    S.despesas(spark, SF_SMALL).write.parquet(path)
    ops = spark.createDataFrame([(1, "A")], "cod_operadora long, razao_social string")
    assert plan(A.top_growth(spark.read.parquet(path), ops, 1996, 1, last_quarter=3)).count("FileScan parquet") <= 2


def test_checks_start_no_job_while_they_are_built(spark):
    names = ("orphan_facts", "duplicate_keys", "null_violations", "length_violations", "expense_history")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building-checks", "plans only")
    for name in names:
        fn = registry._QUERIES[name]
        fn(spark, SF_SMALL)
    jobs = tracker.getJobIdsForGroup("building-checks")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading a parquet schema may run a one-task job; nothing else does
    assert all(tracker.getJobInfo(j) is None or len(tracker.getJobInfo(j).stageIds) == 1 for j in jobs)


def test_no_broadcast_hints(spark):
    for name in ("above_mean_quarters", "expense_history"):
        opt = registry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" not in opt, name


def test_consolidation_has_no_aggregate_after_the_joins(spark):
    from ledger_analytics.operators.consolidate import consolidate
    from ledger_analytics.operators.normalize import normalize_accounts

    df = consolidate(normalize_accounts(S.account_file_rows(spark, SF_SMALL)), S.registry(spark, SF_SMALL)).consolidated
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    top = opt[: opt.find("Join")]
    assert "Join" in opt and "Aggregate" not in top

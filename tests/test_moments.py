"""Statistics from stored moments: any split of a fact gives the statistics of the whole."""

import random
import statistics
import tempfile
from collections import defaultdict
from decimal import Decimal

import pytest

from ledger_analytics.operators import moments as M
from ledger_analytics.operators.aggregate import expense_report
from ledger_analytics.plans import analytics as A
from ledger_analytics.plans import registry as R

FACT = "cod_operadora bigint, ano int, trimestre int, valor_despesa decimal(18,2)"


def facts(n=600):
    r = random.Random(8)
    # one operator holds a third of all rows; large values that lie close together; single rows; NULL values
    rows = [(1, 2020 + i % 5, 1 + i % 4, Decimal("99999999999.00") + Decimal(r.randrange(1000)) / 100) for i in range(n // 3)]
    rows += [(r.randrange(2, 40), 2020 + i % 5, 1 + i % 4, Decimal(r.randrange(-10**8, 10**8)) / 100) for i in range(n // 2)]
    rows += [(100, 2020, 1, Decimal("5.00")), (101, 2020, 1, None), (102, 2021, 2, None), (102, 2021, 3, Decimal("7.10")), (None, 2020, 1, Decimal("1.00")), (None, 2021, 1, Decimal("2.00"))]
    return rows


def expected(rows):
    of = defaultdict(list)
    for k, _, _, v in rows:
        of[k] += [v] if v is not None else []
    return {k: (len(v), sum(v) if v else None, statistics.stdev(v) if len(v) > 1 else None) for k, v in of.items()}


def check(states, want):
    got = {r["cod_operadora"]: (r["n"], r["total"], r["sd"]) for r in states.withColumn("sd", M.std_of()).collect()}
    assert got.keys() == want.keys()
    for k, (n, total, sd) in want.items():
        assert got[k][:2] == (n, total), k
        assert (got[k][2] is None) == (sd is None) and (sd is None or got[k][2] == pytest.approx(float(sd), rel=1e-6, abs=1e-4)), k


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_loads_merge_to_the_whole(spark, parts):
    rows = facts()
    loads = [spark.createDataFrame(rows[i::parts], FACT) for i in range(parts)]
    states = [M.moments(x, ["cod_operadora", "ano", "trimestre"], "valor_despesa") for x in loads]
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    check(M.roll_up(every, ["cod_operadora"]), expected(rows))
    merged = M.roll_up(states[0], ["cod_operadora"])
    for s in states[1:]:
        merged = M.merge_moments(merged, M.roll_up(s, ["cod_operadora"]), ["cod_operadora"])
    check(merged, expected(rows))


def test_empty_states(spark):
    none = M.moments(spark.createDataFrame([], FACT), ["cod_operadora"], "valor_despesa")
    some = M.moments(spark.createDataFrame(facts(60), FACT), ["cod_operadora"], "valor_despesa")
    assert M.roll_up(none, ["cod_operadora"]).count() == 0
    for a, b in ((none, some), (some, none)):
        check(M.merge_moments(a, b, ["cod_operadora"]), expected(facts(60)))


def test_a_load_that_is_run_again_replaces_its_states(spark):
    path, keys = tempfile.mkdtemp(prefix="ledger-test-") + "/moments", ["cod_operadora", "ano", "trimestre"]
    rows = facts(90)
    for load, own in (("a", rows[::2]), ("b", rows[1::3]), ("b", rows[1::2]), ("a", rows[::2])):
        M.write_moments(spark.createDataFrame(own, FACT), path, load, keys, "valor_despesa")
    check(M.roll_up(M.read_moments(spark, path, keys), ["cod_operadora"]), expected(rows))


def test_later_statistics_do_not_read_the_fact(spark):
    path = tempfile.mkdtemp(prefix="ledger-test-")
    rows = facts(120)
    spark.createDataFrame(rows, FACT).write.parquet(f"{path}/fact")
    M.write_moments(spark.read.parquet(f"{path}/fact"), f"{path}/moments", "a", ["cod_operadora", "ano", "trimestre"], "valor_despesa")
    ops = spark.range(1, 120).selectExpr("id AS cod_operadora", "concat('o', id % 7) AS razao_social", "CAST(id % 3 AS STRING) AS uf")
    states = M.read_moments(spark, f"{path}/moments", ["cod_operadora", "ano", "trimestre"])
    out = M.statistics_of(states, ops)
    assert f"{path}/fact" not in out._jdf.queryExecution().executedPlan().toString()
    whole = A.operator_statistics(spark.read.parquet(f"{path}/fact"), ops)
    rounded = lambda df: {r[0]: (*r[1:4], r[4] and round(r[4], 6), r[5]) for r in df.collect()}
    assert rounded(out) == rounded(whole)


def test_report_from_states(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.choice(["SP", "RJ", None]), Decimal(r.randrange(10**6)) / 100, i % 3) for i in range(200)] + [("one", "SP", Decimal("3.33"), 0)]
    valid = spark.createDataFrame(rows, "RazaoSocial string, UF string, ValorDespesas decimal(18,2), load int")
    states = [M.moments(valid.where(f"load = {i}"), ["RazaoSocial", "UF"], "ValorDespesas") for i in range(3)]
    got = M.report_of(states[0].unionByName(states[1]).unionByName(states[2])).collect()
    assert [tuple(x) for x in got] == [tuple(x) for x in expense_report(valid).collect()]


def test_two_loads_make_the_fact_once(spark):
    path, keys = tempfile.mkdtemp(prefix="ledger-test-") + "/fact", ["cod_operadora", "ano", "trimestre"]
    rows = facts(120)
    spark.createDataFrame(rows, FACT).write.parquet(path)
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    fact = spark.read.parquet(path).mapInArrow(counted, FACT)
    states = R._two_loads(fact, keys, "valor_despesa", "(ano * 4 + trimestre) % 3 <> 0")
    assert not any(path in s._jdf.queryExecution().executedPlan().toString() for s in states)
    check(M.roll_up(states[0].unionByName(states[1]), ["cod_operadora"]), expected(rows))
    assert made.value == len(rows)

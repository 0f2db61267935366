"""Files that are sent again: the stages are those of a run over the files as they are now."""

import os
import random
import tempfile
from collections import Counter

import pytest

import ledger_analytics.plans.corrections as plans
from ledger_analytics.operators import consolidate as C
from ledger_analytics.operators import corrections as R
from ledger_analytics.plans.batch import run_batch

LINES = "source_file string, REGISTRO_OPERADORA bigint, DATA_BASE string, VALOR_DESPESAS decimal(18,2)"
REGISTRY = [(str(i), f"{i:014d}", f"N{i}", "M", "SP") for i in range(30)] + [("5", "00000000000005", "again", "M", "SP"), ("6", "77", "other id", "M", None)]


def lines(spark, rows):
    return spark.createDataFrame([(f, k, d, str(v)) for f, k, d, v in rows], "f string, k bigint, d string, v string").selectExpr(
        "f AS source_file", "k AS REGISTRO_OPERADORA", "d AS DATA_BASE", "CAST(v AS DECIMAL(18,2)) AS VALOR_DESPESAS")


def registry(spark):
    return spark.createDataFrame(REGISTRY, "REGISTRO_OPERADORA string, CNPJ string, RAZAO_SOCIAL string, MODALIDADE string, UF string")


def some_lines(seed, file, n):
    r = random.Random(seed)
    dates = ["2024-02-01", "2024-05-01", "2024-02-30", None]
    # registration 3 holds a third of all lines
    return [(file, r.choice([3, r.randrange(40), r.randrange(40)]), r.choice(dates), r.randrange(-500, 900) / 100) for _ in range(n)]


@pytest.mark.parametrize("sent", [10**6, 0])
def test_changes_give_what_a_whole_run_gives(spark, sent):
    a, b, b2 = some_lines(1, "a", 300), some_lines(2, "b", 200), some_lines(2, "b", 120) + some_lines(3, "b", 90)
    reg = registry(spark)
    nets = C.net_lines(C.split_dates(lines(spark, a + b))[0]).checkpoint()
    before = C.attach_registry(nets, reg).checkpoint()
    for new in (b2, b, []):
        changes = R.net_changes(lines(spark, b), lines(spark, new)).checkpoint()
        got = R.consolidated_after(before, nets, changes, reg, sent=sent)
        want = C.consolidate(lines(spark, a + new), reg).consolidated
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
        if new is b:
            assert changes.isEmpty()
        later = R.untouched(nets, changes, sent).select(*nets.columns).unionByName(R.changed_nets(nets, changes, sent))
        whole = C.net_lines(C.split_dates(lines(spark, a + new))[0])
        assert Counter(map(tuple, later.collect())) == Counter(map(tuple, whole.select(*later.columns).collect()))


def test_untouched_rows_are_not_exchanged(spark):
    nets = spark.range(1000).selectExpr("id AS RegistroANS", "2024 AS Ano", "1 AS Trimestre", "CAST(1 AS DECIMAL(28,2)) AS net", "1L AS n_lines").checkpoint()
    changes = nets.limit(3)
    plan = R.untouched(nets, changes)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "hashpartitioning" not in plan.split("LeftAnti")[1].split("BroadcastExchange")[0]


HEADER = "DATA;REG_ANS;CD_CONTA_CONTABIL;DESCRICAO;VL_SALDO_INICIAL;VL_SALDO_FINAL\n"


def write(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "".join(f"{d};{k};411{c};X;0,00;{v}\n" for d, k, c, v in rows))


def files(root):
    r = random.Random(7)
    date = {"1T": ["2025-01-01"], "2T": ["2025-04-01", "2025-02-01"], "3T": ["2025-07-01", "2025-02-30"]}
    for name, dates in date.items():
        write(f"{root}/a b/{name}.csv", [(r.choice(dates), r.randrange(8), i, f"{r.randrange(-900, 1500)},{r.randrange(10)}0") for i in range(100, 160)])


def stages(spark, out):
    tables = {}
    for name in ("normalized", "nets", "consolidated", "clean", "aggregated"):
        df = spark.read.parquet(f"{out}/{name}")
        tables[name] = Counter(tuple(str(x) for x in row) for row in df.select(*sorted(c for c in df.columns)).collect())
    return tables


def cnpj(base):
    digits = lambda s, w: str(0 if (r := sum(int(a) * b for a, b in zip(s, w)) % 11) < 2 else 11 - r)
    one = digits(base, [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2])
    return base + one + digits(base + one, [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2])


@pytest.fixture
def batch(spark):
    root = tempfile.mkdtemp(prefix="ledger-test-")
    files(f"{root}/raw")
    with open(f"{root}/registry.csv", "w") as f:
        f.write("REGISTRO_OPERADORA;CNPJ;RAZAO_SOCIAL;MODALIDADE;UF\n" + "".join(f"{i};{cnpj(f'{i + 11:012d}')};OP {i};M;SP\n" for i in range(7)))
    run_batch(spark, f"{root}/raw", f"{root}/registry.csv", f"{root}/out", export=False)
    return root


def resend(spark, root, *names):
    plans.resend_files(spark, [f"{root}/raw/a b/{n}.csv" for n in names], f"{root}/registry.csv", f"{root}/out", export=False)


def whole(spark, root):
    out = tempfile.mkdtemp(prefix="ledger-test-")
    run_batch(spark, f"{root}/raw", f"{root}/registry.csv", out, export=False)
    return stages(spark, out)


def test_resent_files(spark, batch):
    r = random.Random(9)
    # one file with other lines and one more quarter, one without any line
    write(f"{batch}/raw/a b/2T.csv", [(r.choice(["2025-04-01", "2024-10-01"]), r.randrange(8), i, f"{r.randrange(-900, 1500)},00") for i in range(100, 150)])
    write(f"{batch}/raw/a b/3T.csv", [])
    resend(spark, batch, "2T", "3T")
    want = whole(spark, batch)
    assert stages(spark, f"{batch}/out") == want and want["consolidated"].total() > 5
    resend(spark, batch, "2T", "3T")  # once more: nothing changes
    assert stages(spark, f"{batch}/out") == want
    os.remove(f"{batch}/raw/a b/1T.csv")
    resend(spark, batch, "1T")
    assert stages(spark, f"{batch}/out") == whole(spark, batch)


@pytest.mark.parametrize("after", [2, 5])  # before the plan is written, and half carried out
def test_a_run_that_is_broken_off_is_finished_by_the_next(spark, batch, monkeypatch, after):
    write(f"{batch}/raw/a b/2T.csv", [("2025-04-01", 1, 100, "5,00"), ("2025-01-01", 2, 101, "7,00")])
    real, count = plans.write_parquet, [0]

    def broken(*a, **k):
        if count[0] == after:
            raise OSError("lost")
        count[0] += 1
        return real(*a, **k)

    monkeypatch.setattr(plans, "write_parquet", broken)
    with pytest.raises(OSError):
        resend(spark, batch, "2T")
    monkeypatch.setattr(plans, "write_parquet", real)
    resend(spark, batch, "2T")
    assert stages(spark, f"{batch}/out") == whole(spark, batch)

"""Loads that are published at once, and rules that are counted while they are written."""

import os
import tempfile
from collections import Counter
from decimal import Decimal

import pytest

from ledger_analytics.operators import checks as K
from ledger_analytics.operators.load import load_operators
from ledger_analytics.plans.batch import load_operators_checked, publish_star_schema, registry_as_staging
from ledger_analytics.plans.views import star_tables
from ledger_analytics.sinks.versions import Load, VersionedTables

CLEAN = "CNPJ string, RazaoSocial string, Trimestre int, Ano int, ValorDespesas decimal(18,2), RegistroANS bigint, MODALIDADE string, UF string"
AGG = "RazaoSocial string, UF string, Total_Despesas decimal(38,2), Media_Trimestral decimal(38,2), Desvio_Padrao_Despesas double"


def inputs(spark, ids, quarter, amount):
    registry = spark.createDataFrame([(str(i), f"{i:014d}", f"N{i}", "M", "SP", i) for i in ids],
                                     "REGISTRO_OPERADORA string, CNPJ string, RAZAO_SOCIAL string, MODALIDADE string, UF string, reg_order int")
    clean = spark.createDataFrame([(f"{i:014d}", f"N{i}", q, 2025, Decimal(amount), i, "M", "SP") for i in ids for q in (quarter, 4)], CLEAN)
    agg = spark.createDataFrame([(f"N{i}", "SP", Decimal(amount), Decimal(amount), 0.0) for i in ids], AGG)
    return registry_as_staging(registry), clean, agg


def content(spark, root):
    return {t: Counter(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect()) for t, df in star_tables(spark, root).items()}


def test_a_load_that_ends_between_two_writes_leaves_the_old_version(spark, monkeypatch):
    whole, broken = (tempfile.mkdtemp(prefix="ledger-test-") for _ in range(2))
    for root in (whole, broken):
        publish_star_schema(spark, *inputs(spark, [5, 3, 9], 1, "10.00"), root)
    before = content(spark, whole)
    later = inputs(spark, [4, 3, 8, 1], 2, "7.00")
    publish_star_schema(spark, *later, whole)
    after = content(spark, whole)
    keys = {r.registro_ans: r.cod_operadora for r in star_tables(spark, whole)["operadoras"].collect()}
    assert keys == {3: 1, 5: 2, 9: 3, 1: 4, 4: 5, 8: 6}
    # the fourth quarter was replaced by the second load, the first one stayed
    facts = Counter((r.trimestre, str(r.valor_despesa)) for r in star_tables(spark, whole)["despesas_consolidadas"].collect())
    assert facts == {(1, "10.00"): 3, (2, "7.00"): 4, (4, "7.00"): 4}
    assert Counter(r.razao_social for r in star_tables(spark, whole)["despesas_agregadas"].collect()) == Counter(["N4", "N3", "N8", "N1"])

    real, ends_at = Load.write, ["despesas_consolidadas", "despesas_agregadas", "operadoras_regras"]
    for name in ends_at:
        def ends(self, table, *a, name=name, **k):
            if table == name:
                raise OSError("lost")
            return real(self, table, *a, **k)

        monkeypatch.setattr(Load, "write", ends)
        with pytest.raises(OSError):
            publish_star_schema(spark, *later, broken)
        assert content(spark, broken) == before
    monkeypatch.setattr(Load, "write", real)
    publish_star_schema(spark, *later, broken)
    assert content(spark, broken) == after


def test_readers_keep_their_version_and_writers_do_not_meet(spark):
    root = tempfile.mkdtemp(prefix="ledger-test-")
    tables = VersionedTables(spark, root)
    assert tables.current() == 0 and tables.read("t") is None
    rows = lambda *x: spark.createDataFrame([(i, i % 2) for i in x], "a int, p int")
    load = tables.begin()
    load.write("t", rows(1, 2, 3), "partitions", ["p"])
    load.write("u", rows(), "replace")
    load.write("v", rows(1), "append")
    assert load.publish() == 1
    old = tables.read("t")
    one, two = tables.begin(), tables.begin()
    one.write("t", rows(11), "partitions", ["p"])
    one.write("v", rows(2), "append")
    two.write("t", rows(21))
    one.publish()
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        two.publish()
    got = lambda df: sorted(tuple(r) for r in df.select("a", "p").collect())
    assert got(old) == [(1, 1), (2, 0), (3, 1)] == got(tables.read("t", 1))
    assert got(tables.read("t")) == [(2, 0), (11, 1)] and got(tables.read("v")) == [(1, 1), (2, 0)] and got(tables.read("u")) == []
    assert tables.versions() == [1, 2]
    # a version without its mark is none
    os.remove(f"{root}/versions/{2:010d}/_SUCCESS")
    assert tables.current() == 1 and got(tables.read("t")) == [(1, 1), (2, 0), (3, 1)]
    with pytest.raises(ValueError):
        tables.begin().write("t", rows(1), "partitions")


def test_rules_are_counted_by_the_write(spark):
    rows = [("1", "a" * 14, None, "SP", 0), ("2", "b" * 15, "N", None, 1), ("3", "c", "N", "SPX", 2), ("4", "c", "N", "RJ", 3), ("5", None, "N", "RJ", 4)]
    schema = "registro_ans string, cnpj string, razao_social string, uf string, reg_order int"
    path = tempfile.mkdtemp(prefix="ledger-test-")
    spark.createDataFrame(rows, schema).selectExpr("*", "CAST(NULL AS STRING) AS modalidade", "'x' AS cidade", "'2020-01-01' AS data_registro_ans").write.parquet(f"{path}/stg")
    stg = spark.read.parquet(f"{path}/stg")
    # what is written and counted doesn't scan the staging rows again
    assert f"{path}/stg" not in load_operators(stg).rows._jdf.queryExecution().executedPlan().toString()
    tables = VersionedTables(spark, f"{path}/db")
    load = tables.begin()
    _, found = load_operators_checked(load, stg, None)
    load.publish()
    got = {(a, b): n for a, b, n in found}
    assert got[("rows", "")] == 4 and got[("unique", "cnpj")] == 1
    assert {k: n for k, n in got.items() if n and k[0] in ("not_null", "width")} == {("not_null", "razao_social"): 1, ("not_null", "uf"): 1, ("width", "cnpj"): 1, ("width", "uf"): 1}
    written = tables.read("operadoras")
    assert {("not_null", r.column_name): r.n_null for r in K.null_violations(written, ["registro_ans", "cnpj", "razao_social", "uf"]).collect()}.items() <= got.items()
    # a key of the first load that comes again in the second
    later = spark.createDataFrame([("7", "a" * 14, "N", "SP", 0)], schema).selectExpr("*", "'m' AS modalidade", "'x' AS cidade", "'2020-01-01' AS data_registro_ans")
    load = tables.begin()
    _, found = load_operators_checked(load, later, tables.read("operadoras"))
    assert ("unique", "cnpj", 2) in found and ("rows", "", 1) in found
    load.publish()
    assert tables.read("operadoras_chaves").where("n > 1").count() == 2

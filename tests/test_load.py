from decimal import Decimal

from pyspark.sql import functions as F

from ledger_analytics.operators import checks
from ledger_analytics.operators.load import load_aggregates, load_expenses, load_operators, surrogate_key

STG = "reg_order long, registro_ans string, cnpj string, razao_social string, modalidade string, uf string, " \
      "cidade string, data_registro_ans string"


def test_surrogate_key_dense_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("k")).repartition(7)
    keyed = surrogate_key(df, "k", "sk").collect()
    pairs = sorted((r["k"], r["sk"]) for r in keyed)
    assert [p[1] for p in pairs] == list(range(1, 5001))


def _stg(spark):
    rows = [(1, "300001", "11222333000181", "A", "M", "SP", "C", "2001-02-03"),
            (2, "300001", "11222333000181", "A LTDA", "M", "SP", "C", "2001-02-03"),
            (3, "300002", "11222333000181", "B", "M", "RJ", "C", "03/02/2001"),
            (4, "300002", "11222333000181", "B", "M", "RJ", "C", "03/02/2001"),
            (5, "x", "1", "BAD", "M", "RJ", "C", None),
            (6, None, "2", "NULLID", "M", "RJ", "C", None),
            (7, "300003", "123456789012345", "C", "M", None, "C", "2001-02-30")]
    return spark.createDataFrame(rows, STG)


def test_load_operators_rules(spark):
    res = load_operators(_stg(spark))
    rows = {r["registro_ans"]: r for r in res.rows.collect()}
    assert sorted(rows) == [300001, 300002, 300003]
    assert rows[300001]["razao_social"] == "A"  # first in file order wins the conflict
    assert [rows[k]["cod_operadora"] for k in sorted(rows)] == [1, 2, 3]
    assert rows[300002]["data_registro_ans"] is None and rows[300003]["data_registro_ans"] is None
    assert sorted(r["reject_reason"] for r in res.rejects.collect()) == ["bad_registro_ans", "null_key"]
    again = load_operators(_stg(spark), existing=res.rows)
    assert again.rows.count() == 0  # insert-if-absent: a re-run adds nothing
    dups = checks.duplicate_keys(res.rows, ["cnpj"]).collect()
    assert [(r["cnpj"], r["n_rows"]) for r in dups] == [("11222333000181", 2)]
    nulls = {r["column_name"]: r["n_null"] for r in checks.null_violations(res.rows, ["uf", "cnpj"]).collect()}
    assert nulls == {"uf": 1, "cnpj": 0}
    widths = {r["column_name"]: r["n_violations"] for r in checks.length_violations(res.rows, {"cnpj": 14}).collect()}
    assert widths == {"cnpj": 1}


def test_load_expenses_and_aggregates(spark):
    ops = load_operators(_stg(spark)).rows
    stg = spark.createDataFrame(
        [("300001", "2025", "1", "10.50"), ("300001", "2025", "2", "-1.00"), ("300001", "2025", "3", "1,5"),
         ("300001", "", "4", "2.00"), ("300002", "2025", "1", "1.2.3"), ("999999", "2025", "1", "5.00")],
        "registro_ans string, ano string, trimestre string, valor_despesas string")
    res = load_expenses(stg, ops)
    assert [(r["cod_operadora"], r["valor_despesa"]) for r in res.rows.collect()] == [(1, Decimal("10.50"))]
    assert res.rejects.count() == 4
    orphans = checks.orphan_rows(stg, ops, F.col("registro_ans").try_cast("int"), "registro_ans")
    assert [r["registro_ans"] for r in orphans.collect()] == ["999999"]
    agg = spark.createDataFrame([("A", "SP", "10.005", "3.3333", "0.125"), (None, "RJ", "1", "1", "1")],
                                "razao_social string, uf string, total_despesas string, media_trimestral string, "
                                "desvio_padrao_despesas string")
    out = load_aggregates(agg).rows.collect()
    assert [tuple(r) for r in out] == [("A", "SP", Decimal("10.01"), Decimal("3.33"), Decimal("0.13"))]

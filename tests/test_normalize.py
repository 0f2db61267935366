from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledger_analytics import standins as S
from ledger_analytics.operators.normalize import (
    canonical_name, harmonize_columns, leaf_accounts, normalize_accounts, normalize_headers,
)

from .conftest import SF_SMALL

W1_ROWS = [  # FIXTURES 2.1: file, reg, code, tie value, keep
    ("A", 1, "411", 1, False), ("A", 1, "4111", 1, False), ("A", 1, "41111", 1, True),
    ("A", 1, "41112", 1, True), ("A", 1, "4112", 1, True), ("A", 2, "411", 1, False),
    ("A", 2, "4111", 1, True), ("A", 3, "411", 1, False), ("A", 3, "411", 2, True),
    ("A", None, "4111", 1, False),
]


def test_leaf_fixture(spark):
    df = spark.createDataFrame([r[:4] for r in W1_ROWS],
                               "source_file string, REGISTRO_OPERADORA int, CODIGO_CONTABIL string, DATA_BASE int")
    df = df.withColumn("V_INICIAL", F.lit(0)).withColumn("V_FINAL", F.lit(0))
    got = sorted(tuple(r) for r in leaf_accounts(df).select("REGISTRO_OPERADORA", "CODIGO_CONTABIL", "DATA_BASE").collect())
    want = sorted((r[1], r[2], r[3]) for r in W1_ROWS if r[4])
    assert got == want
    ties = leaf_accounts(df, keep_ties=True).filter("REGISTRO_OPERADORA = 3").count()
    assert ties == 2


def test_leaf_property_on_tables(spark):
    raw = S.raw_accounts(spark, SF_SMALL)
    leaves = leaf_accounts(raw).select("source_file", "REGISTRO_OPERADORA", "CODIGO_CONTABIL").collect()
    codes = {}
    for f, r, c in leaves:
        codes.setdefault((f, r), set()).add(c)
    for group in codes.values():
        for c in group:
            assert not any(o != c and o.startswith(c) for o in group)
    # every leaf of the input survives: leaves = codes with no extension in the full group
    allc = {}
    for f, r, c in raw.select("source_file", "REGISTRO_OPERADORA", "CODIGO_CONTABIL").collect():
        allc.setdefault((f, r), set()).add(c)
    expected = sum(1 for g in allc.values() for c in g if not any(o != c and o.startswith(c) for o in g))
    assert expected == len(leaves)


def test_header_rules(spark):
    assert canonical_name("DT_COMPETENCIA") == "DATA_BASE"
    assert canonical_name("REG_ANS") == "REGISTRO_OPERADORA"
    assert canonical_name("CD_CONTA_CONTABIL") == "CODIGO_CONTABIL"
    assert canonical_name("VL_SALDO_INICIAL") == "V_INICIAL"
    assert canonical_name("VL_SALDO_FINAL") == "V_FINAL"
    assert canonical_name("OUTRA") is None
    df = spark.createDataFrame([("a", "b", "c")], "` reg_ans ` string, `\"X\"` string, x string")
    n = normalize_headers(df)
    assert n.columns == ["REG_ANS", "X"]
    assert n.first()["X"] == "b"
    with pytest.raises(ValueError):
        harmonize_columns(spark.createDataFrame([("1", "2")], "REG_ANS string, NUM_ANS string"))


def test_normalize_text_lines(spark):
    rows = [
        ("q1.csv", "2025-01-31", "10", "411", "root", "0,00", "9,00"),
        ("q1.csv", "2025-01-31", "10", " 4111", "leaf", "1.000,00", "1.500,50"),
        ("q1.csv", "2025-01-31", "10", "4112", "zero", "5,00", "5,00"),
        ("q1.csv", "2025-01-31", "11", "4111", "junk", "x", "2,00"),
        ("q1.csv", "2025-01-31", "12", "3111", "other", "0,00", "7,00"),
        ("q1.csv", "2025-01-31", None, "4111", "no operator", "0,00", "7,00"),
    ]
    df = spark.createDataFrame(rows, "source_file string, DATA string, REG_ANS string, CD_CONTA_CONTABIL string, "
                                     "DESCRICAO string, VL_SALDO_INICIAL string, VL_SALDO_FINAL string")
    out = {(r["REGISTRO_OPERADORA"], r["CODIGO_CONTABIL"]): r["VALOR_DESPESAS"]
           for r in normalize_accounts(df).collect()}
    assert out == {(10, "4111"): Decimal("500.50"), (11, "4111"): Decimal("2.00")}

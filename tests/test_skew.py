"""Hot keys: one operator (and one file) holding a third or more of all
rows.  Results must equal a brute-force computation, and the plans must
bound the per-key work before the shuffle."""

import random
from collections import defaultdict
from decimal import Decimal

from ledger_analytics.operators.consolidate import consolidate
from ledger_analytics.operators.normalize import leaf_accounts
from ledger_analytics.plans import analytics as A

FACT = "cod_operadora int, ano int, trimestre int, valor_despesa decimal(18,2)"


def _lines(n_hot=4000, n_other=4000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_hot + n_other):
        reg = 1 if i < n_hot else rnd.randint(2, 60)
        code = "411" + "".join(rnd.choice("12") for _ in range(rnd.randint(0, 4)))
        rows.append(("HOT.csv" if reg == 1 else f"f{reg % 3}.csv", reg, code, f"2025-0{rnd.randint(1, 9)}-01",
                     Decimal(0), Decimal(rnd.randint(1, 500)), Decimal(rnd.randint(1, 500))))
    return rows


def test_leaf_filter_on_hot_operator(spark):
    rows = _lines()
    df = spark.createDataFrame(rows, "source_file string, REGISTRO_OPERADORA int, CODIGO_CONTABIL string, "
                                     "DATA_BASE string, V_INICIAL decimal(18,2), V_FINAL decimal(18,2), "
                                     "VALOR_DESPESAS decimal(18,2)").repartition(8)
    got = sorted((r[0], r[1], r[2]) for r in leaf_accounts(df).select(
        "source_file", "REGISTRO_OPERADORA", "CODIGO_CONTABIL").collect())
    groups = defaultdict(set)
    for f, reg, code, *_ in rows:
        groups[(f, reg)].add(code)
    want = sorted((f, reg, c) for (f, reg), codes in groups.items() for c in codes
                  if not any(o != c and o.startswith(c) for o in codes))
    assert got == want
    plan = leaf_accounts(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_consolidation_with_hot_registration(spark):
    rows = _lines()
    norm = spark.createDataFrame(rows, "source_file string, REGISTRO_OPERADORA int, CODIGO_CONTABIL string, "
                                       "DATA_BASE string, V_INICIAL decimal(18,2), V_FINAL decimal(18,2), "
                                       "VALOR_DESPESAS decimal(18,2)")
    # the hot registration appears 50 times in the registry (fan-out x50)
    reg = [(i, "1", "11222333000181", f"HOT {i}", "M", "SP") for i in range(50)] + \
          [(100 + r, str(r), f"{r:014d}", f"OP {r}", "M", "RJ") for r in range(2, 61)]
    registry = spark.createDataFrame(reg, "reg_order long, REGISTRO_OPERADORA string, CNPJ string, "
                                          "RAZAO_SOCIAL string, MODALIDADE string, UF string")
    out = {(r["RegistroANS"], r["Ano"], r["Trimestre"]): (r["ValorDespesas"], r["RazaoSocial"])
           for r in consolidate(norm, registry).consolidated.collect()}
    net = defaultdict(Decimal)
    for f, r, code, date, vi, vf, v in rows:
        net[(r, 2025, (int(date[5:7]) - 1) // 3 + 1)] += v
    want = {k: (v * (50 if k[0] == 1 else 1), "HOT 0" if k[0] == 1 else f"OP {k[0]}")
            for k, v in net.items() if v * (50 if k[0] == 1 else 1) > 0}
    assert out == want


def test_top_growth_hot_operator(spark):
    """3,000 rows per period for one operator: the full self-join would form
    9 million pairs for it; the result must equal that brute force."""
    import numpy as np

    rnd = random.Random(5)
    fact = [(1, 2025, t, Decimal(rnd.randint(1, 10 ** 6)) / 100) for t in (1, 3) for _ in range(3000)]
    fact += [(c, 2025, t, Decimal(rnd.randint(1, 10 ** 6)) / 100) for c in range(2, 200) for t in (1, 3)]
    dim = spark.createDataFrame([(c, c, str(c), f"N{c}", "M", "SP") for c in range(1, 200)],
                                "cod_operadora int, registro_ans int, cnpj string, razao_social string, "
                                "modalidade string, uf string")
    facts = spark.createDataFrame(fact, FACT).repartition(8)
    got = [round(r["crescimento_percentual"], 6) for r in A.top_growth(facts, dim, 2025, 1, k=5).collect()]
    firsts, lasts = defaultdict(list), defaultdict(list)
    for c, _, t, v in fact:
        (firsts if t == 1 else lasts)[c].append(float(v))
    growth = []
    for c in firsts:
        a = np.array(firsts[c])[:, None]
        b = np.array(lasts[c])[None, :]
        growth.append(((b - a) / a * 100).ravel())
    want = np.sort(np.concatenate(growth))[::-1][:5]
    assert got == [round(float(x), 6) for x in want]

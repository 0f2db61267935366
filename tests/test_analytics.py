import itertools
import random
from decimal import Decimal

from ledger_analytics.plans import analytics as A

FACT = "cod_operadora int, ano int, trimestre int, valor_despesa decimal(18,2)"
DIM = "cod_operadora int, registro_ans int, cnpj string, razao_social string, modalidade string, uf string"


def _brute_growth(fact, dim, k):
    names = {d[0]: d[3] for d in dim}
    first = [(c, v) for c, a, t, v in fact if a == 2025 and t == 1 and v > 0]
    last = [(c, v) for c, a, t, v in fact if a == 2025 and t == 3]
    pairs = [(names[c], a, b, float((float(b) - float(a)) / float(a) * 100)) for (c, a), (c2, b)
             in itertools.product(first, last) if c == c2 and c in names]
    return sorted(round(p[3], 6) for p in pairs)[::-1][:k]


def test_top_growth_matches_all_pairs(spark):
    """The bounded candidate pairing equals the full self-join, also with
    repeated rows per period and negative last values."""
    rnd = random.Random(7)
    fact = []
    for c in range(1, 30):
        for t in (1, 3):
            for _ in range(rnd.randint(0, 9)):
                fact.append((c, 2025, t, Decimal(rnd.randint(-5000, 90000)) / 100))
    dim = [(c, 300000 + c, str(c), f"N{c % 7}", "M", "SP") for c in range(1, 28)]
    for k in (1, 5, 12):
        got = A.top_growth(spark.createDataFrame(fact, FACT), spark.createDataFrame(dim, DIM), 2025, 1, k=k)
        vals = [round(r["crescimento_percentual"], 6) for r in got.collect()]
        assert vals == _brute_growth(fact, dim, k)


def test_growth_golden():
    # FIXTURES 2.8 (published figures): ((b - a) / a) * 100, two decimals
    golden = [(1982.37, 38366.68, 1835.39), (190.40, 1740.03, 813.88), (649130.14, 5854085.25, 801.84),
              (11171044.96, 55763817.19, 399.18), (5965.44, 26125.52, 337.95)]
    for a, b, g in golden:
        assert round((b - a) / a * 100, 2) == g


def test_state_distribution_and_golden(spark):
    # FIXTURES 2.9: mean = total / operators
    for total, n, mean in [(73271916157.58, 242, 302776513.05), (52407497342.21, 63, 831865037.18)]:
        assert round(total / n, 2) == mean
    fact = [(1, 2025, 1, Decimal("10.00")), (1, 2025, 2, Decimal("5.00")), (2, 2025, 1, Decimal("1.00")),
            (3, 2025, 1, Decimal("4.00"))]
    dim = [(1, 1, "a", "A", "M", "SP"), (2, 2, "b", "B", "M", "SP"), (3, 3, "c", "C", "M", "RJ")]
    got = [tuple(r) for r in A.state_distribution(spark.createDataFrame(fact, FACT),
                                                  spark.createDataFrame(dim, DIM)).collect()]
    assert got == [("SP", Decimal("16.00"), 2, 8.0), ("RJ", Decimal("4.00"), 1, 4.0)]


def test_above_mean_orders_by_count_then_sum(spark):
    fact = [(1, 2025, q, Decimal("100.00")) for q in (1, 2, 3)] + \
           [(2, 2025, q, Decimal("90.00")) for q in (1, 2)] + [(2, 2025, 3, Decimal("1.00"))] + \
           [(3, 2025, q, Decimal("1.00")) for q in (1, 2, 3)] + [(4, 2025, q, Decimal("95.00")) for q in (1, 2, 3)]
    dim = [(c, c, str(c), f"N{c}", "M", "SP") for c in (1, 2, 3, 4)]
    got = [tuple(r) for r in A.above_mean_quarters(spark.createDataFrame(fact, FACT),
                                                   spark.createDataFrame(dim, DIM)).collect()]
    assert got == [("N1", 3, Decimal("300.00")), ("N4", 3, Decimal("285.00")), ("N2", 2, Decimal("180.00"))]


def test_pages_concatenate_and_keyset(spark):
    dim = [(c, c, f"{c:014d}", f"N{c}", "M", "SP") for c in range(1, 24)]
    ops = spark.createDataFrame(dim, DIM).repartition(5)
    seen = []
    for page in range(1, 4):
        rows = A.operators_page(ops, page, 10).collect()
        assert all(r["total"] == 23 for r in rows)
        seen += [r["cod_operadora"] for r in rows]
    assert seen == list(range(1, 24))
    keyset, last = [], None
    while True:
        rows = A.operators_after(ops, last, 7).collect()
        if not rows:
            break
        keyset += [r["cod_operadora"] for r in rows]
        last = rows[-1]["cod_operadora"]
    assert keyset == seen


def test_lookup_and_history(spark):
    dim = [(1, 1, "00000000000191", "A", "M", "SP"), (2, 2, "11222333000181", "B", "M", "RJ")]
    fact = [(1, 2024, 4, Decimal("1.00")), (1, 2025, 1, Decimal("2.00")), (1, 2025, 3, Decimal("3.00")),
            (2, 2025, 2, Decimal("9.00"))]
    ops, facts = spark.createDataFrame(dim, DIM), spark.createDataFrame(fact, FACT)
    assert A.operator_by_cnpj(ops, "00000000000000").count() == 0
    assert A.expense_history(facts, ops, "00000000000000").count() == 0
    hist = [(r["ano"], r["trimestre"]) for r in A.expense_history(facts, ops, "00000000000191").collect()]
    assert hist == [(2025, 3), (2025, 1), (2024, 4)]
    assert A.operator_by_cnpj(ops, "' OR '1'='1").count() == 0
    top = A.top_operators(facts, ops, k=1).collect()
    assert top[0]["RazaoSocial"] == "B"

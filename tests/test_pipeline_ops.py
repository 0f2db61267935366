from decimal import Decimal

from ledger_analytics.operators.aggregate import expense_report
from ledger_analytics.operators.consolidate import consolidate
from ledger_analytics.operators.validate import split_valid
from ledger_analytics.plans.analytics import operator_statistics

NORM = "source_file string, REGISTRO_OPERADORA int, DATA_BASE string, CODIGO_CONTABIL string, " \
       "DESCRICAO string, V_INICIAL decimal(18,2), V_FINAL decimal(18,2), VALOR_DESPESAS decimal(18,2)"
REG = "reg_order long, REGISTRO_OPERADORA string, CNPJ string, RAZAO_SOCIAL string, MODALIDADE string, UF string"


def _line(reg, value, date="2025-01-15", code="4111"):
    return ("f", reg, date, code, None, Decimal(0), Decimal(value), Decimal(value))


def test_consolidation_fixture(spark):
    # FIXTURES 2.6
    lines = [_line(1, "100.00"), _line(1, "-30.00"), _line(2, "50.00"), _line(2, "-50.00"),
             _line(3, "10.00"), _line(4, "10.00"), _line(5, "8.00"), _line(1, "7.00", date="2025-02-30")]
    reg = [(1, "1", "11222333000181", "ONE", "M", "SP"), (2, "2", "22", "TWO", "M", "RJ"),
           (4, "4", "44", "FOUR", "M", None), (5, "5", "55", None, "M", "MG"), (6, "5", "55", "FIVE B", "M", "MG"),
           (7, "5", "55", "FIVE C", "M", "MG")]
    n = spark.createDataFrame(lines, NORM)
    r = spark.createDataFrame(reg, REG)
    res = consolidate(n, r)
    got = {(x["RegistroANS"], x["RazaoSocial"]): x["ValorDespesas"] for x in res.consolidated.collect()}
    # operator 5 fans out over its three registry rows (8 * 3); first non-null name wins
    assert got == {(1, "ONE"): Decimal("70.00"), (5, "FIVE B"): Decimal("24.00")}
    assert res.invalid_dates.count() == 1
    kept = consolidate(n, r, on_unmatched="keep").consolidated
    assert kept.filter("RegistroANS = 3").count() == 1
    assert kept.filter("RegistroANS = 4").count() == 1


def test_validation_split(spark):
    rows = [("11.222.333/0001-81", "OK"), ("11222333000180", "BAD CNPJ"), ("11222333000181", "  "),
            (None, None)]
    df = spark.createDataFrame(rows, "CNPJ string, RazaoSocial string")
    valid, invalid = split_valid(df)
    assert [r["RazaoSocial"] for r in valid.collect()] == ["OK"]
    reasons = sorted(r["reject_reason"] for r in invalid.collect())
    assert reasons == ["blank_name", "blank_name;invalid_cnpj", "invalid_cnpj"]
    assert valid.count() + invalid.count() == df.count()


def test_aggregates_fixture(spark):
    # FIXTURES 2.7
    rows = [("A", "SP", Decimal("3.00")), ("B", "RJ", Decimal("1.00")), ("B", "RJ", Decimal("2.00")),
            ("B", "RJ", Decimal("3.00"))]
    df = spark.createDataFrame(rows, "RazaoSocial string, UF string, ValorDespesas decimal(18,2)")
    got = {r["RazaoSocial"]: (r["Total_Despesas"], r["Media_Trimestral"], r["Desvio_Padrao_Despesas"])
           for r in expense_report(df).collect()}
    assert got == {"A": (Decimal("3.00"), Decimal("3.00"), 0.0), "B": (Decimal("6.00"), Decimal("2.00"), 1.0)}
    fact = spark.createDataFrame([(1, 2025, 1, Decimal("3.00"))],
                                 "cod_operadora int, ano int, trimestre int, valor_despesa decimal(18,2)")
    dim = spark.createDataFrame([(1, "A", "SP")], "cod_operadora int, razao_social string, uf string")
    assert operator_statistics(fact, dim).first()["Desvio_Padrao_Despesas"] is None


def test_consolidation_conserves_the_total(spark):
    """Before the positive filter, the consolidated total equals the input
    total over lines with a date and a full registry match, each counted
    once per registry copy; with it, only groups > 0 remain."""
    import random
    from collections import Counter, defaultdict

    rnd = random.Random(11)
    lines = [_line(rnd.randint(1, 40), f"{rnd.randint(-5000, 9000) / 100:.2f}",
                   date=rnd.choice(["2025-01-15", "2025-05-02", "2025-09-30", "2025-02-30"]))
             for _ in range(3000)]
    reg = []
    for r in range(1, 36):
        for _ in range(rnd.choice([1, 1, 1, 2, 5])):
            reg.append((len(reg), str(r), f"{r:014d}", f"N{r}", "M", None if r % 17 == 0 else "SP"))
    n = spark.createDataFrame(lines, NORM)
    registry = spark.createDataFrame(reg, REG)
    copies = Counter(int(x[1]) for x in reg)
    keyed = {int(x[1]) for x in reg if x[5] is not None}
    want = sum(Decimal(l[7]) * copies[l[1]] for l in lines if l[2] != "2025-02-30" and l[1] in keyed)
    all_rows = consolidate(n, registry, positive_only=False).consolidated
    assert all_rows.agg({"ValorDespesas": "sum"}).first()[0] == want
    groups = defaultdict(Decimal)
    for l in lines:
        if l[2] != "2025-02-30" and l[1] in keyed:
            groups[(l[1], int(l[2][5:7]) // 4 + 1)] += Decimal(l[7]) * copies[l[1]]
    positive = consolidate(n, registry).consolidated
    assert positive.count() == sum(1 for v in groups.values() if v > 0)

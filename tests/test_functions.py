from decimal import Decimal

from pyspark.sql import functions as F

from ledger_analytics.functions import (
    cnpj_is_valid, file_stem, iso_date_or_null, numeric_text_guard, parse_date,
    parse_locale_decimal, resolve_url, round_half_up_ratio, text_to_decimal, text_to_int, url_file_name,
)


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_cnpj_cases(spark):
    # FIXTURES 2.2
    cases = [("11.222.333/0001-81", True), ("11222333000181", True), ("11222333000180", False),
             ("00000000000000", False), (None, False), ("191", True), ("112223330001812", False)]
    got = _one(spark, [(c,) for c, _ in cases], "c string", cnpj_is_valid("c"))
    assert got == [v for _, v in cases]


def test_stand_in_ids_follow_rule(spark):
    from ledger_analytics import standins as S
    from ledger_analytics.plans.registry import LOOKUP_CNPJ

    ops = S.operadoras(spark, "/root/testdata/sf0.001")
    rows = ops.select("cod_operadora", "cnpj", cnpj_is_valid("cnpj").alias("ok")).collect()
    assert all(r.ok == (r.cod_operadora % 4 != 0) for r in rows)
    assert {r.cnpj for r in rows if r.cod_operadora == 7} == {LOOKUP_CNPJ}
    # keys of a very large table keep unique 12-digit bases
    big = spark.range(1_262_780_000, 1_262_790_000).selectExpr("id AS c_custkey").selectExpr(f"{S.STAND_IN_CNPJ} AS cnpj")
    assert big.select(F.substring("cnpj", 1, 12)).distinct().count() == 10_000
    assert big.where("length(cnpj) <> 14").count() == 0


def test_locale_numbers(spark):
    # FIXTURES 2.3
    rows = [("1.234.567,89",), ("-10,00",), ("1.234,56",), ("x",), (None,)]
    got = _one(spark, rows, "v string", parse_locale_decimal("v"))
    assert got == [Decimal("1234567.89"), Decimal("-10.00"), Decimal("1234.56"), Decimal("0.00"), Decimal("0.00")]


def test_locale_numbers_beyond_the_type_are_no_zero(spark):
    rows = [("99.999.999.999.999.999,00",), ("-99.999.999.999.999.999,00",), ("\t1.234,5\u00a0",), ("9" * 50,), ("1e5",)]
    got = _one(spark, rows, "v string", parse_locale_decimal("v"))
    assert got == [None, None, Decimal("1234.50"), None, Decimal("100000.00")]


def test_dates_and_quarter(spark):
    # FIXTURES 2.4
    df = spark.createDataFrame([("2025-09-30",), ("2025-02-30",), ("01/04/2025",), (None,)], "d string")
    got = df.select(parse_date("d").alias("x")).select(F.col("x").cast("string"), F.quarter("x")).collect()
    assert [tuple(r) for r in got] == [("2025-09-30", 3), (None, None), (None, None), (None, None)]
    two = df.select(parse_date("d", ("yyyy-MM-dd", "dd/MM/yyyy")).cast("string")).collect()
    assert two[2][0] == "2025-04-01"


def test_staging_guards(spark):
    # FIXTURES 2.5 and P10-P12
    rows = [("1234.50",), ("-5.00",), ("1,5",), ("1.2.3",), (".",)]
    guard = _one(spark, rows, "v string", numeric_text_guard("v"))
    assert guard == [True, False, False, True, True]
    cast = _one(spark, rows, "v string", F.when(numeric_text_guard("v"), text_to_decimal("v")))
    assert cast == [Decimal("1234.50"), None, None, None, None]
    assert _one(spark, [("",), ("12",), ("x",)], "v string", text_to_int("v")) == [None, 12, None]
    assert _one(spark, [("2025-02-30",), ("2025-01-31",), ("31/01/2025",)], "v string",
                iso_date_or_null("v").cast("string")) == [None, "2025-01-31", None]
    assert _one(spark, [("1.005",), ("-1.005",)], "v string", text_to_decimal("v")) == [Decimal("1.01"), Decimal("-1.01")]


def test_half_up_ratio(spark):
    rows = [(Decimal("0.05"), 2), (Decimal("-0.05"), 2), (Decimal("10.00"), 3)]
    got = _one(spark, rows, "s decimal(18,2), n long", round_half_up_ratio("s", "n"))
    assert got == [Decimal("0.03"), Decimal("-0.03"), Decimal("3.33")]


def test_url_helpers(spark):
    base = "https://h.example.org/a/b/page.html?q=1#top"
    hrefs = ["http://x.org/f.zip", "//cdn.org/x", "/root.csv", "rel/f.txt", "?p=2", "#s", "",
             "../up.zip", "./here/../x/.", "/a/./b/../../c?q=1", "../../../../top", "..", "sub//f.csv"]
    got = _one(spark, [(base, h) for h in hrefs], "u string, h string", resolve_url("u", "h"))
    assert got == ["http://x.org/f.zip", "https://cdn.org/x", "https://h.example.org/root.csv",
                   "https://h.example.org/a/b/rel/f.txt", "https://h.example.org/a/b/page.html?p=2",
                   "https://h.example.org/a/b/page.html?q=1#s", "https://h.example.org/a/b/page.html?q=1",
                   "https://h.example.org/a/up.zip", "https://h.example.org/a/b/x/", "https://h.example.org/c?q=1",
                   "https://h.example.org/top", "https://h.example.org/a/", "https://h.example.org/a/b/sub/f.csv"]
    assert _one(spark, [("http://x/a/b.zip?x=1",)], "u string", url_file_name("u")) == ["b.zip"]
    assert _one(spark, [("dir/a.b.csv",)], "u string", file_stem("u")) == ["a"]

"""Stand-in tables: the driver's TPC-H-shaped tables re-cast as the logical
tables of the accounting pipeline (operators, expenses, account lines, the
operator registry, staging text and a folder tree of links).

Every stand-in is a pure DataFrame derivation of the given tables, so its
size grows with them.  The definitions mirror the SQL in ``FIXTURES.md`` §3
and are written as Spark SQL expressions (``selectExpr``): each column is
one expression parsed once by the JVM.  ``plans/oracle.py`` holds the same
definitions as DuckDB SQL.  Dirty values (bad dates, locale numbers, junk
text, duplicates, missing rows) are made by fixed rules over the keys, so
both engines derive identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.cnpj import WEIGHTS_FIRST, WEIGHTS_SECOND, check_digit_sql

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _locale(expr: str) -> str:
    """SQL rendering of a number as ``1.234,56``."""
    return f"translate(format_number({expr}, 2), ',.', '.,')"


# ------------------------------------------------------------- operadoras

# 14-digit id with right check digits, except every fourth key, where the
# first check digit is shifted by one (invalid id).  7919 and 10^12 have no common factor, so the
# base is unique for keys below 10^12.  The 12-digit base and
# the first digit are bound once each (single-element transform).
STAND_IN_CNPJ = (
    "transform(array(lpad(CAST((CAST(c_custkey AS BIGINT) * 7919 + 1000001) % 1000000000000 AS STRING), 12, '0')), b -> "
    f"transform(array({check_digit_sql('b', WEIGHTS_FIRST)}), d1 -> concat(b, "
    "CASE WHEN c_custkey % 4 = 0 THEN CAST((CAST(d1 AS INT) + 1) % 10 AS STRING) ELSE d1 END, "
    f"{check_digit_sql('concat(b, d1)', WEIGHTS_SECOND)}))[0])[0]"
)


def operadoras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator dimension: one row per customer; names repeat every 1,000 keys."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS BIGINT) AS cod_operadora",
        "CAST(c_custkey + 300000 AS BIGINT) AS registro_ans",
        f"{STAND_IN_CNPJ} AS cnpj",
        "concat('Operator ', CAST(c_custkey % 1000 AS STRING)) AS razao_social",
        "c_mktsegment AS modalidade",
        "lpad(CAST(c_nationkey AS STRING), 2, '0') AS uf",
    )


# --------------------------------------------------------------- despesas

def despesas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expense fact: one row per (operator, year, quarter) with orders in it."""
    return (table(spark, sf_dir, "orders")
            .selectExpr("CAST(o_custkey AS BIGINT) AS cod_operadora", "CAST(year(o_orderdate) AS INT) AS ano",
                        "CAST(quarter(o_orderdate) AS INT) AS trimestre",
                        # whole cents: exact, and summed as BIGINT
                        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS v")
            .groupBy("cod_operadora", "ano", "trimestre")
            .agg({"v": "sum"})
            .selectExpr("cod_operadora", "ano", "trimestre",
                        "CAST(CAST(`sum(v)` AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS valor_despesa"))


# ------------------------------------------------------------ raw_accounts

def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed account lines: three code levels under two roots (311, 411);
    orders with key divisible by 3 stop at level two, so some level-two
    codes are leaves."""
    root = "CASE WHEN o_orderkey % 5 = 0 THEN '311' ELSE '411' END"
    p = "substr(o_orderpriority, 1, 1)"
    lines = table(spark, sf_dir, "orders").selectExpr(
        "concat(CAST(year(o_orderdate) AS STRING), 'T', CAST(quarter(o_orderdate) AS STRING)) AS source_file",
        "CAST(o_custkey + 300000 AS BIGINT) AS REGISTRO_OPERADORA",
        f"explode(CASE WHEN o_orderkey % 3 <> 0 "
        f"THEN array({root}, concat({root}, {p}), concat({root}, {p}, CAST(o_orderkey % 4 AS STRING))) "
        f"ELSE array({root}, concat({root}, {p})) END) AS CODIGO_CONTABIL",
        "to_date(o_orderdate) AS dt",
        # amounts in whole cents: exact, and summed as BIGINT
        "CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) ELSE 0 END "
        "AS vi",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS v",
    )
    return (lines.groupBy("source_file", "REGISTRO_OPERADORA", "CODIGO_CONTABIL")
            .agg({"dt": "min", "vi": "sum", "v": "sum"})
            .selectExpr("source_file", "REGISTRO_OPERADORA", "CODIGO_CONTABIL", "`min(dt)` AS DATA_BASE",
                        "CAST(CAST(`sum(vi)` AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS V_INICIAL",
                        "CAST(CAST(`sum(v)` AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS V_FINAL"))


def account_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account lines as the quarterly files carry them: every value is
    text, numbers use the ``1.234,56`` locale, and headers are the file's
    own names.  Rules: a line dated on day 7 carries the impossible date
    ``<year>-02-30``; a line dated on day 13 has ``n/d`` as opening
    balance (parses to 0); operators with id divisible by 5 pad their
    codes with a leading blank."""
    return raw_accounts(spark, sf_dir).selectExpr(
        "source_file",
        "CASE WHEN dayofmonth(DATA_BASE) = 7 THEN concat(CAST(year(DATA_BASE) AS STRING), '-02-30') "
        "ELSE date_format(DATA_BASE, 'yyyy-MM-dd') END AS DATA",
        "CAST(REGISTRO_OPERADORA AS STRING) AS REG_ANS",
        "CASE WHEN REGISTRO_OPERADORA % 5 = 0 THEN concat(' ', CODIGO_CONTABIL) ELSE CODIGO_CONTABIL END "
        "AS CD_CONTA_CONTABIL",
        "concat('CONTA ', CODIGO_CONTABIL) AS DESCRICAO",
        f"CASE WHEN dayofmonth(DATA_BASE) = 13 THEN 'n/d' ELSE {_locale('V_INICIAL')} END AS VL_SALDO_INICIAL",
        f"{_locale('V_FINAL')} AS VL_SALDO_FINAL",
    )


def corrected_lines(normalized: DataFrame) -> DataFrame:
    """The normalised lines of all second quarters' files as they are sent
    again: operators with an id divisible by 3 are gone, those with remainder 1
    have the opposite amounts, the rest is the same."""
    return normalized.where("source_file LIKE '%T2' AND REGISTRO_OPERADORA % 3 <> 0").withColumn("VALOR_DESPESAS", F.expr(
        "CAST(CASE WHEN REGISTRO_OPERADORA % 3 = 1 THEN -VALOR_DESPESAS ELSE VALOR_DESPESAS END AS DECIMAL(18,2))"))


# ---------------------------------------------------------------- registry

def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator registry as read from its file (all text, upper-case names)
    plus ``reg_order``, the row's position in the file.  Every customer is
    in it; rules over the key ``k`` make the dirty cases:

    * ``k % 50 = 0``: registered under an id no account line uses
      (``2e12 + k``), so those lines find no registry row (D1);
    * ``k % 97 = 0``: no state; ``k % 9 = 0``: id written with punctuation;
      ``k % 11 = 0``: registration date as ``dd/MM/yyyy``; ``k % 250 = 7``:
      blank name;
    * ``k % 100 = 1``: a second row, another registration (``1e12 + k``)
      with the same tax id; ``k % 100 = 2``: a second row with the same
      registration and another name (J1 fan-out, first-name rule).
    """
    punct = ("concat(substr(x, 1, 2), '.', substr(x, 3, 3), '.', substr(x, 6, 3), '/', substr(x, 9, 4), '-', "
             "substr(x, 13, 2))")
    reg_date = "date_add(DATE'2000-01-01', CAST(c_custkey % 5000 AS INT))"
    copies = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_nationkey", "c_mktsegment",
        "explode(sequence(0, CASE WHEN c_custkey % 100 IN (1, 2) THEN 1 ELSE 0 END)) AS copy")
    return copies.selectExpr(
        "c_custkey * 2 + copy AS reg_order",
        "CAST(CASE WHEN copy = 1 AND c_custkey % 100 = 1 THEN c_custkey + 1000000000000 "
        "WHEN c_custkey % 50 = 0 THEN c_custkey + 2000000000000 ELSE c_custkey + 300000 END AS STRING) "
        "AS REGISTRO_OPERADORA",
        f"transform(array({STAND_IN_CNPJ}), x -> CASE WHEN c_custkey % 9 = 0 THEN {punct} ELSE x END)[0] AS CNPJ",
        "concat(CASE WHEN c_custkey % 250 = 7 THEN '  ' ELSE concat('Operator ', CAST(c_custkey % 1000 AS STRING)) "
        "END, CASE WHEN copy = 0 THEN '' WHEN c_custkey % 100 = 1 THEN ' FILIAL' ELSE ' LTDA' END) AS RAZAO_SOCIAL",
        "c_mktsegment AS MODALIDADE",
        "concat('City ', CAST(c_nationkey AS STRING)) AS CIDADE",
        "CASE WHEN c_custkey % 97 = 0 THEN CAST(NULL AS STRING) "
        "ELSE lpad(CAST(c_nationkey AS STRING), 2, '0') END AS UF",
        f"CASE WHEN c_custkey % 11 = 0 THEN date_format({reg_date}, 'dd/MM/yyyy') "
        f"ELSE date_format({reg_date}, 'yyyy-MM-dd') END AS DATA_REGISTRO_ANS",
    )


def staging_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stg_operadoras``: the registry file loaded by position into text
    columns with lower-case names (the columns the load uses)."""
    return registry(spark, sf_dir).selectExpr(
        "reg_order", "REGISTRO_OPERADORA AS registro_ans", "CNPJ AS cnpj", "RAZAO_SOCIAL AS razao_social",
        "MODALIDADE AS modalidade", "CIDADE AS cidade", "UF AS uf", "DATA_REGISTRO_ANS AS data_registro_ans")


def staging_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stg_ans``: consolidated expenses as text.  Rules over
    ``h = cod_operadora + ano + trimestre``: h % 17 = 0 negative amount,
    h % 19 = 0 decimal comma, h % 23 = 0 the text ``1.2.3``, h % 29 = 0
    blank year."""
    d = despesas(spark, sf_dir).selectExpr(
        "*", "cod_operadora + ano + trimestre AS h", "CAST(valor_despesa AS STRING) AS v")
    return d.join(operadoras(spark, sf_dir), "cod_operadora").selectExpr(
        "cnpj", "razao_social", "CAST(trimestre AS STRING) AS trimestre",
        "CASE WHEN h % 29 = 0 THEN '' ELSE CAST(ano AS STRING) END AS ano",
        "CASE WHEN h % 17 = 0 THEN concat('-', v) WHEN h % 19 = 0 THEN replace(v, '.', ',') "
        "WHEN h % 23 = 0 THEN '1.2.3' ELSE v END AS valor_despesas",
        "CAST(registro_ans AS STRING) AS registro_ans", "modalidade", "uf")


def staging_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stg_agregados``: per (name, state) text figures with more decimals
    than the target type (total, mean to 6 places, and the half range as the
    spread figure); names of state ``00`` are missing."""
    joined = despesas(spark, sf_dir).join(operadoras(spark, sf_dir), "cod_operadora").selectExpr(
        "razao_social", "uf", "valor_despesa AS s", "valor_despesa AS mx", "valor_despesa AS mn")
    g = joined.groupBy("razao_social", "uf").agg({"s": "sum", "mx": "max", "mn": "min", "*": "count"})
    return g.selectExpr(
        "CASE WHEN uf = '00' THEN CAST(NULL AS STRING) ELSE razao_social END AS razao_social", "uf",
        "CAST(`sum(s)` AS STRING) AS total_despesas",
        "CAST(CAST(`sum(s)` / CAST(`count(1)` AS DECIMAL(20,0)) AS DECIMAL(38,6)) AS STRING) AS media_trimestral",
        "CAST(CAST((`max(mx)` - `min(mn)`) / CAST(2 AS DECIMAL(1,0)) AS DECIMAL(38,6)) AS STRING) "
        "AS desvio_padrao_despesas")


def locale_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals written as locale text; orders with key divisible by 7
    carry the junk text ``R$ -`` (parses to 0)."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        f"CASE WHEN o_orderkey % 7 = 0 THEN 'R$ -' ELSE {_locale('CAST(o_totalprice AS DECIMAL(18,2))')} END "
        "AS valor_texto")


def locale_amounts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`locale_amounts` where orders with key divisible by 11 carry an
    amount of up to 30 digits and those with key divisible by 13 are padded
    with a tab and a no-break space."""
    return locale_amounts(spark, sf_dir).selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 7 <> 0 "
        "THEN concat(CAST(o_orderkey AS STRING), '.000.000.000.000.', valor_texto) "
        "WHEN o_orderkey % 13 = 0 THEN concat('\\t', valor_texto, decode(unhex('C2A0'), 'UTF-8')) ELSE valor_texto END AS valor_texto")


def customer_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines of a ``;`` delimited file, as a spreadsheet writes
    them: doubled quotes, delimiters and line breaks inside quotes, trailing
    backslashes."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "concat(CAST(c_custkey AS STRING), ';', CASE c_custkey % 4 "
        "WHEN 0 THEN concat('\"EMPRESA \"\"', c_mktsegment, '\"\" LTDA\"') "
        "WHEN 1 THEN concat('\"', c_mktsegment, ';', CAST(c_nationkey AS STRING), '\"') "
        "WHEN 2 THEN concat(c_mktsegment, chr(92)) "
        "ELSE concat('\"', c_mktsegment, chr(10), 'FILIAL\"') END, ';', CAST(c_nationkey AS STRING)) AS line")


def customer_csv_pieces(spark: SparkSession, sf_dir: str, size: int = 97, per_file: int = 500) -> DataFrame:
    """:func:`customer_csv_lines` as files of ``per_file`` keys each, their text
    cut every ``size`` characters, wherever that is: block ``b`` of a file
    begins at character ``b * size``; what a line adds to a block is a piece."""
    lines = customer_csv_lines(spark, sf_dir).selectExpr(
        "concat('file-', CAST(c_custkey DIV %d AS STRING)) AS path" % per_file, "c_custkey", "concat(line, chr(10)) AS t")
    placed = lines.selectExpr("path", "t", "sum(length(t)) OVER (PARTITION BY path ORDER BY c_custkey) - length(t) AS at")
    pieces = placed.selectExpr("path", "t", "at", f"explode(sequence(at DIV {size}, (at + length(t) - 1) DIV {size})) AS block")
    return pieces.selectExpr(
        "path", "CAST(block AS BIGINT) AS block", f"CAST(greatest(at, block * {size}) AS BIGINT) AS place",
        f"substr(t, CAST(greatest(at, block * {size}) - at + 1 AS INT), "
        f"CAST(least(at + length(t), (block + 1) * {size}) - greatest(at, block * {size}) AS INT)) AS value")


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with awkward links, one per customer: an empty href, a ``>``
    inside an attribute, a named entity and a link inside a comment."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS page_id", "concat('http://h/', CAST(c_nationkey AS STRING), '/index.html') AS url",
        "concat('<p><a href=\"\">none</a><a title=\"a>b\" href=\"k', CAST(c_custkey AS STRING), '.html\">x</a>"
        "<!-- <a href=\"hidden.html\">no</a> --><a class=c href=\\'a&eacute;', CAST(c_custkey % 7 AS STRING), "
        "'.csv\\'>y</a><A HREF=z.zip?a=1&amp;b=', c_mktsegment, '>z</A></p>') AS html")


def stateful_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, one per customer, whose links can only be told by a reader that
    knows where it is: ``<a>`` in a script, a style, a text area, a title, a
    comment and an attribute, stray end tags and quotes, a second ``href``,
    and for odd keys a tag at the end whose quote is never closed."""
    k = "CAST(c_custkey AS STRING)"
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS page_id", "concat('http://h/', CAST(c_nationkey AS STRING), '/') AS url",
        "concat('<title><a href=no1></title><SCRIPT type=\"x\">var s = \"<a href=\\'no2\\'>\"; // </scripts> <!--</SCRIPT >"
        "<style>a:after{content:\"<a href=no3>\\'\"}</style><textarea rows=3><a href=\"no4.html\"></textarea>"
        "<!-- > <a href=\"no5\"> --><p title=\\'<a href=\"no6\">\\'>t</p></script>"
        f"<a data-href=\"no7\" it\\'s href=\"y', {k}, '.html\">y</a>\n<A\tHREF = \\'z.csv\\' href=\"no8\">z</A>"
        f"<a href=u', {k}, '/q\\'uote>u</a><abbr href=no9><a/href=\"c_', c_mktsegment, '\"/>', "
        "CASE WHEN c_custkey % 2 = 1 THEN '<a title=\"open href=\\'no10\\'><a href=no11>' ELSE '<a href=\"last\">' END) AS html")


def deep_links(spark: SparkSession, sf_dir: str, per_chain: int = 50) -> DataFrame:
    """Chains of folders, one per ``per_chain`` customer keys, 100 to 199 levels
    deep.  Their customers' files are at the end; on the way every folder has
    a second one without links, which the walk meets first."""
    customer = table(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS BIGINT) AS k", f"CAST(c_custkey DIV {per_chain} AS BIGINT) AS j")
    path = "concat('/c', CAST(j AS STRING), '/', repeat('d/', i))"
    pages = customer.select("j").distinct().selectExpr("j", "explode(sequence(0, CAST(99 + j % 100 AS INT))) AS i")
    down = pages.selectExpr("CASE WHEN i = 0 THEN '/' ELSE concat('/c', CAST(j AS STRING), '/', repeat('d/', i - 1)) END AS page",
                            "CASE WHEN i = 0 THEN j ELSE 0L END AS pos", "CASE WHEN i = 0 THEN concat('c', CAST(j AS STRING), '/') ELSE 'd/' END AS href",
                            f"{path} AS target")
    blind = pages.selectExpr(f"{path} AS page", "1L AS pos", "'e/' AS href", f"concat({path}, 'e/') AS target")
    files = customer.selectExpr("*", "CAST(99 + j % 100 AS INT) AS i").selectExpr(
        f"{path} AS page", "k + 2 AS pos", "concat('f', CAST(k AS STRING), '.zip') AS href", f"concat({path}, 'f', CAST(k AS STRING), '.zip') AS target")
    return down.unionByName(blind).unionByName(files)


# ------------------------------------------------------------------- links

def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder tree of links: root -> region folders -> nation folders ->
    one file per customer with extension .ZIP/.csv/.pdf/.html by key."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    lvl1 = region.selectExpr("'/' AS page", "CAST(r_regionkey AS BIGINT) AS pos", "concat(r_name, '/') AS href",
                             "concat('/', r_name, '/') AS target")
    rn = nation.join(region, nation.n_regionkey == region.r_regionkey)
    lvl2 = rn.selectExpr("concat('/', r_name, '/') AS page", "CAST(n_nationkey AS BIGINT) AS pos",
                         "concat(n_name, '/') AS href", "concat('/', r_name, '/', n_name, '/') AS target")
    fname = ("concat('f', CAST(c_custkey AS STRING), CASE c_custkey % 4 WHEN 0 THEN '.ZIP' WHEN 1 THEN '.csv' "
             "WHEN 2 THEN '.pdf' ELSE '.html' END)")
    crn = customer.join(rn.select("n_nationkey", "n_name", "r_name"), customer.c_nationkey == rn.n_nationkey)
    lvl3 = crn.selectExpr("concat('/', r_name, '/', n_name, '/') AS page", "CAST(c_custkey AS BIGINT) AS pos",
                          f"{fname} AS href", f"concat('/', r_name, '/', n_name, '/', {fname}) AS target")
    return lvl1.unionByName(lvl2).unionByName(lvl3)

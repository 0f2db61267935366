"""DuckDB SQL for every registered query: the correctness oracle.

The stand-in tables are written again as SQL common table expressions
(from ``FIXTURES.md`` §3 and the rules in :mod:`ledger_analytics.standins`),
and each query is written the direct way the source SQL does it (row-level
self-joins, ``NOT EXISTS``, recursive CTE) rather than the way the Spark
plan does it, so the two are independent.  Measures are compared as DOUBLE,
dates as ISO text.
"""

from __future__ import annotations

from html.entities import name2codepoint

from ..functions.cnpj import WEIGHTS_FIRST, WEIGHTS_SECOND
from .registry import (AFTER_KEY, GROWTH_PERIOD, LINK_NEEDLE, LOOKUP_CNPJ, NOT_NULL_COLUMNS, PAGE, PAGE_SIZE,
                       PAST_PAGE, WALK_FILES, WIDTH_LIMITS)


def _terms(col: str, weights, extra: str = "") -> str:
    s = "+".join(f"CAST(substr({col},{i + 1},1) AS INT)*{w}" for i, w in enumerate(weights))
    return f"({s}{extra})"


def _q(s: str) -> str:
    return s.replace("'", "''")


def _half_up_cents(cents: str, den: str) -> str:
    """Integer half-away-from-zero of cents/den."""
    return (f"(CASE WHEN {cents} >= 0 THEN (2*{cents} + {den}) // (2*{den}) "
            f"ELSE -((-2*{cents} + {den}) // (2*{den})) END)")


_W2_12 = WEIGHTS_SECOND[:12]


def _entities(x: str) -> str:
    """DuckDB: decode numeric and named entities, each once."""
    def char(cp):
        return f"CASE WHEN {cp} BETWEEN 1 AND 55295 OR {cp} BETWEEN 57344 AND 1114111 THEN chr({cp}) END"
    names = ", ".join(f"'{n}': {cp}" for n, cp in sorted({**name2codepoint, "apos": 39}.items()))
    kinds = (("^#([0-9]{1,7});(.*)$", "TRY_CAST(regexp_extract(p, '@', 1, 's') AS INTEGER)"),
             ("^#[xX]([0-9a-fA-F]{1,6});(.*)$", "TRY_CAST(('0x' || regexp_extract(p, '@', 1, 's')) AS INTEGER)"),
             ("^([A-Za-z][A-Za-z0-9]*);(.*)$", "(MAP {" + names + "})[regexp_extract(p, '@', 1, 's')]"))
    decoded = ", ".join(f"CASE WHEN regexp_matches(p, '{pat}', 's') THEN {char(cp.replace('@', pat))} || "
                        f"regexp_extract(p, '{pat}', 2, 's') END" for pat, cp in kinds)
    parts = f"string_split({x}, '&')"
    return f"({parts}[1] || array_to_string(list_transform({parts}[2:], lambda p: coalesce({decoded}, '&' || p)), ''))"


def _dot_free(path: str) -> str:
    """DuckDB: drop '.' and '..' segments of an absolute path."""
    segs = f"string_split({path}, '/')"
    stack = (f"list_reduce(list_filter({segs}[2:], lambda x, i: x <> '' OR i = len({segs}) - 1), "
             "lambda acc, x: CASE WHEN x = '..' THEN acc[:-2] WHEN x = '.' THEN acc ELSE list_append(acc, x) END, "
             "CAST([] AS VARCHAR[]))")
    return (f"('/' || array_to_string(CASE WHEN {segs}[-1] IN ('.', '..') THEN list_append({stack}, '') "
            f"ELSE {stack} END, '/'))")

# name -> (body, dependencies); bodies may only use earlier names.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "op_b": ("SELECT c_custkey, c_mktsegment, c_nationkey, "
             "lpad(CAST((c_custkey::BIGINT*7919+1000001) % 1000000000000 AS VARCHAR),12,'0') AS base FROM customer", ()),
    "op_d": (f"SELECT *, {_terms('base', WEIGHTS_FIRST)}%11 AS r1 FROM op_b", ("op_b",)),
    "op_e": ("SELECT *, CASE WHEN r1<2 THEN 0 ELSE 11-r1 END AS d1 FROM op_d", ("op_d",)),
    "op_g": (f"SELECT *, {_terms('base', _W2_12, '+d1*2')}%11 AS r2 FROM op_e", ("op_e",)),
    "op_h": ("SELECT *, CASE WHEN r2<2 THEN 0 ELSE 11-r2 END AS d2 FROM op_g", ("op_g",)),
    "operadoras": (
        "SELECT CAST(c_custkey AS BIGINT) AS cod_operadora, CAST(300000+c_custkey AS BIGINT) AS registro_ans, "
        "concat(base, CAST(CASE WHEN c_custkey%4=0 THEN (d1+1)%10 ELSE d1 END AS VARCHAR), CAST(d2 AS VARCHAR)) AS cnpj, "
        "concat('Operator ', CAST(c_custkey%1000 AS VARCHAR)) AS razao_social, c_mktsegment AS modalidade, "
        "lpad(CAST(c_nationkey AS VARCHAR),2,'0') AS uf FROM op_h", ("op_h",)),
    "despesas": (
        "SELECT CAST(o_custkey AS BIGINT) AS cod_operadora, CAST(year(o_orderdate) AS INT) AS ano, "
        "CAST(quarter(o_orderdate) AS INT) AS trimestre, "
        "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS valor_despesa FROM orders GROUP BY 1,2,3", ()),
    "ra_o": (
        "SELECT CAST(300000+o_custkey AS BIGINT) AS reg, CAST(o_orderdate AS DATE) AS dt, "
        "concat(CAST(year(o_orderdate) AS VARCHAR),'T',CAST(quarter(o_orderdate) AS VARCHAR)) AS f, "
        "substr(o_orderpriority,1,1) AS p, o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS v, "
        "CASE WHEN o_orderkey%5=0 THEN '311' ELSE '411' END AS root FROM orders", ()),
    "ra_l": (
        "SELECT f,reg,root AS code,v,k,dt FROM ra_o UNION ALL SELECT f,reg,concat(root,p),v,k,dt FROM ra_o "
        "UNION ALL SELECT f,reg,concat(root,p,CAST(k%4 AS VARCHAR)),v,k,dt FROM ra_o WHERE k%3<>0", ("ra_o",)),
    "raw_accounts": (
        "SELECT f AS source_file, reg AS REGISTRO_OPERADORA, code AS CODIGO_CONTABIL, MIN(dt) AS DATA_BASE, "
        "CAST(SUM(CASE WHEN k%2=0 THEN v ELSE 0 END) AS DECIMAL(18,2)) AS V_INICIAL, "
        "CAST(SUM(v) AS DECIMAL(18,2)) AS V_FINAL FROM ra_l GROUP BY f,reg,code", ("ra_l",)),
    "n_f": ("SELECT * FROM raw_accounts WHERE CODIGO_CONTABIL LIKE '411%'", ("raw_accounts",)),
    "n_leaf": (
        "SELECT * FROM n_f a WHERE NOT EXISTS (SELECT 1 FROM n_f b WHERE b.source_file=a.source_file "
        "AND b.REGISTRO_OPERADORA=a.REGISTRO_OPERADORA AND b.CODIGO_CONTABIL<>a.CODIGO_CONTABIL "
        "AND starts_with(b.CODIGO_CONTABIL, a.CODIGO_CONTABIL))", ("n_f",)),
    "n_text": (
        "SELECT source_file, REGISTRO_OPERADORA, "
        "CASE WHEN day(DATA_BASE)=7 THEN CAST(year(DATA_BASE) AS VARCHAR)||'-02-30' "
        "ELSE strftime(DATA_BASE,'%Y-%m-%d') END AS DATA_BASE, CODIGO_CONTABIL, "
        "'CONTA '||CODIGO_CONTABIL AS DESCRICAO, "
        "CASE WHEN day(DATA_BASE)=13 THEN CAST(0 AS DECIMAL(18,2)) ELSE V_INICIAL END AS V_INICIAL, V_FINAL "
        "FROM n_leaf", ("n_leaf",)),
    "normalized": (
        "SELECT *, CAST(V_FINAL - V_INICIAL AS DECIMAL(18,2)) AS VALOR_DESPESAS FROM n_text "
        "WHERE V_FINAL - V_INICIAL <> 0", ("n_text",)),
    "reg_copies": ("SELECT c_custkey, c_nationkey, c_mktsegment, o.cnpj, unnest(range(CASE WHEN c_custkey%100 IN (1,2) "
                   "THEN 2 ELSE 1 END)) AS copy FROM customer JOIN operadoras o ON o.cod_operadora = c_custkey",
                   ("operadoras",)),
    "registry": (
        "SELECT c_custkey*2 + copy AS reg_order, "
        "CAST(CASE WHEN copy=1 AND c_custkey%100=1 THEN c_custkey+1000000000000 "
        "WHEN c_custkey%50=0 THEN c_custkey+2000000000000 ELSE c_custkey+300000 END AS VARCHAR) AS REGISTRO_OPERADORA, "
        "CASE WHEN c_custkey%9=0 THEN substr(cnpj,1,2)||'.'||substr(cnpj,3,3)||'.'||substr(cnpj,6,3)||'/'"
        "||substr(cnpj,9,4)||'-'||substr(cnpj,13,2) ELSE cnpj END AS CNPJ, "
        "CASE WHEN c_custkey%250=7 THEN '  ' ELSE concat('Operator ', CAST(c_custkey%1000 AS VARCHAR)) END "
        "|| CASE WHEN copy=0 THEN '' WHEN c_custkey%100=1 THEN ' FILIAL' ELSE ' LTDA' END AS RAZAO_SOCIAL, "
        "c_mktsegment AS MODALIDADE, concat('City ', CAST(c_nationkey AS VARCHAR)) AS CIDADE, "
        "CASE WHEN c_custkey%97=0 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR),2,'0') END AS UF, "
        "CASE WHEN c_custkey%11=0 THEN strftime(DATE '2000-01-01' + CAST(c_custkey%5000 AS INTEGER), '%d/%m/%Y') "
        "ELSE strftime(DATE '2000-01-01' + CAST(c_custkey%5000 AS INTEGER), '%Y-%m-%d') END AS DATA_REGISTRO_ANS "
        "FROM reg_copies", ("reg_copies",)),
    "c_reg1": ("SELECT TRY_CAST(NULLIF(REGISTRO_OPERADORA,'') AS BIGINT) AS RegistroANS, CNPJ, RAZAO_SOCIAL, reg_order "
               "FROM registry", ("registry",)),
    "c_reg2": ("SELECT CNPJ, MODALIDADE, UF FROM (SELECT CNPJ, MODALIDADE, UF, row_number() OVER "
               "(PARTITION BY CNPJ ORDER BY reg_order) AS rn FROM registry) WHERE rn=1", ("registry",)),
    "c_dated": ("SELECT *, TRY_CAST(DATA_BASE AS DATE) AS dd, CAST(year(TRY_CAST(DATA_BASE AS DATE)) AS INT) AS Ano, "
                "CAST(quarter(TRY_CAST(DATA_BASE AS DATE)) AS INT) AS Trimestre FROM normalized", ("normalized",)),
    "c_joined": ("SELECT d.*, r.CNPJ, r.RAZAO_SOCIAL, r.reg_order, x.MODALIDADE, x.UF FROM c_dated d "
                 "LEFT JOIN c_reg1 r ON r.RegistroANS = d.REGISTRO_OPERADORA LEFT JOIN c_reg2 x ON x.CNPJ = r.CNPJ "
                 "WHERE d.dd IS NOT NULL", ("c_dated", "c_reg1", "c_reg2")),
    "consolidated": (
        "SELECT CNPJ, arg_min(RAZAO_SOCIAL, reg_order) FILTER (WHERE RAZAO_SOCIAL IS NOT NULL) AS RazaoSocial, "
        "Trimestre, Ano, CAST(SUM(VALOR_DESPESAS) AS DECIMAL(18,2)) AS ValorDespesas, "
        "REGISTRO_OPERADORA AS RegistroANS, MODALIDADE, UF FROM c_joined "
        "WHERE CNPJ IS NOT NULL AND MODALIDADE IS NOT NULL AND UF IS NOT NULL "
        "GROUP BY CNPJ, Ano, Trimestre, REGISTRO_OPERADORA, MODALIDADE, UF HAVING SUM(VALOR_DESPESAS) > 0",
        ("c_joined",)),
    "v_d": ("SELECT *, CASE WHEN length(regexp_replace(coalesce(CNPJ,''),'[^0-9]','','g'))>=14 "
            "THEN regexp_replace(coalesce(CNPJ,''),'[^0-9]','','g') "
            "ELSE lpad(regexp_replace(coalesce(CNPJ,''),'[^0-9]','','g'),14,'0') END AS dg FROM consolidated",
            ("consolidated",)),
    "v_ok": (
        "SELECT *, (length(dg)=14 AND dg <> repeat(substr(dg,1,1),14) "
        f"AND substr(dg,13,1)=CAST(CASE WHEN {_terms('dg', WEIGHTS_FIRST)}%11<2 THEN 0 "
        f"ELSE 11-{_terms('dg', WEIGHTS_FIRST)}%11 END AS VARCHAR) "
        f"AND substr(dg,14,1)=CAST(CASE WHEN {_terms('dg', WEIGHTS_SECOND)}%11<2 THEN 0 "
        f"ELSE 11-{_terms('dg', WEIGHTS_SECOND)}%11 END AS VARCHAR)) AS cnpj_ok, "
        "NOT (RazaoSocial IS NULL OR regexp_matches(RazaoSocial, '^\\s*$')) AS name_ok FROM v_d", ("v_d",)),
    "valid": ("SELECT * FROM v_ok WHERE cnpj_ok AND name_ok", ("v_ok",)),
    "stg_operadoras": (
        "SELECT reg_order, REGISTRO_OPERADORA AS registro_ans, CNPJ AS cnpj, RAZAO_SOCIAL AS razao_social, "
        "MODALIDADE AS modalidade, CIDADE AS cidade, UF AS uf, DATA_REGISTRO_ANS AS data_registro_ans FROM registry",
        ("registry",)),
    "lo_c": (
        "SELECT TRY_CAST(NULLIF(registro_ans,'') AS BIGINT) AS registro_ans, cnpj, razao_social, modalidade, uf, cidade, "
        "CASE WHEN regexp_matches(data_registro_ans, '^\\d{4}-\\d{2}-\\d{2}$') THEN TRY_CAST(data_registro_ans AS DATE) "
        "END AS data_registro_ans, reg_order FROM stg_operadoras WHERE registro_ans IS NOT NULL AND cnpj IS NOT NULL",
        ("stg_operadoras",)),
    "lo_d": ("SELECT registro_ans, cnpj, razao_social, modalidade, uf, cidade, data_registro_ans, MIN(reg_order) AS o "
             "FROM lo_c GROUP BY ALL", ("lo_c",)),
    "lo_f": ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY registro_ans ORDER BY o) AS rn FROM lo_d "
             "WHERE registro_ans IS NOT NULL) WHERE rn=1", ("lo_d",)),
    "loaded_operators": (
        "SELECT row_number() OVER (ORDER BY registro_ans) AS cod_operadora, registro_ans, cnpj, razao_social, "
        "modalidade, uf, cidade, data_registro_ans FROM lo_f", ("lo_f",)),
    "stg_ans": (
        "SELECT o.cnpj, o.razao_social, CAST(d.trimestre AS VARCHAR) AS trimestre, "
        "CASE WHEN d.h%29=0 THEN '' ELSE CAST(d.ano AS VARCHAR) END AS ano, "
        "CASE WHEN d.h%17=0 THEN '-'||d.v WHEN d.h%19=0 THEN replace(d.v,'.',',') WHEN d.h%23=0 THEN '1.2.3' "
        "ELSE d.v END AS valor_despesas, CAST(o.registro_ans AS VARCHAR) AS registro_ans, o.modalidade, o.uf "
        "FROM (SELECT *, cod_operadora+ano+trimestre AS h, CAST(valor_despesa AS VARCHAR) AS v FROM despesas) d "
        "JOIN operadoras o ON o.cod_operadora = d.cod_operadora", ("despesas", "operadoras")),
    "sa_g": ("SELECT razao_social, uf, SUM(valor_despesa) AS s, COUNT(valor_despesa) AS n, MAX(valor_despesa) AS mx, "
             "MIN(valor_despesa) AS mn FROM despesas d JOIN operadoras o ON o.cod_operadora=d.cod_operadora "
             "GROUP BY razao_social, uf", ("despesas", "operadoras")),
    # tags first, then the href of each: other patterns than the library's
    "pl_t": ("SELECT page_id, url, list_filter(list_transform(regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'), "
             "'(?i)<a\\s(?:\"[^\"]*\"|''[^'']*''|[^\"''>])*>'), "
             "lambda t: nullif(regexp_extract(t, '(?i)\\shref\\s*=\\s*(\"[^\"]*\"|''[^'']*''|[^\\s\"''>]+)', 1), '')), "
             "lambda h: h IS NOT NULL) AS hs FROM pages", ()),
    "pl_u": ("SELECT page_id, url, CAST(unnest(range(len(hs))) AS INTEGER) AS pos, "
             "trim(trim(unnest(hs), '\"''')) AS raw FROM pl_t", ("pl_t",)),
    "pl": (f"SELECT page_id, pos, {_entities('raw')} AS href, url FROM pl_u WHERE raw <> ''", ("pl_u",)),
    "pl_parts": (
        "SELECT *, regexp_extract(href, '^[^?#]*', 0) AS hpath, "
        "substr(href, length(regexp_extract(href, '^[^?#]*', 0)) + 1) AS hrest, "
        "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin, "
        "coalesce(nullif(regexp_replace(substr(regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', ''), "
        "length(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) + 1), '[^/]*$', ''), ''), '/') AS dir "
        "FROM pl", ("pl",)),
    "page_links": (
        "SELECT page_id, pos, href, CASE "
        "WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href "
        "WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || href "
        f"WHEN starts_with(href, '/') THEN origin || {_dot_free('hpath')} || hrest "
        "WHEN href = '' THEN regexp_replace(url, '#.*$', '') "
        "WHEN starts_with(href, '#') THEN regexp_replace(url, '#.*$', '') || href "
        "WHEN starts_with(href, '?') THEN regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', '') || href "
        f"ELSE origin || {_dot_free('dir || hpath')} || hrest END AS resolved FROM pl_parts", ("pl_parts",)),
    "links": (
        "SELECT '/' AS page, CAST(r_regionkey AS BIGINT) AS pos, concat(r_name,'/') AS href, concat('/',r_name,'/') AS target FROM region "
        "UNION ALL SELECT concat('/',r_name,'/'), CAST(n_nationkey AS BIGINT), concat(n_name,'/'), concat('/',r_name,'/',n_name,'/') "
        "FROM nation JOIN region ON n_regionkey=r_regionkey "
        "UNION ALL SELECT concat('/',r_name,'/',n_name,'/'), CAST(c_custkey AS BIGINT), "
        "concat('f',CAST(c_custkey AS VARCHAR),CASE c_custkey%4 WHEN 0 THEN '.ZIP' WHEN 1 THEN '.csv' WHEN 2 THEN '.pdf' ELSE '.html' END), "
        "concat('/',r_name,'/',n_name,'/f',CAST(c_custkey AS VARCHAR),CASE c_custkey%4 WHEN 0 THEN '.ZIP' WHEN 1 THEN '.csv' "
        "WHEN 2 THEN '.pdf' ELSE '.html' END) FROM customer JOIN nation ON c_nationkey=n_nationkey "
        "JOIN region ON n_regionkey=r_regionkey", ()),
}


def _closure(names) -> list[str]:
    need: set[str] = set()

    def visit(n):
        if n in need:
            return
        for dep in CTES[n][1]:
            visit(dep)
        need.add(n)

    for n in names:
        visit(n)
    return [n for n in CTES if n in need]


def with_ctes(final: str, *names: str, recursive: str | None = None) -> str:
    parts = [f"{n} AS ({CTES[n][0]})" for n in _closure(names)]
    if recursive:
        parts.append(recursive)
        return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + final
    return ("WITH " + ",\n".join(parts) + "\n" + final) if parts else final


_D = "CAST({} AS DOUBLE)".format
_FY, _FQ, _LQ, _K = (GROWTH_PERIOD["first_year"], GROWTH_PERIOD["first_quarter"],
                     GROWTH_PERIOD["last_quarter"], GROWTH_PERIOD["k"])


def oracle_sql() -> dict[str, str]:
    q = {}
    q["top_growth"] = with_ctes(
        f"SELECT n.razao_social, {_D('t.a')} AS valor_inicial, {_D('t.b')} AS valor_final, "
        f"({_D('t.b')} - {_D('t.a')}) / {_D('t.a')} * 100 AS crescimento_percentual FROM (SELECT cod_operadora, "
        f"sum(valor_despesa) FILTER (WHERE trimestre={_FQ}) AS a, sum(valor_despesa) FILTER (WHERE trimestre={_LQ}) AS b "
        f"FROM despesas WHERE ano={_FY} GROUP BY cod_operadora) t JOIN operadoras n USING (cod_operadora) "
        f"WHERE t.a > 0 AND t.b IS NOT NULL ORDER BY 4 DESC, cod_operadora LIMIT {_K}",
        "despesas", "operadoras")
    q["state_distribution"] = q["state_distribution_bucketed"] = with_ctes(
        f"SELECT uf, {_D('sum(total)')} AS despesa_total, count(*) AS total_operadoras, "
        f"{_D('sum(total)')} / count(*) AS media_por_operadora FROM (SELECT cod_operadora, sum(valor_despesa) AS total "
        "FROM despesas GROUP BY cod_operadora) JOIN operadoras USING (cod_operadora) GROUP BY uf "
        "ORDER BY sum(total) DESC, uf LIMIT 5", "despesas", "operadoras")
    over = ("(SELECT cod_operadora, ano, trimestre, valor_despesa, avg(valor_despesa) OVER (PARTITION BY ano, trimestre) AS usual "
            "FROM despesas)")
    q["above_mean_quarters"] = with_ctes(
        f"SELECT razao_social, count(*) AS trimestres_acima_da_media, {_D('sum(valor_despesa)')} "
        f"AS despesa_acumulada_nos_periodos FROM {over} JOIN operadoras USING (cod_operadora) WHERE valor_despesa > usual "
        "GROUP BY razao_social HAVING count(*) > 1", "despesas", "operadoras")
    q["above_mean_by_operator"] = with_ctes(
        "SELECT cod_operadora, any_value(razao_social) AS razao_social, count(DISTINCT ano * 10 + trimestre) "
        f"AS trimestres_acima_da_media, {_D('sum(valor_despesa)')} AS despesa_acumulada_nos_periodos FROM {over} "
        "JOIN operadoras USING (cod_operadora) WHERE valor_despesa > usual GROUP BY cod_operadora "
        "HAVING count(DISTINCT ano * 10 + trimestre) > 1", "despesas", "operadoras")
    # sums of values and of squared distances from each operator's mean, then one row per operator
    spread = ("(SELECT cod_operadora AS k, valor_despesa AS v, row_number() OVER w AS nth, count(*) OVER w AS n, sum(valor_despesa) OVER w AS s, "
              "CAST(valor_despesa AS DOUBLE) - CAST(sum(valor_despesa) OVER w AS DOUBLE) / count(*) OVER w AS off FROM despesas "
              "WINDOW w AS (PARTITION BY cod_operadora))")
    per_operator = (f"(SELECT k, max(n) AS n, max(s) AS s, CASE WHEN max(n) > 1 THEN round(sqrt(sum(off * off) / (max(n) - 1)), 2) END AS sd "
                    f"FROM {spread} GROUP BY k)")
    figures = (f"razao_social AS RazaoSocial, uf AS UF, {_D('s')} AS Total_Despesas, {_D('s')} / n AS Media_Trimestral, "
               f"sd AS Desvio_Padrao_Despesas FROM operadoras JOIN {per_operator} ON k = cod_operadora")
    q["operator_statistics"] = q["operator_statistics_incremental"] = with_ctes(f"SELECT {figures}", "despesas", "operadoras")
    q["top_operators"] = with_ctes(
        f"SELECT * EXCLUDE (place) FROM (SELECT row_number() OVER (ORDER BY s DESC, k) AS place, {figures}) WHERE place <= 5", "despesas", "operadoras")
    q["operators_page"] = with_ctes(
        "SELECT cod_operadora, registro_ans, cnpj, razao_social, modalidade, uf, "
        f"(SELECT COUNT(*) FROM operadoras) AS total, {PAGE} AS page, {PAGE_SIZE} AS \"limit\" "
        f"FROM operadoras ORDER BY cod_operadora LIMIT {PAGE_SIZE} OFFSET {(PAGE - 1) * PAGE_SIZE}", "operadoras")
    q["operators_page_past_end"] = with_ctes(
        "SELECT cod_operadora, registro_ans, cnpj, razao_social, modalidade, uf, 0::BIGINT AS total, 0 AS page, 0 AS \"limit\" "
        f"FROM operadoras WHERE false UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, count(*), {PAST_PAGE}, {PAGE_SIZE} "
        "FROM operadoras", "operadoras")
    deep = f"(SELECT count(*) * 9 // {10 * PAGE_SIZE} FROM operadoras)"
    q["operators_page_deep"] = with_ctes(
        f"SELECT * EXCLUDE (rn) REPLACE (CAST(page AS INTEGER) AS page) FROM (SELECT *, count(*) OVER () AS total, {deep} + 1 AS page, "
        f"{PAGE_SIZE} AS \"limit\", row_number() OVER (ORDER BY cod_operadora) - 1 AS rn FROM operadoras) "
        f"WHERE rn // {PAGE_SIZE} = page - 1", "operadoras")
    q["operators_after"] = with_ctes(
        f"SELECT * FROM operadoras WHERE cod_operadora > {AFTER_KEY} ORDER BY cod_operadora LIMIT {PAGE_SIZE}", "operadoras")
    q["operator_by_cnpj"] = with_ctes(f"SELECT * FROM operadoras WHERE cnpj = '{LOOKUP_CNPJ}'", "operadoras")
    q["operator_by_cnpj_clustered"] = q["operator_by_cnpj"]
    q["expense_history"] = q["expense_history_clustered"] = with_ctes(
        f"SELECT cod_operadora, ano, trimestre, {_D('valor_despesa')} AS valor_despesa FROM despesas "
        f"WHERE cod_operadora IN (SELECT cod_operadora FROM operadoras WHERE cnpj = '{LOOKUP_CNPJ}')", "despesas", "operadoras")
    q["leaf_accounts"] = with_ctes(
        "SELECT source_file, REGISTRO_OPERADORA, CODIGO_CONTABIL, strftime(DATA_BASE, '%Y-%m-%d') AS DATA_BASE, "
        f"{_D('V_INICIAL')} AS V_INICIAL, {_D('V_FINAL')} AS V_FINAL FROM raw_accounts a WHERE NOT EXISTS "
        "(SELECT 1 FROM raw_accounts b WHERE b.source_file=a.source_file AND b.REGISTRO_OPERADORA=a.REGISTRO_OPERADORA "
        "AND b.CODIGO_CONTABIL<>a.CODIGO_CONTABIL AND starts_with(b.CODIGO_CONTABIL, a.CODIGO_CONTABIL))",
        "raw_accounts")
    norm_cols = (f"source_file, REGISTRO_OPERADORA, DATA_BASE, CODIGO_CONTABIL, DESCRICAO, {_D('V_INICIAL')} AS V_INICIAL, "
                 f"{_D('V_FINAL')} AS V_FINAL, {_D('VALOR_DESPESAS')} AS VALOR_DESPESAS")
    q["normalized_accounts"] = with_ctes(f"SELECT {norm_cols} FROM normalized", "normalized")
    q["invalid_dates"] = with_ctes(
        "SELECT n.source_file, n.REGISTRO_OPERADORA AS RegistroANS, n.DATA_BASE, n.CODIGO_CONTABIL, n.DESCRICAO, "
        f"{_D('n.V_INICIAL')} AS V_INICIAL, {_D('n.V_FINAL')} AS V_FINAL, {_D('n.VALOR_DESPESAS')} AS VALOR_DESPESAS, "
        "r.CNPJ, r.RAZAO_SOCIAL, x.MODALIDADE, x.UF, 'invalid_date' AS reject_reason FROM normalized n "
        "LEFT JOIN c_reg1 r ON r.RegistroANS = n.REGISTRO_OPERADORA LEFT JOIN c_reg2 x ON x.CNPJ = r.CNPJ "
        "WHERE TRY_CAST(n.DATA_BASE AS DATE) IS NULL", "normalized", "c_reg1", "c_reg2")
    cons_cols = (f"CNPJ, RazaoSocial, Trimestre, Ano, {_D('ValorDespesas')} AS ValorDespesas, RegistroANS, "
                 "MODALIDADE, UF")
    q["consolidated_expenses"] = with_ctes(f"SELECT {cons_cols} FROM consolidated", "consolidated")
    q["consolidated_after_correction"] = with_ctes(
        "SELECT r.CNPJ, arg_min(r.RAZAO_SOCIAL, r.reg_order) FILTER (WHERE r.RAZAO_SOCIAL IS NOT NULL) AS RazaoSocial, d.Trimestre, d.Ano, "
        f"{_D('sum(CAST(v AS DECIMAL(18,2)))')} AS ValorDespesas, d.REGISTRO_OPERADORA AS RegistroANS, x.MODALIDADE, x.UF "
        "FROM (SELECT *, CASE WHEN ends_with(source_file, 'T2') AND REGISTRO_OPERADORA % 3 = 1 THEN -VALOR_DESPESAS ELSE VALOR_DESPESAS END AS v "
        "FROM c_dated WHERE NOT (ends_with(source_file, 'T2') AND REGISTRO_OPERADORA % 3 = 0) AND dd IS NOT NULL) d "
        "JOIN c_reg1 r ON r.RegistroANS = d.REGISTRO_OPERADORA JOIN c_reg2 x ON x.CNPJ = r.CNPJ "
        "WHERE x.MODALIDADE IS NOT NULL AND x.UF IS NOT NULL GROUP BY ALL HAVING sum(v) > 0", "c_dated", "c_reg1", "c_reg2")
    q["valid_rows"] = with_ctes(f"SELECT {cons_cols} FROM valid", "valid")
    q["invalid_rows"] = with_ctes(
        f"SELECT {cons_cols}, concat_ws(';', CASE WHEN NOT name_ok THEN 'blank_name' END, "
        "CASE WHEN NOT cnpj_ok THEN 'invalid_cnpj' END) AS reject_reason FROM v_ok WHERE NOT (cnpj_ok AND name_ok)",
        "v_ok")
    mean_cents = _half_up_cents("CAST(SUM(ValorDespesas)*100 AS HUGEINT)", "COUNT(*)")
    q["aggregated_expenses"] = q["aggregated_expenses_incremental"] = with_ctes(
        f"SELECT RazaoSocial, UF, {_D('SUM(ValorDespesas)')} AS Total_Despesas, "
        f"CAST({mean_cents} AS DOUBLE) / 100.0 AS Media_Trimestral, "
        "COALESCE(ROUND(STDDEV_SAMP(CAST(ValorDespesas AS DOUBLE)), 2), 0) AS Desvio_Padrao_Despesas "
        "FROM valid WHERE RazaoSocial IS NOT NULL AND UF IS NOT NULL GROUP BY RazaoSocial, UF", "valid")
    q["load_operators"] = with_ctes(
        "SELECT cod_operadora, registro_ans, cnpj, razao_social, modalidade, uf, cidade, "
        "CAST(data_registro_ans AS VARCHAR) AS data_registro_ans FROM loaded_operators", "loaded_operators")
    q["load_operators_incremental"] = with_ctes(
        "SELECT row_number() OVER (ORDER BY registro_ans % 2, registro_ans) AS cod_operadora, registro_ans, cnpj, razao_social, "
        "modalidade, uf, cidade, CAST(data_registro_ans AS VARCHAR) AS data_registro_ans FROM lo_f", "lo_f")
    # rows are tagged first; what stays untagged meets the operators
    reasons = ("CASE WHEN NOT regexp_full_match(valor_despesas, '[0-9.]+') OR TRY_CAST(valor_despesas AS DECIMAL(18,2)) IS NULL THEN 'amount' "
               "WHEN NOT regexp_full_match(ano, '[0-9]+') THEN 'year' WHEN NOT regexp_full_match(trimestre, '[0-9]+') THEN 'quarter' END")
    q["load_expenses"] = with_ctes(
        f"SELECT k.cod_operadora, CAST(t.ano AS INTEGER) AS ano, CAST(t.trimestre AS INTEGER) AS trimestre, "
        f"CAST(CAST(t.valor_despesas AS DECIMAL(18,2)) AS DOUBLE) AS valor_despesa FROM (SELECT *, {reasons} AS reason FROM stg_ans) t, "
        "(SELECT CAST(registro_ans AS VARCHAR) AS r, cod_operadora FROM loaded_operators) k WHERE t.reason IS NULL AND k.r = t.registro_ans",
        "stg_ans", "loaded_operators")
    q["load_aggregates"] = with_ctes(
        f"SELECT razao_social, uf, {_D('s')} AS valor_total, "
        f"CAST({_half_up_cents('CAST(s*100 AS HUGEINT)', 'n')} AS DOUBLE) / 100.0 AS media_trimestral, "
        f"CAST({_half_up_cents('CAST((mx-mn)*100 AS HUGEINT)', '2')} AS DOUBLE) / 100.0 AS desvio_padrao "
        "FROM sa_g WHERE uf <> '00'", "sa_g")
    q["load_aggregates_rejects"] = with_ctes(
        "SELECT CASE WHEN uf = '00' THEN NULL ELSE razao_social END AS razao_social, uf, CASE uf WHEN '00' THEN 'null_name' "
        "WHEN '03' THEN 'bad_total_despesas;bad_media_trimestral' ELSE 'bad_media_trimestral' END AS reject_reason "
        "FROM sa_g WHERE uf IN ('00', '03', '05')", "sa_g")
    q["unmatched_registry"] = with_ctes(
        f"SELECT REGISTRO_OPERADORA, COUNT(*) AS n_linhas, {_D('SUM(VALOR_DESPESAS)')} AS valor_total "
        "FROM normalized n WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE "
        "TRY_CAST(NULLIF(r.REGISTRO_OPERADORA,'') AS BIGINT) = n.REGISTRO_OPERADORA) GROUP BY REGISTRO_OPERADORA",
        "normalized", "registry")
    q["orphan_facts"] = with_ctes(
        "SELECT registro_ans, ano, trimestre, valor_despesas FROM stg_ans s WHERE NOT EXISTS "
        "(SELECT 1 FROM loaded_operators o WHERE o.registro_ans = TRY_CAST(s.registro_ans AS BIGINT))",
        "stg_ans", "loaded_operators")
    q["duplicate_keys"] = with_ctes(
        "SELECT cnpj, COUNT(*) AS n_rows FROM loaded_operators WHERE cnpj IS NOT NULL GROUP BY cnpj HAVING COUNT(*) > 1",
        "loaded_operators")
    q["null_violations"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM loaded_operators"
        for c in NOT_NULL_COLUMNS), "loaded_operators")
    q["length_violations"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE length({c}) > {n}) AS n_violations, {n} AS max_length "
        "FROM loaded_operators" for c, n in WIDTH_LIMITS.items()), "loaded_operators")
    # the second load has the rows whose id isn't divisible by 3; keys count over both
    second = "loaded_operators WHERE registro_ans % 3 <> 0"
    q["load_operators_checked"] = with_ctes(" UNION ALL ".join(
        [f"SELECT 'rows' AS rule, '' AS column_name, count(*) AS n FROM {second}",
         "SELECT 'unique', 'cnpj', count(*) FROM (SELECT cnpj FROM loaded_operators GROUP BY cnpj HAVING count(cnpj) > 1)"]
        + [f"SELECT 'not_null', '{c}', count(*) FROM {second} AND {c} IS NULL" for c in NOT_NULL_COLUMNS]
        + [f"SELECT 'width', '{c}', count(*) FROM {second} AND length({c}) > {n}" for c, n in WIDTH_LIMITS.items()]), "loaded_operators")
    q["locale_number_parse"] = (
        "SELECT o_orderkey, CAST(CASE WHEN o_orderkey%7=0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) "
        "AS valor FROM orders")
    q["locale_number_rejects"] = "SELECT o_orderkey FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 7 <> 0"
    parsed = ("CAST(c_custkey AS INTEGER) AS id, CASE c_custkey % 4 WHEN 0 THEN 'EMPRESA \"' || c_mktsegment || '\" LTDA' "
              "WHEN 1 THEN c_mktsegment || ';' || c_nationkey WHEN 2 THEN c_mktsegment || chr(92) "
              "ELSE c_mktsegment || chr(10) || 'FILIAL' END AS nome, CAST(c_nationkey AS INTEGER) AS nation FROM customer")
    q["delimited_text_parse"] = f"SELECT c_custkey, {parsed}"
    q["delimited_blocks_parse"] = (
        "SELECT 'file-' || (c_custkey // 500) AS path, c_custkey = min(c_custkey) OVER (PARTITION BY c_custkey // 500) AS first, "
        f"false AS broken, {parsed}")
    q["page_links_dirty"] = (
        "SELECT page_id, pos, href, 'http://h/' || c_nationkey || '/' || href AS resolved FROM (SELECT c_custkey AS page_id, c_nationkey, "
        "unnest([1, 2, 3]) AS pos, unnest(['k' || c_custkey || '.html', 'aé' || (c_custkey % 7) || '.csv', "
        "'z.zip?a=1&b=' || c_mktsegment]) AS href FROM customer)")
    q["page_links_states"] = (
        "SELECT page_id, pos, href, 'http://h/' || c_nationkey || '/' || href AS resolved FROM (SELECT c_custkey AS page_id, c_nationkey, "
        "unnest(range(5))::INTEGER AS pos, unnest(['y' || c_custkey || '.html', 'z.csv', 'u' || c_custkey || '/q''uote', "
        "'c_' || c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN 'last' END]) AS href FROM customer) WHERE href IS NOT NULL")
    q["latest_files_deep"] = q["latest_files_bounded"] = (
        "SELECT CAST(row_number() OVER (ORDER BY j DESC, c_custkey DESC) AS INTEGER) AS ordem, "
        "'/c' || j || '/' || repeat('d/', CAST(99 + j % 100 AS INTEGER)) || 'f' || c_custkey || '.zip' AS target, 'f' || c_custkey || '.zip' AS href "
        f"FROM (SELECT c_custkey, c_custkey // 50 AS j FROM customer) ORDER BY j DESC, c_custkey DESC LIMIT {2 * WALK_FILES}")
    q["dedup_first"] = with_ctes(
        "SELECT CNPJ, REGISTRO_OPERADORA, MODALIDADE, UF FROM (SELECT *, row_number() OVER "
        "(PARTITION BY CNPJ ORDER BY reg_order) AS rn FROM registry) WHERE rn = 1", "registry")
    q["page_links"] = with_ctes("SELECT page_id, pos, href, resolved FROM page_links", "page_links")
    q["first_matching_link"] = with_ctes(
        "SELECT page_id, pos, href, resolved FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn "
        f"FROM page_links WHERE contains(href, '{_q(LINK_NEEDLE)}')) WHERE rn = 1", "page_links")
    q["links_by_extension"] = with_ctes(
        "SELECT page, pos, href, target FROM links WHERE regexp_matches(lower(href), '\\.(zip|csv|xlsx|rar|txt|pdf)$')",
        "links")
    walk = ("walk(page, ord, depth) AS (SELECT '/' AS page, CAST([] AS BIGINT[]) AS ord, 0 AS depth "
            "UNION ALL SELECT l.target, list_append(w.ord, -l.pos), w.depth + 1 FROM walk w JOIN links l ON l.page = w.page "
            "WHERE (ends_with(l.href, '/') OR NOT contains(l.href, '.')) AND starts_with(l.target, w.page) "
            "AND length(l.target) > length(w.page)), "
            "files AS (SELECT l.target, l.href, list_append(w.ord, -l.pos) AS ord FROM walk w JOIN links l "
            "ON l.page = w.page WHERE NOT (ends_with(l.href, '/') OR NOT contains(l.href, '.')) "
            "AND regexp_matches(lower(l.href), '\\.(zip|csv|xlsx)$'))")
    q["latest_files"] = with_ctes(
        "SELECT CAST(row_number() OVER (ORDER BY ord) AS INTEGER) AS ordem, target, href FROM "
        f"(SELECT * FROM files ORDER BY ord LIMIT {WALK_FILES})", "links", recursive=walk)
    return q

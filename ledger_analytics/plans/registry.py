"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables through the stand-ins, runs the
library operator over the whole tables and converts the result at the edge
(DECIMAL -> DOUBLE, DATE -> ISO text) so it compares cell by cell with the
DuckDB oracle in :mod:`ledger_analytics.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import standins as S
from ..functions.text import parse_locale_decimal
from ..operators import checks, consolidate, corrections, dedup, links, load, moments, normalize, validate, walks
from ..operators.aggregate import expense_report
from ..session import ensure_checkpoint_dir, remove_folder
from ..sinks import layouts
from ..sinks.versions import VersionedTables
from ..sources.files import CSV_OPTIONS
from ..sources.records import cut_records
from . import analytics as A
from .batch import OPERATOR_NOT_NULL as NOT_NULL_COLUMNS
from .batch import OPERATOR_WIDTHS as WIDTH_LIMITS
from .batch import load_operators_checked

# Parameters of the registered queries (the reference hard-codes its own).
GROWTH_PERIOD = dict(first_year=1996, first_quarter=1, last_quarter=3, k=5)
# Fixed value: the tax id of customer 7 in the stand-ins.
LOOKUP_CNPJ = "00000105543438"
PAGE, PAGE_SIZE = 3, 10
PAST_PAGE = 100_000_000
AFTER_KEY = 25
LINK_NEEDLE = "/the"
WALK_FILES = 3


def to_edge(df: DataFrame) -> DataFrame:
    """DECIMAL -> DOUBLE and DATE -> 'yyyy-MM-dd' for comparison."""
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, T.DecimalType):
            exprs.append(f"CAST({q} AS DOUBLE) AS {q}")
        elif isinstance(f.dataType, T.DateType):
            exprs.append(f"date_format({q}, 'yyyy-MM-dd') AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)


# ------------------------------------------------------------ shared chains

def _normalized(spark, d):
    return normalize.normalize_accounts(S.account_file_rows(spark, d))


def _consolidation(spark, d):
    return consolidate.consolidate(_normalized(spark, d), S.registry(spark, d))


def _validated(spark, d):
    return validate.split_valid(_consolidation(spark, d).consolidated)


def _loaded_operators(spark, d):
    return load.load_operators(S.staging_operators(spark, d)).rows


def _operator_rows(spark, d):
    """The same operators without their key, for the checks."""
    return load.operator_rows(S.staging_operators(spark, d))


# ------------------------------------------------------------------ queries

def q_top_growth(spark, d):
    return A.top_growth(S.despesas(spark, d), S.operadoras(spark, d), **GROWTH_PERIOD)


def q_state_distribution(spark, d):
    return A.state_distribution(S.despesas(spark, d), S.operadoras(spark, d))


def q_above_mean_quarters(spark, d):
    return A.above_mean_quarters(S.despesas(spark, d), S.operadoras(spark, d))


def q_operator_statistics(spark, d):
    return A.operator_statistics(S.despesas(spark, d), S.operadoras(spark, d)).drop(A.KEY)


def q_top_operators(spark, d):
    return A.top_operators(S.despesas(spark, d), S.operadoras(spark, d))


def q_operators_page(spark, d):
    return A.operators_page(S.operadoras(spark, d), PAGE, PAGE_SIZE)


def q_operator_by_cnpj(spark, d):
    return A.operator_by_cnpj(S.operadoras(spark, d), LOOKUP_CNPJ)


def q_expense_history(spark, d):
    return A.expense_history(S.despesas(spark, d), S.operadoras(spark, d), LOOKUP_CNPJ)


def _scratch(spark):
    return f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"


def q_operator_by_cnpj_clustered(spark, d):
    folder = _scratch(spark)
    layouts.write_clustered(S.operadoras(spark, d), folder, "cnpj", blooms=["cnpj"])
    found = A.operator_by_cnpj_clustered(spark, folder, LOOKUP_CNPJ).checkpoint()
    remove_folder(spark, folder)
    return found


def q_expense_history_clustered(spark, d):
    folder = _scratch(spark)
    layouts.write_clustered(S.operadoras(spark, d), f"{folder}/operadoras", "cnpj", blooms=["cnpj"])
    layouts.write_clustered(S.despesas(spark, d), f"{folder}/despesas", A.KEY)
    found = A.expense_history_clustered(spark, f"{folder}/despesas", f"{folder}/operadoras", LOOKUP_CNPJ).checkpoint()
    remove_folder(spark, folder)
    return found


def q_state_distribution_bucketed(spark, d):
    """Fact and dimension stored in the same buckets; summed and joined as they lie."""
    folder, n = _scratch(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = {t: f"{t}_{uuid.uuid4().hex}" for t in ("despesas", "operadoras")}
    tables = {t: layouts.save_bucketed(getattr(S, t)(spark, d), name, A.KEY, n, f"{folder}/{t}") for t, name in names.items()}
    found = A.state_distribution(tables["despesas"], tables["operadoras"]).checkpoint()
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")
    remove_folder(spark, folder)
    return found


def q_leaf_accounts(spark, d):
    raw = S.raw_accounts(spark, d)
    return normalize.leaf_accounts(raw).select(
        "source_file", "REGISTRO_OPERADORA", "CODIGO_CONTABIL", "DATA_BASE", "V_INICIAL", "V_FINAL")


def q_normalized_accounts(spark, d):
    return _normalized(spark, d)


def q_consolidated_expenses(spark, d):
    return _consolidation(spark, d).consolidated


def q_invalid_dates(spark, d):
    return _consolidation(spark, d).invalid_dates


def q_valid_rows(spark, d):
    return _validated(spark, d)[0]


def q_invalid_rows(spark, d):
    return _validated(spark, d)[1]


def q_aggregated_expenses(spark, d):
    return expense_report(_validated(spark, d)[0])


def q_load_operators(spark, d):
    return _loaded_operators(spark, d)


def q_load_expenses(spark, d):
    return load.load_expenses(S.staging_expenses(spark, d), _loaded_operators(spark, d)).rows


def q_load_aggregates(spark, d):
    return load.load_aggregates(S.staging_aggregates(spark, d)).rows


def q_unmatched_registry(spark, d):
    return consolidate.unmatched_lines(_normalized(spark, d), S.registry(spark, d))


def q_orphan_facts(spark, d):
    stg = S.staging_expenses(spark, d)
    return checks.orphan_rows(stg, _operator_rows(spark, d), F.col("registro_ans").try_cast("bigint"),
                              "registro_ans").select("registro_ans", "ano", "trimestre", "valor_despesas")


def q_duplicate_keys(spark, d):
    return checks.duplicate_keys(_operator_rows(spark, d), ["cnpj"])


def q_null_violations(spark, d):
    return checks.null_violations(_operator_rows(spark, d), NOT_NULL_COLUMNS)


def q_length_violations(spark, d):
    return checks.length_violations(_operator_rows(spark, d), WIDTH_LIMITS)


def q_locale_number_parse(spark, d):
    t = S.locale_amounts(spark, d)
    return t.select("o_orderkey", parse_locale_decimal("valor_texto").alias("valor"))


def q_dedup_first(spark, d):
    r = S.registry(spark, d)
    return dedup.dedup_first(r, ["CNPJ"], ["reg_order"]).select("CNPJ", "REGISTRO_OPERADORA", "MODALIDADE", "UF")


def q_page_links(spark, d):
    return links.page_links(S.table(spark, d, "pages"))


def q_first_matching_link(spark, d):
    return links.first_matching_link(links.page_links(S.table(spark, d, "pages")), LINK_NEEDLE)


def q_links_by_extension(spark, d):
    return links.links_by_extension(S.links(spark, d))


def q_latest_files(spark, d):
    return links.latest_files(S.links(spark, d), n=WALK_FILES)


def q_above_mean_by_operator(spark, d):
    return A.above_mean_quarters(S.despesas(spark, d), S.operadoras(spark, d), by_key=True)


def q_operators_page_past_end(spark, d):
    return A.operators_page(S.operadoras(spark, d), PAST_PAGE, PAGE_SIZE)


def q_operators_page_deep(spark, d):
    """The page nine tenths into the table."""
    operators = S.operadoras(spark, d)
    return A.operators_page(operators, operators.count() * 9 // (10 * PAGE_SIZE) + 1, PAGE_SIZE)


def q_operators_after(spark, d):
    return A.operators_after(S.operadoras(spark, d), AFTER_KEY, PAGE_SIZE)


def q_latest_files_deep(spark, d):
    return links.latest_files(S.deep_links(spark, d), n=2 * WALK_FILES)


def q_latest_files_bounded(spark, d):
    """The same files by a walk that stops, over the links stored by page."""
    folder = _scratch(spark)
    found = walks.latest_files_bounded(walks.cluster_links(S.deep_links(spark, d), folder), n=2 * WALK_FILES)
    remove_folder(spark, folder)
    return found


def q_page_links_dirty(spark, d):
    return links.page_links(S.customer_pages(spark, d))


def q_page_links_states(spark, d):
    return links.page_links(S.stateful_pages(spark, d))


def q_locale_number_rejects(spark, d):
    """Orders whose amount is a number beyond the amount type."""
    t = S.locale_amounts_wide(spark, d).withColumn("valor", parse_locale_decimal("valor_texto"))
    return t.where("valor IS NULL").select("o_orderkey")


def q_load_operators_incremental(spark, d):
    """A second load over all staged rows, when the operators of even ids are there already."""
    stg = S.staging_operators(spark, d)
    first = load.load_operators(stg.where("try_cast(registro_ans AS BIGINT) % 2 = 0")).rows
    return first.unionByName(load.load_operators(stg, existing=first).rows)


def q_load_operators_checked(spark, d):
    """Two loads, published one after the other, and the rules of the second: its rows, and keys over both."""
    folder = _scratch(spark)
    stg, tables = S.staging_operators(spark, d), VersionedTables(spark, folder)
    for own in ("try_cast(registro_ans AS BIGINT) % 3 = 0", "true"):
        load_ = tables.begin()
        _, checks_ = load_operators_checked(load_, stg.where(own), tables.read("operadoras", load_.base))
        load_.publish()
    remove_folder(spark, folder)
    return spark.createDataFrame(checks_, "rule string, column_name string, n bigint")


def q_load_aggregates_rejects(spark, d):
    """Figures spoilt by fixed rules over the name's length and the state."""
    stg = S.staging_aggregates(spark, d).selectExpr(
        "razao_social", "uf", "CASE WHEN uf = '03' THEN replace(total_despesas, '.', ',') ELSE total_despesas END AS total_despesas",
        "CASE WHEN uf IN ('03', '05') THEN 'x' ELSE media_trimestral END AS media_trimestral", "desvio_padrao_despesas")
    return load.load_aggregates(stg).rejects.select("razao_social", "uf", "reject_reason")


def q_delimited_text_parse(spark, d):
    """Delimited lines parsed with the file readers' options."""
    lines = S.customer_csv_lines(spark, d)
    parsed = F.from_csv("line", "id INT, nome STRING, nation INT", {"sep": ";", **CSV_OPTIONS})
    return lines.select("c_custkey", parsed.alias("r")).select("c_custkey", "r.id", "r.nome", "r.nation")


def q_consolidated_after_correction(spark, d):
    """Consolidated rows after the second quarters' files were sent again: from the stored nets and rows."""
    ensure_checkpoint_dir(spark)
    lines, registry = _normalized(spark, d).checkpoint(), S.registry(spark, d)
    nets = consolidate.net_lines(consolidate.split_dates(lines)[0]).checkpoint()
    rows = consolidate.attach_registry(nets, registry).checkpoint()
    changes = corrections.net_changes(lines.where("source_file LIKE '%T2'"), S.corrected_lines(lines)).checkpoint()
    return corrections.consolidated_after(rows, nets, changes, registry)


def _two_loads(fact, keys, value, first):
    """Moments of two thirds of the quarters, stored, and of the rest: the fact is made once, both loads read its stored rows."""
    ensure_checkpoint_dir(fact.sparkSession)
    rows = fact.select(*keys, value).checkpoint()
    stored = moments.moments(rows.where(first), keys, value).checkpoint()
    return stored, moments.moments(rows.where(f"NOT ({first})"), keys, value)


def q_operator_statistics_incremental(spark, d):
    """The states of the first load, rolled up, merged with those of the second."""
    first, then = _two_loads(S.despesas(spark, d), [A.KEY, "ano", "trimestre"], "valor_despesa", "(ano * 4 + trimestre) % 3 <> 0")
    merged = moments.merge_moments(moments.roll_up(first, [A.KEY]), moments.roll_up(then, [A.KEY]), [A.KEY])
    return moments.statistics_of(merged, S.operadoras(spark, d)).drop(A.KEY)


def q_aggregated_expenses_incremental(spark, d):
    """The report per name and state from the states of two loads."""
    first, then = _two_loads(_validated(spark, d)[0], ["RazaoSocial", "UF", "Ano", "Trimestre"], "ValorDespesas", "(Ano * 4 + Trimestre) % 3 <> 0")
    return moments.report_of(first.unionByName(then))


def q_delimited_blocks_parse(spark, d):
    """Records of files that are cut at fixed offsets, also within quoted values."""
    ensure_checkpoint_dir(spark)
    pieces = S.customer_csv_pieces(spark, d).repartition("path").sortWithinPartitions("path", "block", "place").checkpoint()
    parsed = F.from_csv("value", "id INT, nome STRING, nation INT", {"sep": ";", **CSV_OPTIONS})
    return cut_records(pieces, ";").select("path", "first", "broken", parsed.alias("r")).select("path", "first", "broken", "r.id", "r.nome", "r.nation")


# Key -> SURVEY ids:
#   top_growth Q1 (J4, M8, O3)        state_distribution Q2 (A5)       above_mean_quarters Q3
#   operator_statistics Q4 (A3)       top_operators Q8                  operators_page Q5
#   operator_by_cnpj Q6 (F11)         expense_history Q7                leaf_accounts W1
#   normalized_accounts Q9            consolidated_expenses Q10 (A1)    invalid_dates F4
#   valid_rows / invalid_rows Q11     aggregated_expenses Q12 (A2)      load_operators Q13 (U2, U3, O-KEY)
#   load_expenses Q14 (J3, F9)        load_aggregates Q15               unmatched_registry J8
#   orphan_facts J7 / C4              duplicate_keys C1                 null_violations C2
#   length_violations C3              locale_number_parse P5            dedup_first U1
#   page_links S8                     first_matching_link S9            links_by_extension S10
#   latest_files(_deep, _bounded) S11           page_links_dirty, page_links_states S8   above_mean_by_operator Q3
#   operators_page_past_end, operators_page_deep, operators_after Q5 (A7, O5)   locale_number_rejects P5
#   load_operators_incremental U3, O-KEY, K8                          load_aggregates_rejects Q15
#   consolidated_after_correction Q10
#   operator_statistics_incremental Q4, Q8 (A3)                       aggregated_expenses_incremental Q12 (A2)
#   operator_by_cnpj_clustered Q6 (F11, L1)                           expense_history_clustered Q7 (L1)
#   state_distribution_bucketed Q2
#   load_operators_checked C1, C2, C3, K8, Q13
#   delimited_text_parse S2 (quoting)                                 delimited_blocks_parse S2, S4, S6 (splits)
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_growth": q_top_growth,
    "state_distribution": q_state_distribution,
    "above_mean_quarters": q_above_mean_quarters,
    "operator_statistics": q_operator_statistics,
    "operator_statistics_incremental": q_operator_statistics_incremental,
    "top_operators": q_top_operators,
    "operators_page": q_operators_page,
    "operator_by_cnpj": q_operator_by_cnpj,
    "operator_by_cnpj_clustered": q_operator_by_cnpj_clustered,
    "expense_history": q_expense_history,
    "expense_history_clustered": q_expense_history_clustered,
    "state_distribution_bucketed": q_state_distribution_bucketed,
    "leaf_accounts": q_leaf_accounts,
    "normalized_accounts": q_normalized_accounts,
    "consolidated_expenses": q_consolidated_expenses,
    "consolidated_after_correction": q_consolidated_after_correction,
    "invalid_dates": q_invalid_dates,
    "valid_rows": q_valid_rows,
    "invalid_rows": q_invalid_rows,
    "aggregated_expenses": q_aggregated_expenses,
    "aggregated_expenses_incremental": q_aggregated_expenses_incremental,
    "load_operators": q_load_operators,
    "load_expenses": q_load_expenses,
    "load_aggregates": q_load_aggregates,
    "unmatched_registry": q_unmatched_registry,
    "orphan_facts": q_orphan_facts,
    "duplicate_keys": q_duplicate_keys,
    "null_violations": q_null_violations,
    "length_violations": q_length_violations,
    "locale_number_parse": q_locale_number_parse,
    "dedup_first": q_dedup_first,
    "page_links": q_page_links,
    "first_matching_link": q_first_matching_link,
    "links_by_extension": q_links_by_extension,
    "latest_files": q_latest_files,
    "latest_files_deep": q_latest_files_deep,
    "latest_files_bounded": q_latest_files_bounded,
    "page_links_dirty": q_page_links_dirty,
    "page_links_states": q_page_links_states,
    "above_mean_by_operator": q_above_mean_by_operator,
    "operators_page_past_end": q_operators_page_past_end,
    "operators_page_deep": q_operators_page_deep,
    "operators_after": q_operators_after,
    "locale_number_rejects": q_locale_number_rejects,
    "load_operators_incremental": q_load_operators_incremental,
    "load_operators_checked": q_load_operators_checked,
    "load_aggregates_rejects": q_load_aggregates_rejects,
    "delimited_text_parse": q_delimited_text_parse,
    "delimited_blocks_parse": q_delimited_blocks_parse,
}


def _edged(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_edge(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _edged(v) for k, v in _QUERIES.items()}

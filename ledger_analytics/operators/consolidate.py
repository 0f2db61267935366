"""Consolidate normalised lines with the operator registry (Q10).

Output columns: ``CNPJ, RazaoSocial, Trimestre, Ano, ValorDespesas,
RegistroANS, MODALIDADE, UF`` - one row per (tax id, year, quarter,
registration, modality, state) whose net expense is positive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_DATE_FORMATS, parse_date
from .dedup import dedup_first

# Grouping keys of the net expense and the output order.
GROUP_KEYS = ("CNPJ", "Ano", "Trimestre", "RegistroANS", "MODALIDADE", "UF")
OUTPUT_COLUMNS = ("CNPJ", "RazaoSocial", "Trimestre", "Ano", "ValorDespesas", "RegistroANS", "MODALIDADE", "UF")


@dataclass
class Consolidation:
    consolidated: DataFrame
    invalid_dates: DataFrame


def prepare_registry(registry: DataFrame) -> DataFrame:
    """Registry columns the joins use, with a typed registration id.

    ``reg_order`` (the row's place in the registry file) decides "first";
    if the input has none, the registration id is used.
    """
    reg_id = "try_cast(nullif(CAST(REGISTRO_OPERADORA AS STRING), '') AS BIGINT)"
    order = "reg_order" if "reg_order" in registry.columns else f"CAST({reg_id} AS BIGINT) AS reg_order"
    return registry.selectExpr(f"{reg_id} AS RegistroANS", "CAST(CNPJ AS STRING) AS CNPJ", "RAZAO_SOCIAL",
                               "MODALIDADE", "UF", order)


def split_dates(normalized: DataFrame, formats=DEFAULT_DATE_FORMATS) -> tuple[DataFrame, DataFrame]:
    """Rows with a parsable ``DATA_BASE`` (plus Ano, Trimestre) and the
    rest (F4, M2, M3)."""
    parsed = normalized.withColumn("_date", parse_date("DATA_BASE", formats))
    valid = parsed.where("_date IS NOT NULL").selectExpr(
        *[f"`{c}`" for c in normalized.columns],
        "CAST(year(_date) AS INT) AS Ano", "CAST(quarter(_date) AS INT) AS Trimestre")
    invalid = parsed.where("_date IS NULL").selectExpr(
        *[f"`{c}`" for c in normalized.columns], "'invalid_date' AS reject_reason")
    return valid, invalid


def net_lines(valid: DataFrame) -> DataFrame:
    """Lines with a date (:func:`split_dates`) summed per registration and
    period, with their number: ``RegistroANS, Ano, Trimestre, net, n_lines``."""
    return valid.groupBy(F.col("REGISTRO_OPERADORA").alias("RegistroANS"), "Ano", "Trimestre").agg(
        F.sum("VALOR_DESPESAS").alias("net"), F.count(F.lit(1)).alias("n_lines"))


def attach_registry(nets: DataFrame, registry: DataFrame, on_unmatched: str = "drop", positive_only: bool = True) -> DataFrame:
    """Net lines as consolidated rows: joined with the registry by
    registration (J1) and by tax id (J2), see :func:`consolidate`."""
    if on_unmatched not in ("drop", "keep"):
        raise ValueError("on_unmatched must be 'drop' or 'keep'")
    reg = prepare_registry(registry)
    by_reg = reg.groupBy("RegistroANS", "CNPJ").agg(
        F.count(F.lit(1)).alias("_copies"),
        # first non-NULL name in registry order
        F.expr("min(CASE WHEN RAZAO_SOCIAL IS NOT NULL THEN named_struct('o', reg_order, 'n', RAZAO_SOCIAL) "
               "END).n").alias("RazaoSocial"))
    joined = nets.join(by_reg, "RegistroANS", "left").join(_by_cnpj(reg), "CNPJ", "left")
    if on_unmatched == "drop":
        joined = joined.where(" AND ".join(f"{k} IS NOT NULL" for k in GROUP_KEYS))
    out = joined.withColumn("ValorDespesas", F.expr(
        "CAST(net * CAST(coalesce(_copies, 1) AS DECIMAL(20,0)) AS DECIMAL(18,2))"))
    if positive_only:
        out = out.where("ValorDespesas > 0")
    return out.select(*OUTPUT_COLUMNS)


def _by_cnpj(reg: DataFrame) -> DataFrame:
    return dedup_first(reg.select("CNPJ", "MODALIDADE", "UF", "reg_order"), ["CNPJ"], ["reg_order"]).drop("reg_order")


def consolidate(normalized: DataFrame, registry: DataFrame, formats=DEFAULT_DATE_FORMATS,
                on_unmatched: str = "drop", positive_only: bool = True) -> Consolidation:
    """Join lines with the registry, net them per period and keep positive
    totals.

    * J1: left join on the registration id; the registry is not
      de-duplicated here, so a repeated id fans the lines out, as in the
      source pipeline.
    * J2: modality and state come from the registry de-duplicated by tax id
      (first row in file order).
    * A1: sum per :data:`GROUP_KEYS`, name = first non-NULL name in
      registry order (D17).  ``on_unmatched="drop"`` drops rows with a NULL
      key, as the source code does; ``"keep"`` keeps them as their own
      groups (the documented intent, D1).
    * F3: only totals > 0 survive, after netting (``positive_only=False``
      keeps all totals, e.g. to check that nothing is lost).

    Plan: lines are summed per (registration, year, quarter) and registry
    rows are counted per (registration, tax id) with their first name, both
    map-side combined, *before* they meet.  A registration repeated k times
    with one tax id then contributes ``net * k`` - what the fan-out of J1
    followed by the sum gives - without materialising the k copies, and
    each output key (tax id, period, registration) is produced by exactly
    one joined row, so no aggregation is needed after the joins.
    """
    valid, invalid = split_dates(normalized, formats)
    out = attach_registry(net_lines(valid), registry, on_unmatched, positive_only)
    reg = prepare_registry(registry)
    # the log is split off after both joins: every registry copy of a line, with its names
    copies = reg.select("RegistroANS", "CNPJ", "RAZAO_SOCIAL")
    log = invalid.withColumnRenamed("REGISTRO_OPERADORA", "RegistroANS") \
        .join(copies, "RegistroANS", "left").join(_by_cnpj(reg), "CNPJ", "left") \
        .select(*["RegistroANS" if c == "REGISTRO_OPERADORA" else c for c in normalized.columns],
                "CNPJ", "RAZAO_SOCIAL", "MODALIDADE", "UF", "reject_reason")
    return Consolidation(out, log)


def unmatched_lines(normalized: DataFrame, registry: DataFrame) -> DataFrame:
    """Per registration id without a registry row: line count and net
    amount (J8).  Summed first, then anti-joined, so a hot id is collapsed
    before the shuffle."""
    per_reg = normalized.groupBy("REGISTRO_OPERADORA").agg(
        F.count(F.lit(1)).alias("n_linhas"), F.sum("VALOR_DESPESAS").alias("valor_total"))
    ids = prepare_registry(registry).select(F.col("RegistroANS").alias("REGISTRO_OPERADORA")) \
        .filter(F.col("REGISTRO_OPERADORA").isNotNull())
    return per_reg.join(ids, "REGISTRO_OPERADORA", "left_anti")

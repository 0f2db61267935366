"""Typed loads from staging text (Q13–Q15) and surrogate keys (O-KEY).

Staging tables hold text only; these jobs cast, guard and key the rows.
Rows the source scripts would abort on (bad numbers, blank years, broken
ids) go to a reject set instead (D8, D9).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import iso_date_or_null, numeric_text_guard, text_to_decimal, text_to_int, text_to_long
from ..session import ensure_checkpoint_dir
from .dedup import dedup_first

OPERATOR_COLUMNS = ("registro_ans", "cnpj", "razao_social", "modalidade", "uf", "cidade", "data_registro_ans")


def surrogate_key(df: DataFrame, order_col: str, name: str, start: int = 1) -> DataFrame:
    """Dense 1..N key in ``order_col`` order without a single-partition sort.

    The rows are range-partitioned and sorted on ``order_col`` and saved
    with a reliable ``checkpoint()`` (into ``spark.checkpoint.dir``, the
    cluster's shared folder); the rows are cached while the checkpoint is
    written so the input is computed once.  On the checkpointed rows each
    partition numbers its rows (``monotonically_increasing_id`` minus the
    partition base) and adds the row count of all earlier partitions (one
    row per partition, so broadcast).

    The checkpoint matters: range bounds are sampled, so a recomputation
    could partition differently; the saved copy fixes one partitioning for
    both the counts and the ids and cuts the lineage, so a lost executor
    does not change any id.  ``order_col`` should be unique for the order
    among equal values to be fixed.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(F.col(order_col)).sortWithinPartitions(order_col)
    ranged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        saved = ranged.checkpoint(eager=True)
    finally:
        ranged.unpersist()
    pos = saved.withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    keyed = pos.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
    return keyed.withColumn(name, (F.col("_off") + F.col("_local") + F.lit(start)).cast("long")) \
        .drop("_pid", "_local", "_off")


@dataclass
class Load:
    rows: DataFrame
    rejects: DataFrame


def _typed_operators(stg: DataFrame) -> DataFrame:
    """Staging operator rows, cast and guarded (P10, P11), with the reason a row cannot be loaded (F8)."""
    order = F.col("reg_order") if "reg_order" in stg.columns else F.lit(0).cast("long")
    typed = stg.select(
        text_to_long("registro_ans").alias("registro_ans"), F.col("registro_ans").alias("_text"),
        F.col("cnpj"), F.col("razao_social"), F.col("modalidade"), F.col("uf"), F.col("cidade"),
        iso_date_or_null("data_registro_ans").alias("data_registro_ans"),
        order.alias("_order"),
    )
    return typed.withColumn("reject_reason", F.expr(
        "CASE WHEN _text IS NULL OR cnpj IS NULL THEN 'null_key' WHEN registro_ans IS NULL THEN 'bad_registro_ans' END")).drop("_text")


def operator_rows(stg: DataFrame) -> DataFrame:
    """The operators a load would hold, without their surrogate key: distinct
    rows (U2), the first in file order per ``registro_ans`` (U3).  Checks read
    this; it starts no job."""
    good = _typed_operators(stg).where("reject_reason IS NULL")
    distinct = good.groupBy(*OPERATOR_COLUMNS).agg(F.min("_order").alias("_order"))
    return dedup_first(distinct, ["registro_ans"], ["_order"]).drop("_order")


def load_operators(stg: DataFrame, existing: DataFrame | None = None) -> Load:
    """``operadoras`` load (Q13): insert-if-absent on ``registro_ans``, dense
    surrogate ``cod_operadora`` continuing after the largest of ``existing``.

    Only new rows are returned: operators that exist keep their key and their
    row, so facts loaded under it stay right.  Rows with a NULL id or tax id,
    or a non-numeric id, are rejected.
    """
    rejects = _typed_operators(stg).where("reject_reason IS NOT NULL").drop("_order")
    rows, start = operator_rows(stg), 1
    if existing is not None:
        rows = rows.join(existing.select("registro_ans"), "registro_ans", "left_anti")
        start = existing.agg(F.coalesce(F.max("cod_operadora"), F.lit(0)) + 1).first()[0]
    keyed = surrogate_key(rows, "registro_ans", "cod_operadora", start=start)
    return Load(keyed.select("cod_operadora", *OPERATOR_COLUMNS), rejects)


def load_expenses(stg: DataFrame, operadoras: DataFrame) -> Load:
    """``despesas_consolidadas`` load (Q14): the amount must match
    ``^[0-9.]+$`` and cast, year and quarter must be integers, and the
    registration must exist in ``operadoras`` (inner join, J3)."""
    typed = stg.select(
        text_to_long("registro_ans").alias("registro_ans"),
        text_to_int("ano").alias("ano"),
        text_to_int("trimestre").alias("trimestre"),
        numeric_text_guard("valor_despesas").alias("_numeric"),
        F.col("valor_despesas"),
        text_to_decimal("valor_despesas").alias("_amount"),
    )
    tagged = typed.selectExpr(
        "registro_ans", "ano", "trimestre", "valor_despesas",
        "CASE WHEN _numeric THEN _amount END AS valor_despesa",
        "nullif(concat_ws(';', CASE WHEN NOT _numeric THEN 'non_numeric_amount' "
        "WHEN _amount IS NULL THEN 'bad_amount' END, CASE WHEN ano IS NULL THEN 'bad_year' END, "
        "CASE WHEN trimestre IS NULL THEN 'bad_quarter' END), '') AS reject_reason")
    good = tagged.where("reject_reason IS NULL")
    dim = operadoras.select("registro_ans", "cod_operadora")
    rows = good.join(dim, "registro_ans").select("cod_operadora", "ano", "trimestre", "valor_despesa")
    return Load(rows, tagged.where("reject_reason IS NOT NULL"))


def load_aggregates(stg: DataFrame) -> Load:
    """``despesas_agregadas`` load (Q15): text -> DECIMAL(18,2) (half-up).
    Rows without a name, or with a figure that is no number of that type, are
    rejected with all their reasons."""
    figures = {"total_despesas": "valor_total", "media_trimestral": "media_trimestral", "desvio_padrao_despesas": "desvio_padrao"}
    typed = stg.select("*", *[text_to_decimal(c).alias(f"_{c}") for c in figures])
    bad = ", ".join(f"CASE WHEN {c} IS NOT NULL AND _{c} IS NULL THEN 'bad_{c}' END" for c in figures)
    tagged = typed.withColumn("reject_reason", F.expr(
        f"nullif(concat_ws(';', CASE WHEN razao_social IS NULL THEN 'null_name' END, {bad}), '')"))
    rows = tagged.where("reject_reason IS NULL").select(
        "razao_social", "uf", *[F.col(f"_{c}").alias(name) for c, name in figures.items()])
    return Load(rows, tagged.where("reject_reason IS NOT NULL").drop(*[f"_{c}" for c in figures]))

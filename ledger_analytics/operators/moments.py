"""Statistics from stored moments (A2, A3, Q4, Q8, Q12).

The state of a group of values is their count, their exact sum and their
centred second moment (the sum of squared distances from the mean).  Two states
merge without the values behind them, so a fact is aggregated once, when it is
loaded: the stored states of its (operator, period) are all that later
statistics read.

States are kept per load (:func:`write_moments`).  A load that is run again
replaces its own states, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sql_ident
from ..sinks.files import write_parquet

MOMENTS = ("n", "total", "m2")
SUM_TYPE = "decimal(38,2)"


def moments(fact: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, n, total, m2``: one state per group of rows, map-side combined.
    NULL values do not count; a group of them has n = 0 and no total."""
    v = sql_ident(value)
    return fact.groupBy(*keys).agg(
        F.expr(f"count({v})").alias("n"), F.expr(f"CAST(sum({v}) AS {SUM_TYPE})").alias("total"),
        F.expr(f"coalesce(var_pop(CAST({v} AS DOUBLE)) * count({v}), 0.0D)").alias("m2"))


def _mean(total: Column, n: Column) -> Column:
    return total.cast("double") / F.nullif(n, F.lit(0))


def merge_moments(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states of two tables that have one row per key each, merged by the
    pairwise formula: the second moments add up, plus the squared distance of
    the means weighted by ``n_a n_b / (n_a + n_b)``.  NULL keys match."""
    left = a.select(*[F.col(k).alias(f"_a{i}") for i, k in enumerate(keys)], F.struct(*MOMENTS).alias("_a"))
    right = b.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], F.struct(*MOMENTS).alias("_b"))
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}"))
    joined = left.join(right, same, "full_outer")
    n_a, n_b = (F.coalesce(F.col(f"{x}.n"), F.lit(0)) for x in ("_a", "_b"))
    apart = _mean(F.col("_b.total"), n_b) - _mean(F.col("_a.total"), n_a)
    zero = F.lit(0.0)
    between = F.coalesce(apart * apart * n_a.cast("double") * n_b / F.nullif(n_a + n_b, F.lit(0)), zero)
    total = F.when(F.col("_a.total").isNotNull() | F.col("_b.total").isNotNull(),
                   F.coalesce("_a.total", F.lit(0).cast(SUM_TYPE)) + F.coalesce("_b.total", F.lit(0).cast(SUM_TYPE)))
    found = F.col("_a").isNotNull()
    return joined.select(*[F.when(found, F.col(f"_a{i}")).otherwise(F.col(f"_b{i}")).alias(k) for i, k in enumerate(keys)],
                         (n_a + n_b).alias("n"), total.cast(SUM_TYPE).alias("total"),
                         (F.coalesce("_a.m2", zero) + F.coalesce("_b.m2", zero) + between).alias("m2"))


def roll_up(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All states of a key merged into one (the pairwise formula over any number
    of states): two aggregations, both map-side combined, so a key with a third
    of all states is no burden to any task."""
    means = states.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").cast(SUM_TYPE).alias("total"))
    own = means.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], _mean(F.col("total"), F.col("n")).alias("_mean"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    apart = _mean(F.col("total"), F.col("n")) - F.col("_mean")
    around = states.join(own, same).groupBy(*keys).agg(
        F.sum(F.col("m2") + F.coalesce(apart * apart * F.col("n"), F.lit(0.0))).alias("m2"), F.sum("n").alias("n"),
        F.sum("total").cast(SUM_TYPE).alias("total"))
    return around.select(*keys, *MOMENTS)


def std_of(n: str = "n", m2: str = "m2") -> Column:
    """Sample standard deviation of a state; NULL below two values."""
    return F.when(F.col(n) > 1, F.sqrt(F.greatest(F.col(m2), F.lit(0.0)) / (F.col(n) - 1)))


def statistics_of(states: DataFrame, operadoras: DataFrame, key: str = "cod_operadora", std_scale: int | None = 2) -> DataFrame:
    """The statistics view (Q4) from states, one or more per operator: the
    columns of :func:`~ledger_analytics.plans.analytics.operator_statistics`."""
    joined = roll_up(states, [key]).join(operadoras.select(key, "razao_social", "uf"), key)
    std = std_of() if std_scale is None else F.round(std_of(), std_scale)
    return joined.select(key, F.col("razao_social").alias("RazaoSocial"), F.col("uf").alias("UF"), F.col("total").alias("Total_Despesas"),
                         _mean(F.col("total"), F.col("n")).alias("Media_Trimestral"), std.alias("Desvio_Padrao_Despesas"))


def report_of(states: DataFrame, name_col: str = "RazaoSocial", state_col: str = "UF") -> DataFrame:
    """The report per name and state (Q12) from states: the columns of
    :func:`~ledger_analytics.operators.aggregate.expense_report`."""
    known = states.where(F.col(name_col).isNotNull() & F.col(state_col).isNotNull())
    return roll_up(known, [name_col, state_col]).select(
        F.col(name_col).alias("RazaoSocial"), F.col(state_col).alias("UF"), F.col("total").alias("Total_Despesas"),
        F.expr("CAST(round(total / CAST(nullif(n, 0) AS DECIMAL(20,0)), 2) AS DECIMAL(38,2))").alias("Media_Trimestral"),
        F.coalesce(F.round(std_of(), 2), F.lit(0.0)).alias("Desvio_Padrao_Despesas"),
    ).orderBy(F.col("Total_Despesas").desc(), F.col("RazaoSocial"), F.col("UF"))


def write_moments(fact: DataFrame, path: str, load: str, keys: Sequence[str], value: str) -> None:
    """Store the states of one load; only this load's rows are read."""
    write_parquet(moments(fact, keys, value).withColumn("load", F.lit(load)), path, partition_by=["load"])


def read_moments(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The stored states of all loads."""
    return spark.read.parquet(path).select(*keys, *MOMENTS)

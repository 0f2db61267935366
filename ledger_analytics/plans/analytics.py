"""Analytical and served queries over the star schema (Q1–Q8).

Inputs are the fact ``despesas`` (cod_operadora, ano, trimestre,
valor_despesa) and the dimension ``operadoras`` (cod_operadora, registro_ans,
cnpj, razao_social, modalidade, uf, ...).  Period, quarter and k are
parameters instead of literals.

Plan shape: the fact is always filtered / aggregated per ``cod_operadora``
before it meets the dimension, so the shuffle carries one row per operator
(or a bounded handful), whatever the fact volume or its key skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranks import rows_at
from ..sinks.layouts import read_at

KEY = "cod_operadora"


def _dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# ----------------------------------------------------------------- Q1

def top_growth(despesas: DataFrame, operadoras: DataFrame, first_year: int, first_quarter: int,
               last_year: int | None = None, last_quarter: int = 3, k: int = 5) -> DataFrame:
    """Top-k percentage growth of the expense between two periods (Q1).

    Semantics of the SQL it replaces: inner self-join of the two periods on
    the operator, join with the dimension, ``first > 0``, growth
    ``(last - first) / first * 100``, ``ORDER BY growth DESC LIMIT k``.

    If an operator has several rows in a period, the self-join would pair
    every first-period row with every last-period row.  Instead of emitting
    those pairs, only rows that can reach the top k are paired: for a fixed
    first value the growth rises with the last value (keep the k largest
    last values), and for a fixed last value it is monotone in the first
    value (keep the k smallest and the k largest first values).  At most
    2k*k pairs per operator are formed, and the result is the same.

    One scan ranks both periods: a first-period row enters the ``low`` and the
    ``high`` ranking, a last-period row the ``last`` one, and ``row_number()
    <= k`` per (operator, ranking) is planned with a partial
    WindowGroupLimit.  A second scan counts the first-period rows, which
    tells the rows that are in both rankings.
    """
    last_year = first_year if last_year is None else last_year
    is_first = f"(ano = {int(first_year)} AND trimestre = {int(first_quarter)} AND valor_despesa > 0)"
    is_last = f"(ano = {int(last_year)} AND trimestre = {int(last_quarter)})"
    entries = despesas.where(f"{is_first} OR {is_last}").selectExpr(
        KEY, f"""explode(filter(array(
            CASE WHEN {is_first} THEN named_struct('rank', 'low', 'v', valor_despesa, 'o', valor_despesa) END,
            CASE WHEN {is_first} THEN named_struct('rank', 'high', 'v', valor_despesa, 'o', -valor_despesa) END,
            CASE WHEN {is_last} THEN named_struct('rank', 'last', 'v', valor_despesa, 'o', -valor_despesa) END), e -> e IS NOT NULL)) AS e""")
    entries = entries.selectExpr(KEY, "e.rank AS rank", "e.v AS v", "e.o AS o")
    w = Window.partitionBy(KEY, "rank").orderBy("o")
    best = entries.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    few = best.groupBy(KEY).agg(F.collect_list(F.struct("rank", "v", "_rn")).alias("e"))  # 3k entries at most
    n_first = despesas.where(is_first).groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    pairs = few.join(n_first, KEY).selectExpr(
        KEY, f"""explode(flatten(transform(
            filter(e, x -> x.rank = 'low' OR (x.rank = 'high' AND _n - x._rn + 1 > {int(k)})),
            a -> transform(filter(e, x -> x.rank = 'last'), b -> named_struct('a', a.v, 'b', b.v))))) AS p"""
    ).selectExpr(KEY, "p.a AS valor_inicial", "p.b AS valor_final")
    growth = ((_dbl("valor_final") - _dbl("valor_inicial")) / F.nullif(_dbl("valor_inicial"), F.lit(0.0))) * 100
    return (pairs.join(operadoras.select(KEY, "razao_social"), KEY)
            .select(KEY, "razao_social", "valor_inicial", "valor_final", growth.alias("crescimento_percentual"))
            .orderBy(F.col("crescimento_percentual").desc_nulls_last(), F.col(KEY))
            .limit(k)
            .drop(KEY))


# ----------------------------------------------------------------- Q2

def per_operator_totals(despesas: DataFrame) -> DataFrame:
    """Map-side-combined sum, count and sample std per operator."""
    return despesas.groupBy(KEY).agg(
        F.sum("valor_despesa").alias("_sum"),
        F.count("valor_despesa").alias("_n"),
        F.stddev_samp("valor_despesa").alias("_std"),
    )


def state_distribution(despesas: DataFrame, operadoras: DataFrame, k: int = 5) -> DataFrame:
    """Top-k states by total expense with distinct operators and the mean
    per operator (Q2).  The fact is summed per operator first; the sum over
    the joined rows is the same because the join key is the grouping key."""
    per_op = despesas.groupBy(KEY).agg(F.sum("valor_despesa").alias("_sum"))
    joined = per_op.join(operadoras.select(KEY, "uf"), KEY)
    by_state = joined.groupBy("uf").agg(
        F.sum("_sum").alias("despesa_total"),
        F.countDistinct(KEY).alias("total_operadoras"),
    )
    return (by_state
            .withColumn("media_por_operadora", _dbl("despesa_total") / F.col("total_operadoras"))
            .orderBy(F.col("despesa_total").desc_nulls_last(), F.col("uf"))
            .limit(k))


# ----------------------------------------------------------------- Q3

def period_means(despesas: DataFrame) -> DataFrame:
    """Sum and count per (ano, trimestre): the mean as an exact fraction."""
    return despesas.groupBy("ano", "trimestre").agg(
        F.sum("valor_despesa").alias("_period_sum"),
        F.count("valor_despesa").alias("_period_n"),
    )


def above_mean_quarters(despesas: DataFrame, operadoras: DataFrame, min_quarters: int = 2,
                        by_key: bool = False) -> DataFrame:
    """Operators whose expense is above the mean of its period in at least
    ``min_quarters`` rows (Q3).  Grouped by name, as the source does:
    same-named operators merge and rows are counted; ``by_key`` keeps the
    operators apart and counts distinct quarters (D7).

    ``value > sum / n`` is tested as ``value * n > sum`` in exact decimals.
    The period table is small, which AQE sees from its measured size.
    """
    means = period_means(despesas)
    above = (despesas.join(means, ["ano", "trimestre"])
             .filter(F.col("valor_despesa") * F.col("_period_n").cast("decimal(20,0)") > F.col("_period_sum")))
    if by_key:
        per_period = above.groupBy(KEY, "ano", "trimestre").agg(F.sum("valor_despesa").alias("_s"))
        per_op = per_period.groupBy(KEY).agg(F.count(F.lit(1)).alias("trimestres_acima_da_media"),
                                             F.sum("_s").alias("despesa_acumulada_nos_periodos"))
        return (per_op.filter(F.col("trimestres_acima_da_media") >= min_quarters)
                .join(operadoras.select(KEY, "razao_social"), KEY)
                .select(KEY, "razao_social", "trimestres_acima_da_media", "despesa_acumulada_nos_periodos")
                .orderBy(F.col("trimestres_acima_da_media").desc(),
                         F.col("despesa_acumulada_nos_periodos").desc(), F.col(KEY)))
    per_op = above.groupBy(KEY).agg(F.count(F.lit(1)).alias("_c"), F.sum("valor_despesa").alias("_s"))
    joined = per_op.join(operadoras.select(KEY, "razao_social"), KEY)
    return (joined.groupBy("razao_social")
            .agg(F.sum("_c").alias("trimestres_acima_da_media"),
                 F.sum("_s").alias("despesa_acumulada_nos_periodos"))
            .filter(F.col("trimestres_acima_da_media") >= min_quarters)
            .orderBy(F.col("trimestres_acima_da_media").desc(),
                     F.col("despesa_acumulada_nos_periodos").desc(), F.col("razao_social")))


# ------------------------------------------------------------- Q4 / Q8

def operator_statistics(despesas: DataFrame, operadoras: DataFrame, std_scale: int | None = 2) -> DataFrame:
    """The statistics view (Q4): per operator total, mean and sample std
    (NULL for a single row), labelled by name and state.  The std is
    rounded to cents unless ``std_scale`` is None."""
    per_op = per_operator_totals(despesas)
    joined = per_op.join(operadoras.select(KEY, "razao_social", "uf"), KEY)
    std = F.col("_std") if std_scale is None else F.round("_std", std_scale)
    return joined.select(
        F.col(KEY),
        F.col("razao_social").alias("RazaoSocial"),
        F.col("uf").alias("UF"),
        F.col("_sum").alias("Total_Despesas"),
        (_dbl("_sum") / F.col("_n")).alias("Media_Trimestral"),
        std.alias("Desvio_Padrao_Despesas"),
    )


def top_operators(despesas: DataFrame, operadoras: DataFrame, k: int = 5) -> DataFrame:
    """Top-k rows of the statistics view by total (Q8)."""
    return (operator_statistics(despesas, operadoras)
            .orderBy(F.col("Total_Despesas").desc_nulls_last(), F.col(KEY))
            .limit(k)
            .drop(KEY))


# ------------------------------------------------------------- Q5 – Q7

def operators_page(operadoras: DataFrame, page: int = 1, limit: int = 10) -> DataFrame:
    """One page of operators ordered by key plus the table count (Q5).

    The page's rows are found by rank (:func:`~ledger_analytics.operators.ranks.rows_at`):
    a few counting rounds and a range filter on the key, however far the
    page; no sort or heap grows with its number.  A page past the end is
    one row with the total and no operator.
    """
    if page < 1 or limit < 1:
        raise ValueError("page and limit must be >= 1")
    rows, total = rows_at(operadoras, KEY, (page - 1) * limit, limit)
    if total <= (page - 1) * limit:
        rows = operadoras.sparkSession.range(1).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in operadoras.schema.fields])
    # page numbers are unbounded integers, as the limit
    number = lambda n: F.lit(n) if abs(n) < 1 << 63 else F.lit(str(n)).cast("decimal(38,0)")
    return rows.withColumns({"total": F.lit(total).cast("bigint"), "page": number(page), "limit": number(limit)})


def operators_after(operadoras: DataFrame, last_key: int | None, limit: int = 10) -> DataFrame:
    """Keyset page: the ``limit`` operators after ``last_key`` (pushed down
    as a range filter on the key)."""
    df = operadoras if last_key is None else operadoras.filter(F.col(KEY) > F.lit(last_key))
    return df.orderBy(KEY).limit(limit)


def operator_by_cnpj(operadoras: DataFrame, cnpj: str) -> DataFrame:
    """Operator lookup by tax id (Q6); an empty result is 'not found'.
    The value is bound as a literal, never spliced into SQL text."""
    return operadoras.filter(F.col("cnpj") == F.lit(cnpj))


def expense_history(despesas: DataFrame, operadoras: DataFrame, cnpj: str) -> DataFrame:
    """Expense rows of the operator(s) with this tax id, newest first (Q7)."""
    keys = operadoras.filter(F.col("cnpj") == F.lit(cnpj)).select(KEY)
    rows = despesas.join(keys, KEY)
    return rows.select(*despesas.columns).orderBy(F.col("ano").desc(), F.col("trimestre").desc())


def operator_by_cnpj_clustered(spark: SparkSession, operadoras_path: str, cnpj: str) -> DataFrame:
    """Operator lookup (Q6) in a dimension that is clustered by ``cnpj``
    (:func:`~ledger_analytics.sinks.layouts.write_clustered`): one file is read."""
    return read_at(spark, operadoras_path, "cnpj", [cnpj])


def expense_history_clustered(spark: SparkSession, despesas_path: str, operadoras_path: str, cnpj: str) -> DataFrame:
    """Expense history (Q7) where the fact is clustered by operator: the files
    that may hold the tax id's operators (a few) are read."""
    keys = [r[0] for r in operator_by_cnpj_clustered(spark, operadoras_path, cnpj).select(KEY).distinct().collect()]
    return read_at(spark, despesas_path, KEY, keys).orderBy(F.col("ano").desc(), F.col("trimestre").desc())

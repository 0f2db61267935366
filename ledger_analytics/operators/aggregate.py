"""Aggregate report per name and state (Q12: A2, A8, O2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sql_ident


def expense_report(valid: DataFrame, name_col: str = "RazaoSocial", state_col: str = "UF",
                   value_col: str = "ValorDespesas") -> DataFrame:
    """Total, quarterly mean and sample std per (name, state).

    Rows with a NULL name or state are left out (as a pandas group-by
    does); a single-quarter group has std 0; mean and std are rounded to
    cents (mean half-up on the exact decimal quotient, D3); sorted by total,
    largest first.  Same-named operators in one state merge (D6).
    """
    n, u, v = sql_ident(name_col), sql_ident(state_col), sql_ident(value_col)
    agg = valid.where(f"{n} IS NOT NULL AND {u} IS NOT NULL").groupBy(name_col, state_col).agg(
        F.expr(f"sum({v})").alias("_sum"),
        F.expr(f"count({v})").alias("_n"),
        F.expr(f"stddev_samp(CAST({v} AS DOUBLE))").alias("_std"),
    )
    return (agg.selectExpr(
        f"{n} AS RazaoSocial", f"{u} AS UF",
        "CAST(_sum AS DECIMAL(38,2)) AS Total_Despesas",
        # mean rounded half-up on the exact decimal quotient
        "CAST(round(_sum / CAST(_n AS DECIMAL(20,0)), 2) AS DECIMAL(38,2)) AS Media_Trimestral",
        "coalesce(round(_std, 2), 0.0D) AS Desvio_Padrao_Despesas",
    ).orderBy(F.col("Total_Despesas").desc(), F.col("RazaoSocial"), F.col("UF")))

"""De-duplication operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.text import sql_ident


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (U1, deterministic where
    ``dropDuplicates`` is not).  ``row_number() == 1`` is planned with a
    partial WindowGroupLimit before the shuffle, so a key holding a large
    share of the rows sends one row per map task."""
    part = ", ".join(sql_ident(k) for k in keys)
    by = ", ".join(f"{sql_ident(c)} ASC NULLS LAST" for c in order)
    return df.selectExpr("*", f"row_number() OVER (PARTITION BY {part} ORDER BY {by}) AS _rn") \
        .where("_rn = 1").drop("_rn")

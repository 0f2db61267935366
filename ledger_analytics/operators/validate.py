"""Validation split (Q11): a row is valid when its name is present and not
blank (F5) and its tax id passes the check (F6, M1).  Invalid rows carry a
``reject_reason``; valid + invalid = input, disjoint (F7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cnpj import cnpj_is_valid_sql
from ..functions.text import sql_string, sql_ident

BLANK_PATTERN = r"(?U)^\s*$"


def name_present_sql(column: str) -> str:
    """Not NULL and not only white space (Unicode-aware, like str.strip)."""
    return f"coalesce(NOT (CAST({sql_ident(column)} AS STRING) RLIKE {sql_string(BLANK_PATTERN)}), false)"


def with_reject_reason(df: DataFrame, name_col: str = "RazaoSocial", cnpj_col: str = "CNPJ") -> DataFrame:
    """Add ``reject_reason``: NULL when valid, else ``blank_name``,
    ``invalid_cnpj`` or both joined by ``;``."""
    reason = (f"nullif(concat_ws(';', CASE WHEN NOT {name_present_sql(name_col)} THEN 'blank_name' END, "
              f"CASE WHEN NOT {cnpj_is_valid_sql(cnpj_col)} THEN 'invalid_cnpj' END), '')")
    return df.withColumn("reject_reason", F.expr(reason))


def split_valid(df: DataFrame, name_col: str = "RazaoSocial", cnpj_col: str = "CNPJ") -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, invalid rows with it)."""
    tagged = with_reject_reason(df, name_col, cnpj_col)
    valid = tagged.where("reject_reason IS NULL").drop("reject_reason")
    invalid = tagged.where("reject_reason IS NOT NULL")
    return valid, invalid

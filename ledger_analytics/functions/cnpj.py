"""Brazilian company tax id (CNPJ) check as one Catalyst expression (M1).

No Python runs per row: the digits are cleaned with ``regexp_replace``,
padded with zeros (never truncated) and the two mod-11 check digits are
computed from sums of digits times weights, written out term by term.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The official check-digit weights of the CNPJ, first and second digit.
WEIGHTS_FIRST = [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]
WEIGHTS_SECOND = [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]


def check_digit_sql(var: str, weights: list[int]) -> str:
    """SQL text of one check digit of the digit string ``var``."""
    total = " + ".join(f"(ascii(substr({var}, {i}, 1)) - 48) * {w}" for i, w in enumerate(weights, 1))
    return f"transform(array({total}), s -> CASE WHEN s % 11 < 2 THEN '0' ELSE CAST(11 - s % 11 AS STRING) END)[0]"


def cnpj_is_valid_sql(column: str) -> str:
    """:func:`cnpj_is_valid` as SQL text over a column name: one expression
    the JVM parses in a single call, the cleaned id bound once."""
    raw = f"regexp_replace(coalesce(CAST(`{column}` AS STRING), ''), '[^0-9]', '')"
    digits = f"transform(array({raw}), r -> CASE WHEN length(r) >= 14 THEN r ELSE lpad(r, 14, '0') END)[0]"
    check = (f"length(d) = 14 AND d <> repeat(substr(d, 1, 1), 14) AND substr(d, 13, 2) = "
             f"concat({check_digit_sql('d', WEIGHTS_FIRST)}, {check_digit_sql('d', WEIGHTS_SECOND)})")
    return f"coalesce(transform(array({digits}), d -> {check})[0], false)"


def cnpj_is_valid(column: str) -> Column:
    """True when the id has 14 digits (after cleaning), is not one repeated
    digit and both check digits match.  Never NULL."""
    return F.expr(cnpj_is_valid_sql(column))

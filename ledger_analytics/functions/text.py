"""Scalar text helpers: header names, locale numbers, dates, staging casts.

All helpers take a column name and return a Column built from SQL text (one
parse on the JVM instead of a round trip per function call).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_ident(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(s: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# ---------------------------------------------------------------- headers

def normalize_header(name: str) -> str:
    """Trim, upper-case and drop double quotes (and a byte-order mark)
    from a header name."""
    return name.replace("\ufeff", "").strip().upper().replace('"', "")


# ---------------------------------------------------- locale numbers (P5, M9)

# Fixed value: text that is a plain decimal number once the marks are replaced.
NUMBER_PATTERN = r"^[+-]?[0-9]+([.][0-9]*)?$"


def strip_sql(expression: str) -> str:
    """SQL text that cuts all (Unicode) white space around a string."""
    return f"regexp_replace({expression}, '(?U)^\\\\s+|\\\\s+$', '')"


def parse_locale_decimal_sql(column: str, precision: int = 18, scale: int = 2,
                             thousands: str = ".", decimal: str = ",", default=0) -> str:
    txt = f"CAST({sql_ident(column)} AS STRING)"
    if thousands:
        txt = f"replace({txt}, {sql_string(thousands)}, '')"
    if decimal and decimal != ".":
        txt = f"replace({txt}, {sql_string(decimal)}, '.')"
    number = f"DECIMAL({precision},{scale})"
    stripped = strip_sql(txt)
    # most texts are cast as they are: what is no number yet is stripped, and only what is none then meets the pattern
    tries = [f"try_cast({txt} AS {number})", f"try_cast({stripped} AS {number})"]
    if default is not None:
        tries.append(f"CASE WHEN coalesce({stripped} RLIKE {sql_string(NUMBER_PATTERN)}, false) THEN NULL "
                     f"ELSE CAST({default} AS {number}) END")
    return f"coalesce({', '.join(tries)})"


def parse_locale_decimal(c: str, precision: int = 18, scale: int = 2,
                         thousands: str = ".", decimal: str = ",", default=0) -> Column:
    """Parse ``1.234,56`` style text of a column into DECIMAL: drop the
    thousands mark, turn the decimal mark into a point, strip, cast.  Bad or
    NULL text gives ``default`` (0 like the source pipeline; None keeps
    NULL); a number beyond the type gives NULL, never the default."""
    return F.expr(parse_locale_decimal_sql(c, precision, scale, thousands, decimal, default))


# ------------------------------------------------------------- dates (M2, M3)

DEFAULT_DATE_FORMATS = ("yyyy-MM-dd",)


def parse_date(c: str, formats=DEFAULT_DATE_FORMATS) -> Column:
    """First format that parses wins; impossible dates (``2025-02-30``) and
    other formats give NULL instead of an error."""
    txt = strip_sql(f"CAST({sql_ident(c)} AS STRING)")
    tries = ", ".join(f"try_to_date({txt}, {sql_string(f)})" for f in formats)
    return F.expr(f"coalesce({tries})")


# Fixed value: the staging date guard.
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def iso_date_or_null(c: str) -> Column:
    """Staging date guard (P11): regex first, then a cast that cannot throw."""
    t = f"CAST({sql_ident(c)} AS STRING)"
    return F.expr(f"CASE WHEN {t} RLIKE {sql_string(ISO_DATE_PATTERN)} THEN try_to_date({t}, 'yyyy-MM-dd') END")


# ------------------------------------------------------- staging casts

def text_to_int(c: str) -> Column:
    """Blank -> NULL -> INT, bad text -> NULL (P10)."""
    return F.expr(f"try_cast(nullif(CAST({sql_ident(c)} AS STRING), '') AS INT)")


def text_to_long(c: str) -> Column:
    """Blank -> NULL -> BIGINT, bad text -> NULL (identifiers)."""
    return F.expr(f"try_cast(nullif(CAST({sql_ident(c)} AS STRING), '') AS BIGINT)")


def text_to_decimal(c: str, precision: int = 18, scale: int = 2) -> Column:
    """Text -> DECIMAL with half-up rounding, bad text -> NULL."""
    return F.expr(f"try_cast(CAST({sql_ident(c)} AS STRING) AS DECIMAL({precision},{scale}))")


# Fixed value: the staging amount guard.
NUMERIC_TEXT_PATTERN = r"^[0-9.]+$"


def numeric_text_guard(c: str) -> Column:
    """The staging guard ``~ '^[0-9.]+$'`` (F9); also rejects negatives."""
    return F.expr(f"coalesce(CAST({sql_ident(c)} AS STRING) RLIKE {sql_string(NUMERIC_TEXT_PATTERN)}, false)")


# ----------------------------------------------------------- rounding

def round_half_up_ratio(numerator, denominator, scale: int = 2) -> Column:
    """Exact ``numerator / denominator`` rounded half-up to ``scale`` places.

    With a DECIMAL numerator Spark divides exactly and ``round`` is half-up,
    so the result does not depend on binary floating point.
    """
    num = _col(numerator)
    den = _col(denominator).cast("decimal(20,0)")
    return F.round(num / den, scale)

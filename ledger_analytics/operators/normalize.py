"""Normalise quarterly account lines (Q9): header rules, number parsing,
account-prefix filter, leaf-account filter and the expense measure.

Input: one DataFrame of text columns (any header spelling the rules below
accept) plus ``source_file``.  Output columns: ``source_file,
REGISTRO_OPERADORA, DATA_BASE, CODIGO_CONTABIL, DESCRICAO, V_INICIAL,
V_FINAL, VALOR_DESPESAS``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import file_stem
from ..functions.text import normalize_header, parse_locale_decimal, sql_ident, strip_sql, text_to_long

# Header rules in priority order (the first rule whose any
# substring occurs in the upper-cased header decides the canonical name).
CANONICAL_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("DATA_BASE", ("DATA", "DT_")),
    ("REGISTRO_OPERADORA", ("REG", "ANS")),
    ("CODIGO_CONTABIL", ("CD_CONTA", "CONTABIL")),
    ("DESCRICAO", ("DESC",)),
    ("V_INICIAL", ("INICIAL", "INI")),
    ("V_FINAL", ("FINAL", "FIN")),
)
# How the code column is found before renaming.
CODE_COLUMN_HINTS = ("CD_CONTA", "CONTABIL")
# Claims-expense accounts start with this prefix.
EXPENSE_ACCOUNT_PREFIX = "411"
# Output column order of a normalised file.
OUTPUT_COLUMNS = ("REGISTRO_OPERADORA", "DATA_BASE", "CODIGO_CONTABIL", "DESCRICAO",
                  "V_INICIAL", "V_FINAL", "VALOR_DESPESAS")

LINEAGE = ("source_file", "source_path", "_corrupt_record")


def normalize_headers(df: DataFrame, keep: Iterable[str] = LINEAGE) -> DataFrame:
    """Trim / upper-case / unquote header names and keep only the first of
    equally named columns (P1, P3).  Works on names only."""
    keep = set(keep)
    positional = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    seen: set[str] = set()
    cols = []
    for i, name in enumerate(df.columns):
        new = name if name in keep else normalize_header(name)
        if new not in seen:
            seen.add(new)
            cols.append(F.col(f"_c{i}").alias(new))
    return positional.select(*cols)


def canonical_name(header: str, rules=CANONICAL_RULES) -> str | None:
    for target, needles in rules:
        if any(n in header for n in needles):
            return target
    return None


def find_code_column(columns: Sequence[str], hints=CODE_COLUMN_HINTS) -> str | None:
    """First column whose name contains one of the code hints."""
    return next((c for c in columns if any(h in c for h in hints)), None)


def harmonize_columns(df: DataFrame, rules=CANONICAL_RULES, keep: Iterable[str] = LINEAGE) -> DataFrame:
    """Rename columns to canonical names by the ordered substring rules.

    Two columns mapping to one name is an error (D13) rather than a silent
    overwrite.  Columns no rule matches keep their name.
    """
    keep = set(keep)
    mapping: dict[str, str] = {}
    for c in df.columns:
        if c in keep:
            continue
        target = canonical_name(c, rules)
        if target is not None:
            if target in mapping.values():
                clash = [k for k, v in mapping.items() if v == target] + [c]
                raise ValueError(f"columns {clash} all map to {target}")
            mapping[c] = target
    return df.withColumnsRenamed(mapping) if mapping else df


def filter_account_prefix(df: DataFrame, code_col: str = "CODIGO_CONTABIL",
                          prefix: str = EXPENSE_ACCOUNT_PREFIX) -> DataFrame:
    """Strip all white space around the code (P6) and keep codes starting with ``prefix`` (F1)."""
    return df.withColumn(code_col, F.expr(strip_sql(f"CAST({sql_ident(code_col)} AS STRING)"))) \
        .where(F.col(code_col).startswith(prefix))


def leaf_accounts(df: DataFrame, group_cols: Sequence[str] = ("REGISTRO_OPERADORA", "source_file"),
                  code_col: str = "CODIGO_CONTABIL",
                  tie_order: Sequence[str] = ("DATA_BASE", "V_INICIAL", "V_FINAL", "DESCRICAO"),
                  keep_ties: bool = False, split_length: int = 4) -> DataFrame:
    """Keep leaf accounts only (W1): within a group (one file, one
    operator), drop a row when another code of the group extends its code.

    Sorted byte-wise, the codes that extend *p* directly follow *p*, so a
    code is a parent exactly when the next distinct code starts with it.

    * Equal codes in a group (D2): one row per code survives, the last in
      ``tie_order`` (NULLs first).  ``row_number() == 1`` per code is
      planned with a partial WindowGroupLimit, so each map task sends at
      most one row per code.  ``keep_ties=True`` keeps all equal rows.
    * "Next" is a ``lead`` over (group, first ``split_length`` characters),
      so a group with a large share of the rows is not one task's work.  A
      code shorter than that may be extended in another part: the first code
      of each part (few, whatever the group's size) looks at the next part's
      leading characters in a second window.

    The windows sort by ``group_cols`` in the given order: with the column of
    most values first, most comparisons end at the sort prefix.

    Rows with a NULL group key or code are dropped (D16).
    """
    keys = [*group_cols, code_col]
    clean = df.where(" AND ".join(f"{sql_ident(k)} IS NOT NULL" for k in keys))
    head = [*group_cols, "_head"]
    clean = clean.withColumn("_head", F.substring(code_col, 1, split_length))
    once = Window.partitionBy(*head, code_col).orderBy(*[F.col(x).desc_nulls_last() for x in tie_order if x in df.columns] or [F.lit(0)])
    codes = clean.select(*head, code_col).distinct() if keep_ties else \
        clean.withColumn("_nth", F.row_number().over(once)).where("_nth = 1").drop("_nth")
    within = Window.partitionBy(*head).orderBy(code_col)
    placed = codes.withColumn("_next", F.lead(code_col).over(within)).withColumn("_place", F.row_number().over(within))
    firsts = Window.partitionBy(*group_cols, F.expr("CASE WHEN _place = 1 THEN '' ELSE _head END")).orderBy("_head")
    c = sql_ident(code_col)
    leaves = placed.withColumn("_next_head", F.lead("_head").over(firsts)).where(
        f"NOT coalesce(startswith(_next, {c}), false) "
        f"AND NOT (length({c}) < {split_length} AND coalesce(startswith(_next_head, {c}), false))")
    if keep_ties:
        return clean.join(leaves.select(*keys), keys, "left_semi").select(*df.columns)
    return leaves.select(*df.columns)


def normalize_accounts(lines: DataFrame, prefix: str = EXPENSE_ACCOUNT_PREFIX,
                       thousands: str = ".", decimal: str = ",",
                       keep_ties: bool = False) -> DataFrame:
    """Whole normalisation of account lines read as text (Q9).

    Order as in the source pipeline: header clean-up, code column check,
    prefix filter, renaming, locale number parsing (bad -> 0), leaf filter
    per (file, operator), ``VALOR_DESPESAS = V_FINAL - V_INICIAL``, rows
    with a zero measure dropped, fixed column order.
    """
    df = normalize_headers(lines)
    if find_code_column(df.columns) is None:
        raise ValueError(f"no account code column among {df.columns}")
    df = harmonize_columns(df)
    missing = {"REGISTRO_OPERADORA", "CODIGO_CONTABIL", "V_INICIAL", "V_FINAL"} - set(df.columns)
    if missing:
        raise ValueError(f"account lines lack {sorted(missing)}")
    df = filter_account_prefix(df, prefix=prefix)
    df = df.withColumns({
        "REGISTRO_OPERADORA": text_to_long("REGISTRO_OPERADORA"),
        "V_INICIAL": parse_locale_decimal("V_INICIAL", thousands=thousands, decimal=decimal),
        "V_FINAL": parse_locale_decimal("V_FINAL", thousands=thousands, decimal=decimal),
    })
    for c in ("DATA_BASE", "DESCRICAO"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    if "source_file" not in df.columns:
        df = df.withColumn("source_file", F.lit(None).cast("string"))
    # files are told apart by their path: base names may repeat
    by_path = "source_path" in df.columns
    leaves = leaf_accounts(df, ("REGISTRO_OPERADORA", "source_path" if by_path else "source_file"),
                           keep_ties=keep_ties, split_length=len(prefix) + 1)
    out = leaves.withColumn("VALOR_DESPESAS", (F.col("V_FINAL") - F.col("V_INICIAL")).cast("decimal(18,2)")) \
        .filter(F.col("VALOR_DESPESAS") != 0)
    return out.select("source_file", *(["source_path"] if by_path else []), *OUTPUT_COLUMNS)


REQUIRED_COLUMNS = ("REGISTRO_OPERADORA", "CODIGO_CONTABIL", "V_INICIAL", "V_FINAL")


def harmonize_file_group(df: DataFrame) -> DataFrame | None:
    """Per-header-group hook for the file reader: canonical names before
    files with different headers are unioned.  Files without a code column
    or without both balances, or whose headers map two columns to one
    name (D13), are skipped whole, as the source pipeline skips them
    (returns None; the reader lists them)."""
    if find_code_column(df.columns) is None:
        return None
    try:
        out = harmonize_columns(df)
    except ValueError:
        return None
    if any(c not in out.columns for c in REQUIRED_COLUMNS):
        return None
    return out


def dropped_null_operator(lines: DataFrame) -> DataFrame:
    """Account lines the leaf filter drops for lacking an operator id (D16),
    for the quarantine."""
    df = harmonize_columns(normalize_headers(lines))
    return filter_account_prefix(df).filter(text_to_long("REGISTRO_OPERADORA").isNull()) \
        .withColumn("reject_reason", F.lit("null_operator"))


def overflowing_amounts(lines: DataFrame) -> DataFrame:
    """Account lines with a balance that is a number but beyond the amount type (P5), for the quarantine.
    :func:`normalize_accounts` gives them no measure."""
    df = filter_account_prefix(harmonize_columns(normalize_headers(lines)))
    beyond = [F.col(c).isNotNull() & parse_locale_decimal(c).isNull() for c in ("V_INICIAL", "V_FINAL")]
    return df.where(beyond[0] | beyond[1]).withColumn("reject_reason", F.lit("amount_overflow"))


def expense_or_corrupt(text: DataFrame, prefix: str = EXPENSE_ACCOUNT_PREFIX) -> DataFrame:
    """Of lines as read: those with an expense account, and those that did not fit their file's header."""
    if "CODIGO_CONTABIL" not in text.columns:
        return text
    kept = filter_account_prefix(text.where("_corrupt_record IS NULL"), prefix=prefix)
    return kept.unionByName(text.where("_corrupt_record IS NOT NULL"))


def source_id(path_col: str = "source_path"):
    """Partition value of a file: its stem as a label, and a digest of its path, so that files with one name
    in two folders stay apart."""
    return F.concat(file_stem(path_col), F.lit("-"), F.substring(F.md5(path_col), 1, 12))

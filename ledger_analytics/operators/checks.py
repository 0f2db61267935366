"""Table rules as data jobs (C1–C4, J7): each returns the violations as a
DataFrame instead of aborting a load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row (C1), with the row count.
    NULL keys are not reported (a UNIQUE rule ignores them)."""
    keyed = df
    for k in keys:
        keyed = keyed.filter(F.col(k).isNotNull())
    return keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def _long(df: DataFrame, exprs: Mapping[str, F.Column], value_name: str) -> DataFrame:
    """One aggregation pass, then one row per checked column."""
    names = list(exprs)
    wide = df.agg(*[e.alias(f"_v{i}") for i, e in enumerate(exprs.values())])
    stack = ", ".join(f"'{n}', _v{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {stack}) AS (column_name, {value_name})")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count per NOT NULL column (C2), in a single scan."""
    return _long(df, {c: F.count_if(F.col(c).isNull()) for c in columns}, "n_null")


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows longer than the declared width per column (C3), single scan."""
    out = _long(df, {c: F.count_if(F.length(F.col(c)) > n) for c, n in limits.items()}, "n_violations")
    widths = ", ".join(f"'{c}', {n}" for c, n in limits.items())
    sizes = df.sparkSession.sql(f"SELECT stack({len(limits)}, {widths}) AS (column_name, max_length)")
    return out.join(F.broadcast(sizes), "column_name")


def orphan_rows(facts: DataFrame, dimension: DataFrame, fact_key, dim_key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (J7 / C4): a left anti join.
    ``fact_key`` may be an expression (e.g. a cast of a text key)."""
    fk = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    keys = dimension.select(F.col(dim_key).alias("_dim_key")).filter(F.col("_dim_key").isNotNull())
    return facts.join(keys, fk == F.col("_dim_key"), "left_anti")


def watched(df: DataFrame, not_null: Sequence[str] = (), limits: Mapping[str, int] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` and the counts of its C2 and C3 violations, taken while it is
    written: the rules need no scan of their own.  The frame is to be written
    once, as it is."""
    seen = Observation()
    rules = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in not_null]
    rules += [F.count_if(F.length(F.col(c)) > n).alias(f"width:{c}") for c, n in (limits or {}).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows:"), *rules), seen


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    """``key, n`` of the non-NULL keys: the key set that is kept over loads."""
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def merged_keys(kept: DataFrame | None, new: DataFrame) -> DataFrame:
    """The key set after another load, from the two key sets alone (C1 over
    all loads: the keys with ``n > 1``)."""
    both = new if kept is None else kept.unionByName(new)
    return both.groupBy("key").agg(F.sum("n").alias("n"))


def report_of(seen: Observation, keys: DataFrame, key: str) -> list[tuple[str, str, int]]:
    """(rule, column, violations) of a written load; ``rows`` counts its rows."""
    found = [(*name.split(":", 1), n) for name, n in seen.get.items()]
    return found + [("unique", key, keys.where("n > 1").count())]

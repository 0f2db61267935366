"""The loaded star schema as SQL views (S7: SQL text as a source).

``register_star_schema`` makes ``operadoras``, ``despesas_consolidadas``,
``despesas_agregadas`` and the statistics view ``vw_despesas_estatisticas``
available to ``spark.sql``, so analytical SQL can run over the tables the
batch run wrote.  Views are session-scoped and lazy: nothing is read until
a query runs, and Catalyst inlines the view into each query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sinks.versions import VersionedTables
from .analytics import operator_statistics

TABLES = ("operadoras", "despesas_consolidadas", "despesas_agregadas")
STATISTICS_VIEW = "vw_despesas_estatisticas"


def star_tables(spark: SparkSession, db_dir: str) -> dict[str, DataFrame]:
    """The tables under ``db_dir``, as one version of it
    (:func:`ledger_analytics.plans.batch.publish_star_schema`) or as plain
    folders (:func:`ledger_analytics.plans.batch.load_star_schema`)."""
    published = VersionedTables(spark, db_dir)
    version = published.current()
    found = {t: published.read(t, version) if version else spark.read.parquet(f"{db_dir.rstrip('/')}/{t}") for t in TABLES}
    missing = [t for t, df in found.items() if df is None]
    if missing:
        raise ValueError(f"no rows of {missing} in version {version}")
    return found


def register_star_schema(spark: SparkSession, db_dir: str) -> dict[str, DataFrame]:
    """Register the tables under ``db_dir`` (:func:`star_tables`) and the
    statistics view; returns the DataFrames by view name."""
    frames = star_tables(spark, db_dir)
    frames[STATISTICS_VIEW] = operator_statistics(frames["despesas_consolidadas"], frames["operadoras"]) \
        .drop("cod_operadora")
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames

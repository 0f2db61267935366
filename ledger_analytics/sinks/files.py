"""Writers for the pipeline stages (K1–K8).

Parquet is the stage format (typed, column-pruned, predicate-pushed);
``;``-separated CSV is an export only.  Re-runs overwrite only the
partitions they write (dynamic partition overwrite), so loading a period
twice does not double it (D10).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                  compression: str = "zstd") -> None:
    """Stage output (K1, K3, K5, K6).  With ``partition_by`` and mode
    ``overwrite`` only the partitions present in ``df`` are replaced."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def write_rejects(df: DataFrame, path: str) -> bool:
    """Quarantine / log output (K2, K4); returns whether it has rows.  It is
    written in one pass and always, so a clean re-run leaves an empty
    output, not the rows of an earlier run."""
    write_parquet(df, path)
    return not df.sparkSession.read.parquet(path).isEmpty()


def export_csv(df: DataFrame, path: str, sep: str = ";", compression: str | None = None,
               partition_by: Sequence[str] = ()) -> None:
    """CSV export with a header (K3, K6 text copies; K7 with
    ``compression='gzip'``).  Spark writes no byte-order mark."""
    w = df.write.mode("overwrite").option("header", "true").option("sep", sep)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None,
               mode: str = "overwrite") -> None:
    """Star-schema table (K8).  Partitioned tables are overwritten per
    partition, so a re-run of one period replaces that period only."""
    spark = df.sparkSession
    if partition_by and mode == "overwrite" and spark.catalog.tableExists(name):
        # inserts into a table take the mode from the session alone; it is put back as it was
        mode_key = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode_key)
        spark.conf.set(mode_key, "dynamic")
        try:
            df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(mode_key, before)
        return
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)

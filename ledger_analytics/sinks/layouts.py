"""Layouts that spare reads and shuffles (L1): files by key range with a table of
their ranges, and bucketed tables that join as they lie."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sql_ident

#: hidden from Spark's readers by its name
RANGES = "_ranges"


def write_clustered(df: DataFrame, path: str, by: str, files: int | None = None, blooms: Sequence[str] = ()) -> None:
    """Write ``df`` in files that hold one range of ``by`` each, sorted by it,
    with Parquet bloom filters on ``blooms``, and a small table of every file's
    range.  Rows with one key are dealt over several files if they are many (a
    hash of the row is the second range key).  Rows without a key are in files
    of their own or beside others and are found by scans only."""
    spread = [F.col(by), F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(files, *spread) if files else df.repartitionByRange(*spread)
    w = ranged.sortWithinPartitions(by).write.mode("overwrite").option("compression", "zstd")
    for c in blooms:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    k = sql_ident(by)
    ranges = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.expr(f"min({k})").alias("low"), F.expr(f"max({k})").alias("high"), F.count(F.lit(1)).alias("n_rows"))
    ranges.coalesce(1).sortWithinPartitions("low").write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RANGES}")


def files_with(spark: SparkSession, path: str, values: Sequence) -> list[str]:
    """The files of a clustered folder whose range may hold one of the values."""
    may = F.lit(False)
    for v in values:
        may = may | F.lit(v).between(F.col("low"), F.col("high"))
    found = spark.read.parquet(f"{path.rstrip('/')}/{RANGES}").where(may).select("file").collect()
    return sorted(unquote(r.file) for r in found)


def read_at(spark: SparkSession, path: str, by: str, values: Sequence) -> DataFrame:
    """The rows of a clustered folder (:func:`write_clustered`) with one of a few
    key values; no other file is opened."""
    schema = spark.read.parquet(path).schema
    files = files_with(spark, path, values)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(F.col(by).isin(list(values)))


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """A table whose rows lie in ``buckets`` files by the hash of ``key``, sorted
    by it.  Tables with one number of buckets join and group by the key without
    an exchange.  Returns the table."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)

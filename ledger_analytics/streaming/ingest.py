"""Incremental ingest of quarterly account files with Structured Streaming.

The source application re-reads everything each run.  Here a file stream
watches the landing folder; each micro-batch holds whole new files (the
file source never splits a file across batches), and since the leaf filter
groups by (file, operator), normalising a batch on its own gives exactly
the rows a full run would give for those files.  Each batch overwrites
only its own ``source_id`` partitions (one per path), so a retried batch
does not duplicate rows; files that cannot be used and lines that don't fit
are written beside it per batch, and the checkpoint records which files were processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.normalize import harmonize_file_group, normalize_accounts, source_id
from ..sinks.files import write_parquet
from ..sources.files import _glob, read_delimited_paths


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, landing_dir: str, exts=("csv", "txt"), max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming listing of files arriving under ``landing_dir``.  Only the
    ``path`` column is selected, so file contents are not read here."""
    return (spark.readStream.format("binaryFile")
            .schema(BINARY_FILE_SCHEMA)
            .option("pathGlobFilter", _glob(exts))
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(landing_dir)
            .select("path"))


def normalize_batch(out_dir: str):
    def handle(batch: DataFrame, epoch_id: int) -> None:
        # the batch lists at most maxFilesPerTrigger paths: metadata only
        paths = [r["path"] for r in batch.select("path").distinct().collect()]
        if not paths:
            return
        spark = batch.sparkSession
        skipped: list = []
        lines = read_delimited_paths(spark, paths, per_group=harmonize_file_group, skipped=skipped)
        rejects = f"{out_dir.rstrip('/')}_rejects/batch={epoch_id}"
        write_parquet(spark.createDataFrame(skipped, "path string, reason string"), f"{rejects}/skipped_files")
        write_parquet(lines.where("_corrupt_record IS NOT NULL"), f"{rejects}/corrupt_lines")
        if "CODIGO_CONTABIL" not in lines.columns:
            return
        out = normalize_accounts(lines.where("_corrupt_record IS NULL")).withColumn("source_id", source_id())
        write_parquet(out, out_dir, partition_by=["source_id"])
    return handle


def start_ingest(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_dir: str,
                 available_now: bool = True, max_files_per_trigger: int = 64) -> StreamingQuery:
    """Start the ingest stream.  ``available_now=True`` processes what is
    there and stops (scheduled runs); otherwise it polls every minute."""
    w = (new_files(spark, landing_dir, max_files_per_trigger=max_files_per_trigger).writeStream
         .foreachBatch(normalize_batch(out_dir))
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

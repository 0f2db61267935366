"""Account files that are sent again, over the stages of a batch run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corrections as R
from ..operators.consolidate import attach_registry
from ..operators.normalize import expense_or_corrupt, harmonize_file_group, normalize_accounts, source_id
from ..session import ensure_checkpoint_dir
from ..sinks.files import write_parquet, write_rejects
from ..sources.files import read_delimited_paths, read_registry
from .batch import BatchResult, publish_consolidated, table_if_any

#: partition columns of the stages a correction writes
TABLES = {"normalized": ("source_id",), "nets": ("Ano", "Trimestre"), "consolidated": ("Ano", "Trimestre")}


def resend_files(spark: SparkSession, paths: Sequence[str], registry_path: str, out_dir: str, on_unmatched: str = "drop",
                 export: bool = True) -> BatchResult:
    """Take account files again that a batch run (:func:`~ledger_analytics.plans.batch.run_batch`)
    has read from the same paths, and bring its stages up to date.

    The files' old lines are read from ``normalized/`` (their partitions
    only), the change set against the new ones is netted, and the touched keys
    are joined with the registry again.  Of ``nets/`` and ``consolidated/``
    the touched periods are written, with their other rows as they are.

    All that will be replaced is written to ``pending/`` first, its plan last;
    then the partitions are replaced from there.  A run that was broken off
    leaves the old stages, or a plan, which the next call carries out before
    anything else: carrying it out again gives the same stages.  A file that
    is gone, or not usable any more, counts as one without lines.
    """
    out, res = out_dir.rstrip("/"), BatchResult()
    ensure_checkpoint_dir(spark)
    carry_out(spark, out)
    listed = [_listed(spark, p) for p in paths]
    files = spark.createDataFrame([(name,) for name, _ in listed], "source_path string")
    ids = [r[0] for r in files.select(source_id()).distinct().collect()]  # a row for each file asked for
    new = _lines(spark, [p for p, (_, there) in zip(paths, listed) if there], out, res)
    schema = spark.read.parquet(f"{out}/normalized").schema
    old = spark.read.parquet(f"{out}/normalized").where(F.col("source_id").isin(ids)).drop("source_id")
    new = old.limit(0) if new is None else new.select(*old.columns)
    new = new.checkpoint()
    changes = R.net_changes(old, new).checkpoint()
    periods = [tuple(r) for r in changes.select("Ano", "Trimestre").distinct().collect()]  # at most all quarters there are
    inside = F.struct("Ano", "Trimestre").isin([F.struct(F.lit(a), F.lit(q)) for a, q in periods]) if periods else F.lit(False)
    nets, consolidated = (spark.read.parquet(f"{out}/{t}").where(inside) for t in ("nets", "consolidated"))
    registry = read_registry(spark, registry_path).where("_corrupt_record IS NULL").drop("_corrupt_record")
    later = R.changed_nets(nets, changes).checkpoint()
    again = attach_registry(later, registry, on_unmatched)
    write_parquet(new.withColumn("source_id", source_id()).select(*schema.names), f"{out}/pending/normalized")
    write_parquet(R.untouched(nets, changes).select(*later.columns).unionByName(later), f"{out}/pending/nets")
    write_parquet(R.untouched(consolidated, changes).select(*again.columns).unionByName(again), f"{out}/pending/consolidated")
    plan = [("normalized", f"source_id={i}") for i in ids] + [(t, f"Ano={a}/Trimestre={q}") for t in ("nets", "consolidated") for a, q in periods]
    write_parquet(spark.createDataFrame(plan, "stage string, part string"), f"{out}/pending/plan")
    carry_out(spark, out)
    publish_consolidated(spark, out, res, export)
    return res


def _listed(spark: SparkSession, path: str) -> tuple[str, bool]:
    """A path as the stages name it, and whether a file is there."""
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    place = as_path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # read back from its text, the name has the form that listings give
    return as_path(system.makeQualified(place).toString()).toUri().toString(), system.exists(place)


def _lines(spark: SparkSession, paths: list[str], out: str, res: BatchResult) -> DataFrame | None:
    skipped: list = []
    text = read_delimited_paths(spark, paths, per_group=harmonize_file_group, skipped=skipped) if paths else None
    res.skipped_files = skipped
    if text is None or "CODIGO_CONTABIL" not in text.columns:
        return None
    lines = expense_or_corrupt(text).checkpoint()
    res.written["corrupt_resent_lines"] = write_rejects(
        lines.where("_corrupt_record IS NOT NULL").select("source_path", "_corrupt_record"), f"{out}/quarantine/corrupt_resent_lines")
    return normalize_accounts(lines.where("_corrupt_record IS NULL"))


def carry_out(spark: SparkSession, out_dir: str) -> bool:
    """Replace the partitions a pending plan names; whether there was one."""
    out = out_dir.rstrip("/")
    plan = table_if_any(spark, f"{out}/pending/plan")
    parts = plan.collect() if plan is not None else []  # a row for each file and period
    if not parts:
        return False
    for table, keys in TABLES.items():
        rows = spark.read.parquet(f"{out}/pending/{table}")
        held = {"/".join(f"{k}={v}" for k, v in zip(keys, r)) for r in rows.select(*keys).distinct().collect()}
        write_parquet(rows, f"{out}/{table}", partition_by=keys)
        for p in parts:
            if p.stage == table and p.part not in held:  # nothing is left there
                write_parquet(rows.drop(*keys).limit(0), f"{out}/{table}/{p.part}")
    write_parquet(spark.createDataFrame([], plan.schema), f"{out}/pending/plan")
    return True

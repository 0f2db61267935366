"""SparkSession defaults shared by tests, the bench and the examples.

On a cluster the session is created by the platform; the helpers here only
fill in settings that are unset, so cluster-wide values always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that shape the physical plan.  AQE re-plans joins from measured
# shuffle sizes (runtime broadcast, skew-split, partition coalescing), which
# is what keeps the fact<->dimension joins right at any data size.
PLAN_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}
# Only for sessions this package creates (tests, bench): results carry no
# timestamps, so other sessions keep their own time zone.
LOCAL_DEFAULTS = {"spark.sql.session.timeZone": "UTC"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledger-analytics", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in {**PLAN_DEFAULTS, **LOCAL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_plan_defaults(spark: SparkSession) -> SparkSession:
    """Fill in PLAN_DEFAULTS where the session has no value of its own."""
    for k, v in PLAN_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only on a ``local`` master may it
    be unset, and a fresh scratch folder is created.  Elsewhere executors
    would write to their own disks, so an unset folder is an error.  Set
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` to have checkpoints
    removed once nothing refers to them (:func:`local_session` does).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ledger-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job of this session wrote, in whatever store it is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def scale_settings(input_bytes: int, total_cores: int, partition_bytes: int = 512 * 1024 * 1024,
                   max_partitions: int = 65536) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Input splits and shuffle partitions aim at ``partition_bytes`` each
    (default 512 MiB, comfortable for executors of 8+ GiB per core with
    spill), with at least two tasks per core and at most ``max_partitions``
    shuffle partitions (shuffle block count grows with map x reduce).  AQE
    then coalesces the small post-aggregation stages to the advisory size
    and splits skewed join partitions above 4x the median.

    Example: 100 TB on 1,000 executors x 8 cores gives 65,536 shuffle
    partitions (the cap), so a shuffle of the whole input has partitions of
    about 1.6 GB, and 512 MiB input splits.
    """
    want = -(-input_bytes // partition_bytes)
    shuffle = max(2 * total_cores, min(max_partitions, want))
    size = f"{partition_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * partition_bytes // (1024 * 1024)}m",
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int, total_cores: int, **kw) -> SparkSession:
    """Set :func:`scale_settings` on a running session (runtime SQL confs)."""
    for k, v in scale_settings(input_bytes, total_cores, **kw).items():
        spark.conf.set(k, v)
    return spark

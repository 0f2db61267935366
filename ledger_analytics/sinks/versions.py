"""Tables that change together (K8): all outputs of a load become visible at once.

A load writes its rows to folders of its own, ``data/<table>/load=<id>/``, and
never touches those of others.  A version is a small list of the folders that
are in force for each table; writing that list is the only step that readers
see.  A load that ends before it leaves the last version as it was, and its
folders are never listed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .files import write_parquet

LIST = "table string, part string"


class VersionedTables:
    """The tables below a folder.  One load at a time may publish: a second one
    that began from the same version fails when it tries."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        """Numbers of the versions that are complete, in order."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions/*/_SUCCESS")
        found = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(int(f.getPath().getParent().getName()) for f in found or [])

    def _listed(self, version: int) -> list[tuple[str, str]]:
        """(table, part) of a version: a row for each load's folder or partition in force."""
        if not version:
            return []
        return [tuple(r) for r in self.spark.read.schema(LIST).parquet(f"{self.root}/versions/{version:010d}").collect()]

    def current(self) -> int:
        """The last version, 0 if there is none."""
        return max(self.versions(), default=0)

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        """A table as of a version (the last one, asked for once); None if it has no rows there."""
        parts = [p for t, p in self._listed(self.current() if version is None else version) if t == table]
        if not parts:
            return None
        base = f"{self.root}/data/{table}"
        return self.spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*[f"{base}/{p}" for p in parts]).drop("load")

    def begin(self) -> Load:
        return Load(self)


class Load:
    """The folders of one load, until they are published."""

    def __init__(self, tables: VersionedTables):
        self.tables, self.id = tables, f"l{uuid.uuid4().hex}"
        self.base = tables.current()
        self.parts = tables._listed(self.base)

    def write(self, table: str, df: DataFrame, mode: str = "replace", partition_by: Sequence[str] = ()) -> DataFrame:
        """Write this load's rows of a table and read them back.  ``replace``:
        they are the whole table; ``append``: they come beside the rows of
        earlier loads; ``partitions``: they replace the partitions they have."""
        if mode not in ("replace", "append", "partitions") or mode == "partitions" and not partition_by:
            raise ValueError(f"no such mode, or no partitions: {mode}")
        folder = f"{self.tables.root}/data/{table}/load={self.id}"
        write_parquet(df, folder, partition_by=partition_by)
        rows = self.tables.spark.read.schema(df.schema).parquet(folder)
        own = [f"load={self.id}"]
        if mode == "partitions":  # a folder for each partition, as many as there are periods
            own = [f"load={self.id}/" + "/".join(f"{k}={v}" for k, v in zip(partition_by, r)) for r in rows.select(*partition_by).distinct().collect()]
        held = {p.split("/", 1)[1] for p in own if "/" in p}
        stay = {"append": lambda p: True, "replace": lambda p: False, "partitions": lambda p: p.split("/", 1)[-1] not in held}[mode]
        self.parts = [(t, p) for t, p in self.parts if t != table or stay(p)] + [(table, p) for p in own]
        return rows

    def publish(self) -> int:
        """Make all that was written the next version."""
        rows = self.tables.spark.createDataFrame(self.parts, LIST).coalesce(1)
        (rows.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
         .parquet(f"{self.tables.root}/versions/{self.base + 1:010d}"))
        return self.base + 1

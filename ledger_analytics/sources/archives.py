"""ZIP archive input (S3).

Every ``.zip`` under a folder is opened by a Spark task (``binaryFile``
gives one row per archive, so archives are processed in parallel) and its
members are written to ``<dest>/<archive stem>/``; the CSV reader then
reads the extracted files with normal input splits.  A corrupt archive is
reported as a status row, not an exception, and does not stop the others.
Only the path reaches the task, which opens the archive as a seekable
stream and copies its members in 1 MiB chunks, so memory does not grow with
the archive.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

STATUS_SCHEMA = "archive string, member string, bytes long, status string, error string"


def _extract(dest_root: str):
    def run(batches):
        import posixpath
        import zipfile

        import pyarrow as pa
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(dest_root)
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                name = posixpath.basename(path)
                stem = name[:-4] if name.lower().endswith(".zip") else name
                try:
                    source, inner = pafs.FileSystem.from_uri(path)
                    with source.open_input_file(inner) as archive, zipfile.ZipFile(archive) as zf:
                        for info in zf.infolist():
                            if info.is_dir():
                                continue
                            # keep members inside the archive folder
                            member = posixpath.normpath(info.filename).lstrip("/")
                            if member == ".." or member.startswith("../"):
                                rows.append((path, info.filename, 0, "skipped", "path outside archive"))
                                continue
                            target = posixpath.join(root, stem, member)
                            fs.create_dir(posixpath.dirname(target), recursive=True)
                            with zf.open(info) as src, fs.open_output_stream(target) as dst:
                                size = 0
                                while True:
                                    chunk = src.read(1 << 20)
                                    if not chunk:
                                        break
                                    dst.write(chunk)
                                    size += len(chunk)
                            rows.append((path, member, size, "extracted", None))
                except (zipfile.BadZipFile, pa.ArrowInvalid) as e:
                    rows.append((path, None, 0, "corrupt", str(e)))
                except Exception as e:  # noqa: BLE001 - reported per archive
                    rows.append((path, None, 0, "error", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["archive", "member", "bytes", "status", "error"])
    return run


def extract_archives(spark: SparkSession, source_dir: str, dest_dir: str) -> DataFrame:
    """Extract every ``*.zip`` in ``source_dir`` (not recursive, like the
    source pipeline) into ``dest_dir/<stem>/``.  Returns one status row per
    member (or per failed archive).  Lazy: run an action to extract."""
    archives = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
                .load(source_dir).select("path"))
    return archives.mapInPandas(_extract(dest_dir), STATUS_SCHEMA)

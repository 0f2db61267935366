"""Delimited-text sources.

Files are listed by Spark (``binaryFile`` without its content column, so
only the listing runs), the first line of each file is read by a
distributed job (one small read per file, in parallel), and the data
itself is read by Spark's CSV reader, one reader per (delimiter, header)
group, all strings, then harmonised and unioned by name.  Files with line
breaks inside quoted values are found by their lines with quotes and cut
into records in splits (:mod:`~ledger_analytics.sources.records`), so that
no file is ever one task.

Quoting is the usual one of spreadsheets and ``COPY ... CSV``: values may
stand in double quotes, a quote inside is doubled, a backslash is an
ordinary character.  A line that does not fit its header is kept whole in
the column ``_corrupt_record``; a file that cannot be used is listed with
the reason.  Neither is ever dropped unseen.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_header
from ..session import ensure_checkpoint_dir
from .records import cut_records, files_with_open_lines

# Candidate delimiters, in tie-break order.
DELIMITERS = (";", ",", "\t", "|")
DATA_EXTENSIONS = ("csv", "txt")
# Workbooks are no text and are listed as skipped (no distributed reader).
UNREAD_EXTENSIONS = ("xlsx", "xls")
CORRUPT = "_corrupt_record"
CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
# A line is judged by all its values, whichever columns a query reads.
FILE_OPTIONS = {**CSV_OPTIONS, "columnPruning": "false"}
#: a first line beyond this is no header; the file is listed as skipped
HEADER_BYTES = 1 << 20
LINEAGE = ("source_file", "source_path")


def _glob(exts: Iterable[str]) -> str:
    variants = sorted({v for e in exts for v in (e.lower(), e.upper())})
    return "*.{" + ",".join(variants) + "}"


def list_files(spark: SparkSession, root: str, exts: Sequence[str] = DATA_EXTENSIONS) -> DataFrame:
    """Recursive listing of files under ``root`` with one of ``exts``.
    Returns ``path, length, modificationTime``; file contents are not read."""
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", _glob(exts))
            .load(root)
            .select("path", "length", "modificationTime"))


def _first_line(path: str) -> bytes:
    import pyarrow.fs as pafs

    # Spark lists plain paths; only one with a scheme is read as a URI
    fs, inner = pafs.FileSystem.from_uri(quote(path, safe=":/") if re.match("[A-Za-z][A-Za-z0-9+.-]*:", path) else path)
    with fs.open_input_stream(inner) as f:
        line = b""
        while b"\n" not in line:
            if len(line) > HEADER_BYTES:
                raise ValueError(f"first line longer than {HEADER_BYTES} bytes")
            chunk = f.read(1 << 16)
            if not chunk:
                break
            line += chunk
    return line.split(b"\n", 1)[0].rstrip(b"\r").removeprefix(b"\xef\xbb\xbf")


def _first_lines(batches):
    for pdf in batches:
        out = []
        for path in pdf["path"]:
            try:
                out.append((path, _first_line(path).decode("utf-8", errors="replace"), None))
            except Exception as e:  # noqa: BLE001 - reported per file
                out.append((path, None, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(out, columns=["path", "header_line", "error"])


def file_headers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """First line of every listed file plus its most frequent delimiter.

    Runs as one Spark job: each task opens its files and reads each up to
    its first line break.  Delimiter choice: the candidate occurring most often in
    the header line (ties in :data:`DELIMITERS` order).
    """
    heads = files.select("path").mapInPandas(
        _first_lines, "path string, header_line string, error string")
    counts = [F.size(F.split(F.col("header_line"), re.escape(d))) - 1 for d in DELIMITERS]
    best = F.greatest(*counts)
    choice = F.coalesce(*[F.when((c == best) & (best > 0), F.lit(d)) for c, d in zip(counts, DELIMITERS)])
    return heads.withColumn("delimiter", choice)


def _reader(spark: SparkSession, schema: T.StructType, sep: str, encoding: str):
    return (spark.read.schema(schema).options(**FILE_OPTIONS).option("header", "true").option("enforceSchema", "true")
            .option("sep", sep).option("encoding", encoding))


def _placed(df: DataFrame) -> DataFrame:
    """A row's file and its place in the input: file path, block, place in the block.  Spark deals large splits
    out first, so a running number alone would not follow the files."""
    return df.withColumn("source_path", F.col("_metadata.file_path")).withColumn(
        "reg_order", F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                              F.monotonically_increasing_id().alias("place")))


def _lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """Text lines with their breaks, ``path, block, place, value``; a byte-order mark is no part of the text."""
    own = F.make_valid_utf8("value") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(F.col("value").cast("binary"), encoding)
    bom = "\ufeff"
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.concat(own, F.lit("\n")).alias("value"))
    return lines.withColumn("value", F.when((F.col("block") == 0) & F.col("value").startswith(bom), F.expr("substr(value, 2)")).otherwise(F.col("value")))


def read_csv(spark: SparkSession, paths: Sequence[str], schema: T.StructType, sep: str, encoding: str = "UTF-8",
             line_breaks: bool = True) -> DataFrame:
    """Files with a header line as text columns by position, plus ``source_path``
    and ``reg_order`` (the row's place in the input).  ``schema`` ends with
    ``_corrupt_record``.

    A first scan looks at lines with a quote only and names the files in which
    one ends inside a quoted value.  Their lines are stored and cut into
    records block by block; all others are read line by line as they are.
    ``line_breaks=False`` skips the scan where values are known to have none.
    A quoted value that never ends makes the rest of its file one corrupt
    record.  Lines end with LF or CR LF.  Files in UTF-16 or UTF-32, whose line
    breaks can't be told by their bytes, are read one task a file.
    """
    paths = list(paths)
    reader = _reader(spark, schema, sep, encoding)
    if re.match("utf-?(16|32)", encoding, re.I):
        return _placed(reader.option("multiLine", "true").csv(paths))
    plain = reader.csv(paths)
    found = [r.path for r in files_with_open_lines(_lines(spark, paths, encoding), sep).collect()] if line_breaks else []  # paths, as the listing
    if not found:
        return _placed(plain)
    ensure_checkpoint_dir(spark)
    # splits depend on the session's cores, so the lines are stored before they are numbered by split
    lines = _lines(spark, paths, encoding).where(F.col("path").isin(found)).checkpoint()
    options = {**CSV_OPTIONS, "sep": sep}
    ddl = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    rows = cut_records(lines, sep, whole_lines=True).where(~F.col("first")).withColumn("r", F.from_csv("value", ddl, options))
    columns = [F.when(~F.col("broken"), F.col("r")[f.name]).alias(f.name) for f in schema.fields[:-1]]
    corrupt = F.when(F.col("broken"), F.col("value")).otherwise(F.col("r")[CORRUPT]).alias(CORRUPT)
    cut = rows.select(*columns, corrupt, F.col("path").alias("source_path"), F.struct("path", "block", "place").alias("reg_order"))
    return _placed(plain.where(~F.col("_metadata.file_path").isin(found))).unionByName(cut)


def _read_group(spark: SparkSession, paths: list[str], names: list[str], sep: str, encoding: str) -> DataFrame:
    """Files with one header as positional text columns, their corrupt lines and their lineage:
    the full path identifies a file, its base name is a label."""
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))] + [T.StructField(CORRUPT, T.StringType())])
    return read_csv(spark, paths, schema, sep, encoding).withColumn("source_file", F.element_at(F.split("source_path", "/"), -1))


def read_delimited(spark: SparkSession, root: str, exts: Sequence[str] = DATA_EXTENSIONS,
                   encoding: str = "UTF-8", per_group: Callable[[DataFrame], DataFrame | None] | None = None,
                   skipped: list | None = None) -> DataFrame:
    """All delimited files under ``root`` as one all-string DataFrame (S1+S2).

    Header names are normalised (trim, upper, no quotes; first of equal
    names kept).  Files whose headers differ are read separately and
    unioned by name; missing columns are NULL.  Adds ``source_file`` (base
    name), ``source_path`` (the file's identity) and ``_corrupt_record``.
    ``per_group`` is applied to each header group before the union (e.g.
    renaming columns to canonical names, so differently named files line
    up).  Files that cannot be read, split or used (``per_group`` returns
    None), and workbooks, are left out and listed in ``skipped`` as ``(path,
    reason)``; without such a list they are an error.
    """
    unread = [(r["path"], "workbook: not a text file") for r in list_files(spark, root, UNREAD_EXTENSIONS).select("path").collect()]
    return read_listed(spark, list_files(spark, root, exts), encoding, per_group, skipped, unread)


def read_delimited_paths(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8",
                         per_group: Callable[[DataFrame], DataFrame | None] | None = None,
                         skipped: list | None = None) -> DataFrame:
    """:func:`read_delimited` for an explicit list of files."""
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    return read_listed(spark, files, encoding, per_group, skipped)


def read_listed(spark: SparkSession, files: DataFrame, encoding: str = "UTF-8",
                per_group: Callable[[DataFrame], DataFrame | None] | None = None,
                skipped: list | None = None, unread: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Read the files of a listing (a DataFrame with ``path``)."""
    left_out = list(unread)
    # headers are grouped on the executors; what comes back is one row per distinct header with its
    # paths, the list Spark's reader needs on the driver anyway
    groups = (file_headers(spark, files).groupBy("delimiter", "header_line", "error")
              .agg(F.sort_array(F.collect_list("path")).alias("paths")).collect())
    frames = []
    for g in sorted(groups, key=lambda g: (g["header_line"] or "", g["delimiter"] or "")):
        if g["delimiter"] is None:
            left_out += [(p, g["error"] or "no delimiter in the first line") for p in g["paths"]]
            continue
        raw_names = next(csv.reader([g["header_line"]], delimiter=g["delimiter"]))
        df = _read_group(spark, g["paths"], raw_names, g["delimiter"], encoding)
        names: dict[str, int] = {}
        for place, raw in enumerate(raw_names):
            names.setdefault(normalize_header(raw), place)
        group = df.select(*[F.col(f"_c{i}").alias(n) for n, i in names.items()], *LINEAGE, CORRUPT)
        if per_group is not None:
            group = per_group(group)
            if group is None:
                left_out += [(p, f"columns not usable: {raw_names}") for p in g["paths"]]
                continue
        frames.append(group)
    if left_out and skipped is None:
        raise ValueError(f"files left out: {left_out}")
    if skipped is not None:
        skipped.extend(left_out)
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in (*LINEAGE, CORRUPT)]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_registry(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Operator registry file or folder (S4): all text, header names trimmed
    and upper-cased, plus ``reg_order`` = the row's place in the input.
    Values may hold line breaks inside quotes.  Rows that don't fit are in
    ``_corrupt_record``."""
    head = spark.read.options(**FILE_OPTIONS).option("header", "true").option("sep", sep).option("encoding", encoding)
    names = head.option("multiLine", "true").option("inferSchema", "false").csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*[f"_c{i}" for i in range(len(names))], CORRUPT)])
    df = read_csv(spark, [path], schema, sep, encoding).drop("source_path")
    return df.toDF(*[c.replace("\ufeff", "").strip().upper() for c in names], CORRUPT, "reg_order")


def read_staging(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";",
                 encoding: str = "UTF-8") -> DataFrame:
    """Positional staging load (S6): the header line is skipped and the
    columns take the given names, all text - like ``COPY ... HEADER``.
    Adds ``reg_order`` (place in the input) and ``_corrupt_record``.  Files
    are read in splits, also where quoted values hold line breaks."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT)])
    return read_csv(spark, [path], schema, sep, encoding).drop("source_path")

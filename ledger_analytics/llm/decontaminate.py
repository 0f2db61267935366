"""Benchmark decontamination by winnowing.

Words are runs of ASCII digits and letters (A-Z lower-cased) and of all non-ASCII characters.  A window is
``window`` consecutive words of a benchmark item, or the whole item if it has fewer.  Document words under
any occurrence of a window are hit.

1. Winnowing keeps the least ``gram``-word hash of every sliding window of ``window`` words, of items and of
   documents alike, so every shared span of that length shares a kept hash.  Shorter items are kept whole,
   and documents offer all their sequences of those lengths.
2. Training and benchmark fingerprints join on the hash.  If the benchmark's fingerprints number at most
   ``filter_limit``, documents are filtered by them in the scan; else all fingerprints go to the join.
   The result is the same.
3. Hits are extended to the windows around them (at most one for each word), whose words, as text, join the
   benchmark's distinct windows.  A document and an item that share a kept hash but no window never meet, and
   a window of many items is compared once: it carries a key of its list of items, and the lists are joined to
   the distinct (document, list) pairs at the end.

Defined cases: null and blank texts have no words and no hits; an item without words has no window; a null
``item_id`` is written as the empty string; repeated items with one id count once.  Every input row gives
one output row, repeated rows included; texts of any length are read whole; empty tables are fine.
:func:`drop_contaminated` carries all columns through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import textcore as T

FILTER_LIMIT = 2_000_000


class _Scan:
    """Word hashes of a block of texts."""

    def __init__(self, column):
        data, self.offsets = T.buffers(column)
        self.words = T.words_of(T.LOWER[data], self.offsets, T.ALNUM)
        self.prefix = T.Prefix(self.words.hashes())
        self.n = len(self.words.starts)

    def sequences(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of all sequences of some words within a text."""
        at = np.flatnonzero(self.words.last_window(length))
        return at, self.prefix.slices(at, at + length)

    def kept(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes that winnowing keeps."""
        valid = np.flatnonzero(self.words.last_window(window))
        if not len(valid):
            return valid, np.zeros(0, np.uint64)
        grams = self.prefix.every(gram)
        places = np.unique(T.winnow(grams, window - gram + 1)[valid])
        return places, grams[places]


def _benchmark_prints(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _Scan(batch.column("text"))
            sizes = np.diff(s.words.first)
            places, hashes = s.kept(window, gram)
            owner = np.searchsorted(s.words.first, places, "right") - 1
            short = np.flatnonzero((sizes > 0) & (sizes < window))
            whole = s.prefix.slices(s.words.first[short], s.words.first[short + 1])
            owner, hashes = np.append(owner, short), np.append(hashes, whole)
            lengths = np.append(np.zeros(len(places), np.int64), sizes[short])
            keys = batch.column("item_key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[owner], pa.int64()), pa.array(hashes.view(np.int64)), pa.array(lengths.astype(np.int32))], names=["item_key", "h", "short"]
            )

    return run


def _document_prints(window: int, gram: int, lengths: list[int], wanted: np.ndarray | None):
    names = ["doc_id", "text_key", "n_words", "hits", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.blocks(batch, "text"):
                s = _Scan(part.column("text"))
                found = [s.kept(window, gram), *[s.sequences(m) for m in lengths]]
                places, hashes = (np.concatenate(x) for x in zip(*found))
                sizes = np.repeat([0, *lengths], [len(x) for x, _ in found]).astype(np.int32)
                if wanted is not None:
                    known = T.isin_sorted(hashes, wanted)
                    places, hashes, sizes = places[known], hashes[known], sizes[known]
                owner = np.searchsorted(s.words.first, places, "right") - 1
                order = np.argsort(owner, kind="stable")
                owner, places, hashes, sizes = owner[order], places[order], hashes[order], sizes[order]
                cuts = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                entries = [pa.array(hashes.view(np.int64)), pa.array(places - s.words.first[owner]), pa.array(sizes)]
                hits = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(entries, names=["h", "place", "size"]))
                text = part.column("text").take(pa.array(np.arange(part.num_rows), mask=np.diff(cuts) == 0))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(np.diff(s.words.first)), hits, text], names=names)

    return run


def _spans(text: pa.StringScalar, starts: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Runs of words of a text, joined by one blank."""
    scan = _Scan(pa.array([text.as_py()]))
    raw = scan.words.data.tobytes()
    words = [raw[a:b] for a, b in zip(scan.words.starts.tolist(), scan.words.ends.tolist())]
    line, after = b" ".join(words), np.cumsum([0, *[len(w) + 1 for w in words]])
    return [line[a:b].decode() for a, b in zip(after[starts].tolist(), (after[starts + sizes] - 1).tolist())]


def _in_batches(parts: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Small record batches put together to about ``rows`` rows."""
    some, n = [], 0
    for part in parts:
        some.append(part)
        n += part.num_rows
        if n >= rows:
            yield pa.concat_batches(some)
            some, n = [], 0
    if some:
        yield pa.concat_batches(some)


def _item_windows(window: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words = np.diff(_Scan(batch.column("text")).words.first)
            for item_id, text, n in zip(batch.column("item_id"), batch.column("text"), n_words.tolist()):
                if n:
                    starts = np.arange(max(1, n - window + 1))
                    spans = _spans(text, starts, np.full(len(starts), min(window, n)))
                    yield pa.RecordBatch.from_arrays([pa.array([item_id.as_py()] * len(spans), pa.string()), pa.array(spans, pa.string())], names=["item_id", "words"])

    return lambda batches: _in_batches(each(batches))


def _extend(window: int, gram: int):
    """Windows around the hits of a document: kept grams lie anywhere in a window, short sequences are windows."""
    names = ["row", "place", "size", "words"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, n, own in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("n_words").to_pylist(), batch.column("hits")):
                place, size = (own.values.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("place", "size"))
                around = (place[size == 0][:, None] - np.arange(window - gram + 1)).ravel()
                around = around[(around >= 0) & (around <= n - window)]
                starts, sizes = np.append(around, place[size > 0]), np.append(np.full(len(around), window), size[size > 0])
                starts, sizes = np.unique(np.stack([starts, sizes]), axis=1)
                spans = _spans(text, starts, sizes)
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(spans), pa.int64()), pa.array(starts), pa.array(sizes), pa.array(spans, pa.string())], names=names)

    return lambda batches: _in_batches(each(batches))


def _covered(spans: str) -> str:
    """Words under sorted spans (structs of place and size) of a text, each counted once."""
    return f"""aggregate({spans}, named_struct('n', 0L, 'reach', 0L),
        (a, x) -> named_struct('n', a.n + greatest(0L, x.place + x.size - greatest(a.reach, x.place)), 'reach', greatest(a.reach, x.place + x.size)), a -> a.n)"""


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 13, gram: int = 5, filter_limit: int = FILTER_LIMIT) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, items`` (sorted item ids as strings), a row for each row of ``docs``."""
    ensure_checkpoint_dir(docs.sparkSession)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text is not null").distinct().withColumn("item_key", F.xxhash64("item_id", "text"))
    prints = items.select("item_key", "text").mapInArrow(_benchmark_prints(window, gram), "item_key long, h long, short int").distinct().checkpoint()
    lengths = [r.short for r in prints.where("short > 0").select("short").distinct().collect()]  # at most window - 1 values
    wanted = None
    if prints.count() <= filter_limit:
        wanted = np.unique(np.array([r.h for r in prints.select("h").collect()], np.int64).view(np.uint64))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    # the text rides along only where a fingerprint hit, for the extension
    hits = "hits array<struct<h: long, place: long, size: int>>"
    found = rows.mapInArrow(_document_prints(window, gram, sorted(lengths), wanted), f"doc_id long, text_key long, n_words long, {hits}, text string").checkpoint()
    found = found.withColumn("row", F.monotonically_increasing_id())  # stable: the rows are stored
    hit = found.where("size(hits) > 0").select("row", "n_words", "text", "hits")
    if wanted is None:
        known = hit.select("row", F.explode("hits").alias("x")).join(prints.select(F.col("h").alias("known")), F.col("x.h") == F.col("known"), "left_semi")
        hit = hit.drop("hits").join(known.groupBy("row").agg(F.collect_list("x").alias("hits")), "row")
    around = hit.select("row", "n_words", "text", "hits").mapInArrow(_extend(window, gram), "row long, place long, size long, words string")
    windows = items.select("item_id", "text").mapInArrow(_item_windows(window), "item_id string, words string")
    windows = windows.groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("ids")).withColumn("list", F.sha2(F.to_json("ids"), 256)).checkpoint()
    lists = windows.groupBy("list").agg(F.first("ids").alias("ids"))
    matched = around.join(windows.select("words", "list"), "words").groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("place", "size"))).alias("spans"), F.collect_set("list").alias("lists")
    ).select("row", F.expr(_covered("spans")).alias("n_hit"), F.explode("lists").alias("list"))
    extended = matched.join(lists, "list").groupBy("row").agg(F.first("n_hit").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    none = F.array().cast("array<string>")
    return found.drop("text", "hits").join(extended, "row", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text is contaminated."""
    found = benchmark_hits(docs, benchmark, doc_id, text)
    bad_id, bad_key = T.unused(docs, "_bad_id"), T.unused(docs, "_bad_key")
    bad = found.where(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(bad_id)) & (F.xxhash64(F.col(text).cast("string")) == F.col(bad_key))
    return docs.join(bad, same, "left_anti")


def contaminated(n_hit, n_words):
    """The contract's rule: at least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def op4_winnowing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )

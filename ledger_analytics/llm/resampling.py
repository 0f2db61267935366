"""Importance resampling towards a target corpus, with n-gram hashes from prefix CRCs.

Words are runs of ASCII digits and letters (A-Z lower-cased) and of all non-ASCII characters.  The features of a
text are its runs of 1 to ``max_n`` words joined by one space; a feature's bucket is the CRC-32 of its bytes
modulo ``buckets``.  With S features of all documents and T of all target texts, s and t of them in a bucket, the
bucket's gain is ``floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))``, and a text's weight is the sum of its
features' gains.  A draw without replacement by these weights adds Gumbel noise, taken from a hash of the id, and
keeps the highest scores.

*Prefix CRCs.*  Each text is scanned once, its words separated by one space, and the running CRC behind each word
is stored.  Appending bytes to a text multiplies its CRC's polynomial by a power of x, which is linear over GF(2):
``crc(AB) = shift(crc(A), len(B)) xor crc(B)``.  So the CRC of any n-gram is the CRC behind it, xored with the CRC
before it shifted by the n-gram's length; no n-gram is built or hashed.

*Jobs.*  One pass counts the buckets of all documents (each task sends one row for each bucket it met), a second
one weighs the documents, and the scores are stored.  The gains (``buckets`` numbers, a parameter) go to the tasks
with the code.  The score at the last rank drawn is found by counting scores in ranges, and only rows that reach
it are sorted, by ranges.

Defined cases: null and blank texts have no features and weight 0; texts of any length are processed whole, some
words at a time.  A null id counts as an empty one in the noise and comes last among equal scores; ids are cast to
LONG, so one that is no number ends the job.  Repeated rows are drawn each for itself; rows that are equal in score
and id rank by their number of features, and rows equal in that, too, in any order.  Empty documents, an empty
target and other columns of any name are fine.  Every input row gives one output row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.load import surrogate_key
from ..operators.ranks import values_at
from ..session import ensure_checkpoint_dir
from . import textcore as T

BUCKETS, MAX_N, MIN_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: words whose running CRCs are in memory at a time
WORDS = 1 << 19


def _byte_steps() -> np.ndarray:
    """CRC-32 register after one zero byte, for each low byte of the register before."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    return step


class Shift:
    """``crc(A)`` -> its part in ``crc(AB)``, for any length of B.

    A shift is linear, so it is the xor of a table entry for each byte of the CRC.  Lengths below ``SMALL`` have
    their own tables; longer ones are put together from shifts by SMALL, 2 SMALL, 4 SMALL, ...
    """

    SMALL = 64

    def __init__(self):
        step = _byte_steps()
        unit = (np.arange(256, dtype=np.uint32)[None] << np.array([[0], [8], [16], [24]], np.uint32)).astype(np.uint32)
        tables = [unit]
        for _ in range(self.SMALL):
            tables.append(step[tables[-1] & 255] ^ (tables[-1] >> 8))
        self.small = np.stack(tables[:-1])
        self.large = [tables[-1]]

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]

    def __call__(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        low = length % self.SMALL
        out = self.small[low, 0, crc & 255] ^ self.small[low, 1, crc >> 8 & 255] ^ self.small[low, 2, crc >> 16 & 255] ^ self.small[low, 3, crc >> 24]
        rest, k = length // self.SMALL, 0
        while rest.any():
            if k == len(self.large):
                self.large.append(self._apply(self.large[-1], self.large[-1]))
            odd = np.flatnonzero(rest & 1)
            out[odd] = self._apply(self.large[k], out[odd])
            rest, k = rest >> 1, k + 1
        return out


def _behind_space(crc: np.ndarray) -> np.ndarray:
    """CRC of a text and one space from the CRC of the text."""
    register = ~crc
    return ~(_STEPS[(register ^ np.uint32(0x20)) & 255] ^ (register >> 8))


_STEPS = _byte_steps()


def feature_crcs(words: T.Words, shift: Shift, max_n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, CRC-32) of all runs of 1 to ``max_n`` words of the texts, some runs at a time."""
    raw, n = words.data.tobytes(), len(words.starts)
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    for a in range(0, n, WORDS):
        upto = min(n, a + WORDS)
        starts, ends, own = (x[a : upto + max_n - 1] for x in (words.starts, words.ends, owner))
        pieces = (raw[i:j] for i, j in zip(starts.tolist(), ends.tolist()))
        behind = np.fromiter(accumulate(pieces, lambda c, w: crc32(w, crc32(b" ", c)), initial=0), np.uint32, len(starts) + 1)
        # both are CRCs of prefixes of " w0 w1 w2 ...", whatever came before drops out
        before = _behind_space(behind[:-1])
        behind = behind[1:]
        end = np.cumsum(ends - starts + 1)
        start = end - (ends - starts)
        for size in range(1, max_n + 1):
            last = np.arange(size - 1, min(len(starts), upto - a + size - 1))
            first = last - size + 1
            whole = own[first] == own[last]
            first, last = first[whole], last[whole]
            yield own[first], behind[last] ^ shift(before[first], end[last] - start[first])


def _words(part: pa.RecordBatch) -> T.Words:
    data, offsets = T.buffers(part.column("text"))
    return T.words_of(T.LOWER[data], offsets, T.ALNUM)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N) -> np.ndarray:
    """Features of all rows of ``texts`` (a column ``text``) in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, counts = Shift(), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in T.blocks(batch, "text"):
                for _, crc in feature_crcs(_words(part), shift, max_n):
                    counts += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():  # a row for each bucket at most
        out[bucket] = n
    return out


def gains(of_documents: np.ndarray, of_target: np.ndarray) -> np.ndarray:
    """Each bucket's gain, in doubles."""
    b, s_all, t_all = len(of_documents), int(of_documents.sum()), int(of_target.sum())
    ratio = lambda s, t: (float(t + 1) * float(s_all + b)) / (float(s + 1) * float(t_all + b))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(of_documents.tolist(), of_target.tolist())], np.int64)


def importance_weights(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", max_n: int = MAX_N, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, carried, n_words, n_features, weight`` for each row; ``carried`` is a struct of further columns."""
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), carried.alias("carried"), F.col(text).cast("string").alias("text"))
    schema = StructType([*rows.schema.fields[:2], *[StructField(c, LongType()) for c in ("n_words", "n_features", "weight")]])
    buckets = np.uint32(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = Shift()
        for batch in batches:
            for part in T.blocks(batch, "text"):
                words = _words(part)
                weight, n = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                for own, crc in feature_crcs(words, shift, max_n):
                    np.add.at(weight, own, gain[crc % buckets])
                    n += np.bincount(own, minlength=part.num_rows)
                numbers = [pa.array(x, pa.int64()) for x in (np.diff(words.first), n, weight)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("carried"), *numbers], names=schema.names)

    return rows.mapInArrow(run, schema)


def noise_sql(seed: int) -> str:
    """Gumbel noise from a hash of ``doc_id``, in thousandths."""
    h = f"CAST(conv(substr(sha2(concat('{int(seed)}:', coalesce(CAST(doc_id AS STRING), '')), 256), 1, 8), 16, 10) AS BIGINT)"
    return f"CAST(floor(-1000 * ln(-ln(({h} + 0.5D) / 4294967296D))) AS BIGINT)"


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, max_n: int = MAX_N, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, carried, n_words, n_features, weight, score, rank``, a row for each row of ``docs``.

    ``percent`` of the rows of ``min_words`` words or more are drawn; ``rank`` is their place from 1, in order of
    score, and null for the others.  ``carry`` names columns (the text, say) that come along in ``carried``.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    only = lambda df, c: df.select(F.col(c).cast("string").alias("text"))
    gain = gains(bucket_counts(only(docs, text), buckets, max_n), bucket_counts(only(target, target_text), buckets, max_n))
    scored = importance_weights(docs, gain, doc_id, text, max_n, carry).withColumn("score", F.col("weight") + F.expr(noise_sql(seed))).checkpoint()
    eligible = F.col("n_words") >= min_words
    n, low, high = scored.where(eligible).agg(F.count(F.lit(1)), F.min(-F.col("score")), F.max(-F.col("score"))).first()
    drawn = n * percent // 100
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    least = values_at(scored.where(eligible), -F.col("score"), [drawn - 1], low, high)[drawn - 1][0]
    reaches = eligible & (-F.col("score") <= F.lit(least).cast("long"))
    # the stored rows have one order, so the running number tells equal rows apart
    place = F.struct((-F.col("score")).alias("s"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("n_features").alias("f"), F.monotonically_increasing_id().alias("row"))
    ranked = surrogate_key(scored.withColumn("place", place).where(reaches), "place", "rank").drop("place")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.where(~reaches).withColumn("rank", F.lit(None).cast("long")))


def op12_prefix_crc_resampling(spark, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")

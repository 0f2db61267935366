"""Document shards and key buckets: the exchange that several text operators share.

Documents go to shards by a hash of their id (one exchange, which the phases of a query reuse).
Each shard sends the *distinct* keys it holds, packed into one row per key bucket, so a key that a
third of all rows share costs one entry per shard; buckets answer each shard in the same form.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: text of a shard, in bytes; shards are the unit a task holds in memory
SHARD_BYTES = 2 << 20


def shard_count(docs: DataFrame, text: str = "text", shard_bytes: int = SHARD_BYTES) -> int:
    """Number of shards for a table, from the bytes of its texts (one aggregate, one row)."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long") + 16)).first()[0] or 0
    return max(16, -(-int(total) // shard_bytes))


def shard_of(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a key, from its high bits."""
    return ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpack(column, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]

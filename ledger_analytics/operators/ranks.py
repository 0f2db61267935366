"""Rows by their rank in a table (O5, A7): order statistics over key ranges.

The rows at ranks ``first .. last`` are found without sorting the table.  A
round counts the rows per range of the key (at most :data:`RANGES` counts come
back), the prefix counts tell which range holds a rank, and the next round
looks into that range only.  A range of a 64-bit key is down to one value after
six rounds at most, whatever the size of the table and the rank, and no task
holds more than its counters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ranges a round counts, and so the largest result it sends to the driver
RANGES = 4096


def _within(key: Column, low: int, high: int) -> Column:
    return key.between(F.lit(low).cast("bigint"), F.lit(high).cast("bigint"))


def values_at(df: DataFrame, key: Column, ranks: list[int], low: int, high: int) -> dict[int, tuple[int, int, int]]:
    """For each rank (from 0, below the number of rows) the key's value there,
    the number of rows with a smaller key and the number of rows with it.
    All keys lie within ``low .. high``."""
    found: dict[int, tuple[int, int, int]] = {}

    def narrow(low: int, high: int, before: int, wanted: list[int]) -> None:
        step = -(-(high - low + 1) // RANGES)
        # the ranges follow each other, so their numbers fit an INT whatever the key
        place = F.floor((key.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(step).cast("decimal(20,0)"))
        counts = df.where(_within(key, low, high)).groupBy(place.cast("int").alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()
        for place, n in sorted(tuple(r) for r in counts):
            own = [r for r in wanted if before <= r < before + n]
            start = low + place * step
            if own and step == 1:
                found.update(dict.fromkeys(own, (start, before, n)))
            elif own:
                narrow(start, min(high, start + step - 1), before, own)
            before += n

    narrow(low, high, 0, sorted(set(ranks)))
    return found


def _spread(df: DataFrame, key: Column) -> tuple[int, int, int, int]:
    """Rows, rows with a key, least and largest key."""
    return tuple(df.agg(F.count(F.lit(1)), F.count(key), F.min(key), F.max(key)).first())


def _between(df: DataFrame, key: Column, first: int, last: int, low: int, high: int) -> tuple[DataFrame, int, int, int, int]:
    """The rows from the value at rank ``first`` to that at rank ``last``, the two
    values, and how many rows that is too many at either end."""
    at = values_at(df, key, [first, last], low, high)
    (a, before, _), (b, below, n) = at[first], at[last]
    return df.where(_within(key, a, b)), a, b, first - before, below + n - 1 - last


def rows_at(df: DataFrame, key: str, offset: int, limit: int) -> tuple[DataFrame, int]:
    """The rows at ranks ``offset .. offset + limit - 1`` in the order of an
    integer ``key`` (NULLs last), sorted by it, and the number of all rows.

    Rows with equal keys are ranked by a hash of all their columns, and rows
    equal in that, too, are interchangeable.  Ranks past the end, a limit below 1 and
    an empty table give no row.
    """
    k = F.col(key).cast("bigint")
    total, known, low, high = _spread(df, k)
    last = min(offset + limit, total) - 1
    if offset < 0 or last < offset:
        return df.limit(0), total
    if last >= known:  # rows without a key are among them
        parts = [_by_hash(df.where(F.col(key).isNull()), max(offset - known, 0), last - known)]
        if offset < known:
            parts.append(rows_at(df.where(F.col(key).isNotNull()), key, offset, known - offset)[0])
        return _all(parts).orderBy(F.col(key).asc_nulls_last()), total
    rows, a, b, early, late = _between(df, k, offset, last, low, high)
    if early or late:  # equal keys at an end: their rows by hash
        if a == b:
            rows = _by_hash(rows, early, early + last - offset)
        else:
            parts = [rows.where((k > a) & (k < b))]
            for value, lost_first, lost_last in ((a, early, 0), (b, 0, late)):
                own = rows.where(k == value)
                parts.append(_by_hash(own, lost_first, own.count() - 1 - lost_last))
            rows = _all(parts)
    return rows.orderBy(key), total


def _by_hash(df: DataFrame, first: int, last: int) -> DataFrame:
    """The rows at some ranks in the order of a hash of all columns; at either
    end, any of the rows with one hash will do."""
    h = F.xxhash64(*df.columns)
    _, _, low, high = _spread(df, h)
    rows, a, b, early, late = _between(df, h, first, last, low, high)
    if a == b:
        return rows.limit(last - first + 1)
    parts = [rows.where((h > a) & (h < b))]
    for value, lost in ((a, early), (b, late)):
        own = rows.where(h == value)
        parts.append(own.limit(own.count() - lost) if lost else own)
    return _all(parts)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

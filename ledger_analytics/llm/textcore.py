"""Vectorised text helpers used inside Spark tasks: words, hashes and winnowing over Arrow strings.

A batch of texts is looked at as one byte buffer.  Words and windows never cross a text border.
Hashes are 64-bit and depend on content alone, so equal windows hash alike in every task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# ---- fixed values: byte classes -------------------------------------------------------------
_WHITE = [0x20, *range(0x09, 0x0E)]
NOT_WHITE = np.ones(256, bool)
NOT_WHITE[_WHITE] = False
#: digits, a-z and every byte of a non-ASCII character (after lower-casing)
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i below n (kept and grown between calls)."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Prefix:
    """Polynomial prefix sums, from which the hash of any slice follows."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(_BASE, len(values)), out=self.sums[1:])
        self.back = powers(_BASE_INV, len(values) + 1)

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


    def every(self, length: int) -> np.ndarray:
        """Hashes of all slices of one length, in order; cheaper than :meth:`slices`."""
        h = self.sums[length:] - self.sums[: len(self.sums) - length]
        h *= self.back[: len(h)]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h


@dataclass
class Words:
    """Words of a batch: byte spans in ``data``; text ``d`` owns words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return Prefix(_BYTE[self.data]).slices(self.starts, self.ends)

    def last_window(self, n: int) -> np.ndarray:
        """For each word, whether a window of n words that starts here ends in the same text."""
        ok = np.zeros(len(self.starts), bool)
        for a, b in zip(self.first[:-1], self.first[1:]):
            if b - a >= n:
                ok[a : b - n + 1] = True
        return ok


def unused(table, name: str) -> str:
    """A column name that a table (a DataFrame, by its ``columns``) doesn't have: ``name``, or that and underscores."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls are empty."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).fill_null("").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Words:
    """Maximal runs of the bytes in ``member``, cut at text borders."""
    inside = member[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    opens[heads] = inside[heads]
    closes[tails] = inside[tails]
    starts = np.flatnonzero(opens)
    return Words(data, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def blocks(table: pa.Table | pa.RecordBatch, column: str, size: int = 2 << 20):
    """Cut a table into runs of rows with about ``size`` bytes of text (a longer text stands alone)."""
    if not table.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(table.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    at = 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield table.slice(at, upto - at)
        at = upto


_POS = np.uint64((1 << 24) - 1)


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the least gram of every ``width`` neighbours, the rightmost of equal ones.

    The choice depends on the grams in the window alone, so equal windows choose alike.  Minima of
    twice the width come from two minima, so the cost is logarithmic in the width.
    """
    at = np.arange(len(grams), dtype=np.uint64)
    least = grams & ~_POS
    least |= ~at & _POS
    have = 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    # the low bits hold the position modulo 2**24, counted down
    np.bitwise_not(least, out=least)
    here = at[: len(least)]
    least -= here
    least &= _POS
    least += here
    return least.view(np.int64)


def isin_sorted(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Membership in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Mask of the n places that some span ``[start, start + length)`` covers."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + length, n), -1)
    return np.cumsum(marks[:-1]) > 0


def split_by(values: np.ndarray, parts: np.ndarray):
    """(part, indices) for each part that occurs."""
    order = np.argsort(parts, kind="stable")
    cut = np.flatnonzero(np.diff(parts[order])) + 1
    for own in np.split(order, cut):
        if len(own):
            yield int(parts[own[0]]), values[own]

"""Suffix-array de-duplication over a run-length index.

A byte goes if some ``window``-byte string over it also starts anywhere else, in any document.

1. Winnowing picks one ``gram``-byte seed in every window; the maximal run of windows with one seed is
   a *segment* (equal windows lie in segments with an equal seed).  Shards send their distinct (seed,
   segment) hashes to the seed's bucket, which answers with the segments to index: one copy of every
   distinct segment whose seed occurs twice or more, weighted by whether the segment itself recurs.
2. Each bucket builds a run-length index of its segments: suffix array, run-compressed Burrows-Wheeler
   transform, and the longest-common-prefix values sampled at run ends, from which the matching
   statistics of every position stream as ``value at the last sample - distance``.  Windows with a long
   match, and those of weighted segments, are marked.
3. Shards look their segments up among the marks and drop the bytes under marked windows.

Copies cost one index entry however many there are, so the index grows with the distinct text.

A *hot* seed has more than ``SEED_SEGMENTS`` distinct segments (a footer line in different surroundings).  It
gets no index: the shards that hold it send the distinct hashes of its windows to buckets by window, which
answer with those that recur.  A shard lists ``SHARD_SEGMENTS`` segments of a seed at most; more make it hot.

Defined cases: a null text is empty.  Matches never cross documents.  Every input row gives one output
row, rows that share a ``doc_id`` included; rows are dealt by id and text, so an id that many rows share, or
that they lack, doesn't gather them in one shard (whole rows that repeat do meet there).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as T
from .shards import bucket_of, pack, shard_count, shard_of, unpack

BUCKET_BYTES = 8 << 20
#: bytes of text whose arrays a task works on at once, and of one index: both fit the processor's cache
PART_BYTES = 1 << 18
INDEX_BYTES = 1 << 18
#: distinct segments (of 2 * window - gram bytes at most) that one seed may bring into an index, and that a shard lists
SEED_SEGMENTS = 512
SHARD_SEGMENTS = 32
#: bits of a segment's flag: it occurs again in its shard; its shard lists only some segments of the seed
AGAIN, MORE = 1, 2
PAIRS = "bucket int, shard int, seeds binary, segs binary, flags binary"
PIECES = "bucket int, shard int, seeds binary, segs binary, lens binary, flags binary, body binary"
MARKS = "shard int, segs binary, lows binary, highs binary, seeds binary, windows binary"


class RunLengthIndex:
    """Run-compressed BWT of texts, each ended by a separator that equals nothing else.

    Kept: the suffix order, and the common-prefix length at the sampled positions (those that stand at
    a run end).  Between samples, text position by text position, the value falls by one.
    """

    def __init__(self, body: np.ndarray, lens: np.ndarray):
        ends = np.cumsum(lens + 1) - 1  # places of the separators
        n = int(ends[-1]) + 1
        symbols = np.zeros(n, np.uint64)
        inside = np.ones(n, bool)
        inside[ends] = False
        symbols[inside] = body.astype(np.uint64) + np.uint64(1)
        self.n, self.symbols, self.ends, self.inside = n, symbols, ends, inside
        self.order = self._suffix_order()
        self.row = np.empty(n, np.int64)
        self.row[self.order] = np.arange(n)
        self._sample()

    def _suffix_order(self) -> np.ndarray:
        """Prefix doubling; only positions whose rank is still shared take part in a round."""
        n, width = self.n, 7
        padded = np.append(self.symbols, np.zeros(width, np.uint64))
        two = (padded[:-1] << np.uint64(9)) | padded[1:]
        four = (two[:-2] << np.uint64(18)) | two[2:]
        keys = (four[:n] << np.uint64(27)) | (two[4 : n + 4] << np.uint64(9)) | padded[6 : n + 6]
        upto = self.ends[np.searchsorted(self.ends, np.arange(n))]
        ended = upto - np.arange(n) < width
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        fresh = np.ones(n, bool)
        fresh[1:] = (sorted_keys[1:] != sorted_keys[:-1]) | ended[order[1:]]
        group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[order] = group
        del keys, sorted_keys, padded, two, four, upto, ended
        size_one = fresh & np.append(fresh[1:], True)
        left = order[~size_one]
        step = width
        while len(left):
            ahead = left + step
            key = (rank[left].astype(np.uint64) << np.uint64(32)) | rank[np.minimum(ahead, n - 1)].astype(np.uint64)
            by = np.argsort(key)
            left, key = left[by], key[by]
            at = np.arange(len(left))
            old, new = np.ones(len(left), bool), np.ones(len(left), bool)
            new[1:] = key[1:] != key[:-1]
            high = key >> np.uint64(32)
            old[1:] = high[1:] != high[:-1]
            start = np.maximum.accumulate(np.where(old, at, 0))
            sub = np.maximum.accumulate(np.where(new, at, 0))
            rank[left] += sub - start
            alone = new & np.append(new[1:], True)
            left = left[~alone]
            step *= 2
        out = np.empty(n, np.int64)
        out[rank] = np.arange(n)
        return out

    def _sample(self) -> None:
        before = np.where(self.order > 0, self.symbols[self.order - 1], 0)  # the transform, row by row
        head = np.ones(self.n, bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.runs = int(head.sum())
        # a position is sampled where its row opens a run, or where the row above it is not the
        # neighbour that the previous position leads to
        above = np.full(self.n, -1, np.int64)
        above[self.order[1:]] = self.order[:-1]
        sampled = np.zeros(self.n, bool)
        sampled[self.order[head]] = True
        sampled[0] = True
        sampled[1:] |= above[1:] != above[:-1] + 1
        self.samples = np.flatnonzero(sampled)
        self.sample_values = self._common(self.samples, above[self.samples])

    def _common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Common-prefix length of the suffixes at p and q (none if q is below 0), within their texts."""
        prefix = T.Prefix(T.mix(self.symbols))
        room = np.minimum(self._room(p), self._room(np.maximum(q, 0)))
        low, high = np.zeros(len(p), np.int64), np.where(q < 0, 0, room)
        q = np.maximum(q, 0)
        sums, back = prefix.sums, prefix.back
        at_p, at_q = sums[p], sums[q]
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = (sums[p + mid] - at_p) * back[p] == (sums[q + mid] - at_q) * back[q]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def _room(self, p: np.ndarray) -> np.ndarray:
        return self.ends[np.searchsorted(self.ends, p)] - p

    def matching_statistics(self) -> np.ndarray:
        """For each place, the length of its longest match that starts at another place."""
        at = np.arange(self.n)
        last = np.searchsorted(self.samples, at, "right") - 1
        up = np.maximum(self.sample_values[last] - (at - self.samples[last]), 0)
        by_row = np.append(up[self.order], 0)
        return np.maximum(up, by_row[self.row + 1])


class _Segments:
    """Segments of some documents of a shard."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        self.data, self.offsets = T.buffers(table.column("text"))
        sizes = np.diff(self.offsets)
        if not (sizes >= window).any():
            self.start = self.stop = np.zeros(0, np.int64)
            self.seed = self.hash = np.zeros(0, np.uint64)
            return
        n = len(self.data)
        prefix = T.Prefix(T._BYTE[self.data])
        grams = prefix.every(gram)
        pick = T.winnow(grams, window - gram + 1)  # for windows that start at 0 .. n - window
        valid = np.zeros(n - window + 1, bool)
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            if b - a >= window:
                valid[a : b - window + 1] = True
        opens, closes = valid.copy(), valid.copy()
        change = pick[1:] != pick[:-1]
        opens[1:] &= ~valid[:-1] | change
        closes[:-1] &= ~valid[1:] | change
        # windows of neighbouring documents never touch: window - 1 invalid starts lie between them
        self.start = np.flatnonzero(opens)
        self.stop = np.flatnonzero(closes) + window
        self.seed = grams[pick[self.start]]
        self.hash = prefix.slices(self.start, self.stop)
        self.prefix = prefix

    def windows(self, seeds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, seed, hash) of all windows of the segments with one of these (sorted) seeds."""
        own = np.flatnonzero(T.isin_sorted(self.seed, seeds)) if len(self.seed) and len(seeds) else np.zeros(0, np.int64)
        if not len(own):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        times = self.stop[own] - window + 1 - self.start[own]
        start = np.repeat(self.start[own] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        return start, np.repeat(self.seed[own], times), self.prefix.slices(start, start + window)


def _table(rows: list[tuple], names: list[str], types: list) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)


def _pairs_table(rows):
    return _table(rows, ["bucket", "shard", "seeds", "segs", "flags"], [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])


def _segments(window: int, gram: int, n_buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = [_Segments(part, window, gram) for part in T.blocks(table, "text", PART_BYTES)]
        seeds = np.concatenate([np.zeros(0, np.uint64), *[s.seed for s in found]])
        segs = np.concatenate([np.zeros(0, np.uint64), *[s.hash for s in found]])
        order = np.lexsort((segs, seeds))
        seeds, segs = seeds[order], segs[order]
        head = np.ones(len(seeds), bool)
        head[1:] = (seeds[1:] != seeds[:-1]) | (segs[1:] != segs[:-1])
        at = np.flatnonzero(head)
        flags = (np.diff(np.append(at, len(seeds))) > 1).astype(np.uint8) * AGAIN
        seeds, segs = seeds[at], segs[at]
        if len(at):
            first = np.flatnonzero(np.append(True, seeds[1:] != seeds[:-1]))
            size = np.diff(np.append(first, len(seeds)))
            flags += np.repeat(size > SHARD_SEGMENTS, size).astype(np.uint8) * np.uint8(MORE)
            listed = np.arange(len(seeds)) - np.repeat(first, size) < SHARD_SEGMENTS
            at, seeds, segs, flags = at[listed], seeds[listed], segs[listed], flags[listed]
        rows = []
        if len(at):
            for b, i in T.split_by(np.arange(len(at)), bucket_of(seeds, n_buckets)):
                rows.append((b, key[0].as_py(), pack(seeds[i]), pack(segs[i]), pack(flags[i])))
        return _pairs_table(rows)

    return run


def _bucket(table: pa.Table):
    """Segments of a bucket whose seed recurs as flat arrays: seed, segment, weight, first of its kind, shard, hot seed."""
    seeds, segs, flags = unpack(table.column("seeds"), np.uint64), unpack(table.column("segs"), np.uint64), unpack(table.column("flags"), np.uint8)
    owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
    seeds, segs, flags = np.concatenate(seeds), np.concatenate(segs), np.concatenate(flags)
    names = np.array(table.column("shard").to_pylist(), np.int64)
    order = np.lexsort((names[owner], segs, seeds))
    seeds, segs, flags, owner = seeds[order], segs[order], flags[order], owner[order]
    new_seed = np.ones(len(seeds), bool)
    new_seed[1:] = seeds[1:] != seeds[:-1]
    new_seg = new_seed.copy()
    new_seg[1:] |= segs[1:] != segs[:-1]
    times = 1 + ((flags & AGAIN) > 0).astype(np.int64)
    heads, seg_heads = np.flatnonzero(new_seed), np.flatnonzero(new_seg)
    size = np.diff(np.append(heads, len(seeds)))
    recurs = np.repeat(np.add.reduceat(times, heads) > 1, size)
    weight = np.repeat(np.add.reduceat(times, seg_heads) > 1, np.diff(np.append(seg_heads, len(seeds))))
    hot = (np.add.reduceat(new_seg.astype(np.int64), heads) > SEED_SEGMENTS) | (np.maximum.reduceat(flags & MORE, heads) > 0)
    return seeds[recurs], segs[recurs], weight[recurs], new_seg[recurs], names[owner[recurs]], np.repeat(hot, size)[recurs]


def _wanted(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Asks one shard for each distinct segment that is to be indexed, and all that hold a hot seed for its windows."""
    seeds, segs, weight, first, shard, hot = _bucket(table)
    rows = []
    if hot.any():
        for s, i in T.split_by(np.flatnonzero(hot), shard[hot]):
            rows.append((key[0].as_py(), s, pack(np.unique(seeds[i])), b"", b""))
    first &= ~hot
    segs, weight, shard = segs[first], weight[first], shard[first]
    if len(segs):
        for s, i in T.split_by(np.arange(len(segs)), shard):
            rows.append((key[0].as_py(), s, b"", pack(segs[i]), pack(weight[i].astype(np.uint8))))
    return _pairs_table(rows)


def _window_rows(shard: int, seeds: np.ndarray, hashes: np.ndarray, n_buckets: int) -> list[tuple]:
    """A shard's distinct windows of hot seeds, by seed, for the buckets from n_buckets on."""
    order = np.lexsort((hashes, seeds))
    seeds, hashes = seeds[order], hashes[order]
    at = np.flatnonzero(np.append(True, (seeds[1:] != seeds[:-1]) | (hashes[1:] != hashes[:-1])))
    again = (np.diff(np.append(at, len(seeds))) > 1).astype(np.uint8)
    seeds, hashes = seeds[at], hashes[at]
    rows = []
    for b, i in T.split_by(np.arange(len(at)), bucket_of(hashes, n_buckets)):
        own, counts = np.unique(seeds[i], return_counts=True)
        rows.append((n_buckets + b, shard, pack(own), pack(hashes[i]), pack(counts.astype(np.int32)), pack(again[i]), b""))
    return rows


def _pieces(window: int, gram: int, n_buckets: int):
    names, types = ["bucket", "shard", "seeds", "segs", "lens", "flags", "body"], [pa.int32(), pa.int32(), *[pa.binary()] * 5]

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not table.num_rows:
            return _table([], names, types)
        segs, flags = unpack(asked.column("segs"), np.uint64), unpack(asked.column("flags"), np.uint8)
        bucket = np.repeat(np.array(asked.column("bucket").to_pylist(), np.int64), [len(s) for s in segs])
        segs, flags = np.concatenate(segs), np.concatenate(flags)
        hot = np.unique(np.concatenate(unpack(asked.column("seeds"), np.uint64)))
        order = np.argsort(segs)
        segs, flags, bucket = segs[order], flags[order], bucket[order]
        rows, done, windows = [], np.zeros(len(segs), bool), []
        for part in T.blocks(table, "text", PART_BYTES):
            s = _Segments(part, window, gram)
            windows.append(s.windows(hot, window)[1:])
            mine, where = np.unique(s.hash, return_index=True)
            known = T.isin_sorted(mine, segs) if len(segs) else np.zeros(len(mine), bool)
            at, where = np.searchsorted(segs, mine[known]), where[known]
            at, where = at[~done[at]], where[~done[at]]
            done[at] = True
            raw = s.data.tobytes()
            if len(at):
                for b, i in T.split_by(np.arange(len(at)), bucket[at]):
                    spans = list(zip(s.start[where[i]].tolist(), s.stop[where[i]].tolist()))
                    lens = np.array([y - x for x, y in spans], np.int32)
                    rows.append((b, -1, b"", pack(segs[at[i]]), pack(lens), pack(flags[at[i]]), b"".join(raw[x:y] for x, y in spans)))
        seeds, hashes = (np.concatenate(x) for x in zip(*windows))
        if len(seeds):
            rows += _window_rows(key[0].as_py(), seeds, hashes, n_buckets)
        return _table(rows, names, types)

    return run


def _long_matches(index: RunLengthIndex, lens: np.ndarray, segs: np.ndarray, whole: np.ndarray, window: int):
    """(segment, first, last) of the maximal runs of window starts that occur elsewhere."""
    stats = index.matching_statistics()
    owner = np.repeat(np.arange(len(lens)), lens + 1)
    begin = index.ends - lens
    room = index.ends[owner] - np.arange(index.n)
    hit = (room >= window) & ((stats >= window) | whole[owner])
    opens, closes = hit.copy(), hit.copy()
    opens[1:] &= ~hit[:-1] | (owner[1:] != owner[:-1])
    closes[:-1] &= ~hit[1:] | (owner[1:] != owner[:-1])
    low, high = np.flatnonzero(opens), np.flatnonzero(closes)
    seg = owner[low]
    return segs[seg], (low - begin[seg]).astype(np.int32), (high - begin[seg]).astype(np.int32)


def _recurring_windows(table: pa.Table) -> list[tuple]:
    """For each shard, the windows of this bucket that recur, and their seeds."""
    hashes, flags = unpack(table.column("segs"), np.uint64), unpack(table.column("flags"), np.uint8)
    shard = np.repeat(np.array(table.column("shard").to_pylist(), np.int64), [len(h) for h in hashes])
    seeds = np.concatenate([np.repeat(s, n) for s, n in zip(unpack(table.column("seeds"), np.uint64), unpack(table.column("lens"), np.int32))])
    hashes, flags = np.concatenate(hashes), np.concatenate(flags)
    order = np.lexsort((hashes, seeds))
    seeds, hashes, flags, shard = seeds[order], hashes[order], flags[order], shard[order]
    at = np.flatnonzero(np.append(True, (seeds[1:] != seeds[:-1]) | (hashes[1:] != hashes[:-1])))
    recurs = np.repeat(np.add.reduceat(1 + flags.astype(np.int64), at) > 1, np.diff(np.append(at, len(seeds))))
    own = np.flatnonzero(recurs)
    return [(s, b"", b"", b"", pack(np.unique(seeds[i])), pack(hashes[i])) for s, i in T.split_by(own, shard[own])] if len(own) else []


def _marks(window: int, n_buckets: int):
    names, types = ["shard", "segs", "lows", "highs", "seeds", "windows"], [pa.int32(), *[pa.binary()] * 5]

    def run(key: tuple[pa.Scalar, ...], pairs: pa.Table, pieces: pa.Table) -> pa.Table:
        if not pieces.num_rows:
            return _table([], names, types)
        if key[0].as_py() >= n_buckets:
            return _table(_recurring_windows(pieces), names, types)
        segs = np.concatenate(unpack(pieces.column("segs"), np.uint64))
        lens = np.concatenate(unpack(pieces.column("lens"), np.int32)).astype(np.int64)
        whole = np.concatenate(unpack(pieces.column("flags"), np.uint8)) > 0
        body = np.frombuffer(b"".join(pieces.column("body").to_pylist()), np.uint8)
        seeds, mine, _, _, shard, hot = _bucket(pairs)
        seeds, mine, shard = seeds[~hot], mine[~hot], shard[~hot]
        # segments that may match share a seed, so a bucket falls into independent indices by seed
        known, at = np.unique(mine, return_index=True)
        seed = seeds[at][np.searchsorted(known, segs)]
        part = (T.mix(seed) % np.uint64(max(1, -(-len(body) // INDEX_BYTES)))).astype(np.int64)
        stop = np.cumsum(lens)
        found = []
        for _, i in T.split_by(np.arange(len(segs)), part):
            own = np.concatenate([body[stop[j] - lens[j] : stop[j]] for j in i.tolist()])
            found.append(_long_matches(RunLengthIndex(own, lens[i]), lens[i], segs[i], whole[i], window))
        marked, low, high = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(marked, kind="stable")
        marked, low, high = marked[order], low[order], high[order]
        first, last = np.searchsorted(marked, mine, "left"), np.searchsorted(marked, mine, "right")
        times = last - first
        entry = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        to = np.repeat(shard, times)
        rows = []
        if len(entry):
            for s, e in T.split_by(entry, to):
                rows.append((s, pack(marked[e]), pack(low[e]), pack(high[e]), b"", b""))
        return _table(rows, names, types)

    return run


def _cut(window: int, gram: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, marks: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        segs = np.concatenate([np.zeros(0, np.uint64), *unpack(marks.column("segs"), np.uint64)])
        low = np.concatenate([np.zeros(0, np.int32), *unpack(marks.column("lows"), np.int32)]).astype(np.int64)
        high = np.concatenate([np.zeros(0, np.int32), *unpack(marks.column("highs"), np.int32)]).astype(np.int64)
        order = np.argsort(segs, kind="stable")
        segs, low, high = segs[order], low[order], high[order]
        hot = np.unique(np.concatenate([np.zeros(0, np.uint64), *unpack(marks.column("seeds"), np.uint64)]))
        again = np.sort(np.concatenate([np.zeros(0, np.uint64), *unpack(marks.column("windows"), np.uint64)]))
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for part in T.blocks(table, "text", PART_BYTES):
            s = _Segments(part, window, gram)
            n = len(s.data)
            first, last = np.searchsorted(segs, s.hash, "left"), np.searchsorted(segs, s.hash, "right")
            times = last - first
            entry = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            start = np.repeat(s.start, times)
            steps = np.zeros(n + 1, np.int64)
            np.add.at(steps, start + low[entry], 1)
            np.add.at(steps, start + high[entry] + window, -1)
            if len(hot):
                own, _, hashes = s.windows(hot, window)
                own = own[T.isin_sorted(hashes, again)]
                np.add.at(steps, own, 1)
                np.add.at(steps, own + window, -1)
            gone = np.cumsum(steps[:-1]) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = s.offsets[:-1][s.offsets[:-1] < n]
            opens[inner] = gone[inner]
            total, spans = np.append(0, np.cumsum(gone)), np.append(0, np.cumsum(opens))
            a, b = s.offsets[:-1], s.offsets[1:]
            n_bytes += (b - a).tolist()
            n_removed += (total[b] - total[a]).tolist()
            n_spans += (spans[b] - spans[a]).tolist()
            for x, y, r in zip(a.tolist(), b.tolist(), (total[b] - total[a]).tolist()):
                own = s.data[x:y]
                kept.append((own[~gone[x:y]] if r else own).tobytes())
        return pa.table([table.column("doc_id").combine_chunks(), n_bytes, n_removed, n_spans, kept], schema=schema)

    return run


def _dealt(rows: DataFrame, n_shards: int) -> DataFrame:
    """``rows`` with their shard, by id and text: rows that share an id, or have none, go to different shards."""
    return rows.withColumn("shard", shard_of(F.xxhash64("doc_id", "text"), n_shards))


def drop_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 200, gram: int = 32) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes), a row for each row of ``docs``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    n_shards = shard_count(rows)
    n_buckets = max(32, n_shards * (2 << 20) // BUCKET_BYTES)
    sharded = _dealt(rows, n_shards)
    pairs = sharded.groupBy("shard").applyInArrow(_segments(window, gram, n_buckets), PAIRS)
    wanted = pairs.groupBy("bucket").applyInArrow(_wanted, PAIRS)
    pieces = sharded.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(_pieces(window, gram, n_buckets), PIECES)
    marks = pairs.groupBy("bucket").cogroup(pieces.groupBy("bucket")).applyInArrow(_marks(window, n_buckets), MARKS)
    return sharded.groupBy("shard").cogroup(marks.groupBy("shard")).applyInArrow(
        _cut(window, gram), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op10_run_length_index(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = drop_repeated_bytes(docs)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

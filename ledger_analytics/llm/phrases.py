"""Substring de-duplication with repeated-phrase automata.

A window is ``window`` consecutive words of one document.  A word goes if some window over it has a
word sequence that also starts earlier: in a smaller ``doc_id``, or further left in the same document.

Phases, all on shards of documents (``shards.py``):

1. *recurring anchors*: winnowing picks one ``gram``-word anchor in every window (equal windows pick
   the same one).  Shards send their distinct anchor hashes to key buckets, which answer with those
   that occur twice or more.
2. *confirmed windows*: windows with a recurring anchor are hashed and sent likewise with the least
   ``doc_id`` that holds them; buckets tell the shard of each first occurrence which shards hold the
   window (itself among them if it recurs there).
3. *passages*: that shard cuts the confirmed windows out of its texts, joins neighbours for the same
   shards into one passage, and sends its words, as text, to those shards.
4. *automata*: each shard compiles the anchor phrases of the passages it got into an Aho-Corasick
   automaton, whose entries hold the confirmed windows around the phrase, as text.  All documents of
   the shard are streamed through it; every hit is extended to the windows around it, which count if
   the entry holds their words.  All but the first occurrence lose their words.

Hashes choose what is sent; what is removed is decided by phrases found and words compared, so two
windows that share a hash never cost a word.  (A window whose hash equals that of an earlier, different
one may stay: at 5e12 windows of 64 bits, fewer than 1 in 10**6 of those that recur.)  The automata are
sharded by where phrases occur: a phrase is compiled in the shards whose documents hold it, in pieces
of ``PASSAGE_BYTES`` of passages, and the work grows with the text.

Defined cases: a null or blank text has no words.  A null ``doc_id`` counts as larger than any other;
rows that share a ``doc_id`` count in the order of their texts.  Every input row gives one output row;
an empty table gives none.  A text of any length is one unit of a task's memory.  Other columns of the
table are not read.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as T
from .shards import bucket_of, pack, shard_count, shard_of, unpack

#: bytes of text whose keys one bucket handles
BUCKET_BYTES = 32 << 20
#: bytes of passages in one automaton; a shard with more streams its documents through several
PASSAGE_BYTES = 1 << 20
#: windows of one passage; a longer one is sent in pieces that share window - 1 words
PASSAGE_WINDOWS = 8192
_NULL_ID = np.iinfo(np.int64).max
KEYS = "bucket int, shard int, keys binary, extra binary"
PASSAGES = "owner int, shards array<int>, passage string"


def _keys_table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["bucket", "shard", "keys", "extra"])


class _Block:
    """Words of some documents of a shard, with the anchor that winnowing picks for each window."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        self.data, self.offsets = T.buffers(table.column("text"))
        self.words = T.words_of(self.data, self.offsets, T.NOT_WHITE)
        self.hash = self.words.hashes()
        n = len(self.hash)
        self.prefix = T.Prefix(self.hash)
        self.valid = np.flatnonzero(self.words.last_window(window))
        self.gram = gram
        if len(self.valid):
            self.grams = self.prefix.every(gram)
            self.anchor = T.winnow(self.grams, window - gram + 1)[self.valid]
        else:
            self.grams, self.anchor = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def windows(self, starts: np.ndarray, window: int) -> np.ndarray:
        return self.prefix.slices(starts, starts + window)

    def owner(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.words.first, starts, "right") - 1


def _ids(table: pa.Table) -> np.ndarray:
    return pc.fill_null(table.column("doc_id"), int(_NULL_ID)).to_numpy()


def _send(shard: int, keys: np.ndarray, extra: np.ndarray, n_buckets: int) -> pa.Table:
    at = np.arange(len(keys))
    rows = [(b, shard, pack(keys[i]), pack(extra[i])) for b, i in T.split_by(at, bucket_of(keys, n_buckets))] if len(keys) else []
    return _keys_table(rows)


def _anchors(window: int, gram: int, n_buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for part in T.blocks(table, "text"):
            b = _Block(part, window, gram)
            found.append(b.grams[np.unique(b.anchor)])
        keys, counts = np.unique(np.concatenate(found), return_counts=True)
        return _send(key[0].as_py(), keys, (counts > 1).astype(np.uint8), n_buckets)

    return run


def _recurring(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Keys of a bucket that occur twice or more, for each shard that holds them."""
    keys, twice = unpack(table.column("keys"), np.uint64), unpack(table.column("extra"), np.uint8)
    every, inverse, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    n[inverse[np.concatenate(twice) > 0]] += 1
    recurring = every[n > 1]
    rows = []
    for shard, own in zip(table.column("shard").to_pylist(), keys):
        own = own[T.isin_sorted(own, recurring)]
        if len(own):
            rows.append((key[0].as_py(), shard, pack(own), b""))
    return _keys_table(rows)


def _candidates(window: int, gram: int, n_buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answer: pa.Table) -> pa.Table:
        recurring = np.sort(np.concatenate([np.zeros(0, np.uint64), *unpack(answer.column("keys"), np.uint64)]))
        found, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        if len(recurring):
            for part in T.blocks(table, "text"):
                b = _Block(part, window, gram)
                starts = b.valid[T.isin_sorted(b.grams[b.anchor], recurring)]
                found.append(b.windows(starts, window))
                ids.append(_ids(part)[b.owner(starts)])
        found, ids = np.concatenate(found), np.concatenate(ids)
        order = np.lexsort((ids, found))
        found, ids = found[order], ids[order]
        head = np.ones(len(found), bool)
        head[1:] = found[1:] != found[:-1]
        at = np.flatnonzero(head)
        often = np.diff(np.append(at, len(found))) > 1
        # least doc_id, and in the lowest bit of a second word whether the window recurs in this shard
        extra = np.stack([ids[at], often.astype(np.int64)], 1) if len(at) else np.zeros((0, 2), np.int64)
        return _send(key[0].as_py(), found[at], extra, n_buckets)

    return run


def _confirmed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each shard the recurring windows whose first occurrence it holds, once for every shard to be told."""
    keys = unpack(table.column("keys"), np.uint64)
    extra = [x.reshape(-1, 2) for x in unpack(table.column("extra"), np.int64)]
    names = table.column("shard").to_numpy()
    shard = np.repeat(names, [len(k) for k in keys])
    every, ids = np.concatenate(keys), np.concatenate(extra)
    order = np.lexsort((shard, ids[:, 0], every))
    every, shard, often = every[order], shard[order], ids[order, 1] > 0
    head = np.ones(len(every), bool)
    head[1:] = every[1:] != every[:-1]
    owner = shard[np.flatnonzero(head)][np.cumsum(head) - 1] if len(every) else shard
    told = ~head | often  # the first holder needs the window itself only if it recurs there
    rows = []
    for s, at in T.split_by(np.flatnonzero(told), owner[told]):
        rows.append((key[0].as_py(), s, pack(every[at]), pack(shard[at].astype(np.int32))))
    return _keys_table(rows)


def _passages(window: int):
    """Confirmed windows of a shard as passages of text, each with the shards that hold it."""
    schema = pa.schema([("owner", pa.int32()), ("shards", pa.list_(pa.int32())), ("passage", pa.string())])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answer: pa.Table) -> pa.Table:
        if not table.num_rows or not answer.num_rows:
            return schema.empty_table()
        keys = np.concatenate(unpack(answer.column("keys"), np.uint64))
        told = np.concatenate(unpack(answer.column("extra"), np.int32))
        order = np.lexsort((told, keys))
        keys, told = keys[order], told[order]
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        # equal lists of shards get one number, so that neighbouring windows can share a passage
        numbers: dict[bytes, int] = {}
        lists = [numbers.setdefault(told[a:b].tobytes(), len(numbers)) for a, b in zip(head, np.append(head[1:], len(keys)))]
        every, lists = keys[head], np.array(lists)
        shards = [np.frombuffer(x, np.int32) for x in numbers]
        sent = np.zeros(len(every), bool)
        to, texts = [], []
        for part in T.blocks(table, "text"):
            data, offsets = T.buffers(part.column("text"))
            words = T.words_of(data, offsets, T.NOT_WHITE)
            starts = np.flatnonzero(words.last_window(window))
            if not len(starts):
                continue
            hashes = T.Prefix(words.hashes()).slices(starts, starts + window)
            known = T.isin_sorted(hashes, every)
            starts, at = starts[known], np.searchsorted(every, hashes[known])
            first = np.sort(np.unique(at, return_index=True)[1])
            first = first[~sent[at[first]]]
            starts, at = starts[first], at[first]
            sent[at] = True
            if not len(starts):
                continue
            raw, group = data.tobytes(), lists[at]
            cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(group) != 0) | (np.arange(1, len(starts)) % PASSAGE_WINDOWS == 0))
            for a, b in zip(np.append(0, cut + 1).tolist(), np.append(cut, len(starts) - 1).tolist()):
                span = raw[words.starts[starts[a]] : words.ends[starts[b] + window - 1]]
                to.append(shards[group[a]])
                texts.append(b" ".join(span.split()).decode())
        ends = np.cumsum([0, *map(len, to)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *to])))
        return pa.table([pa.array([key[0].as_py()] * len(to), pa.int32()), lists, pa.array(texts, pa.string())], schema=schema)

    return run


def _compile(passages: pa.Table, window: int, gram: int) -> tuple[ahocorasick.Automaton, list[dict[bytes, bool]]]:
    """Automaton of the anchor phrases of passages; entry k holds the windows around phrase k, and whether they occurred."""
    block = _Block(passages, window, gram)
    raw, opens, closes = block.data.tobytes(), block.words.starts.tolist(), block.words.ends.tolist()
    seen = passages.column("foreign").to_numpy()[block.owner(block.valid)].tolist() if len(block.valid) else []
    number: dict[bytes, int] = {}
    entries: list[dict[bytes, bool]] = []
    for s, a, elsewhere in zip(block.valid.tolist(), block.anchor.tolist(), seen):
        phrase = raw[opens[a] : closes[a + gram - 1]]
        k = number.setdefault(phrase, len(entries))
        if k == len(entries):
            entries.append({})
        entries[k][raw[opens[s] : closes[s + window - 1]]] = elsewhere
    trie = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for phrase, k in number.items():
        trie.add_word(" " + phrase.decode("latin-1") + " ", k)
    if entries:
        trie.make_automaton()
    return trie, entries


def _later(text: bytes, trie: ahocorasick.Automaton, entries: list[dict[bytes, bool]], window: int, gram: int) -> np.ndarray:
    """Places of the windows of a text that the automaton finds and that occurred before; marks the others as seen."""
    words = text.split()
    n = len(words)
    if n < window or not entries:
        return np.zeros(0, np.int64)
    line = b" " + b" ".join(words) + b" "
    found = list(trie.iter(line.decode("latin-1")))
    if not found:
        return np.zeros(0, np.int64)
    after = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)  # the blank behind each word
    ends, k = np.array(found, np.int64).T
    place = np.searchsorted(after, ends) - gram + 1
    starts = place[:, None] - np.arange(window - gram + 1)
    inside = (starts >= 0) & (starts <= n - window)
    # a phrase may occur twice in a window: each window counts once for each phrase, from left to right
    pairs = np.unique((starts * len(entries) + k[:, None])[inside])
    starts, k = np.divmod(pairs, len(entries))
    opens = np.append(1, after[:-1] + 1)[starts].tolist()
    closes = after[starts + window - 1].tolist()
    later = []
    for s, e, a, b in zip(starts.tolist(), k.tolist(), opens, closes):
        own = line[a:b]
        before = entries[e].get(own)
        if before:
            later.append(s)
        elif before is not None:
            entries[e][own] = True
    return np.array(later, np.int64)


def _removal(window: int, gram: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, passages: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        texts = table.column("text").cast(pa.large_binary()).fill_null(b"")
        later: list[list[np.ndarray]] = [[] for _ in range(table.num_rows)]
        # the windows of two passages differ, so each piece finds occurrences of its own
        for piece in T.blocks(passages, "text", PASSAGE_BYTES):
            trie, entries = _compile(piece, window, gram)
            for d, text in enumerate(texts):
                starts = _later(text.as_py(), trie, entries, window, gram)
                if len(starts):
                    later[d].append(starts)
        n_words, n_removed, kept = [], [], []
        for text, starts in zip(texts, later):
            words = text.as_py().split()
            n = len(words)
            if starts:
                gone = T.covered(n, np.concatenate(starts), window)
                words = [words[i] for i in np.flatnonzero(~gone).tolist()]
            n_words.append(n)
            n_removed.append(n - len(words))
            kept.append(b" ".join(words).decode())
        return pa.table([table.column("doc_id").combine_chunks(), n_words, n_removed, kept], schema=schema)

    return run


def drop_repeated_phrases(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, gram: int = 10) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` (kept words joined by one space), a row for each row of ``docs``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    n_shards = shard_count(rows)
    n_buckets = max(32, n_shards * (2 << 20) // BUCKET_BYTES)
    sharded = rows.withColumn("shard", shard_of(F.col("doc_id"), n_shards))
    anchors = sharded.groupBy("shard").applyInArrow(_anchors(window, gram, n_buckets), KEYS)
    recurring = anchors.groupBy("bucket").applyInArrow(_recurring, KEYS)
    windows = sharded.groupBy("shard").cogroup(recurring.groupBy("shard")).applyInArrow(_candidates(window, gram, n_buckets), KEYS)
    confirmed = windows.groupBy("bucket").applyInArrow(_confirmed, KEYS)
    passages = sharded.groupBy("shard").cogroup(confirmed.groupBy("shard")).applyInArrow(_passages(window), PASSAGES)
    # a passage leaves its task once, with the list of its shards; the copies are made row by row behind it
    sent = passages.select(F.explode("shards").alias("shard"), "owner", F.col("passage").alias("text")).select(
        "shard", (F.col("owner") != F.col("shard")).alias("foreign"), "text"
    )
    return sharded.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(
        _removal(window, gram), "doc_id long, n_words long, n_removed long, kept_text string"
    )


def op2_repeated_phrases(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = drop_repeated_phrases(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))

"""Spelling variants, found with search schemes over bidirectional FM-indices.

Words are maximal runs of ASCII letters (A-Z lower-cased) and of the characters U+00C0 to U+00FF; a few
occurrences, chosen by a hash of id and word, lose one character.  Words of at least ``min_length`` characters and
``min_count`` occurrences are the vocabulary.  Two words are near if one inserted, deleted or replaced character
tells them apart.  A word's form is its near word with the most occurrences (of equals the first in code-point
order), if that has ``ratio`` times the word's; its root is the end of the chain of forms.

*Index.*  A shard's words, sorted, form the delimited text ``$w0$w1$...$``.  Its suffixes are sorted by prefix
doubling, and the transform that precedes them is stored as a wavelet matrix; the same is done for the words read
backwards.  A pattern is held as its suffix-rank interval in both, so it can grow by one symbol at either end.

*Search scheme.*  One error leaves one half of a word intact.  From the cut between the halves, the pattern first
grows over one half and its delimiter without an error, then, from the cut the other way, over the other half with
one error: wherever it may occur, the symbols that really follow in the interval are tried as inserted or replacing
ones.  A whole ``$v$`` has an interval of one rank, which is the number of the word v.  A near word that shares the
left half is reported by the left scheme alone, so each is reported once.

*Shards.*  A near word that shares a half shares its outer ``min_length // 2`` characters, so words meet by their
first and by their last characters, many such groups in a shard.  A group of over ``SHARD_WORDS`` words is cut in
pieces by hash, and each piece of its words is searched with each piece of its queries, in tasks of their own.
Every word is a query, so each (word, near word) is found from both sides; a task answers with the number and the
best of each query's near words, not with the pairs.

Defined cases: null and blank texts have no words; texts and words of any length are processed whole; a null id
counts as an empty one in the hash; ids are cast to LONG, so one that is no number ends the job.  Repeated rows
count each for itself.  An empty table, or one without such words, gives no row.  Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import textcore as T

MIN_LENGTH, MIN_COUNT, RATIO, TYPO_EVERY = 6, 5, 5, 199
#: words of an index
SHARD_WORDS = 20_000
#: counts that a counting task holds before it sends them on
HELD = 200_000
#: characters of a text from which its words are not listed at once
LONG = 1 << 22
QUERIES = 4096


# ---- vocabulary ------------------------------------------------------------------------------

def _typo(word: str, h: int) -> str:
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, typo_every: int = TYPO_EVERY) -> DataFrame:
    """``word, n`` of all words of at least ``min_length`` characters."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = ["word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)  # shorter ones cannot become longer
        counts: dict[str, int] = {}

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=names)
            counts.clear()
            return out

        for batch in batches:
            for part in T.blocks(batch, "text"):
                data, offsets = T.buffers(part.column("text"))
                raw = T.LOWER[data].tobytes()
                for own, a, b in zip(part.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    low = raw[a:b].decode("utf-8", "replace")
                    of_id = crc32(f"{'' if own is None else own}:".encode())
                    for word in runs.findall(low) if len(low) < LONG else (m[0] for m in runs.finditer(low)):
                        h = crc32(word.encode(), of_id)
                        if h % typo_every == 0:
                            word = _typo(word, h)
                            if len(word) < min_length:
                                continue
                        counts[word] = counts.get(word, 0) + 1
                        if len(counts) > HELD:
                            yield sent()
        yield sent()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---- bidirectional index ---------------------------------------------------------------------

def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes of a delimited text in order.  The words stand sorted, so delimiters rank by place
    (the last one, with nothing behind it, first), and every suffix is decided within its word."""
    n = len(text)
    marks = np.flatnonzero(text == 0)
    rank = len(marks) + text.astype(np.int64)
    rank[marks] = np.arange(1, len(marks) + 1)
    rank[marks[-1]] = 0
    reach = 1
    while True:
        behind = np.zeros(n, np.int64)
        behind[:-reach] = rank[reach:] + 1
        key = rank * (max(n, 512) + 2) + behind
        order = np.argsort(key, kind="stable")
        new = np.append(0, np.cumsum(key[order][1:] != key[order][:-1]))
        rank[order] = new
        if new[-1] == n - 1:
            return order
        reach *= 2


class Transform:
    """Transform of a delimited text as a wavelet matrix: rank intervals grow by the symbol before them."""

    def __init__(self, text: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        left = text[_suffix_order(text) - 1]  # before the first suffix stands the last symbol, a delimiter, too
        self.zeros: list[np.ndarray] = []
        for b in reversed(range(self.bits)):
            bit = (left >> b) & 1
            self.zeros.append(np.append(0, np.cumsum(bit == 0)).astype(np.int64))
            left = np.concatenate([left[bit == 0], left[bit == 1]])
        # from the place at the last level to the rank of the extended suffix
        symbols = np.arange(sigma)
        self.base = np.zeros(sigma, np.int64)
        start, _, _ = self.grow(np.zeros(sigma, np.int64), np.zeros(sigma, np.int64), symbols)
        self.base = np.append(0, np.cumsum(np.bincount(text, minlength=sigma)))[:-1] - start

    def grow(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Interval of ``symbol + pattern`` for each pattern's, and how many of the symbols before the pattern are smaller."""
        less = np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            a, b = zeros[low], zeros[high]
            less += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return low + self.base[symbol], high + self.base[symbol], less

    def fan(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """All symbols before each pattern: (pattern, symbol, its interval, smaller symbols)."""
        own, symbol, less = np.arange(len(low)), np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        for zeros in self.zeros:
            a, b = zeros[low], zeros[high]
            nil, one = np.flatnonzero(b > a), np.flatnonzero(high - b > low - a)
            less = np.append(less[nil], less[one] + (b - a)[one])
            symbol = np.append(symbol[nil] << 1, symbol[one] << 1 | 1)
            low, high = np.append(a[nil], zeros[-1] + (low - a)[one]), np.append(b[nil], zeros[-1] + (high - b)[one])
            own = np.append(own[nil], own[one])
        return own, symbol, low + self.base[symbol], high + self.base[symbol], less


class Index:
    """Bidirectional index over sorted distinct words, each a bytes object of one byte a character."""

    def __init__(self, words: list[bytes]):
        self.words = words
        backwards = sorted(w[::-1] for w in words)
        used = np.unique(np.frombuffer(b"".join(words), np.uint8))
        self.code = np.full(256, -1, np.int64)
        self.code[used] = np.arange(1, len(used) + 1)
        delimited = lambda ws: np.where(t := np.frombuffer(b"\0" + b"\0".join(ws) + b"\0", np.uint8), self.code[t], 0)
        sigma = len(used) + 1
        self.ahead, self.back = Transform(delimited(words), sigma), Transform(delimited(backwards), sigma)
        self.size = sum(map(len, words)) + len(words) + 1

    def near(self, queries: list[bytes], left: bool) -> Iterator[tuple[int, int]]:
        """(query, number of the near word), for near words that share the query's left half, or else the right one."""
        for at in range(0, len(queries), QUERIES):
            some = queries[at : at + QUERIES]
            if left:
                found = self._scheme(self.ahead, self.back, some, [len(q) // 2 for q in some])
                yield from zip((found[0] + at).tolist(), (found[1] - 1).tolist())
            else:  # the same in the mirror
                found = self._scheme(self.back, self.ahead, [q[::-1] for q in some], [len(q) - len(q) // 2 for q in some])
                for q, v in zip(found[0].tolist(), (found[2] - 1).tolist()):
                    cut = len(some[q]) // 2
                    if self.words[v][:cut] != some[q][:cut]:  # else the left scheme reports it
                        yield q + at, v

    def _scheme(self, ahead: Transform, back: Transform, queries: list[bytes], cuts: list[int]):
        """Match ``query[:cut]`` exactly, from the cut to its delimiter, then the rest with one error: the queries,
        and the ranks in both directions, of what is found."""
        code = self.code[np.frombuffer(b"".join(queries), np.uint8)]
        size = np.array([len(q) for q in queries])
        begin, cut = np.cumsum(size) - size, np.array(cuts)
        rest = size - cut
        q = np.arange(len(queries))
        f, r, w = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), self.size)
        for k in range(int(cut.max()) + 1):
            on = np.flatnonzero(cut[q] >= k)
            symbol = np.where(cut[q[on]] > k, code[begin[q[on]] + np.maximum(cut[q[on]] - 1 - k, 0)], 0)
            low, high, less = ahead.grow(f[on], f[on] + w[on], np.maximum(symbol, 0))
            f[on], r[on], w[on] = low, r[on] + less, np.where(symbol < 0, 0, high - low)
            keep = np.flatnonzero(w > 0)
            q, f, r, w = q[keep], f[keep], r[keep], w[keep]
        symbol_at = lambda q, j: np.where(j < rest[q], code[np.minimum(begin[q] + cut[q] + j, len(code) - 1)], 0)
        branches = []
        j = 0
        while len(q):
            here = np.full(len(q), j)
            wanted, after = symbol_at(q, here), symbol_at(q, here + 1)
            # one symbol less; of equal neighbours the last is left out
            gone = np.flatnonzero((j < rest[q]) & (wanted != after))
            branches.append((q[gone], here[gone] + 1, f[gone], r[gone], w[gone]))
            own, symbol, low, high, less = back.fan(r, r + w)
            fanned = q[own], f[own] + less, low, high - low
            # one symbol more; beside an equal one, behind it
            more = np.flatnonzero((symbol > 0) & (symbol != wanted[own]))
            branches.append((fanned[0][more], here[own[more]], *[x[more] for x in fanned[1:]]))
            other = more[j < rest[q[own[more]]]]
            branches.append((fanned[0][other], here[own[other]] + 1, *[x[other] for x in fanned[1:]]))
            on = np.flatnonzero((j < rest[q]) & (wanted > 0))
            low, high, less = back.grow(r[on], r[on] + w[on], wanted[on])
            q, f, r, w = q[on], f[on] + less, low, high - low
            keep = np.flatnonzero(w > 0)
            q, f, r, w = q[keep], f[keep], r[keep], w[keep]
            j += 1
        q, at, f, r, w = (np.concatenate(x) if branches else np.zeros(0, np.int64) for x in (zip(*branches) if branches else [()] * 5))
        done = []
        while len(q):  # what is left of the pattern, without an error
            wanted = symbol_at(q, at)
            on = np.flatnonzero(wanted >= 0)
            low, high, less = back.grow(r[on], r[on] + w[on], wanted[on])
            q, at, f, r, w, ended = q[on], at[on] + 1, f[on] + less, low, high - low, wanted[on] == 0
            whole = np.flatnonzero(ended & (w > 0))
            done.append((q[whole], f[whole], r[whole]))
            keep = np.flatnonzero(~ended & (w > 0))
            q, at, f, r, w = q[keep], at[keep], f[keep], r[keep], w[keep]
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 3


# ---- near words ------------------------------------------------------------------------------

def _answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Number and best of the near words of a shard's queries."""
    counts: dict[bytes, int] = {}
    asked: list[set[bytes]] = [set(), set()]
    for word, n, side, query in zip(*(table.column(c).to_pylist() for c in ("word", "n", "side", "query"))):
        word = word.encode("latin-1")
        if query:
            asked[side].add(word)
        else:
            counts[word] = n
    out: dict[bytes, list] = {}
    if counts:
        index = Index(sorted(counts))
        for side in (0, 1):
            queries = sorted(asked[side])
            for q, v in index.near(queries, left=side == 0):
                near = index.words[v]
                n = counts[near]
                best = out.setdefault(queries[q], [0, 0, b""])
                best[0] += 1
                if n > best[1] or n == best[1] and near < best[2]:
                    best[1:] = n, near
    text = lambda words: pa.array([w.decode("latin-1") for w in words], pa.string())
    return pa.table([text(out), *[pa.array([b[i] for b in out.values()], pa.int64()) for i in (0, 1)], text(b[2] for b in out.values())], names=["word", "n_near", "best_n", "best"])


def near_words(vocabulary: DataFrame, min_length: int = MIN_LENGTH, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n_near, best, best_n`` of each word of ``vocabulary`` (``word, n``) that has near words."""
    half = min_length // 2
    ends = F.array(F.struct(F.lit(0).alias("side"), F.substring("word", 1, half).alias("ends")), F.struct(F.lit(1).alias("side"), F.expr(f"right(word, {half})").alias("ends")))
    rows = vocabulary.select("word", "n", F.explode(ends).alias("e")).select("word", "n", "e.side", "e.ends")
    sizes = rows.groupBy("side", "ends").agg(F.count(F.lit(1)).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = max(16, -(-total // shard_words))
    hot = sizes.where(F.col("size") > shard_words).select("side", "ends", F.ceil(F.col("size") / shard_words).cast("int").alias("pieces"))
    placed = rows.join(hot, ["side", "ends"], "left").withColumn("own", F.pmod(F.xxhash64("word"), F.coalesce("pieces", F.lit(1))).cast("int"))
    # a group of usual size is one cell of a shard; of a larger one each piece meets each piece, in cells of their own
    shard = F.when(F.col("pieces").isNull(), F.pmod(F.xxhash64("side", "ends"), F.lit(shards)).cast("int")).otherwise(-1 - F.col("side"))
    group = F.when(F.col("pieces").isNotNull(), F.col("ends"))
    each = F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))
    common = ["word", "n", "side", shard.alias("shard"), group.alias("group")]
    indexed = placed.select(*common, F.col("own").alias("piece"), each.alias("block"), F.lit(False).alias("query"))
    asked = placed.select(*common, each.alias("piece"), F.col("own").alias("block"), F.lit(True).alias("query"))
    answers = indexed.unionByName(asked).groupBy("shard", "group", "piece", "block").applyInArrow(_answer, "word string, n_near long, best_n long, best string")
    least = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return answers.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("least")).select("word", "n_near", F.col("least.w").alias("best"), (-F.col("least.n")).alias("best_n"))


def chain_ends(forms: DataFrame) -> DataFrame:
    """``word, root`` of each ``word, form``: the last word of its chain.  Forms have more occurrences by a factor,
    so chains are short; each round doubles the steps that were taken."""
    jumps = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumps = jumps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).checkpoint()
        if jumps.where("moved").isEmpty():
            return jumps.drop("moved")
        jumps = jumps.drop("moved")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      typo_every: int = TYPO_EVERY, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, a row for each word of the vocabulary."""
    ensure_checkpoint_dir(docs.sparkSession)
    vocabulary = word_counts(docs, doc_id, text, min_length, typo_every).where(F.col("n") >= min_count).checkpoint()
    found = vocabulary.join(near_words(vocabulary, min_length, shard_words), "word", "left")
    takes = F.col("best_n") >= ratio * F.col("n")
    table = found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n")).checkpoint()
    ends = chain_ends(table.where("form is not null"))
    return table.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_fm_index_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))

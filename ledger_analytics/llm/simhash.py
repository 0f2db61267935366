"""SimHash near-duplicates, searched with BK-trees.

A text is lower-cased (A-Z), cut into words and ``shingle``-word shingles (repeats included); a bit of
the 64-bit fingerprint is 1 if it is set in over half of the shingles' XXH64 values (seed 42).
Fingerprints link at ``radius`` or fewer differing bits, and documents fall into connected components.

Search works on distinct fingerprints.  Their 64 bits are cut into ``radius + 3`` blocks; two linked
fingerprints agree on at least three of them, so each fingerprint goes to one group for every choice of
three blocks (about 38 agreeing bits), and linked ones meet in a group.  A group is a shard tree: a
BK-tree whose children are keyed by their integer Hamming distance to the parent, and where a search
follows only the edges within ``radius`` of its own distance.  Trees are dealt by key rather than
broadcast, because the fingerprints grow with the corpus and have no size bound.  A group with more than
``split_above`` fingerprints is cut further by the bits its key leaves open, with the same guarantee.
Trees emit links that span their group's components, not all pairs; components then join across groups.

Defined cases: null and blank texts have the fingerprint zero, which links like any other; a text of
fewer words than a shingle is one shingle; a null ``doc_id`` never names a component unless all members
lack one.  Texts of any length are hashed whole.  Repeated rows each keep their row, with one fingerprint; an
empty table gives an empty one.  Every input row gives one output row.  :func:`keep_one` carries all columns
through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import textcore as T
from .components import connected_components

SPLIT_ABOVE = 4_000


def fingerprints_of(table: pa.RecordBatch, column: str, shingle: int) -> np.ndarray:
    """64-bit SimHash of every text of a batch."""
    out = np.zeros(table.num_rows, np.uint64)
    done = 0
    digest = xxhash.xxh64_intdigest
    for part in T.blocks(table, column, 1 << 20):
        data, offsets = T.buffers(part.column(column))
        words = T.words_of(T.LOWER[data], offsets, T.NOT_WHITE)
        raw = words.data.tobytes()
        hashes, owner = [], []
        for d in range(part.num_rows):
            own = raw[offsets[d] : offsets[d + 1]].split()
            if not own:
                continue
            line = b" ".join(own)
            if len(own) <= shingle:
                hashes.append(digest(line, 42))
                owner.append(1)
            else:
                a, b = int(words.first[d]), int(words.first[d + 1])
                ends = np.cumsum(words.ends[a:b] - words.starts[a:b] + 1) - 1
                begin = [0, *(ends[: -shingle] + 1).tolist()]
                hashes.extend([digest(line[x:y], 42) for x, y in zip(begin, ends[shingle - 1 :].tolist())])
                owner.append(len(begin))
            owner[-1] = (d, owner[-1])
        if hashes:
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            rows, sizes = np.array(owner).T
            counts = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64)
            majority = counts * 2 > sizes[:, None]
            out[done + rows] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
        done += part.num_rows
    return out


class BKTree:
    """Distinct 64-bit values; ``add`` returns the earlier values within ``radius`` that span the groups met."""

    def __init__(self, radius: int):
        self.radius, self.values, self.children, self.parent = radius, [], [], []

    def _root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, value: int) -> list[int]:
        me, near, links = len(self.values), self.radius, []
        self.values.append(value)
        self.children.append({})
        self.parent.append(me)
        if not me:
            return links
        stack = [0]
        while stack:
            at = stack.pop()
            d = (value ^ self.values[at]).bit_count()
            if d <= near:
                root = self._root(at)
                if root != self._root(me):  # a new component: one link spans it
                    self.parent[self._root(me)] = root
                    links.append(self.values[at])
            kids = self.children[at]
            if kids:
                stack.extend(kids[k] for k in range(d - near, d + near + 1) if k in kids)
        at = 0
        while True:
            d = (value ^ self.values[at]).bit_count()
            if d not in self.children[at]:
                self.children[at][d] = me
                return links
            at = self.children[at][d]


def _search(radius: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tree, a, b = BKTree(radius), [], []
        for value in sorted(x & (1 << 64) - 1 for x in set(table.column("f").to_pylist())):
            for other in tree.add(value):
                a.append(value)
                b.append(other)
        to = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
        return pa.table([to(a), to(b)], names=["a", "b"])

    return run


def _cuts(bits: list[int], parts: int) -> list[list[int]]:
    size = -(-len(bits) // parts)
    return [bits[i * size : (i + 1) * size] for i in range(parts)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def similar_links(prints: DataFrame, radius: int = 2, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Links ``a, b`` that connect all values of the distinct column ``f`` within ``radius`` bits."""
    blocks = _cuts(list(range(64)), radius + 3)
    choices = list(combinations(range(len(blocks)), 3))
    masks = [_mask([x for c in choice for x in blocks[c]]) for choice in choices]
    keyed = prints.select(
        "f", F.explode(F.array(*[F.struct(F.lit(i).alias("way"), F.col("f").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)])).alias("g")
    ).select("f", "g.way", "g.k")
    sizes = keyed.groupBy("way", "k").count().where("count > 1")
    # few groups are large; those are cut by each part of the bits that their key leaves open
    inner = []
    for choice in choices:
        open_bits = [x for c in range(len(blocks)) if c not in choice for x in blocks[c]]
        inner.append([_mask(part) for part in _cuts(open_bits, radius + 1)])
    parts = [
        F.element_at(F.array(*[F.lit(ways[j]) for ways in inner]), F.col("way") + 1).bitwiseAND(F.col("f")) for j in range(radius + 1)
    ]
    small, large = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("sub"))), F.array(*[F.struct(F.lit(j).alias("part"), p.alias("sub")) for j, p in enumerate(parts)])
    groups = (
        keyed.join(sizes, ["way", "k"])
        .select("f", "way", "k", F.explode(F.when(F.col("count") > split_above, large).otherwise(small)).alias("s"))
        .select("f", "way", "k", "s.part", "s.sub")
    )
    return groups.groupBy("way", "k", "part", "sub").applyInArrow(_search(radius), "a long, b long").distinct()


def _components(spark, rows: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Of ``rows`` (doc_id, text): the checkpointed fingerprints with a hash of the text, and each fingerprint's group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = fingerprints_of(batch, "text", shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(own)], names=["doc_id", "text_key", "simhash"])

    ensure_checkpoint_dir(spark)
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    prints = keyed.mapInArrow(run, "doc_id long, text_key long, simhash long").checkpoint()  # three numbers a document, read again below
    distinct = prints.groupBy(F.col("simhash").alias("f")).agg(F.min("doc_id").alias("least"))
    labels = connected_components(spark, similar_links(distinct.select("f"), radius))
    named = distinct.join(labels, distinct.f == labels.node, "left").select("f", "least", F.coalesce("label", "f").alias("label"))
    groups = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return prints, named.join(groups, "label").select(F.col("f").alias("simhash"), "label", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id, simhash (long), component_id``, a row for each row of ``docs``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    prints, groups = _components(docs.sparkSession, rows, shingle, radius)
    return prints.join(groups, "simhash").select("doc_id", "simhash", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: that of the least ``doc_id`` (of equal rows, any one).

    Of several rows with that id, the one with the least fingerprint, then the least text hash, stays.  Texts are
    fingerprinted once; rows are found again by id and text hash, in one exchange, equal ones already made one
    before it.
    """
    own_id = F.col(doc_id).cast("long")
    rows = docs.select(own_id.alias("doc_id"), F.col(text).cast("string").alias("text"))
    prints, groups = _components(docs.sparkSession, rows, shingle, radius)
    # a null id as a flag beside a number, so that plain equality will do
    place, none, key = (T.unused(docs, n) for n in ("_id", "_no_id", "_key"))
    stays = (
        prints.join(groups, "simhash").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("label").agg(F.min(F.struct("simhash", "text_key")).alias("least"), F.first("component_id").alias("id"))
        .select(F.coalesce("id", F.lit(0)).alias(place), F.col("id").isNull().alias(none), F.col("least.text_key").alias(key))
    )
    nth = T.unused(docs, "_nth")
    marked = docs.withColumns({place: F.coalesce(own_id, F.lit(0)), none: own_id.isNull(), key: F.xxhash64(F.col(text).cast("string"))})
    one = Window.partitionBy(place, none, key).orderBy(F.lit(0))
    firsts = marked.withColumn(nth, F.row_number().over(one)).where(F.col(nth) == 1)
    return firsts.join(stays, [place, none, key], "left_semi").select(*docs.columns)


def op3_simhash_bk_trees(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")

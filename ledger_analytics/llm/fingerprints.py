"""Document fingerprints as invertible Bloom lookup sketches, with DataFrame operations only.

A document is the set of its paragraph digests: lines, of which a long one is cut at the first sentence end
after ``PIECE`` characters.  If none follows within ``STRETCH`` characters, it is cut where the content says
so (before certain letters after a blank, else after certain characters), or else after the stretch.  A sketch
has three groups of cells; every digest enters one cell of each group, where counts add up and digests and
check values are combined by exclusive or.  Every version has a sketch of its own; subtracting the cells of
two versions leaves the digests that differ, and peeling recovers them one pure cell after the other.

The ``fingerprint`` string is the sketch of the whole version (18 cells of count, digest and check value), so
equal texts have equal fingerprints, and two fingerprints can be subtracted and peeled.  Where more digests
differ than these cells resolve, both versions are sketched again, larger: one sketch for each ``LOAD`` digests of the two,
dealt by hash, so work and memory stay linear in the length of the texts.  One that doesn't peel is tried
again with more cells, twice; the digests themselves are compared if that fails too.

Likeness is the Jaccard index of the digest sets, which follows from the two set sizes (the counts of a group of
cells) and the number of recovered digests.  ``differing`` lists the digests recovered between a text and its
edited form: ``-`` and hexadecimal digits for one that the edit removed, ``+`` for one that it brought.

Neighbours: documents are cut into ranges of ``doc_id`` at (approximate) quantiles, and the row that follows
a range is copied into it, so that "next document" is a window inside each range.

Defined cases: a null text is empty; two empty texts are alike (1.0); rows that share a ``doc_id`` are
ordered by their texts; a null ``doc_id`` counts as the least.  A lone row is its own next document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIECE = 120
STRETCH = 120
#: sentence ends of several scripts; letters, digits and parts of scripts without blanks at which a cut may fall
END = ".!?\u3002\uff01\uff1f\uff61\u0964\u0965\u061f\u06d4"
CUT = "aeorAEOR05" + "".join(f"{chr(c)}-{chr(c + 15)}" for c in range(0x400, 0xD700, 0x400))
PARAGRAPH = (
    f"[^\\n]{{{PIECE}}}(?:[^\\n{END}]{{0,{STRETCH}}}[{END}]+|[^\\n{END}]{{0,{STRETCH}}}?[ \\t](?=[{CUT}])"
    f"|[^\\n{END}]{{0,{STRETCH}}}?[{CUT}]|[^\\n{END}]{{0,{STRETCH}}})|[^\\n]+"
)
LOAD = 6
#: cells of a group, first try and retries; the cells of a sketch are the bits of a long
WIDTHS = (6, 12, 20)
ROUNDS = 12


def digests(text: str) -> str:
    """Sorted distinct paragraph digests of a text column."""
    return f"array_sort(array_distinct(transform(regexp_extract_all({text}, r'{PARAGRAPH}', 0), p -> xxhash64(p))))"


def _mask(key: str, width: int) -> str:
    """The three cells of a digest, as bits."""
    return " | ".join(f"shiftleft(1L, cast({width * g} + pmod(shiftright({key}, {13 + 13 * g}), {width}) as int))" for g in range(3))


def sketch(keys: str, width: int) -> str:
    """Cells ``(n, k, h)`` of an array of digests."""
    placed = f"transform({keys}, k -> named_struct('k', k, 'h', xxhash64(k), 'm', {_mask('k', width)}))"
    return f"""element_at(transform(array({placed}), placed -> transform(sequence(0, {3 * width - 1}), i -> aggregate(
        filter(placed, x -> (x.m & shiftleft(1L, i)) != 0L), named_struct('n', 0, 'k', 0L, 'h', 0L),
        (a, x) -> named_struct('n', a.n + 1, 'k', a.k ^ x.k, 'h', a.h ^ x.h)))), 1)"""


def subtract(own: str, other: str) -> str:
    """The cells of one version less those of another."""
    return f"zip_with({own}, {other}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h))"


def peel(cells: str, width: int) -> str:
    """Digests ``(k, s)`` that differ, ``s`` 1 for the first version and -1 for the second, or null if peeling gets stuck."""
    pure = f"""array_distinct(transform(filter(st.cells, c -> abs(c.n) = 1 and c.h = xxhash64(c.k)),
        c -> named_struct('k', c.k, 's', c.n, 'h', c.h, 'm', {_mask('c.k', width)})))"""
    without = """transform(u.cells, (c, i) -> aggregate(filter(pure, p -> (p.m & shiftleft(1L, i)) != 0L), c,
        (a, p) -> named_struct('n', a.n - p.s, 'k', a.k ^ p.k, 'h', a.h ^ p.h)))"""
    step = f"""aggregate(array({pure}), st, (u, pure) -> case when size(pure) = 0 then u else named_struct(
        'cells', {without}, 'got', concat(u.got, transform(pure, p -> named_struct('k', p.k, 's', p.s)))) end)"""
    return f"""aggregate(sequence(1, {ROUNDS}), named_struct('cells', {cells}, 'got', cast(array() as array<struct<k:bigint,s:int>>)),
        (st, r) -> {step}, st -> case when forall(st.cells, c -> c.n = 0 and c.k = 0L and c.h = 0L) then st.got end)"""


def recovered(own: str, other: str) -> str:
    """Digests that differ between two arrays of digests: both are sketched, larger at each retry."""
    only = lambda a, b, s: f"transform(array_except({a}, {b}), k -> named_struct('k', k, 's', {s}))"
    tries = [peel(subtract(sketch(own, w), sketch(other, w)), w) for w in WIDTHS]
    return f"coalesce({', '.join(tries)}, concat({only(own, other, 1)}, {only(other, own, -1)}))"


def as_text(cells: str) -> str:
    """A sketch as text: count, digest and the low half of the check value of each cell, hexadecimal."""
    return f"array_join(transform({cells}, c -> lower(concat(hex(c.n), '.', lpad(hex(c.k), 16, '0'), '.', lpad(hex(c.h & 4294967295L), 8, '0')))), '-')"


def digest_count(cells: str, width: int) -> str:
    """Number of digests in a sketch: every one counts once in each group of cells."""
    return f"aggregate(slice({cells}, 1, {width}), 0, (n, c) -> n + c.n)"


def _constant(values: list[int]):
    """An array literal (parsed once, folded by the optimiser)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def with_next(rows: DataFrame, columns: list[str], ranges: int) -> DataFrame:
    """``rows`` (doc_id, text, ...) with ``range``, ``nth`` (place in it) and ``next_<column>`` of the following row, descending ``doc_id``."""
    shares = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("doc_id", F.array(*[F.lit(s) for s in shares]), 10_000).alias("cuts"), F.max("doc_id").alias("top")).first()
    cuts = sorted({*(bounds["cuts"] or []), *([bounds["top"]] if bounds["top"] is not None else [])})
    # range r holds the ids in (cut r - 1, cut r]; a null id is in range 0
    step = max(1, int(len(cuts) ** 0.5))
    listed, coarse = _constant(cuts), _constant(cuts[step - 1 :: step])  # looked up in two steps, as there may be many
    below = lambda some: F.size(F.filter(some, lambda c: c < F.col("doc_id")))
    block = below(coarse)
    own = F.when(F.col("doc_id").isNull(), 0).otherwise(block * step + below(F.slice(listed, block * step + 1, step))).cast("int")
    # the first of range r (its cut) follows the last of range r + 1; the very first follows the last of range 0
    top = F.lit(bounds["top"]).cast("long")
    after = F.when(F.col("doc_id").eqNullSafe(top), 0).when(F.get(listed, own) == F.col("doc_id"), own + 1)
    homes = F.filter(F.array(F.struct(own.alias("range"), F.lit(0).alias("copy")), F.struct(after.alias("range"), F.lit(1).alias("copy"))), lambda h: h["range"].isNotNull())
    dealt = rows.select("*", F.explode(homes).alias("_home")).select(*rows.columns, "_home.range", "_home.copy")
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    return (
        dealt.select("*", F.row_number().over(order).alias("nth"), *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
        .where("copy = 0").drop("copy")
    )


def sketch_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, differing``, a row for each row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("keys", F.expr(digests("text")))
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    paired = with_next(rows, ["text", "keys"], ranges).withColumn("n_chars", F.length("text").cast("long"))
    paired = paired.withColumn("edited", F.expr("concat(substring(text, 1, int(n_chars - n_chars div 3)), substring(next_text, 1, int(n_chars div 3)))"))
    paired = paired.select(
        "range", "nth", "doc_id", "n_chars", "keys", "next_keys", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.expr(digests("edited")).alias("edited_keys"),
    )
    first = WIDTHS[0]
    sketched = paired.select("*", *[F.expr(sketch(keys, first)).alias(cells) for keys, cells in (("keys", "own"), ("edited_keys", "edited"), ("next_keys", "next"))])
    # first the fingerprints themselves are subtracted
    tried = sketched.select("*", F.expr(peel(subtract("own", "edited"), first)).alias("got_edited"), F.expr(peel(subtract("own", "next"), first)).alias("got_next"))
    whole = F.expr(f"""named_struct('doc_id', doc_id, 'n_chars', n_chars, 'edited_sha256', edited_sha256,
        'fingerprint', {as_text('own')}, 'edited_fingerprint', {as_text('edited')},
        'own_n', {digest_count('own', first)}, 'edited_n', {digest_count('edited', first)}, 'next_n', {digest_count('next', first)},
        'got_edited', got_edited, 'd_next', if(got_next is null, null, size(got_next)))""")
    # what the fingerprints don't resolve is dealt to larger sketches
    entry = lambda side, version, keys, other: f"""transform({keys}, k -> named_struct('side', {side},
        'sub', cast(pmod(xxhash64(k), (size({keys}) + size({other}) + {LOAD - 1}) div {LOAD}) as int), 'x', named_struct('v', {version}, 'k', k)))"""  # noqa: E731
    pair = lambda side, other, got: f"if({got} is null, concat({entry(side, 0, 'keys', other)}, {entry(side, 1, other, 'keys')}), array())"
    # the range is the only exchange: all further groups lie inside it
    dealt = tried.select("range", "nth", whole.alias("whole"), F.posexplode_outer(F.expr(f"concat({pair(0, 'edited_keys', 'got_edited')}, {pair(1, 'next_keys', 'got_next')})")).alias("at", "e"))
    dealt = dealt.select("range", "nth", F.when(F.coalesce("at", F.lit(0)) == 0, F.col("whole")).alias("whole"), "e.side", "e.sub", "e.x")
    subs = dealt.groupBy("range", "nth", "side", "sub").agg(F.collect_list("x").alias("xs"), F.first("whole", ignorenulls=True).alias("whole"))
    version = lambda v: F.expr(f"transform(filter(xs, x -> x.v = {v}), x -> x.k)")
    halves = subs.select("range", "nth", "side", "whole", version(0).alias("a"), version(1).alias("b"))
    peeled = halves.select("range", "nth", "side", "whole", F.expr(recovered("a", "b")).alias("got"))
    done = peeled.groupBy("range", "nth").agg(
        F.flatten(F.collect_list(F.when(F.col("side") == 0, F.col("got")))).alias("more_edited"),
        F.sum(F.when(F.col("side") == 1, F.size("got"))).alias("more_next"), F.first("whole", ignorenulls=True).alias("w"))
    done = done.select("w", F.coalesce("w.got_edited", "more_edited").alias("got"), F.coalesce("w.d_next", "more_next", F.lit(0)).alias("d_next"))
    done = done.select("*", F.size("got").alias("d_edited"))
    near = lambda other, d: F.when(F.col("w.own_n") + F.col(other) == 0, F.lit(1.0)).otherwise(
        (F.col("w.own_n") + F.col(other) - F.col(d)) / (F.col("w.own_n") + F.col(other) + F.col(d)).cast("double"))
    differing = "array_join(array_sort(transform(got, g -> concat(if(g.s = 1, '-', '+'), lower(lpad(hex(g.k), 16, '0'))))), ',')"
    return done.select(
        "w.doc_id", "w.n_chars", "w.edited_sha256", "w.fingerprint", "w.edited_fingerprint",
        near("w.edited_n", "d_edited").alias("near_edited"), near("w.next_n", "d_next").alias("near_next"), F.expr(differing).alias("differing"),
    )


def op1_lookup_sketches(spark, sf_dir: str) -> DataFrame:
    return sketch_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

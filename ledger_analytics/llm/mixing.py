"""Mixing sources to target weights, with DataFrame operations only.

The words of a source, in a fixed order of its documents, are packed into blocks of ``block`` words.
Output shards draw their source counts from a multinomial distribution, a draw for each slot; the slots
of a source are numbered through the shards, mapped through a pseudorandom permutation of the source's
block indices (a new one for each pass over the source), and joined to the blocks by index.

Targets: sources in code-point order (null last) weigh ``weights`` in turn and share the total size; a
target stops at ``cap`` times its source's size, and the excess is shared again by weight.  Draws beyond a
source's target are dropped and missing ones are dealt to shards by hash, so each source ends within a
block of its target, no block is used more often than ``cap`` times, and reruns agree.

A hot source is split: its documents are ordered by (first ``CHUNK_DIGITS`` hex digits of the id's MD5,
``doc_id``), so running totals are summed per chunk first.

Defined cases: null and blank texts have size 0 and take 0; a null source is one source; repeated rows
each have their own words.  Every input row gives one output row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# ---- fixed values ---------------------------------------------------------------------------
WORD = r"[^\x20\x09-\x0D]+"
#: large primes: a multiplier that doesn't divide the number of blocks permutes their indices
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)
CHUNK_DIGITS = 3
#: cells of the draw: a source owns a range of them in proportion to its slots
GRID = 1 << 16
BLOCK = 64
SHARD_SLOTS = 1 << 14


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block: int = BLOCK) -> DataFrame:
    """A row for each source: ``source, sid, source_size, target, blocks, passes, extra, slots``.

    Windows without a key run over one row for each source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", turn.cast("double")).withColumn("most", F.col("source_size") * float(cap))
    by_need = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = ranked.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    # the first source in order of need that its share fits sets the level for all
    targets = leveled.withColumn("level", F.first(fits, ignorenulls=True).over(by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    targets = targets.withColumn("target", F.round(F.least("most", F.col("level") * F.col("weight")), 6))
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    extra = F.when(F.col("source_size") > 0, F.least("blocks", F.round(rest * F.col("blocks") / F.col("source_size")))).otherwise(0).cast("long")
    return (
        targets.withColumn("blocks", blocks).withColumn("passes", passes).withColumn("extra", extra)
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.col("extra"))
        .select("source", "sid", "source_size", "target", "blocks", "passes", "extra", "slots")
    )


def pack_blocks(sized: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``sized`` with each row's place in its source's words, and the rows' shares of blocks."""
    chunk = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, CHUNK_DIGITS)
    chunked = sized.withColumn("chunk", chunk)
    inside = Window.partitionBy("sid", "chunk").orderBy(F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunked.groupBy("sid", "chunk").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("sid", "chunk", F.coalesce(F.sum("words").over(earlier), F.lit(0).cast("long")).alias("base"))
    placed = (
        chunked.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
        .join(chunks, ["sid", "chunk"]).withColumn("place", F.col("base") + F.col("inner")).drop("chunk", "base", "inner")
    )
    shares = placed.where("size > 0").select(
        "sid", "place", "size", "doc_id",
        F.explode(F.expr(f"sequence(place div {block}, (place + size - 1) div {block})")).alias("index"),
    ).select(
        "sid", "index", "place", "size", "doc_id",
        F.greatest(F.col("place"), F.col("index") * block).alias("from_word"),
        F.least(F.col("place") + F.col("size"), (F.col("index") + 1) * block).alias("to_word"),
    )
    return placed, shares


def draw_slots(targets: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``sid, slot, shard, index``: every slot of the mix, with the block of its source that fills it."""
    spark = targets.sparkSession
    total = targets.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // shard_slots))
    by_source = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.floor(F.sum("slots").over(by_source) * GRID / max(total, 1)).cast("long")
    ranges = targets.withColumn("upto", upto).withColumn("from", F.coalesce(F.lag("upto").over(Window.orderBy("sid")), F.lit(0).cast("long")))
    cells = ranges.where("upto > from").select("sid", F.explode(F.expr("sequence(from, upto - 1)")).alias("cell"))  # GRID rows at most
    draws = spark.range(total).select(
        F.expr(f"id div {shard_slots}").alias("shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(GRID)).alias("cell")
    )
    counts = draws.join(cells, "cell").groupBy("sid", "shard").agg(F.count("*").alias("n"))
    numbered = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)))
    drawn = numbered.join(targets.select("sid", "slots"), "sid").withColumn("first", F.col("upto") - F.col("n"))
    drawn = drawn.where("first < slots").select("sid", "shard", F.explode(F.expr("sequence(first, least(upto, slots) - 1)")).alias("slot"))
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    short = targets.join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0).cast("long"))).where("got < slots")
    dealt = short.select("sid", F.explode(F.expr("sequence(got, slots - 1)")).alias("slot"))
    dealt = dealt.select("sid", F.pmod(F.xxhash64(F.lit(seed + 1), "sid", "slot"), F.lit(shards)).alias("shard"), "slot")
    slots = drawn.unionByName(dealt).join(targets.select("sid", "blocks"), "sid")
    turn = F.expr("slot div blocks")
    prime = F.element_at(F.array(*[F.lit(p).cast("long") for p in PRIMES]), ((F.col("sid") + turn) % len(PRIMES) + 1).cast("int"))
    second = F.element_at(F.array(*[F.lit(p).cast("long") for p in PRIMES]), ((F.col("sid") + turn + 1) % len(PRIMES) + 1).cast("int"))
    factor = F.when(prime % F.col("blocks") == 0, F.when(F.col("blocks") == 1, F.lit(1).cast("long")).otherwise(second)).otherwise(prime)
    shift = (F.col("sid") * F.lit(2654435761).cast("long") + turn * F.lit(40503).cast("long") + F.lit(seed)) % F.col("blocks")
    place = (factor % F.col("blocks")).cast("decimal(18,0)") * (F.col("slot") % F.col("blocks")).cast("decimal(18,0)")
    return slots.select("sid", "slot", "shard", ((place + shift.cast("decimal(18,0)")) % F.col("blocks").cast("decimal(18,0)")).cast("long").alias("index"))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block: int = BLOCK, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The mix as word ranges, and each row's part in it.

    First: ``shard, slot, sid, index, doc_id, from_word, to_word`` (words counted within the source).
    Second: ``doc_id, source, size, source_size, target, taken``, a row for each row of ``docs``.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    sized = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ).checkpoint()  # three small columns, used below several times
    targets = source_targets(sized, weights, cap, block).checkpoint()  # a row for each source
    sized = sized.join(targets.select(F.col("source").alias("_s"), "sid"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    placed, shares = pack_blocks(sized, block)
    manifest = draw_slots(targets, seed).join(shares, ["sid", "index"])
    taken = manifest.groupBy("sid", "place", "size").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    report = (
        placed.join(taken, ["sid", "place", "size"], "left").join(targets.select("sid", "source_size", "target"), "sid")
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    )
    return manifest.select("shard", "slot", "sid", "index", "doc_id", "from_word", "to_word"), report


def op9_multinomial_blocks(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs)[1].select("doc_id", "size", "source_size", "target", "taken")


#: the same arithmetic in DuckDB; the draw of shards doesn't change what each source takes
OP9_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {CHUNK_DIGITS}) AS chunk
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM totals),
weighed AS (SELECT *, [5.0, 2.0, 1.0][(sid % 3 + 1)::INT]::DOUBLE AS weight, source_size * 3.0::DOUBLE AS most FROM ranked),
leveled AS (
  SELECT *, ((SELECT sum(source_size) FROM totals)::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (
  SELECT source, sid, source_size,
    round(least(most, weight * (SELECT arg_min(level, most / weight) FROM leveled WHERE level * weight <= most)), 6) AS target,
    ceil(source_size / {BLOCK})::BIGINT AS blocks FROM leveled),
passed AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM targets),
counted AS (
  SELECT *, passes * blocks + CASE WHEN source_size > 0 THEN least(blocks, round((target - passes * source_size) * blocks / source_size))::BIGINT ELSE 0 END AS slots FROM passed),
slot AS (SELECT sid, blocks, unnest(range(slots)) AS slot FROM counted),
chosen AS (
  SELECT sid, ((CASE WHEN blocks = 1 THEN 1 ELSE {list(PRIMES)}[((sid + slot // blocks) % {len(PRIMES)} + 1)::INT] END % blocks)::HUGEINT * (slot % blocks)
    + (sid * 2654435761 + (slot // blocks) * 40503) % blocks) % blocks AS idx, count(*) AS uses
  FROM slot GROUP BY ALL),
placed AS (
  SELECT s.doc_id, s.size, r.sid, (sum(s.size) OVER (PARTITION BY r.sid ORDER BY s.chunk, s.doc_id NULLS LAST, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size)::BIGINT AS place
  FROM sized s JOIN ranked r ON s.source IS NOT DISTINCT FROM r.source),
shares AS (
  SELECT sid, place, size, unnest(range(place // {BLOCK}, (place + size - 1) // {BLOCK} + 1)) AS idx FROM placed WHERE size > 0),
taken AS (
  SELECT h.sid, h.place, h.size, sum(c.uses * (least(h.place + h.size, (h.idx + 1) * {BLOCK}) - greatest(h.place, h.idx * {BLOCK})))::BIGINT AS taken
  FROM shares h JOIN chosen c ON h.sid = c.sid AND h.idx = c.idx GROUP BY ALL)
SELECT p.doc_id, p.size, c.source_size, c.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM placed p JOIN counted c ON p.sid = c.sid
LEFT JOIN taken t ON p.sid = t.sid AND p.place = t.place AND p.size = t.size
"""

"""Connected components of an edge table, by repeated least-label steps with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b): label is the least node it is linked to.

    Alternating large-star and small-star steps: each turns the edges of a node into links to the least
    node it knows.  Pairs are made per edge, never per pair of neighbours, and after a logarithmic number
    of rounds every node links straight to its label.  The edge table is checkpointed each round, so a
    lost executor repeats one round at most.
    """
    ensure_checkpoint_dir(spark)
    links = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct().checkpoint()
    if links.isEmpty():
        return links.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
    while True:
        # large star: every larger neighbour of a node links to the least of the node's neighbourhood
        both = links.selectExpr("hi as u", "lo as v").unionAll(links.selectExpr("lo as u", "hi as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: a node and its smaller neighbours link to the least of them
        tops = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = (
            large.withColumnRenamed("hi", "u").join(tops, "u")
            .select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("u").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.*").where("hi <> lo").distinct()
        )
        fresh = small.checkpoint()
        same = fresh.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x"), F.sum(F.pmod(F.xxhash64("hi", "lo"), F.lit(1 << 31))).alias("s")).first()
        was = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x"), F.sum(F.pmod(F.xxhash64("hi", "lo"), F.lit(1 << 31))).alias("s")).first()
        links = fresh
        if same == was:
            break
    stars = links.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
    roots = stars.select(F.col("label").alias("node"), "label").distinct()
    return stars.unionAll(roots)

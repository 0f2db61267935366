"""Chat formatting with cumulative-snapshot collapse.

Loggers often store a conversation again after every turn.  A conversation whose turns (role and text, in
order) are the first turns of a longer one is dropped, and of equal ones the least ``conv_id`` stays; the
maximal conversations are rendered.

A prefix is known by its length and two 64-bit hashes that roll over the turns (exclusive or of each turn's
hash together with its place), so all prefixes of a conversation come from one running window.  Prefixes are
made distinct before the anti-join: a first turn that a third of all conversations share is one row.

Template: every turn becomes ``<|role|>`` newline, the text, newline; the conversation ends with ``<|end|>``.

Defined cases: turns are ordered by (turn, role, text) with nulls first; a null role is ``unknown``, a null text
is empty; rows without a ``conv_id`` are one conversation; repeated rows are repeated turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def maximal_conversations(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Turns (``conv_id, place, role, text``) of the conversations that no other one contains as a prefix."""
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = by_turn.rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.select("conv_id", F.row_number().over(by_turn).alias("place"), "role", "text")
    hashed = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = placed.select(
        "conv_id", "place",
        F.bit_xor(F.xxhash64("place", "role", "text")).over(hashed).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "text", "place", "role")).over(hashed).alias("h2"),
    )
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct("place", "h1", "h2")).alias("w")).select("conv_id", "w.place", "w.h1", "w.h2")
    distinct = whole.groupBy("place", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    shorter = (
        prefixes.join(whole.select("conv_id", F.col("place").alias("n")), prefixes.conv_id.eqNullSafe(whole.conv_id)).where("place < n")
        .select("place", "h1", "h2").distinct()
    )
    kept = distinct.join(shorter, ["place", "h1", "h2"], "left_anti").select(F.col("conv_id").alias("_kept"))
    return placed.join(kept, F.col("conv_id").eqNullSafe(F.col("_kept")), "left_semi")


def render(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, rendered`` of turns as :func:`maximal_conversations` returns them."""
    line = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n"))
    parts = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", line.alias("line")))).alias("parts"))
    return parts.select("conv_id", F.size("parts").cast("long").alias("n_turns"), F.concat(F.array_join("parts.line", ""), F.lit("<|end|>")).alias("rendered"))


def op7_snapshot_collapse(spark, sf_dir: str) -> DataFrame:
    return render(maximal_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


#: prefixes compared as text, in DuckDB
OP7_SQL = """
WITH placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS place,
         '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS line
  FROM conversations),
prefixes AS (
  SELECT conv_id, place, string_agg(line, chr(0) ORDER BY place) OVER (PARTITION BY conv_id ORDER BY place) AS so_far,
         count(*) OVER (PARTITION BY conv_id) AS n FROM placed),
whole AS (SELECT min(conv_id) AS conv_id, n, so_far FROM prefixes WHERE place = n GROUP BY n, so_far),
shorter AS (SELECT DISTINCT place AS n, so_far FROM prefixes WHERE place < n),
kept AS (SELECT conv_id FROM whole w WHERE NOT EXISTS (SELECT 1 FROM shorter s WHERE s.n = w.n AND s.so_far = w.so_far))
SELECT p.conv_id, count(*)::BIGINT AS n_turns, string_agg(line, '' ORDER BY place) || '<|end|>' AS rendered
FROM placed p JOIN kept k ON p.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY p.conv_id
"""

"""Records of delimited text whose quoted values hold line breaks, cut in splits.

Where a split begins, nobody can tell from its own text whether it begins inside
a quoted value.  So every block of a file first reports what it does to the
reader's state: the state at its end for each state at its start.  These small
tables are composed along each file (a prefix scan, one entry a block), which
gives the state at every block's start; then every block is cut into records by
itself.  Only the ends of blocks that a record crosses, two pieces a block at
most, move between tasks.

A quote opens a value at the start of a field only; inside, two quotes are one
quote, and one ends the value.  A quote anywhere else is an ordinary character.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: the reader's state: at the start of a record, at the start of a later field, within an unquoted value,
#: within a quoted one, behind a quote within one
RECORD, FIELD, PLAIN, QUOTED, CLOSING = range(5)
#: blocks inside a value that are sent to all tasks at once; more of them are joined
SENT_BLOCKS = 10_000
#: characters of a record that is put together from the ends of blocks; the ends of a longer one stay apart
LONGEST_RECORD = 1 << 26


class Reader:
    """Steps over text from one state to the next by searching, not character by character."""

    def __init__(self, sep: str):
        self.ends = {sep: FIELD, "\n": RECORD}
        self.opening = re.compile(f"[{re.escape(sep)}\n]\"")

    def over(self, text: str, state: int, cuts: list[int] | None = None) -> int:
        """The state behind ``text``; ``cuts`` gets the places behind the line breaks that end a record."""
        at, n = 0, len(text)
        while at < n:
            if state == QUOTED:
                close = text.find('"', at)
                if close < 0:
                    return QUOTED
                at, state = close + 1, CLOSING
            elif state == CLOSING and text[at] == '"' or state in (RECORD, FIELD) and text[at] == '"':
                at, state = at + 1, QUOTED
            else:
                opens = self.opening.search(text, at)
                upto = opens.end() - 1 if opens else n
                if cuts is not None:
                    line = text.find("\n", at, upto)
                    while line >= 0:
                        cuts.append(line + 1)
                        line = text.find("\n", line + 1, upto)
                if not opens:
                    return self.ends.get(text[-1], PLAIN)
                at, state = opens.end(), QUOTED
        return state


def _blocks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    """(path, block, is its first row, further columns' values) of the rows, in order; blocks are not interleaved."""
    last = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("path", "block", *columns))):
            yield *row[:2], row[:2] != last, *row[2:]
            last = row[:2]


def _effects(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, key, effect = Reader(sep), None, None
        done: list[tuple] = []

        def sent():
            columns = list(zip(*done)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.list_(pa.int32())))], names=["path", "block", "effect"])

        for path, block, new, value in _blocks(batches, ("value",)):
            if new:
                if key is not None:
                    done.append((*key, effect))
                key, effect = (path, block), list(range(5))
            behind = {s: reader.over(value, s) for s in set(effect)}
            effect = [behind[s] for s in effect]
            if len(done) > 10_000:
                yield sent()
                done.clear()
        if key is not None:
            done.append((*key, effect))
        yield sent()

    return run


def _compose(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """State at the start of each block of a file."""
    blocks = np.array(table.column("block"))
    order = np.argsort(blocks)
    effects = table.column("effect").to_pylist()
    state, out = RECORD, np.zeros(len(blocks), np.int32)
    for i in order.tolist():
        out[i], state = state, effects[i][state]
    return pa.table([table.column("path"), table.column("block"), pa.array(out)], names=["path", "block", "state"])


def block_states(pieces: DataFrame, sep: str, whole_lines: bool = False) -> DataFrame:
    """``path, block, state`` of the blocks that do not begin with a record."""
    # within whole lines, those without a quote change nothing at the ends of lines
    telling = pieces.where(F.col("value").contains('"')) if whole_lines else pieces
    effects = telling.select("path", "block", "value").mapInArrow(_effects(sep), "path string, block bigint, effect array<int>")
    if whole_lines:  # blocks without quotes pass a state on
        same = F.array(*[F.lit(s) for s in range(5)])
        every = pieces.select("path", "block").distinct()
        effects = every.join(effects, ["path", "block"], "left").select("path", "block", F.coalesce("effect", same).alias("effect"))
    return effects.groupBy("path").applyInArrow(_compose, "path string, block bigint, state int").where(F.col("state") != RECORD)


def _cut(sep: str):
    names = ["path", "block", "place", "first", "opens", "ends", "value"]
    types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, done, held = Reader(sep), [], 0
        key, state, opens, first, begin, text = None, RECORD, True, False, None, []

        def sent():
            nonlocal held
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*done)) or [()] * 7, types)], names=names)
            done.clear()
            held = 0
            return out

        def leave():
            if text:
                done.append((*key, begin, first, opens, state, "".join(text)))
                text.clear()

        for path, block, new, place, value, known in _blocks(batches, ("place", "value", "state")):
            if new:
                leave()
                key, state = (path, block), RECORD if known is None else known
                opens, first = state == RECORD, block == 0
            if not value:
                continue
            if state == RECORD and '"' not in value and value.find("\n") == len(value) - 1:  # the usual line
                done.append((path, block, place, first, True, RECORD, value))
                opens, first = True, False
            else:
                cuts: list[int] = []
                state = reader.over(value, state, cuts)
                at = 0
                for cut in cuts:
                    if not text:
                        begin = place
                    text.append(value[at:cut])
                    done.append((path, block, begin, first, opens, RECORD, "".join(text)))
                    text.clear()
                    opens, first, at = True, False, cut
                if at < len(value):
                    if not text:
                        begin = place
                    text.append(value[at:])
            held += len(value)
            if held > 1 << 22:
                yield sent()
        leave()
        yield sent()

    return run


def cut_records(pieces: DataFrame, sep: str, whole_lines: bool = False) -> DataFrame:
    """The records of some files: ``path, block, place, first, broken, value``.

    ``pieces`` has the text of the files, ``path, block, place, value``: the
    blocks of a file follow each other by number, from 0, the pieces of a block
    by ``place``, which grows along the file; in the table, a block's pieces stand together and in order.
    Pieces may be cut anywhere, but with ``whole_lines`` each is one line with its break.
    The table is read twice and must give the same rows both times (a checkpoint does).

    ``place`` is that of the piece where the record begins, ``first`` marks a
    file's first record, and ``broken`` one whose quoted value never ends (it
    holds the rest of the file; beyond ``LONGEST_RECORD`` characters each
    block's part is a broken record of its own).  The line break that ends a
    record is not part of it, and blank records are left out.
    """
    states = block_states(pieces, sep, whole_lines).checkpoint()
    if states.count() <= SENT_BLOCKS:
        stated = pieces.join(F.broadcast(states), ["path", "block"], "left")
    else:
        stated = pieces.join(states, ["path", "block"], "left").repartition("path", "block").sortWithinPartitions("path", "block", "place")
    parts = stated.select("path", "block", "place", "value", "state").mapInArrow(
        _cut(sep), "path string, block bigint, place bigint, first boolean, opens boolean, ends int, value string").checkpoint()
    whole = parts.where(F.col("opens") & (F.col("ends") == RECORD)).select("path", "block", "place", "first", F.lit(False).alias("broken"), "value")
    crossing = parts.where(~(F.col("opens") & (F.col("ends") == RECORD)))
    # each part that opens a record starts the next one of its file
    order = "PARTITION BY path ORDER BY block, place, opens"
    numbered = crossing.selectExpr("*", f"sum(CAST(opens AS INT)) OVER ({order} ROWS UNBOUNDED PRECEDING) AS nth")
    sized = numbered.selectExpr("*", "sum(length(value)) OVER (PARTITION BY path, nth) AS size")
    joined = sized.where(F.col("size") <= LONGEST_RECORD).groupBy("path", "nth").agg(
        F.min(F.struct("block", "place")).alias("at"), F.max("first").alias("first"), F.max(F.struct("block", "place", "ends")).alias("last"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "place", "value"))), lambda x: x["value"]), "").alias("value")
    ).select("path", "at.block", "at.place", "first", (F.col("last.ends") == QUOTED).alias("broken"), "value")
    apart = sized.where(F.col("size") > LONGEST_RECORD).select("path", "block", "place", "first", F.lit(True).alias("broken"), "value")
    records = whole.unionByName(joined).unionByName(apart)
    return records.withColumn("value", F.regexp_replace("value", "\r?\n$", "")).where(F.trim("value") != "")


def files_with_open_lines(lines: DataFrame, sep: str) -> DataFrame:
    """``path`` of the files with a line that ends inside a quoted value.  As long
    as no line does, every line begins a record, so this needs no other line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, found = Reader(sep), set()
        for batch in batches:
            for path, value in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
                if path not in found and reader.over(value, RECORD) == QUOTED:
                    found.add(path)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["path"])

    return lines.where(F.col("value").contains('"')).select("path", "value").mapInArrow(run, "path string").distinct()

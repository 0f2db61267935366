"""Secret scans, with DataFrame operations only.

Base kinds are patterns (``assign``, ``access``, ``hex``; leftmost, not overlapping, per kind).  The method
adds ``markov`` spans: sub-runs of token characters, beside the base spans, that a character Markov model of
random strings explains better than one of ordinary identifiers.  The log-likelihood ratios are summed along
every run of at least ``MIN_RUN`` token characters; the sum starts anew where it falls to 0 or by
``threshold`` below its peak, and a sum that peaks at ``threshold`` or more gives a span, widened to the whole
alphanumeric pieces at its ends.  So an ordinary prefix or suffix takes nothing from a secret.

Both models are first-order, over the 68 token characters, smoothed by the characters' own frequencies.  Labelled samples: the
values that the base patterns find in all documents are random strings; the other tokens of about
``ordinary_docs`` documents (those with the least hashes) are ordinary if they have the shape of an identifier or a number.  Without samples a model is uniform.

Positions count code points, ends are exclusive.  A match's place follows from the lengths of the gaps
(``split``) and matches (``regexp_extract_all``) before it.

Defined cases: a null text is empty; empty texts have no spans.  Every input row gives one output row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textcore as T

# ---- fixed values: patterns and kinds ---------------------------------------------------------
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # AKIA and a run, 16 characters or more: a shorter run holds no longer match
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"  # whole runs, so those of 32 characters or more
KINDS = ("assign", "access", "hex", "markov")
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
#: shape of a token that counts as an ordinary identifier in training: words, joined or in camel case, then digits
IDENTIFIER = r"^([A-Z]?[a-z]{2,}|[A-Z]{2,})([_./-]?([A-Z]?[a-z]{2,}|[A-Z]{2,}))*[0-9]{0,4}$"
#: shape of numbers, dates and versions, which count as ordinary too
NUMBER = r"^[0-9]+([./_-][0-9]+)*$"
#: least run, and least sum of log-likelihood ratios (natural logarithms); README has the measured error rates
MIN_RUN = 8
TOKEN = r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]"
THRESHOLD = 16.0
SMOOTHING = 8
ORDINARY_DOCS = 1000
SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Places of all matches of a pattern (that ``keep`` holds for), as an array of (start, kind, stop, value)."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    none = F.array().cast(SPAN)

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["gap"])
        stop = start + F.length(F.coalesce(piece["match"], F.lit("")))
        own = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), piece["match"].alias("value")))
        return F.struct(stop.alias("at"), F.when(piece["match"].isNull() if keep is None else ~F.coalesce(keep(piece["match"]), F.lit(False)), state["out"]).otherwise(F.concat(state["out"], own)).alias("out"))

    found = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def base_spans(text: Column) -> Column:
    assign = F.filter(_spans(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 8)
    return F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2))


def _pairs(values: DataFrame) -> DataFrame:
    """Counts of neighbouring characters in the distinct strings of column ``value``."""
    chars = values.distinct().where("length(value) > 1").select("value", F.explode(F.sequence(F.lit(1), F.length("value") - 1)).alias("i"))
    return chars.groupBy(F.expr("substring(value, i, 2)").alias("pair")).count()


def _log_probabilities(counts: dict[str, int]) -> dict[str, float]:
    """Log P(second | first) of all pairs of symbols, smoothed by the symbols' own frequencies (add-one)."""
    seen = {b: sum(counts.get(a + b, 0) for a in SYMBOLS) for b in SYMBOLS}
    whole = sum(seen.values()) + len(SYMBOLS)
    out = {}
    for a in SYMBOLS:
        total = sum(counts.get(a + b, 0) for b in SYMBOLS)
        for b in SYMBOLS:
            out[a + b] = math.log((counts.get(a + b, 0) + SMOOTHING * (seen[b] + 1) / whole) / (total + SMOOTHING))
    return out


def train(docs: DataFrame, text: str = "text", ordinary_docs: int = ORDINARY_DOCS) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of all pairs of symbols, in symbol order."""
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    spans = rows.select(F.explode(base_spans(F.col("text"))).alias("s")).select("s.*")
    value = F.when(F.col("kind") == 0, F.regexp_extract("value", ASSIGN, 2)).otherwise(F.col("value"))
    random = _pairs(spans.select(value.alias("value"))).collect()  # a row for each pair of symbols at most
    share = min(1.0, ordinary_docs / max(docs.count(), 1))
    sampled = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    plain = sampled.select(F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|{HEX}", " ").alias("text"))
    tokens = plain.select(F.explode(F.regexp_extract_all("text", F.lit(TOKEN + "+"), F.lit(0))).alias("value"))
    ordinary = _pairs(tokens.where(F.regexp_like("value", F.lit(f"{IDENTIFIER}|{NUMBER}")))).collect()
    likely, usual = (_log_probabilities({r["pair"]: r["count"] for r in rows}) for rows in (random, ordinary))
    return [round(likely[a + b] - usual[a + b], 6) for a in SYMBOLS for b in SYMBOLS]


def _markov_spans(text: Column, ratios: list[float], threshold: float) -> Column:
    size = len(SYMBOLS)
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # folds to a constant
    place = [SYMBOLS.find(chr(c)) for c in range(128)]
    places = F.split(F.lit(",".join(map(str, place))), ",").cast("array<int>")

    def gain(state: Column, here: Column) -> Column:
        return F.when(state["last"] < 0, F.lit(0.0)).otherwise(F.get(table, state["last"] * size + here))

    def peak(run: Column) -> Column:
        """The largest sum that a sub-run reaches."""
        def step(state: Column, char: Column) -> Column:
            here = F.get(places, F.ascii(char))
            total = F.greatest(state["sum"] + gain(state, here), F.lit(0.0))
            return F.struct(here.alias("last"), total.alias("sum"), F.greatest(state["best"], total).alias("best"))

        start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
        return F.aggregate(F.split(run, ""), start, step, lambda s: s["best"])

    def found(state: Column) -> Column:
        own = F.array(F.struct(state["open"].alias("open"), state["stop"].alias("stop")))
        return F.when(state["peak"] >= threshold, F.concat(state["out"], own)).otherwise(state["out"])

    def sub_runs(run: Column) -> Column:
        """Places (open, stop) of the sub-runs whose sum peaks at the threshold or above."""
        def step(state: Column, char: Column) -> Column:
            here = F.get(places, F.ascii(char))
            total = state["sum"] + gain(state, here)
            ends = (total <= 0) | (total < state["peak"] - threshold)
            higher = ~ends & (total > state["peak"])
            return F.struct(
                here.alias("last"), (state["at"] + 1).alias("at"), F.when(ends, 0.0).otherwise(total).alias("sum"),
                F.when(ends, state["at"]).otherwise(state["open"]).alias("open"), F.when(ends, 0.0).otherwise(F.greatest(state["peak"], total)).alias("peak"),
                F.when(higher, state["at"] + 1).otherwise(state["stop"]).alias("stop"), F.when(ends, found(state)).otherwise(state["out"]).alias("out"),
            )

        none = F.array().cast("array<struct<open:int,stop:int>>")
        start = F.struct(
            F.lit(-1).alias("last"), F.lit(0).alias("at"), F.lit(0.0).alias("sum"), F.lit(0).alias("open"), F.lit(0.0).alias("peak"), F.lit(0).alias("stop"), none.alias("out"),
        )
        return F.aggregate(F.split(run, ""), start, step, found)

    def widened(span: Column, x: Column) -> Column:
        """The sub-run, less separators (and the end of the word before them) in front, widened to the pieces that it begins and ends in."""
        run = span["value"]
        open_ = x["open"] + F.length(F.regexp_extract(F.substring(run, x["open"] + 1, x["stop"] - x["open"]), "^([A-Za-z0-9]?[+/_=.-]+)?", 0))
        left = F.length(F.regexp_extract(F.reverse(F.substring(run, F.lit(1), open_)), "^[A-Za-z0-9]*", 0))
        right = F.greatest(F.length(F.regexp_extract(F.substring(run, x["stop"], F.length(run)), "^[A-Za-z0-9]*", 0)) - 1, F.lit(0))
        start, stop = open_ - left, x["stop"] + right
        return F.struct(
            (span["start"] + start).alias("start"), span["kind"].alias("kind"), (span["start"] + stop).alias("stop"), F.substring(run, start + 1, stop - start).alias("value"),
        )

    runs = _spans(text, TOKEN + "{%d,}" % MIN_RUN, 3, lambda run: peak(run) >= threshold)
    return F.array_distinct(F.flatten(F.transform(runs, lambda s: F.transform(sub_runs(s["value"]), lambda x: widened(s, x)))))


def find_secrets(docs: DataFrame, text: str = "text", into: str = "spans", ratios: list[float] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one more column: all spans as an array of (start, kind, stop, value), in order of (start, kind).
    If ``docs`` has a column of that name, the new one's name ends with an underscore (:func:`textcore.unused`)."""
    ratios = train(docs, text) if ratios is None else ratios
    into = T.unused(docs, into)
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumn(into, base_spans(own))
    # what lies beside base spans is scored with blanks in their places
    blank = _replaced(own, F.array_sort(F.col(into)), lambda s, start: F.repeat(F.lit(" "), s["stop"] - start))
    added = _markov_spans(blank, ratios, threshold)
    return rows.withColumn(into, F.array_sort(F.concat(F.col(into), added)))  # by start, then kind


def _replaced(text: Column, spans: Column, by) -> Column:
    """The text with the new part of every span (in order) replaced by ``by(span, start)``, or nothing where ``by`` is null."""
    def step(state: Column, s: Column) -> Column:
        start = F.greatest(s["start"], state["at"])
        piece = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), F.concat(state["out"], piece, F.coalesce(by(s, start), F.lit(""))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every maximal run of overlapping spans replaced by a mark."""
    return _replaced(text, spans, lambda s, start: F.when(start == s["start"], F.lit(mark)))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op5_markov_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_listed(F.filter("spans", lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )

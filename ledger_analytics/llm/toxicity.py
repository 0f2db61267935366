"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is a sequence of words (runs of ASCII letters, A-Z lower-cased, digits and non-ASCII characters).
A word enters with two inputs: the embedding of the word itself, if training has seen it in ``MIN_DOCS``
documents, and the mean embedding of its byte trigrams.  All windows of ``WINDOW`` words that overlap by
half are scored; the best one decides, through a logistic calibration.

Fit, in one task, on a bounded sample: at most ``SAMPLE`` labelled rows of each class, of those whose
``crc32(doc_id as text) mod 3`` is not 1, taken by the least hashes.  Texts of up to ``LONGEST`` characters enter
whole, and longer ones too while the sample stays within ``TOTAL`` characters; beyond that, a longer text gives
as many of its pieces of ``PIECE`` characters as fit an equal share, those with the least hashes.  First values of the embeddings are log-odds of words and trigrams in the sample; every round then
trains on the window of each document that the network scores highest (so a toxic document teaches its
worst window, a clean one the window most like it) and on one more.  Labels, ``lang``, ``source`` and
``doc_id`` are no inputs.

Defined cases: a text without words is one window of padding; without labelled documents of both classes
every score is the share of toxic labels (0 if there are none).  Every input row gives one output row.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import textcore as T

WINDOW = 32
WIDTH = 8  # of each embedding
HIDDEN = 12  # of each direction
ATTENTION = 8
TRIGRAMS = 1 << 13
MIN_DOCS = 3
SAMPLE = 2000
#: characters that a text may always bring into the sample, that longer ones may fill together, and of a piece
LONGEST = 20_000
TOTAL = 40_000_000
PIECE = 1_000
ROUNDS = 5
BATCH = 64
#: small samples get more rounds, so that the network takes this many steps at least
STEPS = 300
#: windows that training scores to find the worst ones; if every round's would be more, they are found anew less often
SCORED = 2_000_000
THRESHOLD = 0.7


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Text:
    """Words of a batch of documents: an id of each word's distinct form, and the forms' inputs."""

    first: np.ndarray  # document d has the words first[d]:first[d + 1]
    form: np.ndarray
    hashes: np.ndarray  # of the forms
    grams: np.ndarray  # trigram ids of all forms, one after the other
    cuts: np.ndarray

    @classmethod
    def of(cls, column) -> Text:
        data, offsets = T.buffers(column)
        words = T.words_of(T.LOWER[data], offsets, T.ALNUM)
        hashes, at, form = np.unique(words.hashes(), return_index=True, return_inverse=True)
        inside = np.where(T.ALNUM[words.data], words.data, 0).astype(np.uint32)
        padded = np.concatenate([[0], inside, [0]]).astype(np.uint32)
        starts, ends = words.starts[at], words.ends[at]
        sizes = ends - starts
        cuts = np.cumsum(sizes) - sizes
        place = np.repeat(starts - cuts, sizes) + np.arange(sizes.sum())
        within = np.arange(sizes.sum()) - np.repeat(cuts, sizes)
        before = np.where(within == 0, 0, padded[place])
        after = np.where(within == np.repeat(sizes, sizes) - 1, 0, padded[place + 2])
        key = (before * np.uint32(65599) + padded[place + 1]) * np.uint32(65599) + after
        key = (key * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAMS.bit_length() + 1)
        return cls(words.first, form, hashes, key.astype(np.int32), cuts)

    @classmethod
    def joined(cls, parts: list[Text]) -> Text:
        """The texts of several batches as one; hashing them batch by batch keeps the work arrays small."""
        hashes = np.concatenate([p.hashes for p in parts])
        known, at, form = np.unique(hashes, return_index=True, return_inverse=True)
        forms = np.split(form, np.cumsum([len(p.hashes) for p in parts])[:-1])
        shift = np.cumsum([0, *[p.first[-1] for p in parts]])
        first = np.concatenate([[0], *[p.first[1:] + n for p, n in zip(parts, shift)]])
        grams = np.concatenate([p.grams for p in parts])
        start = np.concatenate([p.cuts + n for p, n in zip(parts, np.cumsum([0, *[len(p.grams) for p in parts]]))])
        sizes = np.diff(np.append(start, len(grams)))[at]
        cuts = np.cumsum(sizes) - sizes
        place = np.repeat(start[at] - cuts, sizes) + np.arange(sizes.sum())
        return cls(first, np.concatenate([f[p.form] for f, p in zip(forms, parts)]), known, grams[place], cuts)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(form ids, -1 for padding; document) of all overlapping windows; every document has one at least."""
        step = WINDOW // 2
        sizes = np.diff(self.first)
        number = np.maximum(1, -(-(sizes - step) // step))
        owner = np.repeat(np.arange(len(sizes)), number)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        start = nth * step
        at = start[:, None] + np.arange(WINDOW)
        valid = at < sizes[owner][:, None]
        place = np.where(valid, self.first[:-1][owner][:, None] + at, 0)
        ids = np.where(valid, self.form[place] if len(self.form) else 0, -1)
        return ids, owner


@dataclass
class Network:
    vocabulary: np.ndarray  # sorted hashes of the known words
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    bias: float = 0.0
    _moments: dict = field(default_factory=dict, repr=False)

    @classmethod
    def start(cls, vocabulary: np.ndarray, word_odds: np.ndarray, gram_odds: np.ndarray, seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *shape, scale=0.2: (r.standard_normal(shape) * scale).astype(np.float32)
        w = {"word": draw(len(vocabulary) + 1, WIDTH, scale=0.05), "gram": draw(TRIGRAMS, WIDTH, scale=0.05)}
        w["word"][:-1, 0], w["word"][-1] = word_odds, 0
        w["gram"][:, 0] = gram_odds
        for way in "fb":
            w["in_" + way], w["state_" + way] = draw(2 * WIDTH, 3 * HIDDEN), draw(HIDDEN, 3 * HIDDEN)
            w["bias_" + way] = np.zeros(3 * HIDDEN, np.float32)
        w["look"], w["key"] = draw(2 * HIDDEN, ATTENTION), draw(ATTENTION)
        w["out"], w["out_bias"] = draw(2 * HIDDEN), np.zeros(1, np.float32)
        return cls(vocabulary, w)

    # -- inputs -----------------------------------------------------------------------------
    def word_ids(self, text: Text) -> np.ndarray:
        ids = np.searchsorted(self.vocabulary, text.hashes)
        known = T.isin_sorted(text.hashes, self.vocabulary)
        return np.where(known, ids, len(self.vocabulary))

    def inputs(self, text: Text) -> np.ndarray:
        """Word and character inputs of the distinct forms, with a row of zeros for padding at the end."""
        n = len(text.hashes)
        x = np.zeros((n + 1, 2 * WIDTH), np.float32)
        if n:
            x[:n, :WIDTH] = self.weights["word"][self.word_ids(text)]
            sizes = np.diff(np.append(text.cuts, len(text.grams)))
            x[:n, WIDTH:] = np.add.reduceat(self.weights["gram"][text.grams], text.cuts, axis=0) / sizes[:, None]
        return x

    # -- forward and backward ---------------------------------------------------------------
    def _run(self, x: np.ndarray, ids: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States (time, window, HIDDEN) of one direction."""
        w, h3 = self.weights, HIDDEN
        projected = x @ w["in_" + way] + w["bias_" + way]
        state = np.zeros((len(ids), h3), np.float32)
        out = np.empty((ids.shape[1], len(ids), h3), np.float32)
        order = range(ids.shape[1]) if way == "f" else range(ids.shape[1] - 1, -1, -1)
        for t in order:
            p = projected[ids[:, t]]
            s = state @ w["state_" + way]
            gates = _sigmoid(p[:, : 2 * h3] + s[:, : 2 * h3])
            z, r = gates[:, :h3], gates[:, h3:]
            new = np.tanh(p[:, 2 * h3 :] + r * s[:, 2 * h3 :])
            if keep is not None:
                keep.append((t, state, z, r, new, s[:, 2 * h3 :]))
            state = new + z * (state - new)
            out[t] = state
        return out

    def logits(self, x: np.ndarray, ids: np.ndarray, trace: dict | None = None) -> np.ndarray:
        w = self.weights
        keeps = ([], []) if trace is not None else (None, None)
        states = np.concatenate([self._run(x, ids, "f", keeps[0]), self._run(x, ids, "b", keeps[1])], axis=2)
        looked = np.tanh(states @ w["look"])
        e = looked @ w["key"]
        e[(ids < 0).T] = -30.0
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", a, states)
        if trace is not None:
            trace.update(states=states, looked=looked, a=a, pooled=pooled, keeps=keeps)
        return pooled @ w["out"] + w["out_bias"][0]

    def gradients(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean cross-entropy, for the weights and for the inputs ``x``."""
        w, h, trace = self.weights, HIDDEN, {}
        d = ((_sigmoid(self.logits(x, ids, trace)) - labels) / len(ids)).astype(np.float32)
        states, looked, a = trace["states"], trace["looked"], trace["a"]
        g = {"out": trace["pooled"].T @ d, "out_bias": np.array([d.sum()], np.float32)}
        d_pool = d[:, None] * w["out"]
        d_a = np.einsum("bh,tbh->tb", d_pool, states)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        d_e[(ids < 0).T] = 0
        g["key"] = np.einsum("tb,tbk->k", d_e, looked)
        d_look = d_e[:, :, None] * w["key"] * (1 - looked**2)
        g["look"] = np.einsum("tbh,tbk->hk", states, d_look)
        d_states = a[:, :, None] * d_pool + d_look @ w["look"].T
        d_x = np.zeros_like(x)
        for way, keep, part in (("f", trace["keeps"][0], slice(0, h)), ("b", trace["keeps"][1], slice(h, 2 * h))):
            d_projected = np.zeros((len(x), 3 * h), np.float32)
            g_state = np.zeros_like(w["state_" + way])
            back = np.zeros((len(ids), h), np.float32)
            for t, state, z, r, new, s_new in reversed(keep):
                back = back + d_states[t][:, part]
                d_z = back * (state - new) * z * (1 - z)
                d_new = back * (1 - z) * (1 - new**2)
                d_r = d_new * s_new * r * (1 - r)
                d_s = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(d_projected, ids[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
                g_state += state.T @ d_s
                back = back * z + d_s @ w["state_" + way].T
            g["state_" + way], g["in_" + way], g["bias_" + way] = g_state, x.T @ d_projected, d_projected.sum(axis=0)
            d_x += d_projected @ w["in_" + way].T
        d_x[-1] = 0
        return g, d_x

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        """Adam."""
        n = self._moments["n"] = self._moments.get("n", 0) + 1
        for name, grad in g.items():
            m, v = self._moments.setdefault(name, (np.zeros_like(grad), np.zeros_like(grad)))
            m *= 0.9
            m += 0.1 * grad
            v *= 0.99
            v += 0.01 * grad**2
            self.weights[name] -= (rate * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-6)).astype(np.float32)

    # -- scores -----------------------------------------------------------------------------
    def window_logits(self, text: Text, ids: np.ndarray, size: int = 4096) -> np.ndarray:
        x = self.inputs(text)
        return np.concatenate([self.logits(x, ids[i : i + size]) for i in range(0, len(ids), size)] or [np.zeros(0, np.float32)])

    def scores(self, column) -> np.ndarray:
        text = Text.of(column)
        ids, owner = text.windows()
        if not len(ids):
            return np.zeros(0)
        best = np.maximum.reduceat(self.window_logits(text, ids), np.searchsorted(owner, np.arange(len(text.first) - 1)))
        return _sigmoid(self.slope * best.astype(np.float64) + self.bias)


def _odds(owner: np.ndarray, keys: np.ndarray, n_keys: int, toxic: np.ndarray, expand=None) -> tuple[np.ndarray, np.ndarray]:
    """Documents that hold each key, and the smoothed log-odds of holding it (toxic against clean).

    ``owner`` is sorted.  ``expand`` turns a run of (owner, key) into those of what the keys are made of; some
    documents at a time, so that the expansion stays small."""
    there, worse = np.zeros(n_keys, np.int64), np.zeros(n_keys, np.int64)
    cuts = np.searchsorted(owner, np.arange(0, len(toxic) + 100, 100))
    for a, b in zip(cuts[:-1], cuts[1:]):
        some, own = (owner[a:b], keys[a:b]) if expand is None else expand(owner[a:b], keys[a:b])
        pairs = np.unique(some * n_keys + own)
        there += np.bincount(pairs % n_keys, minlength=n_keys)
        worse += np.bincount(pairs[toxic[pairs // n_keys] > 0] % n_keys, minlength=n_keys)
    sums = toxic.sum(), len(toxic) - toxic.sum()
    odds = np.log((worse + 0.5) / (sums[0] + 1)) - np.log((there - worse + 0.5) / (sums[1] + 1))
    return there, np.clip(odds, -4, 8) / 8


def train(texts, toxic: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> Network:
    """A network fit on labelled texts (a list or an Arrow column, not empty)."""
    toxic = np.asarray(toxic, np.float32)
    table = pa.table({"text": texts if isinstance(texts, pa.ChunkedArray) else pa.array(texts, pa.string())})
    text = Text.joined([Text.of(part.column("text")) for part in T.blocks(table, "text", 1 << 20)])
    owner = np.repeat(np.arange(len(texts)), np.diff(text.first))
    there, odds = _odds(owner, text.form, max(1, len(text.hashes)), toxic)
    known = np.flatnonzero(there >= MIN_DOCS)
    sizes = np.diff(np.append(text.cuts, len(text.grams)))

    def grams_of(some: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = sizes[forms]
        at = np.repeat(text.cuts[forms] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(some, n), text.grams[at]

    _, gram_odds = _odds(owner, text.form, TRIGRAMS, toxic, grams_of)
    net = Network.start(text.hashes[known], odds[known], gram_odds, seed)
    ids, of = text.windows()
    starts = np.searchsorted(of, np.arange(len(texts)))
    counts = np.diff(np.append(starts, len(of)))
    word_ids, r = net.word_ids(text), np.random.default_rng(seed)
    rounds = max(rounds, -(-STEPS * BATCH // (len(texts) + int((toxic == 0).sum()))))
    every = -(-rounds * len(ids) // SCORED)
    worst = np.where(ids >= 0, np.append(net.weights["word"][word_ids, 0], 0)[ids], -1).max(axis=1)
    for turn in range(rounds):
        if turn and turn % every == 0:
            worst = net.window_logits(text, ids)
        first = np.array([starts[d] + int(np.argmax(worst[starts[d] : starts[d] + counts[d]])) for d in range(len(texts))])
        other = starts + r.integers(0, counts)
        # a window is an example of its document's class; of a toxic document only the worst one is
        chosen = np.concatenate([first, other[toxic == 0]])
        labels = np.concatenate([toxic, np.zeros(int((toxic == 0).sum()), np.float32)])
        order = r.permutation(len(chosen))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            used, local = np.unique(ids[chosen[pick]], return_inverse=True)
            local = local.reshape(len(pick), -1)
            pad = used[0] < 0
            forms = used[1:] if pad else used
            part = _Part.of(text, forms)
            x = net.inputs(part)
            local = np.where(local == 0, len(forms), local - 1) if pad else local
            rows = np.where(local == len(forms), -1, local)
            g, d_x = net.gradients(x, rows, labels[pick])
            d_word = np.zeros_like(net.weights["word"])
            np.add.at(d_word, word_ids[forms], d_x[:-1, :WIDTH])
            d_word[-1] = 0
            lens = np.diff(np.append(part.cuts, len(part.grams)))
            d_gram = np.zeros_like(net.weights["gram"])
            np.add.at(d_gram, part.grams, np.repeat(d_x[:-1, WIDTH:] / lens[:, None], lens, axis=0))
            g["word"], g["gram"] = d_word, d_gram
            net.step(g, 0.01 if turn < rounds - 2 else 0.003)
    top = np.maximum.reduceat(net.window_logits(text, ids), starts).astype(np.float64)
    net.slope, net.bias = _calibrate(top, toxic)
    net._moments.clear()
    return net


class _Part(Text):
    """Some forms of a text, as inputs of a batch."""

    @classmethod
    def of(cls, text: Text, forms: np.ndarray) -> _Part:
        sizes = np.diff(np.append(text.cuts, len(text.grams)))[forms]
        cuts = np.cumsum(sizes) - sizes
        at = np.repeat(text.cuts[forms] - cuts, sizes) + np.arange(sizes.sum())
        return cls(np.zeros(1, np.int64), np.zeros(0, np.int64), text.hashes[forms], text.grams[at], cuts)


def _calibrate(best: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a lightly penalised logistic regression on the best window's logit (Newton steps)."""
    x = np.stack([best, np.ones(len(best))], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(30):
        p = _sigmoid(x @ theta)
        grad = x.T @ (p - toxic) + 0.1 * (theta - [1.0, 0.0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        theta -= np.linalg.solve(hess, grad)
    return float(max(theta[0], 0.05)), float(theta[1])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _level(lengths: np.ndarray, total: int, least: int) -> int:
    """Characters that a text may bring, so that all together bring ``total`` (``least`` in any case)."""
    lengths = np.sort(lengths)
    left = total - (np.cumsum(lengths) - lengths)  # for the texts from each one on
    shares = left // np.arange(len(lengths), 0, -1)
    over = np.flatnonzero(lengths > shares)
    return max(least, int(shares[over[0]]) if len(over) else int(lengths[-1]) if len(lengths) else 0)


def _excerpt(text: str, level: int) -> Column:
    """A text of up to ``level`` characters as it is, of a longer one the pieces with the least hashes, in order."""
    pieces = f"transform(regexp_extract_all({text}, '(?s).{{1,{PIECE}}}', 0), (p, i) -> named_struct('h', xxhash64(i, p), 'i', i, 'p', p))"
    some = f"array_sort(transform(slice(array_sort({pieces}), 1, {max(1, level // PIECE)}), x -> named_struct('i', x.i, 'p', x.p)))"
    return F.expr(f"case when length({text}) <= {level} then {text} else array_join({some}.p, '\\n') end")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, total: int = TOTAL) -> Network | float:
    """The network, or the share of toxic labels where there aren't labelled documents of both classes."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).where("_id is not null and _toxic is not null")
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    own = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    there = own.select("_id").where("_id is not null").distinct().withColumn("_there", F.lit(1))
    both = known.join(there, "_id", "left").groupBy("_toxic").agg(F.count("*").alias("labels"), F.count("_there").alias("docs")).collect()
    counts = {r["_toxic"]: r["docs"] for r in both}
    if not (counts.get(0) and counts.get(1)):
        return sum(r["labels"] for r in both if r["_toxic"]) / max(1, sum(r["labels"] for r in both))
    share = F.when(F.col("_toxic") == 1, min(1.0, sample / counts[1])).otherwise(min(1.0, sample / counts[0]))
    few = known.join(there, "_id", "left_semi").where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < share * (1 << 30))
    few = F.broadcast(few.limit(4 * sample))  # about two samples; the limit proves the bound
    rows = own.join(few, "_id").select("_id", "_text", "_toxic")
    lengths = rows.groupBy("_id").agg(F.max(F.length("_text")).alias("n")).select("n").collect()  # a number for each id of the sample
    level = _level(np.array([r["n"] for r in lengths], np.int64), total, LONGEST)
    rows = rows.withColumn("_text", _excerpt("_text", level))
    found = rows.repartition(1).mapInArrow(_train_task, "network binary").first()  # one task over the bounded sample
    return pickle.loads(found["network"])


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The network (or the share of toxic rows, if all are of one class), pickled."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches).sort_by([("_id", "ascending"), ("_text", "ascending")])
    toxic = rows.column("_toxic").to_numpy().astype(np.float32)
    one_class = toxic.min() == toxic.max()
    network = float(toxic.mean()) if one_class else train(rows.column("_text"), toxic)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], names=["network"])


def with_score(docs: DataFrame, network: Network | float, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with one more column: the toxicity of its text, 0 to 1.  If ``docs`` has a column of that name, the new
    one's name ends with an underscore (:func:`textcore.unused`)."""
    name = T.unused(docs, name)
    if isinstance(network, float):
        return docs.withColumn(name, F.lit(network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.blocks(batch, text, 1 << 20):
                scores = pa.array(network.scores(part.column(text)), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def op8_attentive_gru(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    network = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = with_score(docs, network)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Token counts of a unigram model by trie-shared dynamic programming.

A text is cut into pre-tokens (maximal runs without white space, each with a leading word mark), as the
piece vocabulary expects.  The best segmentation of a pre-token maximises the sum of its pieces' scores; its
number of pieces is the pre-token's count.  The vocabulary orders its pieces by rank and gives no
probabilities, so a piece of rank r scores ``-log(r + RANK_SHIFT)``.  A character without a piece falls back
to one token per UTF-8 byte, at ``BYTE_SCORE`` each.

The distinct pre-tokens of a block of texts are inserted in a trie: sorted, a pre-token opens new nodes only
beyond the prefix it shares with the one before.  Forward scores are computed once for each node, depth by
depth for all nodes at once: a node's score is the best, over the pieces that end there, of the score of the
node where the piece begins plus the piece's.  The counts at the terminal nodes are looked up for every
occurrence.  Of equally good segmentations the one with the fewest tokens counts.

The vocabulary has a bounded number of pieces (its file is a parameter); it is read on the driver and sent
to the tasks.

Words of over ``LONG`` bytes are left out of the trie, where each depth costs a step for all words: such a word is
matched with the pieces at all its places at once, and its forward scores are computed alone, in time in proportion
to its length.  The result is the same.

Defined cases: null and blank texts have no tokens; texts and pre-tokens of any length are processed whole.
Every input row gives one output row, repeated rows included; an empty table gives none.  Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as T

VOCABULARY = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers") + "/piece_bpe_32k.model"
RANK_SHIFT = 100
BYTE_SCORE = -20.0
#: one byte that stands for the word mark in keys; it cannot occur in UTF-8 text
MARK = 0xFF
#: bytes of a word that goes through the trie
LONG = 256


def read_pieces(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces of a vocabulary file, in rank order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), -float(np.log(rank + RANK_SHIFT))) for rank, i in enumerate(ordinary)]


_HASH = np.random.default_rng(977).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _extend(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
    h = (h ^ _HASH[byte]) * _STEP
    return h ^ (h >> np.uint64(29))


@dataclass
class Pieces:
    """Pieces by the hash of their bytes read backwards."""

    hashes: np.ndarray
    scores: np.ndarray
    longest: int

    @classmethod
    def of(cls, pieces: list[tuple[str, float]]) -> Pieces:
        found: dict[int, float] = {}
        longest = 1
        for piece, score in pieces:
            raw = piece.replace("▁", "\udcff").encode("utf-8", "surrogateescape")
            longest = max(longest, len(raw))
            h = np.zeros(1, np.uint64)
            for b in reversed(raw):
                h = _extend(h, np.array([b], np.uint8))
            found[int(h[0])] = max(score, found.get(int(h[0]), -np.inf))
        hashes = np.array(sorted(found), np.uint64)
        return cls(hashes, np.array([found[h] for h in hashes.tolist()]), longest)


def count_pretokens(words: list[bytes], pieces: Pieces) -> np.ndarray:
    """Tokens of each of the sorted distinct words."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    sizes = np.array([len(w) for w in words])
    body = np.frombuffer(b"".join(words), np.uint8)
    begin = np.cumsum(sizes) - sizes
    out = np.zeros(n, np.int64)
    # nodes of depth d: words longer than d - 1 whose prefix differs from the previous word's; word w reads node[d][w]
    alive = np.arange(n)  # words that reach this depth, in order
    fresh_run = np.zeros(n, bool)  # whether a word differs from the one before within the depths so far
    fresh_run[0] = True
    of_root = np.zeros(n, np.int64)
    history: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(of_root, np.zeros(1), np.zeros(1, np.int64))]  # node of each word, scores, counts
    trail: list[np.ndarray] = []  # the byte of every word at the last depths
    depth = 0
    while True:
        here = alive[sizes[alive] > depth]
        if not len(here):
            break
        byte = np.zeros(n, np.uint8)
        byte[here] = body[begin[here] + depth]
        trail.append(byte)
        # a node is new where the word before in order doesn't share the prefix; words that ended break no sharing
        opens = np.ones(len(here), bool)
        previous = here[:-1]
        same_parent = history[-1][0][here[1:]] == history[-1][0][previous]
        opens[1:] = ~(same_parent & (byte[here[1:]] == byte[previous]))
        node = np.zeros(n, np.int64)
        node[here] = np.cumsum(opens) - 1
        first = here[opens]  # the word that computes the node
        score = np.full(len(first), -np.inf)
        count = np.zeros(len(first), np.int64)
        h = np.zeros(len(first), np.uint64)
        for back in range(1, min(depth + 1, pieces.longest) + 1):
            h = _extend(h, trail[-back][first])
            at = np.searchsorted(pieces.hashes, h)
            at[at == len(pieces.hashes)] = 0
            hit = np.flatnonzero(pieces.hashes[at] == h)
            _offer(score, count, hit, pieces.scores[at[hit]], 1, history[-back], first)
        # characters without a piece: one token a byte, from the start of the character
        last = byte[first]
        for size in range(1, min(depth + 1, 4) + 1):
            lead = trail[-size][first]
            width = np.where(lead < 0x80, 1, np.where(lead < 0xC0, 0, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4))))
            width[lead == MARK] = 1
            whole = np.flatnonzero((width == size) & ((size == 1) | ((last >= 0x80) & (last < 0xC0))))
            _offer(score, count, whole, np.full(len(whole), BYTE_SCORE * size), size, history[-size], first)
        history.append((node, score, count))
        ended = here[sizes[here] == depth + 1]
        out[ended] = count[node[ended]]
        alive = here
        depth += 1
        if len(history) > pieces.longest + 4:
            history.pop(0)
            trail.pop(0)
    return out


def count_alone(word: bytes, pieces: Pieces) -> int:
    """Tokens of one word of any length."""
    body = np.frombuffer(word, np.uint8)
    size = len(body)
    # all pieces that end at each place, shorter ones first: hashes grow backwards from every place at once
    ends, starts, gains = [], [], []
    h = np.zeros(size, np.uint64)
    for back in range(1, min(size, pieces.longest) + 1):
        h = _extend(h[1:] if back > 1 else h, body[: size - back + 1])
        at = np.searchsorted(pieces.hashes, h)
        at[at == len(pieces.hashes)] = 0
        hit = np.flatnonzero(pieces.hashes[at] == h)
        ends.append(hit + back)
        starts.append(hit)
        gains.append(pieces.scores[at[hit]])
    ends, starts, gains = (np.concatenate(x) for x in (ends, starts, gains))
    order = np.argsort(ends, kind="stable")
    upto = np.searchsorted(ends[order], np.arange(size + 2)).tolist()
    starts, gains = starts[order].tolist(), gains[order].tolist()
    # the character that ends at each place, if one does
    lead = np.flatnonzero((body < 0x80) | (body >= 0xC0))
    width = np.zeros(size + 1, np.int64)
    width[np.append(lead[1:], size)] = np.diff(np.append(lead, size))
    width = width.tolist()
    lowest = -np.inf
    score, count = [0.0] + [lowest] * size, [0] * (size + 1)
    for e in range(1, size + 1):
        best, used = lowest, 0
        for i in range(upto[e], upto[e + 1]):
            offered, n = score[starts[i]] + gains[i], count[starts[i]] + 1
            if offered > best + 1e-9 or offered > best - 1e-9 and n < used:
                best, used = offered, n
        n = width[e]
        if n:
            offered, n = score[e - n] + BYTE_SCORE * n, count[e - n] + n
            if offered > best + 1e-9 or offered > best - 1e-9 and n < used:
                best, used = offered, n
        score[e], count[e] = best, used
    return count[size]


def _offer(score, count, at, gain, tokens, origin, first) -> None:
    """Take over what ends at the nodes ``at`` where it is better, or as good with fewer tokens."""
    node, scores, counts = origin
    begin = node[first[at]]
    offered, used = scores[begin] + gain, counts[begin] + tokens
    # sums of the same scores in another order may differ in the last bits
    better = (offered > score[at] + 1e-9) | ((offered > score[at] - 1e-9) & (used < count[at]))
    score[at[better]], count[at[better]] = offered[better], used[better]


def count_batch(column, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Pre-tokens and tokens of each text."""
    data, offsets = T.buffers(column)
    words = T.words_of(data, offsets, T.NOT_WHITE)
    _, at, form = np.unique(words.hashes(), return_index=True, return_inverse=True)
    raw = data.tobytes()
    mark = bytes([MARK])
    distinct = [mark + raw[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())]
    order = sorted((i for i, w in enumerate(distinct) if len(w) <= LONG), key=distinct.__getitem__)
    counts = np.array([count_alone(w, pieces) if len(w) > LONG else 0 for w in distinct], np.int64)
    counts[order] = count_pretokens([distinct[i] for i in order], pieces)
    total = np.append(0, np.cumsum(counts[form]))
    return np.diff(words.first), total[words.first[1:]] - total[words.first[:-1]]


def count_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens``, a row for each row of ``docs``."""
    pieces = Pieces.of(read_pieces(vocabulary))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.blocks(batch, "text", 4 << 20):
                n_pre, n_tok = count_batch(part.column("text"), pieces)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_pre, pa.int64()), pa.array(n_tok, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    return rows.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")


def op6_trie_unigram(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))

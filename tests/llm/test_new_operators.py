"""URL vocabulary, importance resampling and spelling variants against brute-force versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledger_analytics.llm import queries as registry

QUERIES = registry.queries()


def test_op11_verdicts(spark, tables):
    """Written out by hand, beside the SQL."""
    got = {r.page_id: r for r in QUERIES["op11_url_vocabulary"](spark, tables[0]).where("page_id is not null").collect()}
    parts = {0: ("", ""), 2: ("", ""), 3: ("", ""), 4: ("example.org", "/es/a"), 6: ("example.org", "/es"), 8: ("example.org", ""), 12: ("com:80", "/de/"), 15: ("u@b.org", "/"), 30: ("b:", "//example.org/es/")}
    assert {k: (got[k].host, got[k].path) for k in parts} == parts
    rules = {4: "example.org/es/", 5: "example.org/es/", 6: "org/", 7: "example.org/en/1", 8: None, 9: "org/", 10: "com/fr/", 11: "com/de/", 12: None, 13: "com/de/", 14: None, 15: "org/", 16: "org/", 17: None, 27: "org/"}
    assert {k: got[k].rule for k in rules} == rules
    blocked = {2, 4, 5, 7, 11, 13, 18, 21, 23, 24, 25, 28, 29}
    assert {k for k, r in got.items() if r.verdict == "block"} == blocked
    assert got[20].weight == 3 and got[22].weight == 0 and got[26].weight == 4


def test_op11_terms_and_rules_are_parameters(spark):
    from ledger_analytics.llm.urlfilters import judge_urls

    df = spark.createDataFrame([("p", "http://b.c/bad-bad.worse"), ("q", "http://a.b.c/x")], "id string, u string")
    got = judge_urls(df, "id", "u", rules=[("keep", "B.c", "/b"), ("drop", "a.b.c", "")], vocabulary={"Bad": 1, "worse": 2}).orderBy("page_id").collect()
    assert [(r.page_id, r.rule, r.verdict, r.weight, r.terms) for r in got] == [("p", "b.c/b", "keep", 3, "bad:2,worse:1"), ("q", "a.b.c", "drop", 0, "")]
    assert judge_urls(df, "id", "u", rules=[], vocabulary={}).where("verdict = 'allow'").count() == 2


WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, max_n=3):
    w = WORDS.findall((text or "").encode().lower())
    return len(w), [b" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def resampled(documents, target):
    """The contract of op12, n-gram by n-gram."""
    bucket = lambda f: zlib.crc32(f) % 10000
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([x for _, x in documents], target))
    n_s, n_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
    rows = []
    for doc_id, text in documents:
        n_words, f = features(text)
        weight = sum(gain(bucket(x)) for x in f)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = Counter((*r[:4], i + 1) for i, r in enumerate(able[: 5 * len(able) // 100]))
    out = Counter(drawn)
    for r in rows:
        if drawn[same := next((d for d in drawn if d[:4] == r[:4] and drawn[d]), None)] if r[4] >= 20 else 0:
            drawn[same] -= 1
        else:
            out[(*r[:4], None)] += 1
    return out


def test_op12(spark, tables, documents):
    target = [r.text for r in spark.read.parquet(f"{tables[0]}/benchmark.parquet").collect()]
    got = QUERIES["op12_prefix_crc_resampling"](spark, tables[0])
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 5
    assert Counter(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect())) == resampled(documents, target)


def test_op12_draws_by_score_through_ties_and_repeated_rows(spark):
    from ledger_analytics.llm.resampling import resample

    r = random.Random(9)
    text = lambda n: " ".join(f"w{r.randrange(50)}" for _ in range(n))
    same = text(30)
    # one document a third of all rows, one without an id, and many of the target's words
    rows = [(7, same)] * 120 + [(None, text(25))] * 20 + [(i, text(r.choice([5, 19, 20, 40]))) for i in range(220)]
    target = [text(40) for _ in range(5)] + [None, ""]
    docs = spark.createDataFrame([(d, t, "s", 1, 2) for d, t in rows], "doc_id long, text string, score string, rank int, place int").repartition(7)
    out = resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), carry=["text", "score"])
    got = [(x.doc_id, x.n_features, x.weight, x.score, x.rank) for x in out.collect()]
    assert Counter(got) == resampled(rows, target)
    assert Counter((x.doc_id, x.carried.text) for x in out.collect()) == Counter(rows)


def test_op12_target_is_empty(spark, documents):
    from ledger_analytics.llm.resampling import resample

    got = resample(spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame([], "text string")).drop("carried", "n_words")
    assert Counter(map(tuple, got.collect())) == resampled(documents, [])


@pytest.mark.parametrize("at_a_time", [1, 3, 1 << 19])
def test_ngram_crcs_from_prefixes(at_a_time, monkeypatch):
    from ledger_analytics.llm import resampling as R
    from ledger_analytics.llm import textcore as T

    monkeypatch.setattr(R, "WORDS", at_a_time)
    r = random.Random(1)
    texts = ["", "One two  THREE", "é" * 40 + " " + "x" * 500 + " y", "-", " ".join("ab" * r.randrange(1, 60) for _ in range(30)), "z" * 70000 + " end"]
    data, offsets = T.buffers(pa.array(texts))
    found = Counter()
    for own, crc in R.feature_crcs(T.words_of(T.LOWER[data], offsets, T.ALNUM), R.Shift(), 4):
        found.update(zip(own.tolist(), crc.tolist()))
    assert found == Counter((i, zlib.crc32(f)) for i, t in enumerate(texts) for f in features(t, 4)[1])


def test_shifts():
    from ledger_analytics.llm.resampling import Shift

    r = random.Random(2)
    pairs = [(r.randbytes(r.randrange(50)), r.randbytes(n)) for n in (0, 1, 63, 64, 65, 127, 128, 4097, 70000)]
    crc = np.array([zlib.crc32(a) for a, _ in pairs], np.uint32)
    got = Shift()(crc, np.array([len(b) for _, b in pairs]))
    assert [int(g) ^ zlib.crc32(b) for g, (_, b) in zip(got, pairs)] == [zlib.crc32(a + b) for a, b in pairs]


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return any(a[i + x :] == b[i + y :] for x, y in ((1, 1), (0, 1), (1, 0)))


def variants(documents, ratio=5):
    """The contract of op13, all pairs of words."""
    counts = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in counts if distance_one(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def spelled_documents(n_words=150):
    r = random.Random(13)
    syllables = ["ba", "ca", "de", "aa", "\u00e9l", "\u00ff\u00c0", "on", "\u00d7", "z"]
    stems = ["".join(r.choices(syllables, k=r.randrange(3, 7))) for _ in range(n_words)] + ["a" * 6, "a" * 7, "a" * 8, "ab" * 40, "q" * 1500]
    pool = []
    for stem in stems:
        pool += [stem] * r.choice([6, 30, 200])
        for _ in range(4):  # variants, and variants of variants
            at = r.randrange(len(stem))
            other = r.choice([stem[:at] + stem[at + 1 :], stem[:at] + r.choice("abz\u00e9") + stem[at:], stem[:at] + r.choice("abz\u00e9") + stem[at + 1 :]])
            pool += [other] * r.choice([5, 6, 35, 1])
            stem = r.choice([stem, other])
    r.shuffle(pool)
    rows = [(i, r.choice([" ", "1", " \u4e2d ", "-\n"]).join(x.upper() if x.isascii() and r.random() < 0.2 else x for x in pool[i::120])) for i in range(120)]
    return rows + [(None, " ".join(pool[:300])), (None, None), (3, ""), (4, "short 12 \u4e2d"), (5, rows[5][1]), (5, rows[5][1])]


@pytest.mark.parametrize("shard_words", [20_000, 40])
def test_op13(spark, shard_words):
    from ledger_analytics.llm.spelling import spelling_variants

    rows = spelled_documents()
    docs = spark.createDataFrame([(d, t, "w", 1, "f") for d, t in rows], "doc_id long, text string, word string, n int, form string").repartition(6)
    want = variants(rows)
    assert len(want) > 300 and max(len(w[0]) for w in want) >= 1500 and sum(w[2] not in (w[0], w[1]) for w in want) > 3
    assert Counter(map(tuple, spelling_variants(docs, shard_words=shard_words).select(COLUMNS).collect())) == want


def test_op13_query(spark, tables, documents):
    got = QUERIES["op13_fm_index_variants"](spark, tables[0])
    assert [f.dataType.simpleString() for f in got.schema] == ["string"] * 3 + ["bigint"] * 3
    assert Counter(map(tuple, got.select(COLUMNS).collect())) == variants(documents)


def test_op13_a_hot_group_is_cut_in_pieces(spark):
    """A third of the words begin alike, and all end alike."""
    from ledger_analytics.llm.spelling import near_words

    r = random.Random(6)
    words = {r.choice(["pre", "abc", "xyz"]) + "".join(r.choices("ab", k=r.randrange(3, 8))) + "ing" for _ in range(600)}
    n = {w: r.randrange(5, 500) for w in words}
    got = near_words(spark.createDataFrame(list(n.items()), "word string, n long"), shard_words=30)
    plan = got.collect()
    near = {w: [v for v in words if distance_one(w, v)] for w in words}
    want = {w: (len(vs), min(vs, key=lambda v: (-n[v], v))) for w, vs in near.items() if vs}
    assert {x.word: (x.n_near, x.best) for x in plan} == want and len(plan) == len(want)
    assert all(x.best_n == n[x.best] for x in plan)


def test_index_intervals_agree_in_both_directions():
    from ledger_analytics.llm.spelling import Index

    r = random.Random(5)
    words = sorted({bytes(r.choices(b"abc\xe9", k=r.randrange(6, 12))) for _ in range(400)})
    index = Index(words)
    text = b"\0" + b"\0".join(words) + b"\0"
    for _ in range(200):
        pattern, f, b, size = b"", 0, 0, index.size
        for _ in range(r.randrange(1, 7)):
            c = r.choice(b"abc\xe9")
            one = np.array([index.code[c]])
            if r.random() < 0.5:
                low, high, less = index.ahead.grow(np.array([f]), np.array([f + size]), one)
                pattern, f, b, size = bytes([c]) + pattern, int(low[0]), b + int(less[0]), int(high[0] - low[0])
            else:
                low, high, less = index.back.grow(np.array([b]), np.array([b + size]), one)
                pattern, f, b, size = pattern + bytes([c]), f + int(less[0]), int(low[0]), int(high[0] - low[0])
            assert size == sum(text.startswith(pattern, i) for i in range(len(text)))
            if not size:
                break
    queries = words[:50] + [w[:-1] for w in words[:50]]
    pairs = Counter((queries[q], words[v]) for left in (True, False) for q, v in index.near(queries, left))
    # a word without its last character may itself be short of a half that is long enough: all are found all the same
    assert pairs == Counter((q, v) for q in queries for v in words if distance_one(q, v))

"""Cases of the second review of the training-data operators."""

import random
from collections import Counter

import pyarrow as pa

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def noise(r, n, alphabet=LETTERS + " "):
    return "".join(r.choices(alphabet, k=n))


def sharing_documents(n=700):
    """Random texts around one footer line; some share a passage, too."""
    r = random.Random(11)
    line, passage = noise(r, 71), noise(r, 300)
    return [(i, noise(r, 250 + i % 90) + line + noise(r, 220) + (passage + noise(r, 30) if i % 3 == 0 else "")) for i in range(n)]


def test_op10_no_seed_brings_all_its_segments_into_one_index():
    import numpy as np

    from ledger_analytics.llm import runindex as R

    key, tables = (pa.scalar(0),), []
    rows = sharing_documents()
    for shard in range(70):  # few documents in each, so that no shard finds the line common
        own = rows[10 * shard : 10 * shard + 10]
        tables.append(R._segments(200, 32, 1)((pa.scalar(shard),), pa.table({"doc_id": [d for d, _ in own], "text": [t for _, t in own]})))
    for pairs in (pa.concat_tables(tables), R._segments(200, 32, 1)(key, pa.table({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]}))):
        seed_of = {g: s for a, b in zip(pairs["seeds"].to_pylist(), pairs["segs"].to_pylist()) for s, g in zip(np.frombuffer(a, np.uint64).tolist(), np.frombuffer(b, np.uint64).tolist())}
        asked = [g for x in R._wanted(key, pairs)["segs"].to_pylist() for g in np.frombuffer(x, np.uint64).tolist()]
        assert max(Counter(seed_of[g] for g in asked).values(), default=0) <= 512


def test_op10_a_shared_or_missing_id_is_spread(spark):
    from ledger_analytics.llm import runindex as R

    r = random.Random(12)
    passage = noise(r, 260)
    rows = [((1, None, i)[i % 3], noise(r, 120) + (passage if i % 10 < 2 else "") + noise(r, 60)) for i in range(1800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [x["count"] for x in R._dealt(docs, 16).groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.5 * len(rows) / 16
    want = Counter()
    for doc_id, text in rows:
        at = text.find(passage)
        kept = text if at < 0 else text[:at] + text[at + len(passage):]
        want[(doc_id, len(text), len(text) - len(kept), int(at >= 0), kept.encode())] += 1
    got = R.drop_repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    # a byte beside the passage may happen to be shared by two of its copies, so the passage at least goes
    assert Counter(x.doc_id for x in got) == Counter(d for d, _ in rows)
    assert all(passage.encode() not in x.kept for x in got)
    assert Counter((x.doc_id, x.n_bytes, bytes(x.kept)) for x in got if not x.n_removed) == Counter((w[0], w[1], w[4]) for w in want.elements() if not w[2])
    assert all(x.n_spans == 1 and 260 <= x.n_removed < 275 for x in got if x.n_removed)


def test_op10_hot_seeds_lose_no_match(spark):
    from ledger_analytics.llm.runindex import drop_repeated_bytes

    rows = sharing_documents()
    rows += [(9000, rows[0][1] + rows[0][1]), (9001, rows[1][1]), (9002, None), (9003, rows[2][1][:400])]
    starts = Counter((t or "")[i : i + 200] for _, t in rows for i in range(len(t or "") - 199))
    want = Counter()
    for doc_id, text in rows:
        text = text or ""
        gone = bytearray(len(text))
        for i in range(len(text) - 199):
            if starts[text[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        want[(doc_id, sum(gone), "".join(c for c, g in zip(text, gone) if not g).encode())] += 1
    got = drop_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert Counter((r.doc_id, r.n_removed, bytes(r.kept)) for r in got) == want


def test_op5_finds_short_secrets_and_those_beside_ordinary_text(spark):
    from pyspark.sql import functions as F

    from ledger_analytics.llm.secrets import find_secrets, redact

    r = random.Random(3)
    parts = ["read", "write", "file", "table", "index", "count", "value", "name", "list", "order", "price", "store", "config", "service", "credentials", "authorization"]
    names = ["_".join(r.choices(parts, k=5)) for _ in range(300)]
    rows = [(i, f"the {n} and the {m}, {n.replace('_', '/')} on 2024-03-{10 + i % 20} call {r.randrange(10**10, 10**11)}") for i, (n, m) in enumerate(zip(names, reversed(names)))]
    rows += [(5000 + i, f"password={noise(r, 24, LETTERS)}") for i in range(100)]
    shapes = ["here {} there", "authorization={}", "config_service_credentials_value_{}", "store/order/price/list/index/table/count/value/name/file/{}/read", "token=abcdefgh1={}", "{}.price_list_of_the_store_and_service.{}"]
    keys, planted = {}, []
    for k, shape in enumerate(shapes):
        for i in range(100):
            own = [noise(r, 18 if k == 0 else 24, LETTERS) for _ in range(shape.count("{}"))]
            keys[10_000 * (k + 1) + i] = own
            planted.append((10_000 * (k + 1) + i, shape.format(*own)))
    found = find_secrets(spark.createDataFrame(rows + planted, "doc_id long, text string"))
    got = {x.doc_id: (x.spans, x.t) for x in found.select("doc_id", "spans", redact(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert sum(got[i][0] == [] for i in range(300)) >= 297
    for k, shape in enumerate(shapes):
        clean = sum(not any(key in got[d][1] for key in own) for d, own in keys.items() if d // 10_000 == k + 1)
        assert clean >= 97, (shape, clean)
    assert all(dict(planted)[d][s.start : s.stop] == s.value for d in keys for s in got[d][0])
    assert sum("authorization=[SECRET]" == got[20_000 + i][1] for i in range(100)) >= 95


def test_op8_learns_from_long_documents(spark):
    from ledger_analytics.llm import toxicity as X

    r = random.Random(8)
    plain = [f"{i}longish{i}harmless{i}" for i in range(80)]
    book = lambda bad, n: " ".join(r.choice(["nasty", "foul"]) if bad and r.random() < 0.1 else r.choice(plain) for _ in range(n))
    for case, size in (("all long", lambda bad: 1200), ("clean ones long", lambda bad: 40 if bad else 1200)):
        rows = [(i, book(i % 2, size(i % 2))) for i in range(48)]
        assert max(len(t) for _, t in rows) > X.LONGEST
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        labels = spark.createDataFrame([(i, 1, i % 2) for i in range(48)], "doc_id long, quality int, toxic int")
        network = X.fit(docs, labels)
        assert not isinstance(network, float), case
        right = [(s.score >= 0.5) == (s.doc_id % 2 == 1) for s in X.with_score(docs, network).collect()]
        assert sum(right) >= 44, case


def test_op8_excerpts_are_bounded_and_in_order(spark):
    import numpy as np

    from ledger_analytics.llm import toxicity as X

    assert X._level(np.array([5, 10, 100, 200]), 75, 0) == 30 and X._level(np.array([5, 10]), 75, 7) == 10 and X._level(np.array([50, 90]), 20, 30) == 30
    text = "".join(f"{i:09d}\n" for i in range(5000))
    got = [r.t for r in spark.createDataFrame([(text,), (text[:3000],)], "t string").select(X._excerpt("t", 4000).alias("t")).collect()]
    assert got[1] == text[:3000]
    kept = got[0].split()
    assert len(kept) == 400 and kept == sorted(kept) and set(kept) <= set(text.split())


def test_op1_texts_without_sentence_ends_have_several_digests(spark):
    import re

    from ledger_analytics.llm.fingerprints import PARAGRAPH, sketch_documents

    r = random.Random(2)
    texts = [noise(r, 900, "abcdefghijklmnopqrstuvwxyz    "), noise(r, 900, LETTERS), "".join(chr(r.randrange(0x4E00, 0x9FA0)) for _ in range(900)),
             "".join(noise(r, 40, "अकगच ") + "।" for _ in range(25)), noise(r, 700, "xyz ")]
    for t in texts:
        own = re.findall(PARAGRAPH, t)
        assert "".join(own) == t and len(own) >= 3
    moved = set(re.findall(PARAGRAPH, "some words in front " + texts[0]))
    assert len(moved & set(re.findall(PARAGRAPH, texts[0]))) >= 2  # the cuts follow the content
    got = sketch_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == 5 and all(x.near_edited > 0.15 for x in got)


def test_op1_fingerprints_can_be_subtracted_and_peeled(spark):
    """Likeness and digests that differ, worked out from the two strings alone."""
    import re

    import xxhash

    from ledger_analytics.llm.fingerprints import PARAGRAPH, sketch_documents

    r = random.Random(8)
    lines = [" ".join(words(r, 12)) for _ in range(40)]
    texts = ["\n".join(r.sample(lines, n)) for n in (0, 1, 2, 4, 8, 12, 20, 40)] + ["\n".join(lines[:30]), "\n".join(lines[:30])]
    signed = lambda n: n - ((n >> 63) << 64)
    check = lambda k: xxhash.xxh64_intdigest(k.to_bytes(8, "little"), 42)
    keys = lambda t: {xxhash.xxh64_intdigest(p.encode(), 42) for p in re.findall(PARAGRAPH, t)}
    cells = lambda f: [tuple(int(x, 16) for x in c.split(".")) for c in f.split("-")]

    def peel(own, other):
        left = [[a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2]] for a, b in zip(own, other)]
        got = {}
        while True:
            pure = [c for c in left if abs(c[0]) == 1 and c[2] == check(c[1]) & 0xFFFFFFFF]
            if not pure:
                return got, all(c == [0, 0, 0] for c in left)
            n, k, h = pure[0]
            got[k] = n
            for g in range(3):
                at = 6 * g + (signed(k) >> (13 + 13 * g)) % 6
                left[at] = [left[at][0] - n, left[at][1] ^ k, left[at][2] ^ h]

    got = sorted(sketch_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect(), key=lambda x: x.doc_id)
    resolved = 0
    for x, text in zip(got, texts):
        after = texts[x.doc_id - 1]
        cut = len(text) // 3
        a, b = keys(text), keys(text[: len(text) - cut] + after[:cut])
        assert x.differing == ",".join(sorted([f"-{k:016x}" for k in a - b] + [f"+{k:016x}" for k in b - a]))
        own, edited = cells(x.fingerprint), cells(x.edited_fingerprint)
        assert sum(c[0] for c in own[:6]) == len(a) and sum(c[0] for c in edited[6:12]) == len(b)
        found, whole = peel(own, edited)
        if whole:
            resolved += 1
            assert found == {k: 1 for k in a - b} | {k: -1 for k in b - a}
            far = len(found)
            assert abs(x.near_edited - ((len(a) + len(b) - far) / (len(a) + len(b) + far) if a or b else 1.0)) < 1e-12
    assert 4 <= resolved < len(texts)  # the others take the larger sketches
    assert got[8].fingerprint == got[9].fingerprint and got[9].near_next == 1.0


def test_op1_retries_up_to_the_digests_themselves(spark):
    from ledger_analytics.llm import fingerprints as F1

    r = random.Random(9)
    some = [r.getrandbits(63) for _ in range(120)]
    pairs = [(some[:n], some[n // 2 : n // 2 + m]) for n, m in ((0, 0), (1, 0), (5, 5), (9, 14), (30, 10), (60, 60))]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<long>, b array<long>")
    tries = [F1.peel(F1.subtract(F1.sketch("a", w), F1.sketch("b", w)), w) for w in F1.WIDTHS]
    got = rows.selectExpr("i", f"{F1.recovered('a', 'b')} as got", *[f"{t} as try_{n}" for n, t in enumerate(tries)]).orderBy("i").collect()
    assert [got[n].try_0 is None for n in (0, 1, 2, 5)] == [False, False, False, True]
    assert got[3].try_1 is not None and got[5].try_2 is None
    for x, (a, b) in zip(got, pairs):
        want = {k: 1 for k in set(a) - set(b)} | {k: -1 for k in set(b) - set(a)}
        for found in (x.got, x.try_0, x.try_1, x.try_2):
            assert found is None or (len(found) == len(want) and {g.k: g.s for g in found} == want)
        assert x.got is not None


def words(r, n):
    return [noise(r, r.randint(2, 9), LETTERS) for _ in range(n)]


def test_op2_removes_only_what_the_automaton_finds():
    from ledger_analytics.llm import phrases as P

    r = random.Random(5)
    shared, own = words(r, 30), words(r, 40)
    docs = pa.table({"doc_id": [7, 8], "text": [" \t".join(own[:20] + shared), "\n".join(own[:10] + shared[:25] + own[20:])]})
    remove = P._removal(20, 10)

    def removed(passages):
        rows = [(0, foreign, " ".join(text)) for foreign, text in passages]
        columns = list(zip(*rows)) or [[], [], []]
        types = [("shard", pa.int32()), ("foreign", pa.bool_()), ("text", pa.string())]
        table = pa.table([pa.array(c, t) for c, (_, t) in zip(columns, types)], names=[n for n, _ in types])
        out = remove((pa.scalar(0),), docs, table)
        return dict(zip(out["doc_id"].to_pylist(), out["n_removed"].to_pylist()))

    # the texts do repeat each other, but nothing goes without a phrase that finds it
    assert removed([]) == {7: 0, 8: 0}
    assert removed([(True, words(r, 30))]) == {7: 0, 8: 0}
    # a passage that starts in this shard: its first occurrence stays
    assert removed([(False, shared[:25])]) == {7: 0, 8: 25}
    # a passage that starts in another shard: all occurrences go, as far as its windows reach
    assert removed([(True, shared)]) == {7: 30, 8: 25}
    assert removed([(True, shared[2:24])]) == {7: 22, 8: 22}
    # the phrases are there, but no window around them has the same words
    assert removed([(True, own[:1] + shared[1:19] + own[:1])]) == {7: 0, 8: 0}


def test_op2_sends_passages_as_text_to_the_shards_that_hold_them():
    import numpy as np

    from ledger_analytics.llm import phrases as P
    from ledger_analytics.llm.shards import pack

    r = random.Random(6)
    shared, other = words(r, 30), words(r, 21)
    text = "  ".join(words(r, 5) + shared + words(r, 5) + other)
    docs = pa.table({"doc_id": [1, 2], "text": [text, text]})
    block = P._Block(docs, 20, 10)
    starts = np.concatenate([np.arange(5, 16), [40, 41]])
    keys = block.windows(starts, 20)
    told = [(k, s) for i, k in enumerate(keys.tolist()) for s in ((3, 9) if i < 11 else (9,))]
    answer = P._keys_table([(0, 4, pack(np.array([k for k, _ in told], np.uint64)), pack(np.array([s for _, s in told], np.int32)))])
    out = P._passages(20)((pa.scalar(4),), docs, answer)
    assert out.to_pylist() == [
        {"owner": 4, "shards": [3, 9], "passage": " ".join(shared)},
        {"owner": 4, "shards": [9], "passage": " ".join(other)},
    ]


def test_op2_long_passages_many_pieces_and_repeats_inside_a_window(spark):
    from ledger_analytics.llm import phrases as P

    r = random.Random(7)
    long = words(r, 2 * P.PASSAGE_WINDOWS + 100)
    loop = words(r, 3) * 30
    rows = [(1, " ".join(long)), (2, " ".join(words(r, 9) + long[50:] + loop)), (3, " ".join(loop)), (4, " ".join(["a"] * 60)), (5, None)]
    rows += [(10 + i, " ".join(words(r, 30) + long[8000:8400] + loop[:23] + words(r, 30))) for i in range(60)] + [(5, ""), (None, " ".join(long[:30]))]
    seen, want = set(), Counter()
    for doc_id, text in sorted(rows, key=lambda d: (d[0] is None, d[0] or 0, d[1] is None, d[1] or "")):
        w = (text or "").split()
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if key in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(key)
        want[(doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))] += 1
    got = P.drop_repeated_phrases(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert Counter(tuple(x) for x in got) == want


def item_windows(text):
    w = (text or "").lower().split()
    n = min(13, len(w))
    return {tuple(w[s : s + n]) for s in range(len(w) - n + 1)} if n else set()


def test_op4_items_with_one_opening_meet_only_documents_that_hold_their_windows(spark):
    from ledger_analytics.llm.decontaminate import benchmark_hits

    r = random.Random(8)
    opening, shared = words(r, 5), words(r, 13)
    items = [(f"i{i}", " ".join(opening + words(r, 15))) for i in range(300)]
    items += [(f"s{i}", " ".join(words(r, 4) + shared + words(r, 4))) for i in range(200)] + [("short", "yes no"), ("short", "Yes NO"), (None, "null item")]
    docs = [(i, " ".join(words(r, 3) + opening + words(r, 20))) for i in range(200)]
    docs += [(1000 + i, " ".join(opening + words(r, 20) + shared + shared[:6] + words(r, 9) + ["YES", "no", "null", "item"])) for i in range(40)]
    docs += [(2000, items[7][1] + " " + items[8][1]), (2000, items[7][1]), (2001, None), (2002, ""), (None, items[9][1])]
    of = {}
    for item, text in items:
        for w in item_windows(text):
            of.setdefault(w, set()).add(item or "")
    want = Counter()
    for doc_id, text in docs:
        w = (text or "").lower().split()
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in of}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in of:
                    found |= of[tuple(w[s : s + n])]
                    hit[s : s + n] = [True] * n
        want[(doc_id, len(w), sum(hit), tuple(sorted(found)))] += 1
    for limit in (10**6, 0):
        got = benchmark_hits(
            spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id string, text string"), filter_limit=limit
        ).collect()
        assert Counter((x.doc_id, x.n_words, x.n_hit, tuple(x["items"])) for x in got) == want

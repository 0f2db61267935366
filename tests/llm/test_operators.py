"""Every query against a brute-force version, over awkward rows and over empty tables."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from ledger_analytics.llm import queries as registry
from ledger_analytics.llm.fingerprints import PARAGRAPH
from ledger_analytics.llm.secrets import find_secrets, redact

from .conftest import CARRIED

WHITE = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
QUERIES = registry.queries()


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def raw(text) -> bytes:
    return (text or "").encode()


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", [n for n in QUERIES])
def test_empty_tables(spark, tables, name):
    assert QUERIES[name](spark, tables[1]).count() == 0


@pytest.mark.parametrize("name", ["op6_trie_unigram", "op8_attentive_gru"])
def test_a_row_for_each_row(spark, tables, documents, name):
    got = QUERIES[name](spark, tables[0])
    assert Counter(r[0] for r in got.select("doc_id").collect()) == Counter(d for d, _ in documents)


@pytest.mark.parametrize("name", ["op1_lookup_sketches", "op5_markov_secrets", "op9_multinomial_blocks"])
def test_native_plans(spark, tables, name):
    plan = QUERIES[name](spark, tables[0])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_op1(spark, tables, documents):
    signed = lambda t: (h := xxhash.xxh64_intdigest(raw(t), 42)) - ((h >> 63) << 64)
    order = sorted(documents, key=lambda d: (d[0] is None, -(d[0] or 0), signed(d[1]), d[1] or ""))
    parts = lambda t: set(re.findall(PARAGRAPH, t))
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    want = Counter()
    for n, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        want[(doc_id, len(text), sha(edited.encode()), round(alike(parts(text), parts(edited)), 9), round(alike(parts(text), parts(after)), 9))] += 1
    got = QUERIES["op1_lookup_sketches"](spark, tables[0]).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    by_id = defaultdict(set)
    for doc_id, text in documents:
        by_id[doc_id].add(text or "")
    prints = defaultdict(set)
    for r in got:
        if len(by_id[r.doc_id]) == 1:
            prints[next(iter(by_id[r.doc_id]))].add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values())


def test_op2(spark, tables, documents):
    seen, want = set(), Counter()
    for doc_id, text in sorted(documents, key=lambda d: (d[0] is None, d[0] or 0, d[1] is None, d[1] or "")):
        w = WHITE.findall(raw(text))
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if key in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(key)
        want[(doc_id, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))] += 1
    assert rows_of(QUERIES["op2_repeated_phrases"](spark, tables[0]), "doc_id", "n_words", "n_removed", "kept_sha256") == want


def simhash(text) -> int:
    w = WHITE.findall(raw(text).lower())
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 2 and top(a) != top(b):
                root[top(a)] = top(b)
    return {p: top(p) for p in prints}


def test_op3(spark, tables, documents):
    prints = {t: simhash(t) for _, t in documents}
    of = groups(set(prints.values()))
    least = {}
    for doc_id, text in documents:
        g = of[prints[text]]
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    want = Counter((d, f"{prints[t]:016x}", least.get(of[prints[t]])) for d, t in documents)
    assert rows_of(QUERIES["op3_simhash_bk_trees"](spark, tables[0]), "doc_id", "fingerprint", "component_id") == want


def test_op3_large_groups_are_cut_without_loss(spark):
    from ledger_analytics.llm.components import connected_components
    from ledger_analytics.llm.simhash import similar_links

    base = 0x0123456789ABCDEF
    values = sorted({base ^ (1 << i) ^ (1 << j) for i in range(30) for j in range(i, 30)} | {base ^ 0xFFFF << 40})
    of = groups(values)
    df = spark.createDataFrame([(v,) for v in values], "f long")
    for limit in (10, 10**6):
        got = {r.node: r.label for r in connected_components(spark, similar_links(df, split_above=limit)).collect()}
        same = defaultdict(set)
        for v in values:
            same[of[v]].add(got.get(v, v))
        assert all(len(s) == 1 for s in same.values())
        assert len({got.get(v, v) for v in values}) == len(same)


def hits(documents, items):
    windows, sizes = defaultdict(set), set()
    for item, text in items:
        w = ALNUM.findall(raw(text).lower())
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[s : s + n])].add("" if item is None else str(item))
            sizes.add(n)
    for doc_id, text in documents:
        w = ALNUM.findall(raw(text).lower())
        hit, found = [False] * len(w), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    found |= windows[tuple(w[s : s + n])]
                    hit[s : s + n] = [True] * n
        yield doc_id, len(w), sum(hit), len(found), sha(",".join(sorted(found)).encode()), sum(hit) > 0 and 20 * sum(hit) >= len(w)


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_op4(spark, tables, documents, limit, monkeypatch):
    from ledger_analytics.llm import decontaminate

    monkeypatch.setattr(decontaminate.benchmark_hits, "__defaults__", (*decontaminate.benchmark_hits.__defaults__[:-1], limit))
    items = [tuple(r) for r in spark.read.parquet(f"{tables[0]}/benchmark.parquet").collect()]
    got = rows_of(QUERIES["op4_winnowing"](spark, tables[0]), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == Counter(hits(documents, items))


ASSIGN = re.compile(r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_op5(spark, tables, documents):
    kinds = ("assign", "access", "hex")
    want = Counter()
    for doc_id, text in documents:
        s = base_spans(text)
        want[(doc_id, *(sum(x[1] == k for x in s) for k in range(3)), sha(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in s).encode()))] += 1
    got = QUERIES["op5_markov_secrets"](spark, tables[0])
    assert rows_of(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want
    spans = {r.doc_id: r.spans for r in got.collect()}
    assert "assign:" in next(spans[d] for d, t in documents if t and t.startswith("token ="))


def test_op5_models_tell_random_strings_from_identifiers(spark):
    import random

    r = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    parts = ["read", "write", "file", "table", "index", "count", "value", "name", "list", "order", "price", "store"]
    names = ["_".join(r.choices(parts, k=5)) for _ in range(300)]
    keys = ["".join(r.choices(alphabet, k=28)) for _ in range(300)]
    rows = [(i, f"the {n} and the {m}") for i, (n, m) in enumerate(zip(names, reversed(names)))] + [(1000 + i, f"here {k} there") for i, k in enumerate(keys)]
    rows += [(5000 + i, f"password={k}") for i, k in enumerate("".join(r.choices(alphabet, k=24)) for _ in range(100))]
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[i] == [] for i in range(300)) >= 297
    assert sum(found[1000 + i] == [3] for i in range(300)) >= 285


def test_names_that_are_taken(spark):
    from ledger_analytics.llm import decontaminate, simhash, toxicity

    rows = [(1, "token=abcdefgh1", "a", 2, 3, 4, 5, 6), (1, "token=abcdefgh1", "b", 2, 3, 4, 5, 6), (2, "one two", "c", 2, 3, 4, 5, 6), (None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, SPANS string, score int, _print int, _nth int, _bad_key int, _Bad_id int")
    found = find_secrets(docs, ratios=None)
    assert found.columns == [*docs.columns, "spans_"] and Counter(r[:8] for r in found.collect()) == Counter(rows)
    assert Counter(len(r.spans_) for r in found.collect()) == {1: 2, 0: 2}
    scored = toxicity.with_score(docs, 0.25)
    assert scored.columns == [*docs.columns, "score_"] and Counter(tuple(r) for r in scored.collect()) == Counter((*r, 0.25) for r in rows)
    kept = simhash.keep_one(docs).collect()
    assert Counter((r.doc_id, r._nth) for r in kept) == {(1, 4): 1, (2, 4): 1, (None, None): 1}
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert Counter(map(tuple, decontaminate.drop_contaminated(docs, bench).collect())) == Counter(r for r in rows if r[0] != 2)


def test_keep_one_of_many_rows(spark):
    """A third of all rows equal, rows of one id with several texts, and rows without an id."""
    from ledger_analytics.llm.simhash import keep_one

    text = lambda i: " ".join(f"t{i}w{j}" for j in range(40))
    rows = [(7, text(0), 1)] * 100 + [(9, text(0), 2)] * 50 + [(3, text(i % 4), 3) for i in range(40)] + [(None, text(9), 4)] * 30 + [(i, text(i), 5) for i in range(20, 60)] + [(None, None, 6), (0, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(6)
    kept = [tuple(r) for r in keep_one(docs).collect()]
    prints = {t: simhash(t) for _, t, _ in rows}
    of = groups(set(prints.values()))
    least = {}
    for d, t, _ in rows:
        g = of[prints[t]]
        least[g] = d if least.get(g) is None else least[g] if d is None else min(d, least[g])
    assert Counter(of[prints[t]] for _, t, _ in kept) == Counter(set(of.values()))
    assert all(d == least[of[prints[t]]] for d, t, _ in kept) and set(kept) <= set(rows)


def test_redaction(spark):
    from pyspark.sql import functions as F

    rows = [(1, "é token = \"0123456789abcdef0123456789abcdef\" ü"), (2, "clean"), (3, None), (4, "")]
    found = find_secrets(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.t for r in found.select("doc_id", redact(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert got == {1: 'é [SECRET]" ü', 2: "clean", 3: None, 4: ""}


def test_op6_against_a_unigram_library(spark, tables, documents):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from ledger_analytics.llm.tokencounts import BYTE_SCORE, count_tokens, read_pieces

    pieces = read_pieces()
    known = {p for p, _ in pieces}
    model = Tokenizer(models.Unigram([("<unk>", BYTE_SCORE), *pieces], 0))
    model.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always")
    got = Counter((r.doc_id, r.n_pretokens, r.n_tokens) for r in count_tokens(spark.read.parquet(f"{tables[0]}/documents.parquet")).collect())
    compared = 0
    for doc_id, text in documents:
        w = re.findall("[^\x20\x09-\x0D]+", text or "")
        if all(c in known for x in w for c in x) and not any(c.isspace() for x in w for c in x):
            n = sum(len(model.encode(x).ids) for x in w)
            assert any(k[0] == doc_id and k[1] == len(w) and abs(k[2] - n) <= n // 500 for k in got), (doc_id, n)
            compared += 1
    assert compared > 40


def test_op6_bruteforce():
    import numpy as np

    from ledger_analytics.llm.tokencounts import BYTE_SCORE, Pieces, count_alone, count_pretokens

    pieces = [("▁a", -1.0), ("a", -2.0), ("b", -2.5), ("ab", -3.0), ("▁", -1.5), ("bab", -4.0), ("é", -3.0), ("▁ab", -2.0), ("ba", -4.5)]
    score = dict(pieces)

    def best(word):
        word, table = "▁" + word, [(0.0, 0)]
        for e in range(1, len(word) + 1):
            options = [(table[b][0] + score[word[b:e]], table[b][1] + 1) for b in range(e) if word[b:e] in score]
            width = 1 if e == 1 else len(word[e - 1].encode())
            options.append((table[e - 1][0] + BYTE_SCORE * width, table[e - 1][1] + width))
            top = max(s for s, _ in options)
            table.append((top, min(n for s, n in options if s > top - 1e-9)))
        return table[-1][1]

    r = np.random.default_rng(1)
    words = sorted({"".join(r.choice(list("abéx漢"), r.integers(1, 12))) for _ in range(500)}, key=lambda w: w.encode())
    got = count_pretokens([b"\xff" + w.encode() for w in words], Pieces.of(pieces))
    assert got.tolist() == [best(w) for w in words]
    assert [count_alone(b"\xff" + w.encode(), Pieces.of(pieces)) for w in words] == got.tolist()


def test_op6_long_words(spark):
    """A megabyte without a blank, and words on either side of the trie's bound."""
    import time

    from ledger_analytics.llm import tokencounts as X

    pieces = X.Pieces.of(X.read_pieces())
    with open(__file__) as f:
        some = "".join(f.read().split())
    long = ["\xff".encode("latin-1") + w for w in (some[:400].encode(), ("漢字" * 90).encode(), b"ab" * 120, "🙂é".encode() * 50)]
    assert [X.count_alone(w, pieces) for w in long] == X.count_pretokens(sorted(long), pieces)[[sorted(long).index(w) for w in long]].tolist()
    began = time.time()
    text = (some * (1 + (1 << 20) // len(some)))[: 1 << 20]
    n_pre, n_tok = X.count_batch(pa.array([text + " a", "漢" * 8000, None]), pieces)
    assert time.time() - began < 20 and n_pre.tolist() == [2, 1, 0] and 1 << 18 < n_tok[0] < 1 << 20


@pytest.mark.parametrize("name", ["op7_snapshot_collapse", "op9_multinomial_blocks", "op11_url_vocabulary"])
def test_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.sql(f"create view {t} as select * from '{tables[0]}/{t}.parquet/*.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    assert rows_of(QUERIES[name](spark, tables[0]), *want.columns) == Counter(want.fetchall())


def test_op9_reaches_its_targets(spark, tables):
    from ledger_analytics.llm.mixing import BLOCK, mix_sources

    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    manifest, report = mix_sources(docs)
    taken, target, size = Counter(), {}, Counter()
    rows = mix_sources(docs)[1].collect()
    for r in rows:
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= BLOCK and size[s] * 3 >= target[s] for s in target)
    assert abs(sum(target.values()) - sum(size.values())) < 1
    # water filling: the same level for all that aren't capped
    weight = dict(zip(sorted((s for s in target if s is not None)), [5, 2, 1, 5])) | {None: 2}
    levels = {round(target[s] / weight[s], 3) for s in target if target[s] < 3 * size[s] - 1e-6}
    assert len(levels) == 1 and all(3 * size[s] / weight[s] <= max(levels) + 1e-6 for s in target if target[s] >= 3 * size[s] - 1e-6)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, report.collect()))
    assert sum(r.to_word - r.from_word for r in manifest.collect()) == sum(taken.values())


def test_op10(spark, tables, documents):
    starts = Counter(raw(t)[i : i + 200] for _, t in documents for i in range(len(raw(t)) - 199))
    want = Counter()
    for doc_id, text in documents:
        b = raw(text)
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if starts[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans = len(re.findall(b"\1+", bytes(gone)))
        want[(doc_id, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))] += 1
    assert rows_of(QUERIES["op10_run_length_index"](spark, tables[0]), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_run_length_index():
    import numpy as np

    from ledger_analytics.llm.runindex import RunLengthIndex

    r = np.random.default_rng(2)
    texts = [bytes(r.integers(97, 100, r.integers(1, 60)).astype(np.uint8)) for _ in range(40)]
    texts += texts[:5] + [b"a" * 50, b"a" * 30, b"\0\0\0"]
    index = RunLengthIndex(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]))
    stats, place = index.matching_statistics(), 0
    suffixes = [t[i:] for t in texts for i in range(len(t))]
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    at = 0
    for t in texts:
        for i in range(len(t)):
            assert stats[at + i] == max(common(t[i:], s) for k, s in enumerate(suffixes) if k != place), (t, i)
            place += 1
        at += len(t) + 1


def test_pipeline(spark, tables, documents):
    """The run is its stages; each stage's decision holds on its own input."""
    folder = tables[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        rows = [(r.doc_id, r.text) for r in after.collect()]
        assert all(tuple(r)[-len(CARRIED):] == CARRIED for r in after.collect())
        kept[name] = rows
        path = f"{folder}/stage-{name.replace(' ', '-')}"
        after.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    toxic_out = kept["toxicity"]
    of = groups({simhash(t) for _, t in toxic_out})
    firsts = {}
    for d, t in toxic_out:
        g = of[simhash(t)]
        firsts[g] = d if firsts.get(g) is None else (firsts[g] if d is None else min(d, firsts[g]))
    assert Counter(d for d, _ in kept["near duplicates"]) == Counter(firsts.values())
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = [d for d, h in zip(kept["near duplicates"], hits(kept["near duplicates"], items)) if not h[-1]]
    assert Counter(kept["decontamination"]) == Counter(clean)
    assert Counter(d for d, _ in kept["secrets"]) == Counter(d for d, _ in clean)
    untouched = Counter((d, t) for d, t in clean if not base_spans(t) and not (t or "").startswith("Xq7Z"))
    assert not untouched - Counter(kept["secrets"])
    assert not any(base_spans(t) for _, t in kept["secrets"])
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, folder).collect()) == Counter(d for d, _ in clean)

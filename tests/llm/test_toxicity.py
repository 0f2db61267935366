"""The toxicity network: gradients, windows, training and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa

from ledger_analytics.llm import toxicity as X

SF = "/root/testdata/sf0.01"


def small_network(seed=3):
    r = np.random.default_rng(seed)
    net = X.Network.start(np.sort(r.integers(1, 1 << 60, 20, dtype=np.uint64)), r.normal(size=20) * 0.3, r.normal(size=X.TRIGRAMS) * 0.3, seed)
    x = np.vstack([r.normal(size=(9, 2 * X.WIDTH)), np.zeros((1, 2 * X.WIDTH))]).astype(np.float32)
    ids = r.integers(0, 9, (6, 7))
    ids[0, 4:] = ids[3, 1:] = -1
    return net, x, ids, np.array([1, 0, 1, 0, 1, 0], np.float32)


def loss(net, x, ids, y):
    p = 1 / (1 + np.exp(-net.logits(x, ids).astype(np.float64)))
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def test_gradients_match_finite_differences():
    net, x, ids, y = small_network()
    g, d_x = net.gradients(x, ids, y)
    r = np.random.default_rng(0)
    for name in ("in_f", "in_b", "state_f", "state_b", "bias_f", "bias_b", "look", "key", "out", "out_bias"):
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in net.weights[name].shape)
            keep = net.weights[name][at]
            net.weights[name][at] = keep + 0.02
            up = loss(net, x, ids, y)
            net.weights[name][at] = keep - 0.02
            down = loss(net, x, ids, y)
            net.weights[name][at] = keep
            assert abs((up - down) / 0.04 - g[name][at]) < 2e-3 + 0.05 * abs(g[name][at]), (name, at)
    for i, j in ((0, 0), (4, 3), (8, 15)):
        keep = x[i, j]
        x[i, j] = keep + 0.02
        up = loss(net, x, ids, y)
        x[i, j] = keep - 0.02
        down = loss(net, x, ids, y)
        x[i, j] = keep
        assert abs((up - down) / 0.04 - d_x[i, j]) < 2e-3


def test_windows_overlap_and_cover_every_word():
    texts = ["", "one", " ".join(f"w{i}" for i in range(32)), " ".join(f"w{i}" for i in range(33)), " ".join(f"w{i}" for i in range(200)), None]
    text = X.Text.of(pa.array(texts, pa.string()))
    ids, owner = text.windows()
    assert np.bincount(owner).tolist() == [1, 1, 1, 2, 12, 1]
    for d in range(len(texts)):
        own = set(text.form[text.first[d] : text.first[d + 1]].tolist())
        assert own == set(ids[owner == d].ravel().tolist()) - {-1}
    assert (ids[owner == 0] == -1).all()


def test_scores_do_not_depend_on_the_batch():
    r = np.random.default_rng(4)
    texts = [" ".join(f"v{k}" for k in r.integers(0, 60, r.integers(1, 90))) + (" nasty" if i % 4 == 0 else "") for i in range(160)]
    net = X.train(texts, np.array([i % 4 == 0 for i in range(160)], np.float32))
    whole = net.scores(pa.array(texts))
    alone = np.concatenate([net.scores(pa.array([t])) for t in texts])
    assert np.allclose(whole, alone, atol=1e-4)
    assert ((whole >= X.THRESHOLD) == (np.arange(160) % 4 == 0)).mean() > 0.97
    again = X.train(texts, np.array([i % 4 == 0 for i in range(160)], np.float32))
    assert np.allclose(again.scores(pa.array(texts)), whole, atol=1e-6)


def test_held_out_accuracy(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = X.op8_attentive_gru(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in bad for b in good])
    assert auc > 0.85
    assert np.mean([s >= 0.7 for s in bad]) > 0.6 and np.mean([s >= 0.7 for s in good]) < 0.05


def test_labels_of_one_class(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string")
    for toxic, share in ((1, 1.0), (0, 0.0)):
        labels = spark.createDataFrame([(i, 1, toxic) for i in range(9)], "doc_id long, quality int, toxic int")
        network = X.fit(docs, labels)
        assert network == share
        assert {r.score for r in X.with_score(docs, network).collect()} == {share}

"""The network: gradients against differences, held-out accuracy, whole texts and odd rows."""

import random
import zlib

import numpy as np
import pytest

from tallyspark.llm import toxicity as T


def texts(n, seed=1):
    rnd = random.Random(seed)
    words = [a + b + c for a in ("ta", "re", "mi", "so") for b in ("la", "ne", "ri", "du") for c in ("n", "st", "", "ck")]
    out, labels = [], []
    for i in range(n):
        body = [rnd.choice(words) for _ in range(rnd.randint(5, 220))]
        bad = i % 3 == 0
        if bad:
            for _ in range(2):
                body.insert(rnd.randrange(len(body)), rnd.choice(["idiot", "moron", "Scum", "jerk" + rnd.choice(["ed", "ing", "s", "face"])]))
        out.append(" ".join(body))
        labels.append(int(bad))
    return out, np.array(labels)


def test_gradient(monkeypatch):
    monkeypatch.setattr(T, "HIDDEN", 3)
    net, r = T.Network.new(3), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    gates = np.vstack([r.standard_normal((5, 18)), np.zeros((1, 18))])
    ids = np.array([[0, 1, 2, 3], [4, 0, -1, -1], [-1, -1, -1, -1]])
    slope = np.array([0.5, -1.0, 2.0])
    grad, dgates = net.gradient(net.read(gates, ids, keep=True), slope, gates, ids)

    def loss():
        return float(net.read(gates, ids) @ slope)

    for array, own in [(gates, dgates), *((net.p[k], grad[k]) for k in ("ahead", "back", "key", "query", "out"))]:
        for _ in range(4):
            at = tuple(r.integers(0, s) for s in array.shape)
            if array is gates and at[0] == 5:
                continue
            old, step = array[at], 1e-3
            array[at] = old + step
            up = loss()
            array[at] = old - step
            down = loss()
            array[at] = old
            assert own[at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-3)


def test_windows_cover_everything():
    for n in (0, 1, 63, 64, 65, 112, 113, 1000):
        starts = T.windows(n)
        seen = {w for s in starts for w in range(s, min(n, s + T.WINDOW))}
        assert seen == set(range(n)) and all(b - a < T.WINDOW for a, b in zip(starts, starts[1:], strict=False))


@pytest.fixture(scope="module")
def network():
    return T.fit(*texts(450))


def test_held_out_accuracy(network):
    sample, labels = texts(300, seed=9)
    wrong = (T.logits(network, sample) > np.log(T.THRESHOLD / (1 - T.THRESHOLD))) != (labels == 1)
    assert wrong.mean() < 0.05
    long = " ".join(sample[1:80:3]) + " idiot moron scum idiot"
    assert T.logits(network, [long])[0] > T.logits(network, [sample[1]])[0]  # the end of a long text counts


def test_score_and_keep(spark, network):
    rows = [(1, "some idiot moron scum text", "x"), (2, "talan renest mirick", "y"), (None, None, None), (2, "", "z"), (2, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = T.score(docs, network).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert {(r.doc_id, r.held_out) for r in out} == {(i, zlib.crc32(str(i).encode() if i else b"") % 4 == 2) for i in (1, 2, None)}
    kept = T.keep_clean(docs, network).collect()
    assert [r.doc_id for r in kept].count(1) == 0 and len(kept) == 4 and kept[0].asDict().keys() == {"doc_id", "text", "score"}
    assert T.score(docs.limit(0), network).count() == 0


def test_no_labels_rejects_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert T.score(docs, T.train(docs, empty)).first().predicted == 0

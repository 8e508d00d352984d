import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetdw.llm import toxicity as X


@pytest.fixture(scope="module")
def corpus():
    g = random.Random(1)
    calm = ["river", "stone", "garden", "morning", "letter", "window", "bread", "music", "quiet", "harbour", "paper", "cloud"]
    rude = ["blockhead", "blockheads", "numskull", "numskulls"]
    rows = []
    for i in range(500):
        words = [g.choice(calm) for _ in range(g.randint(5, 120))]
        toxic = i % 4 == 0
        for _ in range(g.randint(2, 4) if toxic else 0):
            words[g.randrange(len(words))] = g.choice(rude)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def net(corpus):
    part = corpus[:400]
    return X.train([t for _, t, _ in part], [y for *_, y in part])


def test_gradients_match_differences(monkeypatch):
    net, g = X.Network(3), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    monkeypatch.setattr(X.np, "float32", np.float64)
    at = g.integers(0, 20, (5, X.WINDOW))
    at[0, 20:] = 0
    at = np.unique(np.r_[at.ravel(), np.arange(20)], return_inverse=True)[1][:at.size].reshape(at.shape)
    gates, mask, w = g.standard_normal((20, 6 * X.HIDDEN)), (at > 0).astype(float), g.standard_normal(5)
    _, saved = net.forward(gates, at, mask, keep=True)
    grad, d_gates = net.backward(gates, at, saved, w)
    for name, i in (("out", 3), ("att", 5), ("uf", (2, 7)), ("ub", (1, 20)), ("bias", 0)):
        value = net.p[name]
        value[i] += 1e-5
        up = net.forward(gates, at, mask) @ w
        value[i] -= 2e-5
        down = net.forward(gates, at, mask) @ w
        value[i] += 1e-5
        assert grad[name][i] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-8)
    for i in ((3, 2), (5, 30), (7, 40)):
        gates[i] += 1e-5
        up = net.forward(gates, at, mask) @ w
        gates[i] -= 2e-5
        down = net.forward(gates, at, mask) @ w
        gates[i] += 1e-5
        assert d_gates[i] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-8)


def test_held_out_accuracy(net, corpus):
    part = corpus[400:]
    score = X.score_texts(net, X.Reader(net), [t for _, t, _ in part])
    assert np.mean((score >= 0.5) == [y == 1 for *_, y in part]) >= 0.95


def test_every_window_counts(net):
    reader = X.Reader(net)
    calm = ["river stone garden morning"] * 200
    one = lambda at: " ".join([*calm[:at], "blockhead numskull", *calm[at:]])
    scores = X.score_texts(net, reader, [" ".join(calm), one(0), one(100), one(200)])
    assert scores[0] < 0.5 and (scores[1:] >= 0.5).all()


def test_windows_cover_all_words():
    for n in (0, 1, 31, 32, 33, 55, 56, 57, 500):
        w = X.windows(np.arange(1, n + 1, dtype=np.int32))
        assert set(w.ravel().tolist()) - {0} == set(range(1, n + 1)) and w.shape[1] == X.WINDOW


def test_a_passage_counts_at_any_offset(net):
    """The two passes against all windows of every text."""
    reader, calm = X.Reader(net), "river stone garden morning letter window bread music".split()
    texts = [" ".join((calm * 12)[:at] + ["blockhead", "calm", "numskull"][:k] + (calm * 12)[:n - at])
             for at in range(0, 60, 3) for k in (1, 3) for n in (40, 80)]
    got = X.score_texts(net, reader, texts)
    for t, s in zip(texts, got, strict=True):
        x = reader.numbers([t])[0]
        every = np.lib.stride_tricks.sliding_window_view(x, X.WINDOW) if len(x) > X.WINDOW else X.windows(x)
        odds = np.maximum(X.window_odds(net, reader.gates, every).max(), X.window_odds(net, reader.gates, X.windows(x)).max())
        best = 1 / (1 + np.exp(-float(odds)))
        assert (s >= 0.5) == (best >= 0.5) and (abs(s - best) < 1e-5 or best < 0.1)


def test_windows_at_all_offsets_are_scored():
    """Networks that were not trained give any order of windows: none may be passed over."""
    g = random.Random(5)
    for seed in range(4):
        net = X.Network(seed)
        net.p["out"] *= 20
        net.p["bias"] -= 15  # most windows, not all, far below any likely one
        reader = X.Reader(net)
        texts = [" ".join(g.choice("abcdefghijklmnop") * 3 for _ in range(n)) for n in (31, 32, 33, 61, 90, 0, 300, 47, 5000)]
        got = X.score_texts(net, reader, texts)
        for t, s in zip(texts, got, strict=True):
            x = reader.numbers([t])[0]
            odds = X.window_odds(net, reader.gates, X.windows(x)[-1:]).max()
            if len(x) > X.WINDOW:
                every = np.lib.stride_tricks.sliding_window_view(x, X.WINDOW)
                odds = max(odds, X.window_odds(net, reader.gates, every).max())
            assert s == pytest.approx(1 / (1 + np.exp(-float(odds))), rel=1e-3)


def test_second_pass_windows():
    x = np.arange(1, 201, dtype=np.int32)
    for near in ([], [0], [3], [0, 1, 7], [7]):
        starts = {int(w[0]) - 1 for w in X.between(x, np.array(near, np.int64))}
        want = {s for s in range(169) if s % X.STRIDE and any(abs(s - k * X.STRIDE) < X.STRIDE for k in near)}
        assert starts == want
    assert len(X.between(x[:32], np.array([0]))) == 0
    for offset in (0, 5, 23):
        assert set(X.windows(x, offset).ravel().tolist()) - {0} == set(range(1, 201))


def test_labels_without_usable_documents_take_no_place(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus[:60]] + [(1000 + i, "x" * 30000) for i in range(40)],
                                 "doc_id long, text string")
    lab = spark.createDataFrame([(i, y) for i, _, y in corpus[:60]] + [(1000 + i, i % 2) for i in range(40)]
                                + [(9000 + i, i % 2) for i in range(400)], "doc_id long, toxic int")
    assert X.fit(docs, lab, sample=5) is not None


def test_scores_and_filter_of_odd_rows(net, odd_docs, no_docs):
    got = X.score(odd_docs, net).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (0, 1, 2)}
    assert len(empty) == 1
    kept = X.keep_clean(odd_docs, net)
    assert kept.schema == odd_docs.schema and kept.count() == sum(r["score"] < 0.5 for r in got)
    assert X.score(no_docs, net).collect() == []
    assert {r["score"] for r in X.score(odd_docs, None).collect()} == {0.0}


def test_labels_of_held_out_rows_are_not_read(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus[:200]], "doc_id long, text string")
    lab = spark.createDataFrame([(i, y) for i, _, y in corpus[:200]] + [(3, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    wrong = lab.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(tuple(r) for r in X.toxicity(docs, x).collect()) for x in (lab, wrong))
    assert a == b
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) and p == (s >= 0.5) for d, h, s, p in a)
    assert X.fit(docs, lab.where("toxic = 0")) is None


@pytest.mark.filterwarnings("error")
def test_all_offsets_need_no_tanh_and_bear_extreme_sums(net, monkeypatch):
    g = np.random.default_rng(5)
    for scale in (1, 30, 1000):
        gates = net.halves((g.standard_normal((50, 6 * X.HIDDEN)) * scale).astype(np.float32))
        numbers = g.integers(1, 50, 300)
        want = X.window_odds(net, gates, np.lib.stride_tricks.sliding_window_view(numbers, X.WINDOW))
        with monkeypatch.context() as m:
            m.setattr(X.np, "tanh", None)
            odds = net.every(gates, numbers)
        assert np.allclose(odds, want, rtol=1e-3, atol=1e-3)


def test_steps_take_no_exp(net, monkeypatch):
    """Only the attention weights do, once a word and window; a step's gates take exp2."""
    g, taken, exp = np.random.default_rng(6), [], np.exp
    gates = net.halves(g.standard_normal((50, 6 * X.HIDDEN)).astype(np.float32))
    monkeypatch.setattr(X.np, "exp", lambda x, *a, **k: taken.append(np.size(x)) or exp(x, *a, **k))
    odds = net.every(gates, g.integers(1, 50, 7000))
    assert sum(taken) <= X.WINDOW * len(odds)


def test_words_are_those_of_split(net):
    """White space of any kind, at ends and repeated; words keep their numbers from block to block."""
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    texts = ["a" + s + "b" for s in map(chr, range(0x3100))] + ["", " ", "".join(spaces), " a  b ", "\n\x1fa\u3000\t", "中 é\x85😀 a"]
    reader = X.Reader(net)
    for part in (texts, [], [""], texts[::-1]):
        got = reader.numbers(part)
        assert len(got) == len(part) and all(x.dtype == np.int32 for x in got)
        word = {n: w for w, n in reader.number.items()}
        assert [[word[n] for n in x.tolist()] for x in got] == [t.split() for t in part]

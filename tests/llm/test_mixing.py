import itertools
import random
from collections import defaultdict

import pytest

from fleetdw.llm import mixing


def reshare(sizes, share=1.5, most=2, weights=(5.0, 2.0, 1.0)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    rest, target, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        level = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if level[s] > most * sizes[s]}
        if not full:
            return target | level
        for s in full:
            target[s] = most * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def test_targets_and_taken_words(documents):
    got = {r["doc_id"]: r for r in mixing.mix(documents).collect()}
    src = {r["doc_id"]: (r["source"], len(r["text"].encode().split())) for r in documents.collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for d, (s, n) in src.items():
        assert got[d]["size"] == n and got[d]["taken"] in (0, n, 2 * n)
        sizes[s] += n
        taken[s] += got[d]["taken"]
    want = reshare(sizes)
    for d, (s, _) in src.items():
        assert got[d]["source_size"] == sizes[s] and got[d]["target"] == pytest.approx(want[s])
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(documents.repartition(7)).collect()}
    assert again == {d: r["taken"] for d, r in got.items()}
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 0.05 * sum(sizes.values())
    for s in sizes:  # every source comes near its own target: only whole documents are taken
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], *(n for x, n in src.values() if x == s)), s


def test_odd_rows(odd_docs, no_docs, spark):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert sorted(r["size"] for r in got) == sorted(len((r["text"] or "").encode().split()) for r in odd_docs.collect())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mix(no_docs).collect() == [] and mixing.mixed(no_docs).collect() == []
    copies = spark.range(3000).selectExpr("id", "1 AS doc_id", "'one two three' AS text", "if(id < 1000, 'a', 'b') AS source")
    total = defaultdict(int)
    for r in mixing.mix(copies).collect():
        total[r["source_size"], r["target"]] += r["taken"]
    assert all(abs(n - t) <= 3 for (_, t), n in total.items())


def test_mixed_rows_agree_with_the_decisions(documents):
    want = {r["doc_id"]: r["taken"] // max(1, r["size"]) for r in mixing.mix(documents).collect()}
    n = defaultdict(int)
    for r in mixing.mixed(documents).select("doc_id").collect():
        n[r["doc_id"]] += 1
    assert dict(n) == {d: k for d, k in want.items() if k}


def test_flow_repeats_only_when_it_must():
    flow = mixing.cheapest_flow({"p": 10.0, "q": 10.0, "r": 5.0}, {"a": 12.0, "b": 10.0}, [("p", "a"), ("q", "a"), ("q", "b"), ("r", "b")], 2)
    assert sum(v for (p, s), v in flow.items() if s == "a") == pytest.approx(12)
    assert sum(v for (p, s), v in flow.items() if s == "b") == pytest.approx(10)
    assert all(sum(v for (p, _), v in flow.items() if p == x) <= c + 1e-6 for x, c in (("p", 10), ("q", 10), ("r", 5)))
    flow = mixing.cheapest_flow({"p": 10.0}, {"a": 30.0}, [("p", "a")], 2)
    assert flow["p", "a"] == pytest.approx(20)


def test_flow_against_every_integer_flow():
    """Most words first, then fewest repeated ones, over all flows of small problems."""
    g = random.Random(5)
    for _ in range(60):
        cap = {p: g.randint(0, 3) for p in "pqr"[:g.randint(1, 3)]}
        quota = {s: g.randint(0, 5) for s in "ab"[:g.randint(1, 2)]}
        arcs = [(p, s) for p in cap for s in quota if g.random() < .75][:4]
        best = (0, 0)
        for f in itertools.product(*[range(min(2 * cap[p], quota[s]) + 1) for p, s in arcs]):
            sent = {p: sum(v for v, (q, _) in zip(f, arcs) if q == p) for p in cap}
            got = {s: sum(v for v, (_, t) in zip(f, arcs) if t == s) for s in quota}
            if all(sent[p] <= 2 * cap[p] for p in cap) and all(got[s] <= quota[s] for s in quota):
                best = max(best, (sum(f), -sum(max(0, sent[p] - cap[p]) for p in cap)))
        flow = mixing.cheapest_flow({p: float(c) for p, c in cap.items()}, {s: float(q) for s, q in quota.items()}, arcs, 2)
        sent = {p: sum(v for (q, _), v in flow.items() if q == p) for p in cap}
        assert all(v >= -1e-9 for v in flow.values()) and all(sent[p] <= 2 * cap[p] + 1e-9 for p in cap)
        assert all(sum(v for (_, t), v in flow.items() if t == s) <= quota[s] + 1e-9 for s in quota)
        assert (sum(flow.values()), -sum(max(0, sent[p] - cap[p]) for p in cap)) == pytest.approx(best)


def test_overlapping_sources(spark):
    rows = [(i, ["=a"] if i % 3 == 0 else ["=b", "=a"] if i % 3 == 1 else ["=b"], 10) for i in range(300)]
    decisions, goals = mixing.decide(spark.createDataFrame(rows, "doc_id long, sources array<string>, size long"))
    taken = sum(r["size"] * (r["n"] * r["whole"] + r["extra"]) for r in decisions.collect())
    want = {r["source"]: r["target"] for r in goals.collect()}
    assert abs(taken - sum(want.values())) < 40 and set(want) == {"=a", "=b"}

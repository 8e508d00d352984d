import hashlib
import random
import time
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fleetdw.llm import periodic as P


def brute(words, least=24, times=3):
    """Every period on its own: all maximal stretches, without those that have a smaller period."""
    n, out = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, times * q) and not any(
                    all(words[k] == words[k + e] for k in range(start, start + length - e)) for e in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def altered(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = altered(doc_id, [w.decode() for w in (text or "").encode().split()])
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_made_texts_against_brute_force():
    g, found = random.Random(4), 0
    for _ in range(1200):
        texts = []
        for _ in range(g.randint(1, 4)):
            words = []
            for _ in range(g.randint(0, 5)):
                base = [g.choice("ab" if g.random() < .6 else "abcde") for _ in range(g.randint(1, 6))]
                part = base * g.randint(1, 8)
                words += part[:len(part) - g.randint(0, len(base) - 1)]
            texts.append(" ".join(words))
        least, times = g.choice([(24, 3), (2, 2), (6, 3), (8, 2), (5, 4)])
        want = [brute(t.split(), least, times) for t in texts]
        assert [r for _, r in P.find_in_texts(texts, least, times)] == [[tuple(x) for x in w] for w in want]
        found += sum(map(len, want))
    assert found > 5000


def test_positions_stay_ordered_across_chunks(monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 2)
    g = random.Random(5)
    xs = g.sample(range(10000), 400)
    held, seen = P.Positions(xs[0]), [xs[0]]
    for x in xs[1:]:
        below, above = [y for y in seen if y < x], [y for y in seen if y > x]
        assert held.insert(x) == (max(below, default=None), min(above, default=None))
        seen.append(x)
    assert [x for c in held.chunks for x in c] == sorted(xs) and max(map(len, held.chunks)) <= 4


@pytest.mark.parametrize("text, runs", [
    ("word " * 200000, [(0, 200000, 1)]),
    ("a " * 50000 + "x " + "a " * 50000, [(0, 50000, 1), (50001, 50000, 1)]),
    (" ".join("x" if i % 101 == 100 else "a" for i in range(50500)), None)])
def test_long_texts_take_no_quadratic_time(text, runs):
    begin = time.time()
    got = [r for _, r in P.find_in_texts([text])][0]
    assert time.time() - begin < 60
    if runs is None:
        assert (0, 50500, 101) in got and len(got) == 1 + 500
    else:
        assert got == runs


def test_documents_against_brute_force(documents):
    rows = documents.where(F.length("text") < 8000).select("doc_id", "text")  # brute force is cubic
    want = sorted(expected(*r) for r in rows.collect())
    assert sum(w[1] > 0 for w in want) >= 5
    assert sorted(tuple(r) for r in P.scan(rows).collect()) == want


def test_odd_rows_and_no_rows(odd_docs, no_docs):
    clash = odd_docs.withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("x")).withColumn("best", F.lit(2))
    got = sorted((tuple(r) for r in P.scan(clash).collect()), key=str)
    short = [r for r in odd_docs.select("doc_id", "text").collect() if len((r["text"] or "").split()) < 3000]
    want = sorted((expected(*r) for r in short), key=str)
    rest = [r for r in got if r not in want]
    assert [r for r in got if r in want] == want and len(rest) == 1
    assert rest[0][:6] == (4, 1, 0, 3000, 1, 3000000)  # "word" 3000 times
    assert P.scan(no_docs).collect() == []


def test_every_tenth_document_repeats(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(i % 60))) for i in range(400)] + [(None, "a b c"), (10, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in df.select("doc_id", P.repeating(F.col("text"), F.col("doc_id"))).collect()}
    want = set()
    for i, t in rows:
        words = (t or "").split()
        want.add((i, t if altered(i, words) == words else " ".join(altered(i, words))))
    assert got == want and got != set(rows)

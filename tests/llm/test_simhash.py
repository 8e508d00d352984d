import random

import pytest
import xxhash

from fleetdw.llm import simhash
from fleetdw.llm.components import connected_components


def slow_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, bits=3):
    fp = [slow_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, f"{fp[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def test_documents_against_brute_force(documents, odd_docs, no_docs):
    for df in (documents, odd_docs):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        assert sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=str) == brute(rows)
    assert simhash.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("bits", [0, 1, 3, 6])
def test_links_are_all_pairs_within_the_distance(spark, bits):
    g = random.Random(bits)
    fps = set()
    for _ in range(12):  # clusters around a centre
        c = g.getrandbits(64)
        for _ in range(12):
            x = c
            for b in g.sample(range(64), g.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, (1 << 64) - 1, 1 << 63}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), bits).collect()
    pairs = [tuple(sorted((r["a"] % (1 << 64), r["b"] % (1 << 64)))) for r in got]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= bits}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (None, 1), (300, 301), (301, 300)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 300: 300, 301: 300}

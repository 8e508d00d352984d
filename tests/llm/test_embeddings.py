import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetdw.llm import ann, embed_dedup

NAN, INF = float("nan"), float("inf")


def odd_vectors(spark):
    rows = [(1, [1.0, 0.0], 1, 0), (2, [2.0, 0.0], 1, 0), (3, [1.0, 0.1], 1, 0), (4, [1.0, 0.0], 2, 0), (5, None, 1, 0),
            (6, [], 1, 0), (7, [0.0, 0.0], 1, 0), (8, [NAN, 1.0], 1, 0), (9, [INF, 1.0], 1, 0), (10, [None, 1.0], 1, 0),
            (11, [1.0, 0.0], None, 0), (12, [1.0, 0.0], 1, 0), (13, [1.0, 0.0, 0.0], 1, 0), (None, [1.0, 0.0], 1, 0),
            (20, [1.0, 0.0], 1, 0), (20, [1.0, 0.0], 1, 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept int")


def test_near_duplicates_with_odd_vectors(spark):
    got = sorted((tuple(r) for r in embed_dedup.near_duplicates(odd_vectors(spark)).collect()), key=str)
    one = {1, 2, 3, 12, 20}  # three of them the same vector, and 20 twice
    want = [(v, 5, 1, v == 1) for v in (1, 2, 3, 12, 20, 20)]
    want += [(v, 0, v, True) for v in (4, 5, 6, 7, 8, 9, 10, 11, 13)] + [(None, 0, None, True)]
    assert got == sorted(want, key=str) and len(one) == 5
    assert embed_dedup.near_duplicates(odd_vectors(spark).where("1 = 0")).collect() == []


@pytest.mark.parametrize("threshold", [0.98, 0.9, 0.8])
def test_near_duplicates_against_brute_force(spark, monkeypatch, threshold):
    monkeypatch.setattr(embed_dedup, "BLOCK", 32)  # blocks meet
    g = np.random.default_rng(4)
    centre = g.standard_normal((12, 24))
    vecs = (centre[g.integers(0, 12, 400)] + g.standard_normal((400, 24)) * g.choice([0.02, 0.12, 0.3], (400, 1))).astype(np.float32)
    vecs[50:70] = vecs[49]
    label = g.integers(0, 2, 400)
    df = spark.createDataFrame([(i, vecs[i].tolist(), int(label[i])) for i in range(400)],
                               "vec_id long, embedding array<float>, label int")
    u = embed_dedup.unit(vecs)
    links = (u @ u.T >= threshold) & (label[:, None] == label[None, :]) & ~np.eye(400, dtype=bool)
    root = embed_dedup.forest(links)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in embed_dedup.near_duplicates(df, threshold=threshold).collect()}
    assert got == {i: (int(links[i].sum()), int(root[i]), bool(root[i] == i)) for i in range(400)}


def test_tables_follow_the_threshold():
    assert embed_dedup.tables_for(0.98) == (16, 32)
    g = np.random.default_rng(2)
    for t in (0.98, 0.9, 0.8, 0.5):
        bits, tables = embed_dedup.tables_for(t)
        p = 1 - np.arccos(t) / np.pi
        assert tables <= embed_dedup.MOST_TABLES and (1 - p ** bits) ** tables <= embed_dedup.MISS
        # pairs at the threshold meet in a table
        a = embed_dedup.unit(g.standard_normal((400, 32)))
        b = embed_dedup.unit(g.standard_normal((400, 32)))
        b = embed_dedup.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
        b = t * a + np.sqrt(1 - t * t) * b
        met = (embed_dedup.signatures(a, bits, tables) == embed_dedup.signatures(b, bits, tables)).any(axis=1)
        assert met.mean() >= 0.99


def test_codes_dismiss_no_pair_at_the_threshold():
    g = np.random.default_rng(3)
    for d in (2, 8, 33, 64):
        a = embed_dedup.unit(g.standard_normal((300, d)))
        b = embed_dedup.unit(a + g.choice([0, 0.1, 0.2, 9], (300, 1)) * g.standard_normal((300, d)) / np.sqrt(d))
        cos = (a * b).sum(axis=1)

        def table(units):
            c = embed_dedup.coded(units)
            return embed_dedup.Codes(pd.DataFrame({k: [x.tobytes() for x in v] if v.ndim == 2 else v for k, v in c.items()}), d)

        x, y = table(a), table(b)
        seen = (x.corner * y.turned).sum(axis=1)
        keep = embed_dedup.undecided(seen, y.rest, x.factor, d, 0.98)
        assert keep[cos >= 0.98].all()
        assert d < 64 or keep[cos < 0.5].mean() < 0.05


def test_code_table_holds_bits_and_factor(spark):
    vecs = np.random.default_rng(5).standard_normal((20, 16))
    reps = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "rep long, vec array<double>")
    rows = {r["rep"]: r for r in embed_dedup.code_table(reps, 0.98).collect()}
    units = embed_dedup.unit(vecs)
    turned = units @ embed_dedup.turns_of(16, 1)[0].T
    for i, r in rows.items():
        assert len(r["bits"]) == 2 and len(r["turned"]) == 16 and len(r["keys"]) == 32
        corner = np.where(turned[i] >= 0, 1, -1) / 4
        assert abs(r["factor"] - corner @ turned[i]) < 1e-12
        assert np.linalg.norm(turned[i] - np.frombuffer(r["turned"], np.int8) * r["scale"]) <= r["rest"] + 1e-12


def test_estimates_are_unbiased():
    g = np.random.default_rng(0)
    a, b = embed_dedup.unit(g.standard_normal((2, 1, 64)).reshape(2, 64))
    est = []
    for turn in embed_dedup.rotations(64, 600, seed=9):
        code = np.sign(turn @ a) / 8
        est.append(code @ (turn @ b) / (code @ (turn @ a)))
    assert abs(np.mean(est) - a @ b) < 4 * np.std(est) / np.sqrt(len(est))


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (5, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = ann.hilbert(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def exact(ids, vecs, query, k):
    out = []
    for i in np.flatnonzero(query):
        s = (vecs * vecs[i]).sum(axis=1)
        s[ids == ids[i]] = -np.inf
        order = [j for j in np.lexsort((ids, -s))[:k] if s[j] > -np.inf]
        out += [(int(ids[i]), r + 1, int(ids[j]), float(s[j])) for r, j in enumerate(order)]
    return out


def test_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP", 100)
    monkeypatch.setattr(ann, "QUERIES", 10)
    g = np.random.default_rng(6)
    vecs = (g.standard_normal((700, 12)) * g.uniform(0.1, 3, (700, 1))).astype(np.float32)
    vecs[100:180] = vecs[99]  # ties
    ids = np.arange(700)
    df = spark.createDataFrame([(i, vecs[i].tolist(), 0) for i in range(700)], "vec_id long, embedding array<float>, score int")
    for k in (5, 1000):
        got = ann.search(df, F.col("vec_id") % 20 == 0, k).collect()
        want = exact(ids, vecs.astype(np.float64), ids % 20 == 0, k)
        assert sorted(tuple(r)[:3] for r in got) == [w[:3] for w in want]
        assert np.allclose([r["score"] for r in sorted(got, key=lambda r: (r["query_id"], r["rank"]))], [w[3] for w in want])


def test_search_is_exact_at_any_scale(spark, monkeypatch):
    """Products of 1e8 and more, whose rounding an absolute slack would miss, with ties."""
    monkeypatch.setattr(ann, "GROUP", 50)
    g = np.random.default_rng(8)
    for scale in (1e-6, 1e5):
        vecs = (g.standard_normal((300, 40)) * scale).astype(np.float32)
        vecs[40:90] = vecs[g.integers(0, 40, 50)]
        df = spark.createDataFrame([(i, vecs[i].tolist()) for i in range(300)], "vec_id long, embedding array<float>")
        got = sorted(((r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(df, F.col("vec_id") % 20 == 0, 7).collect()))
        want = []
        v = vecs.astype(np.float64)
        for i in range(0, 300, 20):
            s = np.array([sum(a * b for a, b in zip(v[i].tolist(), x)) for x in v.tolist()])
            s[i] = -np.inf
            want += [(i, r + 1, int(j)) for r, j in enumerate(np.lexsort((np.arange(300), -s))[:7])]
        assert got == want


def test_queries_visit_few_groups_of_clustered_vectors(spark):
    g = np.random.default_rng(9)
    centre = g.standard_normal((16, 12)) * 10
    vecs = (centre[np.repeat(np.arange(16), 60)] + 0.1 * g.standard_normal((960, 12))).astype(np.float32)
    rows = [(i, vecs[i].astype(float).tolist(), 12, i, i // 60) for i in range(960)]
    grouped = spark.createDataFrame(rows, "vec_id long, vec array<double>, d int, key long, group int")
    floor = [float(np.sort(vecs.astype(np.float64) @ vecs[i].astype(np.float64))[-21]) for i in range(0, 960, 20)]
    asked = spark.createDataFrame([(i, rows[i][1], 12, f, 0) for i, f in zip(range(0, 960, 20), floor, strict=True)],
                                  "vec_id long, vec array<double>, d int, floor double, chunk int")
    largest = float(np.sqrt((vecs.astype(np.float64) ** 2).sum(axis=1).max()))
    pairs = {tuple(r) for r in ann.visited(asked, grouped, 1, 16, largest).collect()}
    assert len(pairs) < 48 * 16 / 4
    for i, f in zip(range(0, 960, 20), floor, strict=True):  # none that holds a row of the answer is left out
        s = vecs.astype(np.float64) @ vecs[i].astype(np.float64)
        assert {(i, int(j) // 60) for j in np.flatnonzero(s >= f)} <= pairs


def test_search_with_odd_vectors(spark):
    df = odd_vectors(spark)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, 3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(v) for q, v in got.items()} == {20: [(1, 2, 2.0), (2, 1, 1.0), (3, 3, 1.0)]}
    assert ann.search(df.where("1 = 0"), F.col("vec_id") % 20 == 0, 3).collect() == []

"""Nearest neighbours by shifted space-filling curves (operator 7).

The nearest vectors of a query are those of the largest inner product. A coordinate
sqrt(M^2 - |x|^2), M the largest norm, makes that the smallest distance, and keeps it in
reach of curves:

1. ``CURVES`` times, the vectors are projected to ``DIMS`` random directions, shifted,
   cut to cells and numbered along a Hilbert curve. Spark range-partitions all rows by
   (curve, key) and sorts them; a query meets the ``WINDOW`` rows before and after it on
   every curve. The merged, reranked windows give each query a first answer.
2. *Widening.* On vectors without clusters a fixed window is no bound for recall, so the
   windows go on along the first curve as far as they may hold something better: the
   rows in curve order form groups of about ``GROUP`` with a centre c and a radius r. A
   query visits a group if q.c + |q| r reaches its k-th score so far; that is decided on a
   table of one row a group, before any row of a group moves, and a group is copied once per
   ``QUERIES`` queries that visit it. In a group the same test leaves out blocks of ``BLOCK`` rows.
   Nothing that belongs to the answer can lie in another block, so recall is 1; what the
   curves save is what is left out.
3. Scores are taken on the original vectors in double precision, always summed from the first
   component to the last, so that copies tie; ties go to the smaller id. Until then scores that
   differ by less than ``SLACK`` of the largest product possible count as equal.

Cases: vectors that are null, empty, zero or hold null or non-finite components, or of
another length than the query, and rows without id take no part, neither as queries nor as
candidates; a query of fewer candidates returns them all; rows that repeat an id are
candidates each, and a query's own id is never among its candidates; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetdw.llm.common import materialise, ship_package
from fleetdw.llm.embed_dedup import usable

CURVES, DIMS, BITS, WINDOW = 4, 7, 9, 64
GROUP, BLOCK, QUERIES, STRIP, CENTRES = 4096, 256, 2048, 256, 2048
SEED = 5
SLACK = 1e-12  # well above the rounding of a sum of products, relative to |q| and the largest norm


@lru_cache(maxsize=64)
def directions(d: int, curve: int) -> tuple[np.ndarray, np.ndarray]:
    """Projection (d + 1 to DIMS) and shift of a curve."""
    g = np.random.default_rng([SEED, d, curve])
    q, _ = np.linalg.qr(g.standard_normal((d + 1, min(DIMS, d + 1))))
    return q, g.random(q.shape[1])


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions of integer cells (rows) along the Hilbert curve of ``bits`` bits a dimension."""
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    for b in range(bits - 1, 0, -1):  # undo the turns of the larger cubes, level by level
        low = (1 << b) - 1
        for i in range(n):
            up = (x[i] >> b & 1).astype(bool)
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ flip) >> b & 1)
    return key


def keys(vecs: np.ndarray, largest: float, curve: int) -> np.ndarray:
    """Hilbert keys of vectors on one curve."""
    d = vecs.shape[1]
    v = vecs / largest
    rest = np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1)))
    project, shift = directions(d, curve)
    p = np.hstack([v, rest[:, None]]) @ project
    p = (np.clip(p * np.sqrt(d) / 3, -1, 1) + 1) / 4 + shift / 2  # 0 to 1, wherever the shift puts it
    return hilbert(np.minimum((p * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def score(vecs: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed from the first component to the last."""
    return np.cumsum(vecs * query, axis=1)[:, -1]


def slack(queries: np.ndarray, largest: float) -> np.ndarray:
    """Per query: differences of scores up to this may be rounding."""
    return SLACK * (1 + queries.shape[1] / 1000) * np.sqrt((queries * queries).sum(axis=1)) * largest


def best(scores: np.ndarray, queries: np.ndarray, vecs: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int,
         floor: np.ndarray, largest: float) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per query row: its ``k`` best candidates at or above ``floor``, canonically scored."""
    out, margin = [], 2 * slack(queries, largest)
    for row in range(len(scores)):
        s = np.where(ids == own[row], -np.inf, scores[row])
        cut = max(floor[row], np.partition(s, -k)[-k] if len(s) > k else -np.inf) - margin[row]
        at = np.flatnonzero((s >= cut) & (s > -np.inf))
        if len(at):
            exact = score(vecs[at], queries[row])
            order = np.lexsort((ids[at], -exact))[:k]
            out.append((row, ids[at][order], exact[order]))
    return out


def _frame(found: list) -> pd.DataFrame:
    if not found:
        return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                             "score": pd.Series(dtype="float64")})
    q, v, s = (np.concatenate(x) for x in zip(*found, strict=True))
    return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})


def _windows(k: int, largest: float):
    """Sorted rows of some curves in, the best of every query's window out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for pdf in batches:
            pdf["fresh"] = True
            if tail is not None:
                pdf = pd.concat([tail, pdf], ignore_index=True)
            tail = pdf.iloc[-2 * WINDOW:].assign(fresh=False) if len(pdf) else tail
            found = []
            for _, seg in pdf.groupby(["d", "curve"], sort=False):
                vecs, ids = np.stack(seg["vec"].to_numpy()).astype(np.float64), seg["vec_id"].to_numpy()
                # a query in the last rows of a batch meets its window's end when those rows return
                for i in np.flatnonzero(seg["is_query"].to_numpy()):
                    lo, hi = max(0, i - WINDOW), min(len(seg), i + WINDOW + 1)
                    if not seg["fresh"].iloc[lo:hi].any():
                        continue
                    for _, v, s in best((vecs[lo:hi] @ vecs[i])[None], vecs[i:i + 1], vecs[lo:hi], ids[i:i + 1],
                                        ids[lo:hi], k, np.array([-np.inf]), largest):
                        found.append((np.full(len(v), ids[i]), v, s))
            yield _frame(found)

    return run


def ball(vecs: np.ndarray) -> tuple[np.ndarray, float]:
    """A centre and a radius that hold all rows."""
    c = vecs.mean(axis=0)
    return c, float(np.sqrt(((vecs - c) ** 2).sum(axis=1).max()))


def _centre(rows: pd.DataFrame) -> pd.DataFrame:
    """One group's centre and radius."""
    c, r = ball(np.stack(rows["vec"].to_numpy()).astype(np.float64))
    return pd.DataFrame({"group": [rows["group"].iloc[0]], "d": [rows["d"].iloc[0]], "centre": [c], "radius": [r]})


def _visits(largest: float):
    """Queries with their scores so far, and the centres of groups: who visits which."""

    def run(queries: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(groups):
            centre, radius = np.stack(groups["centre"].to_numpy()), groups["radius"].to_numpy()
            q_all, floor = np.stack(queries["vec"].to_numpy()).astype(np.float64), queries["floor"].to_numpy()
            ids, names = queries["vec_id"].to_numpy(), groups["group"].to_numpy()
            for lo in range(0, len(q_all), STRIP):
                x, y = np.nonzero(reached(q_all[lo:lo + STRIP], floor[lo:lo + STRIP], centre, radius, largest))
                found.append((ids[lo + x], names[y]))
        ids, names = (np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        return pd.DataFrame({"vec_id": ids, "group": names.astype(np.int32)})

    return run


def reached(q: np.ndarray, floor: np.ndarray, centre: np.ndarray, radius: np.ndarray, largest: float) -> np.ndarray:
    """Which balls may hold a row that scores at least ``floor`` (queries by balls)."""
    reach = q @ centre.T + np.sqrt((q * q).sum(axis=1))[:, None] * radius
    return reach >= (floor - 4 * slack(q, largest))[:, None]


def _widen(k: int, largest: float):
    """Queries with their scores so far, and a group of rows in curve order."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            rows = rows.sort_values(["key", "vec_id"], kind="stable")
            vecs, ids = np.stack(rows["vec"].to_numpy()).astype(np.float64), rows["vec_id"].to_numpy()
            balls = [ball(vecs[a:a + BLOCK]) for a in range(0, len(vecs), BLOCK)]
            centre, radius = np.stack([c for c, _ in balls]), np.array([r for _, r in balls])
            q_all, own = np.stack(queries["vec"].to_numpy()).astype(np.float64), queries["vec_id"].to_numpy()
            floor = queries["floor"].to_numpy()
            for lo in range(0, len(q_all), STRIP):
                q, f = q_all[lo:lo + STRIP], floor[lo:lo + STRIP]
                blocks = np.flatnonzero(reached(q, f, centre, radius, largest).any(axis=0))
                if not len(blocks):
                    continue
                at = np.concatenate([np.arange(b * BLOCK, min(len(vecs), (b + 1) * BLOCK)) for b in blocks])
                near, near_ids = vecs[at], ids[at]
                for row, v, s in best(q @ near.T, q, near, own[lo:lo + STRIP], near_ids, k, f, largest):
                    found.append((np.full(len(v), own[lo + row]), v, s))
        return _frame(found)

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           widen: bool = True) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of every row with ``is_query``.
    With ``widen=False`` only the curves' windows answer."""
    spark = df.sparkSession
    ship_package(spark)
    rows = (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"),
                      is_query.alias("is_query")).where(F.col("vec_id").isNotNull() & usable(F.col("vec"))))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    n, n_queries, largest = rows.agg(F.count(F.lit(1)), F.count_if("is_query"), F.max(norm)).first()
    groups, chunks = max(1, -(-n // GROUP)), max(1, -(-n_queries // QUERIES))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for d, part in pdf.groupby(pdf["vec"].map(len)):
                vecs = np.stack(part["vec"].to_numpy())
                for c in range(CURVES):
                    yield part.assign(d=d, curve=c, key=keys(vecs, largest, c))

    schema = "vec_id long, vec array<double>, is_query boolean, d int, curve int, key long"
    placed = materialise(rows.mapInPandas(keyed, schema), "curves")
    order = ["d", "curve", "key", "vec_id"]
    parts = max(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = (placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .mapInPandas(_windows(k, largest or 1.0), "query_id long, vec_id long, score double"))
    first = materialise(_top(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k), "curve-windows")
    if not widen:
        return first.select("query_id", "rank", "vec_id", "score")
    floors = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score"))
                                           .otherwise(float("-inf")).alias("floor"))
    base = placed.where("curve = 0")
    # one query per id: rows that repeat an id would ask twice
    asked = materialise(
        base.where("is_query").groupBy("vec_id").agg(F.min("vec").alias("vec"), F.first("d").alias("d"))
        .join(floors, F.col("vec_id") == F.col("query_id"), "left")
        .select("vec_id", "vec", "d", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"),
                F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk")), "curve-queries")
    grouped = materialise(base.repartitionByRange(groups, "d", "key", "vec_id").select(
        "vec_id", "vec", "key", "d", F.pmod(F.spark_partition_id(), F.lit(groups)).alias("group")), "curve-groups")
    visits = materialise(visited(asked, grouped, chunks, groups, largest or 1.0), "curve-visits")
    by = ["chunk", "group", "d"]
    coming = visits.join(asked, "vec_id")
    # renamed: both sides of the cogroup come from ``coming``
    pairs = coming.select(*[F.col(c).alias(f"_{c}") for c in by]).distinct()
    against = grouped.join(pairs, (F.col("group") == F.col("_group")) & (F.col("d") == F.col("_d"))).select(
        F.col("_chunk").alias("chunk"), "group", "d", "vec_id", "vec", "key")
    more = coming.groupBy(*by).cogroup(against.groupBy(*by)).applyInPandas(
        _widen(k, largest or 1.0), "query_id long, vec_id long, score double")
    return _top(more, k).select("query_id", "rank", "vec_id", "score")


def visited(asked: DataFrame, grouped: DataFrame, chunks: int, groups: int, largest: float) -> DataFrame:
    """(vec_id, group): the groups whose ball a query's score so far does not exclude. Queries and
    centres meet in blocks: a query is copied once per ``CENTRES`` groups, a centre once per
    ``QUERIES`` queries."""
    strips = -(-groups // CENTRES)
    centres = materialise(grouped.groupBy("group", "d").applyInPandas(
        _centre, "group int, d int, centre array<double>, radius double"), "curve-centres")
    left = asked.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    right = (centres.withColumn("strip", F.pmod("group", F.lit(strips)))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    by = ["chunk", "strip", "d"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(_visits(largest), "vec_id long, group int")

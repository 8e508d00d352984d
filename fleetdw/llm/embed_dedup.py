"""Embedding near-duplicates by randomised-rotation binary codes (operator 4).

Vectors of one label link when their cosine is at least ``threshold``.

1. Exact copies collapse to one representative with a count.
2. Each unit vector o is turned by a random rotation; the signs of the turned vector are
   its binary code, a corner x of the unit cube's scaled corners. For any vector q,
   <x, q> / <x, o> estimates <o, q> without bias, with a standard error of at most
   sqrt((1 - f^2) / (f^2 (d - 1))) for the correction factor f = <x, o>. The table of codes holds,
   once a vector: the code's bits, the factor, and the turned vector in one byte a
   component with its scale and the length of what that leaves out.
3. Slices of the codes of further rotations are the keys of hash tables. Two vectors at the
   threshold share a key with probability 1 - (1 - p^bits)^tables, p = 1 - arccos(threshold) / pi;
   :func:`tables_for` takes as many tables as ``MISS`` asks for (at 0.98: 32 of 16 bits).
   Buckets of one member are dropped before anything else moves.
4. Codes, not vectors, go to the buckets. There a pair is dismissed when the estimate plus
   ``SIGMAS`` standard errors stays below the threshold, and so does the bound that the code
   and the factor give for certain (Cauchy-Schwarz on what the code leaves out); what the
   bytes leave out counts in both. Only members of pairs that stay open fetch their vectors and are
   recomputed exactly, in double precision. A pair counts in the first table that brings it together.
5. Buckets of more than ``BLOCK`` members are dealt to blocks, and a task compares two
   blocks. A task returns members, then link counts and a spanning forest, never all pairs.

Cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
without label or id, link with nothing and are a component of their own; vectors of
different length do not link; repeated rows are copies of one another; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetdw.llm.common import join_by_key, materialise, ship_package, shuffle_partitions
from fleetdw.llm.components import connected_components

MISS = 1.2e-6
MOST_BITS, MOST_TABLES = 16, 64
SIGMAS = 6.0
BLOCK = 512
SMALL = 32
SEED = 11


def usable(vec: Column) -> Column:
    """Finite, non-null components, not all of them zero."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def rotations(d: int, n: int, seed: int = SEED) -> np.ndarray:
    """``n`` random rotations of d dimensions."""
    g = np.random.default_rng([seed, d])
    out = []
    for _ in range(n):
        q, r = np.linalg.qr(g.standard_normal((d, d)))
        out.append(q * np.sign(np.diag(r)))
    return np.stack(out)


def unit(vecs: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision, whatever their scale."""
    v = vecs.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def tables_for(threshold: float) -> tuple[int, int]:
    """(bits a key, tables): the longest keys with which ``MOST_TABLES`` tables miss a pair at the
    threshold with probability ``MISS`` at most."""
    p = 1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi
    for bits in range(MOST_BITS, 0, -1):
        share = min(p ** bits, 1 - 1e-12)
        tables = int(np.ceil(np.log(MISS) / np.log1p(-share))) if share > 0 else MOST_TABLES + 1
        if tables <= MOST_TABLES:
            return bits, max(1, tables)
    return 1, max(1, tables)


@lru_cache(maxsize=64)
def turns_of(d: int, code_bits: int) -> np.ndarray:
    """The rotations for vectors of length d that give ``code_bits`` bits."""
    return rotations(d, -(-code_bits // d))


def signatures(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(vectors, tables) keys of ``bits`` code bits."""
    code = np.hstack([units @ t.T >= 0 for t in turns_of(units.shape[1], bits * tables)])[:, :bits * tables]
    return code.reshape(len(units), tables, bits).astype(np.int32) @ (1 << np.arange(bits, dtype=np.int32))


def coded(units: np.ndarray) -> dict[str, np.ndarray]:
    """Code bits, factor and byte form of unit vectors: bits, factor, turned, scale, rest."""
    d = units.shape[1]
    turned = units @ turns_of(d, 1)[0].T
    up = turned >= 0
    factor = np.abs(turned).sum(axis=1) / np.sqrt(d)
    scale = np.abs(turned).max(axis=1) / 127
    small = np.rint(turned / scale[:, None]).astype(np.int8)
    rest = np.sqrt(((turned - small * scale[:, None]) ** 2).sum(axis=1))
    return {"bits": np.packbits(up, axis=1), "factor": factor, "turned": small, "scale": scale, "rest": rest}


class Codes:
    """Codes of some vectors of length d, unpacked: corners, factors and approximate turned vectors."""

    def __init__(self, pdf: pd.DataFrame, d: int):
        bits = np.frombuffer(b"".join(pdf["bits"]), np.uint8).reshape(len(pdf), -1)
        self.corner = np.where(np.unpackbits(bits, axis=1, count=d), 1.0, -1.0) / np.sqrt(d)
        small = np.frombuffer(b"".join(pdf["turned"]), np.int8).reshape(len(pdf), d)
        self.turned = small * pdf["scale"].to_numpy()[:, None]
        self.factor, self.rest, self.d = pdf["factor"].to_numpy(), pdf["rest"].to_numpy(), d


def undecided(seen: np.ndarray, rest, factor, d: int, threshold: float) -> np.ndarray:
    """Neither the estimate with its margin nor the sure bound is below the threshold. ``seen``: the
    products of corners and approximate vectors, which are off by ``rest`` at most."""
    high = np.minimum(1, seen + rest)
    left_out = np.sqrt(np.maximum(0, 1 - factor ** 2))
    margin = SIGMAS * left_out / (factor * np.sqrt(max(1, d - 1)))
    sure = np.where(high >= factor, 1.0, high * factor + np.sqrt(np.maximum(0, 1 - high ** 2)) * left_out)
    return (high / factor + margin >= threshold - 1e-9) | (sure >= threshold - 1e-9)


def forest(links: np.ndarray) -> np.ndarray:
    """Component labels (smallest member) of a symmetric boolean matrix."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label, len(links)).min(axis=1, initial=len(links))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _pairs_of(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within small buckets, as row numbers."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in np.unique(sizes):
        at = starts[sizes == size][:, None]
        x, y = np.triu_indices(size, 1)
        a.append((at + x).ravel())
        b.append((at + y).ravel())
    return np.concatenate(a), np.concatenate(b)


class Open:
    """First pass, on codes: the members of pairs that stay open."""

    columns = ["bits", "factor", "turned", "scale", "rest"]

    def __init__(self, part: pd.DataFrame, d: int, threshold: float):
        self.part, self.c, self.threshold = part, Codes(part, d), threshold
        self.open = np.zeros(len(part), bool)

    def small(self, starts: np.ndarray, sizes: np.ndarray) -> None:
        a, b = _pairs_of(starts, sizes)
        c = self.c
        seen = np.einsum("ij,ij->i", c.corner[a], c.turned[b])
        maybe = undecided(seen, c.rest[b], c.factor[a], c.d, self.threshold)
        self.open[a[maybe]] = self.open[b[maybe]] = True

    def large(self, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        c, reps = self.c, self.part["rep"].to_numpy()
        for k in range(0, len(left), 128):
            rows = left[k:k + 128]
            seen = c.corner[rows] @ c.turned[right].T
            maybe = undecided(seen, c.rest[right], c.factor[rows][:, None], c.d, self.threshold)
            maybe &= reps[rows][:, None] != reps[right]
            self.open[rows[maybe.any(axis=1)]] = True
            self.open[right[maybe.any(axis=0)]] = True

    def result(self) -> pd.DataFrame:
        return self.part.loc[self.open].drop(columns=self.columns)


class Exact:
    """Second pass, on vectors: link counts and a spanning forest."""

    def __init__(self, part: pd.DataFrame, d: int, threshold: float):
        self.units, self.threshold = unit(np.stack(part["vec"].to_numpy())), threshold
        self.rep, self.n, self.table = (part[c].to_numpy() for c in ("rep", "n", "t"))
        self.keys = np.stack(part["keys"].to_numpy())
        self.out = [pd.DataFrame({c: np.zeros(0, np.int64) for c in ("rep", "root", "links")})]

    def _first(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs that no earlier table has brought together."""
        return (self.keys[a] == self.keys[b]).argmax(axis=1) == self.table[a]

    def small(self, starts: np.ndarray, sizes: np.ndarray) -> None:
        a, b = _pairs_of(starts, sizes)
        linked = np.einsum("ij,ij->i", self.units[a], self.units[b]) >= self.threshold
        a, b = a[linked], b[linked]
        first = self._first(a, b) if len(a) else np.zeros(0, bool)
        a, b = a[first], b[first]
        low = np.minimum(self.rep[a], self.rep[b])
        self.out.append(pd.DataFrame({"rep": np.r_[self.rep[a], self.rep[b]], "root": np.r_[low, low],
                                      "links": np.r_[self.n[b], self.n[a]].astype(np.int64)}))

    def large(self, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        base = at[0]
        links = np.zeros((len(at), len(at)), bool)
        for k in range(0, len(left), 128):
            rows = left[k:k + 128]
            x, y = np.nonzero((self.units[rows] @ self.units[right].T >= self.threshold)
                              & (self.rep[rows][:, None] != self.rep[right]))
            x, y = rows[x], right[y]
            if len(x):
                first = self._first(x, y)
                links[x[first] - base, y[first] - base] = True
        links |= links.T
        label = forest(links)
        linked = np.flatnonzero(links.any(axis=1))
        rep, n = self.rep[at], self.n[at]
        self.out.append(pd.DataFrame({"rep": rep[linked], "root": rep[label[linked]],
                                      "links": (links[linked] @ n).astype(np.int64)}))

    def result(self) -> pd.DataFrame:
        return pd.concat(self.out, ignore_index=True)


BUCKET = ["label", "d", "t", "key", "i", "j"]


def _buckets(work: type, threshold: float):
    """Gives the buckets of sorted rows to ``work``; a bucket may go on in the next batch."""

    def whole(pdf: pd.DataFrame) -> list[pd.DataFrame]:
        out = []
        for d, part in pdf.groupby("d", sort=False):
            part = part.reset_index(drop=True)
            keys = np.column_stack([pd.factorize(part["label"])[0], *(part[c] for c in BUCKET[1:])]).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(part)])
            little = (sizes <= SMALL) & (keys[starts, 4] == keys[starts, 5])
            job, chunk = work(part, int(d), threshold), part["chunk"].to_numpy()
            job.small(starts[little], sizes[little])
            for lo, size in zip(starts[~little], sizes[~little], strict=True):
                at = np.arange(lo, lo + size)
                job.large(at, at[chunk[at] == keys[lo, 4]], at[chunk[at] == keys[lo, 5]])
            out.append(job.result())
        return out

    def run(batches):
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            last = (pdf[BUCKET] == pdf[BUCKET].iloc[-1]).all(axis=1).to_numpy()
            open_from = len(pdf) - int(np.argmin(last[::-1])) if not last.all() else 0
            held = pdf.iloc[open_from:]
            yield from whole(pdf.iloc[:open_from]) if open_from else []
        if held is not None and len(held):
            yield from whole(held)

    return run


def _sorted(members: DataFrame) -> DataFrame:
    return (members.repartition(shuffle_partitions(members.sparkSession), *BUCKET)
            .sortWithinPartitions(*BUCKET, "rep"))


CODES = [("keys", pa.list_(pa.int32())), ("d", pa.int32()), ("bits", pa.binary()), ("factor", pa.float64()),
         ("turned", pa.binary()), ("scale", pa.float64()), ("rest", pa.float64())]


def code_table(reps: DataFrame, threshold: float) -> DataFrame:
    """Per row of ``reps`` (rep, vec): the keys of all tables, the code's bits, its factor and the byte
    form of the turned vector. Written."""
    bits, tables = tables_for(threshold)

    def run(batches):
        for b in batches:
            vecs = b.column(1).to_pylist()
            size = np.array([len(v) for v in vecs])
            found = [None] * len(vecs)
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                units = unit(np.array([vecs[i] for i in at], np.float64))
                keys, c = signatures(units, bits, tables), coded(units)
                for k, i in enumerate(at.tolist()):
                    found[i] = (keys[k].tolist(), d, c["bits"][k].tobytes(), float(c["factor"][k]), c["turned"][k].tobytes(),
                                float(c["scale"][k]), float(c["rest"][k]))
            columns = [pa.array([f[i] for f in found], kind) for i, (_, kind) in enumerate(CODES)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["rep", *(name for name, _ in CODES)])

    return materialise(reps.select("rep", "vec").mapInArrow(
        run, "rep long, keys array<int>, d int, bits binary, factor double, turned binary, scale double, rest double"),
        "embed-codes")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    ship_package(df.sparkSession)
    rows = materialise(df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"),
                                 F.col(label_col).alias("label")).withColumn(
        "ok", usable(F.col("vec")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()), "embed")
    good = rows.where("ok").drop("ok")
    reps = materialise(good.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")),
                       "embed-reps")

    codes = code_table(reps, threshold)
    entry = (codes.select("rep", "d", "keys").join(reps.select("rep", "label"), "rep")
             .select("rep", "label", "d", F.posexplode("keys").alias("t", "key")))
    entry = materialise(entry, "embed-keys")
    bucket = BUCKET[:4]
    sizes = entry.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = entry.join(sizes, bucket)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    member = (shared.join(codes.select("rep", *Open.columns), "rep")
              .withColumn("chunk", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")))
    here = member.select(*BUCKET, "chunk", "rep", *Open.columns)
    left = here.drop(*Open.columns)
    still = materialise(_sorted(here).mapInPandas(_buckets(Open, threshold), left.schema), "embed-open")
    fetched = still.join(reps.select("rep", "vec", "n"), "rep").join(codes.select("rep", "keys"), "rep")
    found = materialise(_sorted(fetched).mapInPandas(_buckets(Exact, threshold), "rep long, root long, links long"),
                        "embed-links")
    roots = connected_components(found, "rep", "root").select(F.col("node").alias("rep"), "root")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    keyed = materialise(reps.join(links, "rep", "left").join(roots, "rep", "left").select(
        "label", "vec", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("component_id")), "embed-keyed")
    linked = join_by_key(good, keyed, ["label", "vec"], "n").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))

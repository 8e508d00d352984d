"""SimHash near-duplicates by segment-popcount embedding (operator 9).

1. Each text becomes a 64-bit fingerprint: a bit is 1 if it is set in more than
   half of the XXH64 values of its word shingles (repeats included).
2. A fingerprint is cut into 32 segments of two bits, and mapped to the point of
   its 32 bit counts. One bit flip moves a point by one, so the Manhattan
   distance of two points is a lower bound of the fingerprints' bit distance.
   Counts are kept in unary (0: 00, 1: 01, 2: 11), so that the Manhattan distance
   is the number of differing bits of two words.
3. Grid range-join: the segments are dealt to ``G = max_bits // 2 + 1`` grids; two
   points within ``max_bits`` lie within 1 of each other on some grid (pigeonhole),
   hence in the same cell or in neighbouring cells. A point probes its own cell
   and, per segment, the cell one higher, so each pair meets exactly once a grid;
   a pair that an earlier grid already brought together is left out.
4. Pairs within ``max_bits`` of Manhattan distance are verified on the bits.

Only distinct fingerprints are joined: thousands of copies are one point. The
search is exact. Documents of a component share the smallest id.

Cases: a null or empty text, or one of white space only, has fingerprint zero and
links like any other; with fewer words than a shingle takes, the whole sequence
is the one shingle; repeated rows share a fingerprint and a component; a null id
takes part but is never the smallest unless all are null; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fleetdw.llm.common import bound_batches, join_by_key, materialise, ship_package
from fleetdw.llm.components import connected_components

SEED = 42
SHINGLES_AT_ONCE = 1 << 16
LOW = 0x5555555555555555  # the lower bit of every segment
HIGH = -0x5555555555555556  # the upper bits, as a signed 64-bit value


def fingerprint(text: str | None, size: int) -> int:
    """The 64-bit fingerprint of a text as an unsigned integer."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < size:
        size = len(words)
    n = len(words) - size + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, n, SHINGLES_AT_ONCE):
        hi = min(n, lo + SHINGLES_AT_ONCE)
        columns = [words[lo + k:hi + k] for k in range(size)]
        h = np.fromiter([digest(b" ".join(s), SEED) for s in zip(*columns, strict=True)], np.uint64, hi - lo)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, fp long")


def with_fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(row, doc_id, fp): every row of ``df`` as one struct, so that its columns may have any
    names, its id and its fingerprint's bits as a signed long."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    at = df.columns.index(text_col)
    src = df.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"))
    schema = StructType([*src.schema.fields, StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).field(at).cast(pa.string())  # the text travels once, in its row
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps)], names=schema.names)

    return src.mapInArrow(run, schema)


def unary_counts(fp: Column) -> Column:
    """The 32 bit counts of two-bit segments, each in unary."""
    some = fp.bitwiseOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(F.lit(LOW))
    both = fp.bitwiseAND(F.shiftleft(fp, 1)).bitwiseAND(F.lit(HIGH))
    return some.bitwiseOR(both)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def grid_masks(max_bits: int) -> list[tuple[int, list[int]]]:
    """Per grid: the mask of its segments' bits, and their lowest bit positions."""
    n = max_bits // 2 + 1
    if not 1 <= n <= 32:
        raise ValueError("max_bits must be from 0 to 63")
    out = []
    for g in range(n):
        at = [2 * s for s in range(32 * g // n, 32 * (g + 1) // n)]
        out.append((_signed(sum(3 << k for k in at)), at))
    return out


def links(points: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): all pairs of distinct fingerprints within ``max_bits`` bits, each
    once. ``points``: one row per distinct fingerprint, column fp."""
    base = points.select("fp", unary_counts(F.col("fp")).alias("t"))
    grids = grid_masks(max_bits)
    cells, probes = [], []
    for g, (mask, at) in enumerate(grids):
        cell = F.col("t").bitwiseAND(F.lit(mask))
        cells.append(F.struct(F.lit(g).alias("g"), cell.alias("cell")))
        probes.append(F.struct(F.lit(g).alias("g"), cell.alias("cell"), F.lit(True).alias("own")))
        if max_bits:
            for k in at:  # one higher: 00 -> 01, 01 -> 11; a full segment has no higher cell
                low, high = F.lit(1 << k), F.lit(_signed(2 << k))
                up = (F.when(cell.bitwiseAND(low) == 0, cell.bitwiseOR(low))
                      .when(cell.bitwiseAND(high) == 0, cell.bitwiseOR(high)))
                probes.append(F.when(up.isNotNull(), F.struct(F.lit(g).alias("g"), up.alias("cell"),
                                                              F.lit(False).alias("own"))))
    index = base.select(F.col("fp").alias("b"), F.col("t").alias("tb"), F.inline(F.array(*cells)))
    probe = (base.select(F.col("fp").alias("a"), F.col("t").alias("ta"),
                         F.explode(F.array_compact(F.array(*probes))).alias("p"))
             .select("a", "ta", "p.g", "p.cell", "p.own"))
    met = probe.join(index, ["g", "cell"]).where(
        F.when(F.col("own"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b")))
    apart = F.col("ta").bitwiseXOR(F.col("tb"))
    earlier = F.lit(False)
    for g, (mask, _) in enumerate(grids[:-1]):
        earlier = earlier | ((F.col("g") > g) & (F.bit_count(apart.bitwiseAND(F.lit(mask))) <= 1))
    return (met.where((F.bit_count(apart) <= max_bits) & ~earlier)
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
            .select("a", "b"))


def groups(docs: DataFrame, max_bits: int) -> DataFrame:
    """(fp, n, low, root, component_id) per distinct fingerprint of ``docs`` (doc_id, fp), written
    to the shared folder: its rows, their smallest id, the smallest fingerprint of its component
    (never null, so it names components whose ids are all null too) and the component's smallest id."""
    points = materialise(docs.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")),
                         "simhash-points")
    roots = connected_components(links(points, max_bits))
    linked = points.join(roots.withColumnRenamed("node", "fp"), "fp")
    lowest = linked.groupBy("root").agg(F.min("low").alias("root_low"))
    moved = linked.join(lowest, "root").select("fp", "root", "root_low")  # only fingerprints on a link
    return materialise(points.join(moved, "fp", "left").select(
        "fp", "n", "low", F.coalesce("root", "fp").alias("root"), F.coalesce("root_low", "low").alias("component_id")),
        "simhash-named")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``df``."""
    docs = materialise(fingerprints(df, id_col, text_col, shingle), "simhash")
    named = groups(docs, max_bits).select("fp", "n", "component_id")
    every = join_by_key(docs, named, ["fp"], "n")
    return every.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of ``df`` for each component: that with the smallest id, of several the
    smallest of all columns. Components are told apart by fingerprint, not by id, so rows
    without an id and unrelated texts under one id are kept like any other."""
    rows = materialise(with_fingerprints(df, id_col, text_col, shingle), "simhash-rows")
    named = groups(rows.select("doc_id", "fp"), max_bits)
    # the fingerprints that hold their component's smallest id: mostly one a component
    first = named.where(F.col("low").eqNullSafe(F.col("component_id"))).select("fp", "low", "root")

    def held(rows: DataFrame, first: DataFrame) -> DataFrame:
        """The short side is hashed, so whole rows are moved once and never sorted."""
        return rows.join(first.hint("shuffle_hash"),
                         (rows["fp"] == first["fp"]) & rows["doc_id"].eqNullSafe(first["low"])).drop("fp", "low")

    # most components have one such row, which is known without its other columns
    sizes = materialise(held(rows.select("doc_id", "fp"), first).groupBy("root").agg(F.count(F.lit(1)).alias("n")),
                        "simhash-held")
    one = held(rows, first.join(sizes.where("n = 1"), "root").select("fp", "low", "root"))
    several = held(rows, first.join(sizes.where("n > 1"), "root").select("fp", "low", "root"))
    ordered = F.struct(*[F.col("row")[c] for c in (id_col, *(c for c in df.columns if c != id_col))])
    least = several.groupBy("root").agg(F.min_by("row", ordered).alias("row"))
    return one.select("row.*").unionByName(least.select("row.*"))

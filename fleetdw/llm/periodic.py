"""Periodic runs of words by descending-LCP Kruskal (operator 13).

A run is a stretch of words with smallest period q, at least ``least`` words and
``times`` periods long, that neither neighbour extends. Per text:

1. The suffixes are sorted by prefix doubling; the names of all powers of two are kept and
   give the longest common prefix (LCP) of any two suffixes.
2. Neighbours in suffix order are the edges of a path. Kruskal's algorithm takes them by
   descending LCP and unites the suffix classes of their ends: a union-find whose
   classes hold their positions in order (:class:`Positions`); the smaller class moves into
   the larger one. At LCP l a class holds the positions that agree on l words.
3. Every pair of positions i < j that becomes adjacent in a class has LCP exactly l. If their
   distance d is at most l, they seed the run [i, j + l) of period d; it is complete to the
   right, and to the left if the words before i and j differ. No position between
   them agrees on l words, so d is the smallest period (were there a smaller one, i plus
   it would lie between them, in their class). The left end of a run seeds it, once.

A run of at least ``least`` words and ``times`` periods has an LCP of ``least * (times - 1) /
times`` (rounded up) at its left end, so Kruskal ends there. Positions whose next 16 words
(the largest power of two in that bound) do not occur twice in their text belong to no such
class: texts without a repeat, found by hashes of all 16-word stretches at once, need no
suffix order. A hash collision costs time, never a run.

Several texts are sorted together (words are named per text, so no class crosses texts), about
``AT_ONCE`` words a time. Rows are independent: one map over the input partitions, no
shuffle. A text is one task's work, in O(n log^2 n) time and O(n log n) memory.

Cases: a null or empty text, or one of white space only, has no words, no run and an empty
collapsed text; very long texts, also of one word repeated, take the same path; ties
between runs go to the smaller start, then period; repeated rows and ids are independent
rows; a null id is kept (and counts as unaltered in :func:`scan`); an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetdw.llm.common import ship_package

LEAST = 24
TIMES = 3
AT_ONCE = 1 << 18
CHUNK = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Positions:
    """An ordered set of positions in chunks of at most ``2 * CHUNK``."""

    __slots__ = ("chunks", "size")

    def __init__(self, x: int):
        self.chunks, self.size = [[x]], 1

    def insert(self, x: int) -> tuple[int | None, int | None]:
        """Insert ``x``; its neighbours before and after."""
        chunks = self.chunks
        k = max(0, bisect_right(chunks, x, key=lambda c: c[0]) - 1) if len(chunks) > 1 else 0
        c = chunks[k]
        at = bisect_right(c, x)
        low = c[at - 1] if at else None  # only in the first chunk
        high = c[at] if at < len(c) else chunks[k + 1][0] if k + 1 < len(chunks) else None
        c.insert(at, x)
        self.size += 1
        if len(c) > 2 * CHUNK:
            chunks[k:k + 1] = [c[:CHUNK], c[CHUNK:]]
        return low, high


def seeds(edges: Iterator[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(i, j, l): the pairs that become adjacent in a class, with their LCP. ``edges``: (a, b, l)
    of a forest, by descending l."""
    parent: dict[int, int] = {}
    held: dict[int, Positions] = {}
    for a, b, l in edges:
        for x in (a, b):
            if x not in parent:
                parent[x], held[x] = x, Positions(x)
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if held[a].size < held[b].size:
            a, b = b, a
        into, moved = held[a], [x for c in held.pop(b).chunks for x in c]
        parent[b] = a
        last = -1
        for x, after in zip(moved, [*moved[1:], None], strict=True):
            low, high = into.insert(x)
            if low is not None and low != last:  # the one before comes from the other class
                yield low, x, l
            if high is not None and (after is None or high < after):
                yield x, high, l
            last = x


def _names(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks of pairs, and how many there are."""
    keys, names = np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)
    return names.astype(np.int32) + 1, len(keys)  # 0: beyond the end


def _shifted(x: np.ndarray, by: int, left: np.ndarray) -> np.ndarray:
    """``x`` moved ``by`` to the left, 0 where that is beyond the end of the text; ``left``: words
    from each position to there."""
    out = np.zeros_like(x)
    out[:len(x) - by] = x[by:]
    out[left <= by] = 0
    return out


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in the texts ``words[bounds[k]:bounds[k + 1]]``, starts
    counted in ``words``. ``words``: a number per word."""
    n = len(words)
    lcp_least = max(1, -(-least * (times - 1) // times))
    lengths = np.diff(bounds)
    text = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
    left = (np.repeat(bounds[1:], lengths) - np.arange(n)).astype(np.int64)
    if not (left > lcp_least).any():
        return []
    # hashes of all stretches of the largest power of two words
    h, reach = words.astype(np.uint64) * _MIX ^ text.astype(np.uint64), 1
    with np.errstate(over="ignore"):
        while 2 * reach <= lcp_least:
            h = (h ^ h >> np.uint64(29)) * _MIX
            h[:n - reach] += h[reach:] * np.uint64(2 * reach + 1)
            reach *= 2
    whole = np.flatnonzero(left >= reach)
    order = np.argsort(h[whole], kind="stable")
    same = np.diff(h[whole][order].view(np.int64)) == 0
    again = np.unique(text[whole[order[1:][same]]])
    if not len(again):
        return []
    # suffixes of the texts with a repeat, by prefix doubling
    keep = np.isin(text, again)
    at = np.flatnonzero(keep)
    text, left, words = text[at], left[at], words[at]
    m = len(at)
    names, count = _names(text.astype(np.int32), words.astype(np.int32))
    levels = [names]
    while count < m and (1 << (len(levels) - 1)) < left.max():
        by = 1 << (len(levels) - 1)
        names, count = _names(names, _shifted(names, by, left))
        levels.append(names)
    suffixes = np.argsort(names, kind="stable")
    a, b = suffixes[:-1], suffixes[1:]
    near = text[a] == text[b]
    a, b = a[near], b[near]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):  # whole stretches of 2^k words that agree
        ia, ib = a + lcp, b + lcp
        fits = (lcp + (1 << k) <= left[a]) & (lcp + (1 << k) <= left[b])
        ia, ib = np.where(fits, ia, 0), np.where(fits, ib, 0)
        lcp += np.where(fits & (levels[k][ia] == levels[k][ib]), 1 << k, 0)
    del levels
    long = np.flatnonzero(lcp >= lcp_least)
    long = long[np.argsort(-lcp[long], kind="stable")]
    first = np.r_[True, text[1:] != text[:-1]]
    out = []
    for i, j, l in seeds(zip(a[long].tolist(), b[long].tolist(), lcp[long].tolist(), strict=True)):
        d = j - i
        if d <= l and d + l >= least and d + l >= times * d and (first[i] or words[i - 1] != words[j - 1]):
            out.append((int(at[i]), d + l, d))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    covered = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        covered[start + period] += 1
        covered[start + length] -= 1
    return [w for w, c in zip(words, np.cumsum(covered[:-1]).tolist(), strict=True) if not c]


def find_in_texts(texts: list[str | None], least: int = LEAST, times: int = TIMES) -> Iterator[tuple[list, list]]:
    """Per text, in order: its words (bytes) and its runs."""
    pending, held = [], 0
    for t in texts:
        pending.append((t or "").encode().split())  # bytes: ASCII white space only
        held += len(pending[-1])
        if held >= AT_ONCE:
            yield from _several(pending, least, times)
            pending, held = [], 0
    yield from _several(pending, least, times)


def _several(texts: list[list], least: int, times: int) -> Iterator[tuple[list, list]]:
    codes: dict[bytes, int] = {}
    number = codes.setdefault
    numbered = np.array([number(w, len(codes)) for t in texts for w in t], np.int64)
    bounds = np.cumsum([0] + [len(t) for t in texts])
    runs: list[list] = [[] for _ in texts]
    found = find_runs(numbered, bounds, least, times)
    where = np.searchsorted(bounds, [r[0] for r in found], side="right") - 1 if found else []
    for k, (start, length, period) in zip(where, found, strict=True):
        runs[k].append((start - int(bounds[k]), length, period))
    yield from zip(texts, runs, strict=True)


RUNS = "array<struct<start:long,length:long,period:long>>"


def runs(df: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text", least: int = LEAST,
         times: int = TIMES) -> DataFrame:
    """(id_col, runs, collapsed) per row: all runs by start, then period, and the text without the
    repeated periods, its words joined by one space."""
    if least < 2 or times < 2:
        raise ValueError("a run has at least two words and two periods")
    ship_package(df.sparkSession)
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    src = df.select(F.col(id_col), text.cast("string").alias("__text"))
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, texts = [], []
            for words, rs in find_in_texts(b.column(1).to_pylist(), least, times):
                found.append([{"start": s, "length": n, "period": q} for s, n, q in rs])
                texts.append(b" ".join(collapse(words, rs)).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind), pa.array(texts, pa.string())],
                                             names=[id_col, "runs", "collapsed"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, runs {RUNS}, collapsed string")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where a function inside uses it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeating(text: Column, doc_id: Column) -> Column:
    """``text``; of every tenth document (by the CRC-32 of its id) the words from some position
    on repeat with a period that fits three to ten times."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def altered(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        whole = _let(F.struct(words.alias("w"), a.alias("a"), p.alias("p")), lambda s: F.array_join(F.concat(
            F.slice(s["w"], F.lit(1), s["a"]),
            F.transform(F.sequence(s["a"], F.size(s["w"]) - 1), lambda i: F.get(s["w"], s["a"] + (i - s["a"]) % s["p"]))), " "))
        return F.when(n > 0, whole).otherwise(text)

    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return F.when((h % 10 == 0) & text.isNotNull(), _let(words, altered)).otherwise(text)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row of :func:`runs`: the number of runs, the one with the greatest exponent, and
    the digests of all runs and of the collapsed text."""
    # exact: a / b > c / d by products; the first of equal ones stays
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
                       lambda m, r: F.when(m.isNull() | (r["length"] * m["period"] > m["length"] * r["period"]), r).otherwise(m))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def scan(df: DataFrame) -> DataFrame:
    """The runs of all ``documents``, every tenth altered by :func:`repeating`."""
    return digests(runs(df, "doc_id", repeating(F.col("text").cast("string"), F.col("doc_id"))))

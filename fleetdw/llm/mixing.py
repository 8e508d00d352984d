"""Mixing sources to target weights by min-cost flow (operator 6).

A document belongs to one or more sources (its *membership pattern*). Per pattern
only the number of words counts, so the documents aggregate to one row a pattern:

1. *Targets.* Sources share ``share`` times all words by weight; a target stops at
   ``max_copies`` times its source's words, and the excess is shared again by
   weight. The fixed point is the water level L with sum(min(cap, weight * L)) =
   total, found with one window over the sources sorted by cap / weight.
2. *Flow.* Patterns send words to their sources' targets. The k-th copy of a
   pattern costs more than the (k-1)-th (convex), so nothing is repeated while a
   first copy can still serve; shortest augmenting paths give the flow of least
   cost. Sources that share no pattern, even indirectly, are separate problems:
   each connected component is one small group of aggregated rows.
3. *Selection.* A pattern's flow is ``whole`` copies of every document and one more
   copy of a seeded subset. Documents are ordered by a seeded hash; hash buckets
   are summed on two levels to find where the running sum meets the flow, and the
   one bucket at the border (about ``BORDER`` documents) is filled document by
   document, leaving out what no longer fits and exchanging single documents for a
   closer fit. No task ever sees a whole source.

Only whole documents are taken, and none more than ``max_copies`` times. Reruns
agree: the order depends on the seed, the id and the number of words alone.

Cases: a null text has no words; a null source is a source of its own, after all
others; an empty or null list of sources likewise; rows that repeat an id and size
are counted together and given copies one by one; ties in the hash are broken by
id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetdw.llm.common import materialise, ship_package
from fleetdw.llm.components import connected_components

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SEED = 20240601
BORDER = 1024
LEVEL_BITS = 10
NULL_KEY = "~"  # after every "=source" by code point


def source_key(source: Column) -> Column:
    """A source as a key that sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(NULL_KEY))


def targets(sizes: DataFrame, share: float, max_copies: int, weights=WEIGHTS) -> DataFrame:
    """(source, source_size) -> also ``target``. One row per source."""
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(W.orderBy("source")) - 1) % len(weights) + 1)
    caps = sizes.withColumn("weight", w).withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
    order = W.orderBy(F.col("cap") / F.col("weight"), "source")
    everything = W.partitionBy(F.lit(1))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)))
    levels = caps.withColumn("level", level).withColumn("open", F.col("cap") > F.col("weight") * F.col("level"))
    final = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return levels.withColumn("final", final).select(
        "source", "source_size",
        F.when(F.col("final").isNull(), F.col("cap")).otherwise(
            F.least("cap", F.col("weight") * F.col("final"))).alias("target"))


def cheapest_flow(capacity: dict, quota: dict, arcs: list[tuple], max_copies: int) -> dict:
    """Words sent along each (pattern, source) arc, at least cost. Paths from the cheapest
    copy level come first; within a level every path costs the same, so breadth-first
    search finds shortest augmenting paths."""
    to, back = {}, {}
    for p, s in arcs:
        to.setdefault(p, []).append(s)
        back.setdefault(s, []).append(p)
    flow = dict.fromkeys(arcs, 0.0)
    left_quota = dict(quota)
    eps = 1e-9 * (1 + sum(quota.values()))
    for _ in range(max_copies):
        room = dict(capacity)  # one more copy of every pattern
        for start in sorted(to):
            while room[start] > eps:
                seen, queue, end = {("p", start): None}, deque([("p", start)]), None
                while queue and end is None:
                    kind, x = node = queue.popleft()
                    if kind == "p":
                        nxt = [("s", s) for s in to[x]]
                    else:
                        if left_quota[x] > eps:
                            end = node
                            break
                        nxt = [("p", p) for p in back[x] if flow[p, x] > eps]
                    for y in nxt:
                        if y not in seen:
                            seen[y] = node
                            queue.append(y)
                if end is None:
                    break
                path, y = [], end
                while seen[y] is not None:
                    path.append((seen[y], y))
                    y = seen[y]
                step = min(room[start], left_quota[end[1]])
                for (ka, a), (_, b) in path:
                    if ka == "s":
                        step = min(step, flow[b, a])
                for (ka, a), (_, b) in path:
                    if ka == "p":
                        flow[a, b] += step
                    else:
                        flow[b, a] -= step
                room[start] -= step
                left_quota[end[1]] -= step
    return flow


def _flows(arcs: DataFrame, max_copies: int) -> DataFrame:
    """Per arc of (component, pattern, source, pattern_size, target): ``flow``."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["pattern", "source"], kind="stable").reset_index(drop=True)
        cap = dict(zip(pdf["pattern"], pdf["pattern_size"].astype(float), strict=True))
        quota = dict(zip(pdf["source"], pdf["target"].astype(float), strict=True))
        keys = list(zip(pdf["pattern"], pdf["source"], strict=True))
        flow = cheapest_flow(cap, quota, keys, max_copies)
        return pd.DataFrame({"pattern": pdf["pattern"], "source": pdf["source"], "flow": [flow[k] for k in keys]})

    return arcs.groupBy("component").applyInPandas(solve, "pattern string, source string, flow double")


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """At the border: in hash order, as many copies of each document as still fit; then
    single additions or exchanges while they bring the words nearer to the flow."""
    pdf = pdf.sort_values(["h", "doc_id", "size"], kind="stable", na_position="first")
    size, n = pdf["size"].to_numpy(), pdf["n"].to_numpy()
    left, extra = float(pdf["left"].iloc[0]), np.zeros(len(pdf), np.int64)
    for i in range(len(pdf)):
        extra[i] = min(n[i], (left + 1e-6) // size[i]) if size[i] else 0
        left -= extra[i] * size[i]
    while abs(left) >= 1:
        free = np.flatnonzero((extra < n) & (size > 0))
        free = free[np.argsort(size[free], kind="stable")]
        if not len(free):
            break
        out = np.concatenate([[-1], np.flatnonzero((extra > 0) & (size > 0))])  # -1: add without taking out
        wish = left + np.where(out < 0, 0, size[out])
        at = np.searchsorted(size[free], wish)
        trial = [(abs(wish[k] - size[free[j]]), k, j) for k in range(len(out))
                 for j in (at[k] - 1, at[k]) if 0 <= j < len(free)]
        gap, k, j = min(trial)
        if gap >= abs(left) - 1e-6:
            break
        if out[k] >= 0:
            extra[out[k]] -= 1
            left += size[out[k]]
        extra[free[j]] += 1
        left -= size[free[j]]
    return pdf[["pattern", "doc_id", "size", "n"]].assign(extra=extra)


def _edge(sums: DataFrame, at: str) -> DataFrame:
    """The bucket ``at`` in which each pattern's running sum passes ``left``."""
    w = W.partitionBy("pattern").orderBy(at)
    running = sums.withColumn("upto", F.sum("words").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return (running.where(F.col("upto") > F.col("left")).groupBy("pattern")
            .agg(F.min_by(F.struct(F.col(at).alias("edge"), (F.col("left") - F.col("upto") + F.col("words"))
                                   .alias("left")), at).alias("e")).select("pattern", "e.edge", "e.left"))


def decide(docs: DataFrame, share: float = 1.5, max_copies: int = 2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """``docs``: doc_id, sources (array of keys), size. Returns the decisions, one row per
    distinct (doc_id, pattern, size) with ``n`` rows, ``whole`` copies each and ``extra`` rows
    that get one more, and the targets (source, source_size, target)."""
    ship_package(docs.sparkSession)
    keys = F.when(F.size("sources") > 0, F.array_sort(F.array_distinct("sources"))).otherwise(F.array(F.lit(NULL_KEY)))
    counted = materialise(
        docs.select("doc_id", "size", keys.alias("keys"))
        .groupBy("doc_id", "size", "keys").agg(F.count(F.lit(1)).alias("n"))
        .select("doc_id", "size", "n", "keys", F.to_json("keys").alias("pattern"),
                F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "size"), 1).alias("h")), "mix-documents")
    patterns = materialise(counted.groupBy("pattern", "keys").agg(
        F.sum(F.col("size") * F.col("n")).alias("pattern_size"), F.count(F.lit(1)).alias("docs")), "mix-patterns")
    arcs = patterns.select("pattern", "pattern_size", "docs", F.explode("keys").alias("source"))
    goals = materialise(targets(arcs.groupBy("source").agg(F.sum("pattern_size").alias("source_size")),
                                share, max_copies), "mix-targets")
    shared = patterns.where(F.size("keys") > 1).select(F.get("keys", F.lit(0)).alias("a"), F.explode("keys").alias("b"))
    roots = connected_components(shared)
    arcs = (arcs.join(goals, "source").join(roots.withColumnRenamed("node", "source"), "source", "left")
            .select(F.coalesce("root", "source").alias("component"), "pattern", "source", "pattern_size", "target"))
    sent = _flows(arcs, max_copies).groupBy("pattern").agg(F.sum("flow").alias("sent"))
    whole = F.when(F.col("pattern_size") > 0, F.least(F.floor((F.col("sent") + 1e-6) / F.col("pattern_size")),
                                                      F.lit(max_copies))).otherwise(0)
    bits = F.greatest(F.ceil(F.log2(F.col("docs") / BORDER)), F.lit(0))
    plan = materialise(
        patterns.join(sent, "pattern").withColumn("whole", whole.cast("int"))
        .select("pattern", "whole", (F.col("sent") - F.col("whole") * F.col("pattern_size")).alias("left"),
                F.least(bits, F.lit(LEVEL_BITS)).cast("int").alias("bits1"),
                F.greatest(F.least(bits - LEVEL_BITS, F.lit(LEVEL_BITS)), F.lit(0)).cast("int").alias("bits2")), "mix-plan")
    placed = counted.join(plan, "pattern").select(
        "doc_id", "size", "n", "pattern", "h", "whole", "left",
        F.expr("shiftrightunsigned(h, 63 - bits1)").alias("b1"),
        F.expr("shiftrightunsigned(h, 63 - bits1 - bits2)").alias("b2"))
    words = F.sum(F.col("size") * F.col("n")).alias("words")
    edge1 = materialise(_edge(placed.groupBy("pattern", "b1").agg(words, F.first("left").alias("left")), "b1"),
                        "mix-edge").select("pattern", F.col("edge").alias("e1"), F.col("left").alias("left1"))
    near = placed.join(edge1, "pattern").where(F.col("b1") == F.col("e1"))
    edge2 = materialise(_edge(near.groupBy("pattern", "b2").agg(words, F.first("left1").alias("left")), "b2"),
                        "mix-edge").select("pattern", F.col("edge").alias("e2"), F.col("left").alias("left2"))
    at = placed.join(edge2, "pattern", "left").withColumn("side", F.when(
        F.col("e2").isNull() | (F.col("b2") < F.col("e2")), -1).when(F.col("b2") > F.col("e2"), 1).otherwise(0))
    at = materialise(at, "mix-sides")
    border = (at.where("side = 0").select("pattern", "doc_id", "size", "n", "h", F.col("left2").alias("left"), "whole"))
    filled = border.groupBy("pattern").applyInPandas(
        _fill, "pattern string, doc_id long, size long, n long, extra long")
    filled = filled.join(plan.select("pattern", "whole"), "pattern")
    # where no running sum passes the flow, it takes every document (flow equal to the words) or no copy more (0)
    beyond = at.where("side <> 0").select(
        "pattern", "doc_id", "size", "n",
        F.when((F.col("side") < 0) & (F.col("left") > 0), F.col("n")).otherwise(0).alias("extra"), "whole")
    return filled.unionByName(beyond), goals


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = 1.5, max_copies: int = 2, seed: int = SEED) -> DataFrame:
    """Per row of ``df``: doc_id, size (words), source_size, target (of its source) and taken
    (words the mix takes, repeats counted), for documents of one source each."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.array(source_key(F.col(source_col).cast("string"))).alias("sources"),
                     F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD))
                     .cast("long").alias("size"))
    decisions, goals = decide(docs, share, max_copies, seed)
    named = decisions.withColumn("source", F.get(F.from_json("pattern", "array<string>"), F.lit(0)))
    return (named.join(goals, "source")
            .select("doc_id", "size", "source_size", "target", "whole", "extra",
                    F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
            .select("doc_id", "size", "source_size", "target",
                    ((F.col("whole") + F.when(F.col("i") <= F.col("extra"), 1).otherwise(0)) * F.col("size"))
                    .cast("long").alias("taken")))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          share: float = 1.5, max_copies: int = 2, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``df``, as it is, as many times as the mix takes it."""
    size = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("size"),
                     F.array(source_key(F.col(source_col).cast("string"))).alias("sources"))
    decisions, _ = decide(docs, share, max_copies, seed)
    decisions = decisions.select(F.col("doc_id").alias("__id"), F.col("size").alias("__n"), "pattern",
                                 "whole", "extra", "n")
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("__d"), F.col(id_col).cast("long").alias("__i"),
                     size.alias("__s"), F.to_json(F.array(source_key(F.col(source_col).cast("string")))).alias("__p"))
    met = rows.join(decisions, F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__s") == F.col("__n"))
                    & (F.col("__p") == F.col("pattern")))
    alike = W.partitionBy("__i", "__s", "__p").orderBy(F.xxhash64("__d"))
    one = F.when(F.col("extra") > 0, 1).otherwise(0)
    split = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))  # some of the rows alike
    some = met.where(split).withColumn("more", F.when(F.row_number().over(alike) <= F.col("extra"), 1).otherwise(0))
    copies = met.where(~split).withColumn("more", one).unionByName(some).withColumn("copies", F.col("whole") + F.col("more"))
    return (copies.where("copies > 0").select("__d", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__k"))
            .select("__d.*"))

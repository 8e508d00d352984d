"""Connected components of an edge table, by alternating large and small stars.

Every round rewires each node's neighbours to the smallest node seen there, first
the larger neighbours, then the smaller ones; the table ends as stars around the
smallest node of each component, in O(log n) rounds on real graphs. Only joins and
``min`` aggregations that combine before the shuffle; a node with very many edges
is a skewed join side, which AQE splits. Each round is written to the shared
folder, so the lineage stays short. Nothing but two numbers per round reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetdw.llm.common import materialise


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """``edges`` (u > v). Large star: per node all neighbours, rewire the larger
    ones. Small star: per node the smaller neighbours, rewire them and itself."""
    if larger:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return (near.where("v > u").join(low, "u")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of each component, for every node on an edge.

    Edges may repeat, point either way or be loops; nulls link nothing.
    """
    cur = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    cur = materialise(cur, "cc")
    before = _digest(cur)
    while before[0]:
        cur = materialise(_star(_star(cur, True), False), "cc")
        now = _digest(cur)
        if now == before:
            break
        before = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()

"""Merkle manifest of a dataset with incremental witnesses (operator 12).

Every row is a leaf: the SHA-256 of its columns, each written as its length in bytes,
a colon and its value, or as ``-`` if null. The leaves of a group (here: a language)
ascend by id; as long as a level has several nodes, every ``ARITY`` consecutive ones (the
last run may have fewer, even one) become their hash. What remains is the group's
subroot; the subroots, in byte order of their group (null first), give the root likewise.

Streaming append: :class:`Tree` takes nodes one by one. A leaf is attached to the open
subtree of the lowest level with an empty witness. When a run is complete, each of its
nodes learns its siblings once, and the run's hash is appended one level higher; so
the witnesses of all leaves below grow with every later completion.

On Spark the leaves are cut into aligned blocks of ``ARITY ** BLOCK_LEVELS`` leaves. Blocks
are built independently of one another (upward pass); their roots are the next level's
leaves, i.e. further appends at the height of a block, until each group has one root. Downward,
every block's rows are replayed together with the witness of the block's root, which
extends their own. Only hashes move; the proof of a leaf is made in the last step and
never shuffled. Blocks hold at most 512 rows, so a hot group is many small tasks'
work; positions within a group come from a range partitioning and a table of counts.

Cases: null columns count as ``-``; a null id sorts first; rows that repeat an id ascend by
their leaf (equal leaves are interchangeable); a null group is a group of its own, the
first; an empty text is ``0:``; a group of one row has the leaf itself as its subroot, a
dataset of one group that group's subroot as its root; an empty table gives an empty
result; columns that are not named are neither hashed nor returned.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetdw.llm.common import materialise, ship_package, shuffle_partitions

ARITY = 8
BLOCK_LEVELS = 3
#: Counts per (partition, group) up to so many rows are broadcast.
FEW = 200_000
PROOF = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Node:
    """A node and, once its run is complete, its siblings and its parent."""

    __slots__ = ("hash", "before", "after", "parent")

    def __init__(self, hash: str):
        self.hash, self.before, self.after, self.parent = hash, "", "", None

    def witness(self) -> list[tuple[str, str]]:
        """The siblings left and right on every level passed so far, from here upward."""
        out, node = [], self
        while node.parent is not None:
            out.append((node.before, node.after))
            node = node.parent
        return out


class Tree:
    """Streaming append with incremental witnesses; ``open[k]`` is the run of level k that is
    not complete yet. A complete subtree of height k may be appended at level k as long as
    nothing lower is open."""

    def __init__(self, arity: int = ARITY):
        self.arity, self.open = arity, [[]]

    def append(self, hash: str, level: int = 0) -> Node:
        while len(self.open) <= level:
            self.open.append([])
        node = Node(hash)
        self.open[level].append(node)
        if len(self.open[level]) == self.arity:
            self._complete(level)
        return node

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        joined = "".join(n.hash for n in run)
        parent = self.append(digest(joined), level + 1)
        at = 0
        for n in run:
            n.before, n.after, n.parent = joined[:at], joined[at + len(n.hash):], parent
            at += len(n.hash)

    def close(self, height: int | None = None) -> str | None:
        """Complete the open runs and return the root (None: nothing was appended). ``height``: the
        tree is a block of a larger one, whose root lies so many levels above its leaves."""
        level = 0
        while level < len(self.open):
            run, higher = self.open[level], any(self.open[level + 1:])
            if run and not higher and (level == height if height is not None else len(run) == 1):
                return run[0].hash
            if run:
                self._complete(level)
            level += 1
        return None


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def siblings(proof: Column) -> Column:
    """The hashes of a proof, level by level, left to right, joined."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def leaf(columns: list[Column]) -> Column:
    """The hash of a row's columns."""
    parts = []
    for c in columns:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


# ------------------------------------------------------------------ positions
def _positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (g, hash, ...) with ``idx``, the position in the group by ``order`` then
    hash, and ``n``, the group's rows; written. The written row number is part of the sort
    key only to deal equal rows out to several partitions."""
    keys = [F.col("g"), *[F.col(c).asc_nulls_first() for c in order], F.col("hash"), F.col("tie")]
    dealt = (rows.withColumn("tie", F.monotonically_increasing_id())
             .repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
             .select(*rows.columns, F.spark_partition_id().alias("part"),
                     F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")))
    dealt = materialise(dealt, "merkle-sorted")
    counts = materialise(dealt.groupBy("part", "g").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("first")),
                         "merkle-counts")
    upto = W.partitionBy("g").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("part", "g", (F.coalesce(F.sum("here").over(upto), F.lit(0)) - F.col("first")).alias("shift"),
                            F.sum("here").over(W.partitionBy("g")).alias("n"))
    if counts.count() <= FEW:
        offsets = F.broadcast(offsets)
    return (dealt.join(offsets, ["part", "g"])
            .select(*rows.columns, (F.col("at") + F.col("shift")).alias("idx"), "n"))


# ------------------------------------------------------------------ passes
def _block(height: int) -> Column:
    return F.expr(f"idx div {ARITY ** height}").alias("block")


def _replay(table: pa.Table, height: int) -> tuple[list[Node], str | None]:
    """The nodes of a block, rows ascending by idx, and the block's root."""
    tree = Tree()
    nodes = [tree.append(h) for h in table.column("hash").to_pylist()]
    return nodes, tree.close(height if table.column("n")[0].as_py() > ARITY ** height else None)


def _block_root(height: int):
    """A function of a block's rows: its root as a node of the next table."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        g, block, n = (rows.column(c)[0].as_py() for c in ("g", "block", "n"))
        return pa.table({"g": pa.array([g], pa.string()), "idx": pa.array([block], pa.int64()),
                         "n": pa.array([-(-n // ARITY ** height)], pa.int64()),
                         "hash": pa.array([_replay(rows, height)[1]], pa.string())})

    return run


def _climb(rows: DataFrame, height: int) -> list[DataFrame]:
    """Tables of nodes (g, idx, n, hash, ...): ``rows``, the roots of their blocks, the roots
    of blocks of these, and so on; the last has one row a group."""
    levels = [rows]
    most = rows.agg(F.max("n")).first()[0] or 0
    while most:
        up = (levels[-1].select("g", "idx", "n", "hash", _block(height)).groupBy("g", "block")
              .applyInArrow(_block_root(height), "g string, idx long, n long, hash string"))
        levels.append(materialise(up, "merkle-roots"))
        if most <= ARITY ** height:
            return levels
        most = -(-most // ARITY ** height)
    return levels


def _extend(names: list[str], height: int):
    """A function of a block's rows and its root's witness: the rows (columns ``names``) with their own."""
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def run(rows: pa.Table, root: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        nodes, _ = _replay(rows, height)
        upper = [(s["before"], s["after"]) for s in root.column("proof")[0].as_py()]
        proofs = pa.array([[{"before": a, "after": z} for a, z in n.witness() + upper] for n in nodes], kind)
        out = rows.select(names)
        for c in ("subroot", "root"):
            out = out.append_column(c, pa.array([root.column(c)[0].as_py()] * len(nodes), pa.string()))
        return out.append_column("proof", proofs)

    return run


def _descend(levels: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """The first level with every row's proof, subroot and root. ``top``: (g, idx, subroot,
    root, proof) of the last level."""
    for k, rows in reversed(list(enumerate(levels[:-1]))):
        kept = [f for f in rows.schema.fields if f.name != "n"]
        schema = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
                  + f", subroot string, root string, proof {PROOF}")
        parents = top.select("g", F.col("idx").alias("block"), "subroot", "root", "proof")
        top = (rows.withColumn("block", _block(height)).groupBy("g", "block").cogroup(parents.groupBy("g", "block"))
               .applyInArrow(_extend([f.name for f in kept], height), schema))
        if k:  # upper levels hold one row a block
            top = materialise(top.select("g", "idx", "subroot", "root", "proof"), "merkle-witnesses")
    return top


def manifest(df: DataFrame, columns: list[str], group_col: str, id_col: str,
             carry: dict[str, Column] | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(id_col, leaf, subroot, root, proof) and the columns ``carry`` names, per row of ``df``.

    ``columns``: what a leaf hashes, in order. The proof lists, from the leaf upward, the
    siblings before and after it; :func:`fold` leads from a leaf and its proof to the root.
    ``block_levels``: the height of the blocks; the result does not depend on it."""
    ship_package(df.sparkSession)
    carry = carry or {}
    group = F.col(group_col).cast("string")
    rows = df.select(F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("g"),  # null first, then byte order
                     F.col(id_col).alias("id"), leaf([F.col(c) for c in columns]).alias("hash"),
                     F.struct(*[c.alias(k) for k, c in carry.items()], F.lit(0).alias("__none")).alias("carry"))
    rows = materialise(rows, "merkle-leaves")
    levels = _climb(materialise(_positions(rows, ["id"]), "merkle-ranked"), block_levels)
    if len(levels) == 1:  # no rows
        top = df.sparkSession.createDataFrame([], f"id string, hash string, subroot string, root string, proof {PROOF}")
        return top.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), F.col("hash").alias("leaf"), "subroot",
                          "root", "proof", *[F.lit(None).cast(rows.schema["carry"].dataType[k].dataType).alias(k) for k in carry])
    # the groups' subroots are the leaves of the last tree
    groups = levels[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), "hash")
    upper = _climb(materialise(_positions(groups, ["name"]), "merkle-groups"), block_levels)
    root = upper[-1].select("g", "idx", F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"),
                            F.array().cast(PROOF).alias("proof"))
    named = _descend(upper, root, block_levels).select(F.col("name").alias("g"), F.lit(0).cast("long").alias("idx"),
                                         F.col("hash").alias("subroot"), "root", "proof")
    out = _descend(levels, materialise(named, "merkle-subroots"), block_levels)
    return out.select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot", "root", "proof",
                      *[F.col(f"carry.{k}").alias(k) for k in carry])


A_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(df: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest of ``documents``, and what tampering does to it: where 3 divides the
    CRC-32 of the id, the text's A-Z are lower-cased (a row without id is never tampered
    with). ``folded_root`` is recomputed from that row's leaf with the original siblings."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    changed = F.when(hit, F.translate(F.col("text").cast("string"), *A_Z)).otherwise(F.col("text").cast("string"))
    now = leaf([*[F.col(c) for c in columns[:-1]], changed])
    out = manifest(df, columns, "lang", "doc_id", carry={"now": now}, block_levels=block_levels)
    return (out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
                       fold(F.col("now"), F.col("proof")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))

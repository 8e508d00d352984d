"""Sharding by extendible hashing (operator 3).

A document's key hashes to ``2 * 60`` bits: 60 of its id, then 60 of its text, for rows that
repeat an id. The directory maps hash prefixes to buckets. All starts in one bucket of
depth 0, and a bucket of more than ``limit`` bytes splits on one bit more; the others stay
as they are. So a bucket's prefix is the shortest one whose documents fit.

The splits are found ``LEVEL_BITS`` bits at a time: bytes are summed per leaf prefix
(combined before the shuffle), leaf sums give those of all shorter prefixes, and only
documents below a leaf that is still too large go on to the next level. The directory
stays a table: neither documents nor buckets reach the driver, only their number.

Documents are never cut: one larger than the limit ends alone in a bucket, marked
``oversized``. Rows of the same id and text cannot be told apart by any bits; they fill
*pages* of their bucket, each within the limit.

:func:`directory` gives the buckets as a table, :func:`place` looks documents up in it.

Cases: a null text has no bytes, a null id is the key ``null``; empty texts take no room and
never split a bucket; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetdw.llm.common import materialise

LIMIT = 1 << 20
HASH_BITS, LEVEL_BITS = 60, 12


def hash60(text: Column) -> Column:
    """The first 60 bits of the MD5 digest, as a long."""
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _level(docs: DataFrame, hashed: str, first: int, above: int, limit: int) -> DataFrame:
    """Leaves of the next ``LEVEL_BITS`` bits of ``hashed`` below the buckets ``at`` of ``docs``:
    at, leaf and, if some prefix fits, its additional depth, prefix, bytes and documents."""
    leaf = F.shiftright(hashed, HASH_BITS - first - LEVEL_BITS).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))
    leaves = materialise(docs.groupBy("at", leaf.alias("leaf")).agg(
        F.sum(F.col("bytes") * F.col("n")).alias("bytes"), F.sum("n").alias("docs")), "shard-leaves")
    depths = F.sequence(F.lit(0 if above == 0 else 1), F.lit(LEVEL_BITS))
    prefix = F.expr(f"shiftright(leaf, {LEVEL_BITS} - depth)")
    split = leaves.withColumn("depth", F.explode(depths)).withColumn("prefix", prefix)
    fits = (split.groupBy("at", "depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
            .where(F.col("bytes") <= limit))
    shortest = (split.select("at", "leaf", "depth", "prefix").join(fits, ["at", "depth", "prefix"])
                .groupBy("at", "leaf").agg(F.min(F.struct("depth", "prefix", "bytes", "docs")).alias("b")))
    return leaves.select("at", "leaf").join(shortest, ["at", "leaf"], "left").select("at", "leaf", "b.*")


def assign(df: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, bytes, depth and prefix (the bucket: the first ``depth`` bits of the
    hash; beyond 60 bits the prefix counts in the text's hash), page, shard_bytes, shard_docs
    (of the bucket) and oversized."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc = F.col(id_col).cast("long")
    key = F.coalesce(doc.cast("string"), F.lit("null"))
    docs = materialise(
        df.select(doc.alias("doc_id"), hash60(key).alias("h1"), hash60(text).alias("h2"),
                  F.octet_length(text).cast("long").alias("bytes"))
        .groupBy("doc_id", "h1", "h2", "bytes").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("at", F.lit("")), "shard-documents")
    done, above = [], 0
    left = docs
    for hashed in ("h1", "h2"):
        for first in range(0, HASH_BITS, LEVEL_BITS):
            leaves = materialise(_level(left, hashed, first, above, limit), "shard-level")
            leaf = F.shiftright(hashed, HASH_BITS - first - LEVEL_BITS).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))
            met = left.withColumn("leaf", leaf).join(
                leaves.select("at", "leaf", "depth", "prefix", F.col("bytes").alias("shard_bytes"),
                              F.col("docs").alias("shard_docs")), ["at", "leaf"])
            whole = F.shiftright(hashed, HASH_BITS - first).cast("long")  # the bits of this hash above the level
            done.append(met.where("depth is not null").select(
                "doc_id", "bytes", "n", (F.lit(above) + F.col("depth")).cast("int").alias("depth"),
                (whole * F.pow(F.lit(2.0), F.col("depth")).cast("long") + F.col("prefix")).alias("prefix"),
                F.lit(0).alias("page"), "shard_bytes", "shard_docs", F.lit(False).alias("oversized")))
            above += LEVEL_BITS
            left = materialise(met.where("depth is null").select(
                "doc_id", "h1", "h2", "bytes", "n",
                F.concat_ws(".", "at", F.col("leaf").cast("string")).alias("at")), "shard-left")
            if left.isEmpty():
                break
        else:
            continue
        break
    # all bits are spent: one large document, or rows of the same id and text
    room = F.greatest(F.floor(F.lit(limit) / F.col("bytes")), F.lit(1))
    pages = left.select("doc_id", "bytes", F.lit(above).cast("int").alias("depth"), F.col("h2").alias("prefix"),
                        room.alias("room"), (F.col("bytes") * F.col("n")).alias("shard_bytes"), F.col("n").alias("shard_docs"),
                        (F.col("bytes") > limit).alias("oversized"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    pages = pages.select("doc_id", "bytes", "depth", "prefix", F.floor(F.col("i") / F.col("room")).cast("int").alias("page"),
                         "shard_bytes", "shard_docs", "oversized")
    for part in done:
        rows = part.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n", "i")
        pages = pages.unionByName(rows)
    return pages


def directory(assigned: DataFrame) -> DataFrame:
    """The buckets of :func:`assign`: depth, prefix, doc_id (of buckets deeper than the id's bits, which
    hold one id), shard_bytes, shard_docs and global_depth, the deepest of all."""
    one_id = F.when(F.col("depth") > HASH_BITS, F.col("doc_id")).alias("doc_id")
    buckets = assigned.select("depth", "prefix", one_id, "shard_bytes", "shard_docs").distinct()
    deepest = assigned.agg(F.max("depth").alias("global_depth"))
    return buckets.join(F.broadcast(deepest))  # one row


def place(df: DataFrame, buckets: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and the depth and prefix of its bucket in a written :func:`directory`; both null where
    no bucket's prefix is the document's (nothing hashed there yet)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc = F.col(id_col).cast("long")
    rows = df.select(F.monotonically_increasing_id().alias("row"), doc.alias("doc_id"),
                     hash60(F.coalesce(doc.cast("string"), F.lit("null"))).alias("h1"), hash60(text).alias("h2"))
    rows = materialise(rows, "shard-place")
    depths = sorted(r[0] for r in buckets.select("depth").distinct().collect())  # no more than there are bits
    bits = lambda h, n: F.shiftright(h, HASH_BITS - n) if n else F.lit(0).cast("long")
    keys = [F.struct(F.lit(n).alias("depth"), (bits("h1", n) if n <= HASH_BITS else bits("h2", n - HASH_BITS)).alias("prefix"),
                     (F.col("doc_id") if n > HASH_BITS else F.lit(None).cast("long")).alias("one_id")) for n in depths]
    if not keys:
        return rows.select("doc_id", F.lit(None).cast("int").alias("depth"), F.lit(None).cast("long").alias("prefix"))
    known = buckets.select(F.col("depth").alias("k"), F.col("prefix").alias("p"), F.col("doc_id").alias("d"))
    met = rows.select("row", F.inline(F.array(*keys))).join(
        known, (F.col("depth") == F.col("k")) & (F.col("prefix") == F.col("p")) & F.col("one_id").eqNullSafe(F.col("d")))
    return rows.select("row", "doc_id").join(met.select("row", "depth", "prefix"), "row", "left").drop("row")

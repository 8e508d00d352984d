"""Line dedup with levelled sorted runs of line hashes (operator 11).

A line's key is the line without white space at either end, A-Z in lower case. Keys that occur
in at least ``least`` documents lose all their lines in every document.

The index (:class:`LineRuns`) is a set of runs: tables (h, n) of line hashes, one row a hash,
and the number of documents counted for it, bucketed and sorted by hash, so that runs meet
each other and a batch without being shuffled. A batch of documents is counted, one row a
hash; it merge-anti-joins the runs' closed hashes (those that have reached ``least``, which need no more
counting) and the rest becomes a run of level 0. Whenever a level has ``FAN`` runs they are
merged, counts added, into one run of the next level; what reaches ``least`` there is closed
from then on. So a batch is written once per level, and a search meets few runs. Counts of
closed hashes are lower bounds; all others are exact.

``drop_common`` deals the documents to batches by a hash of their text, adds them one after the other,
and then looks all lines up. Batches only change the work: a hash is frequent if the counts
of all runs add up to ``least``.

Hashes have 128 bits (MD5). A text is named by its own MD5 digest; copies of a text share one
row of dropped line numbers. Frequent hashes are broadcast only if they are at most ``FEW``;
else AQE splits a skewed hash, of which the frequent side has one row. The text's join with its
dropped lines broadcasts the rows of texts with very many copies, fewer than ``HOT``.

Cases: a null or empty text is one empty line; a key shorter than ``shortest`` is never dropped,
so empty lines and lines of white space stay; every row is a document of its own, also if rows
repeat; a key counts once a document; null ids are kept; an empty table gives an empty
result; other columns are neither read nor returned.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.llm.common import join_by_key, materialise, shared_path, shuffle_partitions

SPACE = " \t\n\x0b\x0c\r"
A_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FAN = 2
BATCHES = 4
FEW = 500_000


class LineRuns:
    """Levelled sorted runs (h, n) below a new folder of the shared one. The tables are known to the
    session's catalog under names that are never reused (buckets are a property of tables)."""

    def __init__(self, spark: SparkSession, least: int, buckets: int | None = None, fan: int = FAN):
        self.spark, self.least, self.fan = spark, least, fan
        self.buckets = buckets or shuffle_partitions(spark)
        self.root = shared_path(spark, "line-runs")
        self.levels: list[list[str]] = []

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (counts.repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").sortBy("h")
         .option("path", f"{self.root}/{name}").saveAsTable(name))
        return name

    def add(self, counts: DataFrame) -> None:
        """Add a batch: (h, n), one row a hash."""
        for name in self.runs():
            closed = self.spark.table(name).where(F.col("n") >= self.least).select("h")
            counts = counts.hint("merge").join(closed.hint("merge"), "h", "left_anti")
        self._push(self._write(counts), 0)

    def _push(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fan:
            full, self.levels[level] = self.levels[level], []
            self._push(self._write(self._merged(full)), level + 1)

    def _merged(self, names: list[str]) -> DataFrame:
        rows = self.spark.table(names[0])
        for other in names[1:]:  # a merge of sorted runs, bucket by bucket
            right = self.spark.table(other).select("h", F.col("n").alias("more"))
            rows = rows.hint("merge").join(right.hint("merge"), "h", "full").select(
                "h", (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"))
        return rows

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def counts(self) -> DataFrame:
        """(h, n) of all hashes; n of a closed one is a lower bound of ``least`` or more."""
        if not self.runs():
            return self.spark.createDataFrame([], "h binary, n long")
        return self._merged(self.runs())

    def frequent(self) -> DataFrame:
        return self.counts().where(F.col("n") >= self.least).select("h")

    def forget(self) -> None:
        """Take the runs out of the catalog; their files stay in the shared folder."""
        for name in self.runs():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    low = F.translate(F.coalesce(text, F.lit("")), *A_Z)
    return F.transform(F.split(low, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)))


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def count_lines(docs: DataFrame, batches: int, shortest: int) -> DataFrame:
    """(batch, h, n): in how many documents (rows of ``docs``, column text) of a batch a key occurs."""
    each = F.array_distinct(F.filter(keys(F.col("text")), lambda k: F.length(k) >= shortest))
    batch = F.pmod(F.xxhash64("text"), F.lit(batches)).cast("int").alias("batch")
    return (docs.select(batch, F.explode(each).alias("k")).select("batch", _hash(F.col("k")).alias("h"))
            .groupBy("batch", "h").agg(F.count(F.lit(1)).alias("n")))


def dropped_lines(docs: DataFrame, frequent: DataFrame, shortest: int) -> DataFrame:
    """(t, copies, at): the line numbers that a text loses, for texts that lose any. ``docs``: (t, text);
    ``frequent``: hashes, a written table."""
    if frequent.count() <= FEW:
        frequent = F.broadcast(frequent)
    found = (docs.select("t", F.posexplode(keys(F.col("text"))).alias("at", "k")).where(F.length("k") >= shortest)
             .select("t", "at", _hash(F.col("k")).alias("h")).join(frequent, "h"))
    once = found.groupBy("t", "at").agg(F.count(F.lit(1)).alias("copies"))  # combines copies before the shuffle
    return once.groupBy("t").agg(F.max("copies").alias("copies"), F.collect_list("at").alias("at"))


def drop_common(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10, shortest: int = 1,
                batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) per row: the text without the lines whose key occurs
    in at least ``least`` documents."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).alias("doc_id"), text.alias("text"), _hash(text).alias("t"))
    counted = shared_path(spark, "line-counts")
    count_lines(docs, batches, shortest).write.partitionBy("batch").parquet(counted)
    counts = spark.read.schema("h binary, n long, batch int").parquet(counted)
    index = LineRuns(spark, least)
    for b in range(batches):
        index.add(counts.where(F.col("batch") == b).select("h", "n"))
    frequent = materialise(index.frequent(), "line-frequent")
    index.forget()
    drops = materialise(dropped_lines(docs, frequent, shortest), "line-drops")
    losing = join_by_key(docs, drops, ["t"], "copies")
    rest = docs.join(F.broadcast(drops.select("t")) if drops.count() <= FEW else drops.select("t"), "t", "left_anti")
    every = losing.unionByName(rest.withColumn("at", F.array().cast("array<int>")))
    rows = every.withColumn("line", lines(F.col("text"))).withColumn("n_lines", F.size("line"))
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("at"))
    kept = F.when(F.size("at") == 0, F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("line", i)), "\n"))
    return rows.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                       F.size("at").cast("long").alias("n_dropped"), kept.alias("kept"))

"""Surrogate keys (L0) without a single-partition window.

Dense mode (dimensions): ``max(existing) + rank in natural-key order``.

1. range-partition the rows on the order keys, sort within each partition and number
   rows locally with ``monotonically_increasing_id`` (partition index in the upper
   bits, row position in the lower bits);
2. write them once, to the shared folder, with partition and position: the sampled
   range bounds, and with them each row's place, are fixed from then on, even if an
   executor is lost;
3. read back one column, the partition, for a count per partition - all that reaches
   the driver; the running offsets go back as a broadcast frame whose size is the
   partition count.

Unique mode (facts, never shown by any report): ``start + monotonically_
increasing_id()`` on the written rows - unique, gaps allowed, like a SERIAL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetdw.session import CODEC, fresh_scratch

_PID = "__pid"
_LOCAL = "__local"


def assign_surrogate_key(df: DataFrame, order_cols: Sequence[str], sk_col: str,
                         start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``sk_col`` = start, start+1, ... following ``order_cols`` ascending."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in order_cols])
              .sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in order_cols])
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_LOCAL, F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    path = fresh_scratch(spark, f"numbered-{sk_col}")
    ranged.write.parquet(path, compression=CODEC)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, running = [], 0
    for row in sorted(counts, key=lambda r: r[_PID]):
        offsets.append((int(row[_PID]), running))
        running += int(row["n"])
    off_df = spark.createDataFrame(offsets or [(0, 0)], f"{_PID} int, __offset long")
    keyed = ranged.join(F.broadcast(off_df), _PID, "inner")
    return keyed.select(
        (F.lit(start) + F.col("__offset") + F.col(_LOCAL)).cast("long").alias(sk_col),
        *[F.col(c) for c in df.columns])


def assign_unique_key(df: DataFrame, sk_col: str, start: int = 1) -> DataFrame:
    """Unique (not dense) key for fact rows; evaluated once when the rows are written."""
    return df.select((F.lit(start) + F.monotonically_increasing_id()).alias(sk_col), *df.columns)

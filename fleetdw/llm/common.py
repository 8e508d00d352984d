"""Small shared helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.session import shared_dir

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors (once per application), so
    that functions run in Python workers can be imported there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):  # not when already running from a shipped archive
        out = os.path.join(tempfile.mkdtemp(prefix="fleetdw-src-"), "fleetdw_src.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


#: Bytes of rows that go to a Python worker at once. Each task holds a batch several times: as Arrow vectors and
#: in a buffer on its way out, as Arrow on its way back, and as Arrow and Python objects in the worker.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches are cut at ``BATCH_BYTES`` (a longer row is one of its own), unless the session says
    otherwise: 10,000 whole texts, which Spark sends at once, may take all of its default of 64 MB."""
    if spark.conf.get(_BATCH_KEY, None) is None:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and
    a lost executor re-runs only the stage at hand."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Keys that hold more than 1/HOT of all rows are fewer than HOT.
HOT = 2000


def join_by_key(rows: DataFrame, keyed: DataFrame, on: list[str], count: str) -> DataFrame:
    """Inner join of ``rows`` with one row per key; ``count``: how many rows a key has. Keys
    that hold more than 1/HOT of the rows are fewer than ``HOT``, so they are broadcast
    and their rows stay where they are; the others are shuffled. Both sides are read
    twice, so they should be tables that are written already."""
    many = F.col(count) * HOT > rows.count()
    hot, cold = F.broadcast(keyed.where(many).drop(count)), keyed.where(~many).drop(count)
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(cold, on))

"""Session helpers: building a local session for tests/bench and resolving the
shared folder used for checkpoints and written intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
#: Of the star store's Parquet files: ids of 30 letters take much less room than with the default.
CODEC = "zstd"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "fleetdw") -> SparkSession:
    """Session for local runs. On a cluster the caller's session is used as is."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


_PRIVATE_DIRS: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    It is read from the session. Only on a ``local`` master, where driver and
    executors are one process, may it be unset: then a temporary folder is
    created, once per SparkContext. Elsewhere each machine would write to its own
    disk, so a missing setting is an error.
    """
    conf = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getConf().get(_CKPT_KEY, None)
    if not conf:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"{_CKPT_KEY} must name a folder that driver and executors share")
        key = id(spark.sparkContext)
        conf = _PRIVATE_DIRS.get(key)
        if conf is None:
            conf = _PRIVATE_DIRS[key] = tempfile.mkdtemp(prefix="fleetdw-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf)
    return conf.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_dir(spark), *parts])


def fresh_scratch(spark: SparkSession, name: str) -> str:
    """A new, never-reused folder name below the shared dir (write-new-then-switch)."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Spark itself resolves ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


#: Up to this size of a written table, what its job leaves behind is not worth a collection.
RELEASE_BYTES = 32 << 20


def release(spark: SparkSession, path: str) -> None:
    """After a job that wrote ``path``: let its shuffle files and broadcasts go, if they can be large. Spark
    deletes them when the driver collects its garbage, which can be long after the next jobs have
    written theirs. Those of the very last job may stay until another has run."""
    fs, p = hadoop_path(spark, path)
    if fs.exists(p) and fs.getContentSummary(p).getLength() > RELEASE_BYTES:
        gc.collect()
        spark._jvm.System.gc()


#: More partitions cost the driver more in shuffle bookkeeping than smaller ones save.
MAX_SHUFFLE_PARTITIONS = 20_000


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for a run over ``input_bytes`` of source data.

    Shuffle partitions are sized so each holds about ``target_partition_bytes``
    before AQE coalescing (never fewer than 2 per core, nor more than
    ``MAX_SHUFFLE_PARTITIONS``: partitions then grow with the input, and spill). The file split and AQE's
    advisory size use the same target, so a task's input fits in executor memory
    and spills stay rare. Skewed partitions (a key holding a third of the rows)
    are split by AQE. Apply with ``spark.conf.set`` before building the star store.
    """
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(2 * cores, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
    }

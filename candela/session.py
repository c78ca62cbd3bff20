"""Session settings and shared storage used by every job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A filled frame has dozens of computed columns; deriving filters from all their combinations
    # takes the optimizer minutes. Filters the jobs need are written out.
    "spark.sql.constraintPropagation.enabled": "false",
    # First rows of a group are cut off before the shuffle for caps of any size in use.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # A block and its history fit in memory, so windows need not go through the spilling buffer.
    "spark.sql.windowExec.buffer.in.memory.threshold": "32768",
}

_local_dir: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL settings the engine relies on; all of them can change at run time."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", name: str = "candela", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        # A feature frame has more generated classes than the default cache of 100 holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # Little data but costly windows: keep all local cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="candela-")
    return _local_dir


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/candela-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Used where a result feeds several branches: the table cuts the lineage, survives lost
    executors and, unlike a cached frame, keeps column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

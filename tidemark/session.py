"""Session helpers: shared work folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 128 * 1024 * 1024
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
DEFAULT_BATCH = "67108864b"
BATCH_BYTES = "8m"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for the Arrow functions, and
    have their batches end at `BATCH_BYTES`, so that a worker holds little beside its models."""
    if spark.conf.get(BATCH_SETTING, DEFAULT_BATCH) == DEFAULT_BATCH:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{package.name}"
    shutil.make_archive(archive, "zip", package.parent, package.name)
    sc.addPyFile(f"{archive}.zip")
    _shipped.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for local masters. A
    cluster without the setting is refused."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir()
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written intermediate table."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back, so that later jobs start from
    files that survive lost executors."""
    spark = df.sparkSession
    path = work_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_by_key(df: DataFrame, key: str) -> DataFrame:
    """`cut_lineage` into a table bucketed and sorted by a key: later groupings by the key, alone or
    among others, read each bucket in a task of its own and shuffle nothing."""
    spark = df.sparkSession
    name = f"stage_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", work_path(spark, "stage")).bucketBy(buckets, key).sortBy(key).saveAsTable(name, format="parquet")
    return spark.table(name)


def broadcast_if_small(
    df: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """Broadcast hint once a bounded count has proven the size, else ``None``."""
    limit = max_bytes // row_bytes
    if limit <= 0:
        return None
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else None


def spread(scan: DataFrame) -> DataFrame:
    """Round-robin a scan with fewer splits than cores before compute-heavy steps; at
    scale a scan has more splits than cores and is returned as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan

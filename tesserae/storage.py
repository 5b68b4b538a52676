"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Seconds that a write takes from which its shuffles are released right after it.
RELEASE_S = 5


def shared_root(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where it is unset, a temporary folder for a local session, whose
    driver and tasks share a disk; on a cluster an error."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tesserae-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete scratch paths through Hadoop's file systems."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, at: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def derived(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet table at path if a complete one is there, else what make() gives, written there first. A write that broke
    off left no mark of success, and is replaced."""
    if not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_bytes(spark: SparkSession, at: str, data: bytes) -> None:
    """A small file, through Hadoop's file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def release(spark: SparkSession) -> None:
    """Has Spark remove the shuffles that no frame needs any more: it does so once the driver collects garbage, which a driver
    with room to spare may put off until the disks are full."""
    spark._jvm.System.gc()


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df as Parquet into the shared folder and read it again: lineage ends there, and a lost
    executor costs no recomputation. Returns the frame and its path, for drop(). What a long write has shuffled
    goes from the disks with it."""
    spark, path, began = df.sparkSession, scratch(df.sparkSession, name), time.monotonic()
    df.write.option("compression", "zstd").parquet(path)
    if time.monotonic() - began >= RELEASE_S:
        release(spark)
    return spark.read.schema(df.schema).parquet(path), path

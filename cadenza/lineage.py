"""Frames that several branches of a plan read."""

from __future__ import annotations

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: ``spark.checkpoint.dir``; where that is unset, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def kept(df: DataFrame) -> DataFrame:
    """The frame computed once, when it is first needed, however often it is used.

    Executors keep it in memory and, beyond that, on their disks; the lineage stays, so what a lost
    executor held is computed again. Nothing runs before the result is asked for.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(df: DataFrame) -> DataFrame:
    """The frame written as a table to the shared folder and read from there.

    For the inputs of long plans: computed once, and not again after an executor loss; what is built on
    it starts from a scan, with its columns pruned and its size known. Writes when called; the shuffle
    files of the write go with its end, not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        # A new frame: the setting counts when a frame is made.
        df.select("*").write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


# Rows travel to Python workers in batches of at most so many bytes.
BATCH_BYTES = 4 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies; on a cluster that lacks it there, ship it with --py-files.

    Batches on the way to the workers are bounded by bytes, unless the session sets a bound of its own.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if bound not in spark.conf.getAll:
        spark.conf.set(bound, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])

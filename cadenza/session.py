"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that matter at any size. Shuffle parallelism belongs to the cluster: set
# spark.sql.adaptive.coalescePartitions.initialPartitionNum to the input size over 128 MB;
# adaptive execution joins small partitions again.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hot keys are split even where that takes another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "cadenza", master: str | None = None, **extra: str) -> SparkSession:
    """Session with ``SETTINGS``; pass ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

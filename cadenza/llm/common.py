"""What the operators of this package share: input columns, stored tables, held-out rows."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Python workers take text in slices of about this many characters, whatever the Arrow batch holds.
SLICE_CHARS = 1_000_000
# Rows travel to Python workers in batches of at most so many bytes: executor and worker hold several copies of a batch.
BATCH_BYTES = 4 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies; on a cluster that lacks it there, ship it with --py-files.

    Batches on the way to the workers are bounded by bytes, unless the session sets a bound of its own.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if bound not in spark.conf.getAll:
        spark.conf.set(bound, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(f"`{name}`")


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: ``spark.checkpoint.dir``; where that is unset, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The frame written as a Parquet table in the shared folder and read from there.

    Cuts the lineage: later jobs survive the loss of any executor without running what is
    before the cut again. So the shuffle files of the write go with its end, not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        # A new frame: the setting counts when a frame is made.
        writer = df.select("*").write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(key: str, divisor: int) -> Column:
    """crc32 of a key's decimal text modulo ``divisor``; null for a null key."""
    return F.pmod(F.crc32(plain(key).cast("string").cast("binary")), F.lit(divisor))


# A fixed number: so many rows at most are broadcast by ``may_be_among``.
ID_BUCKETS = 1 << 20


def may_be_among(rows: DataFrame, key: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose key may be among ``ids`` (a frame of one column), or those whose key is not (``left_anti``).

    Keys are told apart by a hash into a fixed number of buckets, so the broadcast is bounded and
    rows that a join would drop anyway need not be shuffled for it. Null keys are not among them.
    """

    def bucket(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(ID_BUCKETS)).cast("int")

    name = ids.columns[0]
    buckets = ids.select(bucket(plain(name)).alias("id_bucket")).distinct()
    own = F.when(plain(key).isNotNull(), bucket(plain(key)))
    return rows.join(F.broadcast(buckets), own == F.col("id_bucket"), how)


def text_slices(frames: Iterator[pd.DataFrame], text: str = "text") -> Iterator[pd.DataFrame]:
    """The frames in pieces of about ``SLICE_CHARS`` characters, null texts empty; an empty frame as it is."""
    for frame in frames:
        texts = frame[text].where(frame[text].notna(), "")
        frame = frame.assign(**{text: texts})
        ends = texts.str.len().to_numpy(dtype="int64").cumsum()
        if not len(frame):
            yield frame
        start = 0
        while start < len(frame):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(done + SLICE_CHARS, side="right")))
            yield frame.iloc[start:stop]
            start = stop


_remembered: dict[object, object] = {}


def remembered(name: object, build: Callable[[], object]) -> object:
    """What this worker process keeps from task to task: one thing at a time, built when it is not there."""
    if name not in _remembered:
        _remembered.clear()
        _remembered[name] = build()
    return _remembered[name]


def per_row(
    columns: dict[str, Column], setup: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], returns: str, text: str = "text", remembers: bool = False
) -> Column:
    """A struct computed row by row in Python, without sending any other column there.

    ``setup`` runs once per task and returns a function from some rows of the columns, null texts
    empty, to as many rows of the result. Unless it ``remembers`` something itself, what the worker
    process remembers of other operators is given up before.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not remembers:
            _remembered.clear()
        work = setup()
        for part in text_slices(frames, text):
            yield work(part)

    run.__annotations__ = {"frames": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, returns)(F.struct(*[c.alias(n) for n, c in columns.items()]))

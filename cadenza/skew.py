"""Joins and numbering that stay spread out when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.lineage import durable


def same_keys(left: Sequence[Column], right: Sequence[Column], null_safe: bool) -> Column:
    """Equality of two key lists."""
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return condition


def key_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    on: Column | None = None,
) -> DataFrame:
    """Equi-join on equally named keys; the key columns of the right side are dropped.

    A key that is hot on either side, or on both, is cut by Spark while the join runs: adaptive
    execution splits the shuffle partition that holds it and pairs each piece with the other
    side's rows (``session.SETTINGS`` allows that wherever it helps). ``how`` is ``inner`` or ``left``.
    ``on`` adds a condition over columns of both sides.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"key_join does inner and left joins, not {how}")
    for key in keys:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise ValueError(f"key {key} has different types on the two sides")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    right_keys = [F.col(f"_right_{k}") for k in keys]
    condition = same_keys([F.col(k) for k in keys], right_keys, null_safe)
    if on is not None:
        condition = condition & on
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partitioned by key into as many parts as the cluster works on at once.

    Short texts are few bytes but much work, so partition sizes must not decide alone.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(parts, key)


# ``monotonically_increasing_id``: the partition is above these bits, the row within it in them.
ROW_BITS = 33


def positions(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """The rows with their positions 1, 2, 3, … in the given order.

    Rows are cut into ranges, sorted within them, and stored with their place in the range; a row takes the
    numbers of rows of all ranges before its own on top. The rows are stored because ranges come from a
    sample: read again, they would lie elsewhere after the loss of an executor. Rows that are equal in the
    order are numbered as they come.
    """
    at = F.monotonically_increasing_id()
    placed = durable(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at))
    sizes = placed.groupBy(F.shiftright("_at", ROW_BITS).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), F.shiftright("_at", ROW_BITS) == F.col("_range")).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_offset") + place + 1).cast("long").alias(out)
    )


def numbered(df: DataFrame, value: str, out: str, within: Sequence[str] = ()) -> DataFrame:
    """Number distinct non-null values 1, 2, 3, … in their order, per ``within`` group if given.

    No group is sorted as a whole: a value's number is its position among all values less the one
    that its group begins at.
    """
    within = list(within)
    if not within:
        return positions(df, [value], out)
    placed = positions(df, [*within, value], "_position")
    begins = placed.groupBy(*[F.col(k).alias(f"_o_{k}") for k in within]).agg(F.min("_position").alias("_begin"))
    condition = same_keys([F.col(k) for k in within], [F.col(f"_o_{k}") for k in within], True)
    return placed.join(begins, condition).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_position") - F.col("_begin") + 1).alias(out)
    )

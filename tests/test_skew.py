import pytest
from pyspark.sql import functions as F

from cadenza import skew


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_key_join_equals_join(spark, how, null_safe):
    # A third of the rows has key 7, some have no key; one key is missing on the right.
    left = spark.range(3000).select(
        F.col("id").alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40).cast("int").alias("k"),
    )
    right = spark.createDataFrame([(k, f"r{i}") for k in [7, 1, 2, 3, None] for i in range(2)], "k int, w string")
    renamed = right.withColumnRenamed("k", "k2")
    condition = F.col("k").eqNullSafe(F.col("k2")) if null_safe else F.col("k") == F.col("k2")
    want = left.join(renamed, condition, how).drop("k2")
    got = skew.key_join(left, right, ["k"], how, null_safe)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_hot_keys_are_split(spark, hot):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)

    def side(name, is_hot):
        # Half of a hot side has one key, of which the other side has a row.
        odd = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id"))
        rows = spark.range(2000).repartition(8)
        return rows.select((odd if is_hot else F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 512).alias(name))

    try:
        left, right = side("x", hot in ("left", "both")), side("y", hot in ("right", "both"))
        joined = skew.key_join(left, right, ["k"])
        # Both texts are asked for, so that they are shuffled.
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("x"), F.max("y"))
        parts = [r["n"] for r in sizes.collect()]
        assert sum(parts) == {"left": 2000, "right": 2000, "both": 1000 * 1000 + 1000}[hot]
        # The rows of the hot key come out of several tasks.
        assert max(parts) < 0.4 * sum(parts)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_key_join_refuses_other_types(spark):
    with pytest.raises(ValueError, match="different types"):
        skew.key_join(spark.range(1), spark.createDataFrame([("1",)], "id string"), ["id"])


def test_numbering(spark):
    names = [("a", f"n{i}") for i in range(300)] + [("b", "x"), (None, "y"), (None, "z")]
    frame = spark.createDataFrame(names, "g string, v string")
    within = {(r.g, r.v): r.i for r in skew.numbered(frame, "v", "i", ["g"]).collect()}
    assert within == {(g, v): 1 + sum(h == g and w < v for h, w in names) for g, v in names}
    assert {r.v: r.i for r in skew.numbered(frame, "v", "i").collect()} == {v: i + 1 for i, v in enumerate(sorted(v for _, v in names))}
    assert skew.numbered(frame.limit(0), "v", "i", ["g"]).count() == 0


def test_numbering_over_many_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        # A third of the rows shares a value; the second column orders them.
        frame = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id")).alias("v"), F.col("id").alias("w"))
        placed = skew.positions(frame, [F.desc("v"), "w"], "i")
        ranges = placed.inputFiles()
        rows = sorted(placed.collect(), key=lambda r: r.i)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(ranges) >= 8
    assert [r.i for r in rows] == list(range(1, 6001))
    assert [(r.v, r.w) for r in rows] == sorted(((r.v, r.w) for r in rows), key=lambda r: (-r[0], r[1]))

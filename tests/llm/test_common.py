"""What all operators share."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from cadenza.llm import common


def test_batches_for_workers_are_bounded_by_bytes(session):
    texts = session.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(frames):
        for frame in frames:
            yield frame.iloc[:1].assign(n=frame["text"].str.len().sum())[["n"]]

    got = [r.n for r in texts.mapInPandas(sizes, "n long").collect()]
    assert sum(got) == 40 << 20 and max(got) <= common.BATCH_BYTES + (1 << 20)


def test_a_bound_of_the_session_is_kept(session):
    other = session.newSession()
    other.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    common.importable(other)
    assert other.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "8m"


def test_shuffle_files_of_a_stored_frame_go_with_its_write(session):
    def shuffles():
        files = session.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "/shuffle_" in f}

    before, setting = shuffles(), session.conf.get(common.CLEANUP)
    got = common.stored(session.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert sorted(r["count"] for r in got.collect())[0] == 142 and session.conf.get(common.CLEANUP) == setting
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before

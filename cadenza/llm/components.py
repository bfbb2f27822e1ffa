"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every id in an edge; the component is its smallest id.

    Labels start at the smallest neighbour. Each round takes the smallest label among the
    neighbours and then the label of one's label, until nothing changes, so long chains
    shrink by half per round. Every round is a stored table; only the number of changes
    reaches the driver.
    """
    ends = edges.select(F.col(a).alias("id"), F.col(b).alias("other"))
    both = stored(ends.unionByName(ends.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "edges")
    labels = stored(
        both.groupBy("id").agg(F.min("other").alias("least"))
        .select("id", F.least("id", "least").alias("component")),
        "labels",
    )
    while True:
        near = both.join(labels.withColumnsRenamed({"id": "other", "component": "theirs"}), "other").groupBy("id").agg(F.min("theirs").alias("theirs"))
        nearer = labels.join(near, "id").select("id", "component", F.least("component", "theirs").alias("nearer"))
        jumps = labels.select(F.col("id").alias("nearer"), F.col("component").alias("jump"))
        moved = stored(
            nearer.join(jumps, "nearer").select("id", F.least("nearer", "jump").alias("component"), (F.least("nearer", "jump") < F.col("component")).alias("changed")),
            "labels",
        )
        labels = moved.select("id", "component")
        if moved.filter("changed").isEmpty():
            return labels

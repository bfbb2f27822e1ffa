"""Exact top-k search by inner product: tiles of queries and shards, merged as a tree.

Queries are dealt into blocks and candidates into shards. Every block meets every shard in a tile of
its own, which multiplies the two matrices and keeps the best of each query; the lists of a
query are then merged a few at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import plain, stored

QUERY_BLOCK = 1024
SHARD = 4096
# Lists merged at a time.
FAN_IN = 16
# Sums of products below this are exact in doubles, and below the second in longs.
EXACT_DOUBLE = 1 << 53
EXACT_LONG = 1 << 62
GREATEST = (1 << 63) - 1


def quantised(embedding: Column, factor: int = 256) -> Column:
    """Every component as floor(factor * x), at most 2^62 either way; null if one is null or not finite."""
    usable = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    most = F.lit(float(EXACT_LONG))
    return F.when(usable, F.transform(embedding, lambda x: F.floor(F.greatest(-most, F.least(most, x.cast("double") * factor)))))


def tile_scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices; those beyond 2^63 - 1 either way count as that."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(candidates)), dtype=np.int64)
    own, other = (np.abs(m.astype(np.float64)).max(axis=1) for m in (queries, candidates))
    bound = own.max() * other.max() * queries.shape[1]
    if bound < EXACT_DOUBLE / 2:
        return (queries.astype(np.float64) @ candidates.T.astype(np.float64)).astype(np.int64)
    scores = queries @ candidates.T
    # Pairs whose sum may have left the range of longs are added up in whole numbers of any size.
    for i, j in zip(*np.nonzero(np.outer(own, other) * queries.shape[1] >= EXACT_LONG / 2), strict=True):
        scores[i, j] = max(-GREATEST, min(GREATEST, sum(a * b for a, b in zip(queries[i].tolist(), candidates[j].tolist(), strict=True))))
    return scores


def best_places(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores (all, if fewer), greatest first, ties to the smaller place."""
    if len(scores) <= k:
        return np.argsort(-scores, kind="stable")
    # Only what reaches the k-th greatest score is sorted.
    bound = np.partition(scores, len(scores) - k)[len(scores) - k]
    over = np.flatnonzero(scores > bound)
    return np.concatenate([over[np.argsort(-scores[over], kind="stable")], np.flatnonzero(scores == bound)[: k - len(over)]])


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", embedding: str = "embedding", factor: int = 256
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for every query row, its own id left out.

    Ties go to the smaller id; with fewer candidates all are returned. Vectors that are null or hold
    null or non-finite components take no part, nor do rows without an id. A component whose ``factor``-fold
    is beyond 2^62 counts as 2^62, and a score beyond 2^63 - 1 either way as that. Vectors
    are compared with those of equal length. Every row counts: repeated rows are candidates as often as they occur, and
    rows of one id are queries that share one list. Other columns don't matter.
    """
    spark = vectors.sparkSession
    rows = stored(
        vectors.select(plain(key).cast("long").alias("id"), quantised(plain(embedding), factor).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        .filter("id IS NOT NULL AND v IS NOT NULL").groupBy("id", "v", "asks").agg(F.count(F.lit(1)).alias("copies")), "vectors",
    ).withColumn("dim", F.size("v"))
    n, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    # Tiles of bounded size, and enough of them for all the partitions.
    n_shards = max(1, -(-n // SHARD), min(n // 16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    n_blocks = max(1, -(-asking // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("id", "v", F.lit("block")), F.lit(n_blocks)).cast("int")
    shard = F.pmod(F.xxhash64("id", "v", F.lit("shard")), F.lit(n_shards)).cast("int")
    numbers = (F.sequence(F.lit(0), F.lit(n_shards - 1)), F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    asked = rows.filter("asks").select("dim", block.alias("block"), F.explode(numbers[0]).alias("shard"), "id", "v", "copies")
    dealt = rows.select("dim", F.explode(numbers[1]).alias("block"), shard.alias("shard"), F.col("id").alias("other"), F.col("v").alias("w"), F.col("copies").alias("held"))

    def tile(name: tuple, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            candidates = candidates.sort_values("other", kind="stable")
            ids, copies = candidates["other"].to_numpy(), candidates["held"].tolist()
            scores = tile_scores(np.stack(queries["v"].to_list()), np.stack(candidates["w"].to_list()))
            for query, often, row in zip(queries["id"].to_numpy(), queries["copies"].tolist(), scores, strict=True):
                others = np.flatnonzero(ids != query)
                top: list[dict] = []
                for p in others[best_places(row[others], k)].tolist():
                    top += [{"less": -int(row[p]), "id": int(ids[p])}] * min(k, often * copies[p])
                if top:
                    out.append((query, name[2], top[:k]))
        return pd.DataFrame(out, columns=["query_id", "part", "top"])

    keys = ["dim", "block", "shard"]
    lists = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(
        tile, "query_id long, part int, top array<struct<less:bigint,id:bigint>>"
    )
    parts = n_shards
    while True:
        # Lists of at most k entries, FAN_IN of them (or one per vector of the id) in a group.
        lists = lists.groupBy("query_id", F.floor(F.col("part") / FAN_IN).cast("int").alias("part")).agg(
            F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top")
        )
        parts = -(-parts // FAN_IN)
        if parts == 1:
            break
    return lists.select("query_id", F.posexplode("top").alias("at", "t")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("t.id").alias("vec_id"), (-F.col("t.less")).alias("score")
    )

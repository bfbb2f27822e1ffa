"""Exact top-k search against a full sort."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(session, rows):
    return session.createDataFrame([(*r, 0) for r in rows], SCHEMA).selectExpr("*", *[f"'x' AS {c}" for c in ("id", "v", "dim", "block", "shard", "top", "part", "asks", "score")])


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def expected(rows, k):
    """Every row counts, as a query and as a candidate; numbers that no long holds are the nearest ones."""
    most = 2**62
    whole = [(i, [max(-most, min(most, math.floor(256 * float(np.float32(x))))) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for q in sorted({i for i, _ in whole if i % 5 == 0}):
        vectors = [v for i, v in whole if i == q]
        products = [(sum(a * b for a, b in zip(v, c, strict=True)), i) for v in vectors for i, c in whole if i != q and len(c) == len(v)]
        scores = sorted((-max(1 - 2**63, min(2**63 - 1, s)), i) for s, i in products)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return out


@pytest.mark.parametrize("k", [1, 5])
def test_equals_a_full_sort(session, k):
    rng = random.Random(k)
    rows = [(i * 3, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(120)]
    same = rows[7][1]
    rows += [(1000 + i, same) for i in range(30)]  # ties beyond k
    rows += [(2, None), (3, [1.0, None]), (None, [0.5] * 8), (10, [float("nan")] * 8), (20, [float("inf")] * 8), (25, []), (26, []), (35, [1e30] * 8)]
    rows += [(40, [0.25, 0.5]), (45, [1.0, 2.0]), rows[0], rows[0], (rows[0][0], [0.5] * 8)]
    found = topk.top_k(frame(session, rows), F.col("vec_id") % 5 == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == expected(rows, k)


def test_many_tiles(session, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 4)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rng = random.Random(9)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5]) for _ in range(3)]) for i in range(80)]
    assert sorted(map(tuple, topk.top_k(frame(session, rows), F.col("vec_id") % 5 == 0).collect())) == expected(rows, 5)


def test_few_rows(session):
    assert topk.top_k(frame(session, []), F.col("vec_id") % 5 == 0).count() == 0
    assert topk.top_k(frame(session, [(5, [1.0])]), F.col("vec_id") % 5 == 0).count() == 0
    assert [tuple(r) for r in topk.top_k(frame(session, [(5, [1.0]), (6, [0.5])]), F.col("vec_id") % 5 == 0).collect()] == [(5, 1, 6, 256 * 128)]


def test_large_components_stay_exact():
    q, c = np.array([[2**40, 3]]), np.array([[2**20, 1], [2**20, 2], [2**40, 0], [-(2**40), 5]])
    assert topk.tile_scores(q, c).tolist() == [[2**60 + 3, 2**60 + 6, 2**63 - 1, -(2**63) + 1]]
    # Parts that no long holds may cancel.
    assert topk.tile_scores(np.array([[2**50, 2**50, 1]]), np.array([[2**50, -(2**50), 7]])).tolist() == [[7]]


def test_outliers_share_a_tile(session):
    rows = [(5, [1e10, 0.0]), (6, [0.0, 1e10]), (7, [0.5, 0.25]), (8, [3e38, -3e38]), (10, [3e38, 3e38])]
    got = sorted(map(tuple, topk.top_k(frame(session, rows), F.col("vec_id") % 5 == 0).collect()))
    assert got == expected(rows, 5) and (5, 4, 6, 0) in got

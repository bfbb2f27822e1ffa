"""Embedding whitening against plain matrices and whole numbers of any size."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHING = ("key", "x", "n", "dim", "copies", "weight", "digest", "hot", "component", "deviation", "whitened", "explained", "at", "c")


def frame(session, rows):
    return session.createDataFrame([(*r, 0) for r in rows], SCHEMA).selectExpr("*", *[f"'x' AS {c}" for c in CLASHING])


def whole(v):
    return [max(-(2**62), min(2**62, math.floor(64 * float(np.float32(c))))) + 1_000_000 for c in v]


def usable(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v)


def check(session, rows, components=32, multiplicity=True):
    """Deviations, shares and covariance of the result against the rows themselves; the sign of a component is free."""
    got = whitening.whiten(frame(session, rows), components=components, multiplicity=multiplicity)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    used = [(i, whole(v)) for i, v in rows if usable(v)]
    expected = Counter()
    for dim in {len(x) for _, x in used}:
        own = [(i, x) for i, x in used if len(x) == dim]
        fitted = [x for _, x in own] if multiplicity else [list(x) for x in {tuple(x) for _, x in own}]
        n, sums = len(fitted), [sum(col) for col in zip(*fitted, strict=True)]
        c = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in fitted])
        v = c.T @ c / n
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values)[: min(components, dim)]
        for i, x in own:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            centred = np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)])
            for k, j in enumerate(order, 1):
                there = values[j] > 1e-9 * max(values.max(), 1e-300)
                size = round(abs(centred @ vectors[:, j]) / math.sqrt(values[j]), 4) + 0.0 if there else None
                share = round(values[j] / np.trace(v), 6) + 0.0 if there else 0.0
                expected[i, k, n, deviation if deviation < 2**63 else None, size, share] += 1
    found = Counter(
        (r.vec_id, r.component, r.n, r.deviation, None if r.whitened is None else round(abs(r.whitened), 4) + 0.0, round(r.explained, 6) + 0.0) for r in got
    )
    assert found == expected
    assert len({r.identity_error for r in got}) <= 1
    assert all(0 <= r.identity_error <= 1e-4 for r in got)
    return got


@pytest.mark.parametrize("multiplicity", [True, False])
def test_equals_plain_matrices(session, multiplicity):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1 + k) for k in range(6)]) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(120)]  # one vector held by many rows
    rows += [(2, None), (3, [1.0, None]), (None, [0.5, 1.0, -2.0, 0.0, 3.0, 1.5]), (4, [float("nan")] * 6), (5, [float("inf")] * 6), (6, []), rows[0], rows[0]]
    check(session, rows, multiplicity=multiplicity)
    check(session, rows, components=2, multiplicity=multiplicity)


def test_whitened_values_have_unit_covariance(session):
    rng = random.Random(6)
    base = np.array([[rng.gauss(0, 1) for _ in range(40)] for _ in range(40)])
    rows = [(i, (np.array([rng.gauss(0, 1) for _ in range(40)]) @ base).tolist()) for i in range(300)]
    got = check(session, rows)
    assert {r.component for r in got} == set(range(1, 33))
    z = np.zeros((300, 32))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(np.cov(z.T, bias=True) - np.eye(32)).max() < 1e-6


def test_vectors_without_variance(session):
    got = check(session, [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [0.5, 1.0])])
    assert all(r.whitened is None and r.explained == 0 and r.deviation == 0 for r in got) and len(got) == 6
    check(session, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])  # rank one
    check(session, [(7, [0.25])])


def test_lengths_are_fitted_apart(session):
    rng = random.Random(7)
    check(session, [(i, [rng.gauss(0, 2) for _ in range(2 + i % 3)]) for i in range(90)])


def test_large_components(session):
    rows = [(i, [1e30 * (-1) ** i, float(i % 4)]) for i in range(8)]
    got = whitening.whiten(frame(session, rows)).collect()
    assert len(got) == 16 and all(r.deviation is None for r in got)
    centre = whitening.Centre(3, (2**62 * 2, 10))
    x = np.array([[2**62, 5], [2**62, 5], [0, 0]])
    assert centre.deviations(x) == [None, None, None]
    assert np.allclose(centre.centred(x), [[2**62 / 3, 5 / 3], [2**62 / 3, 5 / 3], [-(2**63) / 3, -10 / 3]])


def test_empty_tables(session):
    assert whitening.whiten(frame(session, [])).count() == 0
    assert whitening.whiten(frame(session, [(1, None), (2, [])])).count() == 0

"""Embedding whitening by a covariance over distinct vectors, weighted by how often each occurs.

Vectors are quantised to whole numbers, so copies are equal and meet in one row with their number. Every
distinct vector is centred, multiplied and whitened once; its result is joined back to the rows that hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import plain, stored

FACTOR = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Vectors that hold more than one row in so many are joined by a broadcast: there are fewer of them than that.
HOT_SHARE = 1000
# Eigenvalues below this share of the greatest one are rounding, not variance.
RANK_TOLERANCE = 1e-12
LONG = 1 << 63
SAFE = 1 << 62


def quantised(embedding: Column, factor: int = FACTOR, offset: int = OFFSET) -> Column:
    """Every component c as floor(factor * c) + offset; null if one is null or not finite.

    A factor * c beyond 2^62 counts as 2^62, so that the result fits a long.
    """
    finite = F.forall(embedding, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    most = F.lit(float(SAFE))
    return F.when(
        finite, F.transform(embedding, lambda c: F.floor(F.greatest(-most, F.least(most, c.cast("double") * factor))) + offset)
    )


def matrix(column: pd.Series) -> np.ndarray:
    """Equally long arrays as the rows of a matrix of longs."""
    return np.stack(column.to_list()).astype(np.int64)


def by_length(frame: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    """The frame's rows by the length of their vectors."""
    for dim, part in frame.groupby("dim", sort=False):
        yield int(dim), part


@dataclass(frozen=True)
class Centre:
    """How many vectors of one length a fit has, and their exact sums per dimension."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, from whole numbers, so that nothing cancels in doubles."""
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - self.n * w) / self.n for s, w in zip(self.sums, whole, strict=True)])
        if max(map(abs, whole)) < SAFE and np.abs(x.astype(np.float64)).max(initial=0) < SAFE:
            return (x - np.array(whole, dtype=np.int64)) - rest
        return np.array([[float(int(a) - w) for a, w in zip(row, whole, strict=True)] for row in x]) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S)^2, exact; None where no long holds it."""
        far = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
        bound = self.n * far + max(map(abs, self.sums))
        if bound < SAFE:
            y = self.n * x - np.array(self.sums, dtype=np.int64)
            most = int(np.abs(y).max(initial=0))
            if most * most * len(self.sums) < SAFE:
                return (y * y).sum(axis=1).tolist()
        exact = (sum((self.n * int(a) - s) ** 2 for a, s in zip(row, self.sums, strict=True)) for row in x)
        return [d if d < LONG else None for d in exact]


@dataclass(frozen=True)
class Whitening:
    """Centre, unit eigenvectors by falling eigenvalue, and the share of the variance each explains."""

    centre: Centre
    vectors: np.ndarray  # (dimensions, components)
    values: np.ndarray
    explained: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Centred vectors in units of each component's deviation; NaN for components without variance."""
        real = self.values > 0
        scale = np.where(real, 1 / np.sqrt(np.where(real, self.values, 1)), np.nan)
        return (self.centre.centred(x) @ self.vectors) * scale


def distinct_vectors(rows: DataFrame, multiplicity: bool = True) -> DataFrame:
    """``(digest, dim, x, copies, weight)``: distinct vectors; the weight is the number of copies, or one.

    Copies are counted before the shuffle, so a vector of many rows reaches its task as one row per mapper.
    """
    counted = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.col("copies") if multiplicity else F.lit(1).cast("long")
    return counted.select(vector_digest(F.col("x")).alias("digest"), F.size("x").alias("dim"), "x", "copies", weight.alias("weight"))


def vector_digest(x: Column) -> Column:
    """256 bits that stand for a vector in joins."""
    return F.unhex(F.sha2(F.concat_ws(",", x.cast("array<string>")).cast("binary"), 256))


def centres(distinct: DataFrame) -> dict[int, Centre]:
    """Exact sums of the vectors of every length: one row per dimension reaches the driver."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for frame in frames:
            for dim, part in by_length(frame):
                x, w = matrix(part["x"]), part["weight"].to_numpy()
                total = int(w.sum())
                far = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
                whole = w @ x if far * total < SAFE else w.astype(object) @ x.astype(object)
                n[dim] = n.get(dim, 0) + total
                sums[dim] = [a + int(b) for a, b in zip(sums.get(dim, [0] * dim), whole, strict=True)]
        for dim, own in sums.items():
            yield pd.DataFrame({"dim": dim, "at": range(dim), "n": n[dim], "s": [Decimal(v) for v in own]})

    parts = distinct.select("dim", "x", "weight").mapInPandas(add, "dim int, at int, n long, s decimal(38,0)")
    out: dict[int, dict[int, tuple[int, int]]] = {}
    for r in parts.groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        out.setdefault(r["dim"], {})[r["at"]] = (r["n"], int(r["s"]))
    return {dim: Centre(own[0][0], tuple(own[i][1] for i in range(dim))) for dim, own in out.items()}


def summed_products(rows: DataFrame, columns: list[str], product: Callable[[int, pd.DataFrame], np.ndarray]) -> DataFrame:
    """``(dim, i, j, v)``: the matrices that ``product`` makes of the rows, added up entry by entry.

    Each task adds up its own rows and sends one matrix per length of vectors.
    """

    def multiply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in frames:
            for dim, part in by_length(frame):
                own = product(dim, part)
                total[dim] = total[dim] + own if dim in total else own
        for dim, m in total.items():
            yield pd.DataFrame({"dim": dim, "i": range(len(m)), "line": list(m)})

    lines = rows.select(*columns).mapInPandas(multiply, "dim int, i int, line array<double>")
    entries = lines.select("dim", "i", F.posexplode("line").alias("j", "v"))
    return entries.groupBy("dim", "i", "j").agg(F.sum("v").alias("v"))


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening per length of vectors: centred before multiplying, divided by the number of vectors.

    The eigenvectors of a length are found by one task, from its matrix alone; as many numbers as
    components times dimensions reach the driver.
    """
    known = centres(distinct)

    def product(dim: int, part: pd.DataFrame) -> np.ndarray:
        c = known[dim].centred(matrix(part["x"]))
        return (c * part["weight"].to_numpy(dtype=np.float64)[:, None]).T @ c

    def solve(entries: pd.DataFrame) -> pd.DataFrame:
        dim = int(entries["dim"].iloc[0])
        v = np.zeros((dim, dim))
        v[entries["i"], entries["j"]] = entries["v"] / known[dim].n
        values, vectors = np.linalg.eigh((v + v.T) / 2)
        falling = np.argsort(-values, kind="stable")[:components]
        trace = float(np.trace(v))
        kept = np.where(values[falling] > max(trace, 0) * RANK_TOLERANCE, values[falling], 0.0)
        return pd.DataFrame({
            "dim": dim, "component": range(1, len(falling) + 1), "value": kept, "explained": kept / trace if trace > 0 else 0.0,
            "vector": [vectors[:, k] for k in falling],
        })

    solved = summed_products(distinct, ["dim", "x", "weight"], product).groupBy("dim").applyInPandas(
        solve, "dim int, component int, value double, explained double, vector array<double>"
    )
    found: dict[int, list] = {}
    for r in solved.collect():
        found.setdefault(r["dim"], []).append(r)
    out = {}
    for dim, own in found.items():
        own.sort(key=lambda r: r["component"])
        out[dim] = Whitening(
            known[dim], np.array([r["vector"] for r in own]).T, np.array([r["value"] for r in own]), np.array([r["explained"] for r in own])
        )
    return out


def whitened_vectors(distinct: DataFrame, model: dict[int, Whitening]) -> DataFrame:
    """``(digest, dim, copies, weight, deviation, whitened)`` of every distinct vector."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in by_length(frame):
                x = matrix(part["x"])
                yield part[["digest", "dim", "copies", "weight"]].assign(
                    deviation=pd.array(model[dim].centre.deviations(x), dtype="Int64"), whitened=list(model[dim].whiten(x))
                )

    return distinct.mapInPandas(run, "digest binary, dim int, copies long, weight long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, model: dict[int, Whitening]) -> float:
    """Greatest absolute entry of the whitened vectors' covariance less the identity, over all lengths."""

    def product(dim: int, part: pd.DataFrame) -> np.ndarray:
        z = np.stack(part["whitened"].to_list())[:, model[dim].values > 0]
        ones = np.hstack([np.ones((len(z), 1)), z])
        return (ones * part["weight"].to_numpy(dtype=np.float64)[:, None]).T @ ones

    sums: dict[int, np.ndarray] = {
        dim: np.zeros((1 + int((m.values > 0).sum()),) * 2) for dim, m in model.items()
    }
    for r in summed_products(whitened, ["dim", "whitened", "weight"], product).collect():
        sums[r["dim"]][r["i"], r["j"]] = r["v"]
    worst = 0.0
    for dim, m in sums.items():
        means = m[0, 1:] / model[dim].centre.n
        spread = m[1:, 1:] / model[dim].centre.n - np.outer(means, means)
        worst = max(worst, float(np.abs(spread - np.eye(len(spread))).max(initial=0.0)))
    return worst


def whiten(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, multiplicity: bool = True,
    factor: int = FACTOR, offset: int = OFFSET,
) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` per usable row and component.

    - Vectors that are null or hold null or non-finite entries are dropped. The fit list is all others
      (with ``multiplicity=False``: every distinct one once). Repeated rows and null keys each get their rows.
    - Vectors of different lengths are fitted apart, ``n`` being the number of each length; an empty vector
      has no component. There are as many components as dimensions, ``components`` at most.
    - A component without variance (all vectors equal, fewer vectors than dimensions) explains 0 and has a null
      ``whitened``; the identity error is taken over the others. A ``deviation`` beyond a long is null.
    - Every worker holds ``components`` times as many numbers as a vector has. Other columns don't matter.
    """
    rows = vectors.select(plain(key).alias("key"), quantised(plain(embedding), factor, offset).alias("x")).filter(F.size("x") > 0)
    distinct = stored(distinct_vectors(rows, multiplicity), "vectors")
    model = fit(distinct, components)
    found = stored(whitened_vectors(distinct, model), "whitened")
    error = identity_error(found, model)
    told = {dim: (m.centre.n, m.explained.tolist()) for dim, m in model.items()}
    spark = vectors.sparkSession
    lengths = spark.createDataFrame([(d, n, e) for d, (n, e) in told.items()], "dim int, n long, explained array<double>")
    return joined_back(rows, found).join(F.broadcast(lengths), "dim").select(
        "key", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    ).select(
        F.col("key").alias(key), (F.col("at") + 1).alias("component"), "n", "deviation",
        F.nanvl("c.whitened", F.lit(None).cast("double")).alias("whitened"), F.col("c.explained").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def joined_back(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(key, dim, deviation, whitened)`` of every row, from the result of its distinct vector.

    Vectors with a thousandth of all rows are fewer than a thousand: they are broadcast, and their rows
    are not shuffled. No other vector has enough rows to fill a task.
    """
    total = found.agg(F.sum("copies")).first()[0] or 0
    result = found.select("digest", "dim", "deviation", "whitened", (F.col("copies") * HOT_SHARE > total).alias("hot"))
    keyed = rows.select("key", vector_digest(F.col("x")).alias("digest"))
    hot = F.broadcast(result.filter("hot").select("digest"))
    often = keyed.join(F.broadcast(result.filter("hot")), "digest")
    seldom = keyed.join(hot, "digest", "left_anti").join(result.filter(~F.col("hot")), "digest")
    return often.unionByName(seldom).drop("digest", "hot")

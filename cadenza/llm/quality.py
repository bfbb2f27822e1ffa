"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a text is the logistic of ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pairwise
part is ``1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)``, so it costs as much as the features it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import per_row, plain, text_slices
from cadenza.llm.words import hash_words, joined_bytes

WORD_BITS = 15
FACTORS = 8
# Classes of bytes whose shares are statistics.
CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".,;:!?'\"-()", b"", bytes(range(128, 256)))
STATISTICS = len(CLASSES) + 9
N_FEATURES = (1 << WORD_BITS) + STATISTICS
_class_of = np.full(256, CLASSES.index(b""), dtype=np.int64)
for _i, _members in enumerate(CLASSES):
    _class_of[list(_members)] = _i


@dataclass(frozen=True)
class Features:
    """Sparse rows: where each begins, feature numbers and values; statistics come last in a row."""

    starts: np.ndarray
    index: np.ndarray
    value: np.ndarray


def statistics(texts: list[str], n_chars: np.ndarray, words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Structure of each text and its given length (NaN if unknown), one row a text."""
    data, starts = joined_bytes(texts)
    n = len(texts)
    sizes = np.diff(starts) - 1
    shares = np.bincount(np.repeat(np.arange(n), sizes + 1) * len(CLASSES) + _class_of[data], minlength=n * len(CLASSES)).reshape(n, -1).astype(np.float64)
    shares[:, CLASSES.index(b"\n")] -= 1  # the one that joins the texts
    shares /= np.maximum(sizes, 1)[:, None]
    counts = np.diff(firsts)
    out = np.zeros((n, 9))
    out[:, 0] = np.log1p(sizes)
    out[:, 1] = np.log1p(counts)
    out[:, 2] = sizes / np.maximum(counts, 1)
    for i, (begin, end) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)):
        if end > begin:
            repeats = np.unique(words[begin:end], return_counts=True)[1]
            out[i, 3:5] = len(repeats) / (end - begin), repeats.max() / (end - begin)
        lines = texts[i].split("\n")
        out[i, 5] = 1 - len(set(lines)) / len(lines)
        out[i, 6] = np.log1p(len(texts[i]) / len(lines))
    out[:, 7] = np.where(np.isnan(n_chars), 0.0, np.log1p(np.maximum(np.nan_to_num(n_chars), 0)))
    out[:, 8] = np.isnan(n_chars)
    return np.concatenate([shares, out], axis=1)


def features(texts: list[str], n_chars: np.ndarray) -> Features:
    """Features of whole texts: log counts of hashed words, as a unit vector, and the statistics."""
    words, firsts = hash_words(texts)
    n = len(texts)
    owner = np.repeat(np.arange(n), np.diff(firsts))
    keys, counts = np.unique((owner << WORD_BITS) | (words >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
    row, value = keys >> WORD_BITS, np.log1p(counts)
    value /= np.sqrt(np.maximum(np.bincount(row, value * value, n), 1e-12))[row]
    hashed = np.bincount(row, minlength=n)
    starts = np.concatenate([[0], np.cumsum(hashed + STATISTICS)])
    index, out = np.empty(starts[-1], dtype=np.int64), np.empty(starts[-1])
    at = np.arange(len(keys)) + row * STATISTICS
    index[at], out[at] = keys & ((1 << WORD_BITS) - 1), value
    last = (starts[1:] - STATISTICS)[:, None] + np.arange(STATISTICS)
    index[last] = (1 << WORD_BITS) + np.arange(STATISTICS)
    out[last] = statistics(texts, n_chars, words, firsts)
    return Features(starts, index, out)


@dataclass(frozen=True)
class FactorisationMachine:
    """Weights, factors, and mean and spread of the statistics."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def scaled(self, f: Features) -> np.ndarray:
        """Values with standardised statistics."""
        value = f.value.copy()
        number = f.index - (1 << WORD_BITS)
        own = number >= 0
        value[own] = np.clip((value[own] - self.mean[number[own]]) / self.spread[number[own]], -3, 3) / 3
        return value

    def raw(self, f: Features) -> np.ndarray:
        """The score of each row before the logistic function, in time linear in its features."""
        value = self.scaled(f)
        begins = f.starts[:-1]
        linear = np.add.reduceat(self.weights[f.index] * value, begins)
        terms = self.factors[f.index] * value[:, None]
        return self.bias + linear + 0.5 * (np.add.reduceat(terms, begins) ** 2 - np.add.reduceat(terms * terms, begins)).sum(axis=1)

    def score(self, f: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(f), -30, 30)))


def train(f: Features, labels: np.ndarray, epochs: int = 12, seed: int = 0) -> FactorisationMachine:
    """Fit by Adam on the logistic loss; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    n = len(labels)
    last = (f.starts[1:] - STATISTICS)[:, None] + np.arange(STATISTICS)
    mean, spread = f.value[last].mean(axis=0), f.value[last].std(axis=0) + 1e-6
    model = FactorisationMachine(0.0, np.zeros(N_FEATURES), rng.normal(0, 0.01, (N_FEATURES, FACTORS)), mean, spread)
    value = model.scaled(f)
    weight = n / (2 * np.maximum(np.bincount(labels, minlength=2), 1))
    params = [np.zeros(1), model.weights, model.factors]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            rows = order[at : at + 256]
            sizes = f.starts[rows + 1] - f.starts[rows]
            begins = np.cumsum(sizes) - sizes
            place = np.repeat(f.starts[rows] - begins, sizes) + np.arange(sizes.sum())
            index, x = f.index[place], value[place]
            terms = params[2][index] * x[:, None]
            sums = np.add.reduceat(terms, begins)
            z = params[0][0] + np.add.reduceat(params[1][index] * x, begins) + 0.5 * (sums**2 - np.add.reduceat(terms * terms, begins)).sum(axis=1)
            y = labels[rows]
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight[y] / len(rows)
            each = np.repeat(error, sizes) * x
            slopes = each[:, None] * (np.repeat(sums, sizes, axis=0) - terms)
            grads = [
                np.array([error.sum()]), np.bincount(index, each, N_FEATURES) + 1e-5 * params[1],
                np.stack([np.bincount(index, slopes[:, k], N_FEATURES) for k in range(FACTORS)], axis=1) + 1e-5 * params[2],
            ]
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return FactorisationMachine(float(params[0][0]), params[1], params[2], mean, spread)


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 2500, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", label: str = "quality"
) -> FactorisationMachine | None:
    """Model learned from labelled documents; None if there are none.

    Bounded sample: of each label 0 and 1 the ``per_class`` rows of smallest key hash, however many rows have
    one key. Other labels and null don't count; a key labelled twice counts twice.
    """
    known = labels.select(plain(key).alias("labelled"), plain(label).cast("int").alias("label")).filter("labelled IS NOT NULL")
    order = (F.xxhash64("labelled", F.lit("sample")), F.col("labelled"))
    sample = known.filter("label = 0").orderBy(*order).limit(per_class).unionByName(known.filter("label = 1").orderBy(*order).limit(per_class))
    # At most 2 * per_class rows are broadcast.
    length = plain(n_chars).cast("double") if n_chars else F.lit(None).cast("double")
    rows = docs.select(plain(key).alias("id"), plain(text).alias("text"), length.alias("n_chars")).join(F.broadcast(sample), F.col("id") == F.col("labelled"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in text_slices(frames):
            f = features(part["text"].tolist(), part["n_chars"].to_numpy(dtype=np.float64))
            cut = list(zip(f.starts[:-1].tolist(), f.starts[1:].tolist(), strict=True))
            yield pd.DataFrame({
                "label": part["label"].to_numpy(), "place": part["place"].to_numpy(), "index": [f.index[a:b].astype("<i4").tobytes() for a, b in cut],
                "value": [f.value[a:b].astype("<f8").tobytes() for a, b in cut],
            })

    made = rows.select("label", order[0].alias("place"), "text", "n_chars").mapInPandas(run, "label int, place long, index binary, value binary")
    # Spark keeps no more of a label in any task than it takes in the end.
    within = Window.partitionBy("label").orderBy("place", F.xxhash64("index"), F.xxhash64("value"))
    taken = made.withColumn("number", F.row_number().over(within)).filter(F.col("number") <= per_class).select("label", "index", "value")
    # In an order that does not depend on the tasks.
    found = sorted(tuple(r) for r in taken.collect())
    if not found:
        return None
    starts = np.concatenate([[0], np.cumsum([len(index) // 4 for _, index, _ in found])])
    index, value = (np.frombuffer(b"".join(bytes(r[i]) for r in found), dtype=kind) for i, kind in ((1, "<i4"), (2, "<f8")))
    return train(Features(starts, index.astype(np.int64), value), np.array([label for label, _, _ in found]))


def quality_score(text: Column, n_chars: Column, model: Broadcast) -> Column:
    """The score of a text, 0 to 1; 0.5 without a model. A null text is an empty one, which is scored, too."""

    def setup() -> Callable[[pd.DataFrame], pd.DataFrame]:
        def work(part: pd.DataFrame) -> pd.DataFrame:
            if model.value is None:
                return pd.DataFrame({"score": np.full(len(part), 0.5)})
            return pd.DataFrame({"score": model.value.score(features(part["text"].tolist(), part["n_chars"].to_numpy(dtype=np.float64)))})

        return work

    return per_row({"text": text, "n_chars": n_chars.cast("double")}, setup, "score double")["score"]


def classify(
    docs: DataFrame, model: FactorisationMachine | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text", n_chars: str | None = "n_chars"
) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` (1 from score 0.5 on) of every row's whole text.

    Repeated rows each get their row; other columns don't matter.
    """
    # Its size is fixed by the numbers of features and factors.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    length = plain(n_chars) if n_chars else F.lit(None).cast("double")
    rows = docs.select(F.struct(*[plain(c) for c in keep]).alias("kept"), quality_score(plain(text), length, shared).alias("score"))
    return rows.select("kept.*", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))

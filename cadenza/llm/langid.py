"""Language ID: a byte convolutional network over fixed-length windows of the whole text."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import SLICE_CHARS, per_row, plain

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
UNDETERMINED = "und"
# Windows scored at once; bounds the memory of a task.
BATCH_WINDOWS = 512
HAS_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class ByteConvNet:
    """Filters as one value per offset, byte and filter; then max pooling and one softmax layer."""

    languages: tuple[str, ...]
    filters: tuple[np.ndarray, ...]  # per width: (width, 256, FILTERS)
    weights: np.ndarray  # (pooled filters, languages)
    bias: np.ndarray


def windows_of(texts: list[str], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole texts cut into windows of ``size`` bytes, the last one of each text padded with zeros.

    Returns the windows, the text each belongs to and its number of bytes.
    """
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.array([len(e) for e in encoded], dtype=np.int64)
    counts = -(-lengths // size)
    data = np.frombuffer(b"".join(e.ljust(c * size, b"\0") for e, c in zip(encoded, counts.tolist(), strict=True)), dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return data.reshape(-1, size), owner, np.minimum(size, lengths[owner] - within * size)


def train(texts: list[str], languages: list[str], epochs: int = 8, seed: int = 0) -> ByteConvNet:
    """Fit the network by Adam on one window per text; every language weighs the same."""
    names = tuple(sorted(set(languages)))
    rng = np.random.default_rng(seed)
    x = np.zeros((len(texts), WINDOW), dtype=np.uint8)
    for row, text in zip(x, texts, strict=True):
        b = np.frombuffer(text.encode("utf-8", "surrogatepass")[:WINDOW], dtype=np.uint8)
        row[: len(b)] = b
    y = np.searchsorted(np.array(names, dtype=object), np.array(languages, dtype=object))
    share = (len(y) / len(names)) / np.bincount(y, minlength=len(names))
    params = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    params += [rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))).astype(np.float32), np.zeros(len(names), np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            rows = order[at : at + 64]
            xb, yb, n = x[rows], y[rows], np.arange(len(rows))
            pooled, places = [], []
            for w, table in zip(WIDTHS, params, strict=False):
                z = sum(table[j][xb[:, j : WINDOW - w + 1 + j]] for j in range(w))
                places.append(z.argmax(axis=1))
                pooled.append(np.take_along_axis(z, places[-1][:, None, :], axis=1)[:, 0])
            flat = np.tanh(np.concatenate(pooled, axis=1))
            logits = flat @ params[-2] + params[-1]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[n, yb] -= 1
            p *= (share[yb] / len(rows))[:, None].astype(np.float32)
            back = (p @ params[-2].T) * (1 - flat * flat)
            grads = []
            for k, (w, table) in enumerate(zip(WIDTHS, params, strict=False)):
                g = np.zeros_like(table)
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                columns = np.broadcast_to(np.arange(FILTERS), part.shape)
                for j in range(w):
                    np.add.at(g[j], (xb[n[:, None], places[k] + j], columns), part)
                grads.append(g)
            grads += [flat.T @ p, p.sum(axis=0)]
            step += 1
            for i, g in enumerate(grads):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                params[i] -= 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return ByteConvNet(names, tuple(params[: len(WIDTHS)]), params[-2], params[-1])


class Scorer:
    """The network with the filters of two neighbouring bytes added up beforehand."""

    def __init__(self, net: ByteConvNet) -> None:
        two, three, four = net.filters
        self.net = net
        pairs = [(a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS) for a, b in ((two[0], two[1]), (three[0], three[1]), (four[0], four[1]))]
        self.starts = np.concatenate(pairs, axis=1)
        self.third = three[2]
        self.last = (four[2][:, None, :] + four[3][None, :, :]).reshape(65536, FILTERS)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        """Logits of each window."""
        out = []
        for at in range(0, len(windows), BATCH_WINDOWS):
            x = windows[at : at + BATCH_WINDOWS]
            pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
            begun = self.starts[pairs]
            pooled = [
                begun[:, :, :FILTERS].max(axis=1),
                (begun[:, :-1, FILTERS : 2 * FILTERS] + self.third[x[:, 2:]]).max(axis=1),
                (begun[:, :-2, 2 * FILTERS :] + self.last[pairs[:, 2:]]).max(axis=1),
            ]
            out.append(np.tanh(np.concatenate(pooled, axis=1)) @ self.net.weights + self.net.bias)
        return np.concatenate(out) if out else np.zeros((0, len(self.net.languages)), np.float32)

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Language and probability of each whole text: the byte-weighted mean of its windows' logits."""
        windows, owner, weights = windows_of(texts)
        logits = self.logits(windows) * weights[:, None]
        sums = np.stack([np.bincount(owner, logits[:, k], len(texts)) for k in range(logits.shape[1])], axis=1)
        mean = sums / np.maximum(np.bincount(owner, weights, len(texts)), 1)[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names = np.array(self.net.languages, dtype=object)[best]
        score = p[np.arange(len(best)), best].astype(np.float64)
        for i, text in enumerate(texts):
            if not HAS_LETTER.search(text):
                names[i], score[i] = UNDETERMINED, 0.0
        return names, score


def training_windows(labelled: DataFrame, key: str, text: str, lang: str, per_language: int = 1500) -> DataFrame:
    """``(text, lang)``: a bounded sample of labelled rows, one piece of ``WINDOW`` characters from each.

    About ``per_language`` rows of every language (all, if fewer), chosen by a hash of the key, and
    never more than twice that for all languages together. The piece begins at a place that
    depends on the key, so it may come from anywhere in the text.
    """
    rows = labelled.select(
        plain(key).alias("key"), plain(text).alias("text"), plain(lang).alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    h = F.xxhash64("key", F.lit("sample"))
    place = F.pmod(F.xxhash64("key", F.lit("place")), F.greatest(F.length("text") - WINDOW // 2, F.lit(1)))
    pieces = rows.select(h.alias("h"), "key", F.substring("text", place.cast("int") + 1, F.lit(WINDOW)).alias("text"), "lang")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), per_language / F.col("n"))
    return (
        pieces.join(counts, "lang").filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
        .orderBy("h", "key", "text").limit(2 * per_language * max(1, counts.count()))
        .select("text", "lang")
    )


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 1500) -> ByteConvNet | None:
    """Network learned from labelled rows; None if there are none."""
    sample = training_windows(labelled, key, text, lang, per_language).collect()
    return train([r["text"] for r in sample], [r["lang"] for r in sample]) if sample else None


def prediction(text: Column, net: ByteConvNet | None) -> Column:
    """``struct<lang_pred, score>`` of a text.

    Texts that are null or have no letter get ``und`` and score 0, as all texts do without a network.
    Languages of equal probability: the first in order.
    """

    def setup() -> Callable[[pd.DataFrame], pd.DataFrame]:
        scorer = Scorer(net) if net else None

        def predict(part: pd.DataFrame) -> pd.DataFrame:
            texts = part["text"].tolist()
            names, score = scorer.predict(texts) if scorer else ([UNDETERMINED] * len(texts), [0.0] * len(texts))
            return pd.DataFrame({"lang_pred": names, "score": score})

        return predict

    return per_row({"text": text}, setup, "lang_pred string, score double")


def identify(docs: DataFrame, net: ByteConvNet | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every row, from its whole text (see ``prediction``).

    Repeated rows each get their row; other columns don't matter.
    """
    rows = docs.select(F.struct(*[plain(c) for c in keep]).alias("kept"), prediction(plain(text), net).alias("found"))
    return rows.select("kept.*", "found.lang_pred", "found.score")


def likely(docs: DataFrame, net: ByteConvNet, least: float, text: str = "text") -> DataFrame:
    """The rows whose text has a letter and a language of probability ``least`` or more, all columns as they are.

    Rows pass through a worker as a whole and are not held beside it meanwhile.
    """
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            texts, start = batch.column(at), 0
            ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
            while start < batch.num_rows:
                done = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_CHARS, side="right")))
                names, score = scorer.predict([t or "" for t in texts.slice(start, stop - start).to_pylist()])
                yield batch.slice(start, stop - start).filter(pa.array((names != UNDETERMINED) & (score >= least)))
                start = stop

    return docs.mapInArrow(run, docs.schema)

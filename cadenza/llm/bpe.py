"""Byte-level BPE in two tiers: whole pre-tokens by a minimal perfect hash, the rest by merging bytes.

A pre-token that is a token of the vocabulary is found in one probe of a minimal perfect hash. Any
other one is merged: its bytes form a linked list, and a heap yields the adjacent pair of lowest rank,
the leftmost of equals, until no pair is in the vocabulary.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import per_row, plain, remembered
from cadenza.llm.words import U, mix

STEP = U(0x9E3779B97F4A7C15)
# Pre-tokens a worker process remembers; later and longer ones are looked up anew, which costs time only.
REMEMBERED = 500_000
LONGEST_REMEMBERED = 64


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), dtype=np.uint64, count=len(keys))


@dataclass(frozen=True)
class PerfectHash:
    """Minimal perfect hash by displacement: n keys to the slots 0 to n - 1, one number per bucket.

    A bucket's number is the seed that sends all its keys to free slots; a bucket of one key
    stores ``-1 - slot``.
    """

    seeds: np.ndarray
    n: int

    @staticmethod
    def build(keys: list[bytes]) -> PerfectHash:
        n = len(keys)
        h = _hashes(keys)
        if len(np.unique(h)) < n:
            raise ValueError("two keys have one 64-bit hash, or a key is given twice")
        buckets = max(1, n // 4)
        of = (h % U(buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        firsts = np.searchsorted(of[order], np.arange(buckets + 1))
        sizes = np.diff(firsts)
        seeds = np.zeros(buckets, dtype=np.int64)
        free = np.ones(n, dtype=bool)
        tries = np.arange(256, dtype=np.uint64)
        for b in np.argsort(-sizes, kind="stable"):
            own = h[order[firsts[b] : firsts[b + 1]]]
            if len(own) < 2:
                break
            start = 0
            while True:
                seed = tries + U(start)
                slots = (mix(own[None, :] ^ (seed[:, None] * STEP)) % U(n)).astype(np.int64)
                fits = free[slots].all(axis=1)
                in_order = np.sort(slots, axis=1)
                fits &= (in_order[:, 1:] != in_order[:, :-1]).all(axis=1)
                if fits.any():
                    hit = int(fits.argmax())
                    seeds[b] = start + hit
                    free[slots[hit]] = False
                    break
                start += len(tries)
        alone = np.flatnonzero(sizes == 1)
        seeds[alone] = -1 - np.flatnonzero(free)[: len(alone)]
        return PerfectHash(seeds, n)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash; hashes of other keys get some slot, too."""
        seed = self.seeds[(hashes % U(len(self.seeds))).astype(np.int64)]
        rehashed = (mix(hashes ^ (np.maximum(seed, 0).astype(np.uint64) * STEP)) % U(self.n)).astype(np.int64)
        return np.where(seed < 0, -1 - seed, rehashed)


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging bytes. A heap entry holds the bytes a pair covers, so it is
    out of date exactly when no pair covers them any more."""
    n = len(piece)
    ends = list(range(1, n + 1))  # of the part that starts here, 0 if none does
    before = list(range(-1, n - 1))
    get = ranks.get
    # Rank, begin and end in one number.
    bits = n.bit_length()
    mask = (1 << bits) - 1
    heap = []
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            heap.append(((rank << bits | i) << bits) | (i + 2))
    heapify(heap)
    while heap:
        entry = heappop(heap)
        end = entry & mask
        left = (entry >> bits) & mask
        right = ends[left]
        if not right or right >= end or ends[right] != end:
            continue
        ends[right] = 0
        ends[left] = end
        if end < n:
            before[end] = left
            rank = get(piece[left : ends[end]])
            if rank is not None:
                heappush(heap, ((rank << bits | left) << bits) | ends[end])
        if left:
            previous = before[left]
            rank = get(piece[previous:end])
            if rank is not None:
                heappush(heap, ((rank << bits | previous) << bits) | end)
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return out


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id, the pattern of pre-tokens and the perfect hash of all tokens."""

    tokens: dict[int, bytes]
    pattern: str
    table: PerfectHash
    slot_ids: np.ndarray

    @staticmethod
    def load(path: str, pattern: str) -> Vocabulary:
        """From a file of lines ``base64 token, blank, rank``."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        return Vocabulary.of(ranks, pattern)

    @staticmethod
    def of(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        keys = list(ranks)
        table = PerfectHash.build(keys)
        slot_ids = np.zeros(len(keys), dtype=np.int64)
        slot_ids[table.slots(_hashes(keys))] = np.array(list(ranks.values()))
        return Vocabulary({i: t for t, i in ranks.items()}, pattern, table, slot_ids)


class Encoder:
    """Encodes texts with a vocabulary; remembers the first ``REMEMBERED`` pre-tokens it meets."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.split = regex.compile(vocabulary.pattern).findall
        self.ranks = {t: i for i, t in vocabulary.tokens.items()}
        tokens = [vocabulary.tokens.get(i, b"") for i in range(max(vocabulary.tokens) + 1)]
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.token_ends = np.cumsum([len(t) for t in tokens])
        self.token_begins = self.token_ends - np.array([len(t) for t in tokens])
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 20, dtype=np.int32)
        self.starts = np.zeros(REMEMBERED + 1, dtype=np.int64)

    def ids_of(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pre-tokens: one probe each, then merging for those that are no token."""
        encoded = [p.encode("utf-8", "surrogatepass") for p in pieces]
        found = self.vocabulary.slot_ids[self.vocabulary.table.slots(_hashes(encoded))].tolist()
        tokens = self.vocabulary.tokens
        return [[i] if tokens[i] == e else merge_bytes(e, self.ranks) for i, e in zip(found, encoded, strict=True)]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each array of ids, gathered from all tokens' bytes at once."""
        lengths = self.token_ends - self.token_begins
        every = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
        sizes = lengths[every]
        ends = np.cumsum(sizes)
        data = self.token_bytes[np.repeat(self.token_begins[every] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))].tobytes()
        edges = np.concatenate([[0], ends])[np.cumsum([0, *map(len, ids)])].tolist()
        return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        pieces = [self.split(t) for t in texts]
        known = self.known
        new = sorted({p for piece in pieces for p in piece if p not in known}, key=len)
        # New pre-tokens lie behind the remembered ones; what does not fit is forgotten after these texts.
        ids = self.ids_of(new)
        first, begin = len(known), int(self.starts[len(known)])
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        more = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(lengths.sum()))
        flat = np.concatenate([self.flat[:begin], more])
        starts = np.concatenate([self.starts[: first + 1], begin + np.cumsum(lengths)])
        known.update(zip(new, range(first, first + len(new))))
        out = []
        for piece in pieces:
            index = np.fromiter(map(known.__getitem__, piece), dtype=np.int64, count=len(piece))
            begins = starts[index]
            lengths = starts[index + 1] - begins
            out.append(flat[np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))])
        kept = 0
        for p in new:
            if first + kept >= REMEMBERED or len(p) > LONGEST_REMEMBERED:
                break
            kept += 1
        for p in new[kept:]:
            del known[p]
        self.starts[: first + kept + 1] = starts[: first + kept + 1]
        end = int(starts[first + kept])
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(end, dtype=np.int32)])
        self.flat[begin:end] = flat[begin:end]
        return out


def worker_encoder(shared: Broadcast) -> Encoder:
    """The encoder of this worker process, which keeps what it remembers from task to task."""
    return remembered(("bpe", id(shared.value)), lambda: Encoder(shared.value))


def token_ids(text: Column, vocabulary: Broadcast) -> Column:
    """The token ids of a whole text as an array; none for a null or empty text.

    No special tokens: their strings are ordinary text.
    """

    def setup() -> Callable[[pd.DataFrame], pd.DataFrame]:
        encoder = worker_encoder(vocabulary)
        return lambda part: pd.DataFrame({"ids": encoder.encode(part["text"].tolist())})

    return per_row({"text": text}, setup, "ids array<int>", remembers=True)["ids"]


def decoded(ids: Column, vocabulary: Broadcast) -> Column:
    """The bytes of an array of token ids; null for null. An unknown id fails the job."""

    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = vocabulary.value.tokens
        for series in frames:
            yield series.map(lambda x: None if x is None else b"".join(map(tokens.__getitem__, x.tolist())))

    run.__annotations__ = {"frames": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "binary")(ids)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` and ``decoded``: every row's whole text encoded, and decoded from its ids.

    Repeated rows each get their row; other columns don't matter.
    """
    # Its size is that of the vocabulary.
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def setup() -> Callable[[pd.DataFrame], pd.DataFrame]:
        encoder = worker_encoder(shared)

        def work(part: pd.DataFrame) -> pd.DataFrame:
            ids = encoder.encode(part["text"].tolist())
            return pd.DataFrame({"ids": ids, "decoded": encoder.decode(ids)})

        return work

    # Both ways in one visit of a worker, so the ids travel once.
    both = per_row({"text": plain(text)}, setup, "ids array<int>, decoded binary", remembers=True)
    return docs.select(F.struct(*[plain(c) for c in keep]).alias("kept"), both.alias("both")).select("kept.*", "both.ids", "both.decoded")


def digests(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, number of ids, and digests of the ids and the decoded bytes of a round trip."""
    return rows.select(
        *[plain(c) for c in keep], F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

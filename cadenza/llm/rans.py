"""Token files: ids in blocks of an interleaved range asymmetric numeral system with one static table.

A file set is a folder with two tables. ``frequencies`` has the scaled frequency of every symbol
and is shared by all blocks. ``blocks`` has a row per block, in order of ``part`` and ``block``:
the documents it holds, the code words, the states of all lanes at every checkpoint, and the crc32 of
the ids from each checkpoint to the next. Blocks are decoded independently, a block from any of
its checkpoints on.

Symbol ``i`` of a block belongs to lane ``i mod lanes``. A state lies in [2**31, 2**63) and moves 32
bits at a time to or from the block's words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import plain, stored, text_slices
from cadenza.llm.tokens import worker_encoder

U = np.uint64
SCALE_BITS = 20
LOW = U(1 << 31)
LANES = 2048
# A block is closed when it holds as many ids; a document is never split.
BLOCK_IDS = 1 << 19
CHECKPOINT_ROWS = 128


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies proportional to the counts that sum up to 2**SCALE_BITS, at least 1 where a count is."""
    total = 1 << SCALE_BITS
    present = np.flatnonzero(counts)
    if len(present) > total:
        raise ValueError(f"more than {total} symbols")
    out = np.zeros(len(counts), dtype=np.int64)
    if not len(present):
        return out
    # One each, and the rest by largest remainder.
    share = counts[present].astype(np.float64) / counts[present].sum() * (total - len(present))
    whole = np.floor(share).astype(np.int64)
    order = np.argsort(-(share - whole), kind="stable")
    short = total - len(present) - int(whole.sum())
    whole[order[:short]] += 1
    out[present] = whole + 1
    return out


@dataclass(frozen=True)
class Table:
    """Frequencies, where each symbol's slots begin, and the symbol of every slot."""

    frequencies: np.ndarray
    begins: np.ndarray
    slots: np.ndarray

    @staticmethod
    def of(frequencies: np.ndarray) -> Table:
        f = frequencies.astype(np.uint64)
        return Table(f, np.cumsum(f) - f, np.repeat(np.arange(len(f), dtype=np.uint32), frequencies))


@dataclass(frozen=True)
class Block:
    """The code of some symbols; entry k of positions, states and checksums is checkpoint k."""

    n: int
    lanes: int
    words: np.ndarray
    positions: np.ndarray
    states: np.ndarray
    checksums: np.ndarray


def lanes_for(n: int) -> int:
    """A power of two that leaves every lane about 64 symbols or more."""
    return max(1, min(LANES, 1 << max(0, (n // 64).bit_length() - 1)))


def encode_block(ids: np.ndarray, table: Table) -> Block:
    """Encode from the last row of symbols to the first, so that decoding runs forwards."""
    n = len(ids)
    lanes = lanes_for(n)
    rows = -(-n // lanes)
    states = np.full(lanes, LOW, dtype=np.uint64)
    # The greatest state that still has room for a symbol of this frequency.
    f, begin = table.frequencies[ids], table.begins[ids]
    if not f.all():
        raise ValueError("a symbol has no frequency")
    words: list[np.ndarray] = [np.zeros(0, np.uint32)] * rows
    checkpoints = []
    for row in range(rows - 1, -1, -1):
        own = slice(row * lanes, min(n, (row + 1) * lanes))
        fr = f[own]
        x = states[: len(fr)]
        full = x >= fr << U(63 - SCALE_BITS)
        words[row] = x[full].astype(np.uint32)
        x = np.where(full, x >> U(32), x)
        q = x // fr
        states[: len(fr)] = (q << U(SCALE_BITS)) + (x - q * fr) + begin[own]
        if row % CHECKPOINT_ROWS == 0:
            checkpoints.append(states.copy())
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words])])[: max(rows, 1)][::CHECKPOINT_ROWS]
    step = CHECKPOINT_ROWS * lanes
    sums = [zlib.crc32(ids[at : at + step].astype("<u4").tobytes()) for at in range(0, n, step)]
    return Block(
        n, lanes, np.concatenate(words) if rows else np.zeros(0, np.uint32), starts[: len(checkpoints)].astype(np.int64),
        np.array(checkpoints[::-1], dtype=np.uint64).reshape(-1, lanes), np.array(sums, dtype=np.int64),
    )


def decode_block(block: Block, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The symbols from checkpoint ``first`` up to checkpoint ``last``; checks every checksum on the way."""
    last = len(block.positions) if last is None else last
    step = CHECKPOINT_ROWS * block.lanes
    begin, end = first * step, min(block.n, last * step)
    out = np.empty(max(0, end - begin), dtype=np.uint32)
    if not len(out):
        return out
    states, at = block.states[first].copy(), int(block.positions[first])
    mask = U((1 << SCALE_BITS) - 1)
    for row_begin in range(begin, end, block.lanes):
        size = min(block.lanes, end - row_begin)
        x = states[:size]
        slot = x & mask
        symbols = table.slots[slot]
        out[row_begin - begin : row_begin - begin + size] = symbols
        x = table.frequencies[symbols] * (x >> U(SCALE_BITS)) + slot - table.begins[symbols]
        short = np.flatnonzero(x < LOW)
        x[short] = (x[short] << U(32)) | block.words[at : at + len(short)]
        at += len(short)
        states[:size] = x
    for k in range(first, last):
        part = out[(k - first) * step : (k - first + 1) * step]
        if zlib.crc32(part.astype("<u4").tobytes()) != block.checksums[k]:
            raise ValueError(f"checksum of checkpoint {k} is wrong")
    return out


# Of each text, so many characters help to range-partition; a sample of them reaches the driver.
RANGE_CHARS = 200
HEAD = "part int, block int, n long, before long, keys array<long>, lengths array<long>"
RAW = HEAD + ", ids binary, counts binary"
CODED = HEAD + ", lanes int, words binary, positions binary, states binary, checksums binary"
HEAD_COLUMNS = ["part", "block", "n", "before", "keys", "lengths"]


def tokenised(docs: DataFrame, tokenizer_json: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of documents in ascending order of key, with their ids (end id included), uncoded."""
    # Its size is that of the tokenizer.
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = worker_encoder(shared.value)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        size = 0
        squeeze = zstandard.ZstdCompressor(level=1).compress

        def closed() -> pd.DataFrame:
            every = np.concatenate(ids).astype("<u4")
            # A block may hold one document of any length, so its counts are longs; nearly all their bytes are zero.
            counts = squeeze(np.bincount(every).astype("<i8").tobytes())
            return pd.DataFrame([(part, block, size, before, keys, [len(i) for i in ids], squeeze(every.tobytes()), counts)], columns=[*HEAD_COLUMNS, "ids", "counts"])

        for piece in text_slices(frames):
            for k, own in zip(piece["key"].tolist(), encoder.encode(piece["text"].tolist()), strict=True):
                keys.append(None if k is None else int(k))
                ids.append(np.append(own, np.uint32(end_id)))
                size += len(ids[-1])
                if size >= BLOCK_IDS:
                    yield closed()
                    keys, ids, size, block, before = [], [], 0, block + 1, before + size
        if keys:
            yield closed()

    # By key and how the text begins, which agrees with the order by key and text: rows of one key can be dealt to many tasks.
    rows = docs.select(plain(key).cast("long").alias("key"), plain(text).alias("text")).repartitionByRange("key", F.substring("text", 1, RANGE_CHARS))
    # As text, so that neither nulls nor pandas change a long.
    return rows.sortWithinPartitions("key", "text").select(F.col("key").cast("string").alias("key"), "text").mapInPandas(pack, RAW)


def _ids(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="<u4")


def symbol_counts(raw: DataFrame) -> np.ndarray:
    """How often every symbol occurs in all blocks, from the counts of each; as many numbers as the vocabulary has."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, dtype=np.int64)
        for frame in frames:
            for data in frame["counts"]:
                own = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="<i8").copy()
                total, own = (total, own) if len(total) >= len(own) else (own, total)
                total[: len(own)] += own
        present = np.flatnonzero(total)
        yield pd.DataFrame({"symbol": present, "n": total[present]})

    rows = raw.select("counts").mapInPandas(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(int(rows["symbol"].max()) + 1 if len(rows) else 0, dtype=np.int64)
    out[rows["symbol"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def write(docs: DataFrame, path: str, tokenizer_json: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Write a file set of all documents, in ascending order of key, each with the end id at its end.

    A null or empty text is the end id alone. Null keys come first; rows that share a key follow
    each other by text, and each is a document. Other columns don't matter. Without rows the
    set has no block.
    """
    spark = docs.sparkSession
    raw = stored(tokenised(docs, tokenizer_json, end_id, key, text), "uncoded")
    frequencies = scaled(symbol_counts(raw))
    spark.createDataFrame(pd.DataFrame({"symbol": np.flatnonzero(frequencies), "frequency": frequencies[frequencies > 0]}), "symbol long, frequency long").coalesce(1).write.parquet(f"{path}/frequencies")
    shared = spark.sparkContext.broadcast(frequencies)

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table.of(shared.value)
        for frame in frames:
            for row in frame.itertuples(index=False):
                b = encode_block(_ids(row.ids), table)
                yield pd.DataFrame([(
                    row.part, row.block, row.n, row.before, row.keys, row.lengths, b.lanes, b.words.astype("<u4").tobytes(),
                    b.positions.astype("<i8").tobytes(), b.states.astype("<u8").tobytes(), b.checksums.astype("<i8").tobytes(),
                )], columns=[*HEAD_COLUMNS, "lanes", "words", "positions", "states", "checksums"])

    raw.drop("counts").mapInPandas(code, CODED).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``key, start, n_tokens, ids`` of every document of a file set.

    ``start`` is the number of ids of all documents before it, ``ids`` holds little-endian unsigned
    32-bit integers. A block whose checksum is wrong fails the job.
    """
    kept = spark.read.parquet(f"{path}/frequencies").toPandas()
    frequencies = np.zeros(int(kept["symbol"].max()) + 1 if len(kept) else 0, dtype=np.int64)
    frequencies[kept["symbol"].to_numpy(dtype=np.int64)] = kept["frequency"].to_numpy(dtype=np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    # One number per part: as many as the tasks that wrote the set.
    totals = blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    sizes = [r["n"] for r in totals]
    offsets = dict(zip((r["part"] for r in totals), np.concatenate([[0], np.cumsum(sizes)]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast((frequencies, offsets))

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequencies, offsets = shared.value
        table = Table.of(frequencies)
        for frame in frames:
            for row in frame.itertuples(index=False):
                states = np.frombuffer(row.states, dtype="<u8").reshape(-1, row.lanes)
                b = Block(row.n, row.lanes, np.frombuffer(row.words, "<u4"), np.frombuffer(row.positions, "<i8"), states, np.frombuffer(row.checksums, "<i8"))
                data = decode_block(b, table).astype("<u4").tobytes()
                ends = np.cumsum(row.lengths)
                begins = ends - row.lengths
                yield pd.DataFrame({
                    "key": [None if k is None or k != k else str(int(k)) for k in row.keys],
                    "start": begins + row.before + offsets[row.part], "n_tokens": row.lengths,
                    "ids": [data[4 * a : 4 * e] for a, e in zip(begins.tolist(), ends.tolist(), strict=True)],
                })

    # Keys as text, so that neither nulls nor pandas change a long.
    texts = blocks.withColumn("keys", F.col("keys").cast("array<string>"))
    return texts.mapInPandas(decode, "key string, start long, n_tokens long, ids binary").withColumn("key", F.col("key").cast("long"))

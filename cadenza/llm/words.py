"""Words of many texts as 64-bit hashes, computed over the bytes of all texts at once.

A word is a longest run of bytes that are no ASCII white space, A-Z lower-cased. Its hash is a
polynomial over random byte values modulo 2**64, mixed at the end; it depends on the word alone.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
# The inverse of BASE modulo 2**64.
INVERSE = U(pow(int(BASE), -1, 1 << 64))
_values = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
_values[65:91] = _values[97:123]
BYTE_VALUES = _values
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for factor in (BASE, INVERSE):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers, _inverses = both
    return _powers, _inverses


def joined_bytes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as bytes, each followed by a line feed, and where each begins (one more entry than texts)."""
    # A lone surrogate can't be in a Spark string, but must not stop a direct caller.
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(encoded) + 1, dtype=np.int64)
    np.cumsum([len(e) + 1 for e in encoded], out=starts[1:])
    return np.frombuffer(b"\n".join(encoded) + b"\n" if encoded else b"", dtype=np.uint8), starts


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end (exclusive) of every word, and where each text's words begin in that list."""
    inside = ~SPACE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    return begins, ends, np.searchsorted(begins, starts)


def hash_words(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one more entry than texts)."""
    data, starts = joined_bytes(texts)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    begins, ends, firsts = word_spans(data, starts)
    powers, inverses = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers[: len(data)], dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[begins]) * inverses[begins] + (ends - begins).astype(np.uint64)), firsts


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words of one text; with fewer words, of the whole text as one run."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, U(n), dtype=np.uint64)
    for i in range(n):
        out = mix(out * BASE + words[i : len(words) - n + 1 + i])
    return out


def shingle_sets(texts: Sequence[str], n: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``n`` words; none without words."""
    words, firsts = hash_words(texts)
    runs = shingle_hashes(words, n) if len(words) >= n else words[:0]
    out = []
    for begin, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        own = runs[begin : end - n + 1] if end - begin >= n else shingle_hashes(words[begin:end], n)
        out.append(np.unique(own))
    return out

"""Token ids of whole texts by a tokenizer of the ``tokenizers`` library that drops white space.

Such a tokenizer never looks beyond white space, so a text's ids are those of its pieces between white
space, and a piece is encoded once by the library and then remembered.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from cadenza.llm.common import remembered

# Pieces and parts of pieces a worker process remembers; later ones are encoded anew, which costs time only.
REMEMBERED = 600_000
PARTS_REMEMBERED = 300_000
LONGEST_REMEMBERED = 40
# In a piece of these characters the tokenizer's pattern sees runs of letters, single digits and runs of others:
# ASCII without apostrophe and <, and Latin letters, each of which is one letter in lower case, too.
SIMPLE = re.compile(r"[!-&(-;=-~À-ÖØ-öø-įı-ž]+")
# The line feed ends a piece.
PARTS = re.compile(r"[a-zß-öø-ž]+|[0-9]|\n|[^a-zß-öø-ž0-9\n]+")
LETTERS = re.compile(r"[a-z]+")
# Words that tell whether the library's model alone gives what the whole tokenizer gives for words of a-z.
PROBES = ("a", "the", "reading", "zqxjkv", "internationalisation", "mnbvcxzlkjhgfdsapoiuytrewq")


class Numbers(dict):
    """Numbers texts as they come; ``new`` lists those numbered since it was last emptied."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, text: str) -> int:
        number = self[text] = len(self)
        self.new.append(text)
        return number


class Remembered:
    """Texts, numbered as they come, with their ids; all ids are in one array."""

    def __init__(self) -> None:
        self.numbers = Numbers()
        self.flat = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)

    def numbered(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, texts), dtype=np.int64, count=len(texts))

    def numbered_array(self, texts: pa.Array) -> np.ndarray:
        """Like ``numbered``; each text is looked up once, however often the array holds it."""
        coded = texts.dictionary_encode()
        return self.numbered(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]

    def taken(self) -> list[str]:
        """The texts numbered since the last call: the next to ``add``."""
        new, self.numbers.new = self.numbers.new, []
        return new

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def ids(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts of these numbers, one after the other, and where each text's end."""
        return gathered(self.flat, self.starts[index], self.starts[index + 1] - self.starts[index])

    def forget(self, new: list[str], limit: int, longest: int) -> None:
        """Keep those of the last texts that come first, so that numbers stay without gaps."""
        known = len(self.numbers) - len(new)
        kept = 0
        while kept < len(new) and known + kept < limit and len(new[kept]) <= longest:
            kept += 1
        for text in new[kept:]:
            del self.numbers[text]
        self.starts = self.starts[: known + kept + 1]
        self.flat = self.flat[: self.starts[-1]]


def gathered(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of an array, one after the other, and where each ends."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(begins - ends + sizes, sizes) + np.arange(int(sizes.sum()))], ends


class PieceEncoder:
    """Encodes texts piece by piece."""

    def __init__(self, tokenizer_json: str) -> None:
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.pieces = Remembered()
        self.parts = Remembered()
        # What stands before, after and between pieces has number 0 and no ids.
        for known, nothing in ((self.pieces, ""), (self.parts, "\n")):
            known.numbered([nothing])
            known.add(np.zeros(0, np.uint32), np.zeros(len(known.taken()), np.int64))
        self.model = self.tokenizer.model
        self.plain = all(self._by_model(p) == self.tokenizer.encode(p, add_special_tokens=False).ids for p in PROBES)

    def _by_model(self, word: str) -> list[int]:
        """Ids of a word of a-z, which neither the normaliser nor the pre-tokenizer changes."""
        return [t.id for t in self.model.tokenize(word)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens at its ends."""
        if not texts:
            return []
        # White space outside ASCII stays inside of pieces; the library drops it there.
        split = pc.ascii_split_whitespace(pa.array([self._lowered(t) for t in texts], pa.large_string()))
        index = self.pieces.numbered_array(split.flatten())
        new = self.pieces.taken()
        self.pieces.add(*self._ids(new))
        every, ends = self.pieces.ids(index)
        last = split.offsets.to_numpy()[1:]
        out = np.split(every, np.concatenate([[0], ends])[last[:-1]])
        self.pieces.forget(new, REMEMBERED, LONGEST_REMEMBERED)
        return out

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of pieces and how many each has; pieces are put together from parts where the pattern cuts them anyway."""
        matched = [m is not None for m in map(SIMPLE.fullmatch, pieces)]
        simple = np.array(matched, dtype=bool)
        cut = "\n".join(compress(pieces, matched)).lower()
        index = self.parts.numbered_array(pa.array(PARTS.findall(f"{cut}\n") if simple.any() else [], pa.large_string()))
        whole = self.parts.numbered(list(compress(pieces, ~simple)))
        new = self.parts.taken()
        self.parts.add(*self._part_ids(new))
        every, ends = self.parts.ids(np.concatenate([index, whole]))
        ends = np.concatenate([ends[: len(index)][index == 0], ends[len(index) :]])
        sizes = np.diff(ends, prepend=0)
        self.parts.forget(new, PARTS_REMEMBERED, LONGEST_REMEMBERED)
        # In the order of the pieces.
        place = np.empty(len(pieces), dtype=np.int64)
        place[np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)])] = np.arange(len(pieces))
        return gathered(every, (ends - sizes)[place], sizes[place])[0], sizes[place]

    def _part_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of parts and how many each has."""
        by_model = [self.plain and LETTERS.fullmatch(x) is not None for x in parts]
        others = [x for x, word in zip(parts, by_model, strict=True) if not word]
        found = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        ids = [self._by_model(x) if word else next(found).ids for x, word in zip(parts, by_model, strict=True)]
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(lengths.sum())), lengths

    def _lowered(self, text: str) -> str:
        # The tokenizer lower-cases; special tokens are found before that.
        return text.lower() if text.isascii() and "<|" not in text else text


def worker_encoder(tokenizer_json: str) -> PieceEncoder:
    """The encoder of this worker process, which keeps what it remembers from task to task."""
    return remembered(("tokens", hashlib.sha256(tokenizer_json.encode()).hexdigest()), lambda: PieceEncoder(tokenizer_json))

"""Byte-level BPE against a reference implementation, and the perfect hash."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    ranks = {t: i for i, t in vocabulary.tokens.items()}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal():
    keys = [f"k{i}".encode() for i in range(5000)]
    table = bpe.PerfectHash.build(keys)
    assert sorted(table.slots(bpe._hashes(keys)).tolist()) == list(range(5000))
    assert bpe.PerfectHash.build([b"x"]).slots(bpe._hashes([b"x", b"y"])).tolist() == [0, 0]
    with pytest.raises(ValueError):
        bpe.PerfectHash.build([b"x", b"x"])


def test_a_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError):
        bpe.Vocabulary.of({b"a": 0}, ".")


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_encodes_like_the_library(vocabulary, reference, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = bpe.Encoder(vocabulary).encode([text])[0].tolist()
    assert ids == reference.encode_ordinary(text)
    assert b"".join(vocabulary.tokens[i] for i in ids) == text.encode()


def test_memory_of_pre_tokens_changes_nothing(vocabulary, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder = bpe.Encoder(vocabulary)
    for round_ in range(3):
        texts = [f"word{i} {'y' * 70} blorgfrump{i * round_} the" for i in range(40)]
        assert [x.tolist() for x in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]
    assert len(encoder.known) <= 50


def test_documents(documents, vocabulary, reference):
    big = 2**62 + 1
    long = "ab" * 40_000 + " " + "the quick " * 20_000 + "日本語" * 5000
    rows = [(big, "Hello  world\n\n <|endoftext|> it's"), (None, "x"), (2, None), (3, ""), (4, long), (5, "same"), (5, "same"), (6, " \t\x00é😀")]
    trip = bpe.round_trip(documents(rows), vocabulary, keep=("doc_id", "row"))
    assert trip.columns == ["doc_id", "row", "ids", "decoded"]
    got = sorted(((r.doc_id or -1, list(r.ids), bytes(r.decoded)) for r in trip.collect()), key=str)
    assert got == sorted(((i or -1, reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=str)
    digests = {r.doc_id: r for r in bpe.digests(trip, "doc_id").collect()}
    ids = reference.encode_ordinary(long)
    assert digests[4].n_tokens == len(ids)
    assert digests[4].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert digests[2] == (2, 0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())


def test_empty_table(documents, vocabulary):
    assert bpe.digests(bpe.round_trip(documents([]), vocabulary), "doc_id").count() == 0


def test_merging_follows_rank_then_place():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ba": 258, b"aab": 259}
    assert bpe.merge_bytes(b"aaaa", ranks) == [256, 256]
    assert bpe.merge_bytes(b"aaaaa", ranks) == [256, 257]
    assert bpe.merge_bytes(b"aab", ranks) == [259]
    assert np.array(bpe.merge_bytes(b"xyz", ranks)).tolist() == [120, 121, 122]

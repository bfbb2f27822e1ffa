"""Token files: exact round trips, parallel decoding, order, and the tokenizer by pieces."""

from __future__ import annotations

import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadenza.llm import rans, tokens


@pytest.fixture(scope="module")
def tokenizer_json():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def table_for(ids, size=1000):
    return rans.Table.of(rans.scaled(np.bincount(ids, minlength=size)))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 5000), st.integers(1, 999), st.integers(0, 2**32 - 1))
def test_blocks_round_trip(n, symbols, seed):
    ids = (np.random.default_rng(seed).zipf(1.3, n) % symbols).astype(np.uint32)
    table = table_for(ids)
    assert (rans.decode_block(rans.encode_block(ids, table), table) == ids).all()


def test_decoding_starts_at_any_checkpoint(monkeypatch):
    monkeypatch.setattr(rans, "CHECKPOINT_ROWS", 4)
    ids = (np.random.default_rng(1).zipf(1.5, 10_000) % 500).astype(np.uint32)
    table = table_for(ids)
    block = rans.encode_block(ids, table)
    step = 4 * block.lanes
    assert len(block.positions) == -(-10_000 // step) > 5
    parts = [rans.decode_block(block, table, k, k + 1) for k in range(len(block.positions))]
    assert (np.concatenate(parts) == ids).all() and (rans.decode_block(block, table, 3) == ids[3 * step :]).all()


def test_a_changed_word_is_noticed():
    ids = (np.random.default_rng(2).zipf(1.5, 5000) % 500).astype(np.uint32)
    table = table_for(ids)
    block = rans.encode_block(ids, table)
    words = block.words.copy()
    words[10] ^= 1
    with pytest.raises((ValueError, IndexError)):
        rans.decode_block(rans.Block(block.n, block.lanes, words, block.positions, block.states, block.checksums), table)
    with pytest.raises(ValueError):
        rans.encode_block(np.array([999], dtype=np.uint32), table_for(np.array([1])))


def test_frequencies_sum_up():
    for counts in ([1], [1, 0, 10**12], [3] * 1000, [10**9, *[1] * 50_000]):
        f = rans.scaled(np.array(counts))
        assert f.sum() == 1 << rans.SCALE_BITS and ((f > 0) == (np.array(counts) > 0)).all()
    assert rans.scaled(np.zeros(3, dtype=np.int64)).sum() == 0


def test_code_is_near_the_entropy():
    ids = (np.random.default_rng(3).zipf(1.3, 400_000) % 900).astype(np.uint32)
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(ids) / 8
    assert 4 * len(rans.encode_block(ids, table_for(ids)).words) < 1.01 * entropy + 8 * rans.LANES


def test_pieces_encode_like_the_library(tokenizer_json, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    monkeypatch.setattr(tokens, "PARTS_REMEMBERED", 50)
    library = Tokenizer.from_str(tokenizer_json)
    encoder = tokens.PieceEncoder(tokenizer_json)
    rng = random.Random(4)
    letters = "abzAZ019'’ \t\n.,!<|>_-\x1d\xa0éÉßÑñ日`~^́　İΣς"
    texts = ["".join(rng.choices(letters, k=rng.randrange(80))) for _ in range(500)]
    texts += ["<|endoftext|> A<|ENDOFTEXT|>", "it's DON'T 's", "a" * 500, "ΑΣ ΑΣ.", "x" * 39 + " " + "y" * 41, ""]
    for at in range(0, len(texts), 60):
        part = texts[at : at + 60]
        assert [x.tolist() for x in encoder.encode(part)] == [library.encode(t, add_special_tokens=False).ids for t in part]
    assert len(encoder.pieces.numbers) <= 100 and len(encoder.parts.numbers) <= 50


def test_a_piece_is_looked_up_once_a_call(tokenizer_json, monkeypatch):
    encoder = tokens.PieceEncoder(tokenizer_json)
    looked = []
    numbered = tokens.Remembered.numbered
    monkeypatch.setattr(tokens.Remembered, "numbered", lambda self, texts: looked.append(len(texts)) or numbered(self, texts))
    texts = ["the cat 12 12 sat\n" * 50, "a cat sat"] * 20
    assert [x.tolist() for x in encoder.encode(texts)] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(looked) < 30
    assert encoder.encode([]) == []


def write_and_read(session, docs, tokenizer_json):
    path = f"{session.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"
    rans.write(docs, path, tokenizer_json, 1)
    return rans.read(session, path)


def test_files_round_trip(session, documents, tokenizer_json, monkeypatch):
    library = Tokenizer.from_str(tokenizer_json)
    rng = random.Random(5)
    rows = [(i * 37 % 401, " ".join(rng.choices(["the", "Quick", "brown", "fox,", "jümps", "42"], k=rng.randrange(60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (2**62 + 1, "last one"), (-5, "first one"), (7000, "long text " * 40_000), (8000, "same"), (8000, "same"), (8000, "other")]
    found = write_and_read(session, documents(rows), tokenizer_json)
    assert found.columns == ["key", "start", "n_tokens", "ids"]
    at, expected = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert sorted((r.key, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in found.collect()) == expected


def test_null_keys_and_empty_tables(session, documents, tokenizer_json):
    found = write_and_read(session, documents([(5, "b"), (None, "a"), (None, None)]), tokenizer_json)
    assert sorted((r.start, r.key, r.n_tokens) for r in found.collect()) == [(0, None, 1), (1, None, 2), (3, 5, 2)]
    assert write_and_read(session, documents([]), tokenizer_json).count() == 0


def test_rows_of_one_key_are_dealt_to_several_tasks(session, documents, tokenizer_json, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_IDS", 200)
    rows = [(None, f"text {i:04} " + "more " * 30) for i in range(600)] + [(1, "one"), (2, None)]
    before = session.conf.get("spark.sql.adaptive.enabled")
    session.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        blocks = rans.tokenised(documents(rows), tokenizer_json, 1).select("part", "block", "keys", "lengths").collect()
    finally:
        session.conf.set("spark.sql.adaptive.enabled", before)
    parts = sorted((b.part, b.block, b["keys"]) for b in blocks)
    assert len({p for p, _, keys in parts if None in keys}) > 1
    assert [k for *_, keys in parts for k in keys] == [None] * 600 + [1, 2]

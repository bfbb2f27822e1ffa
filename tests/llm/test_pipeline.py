"""The pipeline against brute force, stage by stage, and as a whole."""

from __future__ import annotations

import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from cadenza.llm import bpe
from cadenza.llm.queries import QUERIES
from cadenza.llm.secret_scan import BASE, MORE

SYLLABLES = {"aa": ["bra", "dun", "kel", "mo", "tri", "so"], "bb": ["éche", "lou", "ñi", "zza", "pu", "ré"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(n))


@pytest.fixture(scope="module")
def data(session, tmp_path_factory):
    """A data folder of documents with near copies, leaks, secrets and junk, and a benchmark."""
    rng = random.Random(11)
    folder = str(tmp_path_factory.mktemp("data"))
    items = [(i, prose(rng, "aa", 25)) for i in range(6)]
    rows = []
    for i in range(150):
        lang = rng.choice(sorted(SYLLABLES))
        words = prose(rng, lang, rng.randrange(30, 200)).split()
        if i % 10 == 0:
            words[5:5] = rng.choice(items)[1].split()
        if i % 7 == 0:
            words[9:9] = [f'password="{i:08d}abcd"', "AKIA" + "Q" * 16]
        rows.append([i, " ".join(words), lang, "s", 1])
        if i % 4 == 0:
            copy = list(words)
            if i % 8:
                copy[len(copy) // 2] = "changed"
            rows.append([1000 + i, " ".join(copy), lang, "s", 1])
    rows += [[5000, None, None, None, None], [5001, "", "aa", "s", 0], [5002, "123 456 --", "aa", "s", 10], [5003, prose(rng, "bb", 8000), "bb", "s", 1]]
    rows += [[5004, prose(rng, "aa", 50), None, None, None]] * 2
    session.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    session.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def shingles(text, n=5):
    words = text.encode().lower().split()
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def kept_by_hand(rows, items):
    """(doc_id, text) after language, near-duplicates and decontamination, then secrets replaced."""
    rows = sorted({(i, t) for i, t, *_ in rows if t and any(map(str.isalpha, t))})
    sets = {i: shingles(t) for i, t in rows}
    component = {i: i for i, _ in rows}
    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and 10 * shared >= 8 * len(sets[a] | sets[b]):
                old, new = sorted((component[a], component[b]), reverse=True)
                component = {k: new if v == old else v for k, v in component.items()}
    out = {}
    for i, t in rows:
        leaks = any(10 * len(sets[i] & shingles(x)) >= 8 * len(shingles(x)) for _, x in items)
        if component[i] == i and not leaks:
            spans = sorted((m.start(), m.end()) for r in BASE + MORE for m in re.finditer(r.pattern, t) if len(m[r.group]) >= r.least)
            merged = []
            for start, end in spans:
                if merged and start < merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([start, end])
            for start, end in reversed(merged):
                t = t[:start] + "<secret>" + t[end:]
            out[i] = t
    return out


def test_stages_equal_brute_force(session, data):
    folder, rows, items = data
    docs = session.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    steps = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(session, docs, folder)
        assert docs.columns == columns, name
        path = f"{folder}/{name}.parquet"
        docs.write.parquet(path)
        docs = session.read.parquet(path)
        steps.append({r.doc_id: r for r in docs.collect()})
    language, near, clean, secrets = steps
    assert set(language) == {r[0] for r in rows} - {5000, 5001, 5002}
    expected = kept_by_hand(rows, items)
    assert set(clean) == set(expected) and set(near) > set(clean) and set(near) < set(language)
    assert {i: r.text for i, r in secrets.items()} == expected
    assert any("<secret>" in t for t in expected.values())
    for i, r in secrets.items():
        assert r.n_chars == (len(r.text) if "<secret>" in r.text else clean[i].n_chars)
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in vocabulary.tokens.items()}, special_tokens={})
    got = corpus_pipeline.run(session, folder).collect()
    assert {r.doc_id for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        ids = library.encode_ordinary(expected[r.doc_id])
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(expected[r.doc_id].encode()).hexdigest()


def test_stages_take_empty_tables_and_extra_columns(session, data):
    folder = data[0]
    schema = "doc_id long, text string, lang string, source string, n_chars long, found string, row string, rules string, score string, ids string, redacted string"
    for rows in ([], [(None, "bra dun kel", "aa", "s", 3, *"xxxxxx"), (7, None, "aa", "s", 3, *"xxxxxx"), (8, "sole mo token=abcdefgh", None, "s", 3, *"xxxxxx")]):
        docs = session.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(session, docs, folder)
            assert out.count() == (len(rows) - 1 if rows and name == "language" else len(rows)), name
            assert name == "encoding" or out.columns == docs.columns


def test_filters_judge_rows_by_their_own_text(session, data):
    folder, _, items = data
    rng = random.Random(5)
    texts = [prose(rng, "aa", 40) for _ in range(4)]
    leak = prose(rng, "bb", 20) + " " + items[0][1]
    rows = [
        (1, texts[0]), (1, texts[1]), (1, None), (2, texts[1] + " end"), (3, leak), (3, texts[2]), (3, texts[2]), (None, leak), (None, texts[3]), (None, None), (4, None), (0, leak + " end"),
    ]
    docs = session.createDataFrame([(i, t, "aa", "s", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    near = corpus_pipeline.near_duplicate_stage(session, docs, folder)
    # Near copies: 1 and 3 (of the ids 1 and 2), 4 and 11 (of 3 and 0), 5 and 6 are equal.
    assert sorted(r.n_chars for r in near.collect()) == [0, 1, 2, 5, 7, 8, 9, 10, 11]
    clean = corpus_pipeline.decontamination_stage(session, docs, folder)
    assert sorted(r.n_chars for r in clean.collect()) == [0, 1, 2, 3, 5, 6, 8, 9, 10]


def test_language_stage_without_labels(session):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "bra dun kel", None, "s", 3), (2, "123 --", None, "s", 3), (3, "é", None, "s", 3), (4, None, None, "s", 3), (5, "12", "aa", "s", 3)]
    docs = session.createDataFrame(rows, schema)
    assert sorted(r.doc_id for r in corpus_pipeline.language_stage(session, docs, "").collect()) == [1, 3]


def test_queries_are_registered():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 14)]

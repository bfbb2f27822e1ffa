"""The n-gram join against all pairs, and what stays of each component."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cadenza.llm import ngram_join
from cadenza.llm.ngram_join import Similarity
from cadenza.llm.words import hash_words, shingle_sets


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_force(rows, rule):
    """(size, component) per row, from all pairs."""
    sets = [shingles(t, rule.n) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            shared = len(sets[i] & sets[j])
            if None not in (a, b) and sets[i] and sets[j] and rule.den * shared >= rule.num * len(sets[i] | sets[j]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def corpus(seed):
    """Groups of near copies, chains, a shared passage, exact copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []

    def add(words):
        rows.append((len(rows) * 7 % 1009, " ".join(words)))

    for size in (1, 2, 3, 5, 9, 10, 12, 20, 40, 80, 150, 300):
        base = rng.choices(vocabulary, k=size)
        add(base)
        add(base)
        chain = list(base)
        for _ in range(8):
            # Each step is a near copy of the last one, so the ends are not similar.
            chain = list(chain)
            chain[rng.randrange(size)] = rng.choice(vocabulary)
            if size > 30:
                chain[rng.randrange(size)] = rng.choice(vocabulary)
            add(chain)
    for _ in range(15):
        add(rng.choices(vocabulary, k=30) + passage + rng.choices(vocabulary, k=30))
    for _ in range(40):
        add(passage + rng.choices(vocabulary, k=4))
    return rows


@pytest.mark.parametrize(("rule", "seed"), [(Similarity(3, 90, 100), 1), (Similarity(5, 8, 10), 2), (Similarity(2, 1, 2), 3)])
def test_components_equal_all_pairs(documents, rule, seed):
    rows = corpus(seed)
    found = ngram_join.join(documents(rows), rule)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows, rule)


def test_edge_rows(documents):
    rule = Similarity(3, 90, 100)
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [
        (5, None), (6, ""), (7, " \t\n"), (8, "One two"), (9, "one  TWO"), (10, "one two three"), (None, "one two"), (11, long), (12, long + " y"),
        (13, "a b c d"), (13, "a b c d"), (14, "A b C d"), (15, "Äb c d e"), (16, "äb c d e"),
    ]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.join(documents(rows), rule).collect()}
    assert got[5, 0] == 5 and got[6, 0] == 6 and got[7, 0] == 7
    assert got[8, 1] == got[9, 1] == 8 and got[10, 1] == 10 and got[None, 1] is None
    assert got[11, 29_998] == got[12, 29_999] == 11
    assert got[13, 2] == got[14, 2] == 13
    assert got[15, 2] == 15 and got[16, 2] == 16  # only A-Z is lower-cased


def test_texts_of_one_id_are_one_document(documents):
    rule = Similarity(2, 9, 10)
    rows = [(1, "a b c"), (1, "d e f"), (2, "d e f"), (0, "a b c"), (3, "g h i")]
    got = sorted((r.doc_id, r.component_id) for r in ngram_join.join(documents(rows), rule).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, 0), (3, 3)]


def test_empty_table(documents):
    assert ngram_join.join(documents([]), Similarity()).count() == 0
    assert ngram_join.one_of_each(documents([]), Similarity()).count() == 0


def test_one_of_each(documents):
    rule = Similarity(2, 9, 10)
    docs = documents([(4, "a b c"), (2, "a b c"), (2, "a b c"), (3, "x y z"), (None, "a b c"), (5, None), (6, "")])
    kept = ngram_join.one_of_each(docs, rule)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, "a b c"), (2, "a b c"), (3, "x y z"), (5, ""), (6, "")]


def test_folded_bitmaps_count_differing_bits(session):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(0)
    wide, narrow = rng.integers(-(2**62), 2**62, 8), rng.integers(-(2**62), 2**62, 4)
    frame = session.createDataFrame([(wide.tolist(), narrow.tolist())], "x array<bigint>, y array<bigint>")
    folded = wide[:4] ^ wide[4:]
    expected = sum(int(v & (2**64 - 1)).bit_count() for v in (folded ^ narrow).astype(object))
    assert frame.select(ngram_join.differing_bits(F.col("x"), F.col("y")), ngram_join.differing_bits(F.col("y"), F.col("x"))).first() == (expected, expected)


def test_bands_hold_all_partners():
    for rule in (Similarity(3, 90, 100), Similarity(5, 8, 10), Similarity(2, 1, 2)):
        ends = rule.upper_ends(5000)
        for size in range(1, 2500):
            band = int(np.searchsorted(ends, size))
            largest = rule.den * size // rule.num
            assert largest <= ends[band] or int(np.searchsorted(ends, largest)) == band + 1


def test_word_hashes_depend_on_the_word_alone():
    texts = ["One two ONE", "", " one\x0btwo\x1cx ", "ä Ä", "two"]
    hashes, firsts = hash_words(texts)
    words = [w for t in texts for w in t.encode().lower().split()]
    assert firsts.tolist() == [0, 3, 3, 5, 7, 8]
    by_word = {}
    for w, h in zip(words, hashes.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    assert [len(s) for s in shingle_sets(["a b c d", "a b", "", "a a a a"], 3)] == [2, 1, 0, 1]


def test_all_links_are_found(documents):
    rule = Similarity(3, 90, 100)
    base = [f"v{i}" for i in range(60)]
    # Near copies of different texts, all linked with each other; exact copies; an id with several texts.
    copies = [(2000 + i, " ".join([*base, f"end{i}"])) for i in range(12)]
    rows = [*corpus(4), *copies, copies[3], (3000, copies[3][1]), (3001, "p q r s"), (3001, copies[5][1]), (3002, "p q r s"), (3003, None), (None, copies[0][1])]
    pairs, found = ngram_join.links(documents(rows), rule)
    found = found.collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in sorted(found, key=lambda r: str((r.doc_id, r.n_shingles, r.component_id)))] == brute_force(rows, rule)
    sets = [(i, shingles(t, 3)) for i, t in rows if i is not None and shingles(t, 3)]
    similar = {(s, t) for _, s in sets for _, t in sets if 100 * len(s & t) >= 90 * len(s | t)}
    linked = {}
    for i, s in sets:
        linked.setdefault(i, set()).update(j for j, t in sets if j != i and (s, t) in similar)
    assert {r.doc_id: r.n_links for r in found} == {i: len(linked.get(i, ())) for i, _ in rows}
    assert pairs.count() == sum(s != t for s, t in similar) // 2
    names = {r.set for r in found if r.set}
    assert len(names) == len({s for _, s in sets}) and {x for r in pairs.collect() for x in r} <= names


def test_pairs_of_a_large_group_of_near_copies_grow_with_the_group(documents, monkeypatch):
    rule = Similarity(2, 3, 4)
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = rng.choices(vocabulary, k=100)
    rows = []
    for i in range(160):
        copy = list(base)
        for at in rng.sample(range(100), rng.choice((2, 4, 8, 14))):
            copy[at] = rng.choice(vocabulary)
        rows.append((i * 7 % 1009, " ".join(copy)))
    tested = []

    def counted(df, name, *partition_by):
        out = stored(df, name, *partition_by)
        if name == "sides":
            tested.append(out.count() // 2)
        return out

    stored = ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", counted)
    found = ngram_join.join(documents(rows), rule)
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows, rule)
    # Each document meets a bounded number of others; all similar pairs are thousands.
    sets = [shingles(t, rule.n) for _, t in rows]
    similar = sum(rule.similar(len(s & t), len(s), len(t)) for i, s in enumerate(sets) for t in sets[:i])
    assert sum(tested) < 10 * len(rows) < similar, (tested, similar)

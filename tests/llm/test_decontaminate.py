"""Benchmark decontamination against all pairs."""

from __future__ import annotations

import random

import pytest

from cadenza.llm import decontaminate


def shingles(text, n=5):
    words = [w for w in (text or "").lower().split() if w]
    if not words:
        return set()
    n = min(n, len(words))
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def expected(docs, items, num=8, den=10):
    best = {}
    for d, text in docs:
        for i, test in items:
            wanted = shingles(test)
            shared = len(wanted & shingles(text))
            if wanted and den * shared >= num * len(wanted):
                best[d, i] = max(best.get((d, i), (0,)), (shared / len(wanted), shared, len(wanted)))
    return sorted(((d, i, n, s, c) for (d, i), (c, s, n) in best.items()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(documents, session, seed):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 5, 6, 9, 14, 30, 59])))) for i in range(40)]
    docs = []
    for d in range(120):
        words = rng.choices(vocabulary, k=rng.choice([0, 2, 10, 60, 400]))
        if rng.random() < 0.7:
            passage = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                passage[rng.randrange(len(passage))] = "edited"
            words[len(words) // 2 : len(words) // 2] = passage
        docs.append((d, rng.choice([" ", "\n", "\t  "]).join(words)))
    long = " ".join(rng.choices(vocabulary, k=30_000))
    docs += [(500, None), (None, items[8][1]), (501, long + " " + items[9][1]), (1, items[3][1]), (1, items[3][1])]
    items += [(100, None), (101, ""), (None, items[5][1]), (7, items[12][1]), items[2]]
    tests = session.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS item", "'x' AS h", "'x' AS need")
    found = decontaminate.contaminated(documents(docs), tests)
    assert found.columns == ["doc_id", "item_id", "n_item", "n_shared", "containment"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(docs, items)


def test_empty_tables(documents, session):
    none = session.createDataFrame([], "item_id long, text string")
    some = session.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(documents([(1, "a b c d e f")]), none).count() == 0
    assert decontaminate.contaminated(documents([]), some).count() == 0


def test_a_hot_passage_is_found_everywhere(documents, session):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, f"start {i} {passage} end {i}") for i in range(300)]
    tests = session.createDataFrame([(1, passage)], "item_id long, text string")
    assert decontaminate.contaminated(documents(docs), tests).count() == 300


def test_hashed_shingles_count_like_texts(documents):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    texts = [" ".join(rng.choices("ab", k=k)) for k in range(40)]
    for n in (1, 2, 3, 5, 7, 8):
        rows = documents(list(enumerate(texts))).select(
            "doc_id", F.size(decontaminate.hashed_shingles(F.col("text"), n)).alias("h"), F.size(decontaminate.shingle_texts(F.col("text"), n)).alias("t")
        ).collect()
        assert all(r.h == r.t == len(shingles(texts[r.doc_id], n)) for r in rows)

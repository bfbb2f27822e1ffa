"""The quality classifier on made-up labels, and its linear-time score."""

from __future__ import annotations

import random

import numpy as np

from cadenza.llm import quality


def examples(n=400, seed=0):
    rng = random.Random(seed)
    good, bad = [f"good{i}" for i in range(30)], ["buy", "now", "!!!", "$$$", "click"]
    rows, labels = [], []
    for i in range(n):
        y = rng.random() < 0.7
        words = rng.choices(good if y else good[:5] + bad, k=rng.randrange(5, 80))
        rows.append((i, " ".join(words), None, None, None if i % 5 == 0 else len(" ".join(words))))
        labels.append((i, int(y), 0))
    return rows, labels


def labels_frame(session, labels):
    return session.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_labels(documents, session):
    rows, labels = examples()
    docs = documents(rows, extra=("labelled", "label", "kept"))
    more = [(3, None, 0), (None, 1, 0), (4, 7, 0), (9999, 1, 0)]
    model = quality.fit(docs.filter("doc_id < 250"), labels_frame(session, [x for x in labels if x[0] < 250] + more), per_class=80)
    found = quality.classify(docs.filter("doc_id >= 250"), model, keep=("doc_id", "kept"))
    assert found.columns == ["doc_id", "kept", "score", "predicted"]
    truth = {i: y for i, y, _ in labels}
    got = found.collect()
    assert sum(r.predicted == truth[r.doc_id] for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_the_sample_is_bounded_by_rows(documents, session, monkeypatch):
    rows, labels = examples(100)
    sizes = []
    train = quality.train
    monkeypatch.setattr(quality, "train", lambda f, y: sizes.append(np.bincount(y).tolist()) or train(f, y))
    # One labelled id in very many rows.
    hot = labels[0][0]
    docs = documents([*rows, *[(hot, f"good{i} good{i % 7}") for i in range(3000)]])
    assert quality.fit(docs, labels_frame(session, labels), per_class=40) is not None
    assert sizes == [[min(40, sum(y == k for _, y, _ in labels)) if labels[0][1] != k else 40 for k in (0, 1)]]


def test_edge_rows(documents, session):
    rows, labels = examples(100)
    model = quality.fit(documents(rows), labels_frame(session, labels))
    big = 2**62 + 1
    edge = [(None, "good1"), (big, None), (2, ""), (3, "good1 good2 " * 50_000), (4, "x\n" * 1000), (5, "same"), (5, "same")]
    got = quality.classify(documents(edge), model).collect()
    assert len(got) == len(edge) and {r.doc_id for r in got} == {None, big, 2, 3, 4, 5}
    assert all(np.isfinite(r.score) for r in got)
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    scores = {r.doc_id: r.score for r in got}
    assert scores[big] == scores[2]


def test_nothing_to_learn(documents, session):
    assert quality.fit(documents([(1, "a")]), labels_frame(session, [])) is None
    assert quality.classify(documents([]), None).count() == 0
    assert quality.classify(documents([(1, "a")]), None).first() == (1, 0.5, 1)
    one = quality.fit(documents([(1, "a b")]), labels_frame(session, [(1, 1, 0)]))
    assert quality.classify(documents([(1, "a b")]), one).first().predicted == 1


def test_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    f = quality.features(["one two two", "", "Three!\nThree!\n1"], np.array([3.0, np.nan, 5.0]))
    model = quality.FactorisationMachine(
        0.3, rng.normal(size=quality.N_FEATURES), rng.normal(0, 0.1, (quality.N_FEATURES, quality.FACTORS)), np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS)
    )
    value = model.scaled(f)
    for row, raw in enumerate(model.raw(f)):
        own = slice(f.starts[row], f.starts[row + 1])
        x, index = value[own], f.index[own]
        pairs = sum(model.factors[index[i]] @ model.factors[index[j]] * x[i] * x[j] for i in range(len(x)) for j in range(i))
        assert np.isclose(raw, model.bias + model.weights[index] @ x + pairs)

"""Language ID on made-up languages, and on texts that have none."""

from __future__ import annotations

import random

import numpy as np

from cadenza.llm import langid

SYLLABLES = {"aa": ["bra", "dun", "kel", "mo", "tri"], "bb": ["éche", "lou", "ñi", "zza", "pu"], "cc": ["日本", "語の", "学ぶ", "東"]}


def text(lang, rng, n=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(n))


def labelled(n=300):
    rng = random.Random(3)
    return [(i, text(lang := rng.choice(sorted(SYLLABLES)), rng), lang) for i in range(n)]


def test_learns_languages(documents):
    docs = documents(labelled())
    net = langid.fit(docs.filter("doc_id < 200"), per_language=60)
    found = langid.identify(docs.filter("doc_id >= 200"), net, keep=("doc_id", "lang"))
    assert found.columns == ["doc_id", "lang", "lang_pred", "score"]
    rows = found.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_rows(documents):
    net = langid.fit(documents(labelled()), per_language=60)
    rng = random.Random(4)
    long = text("aa", rng, 60_000)
    big = 2**62 + 1
    rows = [(None, "bra dun"), (big, None), (2, ""), (3, "12 34 !!"), (4, "x"), (5, long), (6, "é" * 255 + "bra"), (7, "same"), (7, "same")]
    got = langid.identify(documents(rows), net).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and big in by_id
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (big, 2, 3))
    assert by_id[5].lang_pred == "aa" and by_id[4].lang_pred in SYLLABLES
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 7}) == 1


def test_whole_texts_count():
    windows, owner, weights = langid.windows_of(["a" * 600, "", "b"])
    assert windows.shape == (4, langid.WINDOW) and owner.tolist() == [0, 0, 0, 2] and weights.tolist() == [256, 256, 88, 1]
    assert (windows != 0).sum() == 601


def test_added_up_filters_are_the_convolution():
    rng = np.random.default_rng(0)
    filters = tuple(rng.normal(size=(w, 256, langid.FILTERS)).astype(np.float32) for w in langid.WIDTHS)
    net = langid.ByteConvNet(("a", "b"), filters, rng.normal(size=(24, 2)).astype(np.float32), np.zeros(2, np.float32))
    x = rng.integers(0, 256, (3, langid.WINDOW)).astype(np.uint8)
    pooled = [
        np.stack([sum(f[j, x[:, t + j]] for j in range(len(f))) for t in range(langid.WINDOW - len(f) + 1)]).max(axis=0) for f in filters
    ]
    assert np.allclose(langid.Scorer(net).logits(x), np.tanh(np.concatenate(pooled, axis=1)) @ net.weights, atol=1e-4)


def test_empty_table_and_nothing_to_learn(documents):
    assert langid.fit(documents([(1, "abc", None)])) is None
    assert langid.identify(documents([]), None).count() == 0
    assert langid.identify(documents([(1, "abc")]), None).first() == (1, "und", 0.0)
    only = langid.fit(documents([(1, "bra dun", "aa")]))
    assert langid.identify(documents([(1, "abc")]), only).first()[:2] == (1, "aa")


def test_number_signs_are_no_letters(documents):
    net = langid.fit(documents(labelled()), per_language=60)
    rows = [(1, "½ ² 3"), (2, "①②"), (3, "Ⅷ _"), (4, "½ é"), (5, "中")]
    got = {r.doc_id: r.lang_pred for r in langid.identify(documents(rows), net).collect()}
    assert {i for i, lang in got.items() if lang == "und"} == {1, 2, 3}


def test_thousands_of_languages(documents):
    rows = [(i, f"word{i % 2000} text", f"l{i % 2000:04}") for i in range(4000)]
    sample = langid.training_windows(documents(rows), "doc_id", "text", "lang", 5).collect()
    assert len({r["lang"] for r in sample}) == 2000 and len(sample) == 4000


def test_likely_rows_are_kept_whole(documents):
    rng = random.Random(9)
    net = langid.fit(documents(labelled()), per_language=60)
    rows = [(1, text("aa", rng)), (2, None), (3, "12"), (None, text("bb", rng), "x", "s", 5), (4, text("aa", rng, 60_000)), (1, text("cc", rng))]
    docs = documents(rows)
    kept = langid.likely(docs, net, 0.3)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in docs.collect() if r.doc_id not in (2, 3))
    assert langid.likely(documents([]), net, 0.3).count() == 0

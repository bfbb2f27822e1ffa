import random

from cadenza.operators import edit, matching


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edit_distance_equals_brute_force(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(0, 9))) for _ in range(220)}
    tokens, terms = sorted(words)[::2], sorted(words)[1::2]
    for k in (0, 1, 2):
        want = {(a, b, distance(a, b)) for a in tokens for b in terms if distance(a, b) <= k}
        rows = edit.edit_distance_pairs(
            spark.createDataFrame([(t,) for t in tokens], "a string"), "a",
            spark.createDataFrame([(t,) for t in terms], "b string"), "b", k,
        ).collect()
        assert {tuple(r) for r in rows} == want
        assert len(rows) == len(want)


def test_edit_distance_matches(spark):
    texts = spark.createDataFrame([("2+ including lenalidomide",), ("Cisplatine, drugs",), (" ",), (None,)], "t string")
    terms = spark.createDataFrame([("cisplatin",), ("lenalidomide",), ("Paclitaxel",), ("medicament",)], "c string")
    got = {tuple(r) for r in edit.edit_distance_matches(texts, "t", terms, "c").collect()}
    assert got == {("2+ including lenalidomide", "lenalidomide"), ("Cisplatine, drugs", "cisplatin")}
    lemmas = spark.createDataFrame([("drugs", "medicament")], "token string, lemma string")
    got = {tuple(r) for r in edit.edit_distance_matches(texts, "t", terms, "c", lemmas=lemmas).collect()}
    assert ("Cisplatine, drugs", "medicament") in got


def test_containment_equals_brute_force(spark):
    rng = random.Random(9)
    words = ["ab", "a", "abc", "ca", "bca", "cab", "b.c", "x"]
    values = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 7))) for _ in range(80)} | {"ab  c", "ab\tc x"})
    units = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(80)} | {"b ca", "c"})
    got = matching.containing_values(
        spark.createDataFrame([("k", u) for u in units], "col string, unit string"),
        spark.createDataFrame([("k", v, v) for v in values] + [("other", "o", "zzz ab")], "col string, value_key string, value string"),
        ["col"],
    ).collect()
    want = {("k", u, v) for u in units for v in values if u in v}
    assert {tuple(r) for r in got} == want
    assert len(got) == len(want)


def test_extract_and_explode(spark):
    rows = [
        (1, "aspirin", "Palictaxel and Surgery", "s1"),
        (2, "x", "Other (Cisplatin) use", "s2"),
        (3, "y", None, "s3"),
        (4, "z", "palictaxel and surgery", "s4"),
        (5, "w", "with alfa 12 | 12+", "s5"),
    ]
    frame = spark.createDataFrame(rows, "id long, component string, note string, study string")
    corpus = spark.createDataFrame([("Paclitaxel",), ("cisplatin",), (None,)], "component string")
    matches, audit = matching.extract_matches(frame, "id", corpus)
    assert {(r.hvc_col, r.unit, r.term, r.row_id) for r in matches.collect()} == {
        ("note", "palictaxel", "paclitaxel", 1), ("note", "palictaxel", "paclitaxel", 4),
    }
    # The unit of row 2 lost its brackets, so no value holds it.
    got = {(r.unit, r.status, r.score, r.repeats) for r in audit.collect()}
    assert got == {
        ("palictaxel", "match", 1.0, 2), ("surgery", "skipped", 0.0, 0),
        ("other cisplatin use", "partial match", 1.0, 0), ("with alfa 12", "no match", 0.0, 0),
        ("12+", "skipped", 0.0, 0),
    }
    exploded = matching.explode_matches(frame, "id", matches)
    assert exploded.count() == 7
    assert {(r.id, r.study) for r in exploded.filter("component = 'paclitaxel'").collect()} == {(1, "s1"), (4, "s4")}
    assert matching.explode_matches(frame, "id", matches, keep_multiplicity=True).count() == 7
    assert [tuple(r) for r in matching.match_counts(matches).collect()] == [("note", 2, 1, 2)]


def test_values_that_hold_a_unit_are_split_once(spark):
    values = ["ab cd ef", "xab cdx", "ab", "zab cd efz", "cd", "ab  cd", "", None, "ef ab"]
    units = ["ab", "ab cd", "b cd e", "cd ef", "ef", "zz", "d"]
    frame = matching.containing_values(
        spark.createDataFrame([(u,) for u in [*units, "ab"]], "unit string"),
        spark.createDataFrame(list(enumerate(values)), "value_key int, value string"),
    )
    got = sorted((r.unit, r.value_key) for r in frame.collect())
    assert got == sorted((u, i) for u in units for i, v in enumerate(values) if v and u in v)
    # The candidates are a stored table: what is left looks up texts, no words.
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_words_of_units_are_no_copies_of_the_unit(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(matching, "durable", lambda df: stored.append(df) or df.localCheckpoint())
    words = ["xylophon", "and", "paclitaxel", "with", "cisplatin", "paclitaxel", "zz"]
    units = spark.createDataFrame([(" ".join(words * 20),), ("zz with xylophon",), ("or cisplatin",), ("",), (None,)], "unit string")
    corpus = spark.createDataFrame([("paclitaxel",), ("cisplatin",)], "component string")
    got = matching.word_matches(units, corpus, "component", 0.8).collect()
    assert {tuple(r) for r in got} == {(" ".join(words * 20), "paclitaxel", 1.0), ("or cisplatin", "cisplatin", 1.0)}
    # A stored table names a unit once.
    assert all(df.count() <= 4 for df in stored if "unit" in df.columns)


def test_candidates_hold_the_words_next_to_the_anchor(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(matching, "durable", lambda df: stored.append(df) or df.localCheckpoint())
    values = ["a longest b", "xa longest bx", "c longest d", "longest", "a  longest b", "x a", "xa by", "a  b", "xa  by", "a b c", "a b c d e"]
    units = ["a longest b", "a longest", "longest b", "a b", "a  b", "a b c d", "a b c d e", "b c"]
    frame = matching.containing_values(
        spark.createDataFrame([(u,) for u in units], "unit string"),
        spark.createDataFrame(list(enumerate(values)), "value_key int, value string"),
    )
    want = sorted((u, i) for u in units for i, v in enumerate(values) if u in v)
    assert sorted((r.unit, r.value_key) for r in frame.collect()) == want
    # All have the same longest word: what the words beside it rule out is no candidate.
    assert stored[-1].columns == ["_id", "value_key"] and stored[-1].count() == len(want)

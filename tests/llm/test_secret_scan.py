"""Secret scans against Python's regular expressions, and the trigram queries they are found by."""

from __future__ import annotations

import random
import re

import pytest

from cadenza.llm import secret_scan
from cadenza.llm.secret_scan import BASE, MORE, Rule
from cadenza.llm.trigrams import trigram_query


def expected(text):
    out = []
    for number, rule in enumerate(BASE + MORE):
        for m in re.finditer(rule.pattern, text or "", re.A):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), number, m.end(), rule.kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out)]


@pytest.mark.parametrize(("pattern", "query"), [
    ("abcd", {("abc", "bcd")}),
    ("AbC", {("abc",)}),
    ("ab", None),
    ("(abc|xyz1)+", {("abc",), ("xyz", "yz1")}),
    ("abc|x", None),
    ("abc[0-9]+def", {("abc", "def")}),
    ("ab?cd", {("abc", "bcd"), ("acd",)}),
    ("[ab]cde?", {("acd",), ("bcd",)}),
    ("(abc)*def", {("def",)}),
    ("[0-9a-f]+", None),
    ("^abc$", {("abc",)}),
    ("a.cdef", {("cde", "def")}),
])
def test_trigram_queries(pattern, query):
    found = trigram_query(pattern)
    assert found == (None if query is None else frozenset(map(frozenset, query)))


def test_every_match_satisfies_its_query():
    rng = random.Random(0)
    for rule in BASE + MORE:
        for text in samples(rng, 300):
            if (m := re.search(rule.pattern, text, re.A)) and rule.query is not None:
                held = {m[0].lower()[i : i + 3] for i in range(len(m[0]))}
                assert any(a <= held for a in rule.query)


def samples(rng, n):
    pieces = [
        "password", "PASSWD", "Secret", "token", "api_key", "apikey", "API_KEY", ' = ', ": ", '"', "'", ":=", "abcdefgh", "A1b2+/_.=-x", "AKIA", "ABCDEFGH12345678",
        "deadbeef" * 4, "0123456789abcdef", "ghp_" + "a1" * 18, "xoxb-", "1234567890-abc", "AIza" + "b" * 35, "eyJhbGciOi.eyJzdWIiOi.abcdefgh1", "-----BEGIN RSA PRIVATE KEY-----",
        "é", "😀", " ", "\n", "word", "AKIAAKIA", "ſecret", "K",
    ]
    return ["".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(n)]


def test_spans_equal_a_direct_search(documents):
    rng = random.Random(1)
    texts = [*samples(rng, 400), None, "", "x" * 200_000 + " token=abcdefgh " + "f" * 100_000, "password=short", "AKIA" + "A" * 11, "token=aaaaaaaa" * 500]
    found = secret_scan.scan(documents(list(enumerate(texts))).drop("found")).select("doc_id", secret_scan.listed("found").alias("spans"))
    got = {r.doc_id: r.spans for r in found.collect()}
    assert got == {i: ",".join(expected(t)) for i, t in enumerate(texts)}


def test_repeated_and_null_ids(documents):
    rows = [(1, "token=abcdefgh"), (1, "token=abcdefgh"), (1, "nothing"), (None, "secret: 12345678"), (None, None)]
    docs = documents(rows)
    found = secret_scan.scan(docs, out="spans_")
    assert found.columns == [*docs.columns, "spans_"]
    assert sorted((r.text or "", len(r.spans_)) for r in found.collect()) == [("", 0), ("nothing", 0), ("secret: 12345678", 1), ("token=abcdefgh", 1), ("token=abcdefgh", 1)]
    assert secret_scan.scan(documents([]), out="spans_").count() == 0


def test_rules_without_queries_only(documents):
    found = secret_scan.scan(documents([(1, "ab12cd")]), (Rule("digit", "[0-9]+"),), out="spans_")
    assert [tuple(s) for s in found.first().spans_] == [(2, 0, 4, "digit")]


def test_redaction_covers_overlapping_spans(documents):
    from pyspark.sql import functions as F

    rows = [(1, "é token=" + "a1" * 20 + " AKIA" + "X" * 12 + " z"), (2, "clean"), (3, None), (4, "AKIA" + "X" * 12)]
    found = secret_scan.scan(documents(rows, extra=())).select("doc_id", "found", F.col("text").alias("whole"))
    got = {r.doc_id: r.out for r in found.select("doc_id", secret_scan.redacted(F.col("whole"), F.col("found")).alias("out")).collect()}
    assert got == {1: "é <secret> <secret> z", 2: "clean", 3: None, 4: "<secret>"}

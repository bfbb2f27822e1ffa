"""Edit-distance join of tokens with known terms.

Two strings within distance k: cut one into k+1 segments, then at least one segment is in the
other unchanged and hardly moved (PASS-JOIN). So an equi-join on (length, segment number, segment)
finds all candidates, whatever the length of the strings, and ``levenshtein`` decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import SPACE
from cadenza.lineage import durable
from cadenza.skew import key_join, spread

# Words, numbers and single marks of a text.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+(?:['’.\-+/][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_\s\p{Z}]"


def tokenize(text: Column) -> Column:
    """Tokens of a text; array."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def _segment_start(length: Column, number: int, parts: int) -> Column:
    """0-based start of a segment; the last ``length % parts`` segments are one longer."""
    short = F.floor(length / parts).cast("int")
    longer = length % parts
    return short * number + F.greatest(longer - (parts - number), F.lit(0))


def _segment_size(length: Column, number: int, parts: int) -> Column:
    return F.floor(length / parts).cast("int") + (F.lit(parts - number) <= length % parts).cast("int")


def _segments(term: Column, parts: int) -> Column:
    """Index entries of a known term: ``struct(n, number, piece)`` per segment."""
    n = F.length(term)
    return F.array(*[
        F.struct(
            n.alias("n"), F.lit(i).alias("number"),
            F.substring(term, _segment_start(n, i, parts) + 1, _segment_size(n, i, parts)).alias("piece"),
        )
        for i in range(parts)
    ])


def _probes(token: Column, distance: int) -> Column:
    """Lookups of a token, null where there is none: substrings that a segment of a term of length ``n`` can be.

    With d = |token| - n, segment i (from 0) may start at most i places to either side of its own
    start, and at most distance - i places to either side of its start shifted by d.
    """
    parts = distance + 1
    out = []
    for shift in range(-distance, distance + 1):
        n = F.length(token) - shift
        for i in range(parts):
            for move in range(max(-i, shift - (distance - i)), min(i, shift + (distance - i)) + 1):
                start = _segment_start(n, i, parts) + move
                size = _segment_size(n, i, parts)
                inside = (n >= 0) & (start >= 0) & (start + size <= F.length(token))
                out.append(F.when(inside, F.struct(
                    n.alias("n"), F.lit(i).alias("number"),
                    F.substring(token, start + 1, size).alias("piece"),
                )))
    return F.array(*out)


def edit_distance_pairs(tokens: DataFrame, token: str, terms: DataFrame, term: str, max_distance: int = 2) -> DataFrame:
    """``(token, term, distance)`` of distinct tokens and terms within the distance."""
    left = spread(durable(tokens.select(F.col(token).alias("token")).filter(F.col("token").isNotNull()).distinct()), "token")
    right = terms.select(F.col(term).alias("term")).filter(F.col("term").isNotNull()).distinct()
    probes = left.select("token", F.explode(_probes(F.col("token"), max_distance)).alias("p")).filter(
        F.col("p").isNotNull()
    ).select("token", "p.n", "p.number", "p.piece")
    index = right.select("term", F.explode(_segments(F.col("term"), max_distance + 1)).alias("s")).select(
        "term", "s.n", "s.number", "s.piece"
    )
    near = F.levenshtein("token", "term", max_distance)
    candidates = key_join(probes, index, ["n", "number", "piece"], on=near >= 0)
    return candidates.select("token", "term").distinct().select(
        F.col("token").alias(token), F.col("term").alias(term), F.levenshtein("token", "term", max_distance).alias("distance")
    )


def edit_distance_matches(
    texts: DataFrame,
    text: str,
    terms: DataFrame,
    term: str,
    max_distance: int = 2,
    lowercase: bool = True,
    lemmas: DataFrame | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """``(keys or text, term)``: known terms within the distance of a token of the text.

    ``lemmas`` is an optional table ``(token, lemma)``; tokens without an entry stay as they are.
    """
    keys = keys or [text]
    fold = F.lower if lowercase else (lambda c: c)
    rows = texts.filter(F.regexp_replace(F.col(text), f"{SPACE}+", "") != "")
    found = durable(rows.select(*keys, F.explode(F.array_distinct(tokenize(fold(F.col(text))))).alias("token")))
    if lemmas is not None:
        known = lemmas.select("token", "lemma").dropDuplicates(["token"])
        found = key_join(found, known, ["token"], "left").select(*keys, F.coalesce("lemma", "token").alias("token"))
    vocabulary = terms.select(fold(F.col(term)).alias(term))
    pairs = durable(edit_distance_pairs(found.select("token"), "token", vocabulary, term, max_distance))
    return key_join(found, pairs.select("token", term), ["token"]).select(*keys, term).distinct()

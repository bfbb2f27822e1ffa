"""A corpus cleaned and tokenised in stages, each a table of documents for the next one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import bpe, decontaminate, langid, ngram_join, secret_scan
from cadenza.llm.common import importable, plain, stored, table

# Below this probability a text resembles no language that the documents teach.
LEAST_LANGUAGE_SCORE = 0.3
# Near-duplicates: word 5-grams, Jaccard 0.8 or more.
NEAR = ngram_join.Similarity(5, 8, 10)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without a letter or a likely language go.

    If no document with a letter is labelled, nothing teaches a language: all with a letter stay.
    """
    importable(spark)
    net = langid.fit(docs)
    if net is None:
        return docs.filter(plain("text").rlike(r"\p{L}"))
    return langid.likely(docs, net, LEAST_LANGUAGE_SCORE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near-duplicates, the one of smallest id; rows are judged by id and text."""
    importable(spark)
    return ngram_join.one_of_each(docs, NEAR)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text holds no benchmark item, whatever other rows of their id hold; a null text holds none."""
    # Id and text are told apart by 64 bits.
    own = F.xxhash64(plain("doc_id"), plain("text"))
    found = decontaminate.contaminated(docs.select(own.alias("doc_id"), plain("text").alias("text")), table(spark, sf_dir, "benchmark"))
    leaks = stored(found.select(F.col("doc_id").alias("leaking")).distinct(), "leaks")
    return docs.join(leaks, own == leaks["leaking"], "left_anti")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; ``n_chars`` of a changed text is its new length."""
    spans = "found"
    while spans in docs.columns:
        spans += "_"
    found = secret_scan.scan(docs, out=spans).select(F.struct(*[plain(c) for c in docs.columns]).alias("row"), plain(spans).alias("spans"))
    redacted = found.select("row", F.size("spans").alias("n"), secret_scan.redacted(F.col("row")["text"], F.col("spans")).alias("redacted"))
    new = {
        "text": F.col("redacted"),
        "n_chars": F.when(F.col("n") > 0, F.char_length("redacted").cast("long")).otherwise(F.col("row")["n_chars"]),
    }
    return redacted.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes decoded from them."""
    importable(spark)
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(bpe.round_trip(docs, vocabulary), "doc_id", "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's result is a stored table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Learned models and tokenisers are no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL: str | None = None

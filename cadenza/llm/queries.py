"""One query per operator over the whole tables of a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import bpe, decontaminate, dialogue, html_extract, katz, langid, ngram_join, personal, quality, rans, secret_scan, topk, whitening
from cadenza.llm.common import id_remainder, importable, shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query by its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles have Jaccard 0.9 or more."""
    return ngram_join.join(table(spark, sf_dir, "documents"), ngram_join.Similarity(3, 90, 100))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: numbers of the base kinds, a digest of their spans, and all spans."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("found", lambda s: s["rule"] < len(secret_scan.BASE))

    def count(number: int, kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["rule"] == number)).cast("long").alias(f"n_{kind}")

    counts = [count(i, r.kind) for i, r in enumerate(secret_scan.BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("found")).alias("spans"),
    )


@query
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth embedding by integer inner product."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % or more of the five-word shingles of a benchmark item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document by a backoff model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder("doc_id", 7) == 2, F.lit(False))
    return katz.learn_and_score(docs, held_out)


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)))
    model = quality.fit(docs.filter(~F.col("held_out")), table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 3) != 1))
    return quality.classify(docs, model, keep=("doc_id", "held_out"))


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, then decoded from its ids."""
    vocabulary = bpe.Vocabulary.load(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary), "doc_id")


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the four fifths that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    )
    net = langid.fit(docs.filter(~F.col("held_out")))
    return langid.identify(docs, net, keep=("doc_id", "held_out"))


@query
def op10_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as token files and read back from them."""
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        rans.write(table(spark, sf_dir, "documents"), path, file.read(), 1)
    return rans.read(spark, path).select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op11_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: numbers of the base kinds, a digest of their spans, and all spans."""
    return personal.report(table(spark, sf_dir, "documents"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the whitened leading components of all of them."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and a digest of the repaired rows of every damaged conversation."""
    return dialogue.report(table(spark, sf_dir, "conversations"))

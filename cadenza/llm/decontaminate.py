"""Benchmark decontamination: short test items found inside long documents by the words they share.

Items are grouped by size, each class with one MinHash sketch size: the smallest shingle hashes of an
item. An item of ``n`` shingles may miss ``n - ceil(t * n)`` of them, so a document that contains it
holds all but so many of its sketch; a sketch longer than that is found whatever else the document
holds, however long it is. Documents are probed with all their shingles; only those with enough hits
are candidates, and they are decided by exact containment of the shingles as texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import plain, stored

SPACES = "[ \\t\\n\\u000B\\f\\r]+"


def words(text: Column) -> Column:
    """Lower-case words of a text, split at ASCII white space; empty for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), "")


def _rest(array: Column, start: int) -> Column:
    """All elements from position ``start`` (0-based) on."""
    return F.slice(array, F.lit(start + 1), F.size(array))


def hashed_shingles(text: Column, n: int = 5) -> Column:
    """Distinct 64-bit hashes of all runs of ``n`` words; with fewer words, of all words as one run.

    Runs grow by doubling: hashes of runs of 1, 2, 4, … words, put together to ``n``.
    """

    def runs(hashes: Column) -> Column:
        powers, width = [hashes], 1
        while width * 2 <= n:
            w = width
            powers.append(F.zip_with(powers[-1], _rest(powers[-1], w), lambda a, b: F.xxhash64(a, b)))
            width *= 2
        out, covered = powers[-1], width
        for power in range(len(powers) - 2, -1, -1):
            if covered + (1 << power) <= n:
                out = F.zip_with(out, _rest(powers[power], covered), lambda a, b: F.xxhash64(a, b))
                covered += 1 << power
        # The shorter side is padded with nulls, so what runs over the end is cut off.
        return F.slice(out, F.lit(1), F.size(hashes) - (n - 1))

    def of(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        return F.when(F.size(w) >= n, runs(hashes)).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
            F.array().cast("array<bigint>")
        )

    return F.array_distinct(F.element_at(F.transform(F.array(words(text)), of), 1))


def shingle_texts(text: Column, n: int = 5) -> Column:
    """Distinct runs of ``n`` words, as texts; with fewer words, all words as one run."""

    def of(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
        return F.when(F.size(w) >= n, runs).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.element_at(F.transform(F.array(words(text)), of), 1))


def _needed(n: Column, num: int, den: int) -> Column:
    """Shingles a document must share with an item of ``n``."""
    return F.ceil(n * num / F.lit(den)).cast("int")


def sketches(items: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``(h, item, need)``: the sketch of each item and how many of it a document has to hold."""
    sized = items.select("item", hashed_shingles(F.col("text"), n).alias("all")).withColumn("n", F.size("all")).filter("n > 0")
    # Classes of doubling size share the sketch size of their largest item.
    largest = (F.pow(F.lit(2), F.length(F.bin("n"))) - 1).cast("int")
    size = F.least(F.col("n"), largest - _needed(largest, num, den) + 1)
    sketch = F.slice(F.array_sort("all"), F.lit(1), size)
    need = size - (F.col("n") - _needed(F.col("n"), num, den))
    return sized.select("item", need.alias("need"), F.explode(sketch).alias("h")).distinct()


def contaminated(
    docs: DataFrame, items: DataFrame, n: int = 5, num: int = 8, den: int = 10,
    key: str = "doc_id", item_key: str = "item_id", text: str = "text",
) -> DataFrame:
    """``(key, item_key, n_item, n_shared, containment)`` of every document that holds ``num / den`` or
    more of an item's distinct shingles.

    Null and empty texts hold nothing and are held by nothing. A text of fewer than ``n`` words is one
    shingle, so such an item is found in texts equal to it only. Rows that share an id, null
    included, are one document or item with several texts; the best pair counts. Other columns
    don't matter. Items are broadcast only while Spark measures them to be small.
    """
    whole = docs.select(plain(key).alias("id"), plain(text).alias("text"))
    # One item per id and text.
    tests = stored(
        items.select(plain(item_key).alias("item_id"), plain(text).alias("text")).filter("text IS NOT NULL").distinct()
        .select("item_id", "text", F.struct("item_id", F.md5(F.col("text").cast("binary")).alias("text")).alias("item")), "items",
    )
    probes = whole.select("id", F.explode(hashed_shingles(F.col("text"), n)).alias("h"))
    hits = probes.join(stored(sketches(tests, n, num, den), "sketches"), "h")
    candidates = stored(
        hits.groupBy("id", "item").agg(F.count_distinct("h").alias("hits"), F.max("need").alias("need")).filter("hits >= need").select("id", "item"),
        "candidates",
    )
    found = candidates.withColumnRenamed("id", "found").join(
        tests.select(F.col("item").alias("tested"), "item_id", shingle_texts(F.col("text"), n).alias("wanted")), F.col("item").eqNullSafe(F.col("tested"))
    ).select("found", "item_id", "wanted")
    shared = F.size(F.array_intersect("wanted", shingle_texts(F.col("text"), n)))
    return (
        whole.join(found, F.col("id").eqNullSafe(F.col("found")))
        .select("id", "item_id", F.size("wanted").alias("n_item"), shared.alias("n_shared"))
        .filter(F.col("n_shared") >= _needed(F.col("n_item"), num, den))
        .groupBy("id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_shared", "n_item")).alias("best"))
        .select(
            F.col("id").alias(key), F.col("item_id").alias(item_key), F.col("best.n_item").cast("long").alias("n_item"),
            F.col("best.n_shared").cast("long").alias("n_shared"), F.col("best.containment").alias("containment"),
        )
    )

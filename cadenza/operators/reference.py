"""Reference tables completed with the entries that new results need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import title_case
from cadenza.lineage import kept
from cadenza.operators.cleaning import expect_columns
from cadenza.skew import numbered

# Columns of the item reference table.
ITEM_COLUMNS = [
    "name", "concept_id", "Manual", "concept_me", "valid_concept_id", "domain_id", "concept_class_id",
    "Manual_Req",
]


def stable_choice(name: Column, n: Column, seed: int = 0) -> Column:
    """A number from 1 to ``n`` that depends on the name and the seed only."""
    digits = F.left(F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")), F.lit(8))
    return (F.pmod(F.conv(digits, 16, 10).cast("bigint"), n) + 1).cast("bigint")


def new_names(final: DataFrame, reference: DataFrame) -> DataFrame:
    """Distinct ``regName`` values that are not in ``Var1``; upper and lower case differ."""
    names = final.select(F.col("regName").alias("Var1")).filter(F.col("Var1").isNotNull()).distinct()
    return names.join(reference.select("Var1"), "Var1", "left_anti")


def complete_groups(final: DataFrame, reference: DataFrame, seed: int = 0) -> DataFrame:
    """Reference groups plus an entry for each new name, its group drawn from the known ones."""
    expect_columns(reference, ["Var1", "regGroup"])
    groups = reference.select("regGroup").filter(F.col("regGroup").isNotNull()).distinct()
    labels = numbered(groups, "regGroup", "_no")
    drawn = new_names(final, reference).withColumn(
        "_pick", stable_choice(F.col("Var1"), groups.agg(F.count(F.lit(1))).scalar(), seed)
    )
    entries = drawn.join(labels, drawn["_pick"] == labels["_no"]).select("Var1", "regGroup")
    return reference.select("Var1", "regGroup").unionByName(entries)


def known_items(components: DataFrame, reference: DataFrame) -> DataFrame:
    """Reference rows whose name is a component, ignoring case."""
    return reference.join(
        components.select(F.col("component").alias("_c")), F.lower(reference["name"]) == F.col("_c"), "left_semi"
    )


def missing_items(components: DataFrame, reference: DataFrame) -> DataFrame:
    """Components without a reference row, ignoring case."""
    return components.join(
        reference.select(F.lower("name").alias("_c")).distinct(), components["component"] == F.col("_c"), "left_anti"
    )


def largest_id(known: DataFrame, column: str) -> Column:
    """Greatest numeric id of the known rows, rounded down, 0 without one.

    Signs, decimals and exponents are numbers, too (a number column read as text ends in ``.0``).
    """
    # Texts that are no number are dropped before the cast: one that fails costs more.
    number = F.when(F.col(column).rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), F.trim(column)).try_cast("decimal(38,6)")
    return known.agg(F.coalesce(F.floor(F.max(number)), F.lit(0)).cast("decimal(38,0)")).scalar()


def complete_items(final: DataFrame, reference: DataFrame) -> DataFrame:
    """Reference items plus an entry with the next ids for each component they lack."""
    expect_columns(reference, ITEM_COLUMNS)
    components = final.select(F.lower("component").alias("component")).filter(F.col("component").isNotNull()).distinct()
    known = known_items(components, reference)
    added = numbered(missing_items(components, reference), "component", "_no")
    known = kept(known)
    concept = (largest_id(known, "concept_id") + F.col("_no")).cast("string")
    name = title_case(F.col("component"))
    entries = added.select(
        name.alias("name"),
        concept.alias("concept_id"),
        concept.alias("Manual"),
        name.alias("concept_me"),
        (largest_id(known, "valid_concept_id") + F.col("_no")).cast("string").alias("valid_concept_id"),
        F.lit("Drug").alias("domain_id"),
        F.lit("Ingredient").alias("concept_class_id"),
        F.lit("Yes").alias("Manual_Req"),
    )
    return reference.select(*[F.col(c).cast("string").alias(c) for c in ITEM_COLUMNS]).unionByName(entries)

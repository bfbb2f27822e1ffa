"""Row and column clean-up, blacklist filter and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.text import blacklist_terms, clean_text

# Texts that stand for a missing value.
SENTINELS = ["nan", "none", "None", ""]

# Texts that table readers commonly take for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]


def expect_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or an error naming the missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def null_sentinels(df: DataFrame, columns: Sequence[str], sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Texts that stand for a missing value become null."""
    return df.withColumns(
        {c: F.when(~F.col(c).isin(list(sentinels)), F.col(c)) for c in columns}
    )


def fill_sentinel(df: DataFrame, sentinel: str = "nan") -> DataFrame:
    """Text columns with the sentinel text in place of null."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(sentinel)) for c in texts})


def drop_matching_columns(df: DataFrame, part: str = "date_added") -> DataFrame:
    """Drop the columns whose name contains ``part``."""
    return df.drop(*[c for c in df.columns if part in c])


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Drop null and blank values."""
    return df.filter(F.col(column).isNotNull() & F.col(column).rlike(r"[^\s\p{Z}]"))


def with_meta_condition(df: DataFrame) -> DataFrame:
    """Add the constant ``metaCondition``."""
    return df.withColumn("metaCondition", F.lit("all"))


def clean_merge_side(df: DataFrame) -> DataFrame:
    """One side of the merge: clean keys, no ``date_added`` columns, missing values as null.

    A missing study becomes the text ``nan`` and joins; a missing component is null and
    joins nothing.
    """
    df = drop_matching_columns(expect_columns(df, ["component", "study"]))
    df = null_sentinels(df, [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)], MISSING_TEXTS)
    texts = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in ("component", "study")
    ]
    df = df.withColumns({
        "component": F.when(F.col("component").isNotNull(), clean_text(F.col("component"))),
        "study": clean_text(F.coalesce(F.nullif(F.col("study"), F.lit("")), F.lit("nan"))),
    })
    return null_sentinels(null_sentinels(df, ["component"], ["nan", "none"]), texts)


def blacklist_set(entries: DataFrame, column: str = "entry", strict: bool = False) -> DataFrame:
    """Distinct lower-case terms of the blacklist entries, as column ``term``.

    ``strict`` also cleans the terms like components; without it terms with punctuation
    cannot equal a cleaned component.
    """
    terms = entries.select(F.explode(blacklist_terms(F.col(column))).alias("term"))
    if strict:
        terms = terms.select(clean_text(F.col("term")).alias("term"))
    return terms.distinct()


def drop_blacklisted(df: DataFrame, terms: DataFrame, column: str = "component") -> DataFrame:
    """Rows whose lower-case value is no blacklist term; null values are dropped too.

    A plain anti-join: Spark broadcasts the terms when their measured size allows it.
    """
    kept = df.filter(F.col(column).isNotNull())
    return kept.join(terms.select(F.col("term").alias("_term")), F.lower(kept[column]) == F.col("_term"), "left_anti")


def expectations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row per check with ``passed``; each check is an aggregate over the table, one pass."""
    results = df.agg(*[F.coalesce(check, F.lit(False)).alias(name) for name, check in checks.items()])
    return results.select(
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("check"), F.col(name).alias("passed")) for name in checks
        ])).alias("c")
    ).select("c.check", "c.passed")


def present(column: str, value: str) -> Column:
    """Check: some row has the value, ignoring case."""
    return F.max(F.lower(F.col(column)) == value)


def absent(column: str, value: str) -> Column:
    """Check: no row has the value, ignoring case."""
    return ~F.coalesce(F.max(F.lower(F.col(column)) == value), F.lit(False))


def not_empty() -> Column:
    """Check: the table has rows."""
    return F.count(F.lit(1)) > 0


# The checks on the merged table.
MERGE_CHECKS = {"thalidomide_present": ("present", "thalidomide"), "bisophonate_absent": ("absent", "bisophonate")}


def merge_expectations(df: DataFrame) -> DataFrame:
    """The checks of the merged table."""
    rules = {"present": present, "absent": absent}
    return expectations(df, {name: rules[rule]("component", value) for name, (rule, value) in MERGE_CHECKS.items()})

"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.shape import first_per_short_string, sort_output
from cadenza.operators.validate import sort_report


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; a folder of part files."""
    df.write.mode("overwrite").options(sep="\t", header=True, quote='"', escape='"', emptyValue="").csv(path)


def write_products(final: DataFrame, full_path: str, short_path: str) -> None:
    """The sorted full table, and one row per short string. ``final`` is read twice: pass a stored table."""
    write_tsv(sort_output(final), full_path)
    write_tsv(sort_output(first_per_short_string(final)), short_path)


def write_report(lines: DataFrame, path: str) -> None:
    """Report lines as text, in reading order over the part files."""
    sort_report(lines).select(F.col("line").alias("value")).write.mode("overwrite").text(path)

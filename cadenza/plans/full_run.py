"""The stages of a run. Each stage reads the Parquet tables that the one before has written below the
output folder, so a lost executor repeats at most one stage's work; delimited files are exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.cleaning import blacklist_set, merge_expectations
from cadenza.operators.matching import SKIP_COLUMNS, SKIP_WORDS, explode_matches, extract_matches, match_counts
from cadenza.operators.merge import merged_table
from cadenza.operators.reference import complete_groups, complete_items
from cadenza.operators.schedule import group_metrics, missing_days, process_schedules
from cadenza.operators.shape import format_output, with_short_string
from cadenza.operators.validate import match_status, match_summary, report_lines
from cadenza.sources.files import read_csv, read_latin_csv, read_ragged, read_term_lists, read_tsv
from cadenza.sources.sinks import write_products, write_report, write_tsv

ROW_ID = "_row_id"


def stage(df: DataFrame, path: str) -> DataFrame:
    """The frame written as parquet and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pre_run(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    threshold: float = 0.8,
    skip_words: list[str] = SKIP_WORDS,
    skip_columns: list[str] = SKIP_COLUMNS,
    keep_multiplicity: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Find hidden terms in the indications and add their rows; returns the audit table.

    Row numbers are stored with the rows before they are used. ``multi_line=False`` lets Spark split
    inputs without quoted line breaks.
    """
    sigs = read_csv(spark, f"{input_dir}/sigs.csv", multi_line=multi_line)
    numbered = read_latin_csv(spark, f"{input_dir}/indications.csv", multi_line=multi_line).withColumn(
        ROW_ID, F.monotonically_increasing_id()
    )
    rows = stage(numbered, f"{output_dir}/_stages/indications")
    sigs = stage(sigs, f"{output_dir}/_stages/s_frame")
    matches, audit = extract_matches(
        rows, ROW_ID, sigs, "component", threshold, skip_words, [*skip_columns, ROW_ID]
    )
    matches = stage(matches, f"{output_dir}/_stages/matches")
    stage(match_counts(matches), f"{output_dir}/_stages/match_counts")
    exploded = stage(
        explode_matches(rows, ROW_ID, matches, "component", keep_multiplicity).drop(ROW_ID), f"{output_dir}/_stages/i_frame"
    )
    require(appended_rows(rows, matches, exploded, keep_multiplicity))
    write_tsv(sigs, f"{output_dir}/s_frame.tsv")
    write_tsv(exploded, f"{output_dir}/i_frame.tsv")
    return stage(audit, f"{output_dir}/_stages/match_audit")


def appended_rows(rows: DataFrame, matches: DataFrame, exploded: DataFrame, keep_multiplicity: bool = False) -> DataFrame:
    """Check: the exploded table has the rows of the first one and one for each match."""
    added = (
        matches.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("n")) if keep_multiplicity
        else matches.select("row_id", "term").distinct().agg(F.count(F.lit(1)).alias("n"))
    ).scalar()
    wanted = rows.agg(F.count(F.lit(1))).scalar() + added
    return exploded.agg((F.count(F.lit(1)) == wanted).alias("passed")).select(F.lit("appended_rows").alias("check"), "passed")


def require(expectations: DataFrame) -> None:
    """Fail when a check has not passed; there are as many rows as checks."""
    failed = [r["check"] for r in expectations.collect() if not r["passed"]]
    if failed:
        raise ValueError(f"failed checks: {failed}")


def frame_all(
    spark: SparkSession, indications: DataFrame, sigs: DataFrame, output_dir: str, blacklist_path: str | None = None,
    check: bool = True,
) -> DataFrame:
    """Clean, merge, enrich and filter; writes ``merged.tsv`` and returns the stored table."""
    terms = blacklist_set(read_term_lists(spark, blacklist_path)) if blacklist_path else None
    merged = merged_table(sigs, indications, terms)
    merged = stage(merged, f"{output_dir}/_stages/merged")
    if check:
        require(merge_expectations(merged))
    write_tsv(merged, f"{output_dir}/merged.tsv")
    return merged


def run_etl(spark: SparkSession, output_dir: str, blacklist_path: str | None = None, check: bool = True) -> DataFrame:
    """Merge and regimen strings; writes ``regimens_full.tsv`` and ``regimens.tsv``, returns the full table."""
    indications, sigs = (spark.read.parquet(f"{output_dir}/_stages/{name}") for name in ("i_frame", "s_frame"))
    merged = frame_all(spark, indications, sigs, output_dir, blacklist_path, check)
    stage(missing_days(merged), f"{output_dir}/_stages/missing_days")
    stage(group_metrics(merged), f"{output_dir}/_stages/group_metrics")
    final = stage(format_output(with_short_string(process_schedules(merged))), f"{output_dir}/_stages/final")
    if final.isEmpty():
        raise ValueError("the final table is empty")
    write_products(final, f"{output_dir}/regimens_full.tsv", f"{output_dir}/regimens.tsv")
    return final


def complete_references(
    spark: SparkSession, final: DataFrame, groups_path: str, items_path: str, output_dir: str, seed: int = 0, multi_line: bool = True
) -> None:
    """Writes ``regimengroups.tsv`` and ``validdrugs.tsv``."""
    write_tsv(complete_groups(final, read_tsv(spark, groups_path, multi_line=multi_line), seed), f"{output_dir}/regimengroups.tsv")
    write_tsv(complete_items(final, read_ragged(spark, items_path)), f"{output_dir}/validdrugs.tsv")


def validate(spark: SparkSession, final: DataFrame, merged: DataFrame, old_path: str, output_dir: str, multi_line: bool = True) -> DataFrame:
    """Writes the report, returns the summary."""
    old = read_tsv(spark, old_path, multi_line=multi_line)
    status = stage(match_status(final, old, merged), f"{output_dir}/_stages/match_status")
    write_report(report_lines(final, old, merged, status), f"{output_dir}/validation/shared_output_analysis.txt")
    return match_summary(status)


def run_all(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    blacklist_path: str,
    groups_path: str,
    items_path: str,
    old_path: str | None = None,
    check: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """All stages in order; returns the final table. ``multi_line=False`` lets Spark split inputs without quoted line breaks."""
    pre_run(spark, input_dir, output_dir, multi_line=multi_line)
    final = run_etl(spark, output_dir, blacklist_path, check)
    complete_references(spark, final, groups_path, items_path, output_dir, multi_line=multi_line)
    if old_path:
        merged = spark.read.parquet(f"{output_dir}/_stages/merged")
        validate(spark, final, merged, old_path, output_dir, multi_line)
    return final

"""Stand-ins for the input tables, derived from the driver tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with part and order columns; the joins' right sides are unique keys."""
    item = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    order = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
    )
    return item.join(part, item.l_partkey == part.p_partkey).join(order, item.l_orderkey == order.o_orderkey)


def day_text() -> F.Column:
    return F.concat_ws(",", F.dayofmonth("l_shipdate").cast("string"), F.col("l_linenumber").cast("string"))


def cycle_text() -> F.Column:
    return (
        F.when(F.col("l_linenumber") == 7, "Full cycle")
        .when(F.col("l_linestatus") == "O", "28-day cycle")
        .otherwise("3-week schedule")
    )


def sched(spark: SparkSession, folder: str) -> DataFrame:
    """Merged schedule rows: a customer's lines as one regimen; some lack the regimen, its variant or the days."""
    days = F.when(F.col("l_quantity") == 13, F.lit("")).when(F.col("l_partkey") % 41 != 0, day_text())
    return lines(spark, folder).select(
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey").cast("string")).alias("regimen_cui"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("variant"),
        F.col("p_name").alias("component"),
        days.alias("allDays"),
        cycle_text().alias("cyclesigs"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("condition"),
        F.col("o_orderstatus").alias("context"),
        F.col("l_linestatus").alias("study"),
        F.concat(F.col("p_type"), F.lit(" and "), F.col("p_brand")).alias("regimen"),
        F.lit("all").alias("metaCondition"),
    )


def sigs(spark: SparkSession, folder: str) -> DataFrame:
    """Schedule rows before the merge, with untidy component texts."""
    return lines(spark, folder).select(
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(") "),
                 F.col("l_quantity").cast("int").cast("string")).alias("component"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("study"),
        F.col("l_orderkey").cast("string").alias("regimen_cui"),
        F.col("l_returnflag").alias("variant"),
        day_text().alias("allDays"),
        cycle_text().alias("cyclesigs"),
        F.concat(F.col("p_type"), F.lit(" and "), F.col("p_brand")).alias("regimen"),
        F.col("l_shipdate").cast("date").cast("string").alias("date_added_sig"),
    )


def indications(spark: SparkSession, folder: str) -> DataFrame:
    """Indications of the same components; the study follows the order, so only some match."""
    return lines(spark, folder).select(
        F.concat(F.upper("p_name"), F.lit(" "), F.col("p_brand"), F.lit(" "),
                 F.col("l_quantity").cast("int").cast("string")).alias("component"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("study"),
        F.col("l_orderkey").cast("string").alias("regimen_cui"),
        F.col("l_returnflag").alias("variant"),
        day_text().alias("allDays"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("condition"),
        F.col("o_orderstatus").alias("context"),
        F.col("p_type").alias("with"),
        F.col("o_orderdate").cast("date").cast("string").alias("date_added_ind"),
    )


def cycle_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Cycle expressions of every form, from part sizes."""
    size = F.col("p_size").cast("string")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_type") == "ECONOMY", F.concat(size, F.lit("-day cycle")))
        .when(F.col("p_type") == "SMALL", F.concat(size, F.lit("- to "), (F.col("p_size") + 7).cast("string"), F.lit("-day Cycle")))
        .when(F.col("p_type") == "MEDIUM", F.concat(size, F.lit("-week schedule")))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit(" "), size, F.lit(" months ")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("for "), size, F.lit("years course")))
        .otherwise(F.concat(F.lit("Full cycle "), F.col("p_type"))).alias("cycle_text"),
    )


def blacklist(spark: SparkSession, folder: str) -> DataFrame:
    """Blacklist entries with a second name in brackets."""
    return table(spark, folder, "part").select(
        F.concat(F.initcap("p_name"), F.lit(" "), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit(" "),
                 F.col("p_size").cast("string"), F.lit(" ("), F.col("p_type"), F.lit(")")).alias("entry")
    )


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Known terms: the units of the benchmark texts."""
    from cadenza.functions.text import split_units

    return table(spark, folder, "benchmark").select(F.explode(split_units(F.col("text"))).alias("component")).distinct()


def known_words(spark: SparkSession, folder: str) -> DataFrame:
    """Known terms: the words of the benchmark texts."""
    from cadenza.functions.text import split_words

    return table(spark, folder, "benchmark").select(F.explode(split_words(F.lower("text"))).alias("component")).distinct()


def document_words(spark: SparkSession, folder: str) -> DataFrame:
    from cadenza.functions.text import split_words

    return table(spark, folder, "documents").select(F.explode(split_words(F.lower("text"))).alias("word")).distinct()


def conversation_words(spark: SparkSession, folder: str) -> DataFrame:
    from cadenza.functions.text import split_words

    return table(spark, folder, "conversations").select(F.explode(split_words(F.lower("text"))).alias("word")).distinct()


def document_units(spark: SparkSession, folder: str) -> DataFrame:
    from cadenza.functions.text import split_units

    return table(spark, folder, "documents").select(F.explode(split_units(F.col("text"))).alias("unit")).distinct()


def hidden(spark: SparkSession, folder: str) -> DataFrame:
    """A table with terms hidden in its text columns."""
    return table(spark, folder, "documents").select(
        "doc_id", F.col("lang").alias("component"), F.col("source").alias("study"), F.col("text").alias("note"),
        F.concat(F.col("lang"), F.lit(" or "), F.col("source")).alias("origin"),
    )


def regimen_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names that touch each normalisation rule."""
    head = (
        F.when(F.col("p_type") == "ECONOMY", "Bortezomib, Thalidomide, Dexamethasone, ")
        .when(F.col("p_type") == "SMALL", "Melphalan flufenamide , Dexamethasone and ")
        .when(F.col("p_type") == "MEDIUM", "Tegafur & Uracil, Folinic acid, ")
        .when(F.col("p_type") == "PROMO", "VMP, then Rd (TP) and ")
        .when(F.col("p_type") == "LARGE", "VMP/Rd  (KR), ")
    )
    own = F.when(F.col("p_size") > 5, F.concat(F.lit(" "), "p_name", F.lit(" and "), "p_brand")).otherwise("")
    return table(spark, folder, "part").select(
        "p_partkey", F.coalesce(F.concat(head, own), F.when(F.col("p_size") > 25, F.lit("Carfilzomib")).otherwise(own)).alias("regName")
    )


def check_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of ``lines`` that ``check_rows`` reads."""
    return lines(spark, folder).select(
        "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
        "p_name", "p_brand", "p_type", "o_orderstatus", "o_orderpriority",
        (F.col("o_orderdate") >= F.lit("1998-07-01").cast("timestamp")).alias("newer"),
    )


def check_rows(spark: SparkSession, folder: str, newer: bool, read: DataFrame | None = None) -> DataFrame:
    """Merged rows of the newer or the older orders; the older ones write names differently. ``read`` are the ``check_lines``, if they are stored."""
    quantity = F.col("l_quantity").cast("int").cast("string")
    name = (
        F.concat("p_name", F.lit(" and "), "p_brand", F.lit(", "), quantity)
        if newer
        else F.concat(F.upper("p_name"), F.lit(" & "), "p_brand", F.lit(" , "), quantity)
    )
    rows = check_lines(spark, folder) if read is None else read
    return rows.filter(F.col("newer") if newer else ~F.col("newer")).select(
        (F.col("l_partkey") * 100 + F.col("l_quantity").cast("long")).cast("string").alias("regimen_cui"),
        F.col("l_returnflag").alias("variant"),
        F.col("p_name").alias("component"),
        F.col("l_linenumber").cast("string").alias("allDays"),
        F.when(F.col("l_linestatus") == "O", "28-day cycle").otherwise("3-week schedule").alias("cyclesigs"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("condition"),
        F.col("o_orderstatus").alias("context"),
        F.nullif(F.col("p_type"), F.lit("SMALL")).alias("with"),
        name.alias("regimen"),
        F.lit("all").alias("metaCondition"),
    )

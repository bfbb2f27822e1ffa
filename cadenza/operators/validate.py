"""New results compared with a trusted older set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import compare_key, normalise_new_name, normalise_old_name
from cadenza.lineage import durable
from cadenza.skew import key_join, numbered

# Marks of the match classes in the report.
MARKS = {"correct": "✅", "partial": "⚠️", "failed": "❌"}
TABLE_HEADER = "regimen_cui | component | cyclesigs | HVC (with) | variant | allDays | condition"
ROW_KEYS = ["regimen_cui", "component", "cyclesigs", "variant", "allDays", "condition"]


# Bits of the tables that have a row.
NEW, OLD, MERGED = 1, 2, 4


def shared_names(new: DataFrame, old: DataFrame) -> DataFrame:
    """``(name_key, new_name, old_name)`` of the names both tables have; of several with one key the greatest."""
    sides = [table.select(F.col("regName").alias("name"), F.lit(bit).alias("side")) for table, bit in ((new, NEW), (old, OLD))]
    names = sides[0].unionByName(sides[1]).filter(F.col("name").isNotNull()).groupBy("name").agg(F.bit_or("side").alias("sides"))
    # A name that both tables have is normalised by the rules of each.
    forms = F.array(*[
        F.struct(F.lit(bit).alias("side"), normalise(F.col("name")).alias("name_key"))
        for bit, normalise in ((NEW, normalise_new_name), (OLD, normalise_old_name))
    ])
    tagged = names.select("name", "sides", F.explode(forms).alias("form")).filter(F.col("sides").bitwiseAND(F.col("form.side")) != 0)
    return tagged.groupBy("form.name_key").agg(
        *[F.max(F.when(F.col("form.side") == bit, F.col("name"))).alias(out) for bit, out in ((NEW, "new_name"), (OLD, "old_name"))]
    ).filter("name_key IS NOT NULL AND new_name IS NOT NULL AND old_name IS NOT NULL")


def shared_rows(merged: DataFrame, shared: DataFrame) -> DataFrame:
    """Merged rows whose regimen is a shared name."""
    return merged.join(shared.select("new_name"), merged["regimen"] == F.col("new_name"), "left_semi")


def tagged_strings(new: DataFrame, old: DataFrame, shared: DataFrame, string: Column) -> DataFrame:
    """``(regimen, text, sides)``: distinct strings of the shared names, under the new name, with the bits of the tables that have them."""
    sides = [table.select(F.col("regName").alias("name"), string.alias("text"), F.lit(bit).alias("side")) for table, bit in ((new, NEW), (old, OLD))]
    distinct = sides[0].unionByName(sides[1]).groupBy("name", "text").agg(F.bit_or("side").alias("sides"))
    own = F.array(*[F.struct(F.col(c).alias("name"), F.lit(bit).alias("side")) for c, bit in (("new_name", NEW), ("old_name", OLD))])
    names = shared.select(F.col("new_name").alias("regimen"), F.explode(own).alias("own")).select("regimen", "own.name", "own.side")
    side = F.col("sides").bitwiseAND(F.col("side"))
    rows = key_join(distinct, names, ["name"], on=side != 0).select("regimen", "text", side.alias("side"))
    return rows.groupBy("regimen", "text").agg(F.bit_or("side").alias("sides"))


def short_strings(new: DataFrame, old: DataFrame, shared: DataFrame) -> DataFrame:
    """``tagged_strings`` of the comparable short strings."""
    return tagged_strings(new, old, shared, compare_key(F.col("shortString")))


def _on(sides: int) -> Column:
    return F.col("sides").bitwiseAND(F.lit(sides)) == sides


def match_status(new: DataFrame, old: DataFrame, merged: DataFrame, strings: DataFrame | None = None) -> DataFrame:
    """``(regimen, status, n_new, n_hit)`` of the shared regimens that have merged rows.

    ``correct``: all new strings are among the old ones, ``partial``: some, ``failed``: none. A null string is
    among none. ``strings`` are the ``short_strings``, if they are there already.
    """
    strings = short_strings(new, old, durable(shared_names(new, old))) if strings is None else strings
    rows = strings.select("regimen", "sides", F.col("text").isNotNull().alias("known"))
    present = merged.select("regimen", F.lit(MERGED).alias("sides"), F.lit(False).alias("known"))
    counts = rows.unionByName(present).groupBy("regimen").agg(
        F.bit_or("sides").alias("sides"), F.count_if(_on(NEW)).alias("n_new"), F.count_if(_on(NEW | OLD) & F.col("known")).alias("n_hit")
    )
    return counts.filter(_on(NEW | MERGED)).select(
        "regimen",
        F.when(F.col("n_hit") == F.col("n_new"), "correct").when(F.col("n_hit") > 0, "partial").otherwise("failed").alias("status"),
        "n_new", "n_hit",
    )


def match_summary(status: DataFrame) -> DataFrame:
    """``(status, regimens)`` for the three classes, zero included."""
    return status.agg(*[F.count_if(F.col("status") == s).alias(s) for s in MARKS]).select(
        F.explode(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("regimens")) for s in MARKS])).alias("c")
    ).select("c.status", "c.regimens")


def exact_counters(new: DataFrame, old: DataFrame) -> DataFrame:
    """One row ``(matched, mismatched)``: shared names with the same single string on both sides."""
    strings = tagged_strings(new, old, durable(shared_names(new, old)), F.col("regString"))
    known = F.col("text").isNotNull()
    per_name = strings.groupBy("regimen").agg(
        F.count_if(known).alias("n"), F.bit_or(F.when(known, F.col("sides"))).alias("sides")
    )
    same = F.coalesce((F.col("n") == 1) & _on(NEW | OLD), F.lit(False))
    return per_name.agg(F.count_if(same).alias("matched"), F.count_if(~same).alias("mismatched"))


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def report_lines(new: DataFrame, old: DataFrame, merged: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """The report as rows ``(priority, regimen, part, place, variant, step, with_text, line)``.

    A block per regimen that is not fully correct. Separators are rows of their own between
    variants, and listed strings are numbered by their ranges, so no block is put together in one task.
    ``status`` is the result of ``match_status``, if it is there already.
    """
    # Both are read by several branches: written once.
    strings = durable(short_strings(new, old, durable(shared_names(new, old))))
    status = durable(match_status(new, old, merged, strings) if status is None else status)
    open_ = status.filter(F.col("status") != "correct").select(
        "regimen", "status", F.when(F.col("status") == "partial", 1).otherwise(2).alias("priority")
    )
    null = F.lit(None).cast("string")

    def rows(df: DataFrame, part: int | Column, line: Column, place: Column | None = None, variant: Column = null,
             step: int = 0, with_text: Column = null) -> DataFrame:
        return df.select(
            "priority", "regimen", (part if isinstance(part, Column) else F.lit(part)).alias("part"),
            (F.lit(0) if place is None else place).cast("long").alias("place"),
            variant.alias("variant"), F.lit(step).alias("step"), with_text.alias("with_text"), line.alias("line"),
        )

    mark = F.lit(None).cast("string")
    for name, sign in MARKS.items():
        mark = F.when(F.col("status") == name, F.lit(sign)).otherwise(mark)
    fixed = [
        (0, F.concat(F.lit("=== Regimen: "), "regimen", F.lit(" ==="))),
        (1, F.concat(F.lit("=== Status: "), mark, F.lit(" ==="))),
        (2, F.lit("new")),
        (4, F.lit("old")),
        (6, F.lit("")),
        (7, F.lit(TABLE_HEADER)),
        (8, F.lit("=" * 80)),
        (10, F.lit("")),
    ]
    heads = open_.select(
        "priority", "regimen", F.explode(F.array(*[F.struct(F.lit(p).alias("part"), line.alias("line")) for p, line in fixed])).alias("h")
    )
    out = heads.select(
        "priority", "regimen", "h.part", F.lit(0).cast("long").alias("place"), null.alias("variant"),
        F.lit(0).alias("step"), null.alias("with_text"), "h.line",
    )
    # Only the strings of open regimens are numbered, those of each table for themselves.
    parts = F.filter(
        F.array(*[F.when(_on(bit), F.lit(part)) for bit, part in ((NEW, 3), (OLD, 5))]), lambda p: p.isNotNull()
    )
    listed = key_join(strings.select("regimen", "text", F.explode(parts).alias("part")), open_.select("regimen", "priority"), ["regimen"])
    place = F.col("_no") - 1
    out = out.unionByName(rows(
        numbered(listed, "text", "_no", ["regimen", "part"]), F.col("part"), F.concat_ws(" ", place.cast("string"), "text"), place
    ))

    kept = merged.groupBy("regimen", *ROW_KEYS).agg(F.max("with").alias("with"))
    kept = durable(key_join(kept, open_.select("regimen", "priority"), ["regimen"]))
    cells = [_shown(c) for c in ("regimen_cui", "component", "cyclesigs", "with", "variant", "allDays", "condition")]
    out = out.unionByName(
        rows(kept, 9, F.concat_ws(" | ", *cells), None, F.col("variant"), 1, F.col("with"))
    )
    variants = kept.select("priority", "regimen", "variant").distinct()
    first = variants.groupBy(F.col("regimen").alias("_r")).agg(F.min("variant").alias("_first"))
    later = variants.join(first, variants["regimen"] == first["_r"]).filter(~F.col("variant").eqNullSafe(F.col("_first")))
    out = out.unionByName(rows(later, 9, F.lit("-" * 80), None, F.col("variant"), 0))

    counts = status.agg(*[F.count_if(F.col("status") == s).cast("string").alias(s) for s in MARKS])
    top = [
        F.lit("### MATCH SUMMARY ###"),
        F.concat(F.lit(f"{MARKS['correct']} Correct: "), "correct"),
        F.concat(F.lit(f"{MARKS['partial']} Partially correct: "), "partial"),
        F.concat(F.lit(f"{MARKS['failed']} Failed: "), "failed"),
        F.lit("=" * 80),
        F.lit(""),
    ]
    summary = counts.select(F.posexplode(F.array(*top)).alias("place", "line")).select(
        F.lit(0).alias("priority"), F.lit("").alias("regimen"), "place", "line"
    )
    return out.unionByName(rows(summary, 0, F.col("line"), F.col("place")))


def sort_report(lines: DataFrame) -> DataFrame:
    """Report lines in reading order."""
    return lines.orderBy(
        "priority", "regimen", "part", "place", F.col("variant").asc_nulls_last(), "step",
        F.col("with_text").desc_nulls_last(), "line",
    )

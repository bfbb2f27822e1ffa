"""Secret scans: regular expressions verified only where an inverted index of trigrams allows a match.

Each rule's expression gives a Boolean query over trigrams that any match contains. The index holds,
for every trigram the queries name, the documents it occurs in; the postings of a document meet
in one row, where the queries are decided. A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import plain, stored
from cadenza.llm.trigrams import Query, trigram_query


@dataclass(frozen=True)
class Rule:
    """An expression; a match counts if its ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def query(self) -> Query:
        return trigram_query(self.pattern)


# The base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
# Published token formats of well-known services.
MORE = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
SPAN = "struct<start:bigint,rule:int,end:bigint,kind:string>"


def postings(docs: DataFrame, rules: tuple[Rule, ...], id: str = "id", text: str = "text") -> DataFrame:
    """The inverted index: ``(trigram, id)`` for every trigram that the rules' queries name."""
    named = sorted({t for r in rules for a in r.query or () for t in a})
    low = docs.select(plain(id).alias("id"), F.lower(plain(text)).alias("low"))
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in named]).cast("array<string>")
    return low.select(F.explode(held).alias("trigram"), "id").filter("trigram IS NOT NULL").distinct()


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(id, rules)``: of the rules that have a query, those that a document may match, as numbers."""

    def allowed(query: Query) -> Column:
        return reduce(
            Column.__or__, [F.size(F.array_intersect("held", F.array(*map(F.lit, sorted(a))))) == len(a) for a in sorted(query, key=sorted)]
        )

    # A document's row has at most the trigrams that the rules name.
    held = index.groupBy("id").agg(F.collect_set("trigram").alias("held"))
    some = F.array(*[F.when(allowed(r.query), F.lit(i)) for i, r in enumerate(rules) if r.query is not None]).cast("array<int>")
    return held.select("id", F.array_compact(some).alias("rules")).filter(F.size("rules") > 0)


def spans(text: Column, number: int, rule: Rule) -> Column:
    """The rule's spans in a text in code points: what lies between matches and the matches add up to them.

    A span sorts by its start, then by the number of its rule.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = matches if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.transform(F.split(text, rule.pattern, -1), lambda p: F.char_length(p))
    lengths = F.transform(matches, lambda m: F.char_length(m))
    counted = F.transform(judged, lambda m: F.char_length(m))
    steps = F.arrays_zip(between.alias("between"), lengths.alias("length"), counted.alias("counted"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))

    def step(state: Column, s: Column) -> Column:
        begin = state["at"] + s["between"]
        end = begin + F.coalesce(s["length"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(number).alias("rule"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(s["counted"] >= rule.least, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"))

    return F.when(text.rlike(rule.pattern if rule.group or rule.least == 1 else _long_enough(rule)), F.aggregate(steps, start, step)["found"]).otherwise(
        F.array().cast(f"array<{SPAN}>")
    )


def _long_enough(rule: Rule) -> str:
    """A cheaper test for a match that counts: the last element of the pattern ends in ``+``, so a long
    match is one with enough repetitions."""
    body = rule.pattern[:-1]
    fixed = len(body[: body.rindex("[")])
    return f"{body}{{{rule.least - fixed},}}"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, key: str = "doc_id", text: str = "text", out: str = "found") -> DataFrame:
    """All columns of every row and ``out``: the spans of all rules, by start, then rule.

    Null and empty texts have no spans. Rows that share an id, null included, share their postings and
    are verified one by one. ``out`` must not be a column of the input; other columns don't matter.
    """
    row = docs.select(plain(key).alias("id"), F.struct(*[plain(c) for c in docs.columns]).alias("row"))
    index = stored(postings(docs, rules, key, text), "postings")
    allowed = stored(candidates(index, rules), "candidates").withColumnRenamed("id", "candidate")
    whole = F.col("row")[text]
    verify = [
        spans(F.coalesce(whole, F.lit("")), i, r) if r.query is None
        else F.when(F.array_contains("rules", i), spans(whole, i, r)).otherwise(F.array().cast(f"array<{SPAN}>"))
        for i, r in enumerate(rules)
    ]
    found = row.join(allowed, F.col("id").eqNullSafe(F.col("candidate")), "left").select("row", F.array_sort(F.concat(*verify)).alias("spans"))
    return found.select("row.*", F.col("spans").alias(out))


def listed(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, found: Column, mark: str = "<secret>") -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return (
            F.when(s["end"] <= state["at"], state)
            .when(s["start"] < state["at"], F.struct(s["end"].alias("at"), state["parts"].alias("parts")))
            .otherwise(F.struct(s["end"].alias("at"), F.concat(state["parts"], F.array(between, F.lit(mark))).alias("parts")))
        )

    def finish(state: Column) -> Column:
        rest = F.substring(text, (state["at"] + 1).cast("int"), F.length(text))
        return F.array_join(F.concat(state["parts"], F.array(rest)), "")

    return F.when(F.size(found) > 0, F.aggregate(found, start, step, finish)).otherwise(text)

"""Personal data: fixed expressions as seeds, and contexts learned from them that find further identifiers.

What the expressions find are known instances. The words around them are lexical patterns; all identifiers in the
slot of such a pattern, known or not, are its instances. Rounds over this graph score a pattern by the known among
its instances and an instance by its patterns, until no further instance becomes known.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import per_row, plain, stored, text_slices
from cadenza.llm.words import BASE, U, hash_words, joined_bytes, mix, word_spans

# The base kinds, in the order in which they are listed, and their expressions.
KINDS = ("email", "ip", "card", "phone")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match begins and ends with whole runs of digits, so no other start in a run needs to be tried.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The kind of what patterns find.
LEARNED = "context"

# An identifier that no expression finds: so many characters, with so many digits or an @ inside.
LEAST_CHARS, MOST_CHARS, LEAST_DIGITS = 6, 64, 4
EDGES = "\"'`´‘’“”„«»()[]{}<>.,;:!?=*#%&$|/\\~^_-"
# A word that ends so is a label of what follows it.
LABEL_ENDS = b":=#"
# A pattern counts if so many different known instances stand in its slot and its score reaches this.
LEAST_KNOWN = 5
LEAST_PATTERN = 0.6
# An instance is known if one of its patterns does not fail with this probability, taken as independent.
LEAST_INSTANCE = 0.8
# Unknown identifiers speak against a pattern by so much; other words by one each.
UNKNOWN_WEIGHT = 0.5
# Patterns are looked for by so many bits of their hashes, so that this search needs a fixed amount of memory.
BUCKET_BITS = 20

Span = tuple[int, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost e-mail addresses: every @ with a domain behind it and what of a local part is before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        if domain:
            start = at
            while start > done and text[start - 1] in LOCAL_PART:
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    """Does the check digit fit?"""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of all base matches in code points, by start, then kind."""
    found = [(s, 0, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@dataclass(frozen=True)
class Contexts:
    """Words of some texts, and for each word the patterns whose slot it stands in (0: none of that kind)."""

    texts: list[str]
    data: np.ndarray
    starts: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    two_left: np.ndarray
    around: np.ndarray
    label: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Contexts:
        data, starts = joined_bytes(texts)
        begins, ends, firsts = word_spans(data, starts)
        words, _ = hash_words(texts)
        n = len(words)
        text_of = np.repeat(np.arange(len(texts)), np.diff(firsts))
        place = np.arange(n) - firsts[text_of]
        left = np.roll(words, 1)
        two_left = np.where(place >= 2, mix(np.roll(words, 2) * BASE + left), U(0))
        has_right = place < firsts[text_of + 1] - firsts[text_of] - 1
        around = np.where((place >= 1) & has_right, mix(left * BASE + mix(np.roll(words, -1))), U(0))
        labels = np.isin(data[ends - 1], list(LABEL_ENDS)) if n else np.zeros(0, dtype=bool)
        label = np.where((place >= 1) & np.roll(labels, 1), mix(left + U(1)), U(0))
        return cls(texts, data, starts, begins, ends, firsts, two_left, around, label)

    def word(self, i: int) -> str:
        return self.data[self.begins[i] : self.ends[i]].tobytes().lower().decode("utf-8", "surrogatepass")

    def patterns(self, first: int, last: int) -> list[dict]:
        """Patterns of a slot from one word to another one, each with its words."""
        out = []
        if self.two_left[first]:
            out.append((self.two_left, f"{self.word(first - 2)} {self.word(first - 1)} _"))
        if first == last and self.around[first]:
            out.append((self.around, f"{self.word(first - 1)} _ {self.word(first + 1)}"))
        if self.label[first]:
            out.append((self.label, f"{self.word(first - 1)} _"))
        return [{"pattern": int(kind[first].astype(np.int64)), "words": words} for kind, words in out]

    def found(self) -> tuple[list[list[dict]], list[list[dict]]]:
        """Base spans and slots of every text; a slot is a base match or an identifier outside of those."""
        digits = np.concatenate([[0], np.cumsum((self.data >= 48) & (self.data <= 57))])
        signs = np.concatenate([[0], np.cumsum(self.data == 64)])
        chars = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        likely = (digits[self.ends] - digits[self.begins] >= LEAST_DIGITS) | (signs[self.ends] > signs[self.begins])
        spans, slots = [], []
        for t, text in enumerate(self.texts):
            here, there = self.starts[t], self.starts[t + 1]
            if digits[here] == digits[there] and signs[here] == signs[there]:
                spans.append([])
                slots.append([])
                continue
            base = base_spans(text)
            first, last = int(self.firsts[t]), int(self.firsts[t + 1])
            begin = chars[self.begins[first:last]] - chars[here]
            own = []
            for s, _, e in base:
                a, b = (np.searchsorted(begin, [s, e - 1], side="right") - 1 + first).tolist()
                own.append({"start": s, "end": e, "value": text[s:e].lower(), "seed": True, "patterns": self.patterns(a, b)})
            for i in (np.flatnonzero(likely[first:last]) + first).tolist():
                s = int(begin[i - first])
                value = text[s : s + int(chars[self.ends[i]] - chars[self.begins[i]])]
                s += len(value) - len(value.lstrip(EDGES))
                value = value.strip(EDGES)
                e = s + len(value)
                enough = sum("0" <= c <= "9" for c in value) >= LEAST_DIGITS or "@" in value
                if LEAST_CHARS <= len(value) <= MOST_CHARS and enough and not any(a < e and s < b for a, _, b in base):
                    own.append({"start": s, "end": e, "value": value.lower(), "seed": False, "patterns": self.patterns(i, i)})
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
            slots.append(own)
        return spans, slots

    def every_pattern(self) -> np.ndarray:
        """The patterns of all words, as often as they occur."""
        every = np.concatenate([self.two_left, self.around, self.label])
        return every[every != 0]


SPANS = "array<struct<start:int,kind:int,end:int>>"
SLOTS = "array<struct<start:int,end:int,value:string,seed:boolean,patterns:array<struct<pattern:bigint,words:string>>>>"


def scanned(docs: DataFrame, keep: tuple[str, ...], text: str) -> DataFrame:
    """``(kept, digest, spans, slots)`` of every row; the digest stands for the text."""

    def setup() -> Callable[[pd.DataFrame], pd.DataFrame]:
        def work(part: pd.DataFrame) -> pd.DataFrame:
            spans, slots = Contexts.of(part["text"].tolist()).found()
            return pd.DataFrame({"spans": spans, "slots": slots})

        return work

    whole = F.coalesce(plain(text), F.lit(""))
    return docs.select(
        F.struct(*[plain(c).alias(f"k{i}") for i, c in enumerate(keep)]).alias("kept"), F.unhex(F.md5(whole.cast("binary"))).alias("digest"),
        per_row({"text": whole}, setup, f"spans {SPANS}, slots {SLOTS}").alias("f"),
    ).select("kept", "digest", "f.spans", "f.slots")


def occurrences(docs: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """``(pattern, total)``: at how many words in all texts each of some patterns stands."""
    bucket = F.shiftrightunsigned("pattern", 64 - BUCKET_BITS).cast("int").alias("bucket")
    wanted = np.zeros(1 << BUCKET_BITS, dtype=bool)
    # At most as many numbers as there are buckets.
    wanted[[r["bucket"] for r in patterns.select(bucket).distinct().collect()]] = True

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in text_slices(frames, "text"):
            every = Contexts.of(part["text"].tolist()).every_pattern()
            found, n = np.unique(every[wanted[every >> U(64 - BUCKET_BITS)]], return_counts=True)
            yield pd.DataFrame({"pattern": found.astype(np.int64), "n": n})

    counted = docs.select(plain(text).alias("text")).mapInPandas(count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    return counted.join(patterns.select("pattern"), "pattern", "left_semi")


@dataclass(frozen=True)
class Learned:
    """``instances`` (value) that became known, ``patterns`` (pattern, words, known, score) that count, and how many rounds it took."""

    instances: DataFrame
    patterns: DataFrame
    rounds: int


def bootstrap(slots: DataFrame, totals: Callable[[DataFrame], DataFrame]) -> Learned | None:
    """Patterns and instances learned from ``(value, seed, pattern, words)``, a row per slot and pattern.

    A pattern's score is known / (known + UNKNOWN_WEIGHT * unknown + others), where known and unknown are different
    instances and others the occurrences of the pattern before other words, so copies of a text can lower
    a score, but not raise it. Known instances only add up, so scores only rise, and the rounds end.
    None if no pattern has enough instances. Every round is a stored table.
    """
    edges = stored(slots.groupBy("pattern", "value").agg(F.max("seed").alias("seed"), F.min("words").alias("words"), F.count(F.lit(1)).alias("n")), "edges")
    enough = stored(
        edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n"), F.min("words").alias("words"))
        .filter(F.col("values") >= LEAST_KNOWN), "patterns",
    )
    if enough.isEmpty():
        return None
    others = stored(enough.join(totals(enough), "pattern", "left").select(
        "pattern", "words", F.greatest(F.coalesce("total", F.lit(0)) - F.col("n"), F.lit(0)).alias("others")
    ), "others")
    graph = stored(edges.join(enough.select("pattern"), "pattern", "left_semi").select("pattern", "value", "seed"), "graph")
    known = stored(edges.filter("seed").select("value").distinct(), "known")
    seeds, rounds = known, 0
    while True:
        rounds += 1
        marked = graph.join(known.withColumn("known", F.lit(True)), "value", "left")
        weighed = marked.groupBy("pattern").agg(F.count("known").alias("known"), F.count_if(F.col("known").isNull()).alias("unknown")).join(others, "pattern")
        score = F.col("known") / (F.col("known") + UNKNOWN_WEIGHT * F.col("unknown") + F.col("others"))
        patterns = stored(
            weighed.select("pattern", "words", "known", score.alias("score"))
            .filter((F.col("known") >= LEAST_KNOWN) & (F.col("score") >= LEAST_PATTERN)), "accepted",
        )
        # One less the product of what each pattern leaves open.
        sure = F.lit(1) - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
        reached = graph.join(patterns.select("pattern", "score"), "pattern").groupBy("value").agg(sure.alias("sure")).filter(F.col("sure") >= LEAST_INSTANCE)
        fresh = stored(reached.select("value").join(known, "value", "left_anti"), "fresh")
        if fresh.isEmpty():
            return Learned(known.join(seeds, "value", "left_anti"), patterns, rounds)
        known = stored(known.unionByName(fresh), "known")


def learn(docs: DataFrame, found: DataFrame, text: str = "text") -> Learned | None:
    """``bootstrap`` over the slots that ``scanned`` has found in all texts."""
    slots = found.select(F.explode("slots").alias("s")).select("s.value", "s.seed", F.explode("s.patterns").alias("p"))
    return bootstrap(slots.select("value", "seed", "p.pattern", "p.words"), lambda patterns: occurrences(docs, text, patterns))


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and ``found`` of every row: spans ``(start, kind, end)`` by start, then kind.

    Kinds below ``len(KINDS)`` are the base ones, the one after them (``LEARNED``) are identifiers that the learned
    patterns have found; they never overlap a base span and count wherever they occur as a word. Null
    and empty texts have no spans; repeated rows each get their row. ``found`` must not be among ``keep``; other
    columns don't matter.
    """
    rows = stored(scanned(docs, keep, text), "scanned")
    learned = learn(docs, rows, text)
    kept = [F.col(f"kept.k{i}").alias(c) for i, c in enumerate(keep)]
    if learned is None:
        return rows.select(*kept, F.col("spans").alias("found"))
    open_slots = F.filter("slots", lambda s: ~s["seed"])
    asked = rows.filter(F.size(open_slots) > 0).select("digest", F.explode(open_slots).alias("s")).select("digest", "s.start", "s.end", "s.value").distinct()
    more = asked.join(learned.instances, "value").groupBy("digest").agg(
        F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).alias("more")
    )
    # Only rows with an open slot can get more spans.
    without = rows.filter(F.size(open_slots) == 0).select("kept", "spans")
    extended = rows.filter(F.size(open_slots) > 0).join(stored(more, "more"), "digest", "left").select(
        "kept", F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", "more"))).alias("spans")
    )
    return without.unionByName(extended).select(*kept, F.col("spans").alias("found"))


def listed(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, LEARNED)])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Numbers of the base kinds per row, a digest of their spans, and all spans."""
    base = F.filter("found", lambda s: s["kind"] < len(KINDS))

    def count(number: int, kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return scan(docs, (key,), text).select(
        plain(key), *[count(i, k) for i, k in enumerate(KINDS)],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
    )

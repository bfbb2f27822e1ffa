"""Conversation structure repair: cheapest edits that give each conversation the roles ``(s?(ua)+)?``.

The costs to go before a row, for the four places in that pattern, depend on the costs after it and on the
row's symbol alone (its role and faults). Less their least one, these costs take few values, so the step
over any block of ``BLOCK`` symbols is looked up in a table that is computed beforehand (the Four-Russians method).
A conversation is passed backward block by block; then each block is expanded backward from the costs
behind it and the edits are read forward, the ASCII-least of the cheapest ones.

A conversation may be longer than a task can hold: rows are sorted by ranges, not by conversation, and cut into
pieces. A piece's step is a table over all costs that may follow it, so a conversation's pieces
exchange one small row each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import plain, stored

BLOCK = 4
# A piece of a conversation has at most so many rows, and about so many characters.
PIECE_ROWS = 4096
PIECE_CHARS = 1_000_000

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
# Places in the pattern, the place after the next row that it asks for, and the role of that row.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ASKED = ("user", "user", "assistant", "user")
DELETE, INSERT, REROLE = 3, 2, 2
# Symbols: a row that has to go; else 1 + 2 * (place in the list of initials) + (is it truncated).
GONE = 0
INITIALS = ("s", "u", "a", "")
SYMBOLS = 1 + 2 * len(INITIALS)
LEGAL_PAIRS = ("su", "ua", "au")
# From which places a row may be kept, and the place after it, by the number of its initial.
KEEPS = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
# Costs to go after the last row: the pattern may end at the start or after an assistant.
END = (0, 4, 2, 0)

Costs = tuple[int, ...]


def step(symbol: int, after: Costs) -> Costs:
    """Costs to go before a row, from those after it."""
    best = [DELETE + c for c in after]
    if symbol != GONE:
        initial, truncated = divmod(symbol - 1, 2)
        for place, to in enumerate(NEXT):
            best[place] = min(best[place], REROLE + truncated + after[to])
        for place, to in KEEPS[initial].items():
            best[place] = min(best[place], truncated + after[to])
    # More than two insertions in a row lead back to the same place.
    for _ in range(2):
        best = [min(c, INSERT + best[NEXT[place]]) for place, c in enumerate(best)]
    return tuple(best)


class Blocks:
    """The normalised costs that occur, and their steps over every symbol and every block of symbols."""

    def __init__(self) -> None:
        self.costs: list[Costs] = [END]
        self.number: dict[Costs, int] = {END: 0}
        to, gain = [], []
        for costs in self.costs:  # grows while it is read
            to.append([])
            gain.append([])
            for symbol in range(SYMBOLS):
                before = step(symbol, costs)
                least = min(before)
                normal = tuple(c - least for c in before)
                if normal not in self.number:
                    self.number[normal] = len(self.costs)
                    self.costs.append(normal)
                to[-1].append(self.number[normal])
                gain[-1].append(least)
        self.to_one, self.gain_one = np.array(to), np.array(gain)
        self.to, self.gain = self.to_one, self.gain_one
        for _ in range(BLOCK - 1):
            # One more symbol in front: first the step over the block behind it, then its own.
            first = self.to_one[self.to].transpose(0, 2, 1).reshape(len(to), -1)
            more = (self.gain[:, :, None] + self.gain_one[self.to]).transpose(0, 2, 1).reshape(len(to), -1)
            self.to, self.gain = first, more

    def steps(self, symbols: np.ndarray) -> tuple[list[int], int]:
        """The numbers of a piece's blocks from the first to the last, and how many symbols are left behind them."""
        full = len(symbols) // BLOCK
        weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        return (symbols[: full * BLOCK].reshape(full, BLOCK).astype(np.int64) @ weights).tolist(), len(symbols) - full * BLOCK

    def across(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A piece's step: for all costs that may follow it, the costs before it and what they gain."""
        at, gained = np.arange(len(self.costs)), np.zeros(len(self.costs), dtype=np.int64)
        codes, rest = self.steps(symbols)
        for symbol in symbols[len(symbols) - rest :][::-1].tolist():
            gained, at = gained + self.gain_one[at, symbol], self.to_one[at, symbol]
        for code in reversed(codes):
            gained, at = gained + self.gain[at, code], self.to[at, code]
        return at, gained

    def behind(self, symbols: np.ndarray, after: int) -> tuple[list[int], int, int]:
        """Numbers of the costs behind each block (the last one: behind the piece), of those before the piece, and their gain."""
        codes, rest = self.steps(symbols)
        at, gained, found = after, 0, [after] if rest else []
        for symbol in symbols[len(symbols) - rest :][::-1].tolist():
            gained, at = gained + int(self.gain_one[at, symbol]), int(self.to_one[at, symbol])
        for code in reversed(codes):
            found.append(at)
            gained, at = gained + int(self.gain[at, code]), int(self.to[at, code])
        return found[::-1], at, gained

    def edits(self, symbols: np.ndarray, behind: list[int], place: int) -> tuple[str, int]:
        """The ASCII-least of the cheapest edits from a place on, and the place after the piece."""
        out = []
        for block, after in enumerate(behind):
            own = symbols[block * BLOCK : (block + 1) * BLOCK].tolist()
            costs = [self.costs[after]]
            for symbol in reversed(own):
                costs.append(step(symbol, costs[-1]))
            costs.reverse()
            for at, symbol in enumerate(own):
                initial, truncated = divmod(symbol - 1, 2)
                here, there = costs[at], costs[at + 1]
                while True:
                    left = here[place]
                    if DELETE + there[place] == left:
                        out.append("D")
                        break
                    if INSERT + here[NEXT[place]] == left:
                        out.append("I")
                        place = NEXT[place]
                        continue
                    kept = KEEPS[initial].get(place) if symbol != GONE else None
                    if kept is not None and truncated + there[kept] == left:
                        out.append("K")
                        place = kept
                    else:
                        out.append("R")
                        place = NEXT[place]
                    break
        return "".join(out), place


@cache
def blocks() -> Blocks:
    """The tables, computed once per process."""
    return Blocks()


def closing(place: int) -> str:
    """The edits behind the last row."""
    return "I" * {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[place]


def read(roles: list[str], texts: list[str], seen: set, marks: list) -> tuple[np.ndarray, dict[str, int]]:
    """Symbols of a piece's rows and the number of each fault; ``marks`` tell equal rows, ``seen`` those of earlier pieces."""
    symbols = np.zeros(len(roles), dtype=np.uint8)
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    for i, (role, text, mark) in enumerate(zip(roles, texts, marks, strict=True)):
        written = text.rstrip(WHITE)
        if not written:
            faults["blank"] += 1
        elif mark in seen:
            faults["duplicate"] += 1
        else:
            truncated = written[-1] not in ".!?"
            faults["truncated"] += truncated
            initial = role[:1]
            symbols[i] = 1 + 2 * (INITIALS.index(initial) if initial in INITIALS else 3) + truncated
        seen.add(mark)
    return symbols, faults


def illegal_pairs(initials: list[str]) -> int:
    """Adjacent roles that the pattern does not allow."""
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:], strict=False))


def applied(audit: str, place: int, roles: list[str], texts: list[str]) -> list[dict[str, str]]:
    """The rows that the edits leave, each with its edit."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        asked = ASKED[place]
        if edit == "I":
            out.append({"edit": edit, "role": asked, "text": ""})
            place = NEXT[place]
            continue
        out.append({"edit": edit, "role": roles[at] if edit == "K" else asked, "text": texts[at]})
        place = KEEPS[INITIALS.index(roles[at][:1])][place] if edit == "K" else NEXT[place]
        at += 1
    return out


TURNS = "array<struct<edit:string,role:string,text:string>>"
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
PIECE = (
    "key string, part int, piece int, done boolean, " + ", ".join(f"{c} long" for c in COUNTS)
    + f", audit string, turns {TURNS}, roles array<string>, texts array<string>"
)
PIECE_COLUMNS = [c.split(" ")[0] for c in PIECE.split(", ")]


def whole(key: str | None, part: int, roles: list[str], texts: list[str]) -> tuple:
    """A conversation that is all in one piece, repaired."""
    table = blocks()
    symbols, faults = read(roles, texts, set(), list(zip(roles, texts, strict=True)))
    behind, at, gained = table.behind(symbols, 0)
    audit, place = table.edits(symbols, behind, START)
    audit += closing(place)
    return (
        key, part, 0, True, *faults.values(), illegal_pairs([r[:1] for r in roles]), gained + table.costs[at][START], audit,
        applied(audit, START, roles, texts), None, None,
    )


def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows as pieces of conversations.

    Those that begin and end inside of this part of the table are repaired at once, if they are one piece; the
    first and the last one may go on in other parts, so their pieces are returned as they are.
    """
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    key, roles, texts, size, number, first, held = None, [], [], 0, 0, True, 0

    def close(last: bool) -> None:
        if number == 0 and not first and not last:
            out.append(whole(key, part, roles, texts))
        else:
            out.append((key, part, number, False, *[None] * (len(COUNTS) + 2), roles, texts))

    for frame in frames:
        for k, role, text in zip(frame["key"].tolist(), frame["role"].tolist(), frame["text"].tolist(), strict=True):
            if roles and k != key:
                close(False)
                held += size
                roles, texts, size, number, first = [], [], 0, 0, False
            elif len(roles) >= PIECE_ROWS or size + len(text) > PIECE_CHARS and roles:
                out.append((key, part, number, False, *[None] * (len(COUNTS) + 2), roles, texts))
                held += size
                roles, texts, size, number = [], [], 0, number + 1
            key = k
            roles.append(role)
            texts.append(text)
            size += len(text)
            if held >= PIECE_CHARS or len(out) >= PIECE_ROWS:
                yield pd.DataFrame(out, columns=PIECE_COLUMNS)
                out, held = [], 0
    if roles:
        close(True)
    if out:
        yield pd.DataFrame(out, columns=PIECE_COLUMNS)


def in_order(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(key, role, text)`` sorted over all tasks by conversation and turn.

    Ranges may cut a conversation anywhere, also between equal rows. Nulls in role and text are one space.
    """
    def spaced(name: str) -> Column:
        return F.coalesce(plain(name).cast("string"), F.lit(" "))

    keyed = rows.select(
        conversation_key(plain(conv)).alias("key"), plain(turn).alias("turn"), spaced(role).alias("role"), spaced(text).alias("text")
    ).select("*", F.left("text", F.lit(64)).alias("begin"), F.xxhash64("text").alias("hash"), F.rand(0).alias("any"))
    order = ["key", F.col("turn").asc_nulls_first(), "role", "begin", "hash"]
    # Equal rows are dealt out at random: which of them comes first makes no difference.
    return keyed.repartitionByRange(*order, "any").sortWithinPartitions(*order).select("key", "role", "text")


def conversation_key(conv: Column) -> Column:
    """A text for each conversation, the one without an id among them."""
    return F.coalesce(F.concat(F.lit(":"), conv.cast("string")), F.lit(""))


IDS = ["key", "part", "piece"]


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Every conversation's faults and cheapest edits, and its repaired rows.

    Rows are taken by turn (nulls first), rows of equal turn by role, first 64 characters and hash of the text.
    A null role or text is one space; a null conversation is one of its own. Empty tables give empty results.
    Other columns don't matter.

    Returns ``(key, blank, duplicate, truncated, illegal, cost, audit)`` per conversation, where ``key`` is
    ``conversation_key`` of its id, and ``(key, part, piece, done, turns)``: the repaired rows, each with its edit, in
    pieces by ``part`` and ``piece``; conversations that are ``done`` have one piece.

    A conversation within a task is repaired there. For the others, no task holds more than one piece
    of rows; one row of some hundred numbers for each of their pieces meets in one task per conversation.
    """
    pieces = stored(in_order(rows, conv, turn, role, text).mapInPandas(cut, PIECE), "pieces")
    done = pieces.filter("done")
    cut_up = pieces.filter("NOT done").select(*IDS, "roles", "texts")
    summary, turns = repaired_pieces(cut_up)
    return (
        done.select("key", *COUNTS, "audit").unionByName(summary),
        done.select(*IDS, "done", "turns").unionByName(turns),
    )


def repaired_pieces(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``repair`` for conversations given as ``(key, part, piece, roles, texts)``, in any number of pieces."""
    mark = F.transform(F.arrays_zip("roles", "texts"), lambda r: F.md5(F.concat_ws(":", F.length(r["roles"]), r["roles"], r["texts"]).cast("binary")))
    marked = pieces.withColumn("marks", mark)
    # Rows that an earlier piece of the conversation holds.
    held = marked.select("key", F.struct("part", "piece").alias("at"), F.explode(F.array_distinct("marks")).alias("mark"))
    first = held.groupBy("key", "mark").agg(F.min("at").alias("first"))
    later = held.join(first, ["key", "mark"]).filter(F.col("at") > F.col("first"))
    seen = later.groupBy("key", "at").agg(F.collect_list("mark").alias("seen")).select("key", "at.part", "at.piece", "seen")

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = blocks()
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                roles, seen_before = list(r.roles), set() if r.seen is None else set(r.seen)
                symbols, faults = read(roles, list(r.texts), seen_before, list(r.marks))
                to, gain = table.across(symbols)
                initials = [x[:1] for x in roles]
                out.append((r.key, r.part, r.piece, symbols.tobytes(), to, gain, *faults.values(), illegal_pairs(initials), initials[0], initials[-1]))
            yield pd.DataFrame(out, columns=[*IDS, "symbols", "to", "gain", *COUNTS[:4], "opens", "ends"])

    kinds = "key string, part int, piece int"
    steps = stored(marked.join(seen, IDS, "left").mapInPandas(
        summarise, f"{kinds}, symbols binary, to array<int>, gain array<long>, {', '.join(f'{c} long' for c in COUNTS[:4])}, opens string, ends string"
    ), "steps")

    def backward(own: pd.DataFrame) -> pd.DataFrame:
        table = blocks()
        own = own.sort_values(["part", "piece"])
        after, cost, found = 0, 0, []
        for to, gain in zip(own["to"][::-1], own["gain"][::-1], strict=True):
            found.append(after)
            cost, after = cost + int(gain[after]), int(to[after])
        between = illegal_pairs([x for pair in zip(own["opens"], own["ends"], strict=True) for x in pair]) - illegal_pairs_inside(own)
        return pd.DataFrame({
            **{c: own[c] for c in [*IDS, *COUNTS[:3]]}, "illegal": own["illegal"] + ([between] + [0] * (len(own) - 1)),
            "cost": [cost + table.costs[after][START]] + [0] * (len(own) - 1), "after": found[::-1],
        })

    known = stored(steps.drop("symbols").groupBy("key").applyInPandas(
        backward, f"{kinds}, {', '.join(f'{c} long' for c in COUNTS)}, after int"
    ), "costs")

    def trace(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = blocks()
        for frame in frames:
            audits = []
            for packed, after in zip(frame["symbols"], frame["after"], strict=True):
                symbols = np.frombuffer(packed, dtype=np.uint8)
                behind = table.behind(symbols, int(after))[0]
                audits.append([dict(zip(("audit", "to"), table.edits(symbols, behind, place), strict=True)) for place in range(len(NEXT))])
            yield frame[IDS].assign(ways=audits)

    # How a piece is edited depends on the place before it: all four ways are traced.
    ways = steps.select(*IDS, "symbols").join(known.select(*IDS, "after"), IDS).mapInPandas(
        trace, f"{kinds}, ways array<struct<audit:string,to:int>>"
    )

    def forward(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["part", "piece"])
        place, places, audits = START, [], []
        for way in own["ways"]:
            places.append(place)
            audits.append(way[place]["audit"])
            place = way[place]["to"]
        audits[-1] += closing(place)
        return own[IDS].assign(place=places, audit=audits)

    edits = stored(ways.groupBy("key").applyInPandas(forward, f"{kinds}, place int, audit string"), "edits")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[IDS].assign(done=False, turns=[
                applied(r.audit, int(r.place), list(r.roles), list(r.texts)) for r in frame.itertuples(index=False)
            ])

    turns = pieces.join(edits, IDS).mapInPandas(write, f"{kinds}, done boolean, turns {TURNS}")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "piece", "audit"))), lambda p: p["audit"]), "")
    counts = known.groupBy("key").agg(*[F.sum(c).alias(c) for c in COUNTS])
    return counts.join(edits.groupBy("key").agg(audit.alias("audit")), "key"), turns


def illegal_pairs_inside(own: pd.DataFrame) -> int:
    """Those pairs of a piece's first and last role that ``backward`` counts though they are no neighbours."""
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(own["opens"], own["ends"], strict=True))


def content_hashes(turns: DataFrame) -> DataFrame:
    """``(key, repaired_sha256)`` over the repaired ``role:text``, joined by line feeds.

    The hash of a conversation of several pieces can only be computed from its first to its last byte: its pieces
    pass through one task in order, one at a time.
    """
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    lines = turns.select(*IDS, "done", line.alias("lines"))
    alone = lines.filter("done").select("key", F.sha2(F.array_join("lines", "\n").cast("binary"), 256).alias("repaired_sha256"))

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, begun = None, None, False
        for frame in frames:
            for k, own in zip(frame["key"], frame["lines"], strict=True):
                if state is None or k != key:
                    if state is not None:
                        yield pd.DataFrame({"key": [key], "repaired_sha256": [state.hexdigest()]})
                    key, state, begun = k, hashlib.sha256(), False
                for one in own:
                    state.update(("\n" * begun + one).encode())
                    begun = True
        if state is not None:
            yield pd.DataFrame({"key": [key], "repaired_sha256": [state.hexdigest()]})

    several = lines.filter("NOT done").repartition("key").sortWithinPartitions(*IDS).select("key", "lines")
    return alone.unionByName(several.mapInPandas(digest, "key string, repaired_sha256 string"))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text)`` of the rows after damage by a hash of conversation and turn; nulls of role and text, and in the hash, are one space."""
    def spaced(name: str) -> Column:
        return F.coalesce(plain(name).cast("string"), F.lit(" "))

    code = F.pmod(F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn)).cast("binary")), F.lit(20))
    coded = rows.select(plain(conv).alias("conv"), plain(turn).alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"), code.alias("code"))
    return coded.filter("code <> 0").select(
        "conv", "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def gaps(rows: DataFrame, conv: str = "conv", turn: str = "turn") -> DataFrame:
    """``(key, gaps)``: turns that a conversation lacks between its first and its last; nulls are no turns, without any there is no gap.

    Null where no long holds the number.
    """
    turns = rows.select(conversation_key(plain(conv)).alias("key"), plain(turn).alias("turn")).distinct()
    span = F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), F.lit(1) - F.count("turn"))
    return turns.groupBy("key").agg(F.when(F.count("turn") == 0, F.lit(0)).otherwise(span).cast("long").alias("gaps"))


def report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damage, repair and count: one row per conversation of the table, also for those that lose all their rows."""
    after = damaged(rows, conv, turn, role, text)
    summary, turns = repair(after, "conv")
    ids = rows.select(plain(conv).alias("conv")).distinct().select(conversation_key(F.col("conv")).alias("key"), "conv")
    joined = ids.join(gaps(after), "key", "left").join(summary, "key", "left").join(content_hashes(turns), "key", "left")
    none = hashlib.sha256(b"").hexdigest()
    counted = [F.when(F.col("audit").isNull(), F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in ("gaps", *COUNTS)]
    return joined.select(
        F.col("conv").alias(conv), *counted, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256")
    )

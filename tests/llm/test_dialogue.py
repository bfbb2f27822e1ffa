"""Conversation repair against a plain search over whole conversations."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cadenza.llm import dialogue

SCHEMA = "conv_id long, turn long, role string, text string"
CLASHING = ("key", "part", "piece", "done", "audit", "turns", "roles", "texts", "conv", "code", "cost", "gaps", "begin", "hash", "any", "marks", "seen", "after", "to")
NONE = hashlib.sha256(b"").hexdigest()


def plain_repair(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, lines) of (role, text) rows in order, by their description."""
    seen, kinds = set(), []
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            kinds.append("blank")
        elif (role, text) in seen:
            kinds.append("duplicate")
        elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            kinds.append("truncated")
        else:
            kinds.append("")
        seen.add((role, text))

    def fits(initials):
        """Is it a beginning of the pattern?"""
        return re.fullmatch(r"s?(ua)*u?", initials) is not None

    def shape(initials):
        """What of the initials so far matters for those to come."""
        return initials if initials in ("", "s") else initials[-1]

    # Insertions: as rows that may be put in anywhere, by relaxing over (row, shape) until nothing gets cheaper.
    shapes = ["", "s", "u", "a"]
    table = {}
    for i in range(len(rows), -1, -1):
        here = {}
        for so_far in shapes:
            ways = [(0, "", ())] if i == len(rows) and so_far in ("", "a") else []
            if i < len(rows):
                role, text = rows[i]
                ways.append((3 + table[i + 1, so_far][0], "D" + table[i + 1, so_far][1], table[i + 1, so_far][2]))
                if kinds[i] not in ("blank", "duplicate"):
                    more = int(kinds[i] == "truncated")
                    for cost, edit, new in [(more, "K", role), (2 + more, "R", "user"), (2 + more, "R", "assistant")]:
                        whole = ("ua" if so_far == "a" else so_far) + (new[:1] or "?")
                        if fits(whole):
                            c, e, lines = table[i + 1, shape(whole)]
                            ways.append((cost + c, edit + e, ((new, text), *lines)))
            here[so_far] = min(ways, default=(10**9, "~", ()))
        for _ in range(6):
            for so_far in shapes:
                for new in ("user", "assistant"):
                    whole = ("ua" if so_far == "a" else so_far) + new[0]
                    if fits(whole):
                        c, e, lines = here[shape(whole)]
                        here[so_far] = min(here[so_far], (2 + c, "I" + e, ((new, ""), *lines)))
        table |= {(i, s): w for s, w in here.items()}
    cost, audit, lines = table[0, ""]
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return (kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, [f"{r}:{t}" for r, t in lines])


def plain_report(table):
    """The query's row per conversation, from the description of the damage."""
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in table:
            if c != conv:
                continue
            role, text = (" " if x is None else x for x in (role, text))
            code = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if code == 0:
                continue
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            rows += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {r[0] for r in rows} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        if rows:
            *counts, audit, lines = plain_repair([r[1:] for r in rows])
            out.append((conv, gaps, *counts, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
        else:
            out.append((conv, 0, 0, 0, 0, 0, 0, "", NONE))
    return out


def some_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "s", "usher", None]
    texts = ["Yes.", "No!", "cut off", "  ", "", "Well? \n", "a.b", None, "Why", "é…", "End.\x0b\t"]
    return [(rng.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.6 else f"t{rng.randrange(99)}.") for _ in range(n)]


def frame(session, rows):
    return session.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'x' AS {c}" for c in CLASHING])


def test_block_tables_equal_single_steps():
    table = dialogue.blocks()
    rng = random.Random(1)
    for _ in range(200):
        symbols = np.array([rng.randrange(dialogue.SYMBOLS) for _ in range(rng.randrange(1, 30))], dtype=np.uint8)
        after = rng.randrange(len(table.costs))
        costs = table.costs[after]
        for symbol in symbols[::-1].tolist():
            costs = dialogue.step(symbol, costs)
        to, gain = table.across(symbols)
        behind, before, gained = table.behind(symbols, after)
        assert (to[after], gain[after]) == (before, gained)
        assert tuple(c + gained for c in table.costs[before]) == costs
        assert len(behind) == -(-len(symbols) // dialogue.BLOCK)


def test_edits_equal_a_plain_search():
    rng = random.Random(2)
    for n in [1, 2, 3] * 60 + [5, 8, 13, 30] * 20:
        rows = [(" " if r is None else r, " " if t is None else t) for r, t in some_rows(rng, n)]
        got = dialogue.whole("k", 0, *map(list, zip(*rows, strict=True)))
        lines = [f"{t['role']}:{t['text']}" for t in got[10]]
        assert (*got[4:10], lines) == plain_repair(rows), rows


def test_pieces_equal_whole_conversations(session):
    rng = random.Random(3)
    pieces, expected, hashes = [], {}, {}
    for c in range(40):
        rows = [(r or "", t or " ") for r, t in some_rows(rng, rng.randrange(1, 40))]
        *counts, audit, lines = plain_repair(rows)
        expected[f":{c}"] = (*counts, audit)
        hashes[f":{c}"] = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        at, number = 0, 0
        while at < len(rows):
            own = rows[at : at + rng.randrange(1, 12)]
            pieces.append((f":{c}", number // 3, number % 3, [r for r, _ in own], [t for _, t in own]))
            at, number = at + len(own), number + 1
    given = session.createDataFrame(pieces, "key string, part int, piece int, roles array<string>, texts array<string>")
    summary, turns = dialogue.repaired_pieces(given)
    assert {r.key: tuple(r[c] for c in (*dialogue.COUNTS, "audit")) for r in summary.collect()} == expected
    assert {r.key: r.repaired_sha256 for r in dialogue.content_hashes(turns).collect()} == hashes


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_whole_tables(session, coalesce):
    rng = random.Random(4)
    rows = []
    for conv in [*range(60), None]:
        for turn, (role, text) in enumerate(some_rows(rng, rng.randrange(1, 9))):
            rows.append((conv, turn + rng.randrange(2), role, text))
    rows += [(1000, turn, ("user", "assistant")[turn % 2], f"turn {turn}" + "." * (turn % 5 > 0)) for turn in range(300)]  # most of the table
    rows += [(1001, None, "user", "Hi."), (1001, None, "assistant", "Yes."), (1002, -(2**62), "user", "Hi."), (1002, 2**62, "assistant", "x." * 60_000)]
    rows += [(1003, 5, "user", "Same.")] * 50 + [rows[0], rows[0]]
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = dialogue.report(frame(session, rows))
        assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_report(rows)))
    finally:
        session.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_tables(session):
    assert dialogue.report(frame(session, [])).count() == 0
    # The hash drops the only row of one of these.
    rows = [(c, 0, "user", "Hi.") for c in range(40)]
    got = sorted(map(tuple, dialogue.report(frame(session, rows)).collect()))
    assert got == sorted(plain_report(rows)) and any(r[-1] == NONE for r in got)

"""Personal data against the plain expressions, and learned contexts against a plain search over words."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict


from cadenza.llm import personal

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CLASHING = ("kept", "digest", "spans", "slots", "found", "value", "seed", "pattern", "words", "n", "known", "score", "more", "f", "k0", "total", "start", "end")


def checks(number):
    twice = [2 * int(d) for d in number[-2::-2]]
    return (sum(map(int, number[-1::-2])) + sum(t - 9 * (t > 9) for t in twice)) % 10 == 0


def plain_base(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        number = re.sub("[^0-9]", "", m.group())
        if 12 <= len(number) <= 19 and checks(number):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def plain_scan(texts):
    """Spans of every text, patterns being lower-case words around a slot."""
    low = [[(m.start(), m.end(), re.sub("[A-Z]", lambda c: c.group().lower(), m.group())) for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] for t in texts]

    def around(words, a, b):
        out = []
        if a >= 2:
            out.append(("two", words[a - 2][2], words[a - 1][2]))
        if a == b and a >= 1 and b + 1 < len(words):
            out.append(("both", words[a - 1][2], words[b + 1][2]))
        if a >= 1 and words[a - 1][2][-1] in ":=#":
            out.append(("label", words[a - 1][2]))
        return out

    totals, slots = defaultdict(int), []
    for t, words in zip(texts, low, strict=True):
        base, own = plain_base(t), []
        for i in range(len(words)):
            for p in around(words, i, i):
                totals[p] += 1
        for s, _, e in base:
            a = max(i for i, w in enumerate(words) if w[0] <= s)
            b = max(i for i, w in enumerate(words) if w[0] <= e - 1)
            own.append((s, e, t[s:e].lower(), True, around(words, a, b)))
        for i, (s, e, _) in enumerate(words):
            value = t[s:e].strip(personal.EDGES)
            s += len(t[s:e]) - len(t[s:e].lstrip(personal.EDGES))
            e = s + len(value)
            if 6 <= len(value) <= 64 and (len(re.findall("[0-9]", value)) >= 4 or "@" in value) and not any(a < e and s < b for a, _, b in base):
                own.append((s, e, value.lower(), False, around(words, i, i)))
        slots.append((base, own))
    instances, occurs = defaultdict(dict), defaultdict(int)
    for _, own in slots:
        for _, _, value, seed, patterns in own:
            for p in patterns:
                instances[p][value] = instances[p].get(value, False) or seed
                occurs[p] += 1
    known = {v for _, own in slots for _, _, v, seed, patterns in own if seed}
    seeds, scores = set(known), {}
    while True:
        scores = {}
        for p, values in instances.items():
            k = sum(v in known for v in values)
            score = k / (k + 0.5 * (len(values) - k) + max(0, totals[p] - occurs[p])) if len(values) >= 5 else 0
            if k >= 5 and score >= 0.6:
                scores[p] = score
        open_ = defaultdict(lambda: 1.0)
        for p, score in scores.items():
            for v in instances[p]:
                open_[v] *= 1 - score
        fresh = {v for v, o in open_.items() if 1 - o >= 0.8 - 1e-12} - known
        if not fresh:
            break
        known |= fresh
    out = []
    for base, own in slots:
        out.append(sorted(base + [(s, 4, e) for s, e, v, seed, _ in own if not seed and v in known - seeds]))
    return out, {p: s for p, s in scores.items()}


def test_base_expressions():
    rng = random.Random(1)
    alphabets = ["ab.@_%-é 1", "0123.. 9", "0123456789 -", "+01 ().-2345", "a1@.+-( é"]
    texts = ["".join(rng.choices(a, k=rng.randrange(1, 60))) for a in alphabets for _ in range(1500)]
    texts += ["4952935900253052 and 4952-9359-0025-3052, 4952 9359 0025 3053", "0255.000.1.256 0255.000.1.255", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f @x.y", "+1 (017) 555-7713"]
    for t in texts:
        assert personal.base_spans(t) == plain_base(t), t


def test_long_texts_take_time_in_proportion():
    for t in ("a" * 300_000, "1" * 300_000, "@" * 200_000, "1." * 100_000, "a.@" * 100_000, "+1" + " " * 200_000, "-" * 200_000 + "@a.b"):
        assert len(personal.base_spans(t)) <= 2 or t.startswith("1.")


def corpus(rng):
    names = ["Ada", "Bo", "Cy", "Di", "Ed"]
    word = lambda: "".join(rng.choices("aeioubdg", k=5))
    texts = []
    for i in range(14):
        texts.append(f"{word()} {word()} call me: +1 (555) 010-{1000 + i} now {word()}")
        texts.append(f"write to agent{i}@mail.example.org or {word()} in {1990 + i}00")
    hidden = [f"AB-{rng.randrange(10**6, 10**7)}-X" for _ in range(6)]
    for h in hidden[:4]:
        texts.append(f"please call me: {h} now {word()}")
    # Found in a second round: the words beside those that the first round has found.
    for h in hidden[:4]:
        for _ in range(2):
            texts.append(f"badge no {h} issued {word()}")
    for i in range(6):
        texts.append(f"badge no +44 20 7946 0{100 + i} issued {word()}")
        texts.append(f"badge no 10.0.0.{i} issued {word()}")
    texts.append(f"badge no {hidden[4]} issued, {word()}")
    texts += [f"order of {10**7 + i} {word()}" for i in range(9)]
    texts += [f"{rng.choice(names)} {word()} {word()} {word()}." for _ in range(30)]
    texts += [texts[0]] * 40
    return texts, hidden


def test_patterns_find_unseen_identifiers(session, documents):
    rng = random.Random(2)
    texts, hidden = corpus(rng)
    expected, scores = plain_scan(texts)
    assert {len(p) for p in scores} & {2, 3}
    docs = documents([(i, t) for i, t in enumerate(texts)], extra=CLASHING)
    got = {r.doc_id: [tuple(s) for s in r.found] for r in personal.scan(docs).collect()}
    assert [got[i] for i in range(len(texts))] == expected
    learned = {t[s:e] for t, spans in zip(texts, expected, strict=True) for s, k, e in spans if k == 4}
    assert learned == set(hidden[:5])
    found = personal.learn(docs, personal.scanned(docs, ("doc_id",), "text"))
    assert found.rounds >= 2
    by_words = {r.words: (r.known, round(r.score, 9)) for r in found.patterns.collect()}
    assert len(by_words) == len(scores) and "me: _" in by_words
    assert sorted(s for _, s in by_words.values()) == sorted(round(s, 9) for s in scores.values())


def test_common_words_are_no_patterns(documents):
    """What mostly stands before other words teaches nothing, however many known instances follow it."""
    texts = [f"sent to the 10.0.0.{i} host{i}" for i in range(20)] + [f"sent to the house {i}" for i in range(60)] + ["sent to the 12345678 host7"]
    rows = personal.scan(documents(list(enumerate(texts)), extra=CLASHING)).collect()
    assert all(s["kind"] < 4 for r in rows for s in r.found)
    assert [[tuple(s) for s in r.found] for r in sorted(rows)] == plain_scan(texts)[0]


def test_edge_rows(documents):
    mail = "é mail bo@example.org."
    long = "word " * 150_000 + "10.1.2.3"
    rows = [(None, mail), (1, None), (2, ""), (3, "  \n"), (4, long), (5, mail), (5, mail), (2**62 + 1, "x@y.zz é" + "1" * 5000)]
    docs = documents(rows, extra=CLASHING)
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in personal.report(docs).collect()), key=repr)
    expected = []
    for i, t in rows:
        base = plain_base(t or "")
        spans = ",".join(f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in base)
        expected.append((i, *[sum(k == n for _, k, _ in base) for n in range(4)], hashlib.sha256(spans.encode()).hexdigest(), spans))
    assert got == sorted(expected, key=repr)
    assert personal.report(documents([], extra=CLASHING)).count() == 0



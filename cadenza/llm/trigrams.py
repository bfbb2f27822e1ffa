"""Boolean trigram queries of regular expressions.

A query is None (says nothing), or a set of alternatives, each a set of trigrams that all occur in
every text the alternative matches. Trigrams are lower case.
"""

from __future__ import annotations

from itertools import product
from re import _constants as sre
from re import _parser as parser

Query = frozenset[frozenset[str]] | None

# Larger sets of texts are not followed; that only makes a query say less.
MOST_TEXTS = 32
MOST_ALTERNATIVES = 64


def trigrams(text: str) -> frozenset[str]:
    """All trigrams of a text, in lower case."""
    low = text.lower()
    return frozenset(low[i : i + 3] for i in range(len(low) - 2))


def both(a: Query, b: Query) -> Query:
    """What holds if both queries hold."""
    if a is None or b is None:
        return a if b is None else b
    if len(a) * len(b) > MOST_ALTERNATIVES:
        return min(a, b, key=len)
    return _least(x | y for x, y in product(a, b))


def either(queries: list[Query]) -> Query:
    """What holds if one of the queries holds."""
    if any(q is None for q in queries):
        return None
    return _least(x for q in queries for x in q)


def _least(alternatives) -> Query:
    """Without alternatives that others contain; none at all if one demands nothing."""
    every = set(alternatives)
    if frozenset() in every:
        return None
    return frozenset(x for x in every if not any(y < x for y in every))


def _of_texts(texts: set[str]) -> Query:
    return _least(trigrams(t) for t in texts)


def trigram_query(pattern: str) -> Query:
    """The query of a pattern: what every text it matches in is bound to hold."""
    texts, query = _whole(parser.parse(pattern))
    return query if texts is None else _of_texts(texts)


def _parts(tree) -> list[tuple[set[str] | None, Query]]:
    """For each element in sequence the set of texts it matches, or None and its own query."""
    out: list[tuple[set[str] | None, Query]] = []
    for kind, value in tree:
        if kind is sre.LITERAL:
            out.append(({chr(value)}, None))
        elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value) and len(value) <= MOST_TEXTS:
            out.append(({chr(c) for _, c in value}, None))
        elif kind is sre.SUBPATTERN:
            out.extend(_parts(value[3]))
        elif kind is sre.BRANCH:
            branches = [_whole(b) for b in value[1]]
            if all(t is not None for t, _ in branches):
                out.append((set().union(*(t for t, _ in branches)), None))
            else:
                out.append((None, either([_of_texts(t) if t is not None else q for t, q in branches])))
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, body = value
            texts, inner = _whole(body)
            if texts is not None and most == 1:
                out.append((texts | {""} if least == 0 else texts, None))
            elif least == 0:
                out.append((None, None))
            else:
                # At least once, and then something unknown before and after the rest.
                out.extend([(None, None), (texts, inner), (None, None)])
        elif kind is not sre.AT:
            out.append((None, None))
    return out


def _whole(tree) -> tuple[set[str] | None, Query]:
    """A sequence as one element."""
    run: set[str] = {""}
    query: Query = None
    finite = True
    for texts, inner in _parts(tree):
        if texts is not None and len(run) * len(texts) <= MOST_TEXTS:
            run = {a + b for a, b in product(run, texts)}
            continue
        finite = False
        query = both(query, _of_texts(run))
        if texts is not None:
            run = texts
        else:
            query, run = both(query, inner), {""}
    return (run, None) if finite else (None, both(query, _of_texts(run)))

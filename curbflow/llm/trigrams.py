"""Boolean trigram queries of regular expressions: what a matching text must contain."""

from __future__ import annotations

import re
from itertools import product
from re import _constants as op
from re import _parser

#: A query is True (any text), a trigram's number, or ("and" | "or", queries).
Query = bool | int | tuple[str, tuple]
#: Alternatives of a literal stretch that are written out; more end the stretch.
MOST = 64


def number(trigram: str) -> int:
    a, b, c = trigram.encode()
    return a << 16 | b << 8 | c


def _join(kind: str, queries: list[Query]) -> Query:
    neutral = kind == "and"
    if any(q is (not neutral) for q in queries):
        return not neutral
    rest = tuple(dict.fromkeys(q for q in queries if q is not neutral))
    return neutral if not rest else rest[0] if len(rest) == 1 else (kind, rest)


def _stretch(texts: set[str]) -> Query:
    """What holds if one of ``texts`` stands somewhere."""
    return _join("or", [_join("and", [number(t[i : i + 3]) for i in range(len(t) - 2)]) for t in texts])


def _letters(node) -> set[str] | None:
    """The few ASCII characters, in lower case, that one item matches; None if many or others."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()} if value < 128 else None
    if kind is not op.IN:
        return None
    found: set[str] = set()
    for what, x in value:
        if what is op.LITERAL and x < 128:
            found.add(chr(x).lower())
        elif what is op.RANGE and x[1] < 128 and x[1] - x[0] < 8:
            found |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _walk(items) -> tuple[set[str] | None, Query]:
    """(all texts the items match, if few; a query that holds besides)."""
    texts, query, exact = {""}, True, True

    def close() -> None:
        nonlocal texts, query, exact
        query, texts, exact = _join("and", [query, _stretch(texts)]), {""}, False

    def add(more: set[str] | None) -> None:
        nonlocal texts
        if more is None or len(texts) * len(more) > MOST:
            close()
            if more is not None:
                texts = set(more)
        else:
            texts = {a + b for a, b in product(texts, more)}

    for node in items:
        kind, value = node
        if kind is op.AT or kind in (op.ASSERT, op.ASSERT_NOT):
            continue
        if kind is op.SUBPATTERN:
            inner, also = _walk(value[-1])
            query = _join("and", [query, also])
            add(inner)
        elif kind is op.BRANCH:
            ways = [_walk(x) for x in value[1]]
            if all(w[0] is not None for w in ways):
                add(set().union(*(w[0] for w in ways)))
            else:
                close()
                query = _join("and", [query, _join("or", [_join("and", [q, _stretch(t or {""})]) for t, q in ways])])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, sub = value
            inner, also = _walk(sub)
            if least == 0 and most == 1 and inner is not None:
                add(inner | {""})
            elif least == 0:
                close()
            else:
                query = _join("and", [query, also])
                for _ in range(min(least, 3)):
                    add(inner)
                if most > min(least, 3):
                    close()
        else:
            add(_letters(node))
    return (texts, query) if exact else (None, _join("and", [query, _stretch(texts)]))


def query_of(pattern: str) -> Query:
    """The query of a pattern, over texts whose ASCII letters are lower case; True if nothing is mandatory."""
    texts, query = _walk(_parser.parse(pattern, re.ASCII))
    return query if texts is None else _join("and", [query, _stretch(texts)])


def trigrams_in(query: Query) -> set[int]:
    if isinstance(query, bool):
        return set()
    return {query} if isinstance(query, int) else set().union(*map(trigrams_in, query[1]))

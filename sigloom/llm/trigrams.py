"""Boolean trigram queries derived from regular expressions.

A query is a disjunction of conjunctions: a frozenset of frozensets of trigrams.  A text can match the expression only
if it holds, in either case, all trigrams of at least one conjunction.  ``EVERY`` is the query that excludes no text.
"""

from __future__ import annotations

import re
from itertools import product

# The public parse tree of Python's own regular expressions; both engines share the syntax used by the rules.
from re import _parser as parser

Query = frozenset[frozenset[str]]
EVERY: Query = frozenset([frozenset()])
# Strings tracked side by side while an expression is read; beyond that, what is known so far becomes trigrams.
MAX_STRINGS = 64


def trigrams(word: str) -> frozenset[str]:
    return frozenset(word[i : i + 3] for i in range(len(word) - 2))


def _reduced(query: Query) -> Query:
    """Without conjunctions that a weaker one already covers."""
    return frozenset(c for c in query if not any(other < c for other in query))


def _both(left: Query, right: Query) -> Query:
    return _reduced(frozenset(a | b for a, b in product(left, right)))


def _any_of(words: set[str]) -> Query:
    return _reduced(frozenset(trigrams(w) for w in words))


def _sequence(items) -> tuple[set[str] | None, Query]:
    """(all strings the sequence can be, or None; what any match needs)."""
    words, need, whole = {""}, EVERY, True
    for kind, value in items:
        own, own_need = _node(str(kind), value)
        if own is not None and len(words) * len(own) <= MAX_STRINGS:
            words = {a + b for a in words for b in own}
            continue
        need, whole = _both(_both(need, _any_of(words)), own_need), False
        words = {""}
    return (words, need) if whole else (None, _both(need, _any_of(words)))


def _node(kind: str, value) -> tuple[set[str] | None, Query]:
    if kind == "LITERAL":
        return {chr(value).lower()}, EVERY
    if kind == "AT":
        return {""}, EVERY
    if kind == "SUBPATTERN":
        return _sequence(value[-1])
    if kind == "IN" and all(str(k) == "LITERAL" for k, _ in value):
        return {chr(v).lower() for _, v in value}, EVERY
    if kind == "BRANCH":
        parts = [_sequence(x) for x in value[1]]
        if all(words is not None for words, _ in parts):
            return set().union(*(words for words, _ in parts)), EVERY
        return None, _reduced(frozenset().union(*(n if w is None else _any_of(w) for w, n in parts)))
    if kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, inner = value
        words, need = _sequence(inner)
        if words is not None and int(most) == 1:
            return (words if least else words | {""}), EVERY
        return None, (EVERY if not least else need if words is None else _any_of(words))
    return None, EVERY


def trigram_query(pattern: str, flags: int = re.NOFLAG) -> Query:
    """The query of a regular expression."""
    words, need = _sequence(parser.parse(pattern, flags))
    return need if words is None else _any_of(words)

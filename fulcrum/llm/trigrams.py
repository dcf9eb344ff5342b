"""Trigram queries of regular expressions: which trigrams a text must hold to match.

A query is a set of conjunctions (disjunctive form), each a set of lower-case trigrams; a
text that matches the expression holds all trigrams of at least one of them.  ``None``
means that nothing is mandatory, so every text has to be scanned.

The derivation walks the parsed expression and keeps, for each part, the strings it can
be exactly (while few) and else the conjunctions found inside it.  Runs of exact strings
are joined across concatenation before their trigrams are taken; a part whose strings are
unknown ends the run.
"""

from __future__ import annotations

import itertools
from re import _constants as op
from re import _parser

MAX_STRINGS = 32
MAX_CONJUNCTIONS = 64

Query = frozenset  # of frozensets of trigrams


def trigram_query(pattern: str) -> Query | None:
    return _reduced(_sequence(_parser.parse(pattern)))


def _strings(part) -> list[str] | None:
    """The strings a part can be, lower-cased, or None if unknown or many."""
    code, arg = part
    if code is op.LITERAL:
        return [chr(arg).lower()]
    if code is op.AT:
        return [""]
    if code is op.IN:
        found = set()
        for kind, value in arg:
            if kind is op.LITERAL:
                found.add(chr(value).lower())
            elif kind is op.RANGE and value[1] - value[0] < MAX_STRINGS:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return sorted(found) if len(found) <= 8 else None
    if code is op.SUBPATTERN:
        return _joined(arg[-1])
    if code is op.BRANCH:
        options = [_joined(option) for option in arg[1]]
        if any(o is None for o in options):
            return None
        found = sorted(set(itertools.chain(*options)))
        return found if len(found) <= MAX_STRINGS else None
    if code in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = arg
        one = _joined(inner)
        if one is None or high is op.MAXREPEAT or high > 4:
            return None
        found = {"".join(c) for n in range(low, high + 1) for c in itertools.product(one, repeat=n)}
        return sorted(found) if len(found) <= MAX_STRINGS else None
    return None


def _joined(parts) -> list[str] | None:
    runs = [""]
    for part in parts:
        more = _strings(part)
        if more is None or len(runs) * len(more) > MAX_STRINGS:
            return None
        runs = [a + b for a in runs for b in more]
    return runs


def _sequence(parts) -> Query | None:
    query, runs = None, [""]
    for part in parts:
        more = _strings(part)
        if more is not None and len(runs) * len(more) <= MAX_STRINGS:
            runs = [a + b for a in runs for b in more]
            continue
        query = _both(query, _of_strings(runs))
        runs = more if more is not None else [""]
        if more is None:
            query = _both(query, _inside(part))
    return _both(query, _of_strings(runs))


def _inside(part) -> Query | None:
    """The query of a part whose strings are unknown."""
    code, arg = part
    if code is op.SUBPATTERN:
        return _sequence(arg[-1])
    if code in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] > 0:
        return _sequence(list(arg[2]) * min(arg[0], 3))
    if code is op.BRANCH:
        options = [_sequence(option) for option in arg[1]]
        return None if any(o is None for o in options) else frozenset(itertools.chain(*options))
    return None


def _of_strings(strings: list[str]) -> Query | None:
    found = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in set(strings)]
    return frozenset(found) if found and all(found) else None


def _both(a: Query | None, b: Query | None) -> Query | None:
    if a is None or b is None:
        return a if b is None else b
    if len(a) * len(b) > MAX_CONJUNCTIONS:
        return a if len(a) <= len(b) else b  # either alone is still mandatory
    return frozenset(x | y for x in a for y in b)


def _reduced(query: Query | None) -> Query | None:
    """Without conjunctions that a weaker one implies."""
    return query and frozenset(c for c in query if not any(o < c for o in query))

"""Boolean trigram queries of regular expressions.

A query is an OR of ANDs, kept as a set of sets of trigrams: a text can match the
expression only if it has all trigrams of one of the sets. Trigrams are those of
the text in ASCII lower case, so a query never misses a match, whatever the case
rules of the expression. ``None`` stands for an expression that no trigram is
mandatory for.
"""

from __future__ import annotations

import re
from itertools import product

# The standard library's own parse tree of an expression.
from re import _constants as kinds
from re import _parser as tree

Query = frozenset[frozenset[str]] | None
#: Most strings that a part of an expression is spelled out to, and characters of a class.
MOST_STRINGS, MOST_CHARACTERS = 64, 8


def _characters(items) -> set[str] | None:
    """The few characters a class stands for; None if they are many."""
    found: set[str] = set()
    for kind, value in items:
        if kind is kinds.LITERAL:
            found.add(chr(value))
        elif kind is kinds.RANGE and value[1] - value[0] < MOST_CHARACTERS:
            found |= {chr(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_CHARACTERS else None


def _spelled(node) -> list[set[str] | None]:
    """An expression as a row of parts: the strings a part stands for, or None for a gap."""
    kind, value = node
    if kind is kinds.LITERAL:
        return [{chr(value)}]
    if kind is kinds.IN:
        return [_characters(value)]
    if kind is kinds.SUBPATTERN:
        return [part for inner in value[-1] for part in _spelled(inner)]
    if kind is kinds.BRANCH:
        strings: set[str] = set()
        for branch in value[1]:
            found = _joined([part for inner in branch for part in _spelled(inner)])
            if len(found) != 1 or found[0] is None:
                return [None]
            strings |= found[0]
        return [strings if len(strings) <= MOST_STRINGS else None]
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
        low, high, inner = value
        once = _joined([part for x in inner for part in _spelled(x)])
        if len(once) == 1 and once[0] is not None:
            if high == 1 and low == 0:
                return [once[0] | {""}]
            if low == high and low <= 4:
                return [once[0]] * low
            return [*[once[0]] * min(low, 4), None]
        return [None]
    if kind is kinds.AT or kind is kinds.ASSERT or kind is kinds.ASSERT_NOT:
        return [{""}]
    return [None]


def _joined(parts: list[set[str] | None]) -> list[set[str] | None]:
    """Neighbouring parts put together as long as the strings stay few."""
    out: list[set[str] | None] = []
    for part in parts:
        if part is not None and out and out[-1] is not None and len(out[-1]) * len(part) <= MOST_STRINGS:
            out[-1] = {a + b for a, b in product(out[-1], part)}
        else:
            out.append(part)
    return out


def _lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def query(expression: str) -> Query:
    """The trigram query of an expression; None if texts must be scanned in full."""
    best: Query = None
    parsed = tree.parse(expression)
    if parsed.state.flags & re.IGNORECASE:
        raise ValueError("use a group like (?i:...) for letters of either case")
    for strings in _joined([part for node in parsed for part in _spelled(node)]):
        if strings is None or not all(len(s) >= 3 for s in strings):
            continue
        if any(ord(c) > 127 for s in strings for c in s):
            continue  # letters that fold outside ASCII
        found = frozenset(frozenset(_lowered(s)[i : i + 3] for i in range(len(s) - 2)) for s in strings)
        # A set that holds another one adds nothing.
        found = frozenset(a for a in found if not any(b < a for b in found))
        if best is None or min(map(len, found)) > min(map(len, best)):
            best = found
    return best

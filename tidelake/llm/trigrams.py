"""Boolean trigram queries derived from regular expressions.

``query(regex)`` is a conjunction of clauses; a clause is a set of alternatives; an alternative is
a set of trigrams.  Every text that the expression matches has, lower-cased, all trigrams of at
least one alternative of each clause.  An empty conjunction says nothing: such rules scan fully.
"""

from __future__ import annotations

from re import _constants as sre
from re import _parser as parser

EXPAND, STRINGS = 6, 64  # a class of more characters, or more strings than this, is "anything"


def trigrams_of(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def query(regex: str) -> list[frozenset[frozenset[str]]]:
    clauses: list[frozenset[frozenset[str]]] = []
    tail = _walk(parser.parse(regex), {""}, clauses)
    _flush(tail, clauses)
    return clauses


def _flush(run: set[str], clauses: list) -> None:
    """The strings of a run must occur: one clause, unless one of them is too short to tell."""
    sets = {trigrams_of(s) for s in run}
    if frozenset() not in sets:
        clause = frozenset(a for a in sets if not any(b < a for b in sets))
        if clause not in clauses:
            clauses.append(clause)


def _strings(node) -> set[str] | None:
    """All strings a node matches, lower-cased, if they are few; else None."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < EXPAND:
                chars.update(chr(c).lower() for c in range(value[0], value[1] + 1))
            else:
                return None
        return chars if len(chars) <= EXPAND else None
    if op is sre.SUBPATTERN:
        return _all(arg[-1])
    if op is sre.BRANCH:
        found = [_all(x) for x in arg[1]]
        return None if None in found else set().union(*found)
    if op is sre.MAX_REPEAT and arg[1] is not sre.MAXREPEAT and arg[1] <= EXPAND * 2:
        low, high, body = arg
        one = _all(body)
        if one is None:
            return None
        out, cur = set(), {""}
        for i in range(high + 1):
            if i >= low:
                out |= cur
            cur = {a + b for a in cur for b in one}
            if len(cur) > STRINGS:
                return None
        return out
    return {""} if op is sre.AT else None


def _all(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        part = _strings(node)
        if part is None or len(out) * len(part) > STRINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


def _walk(nodes, run: set[str], clauses: list) -> set[str]:
    """Extend ``run`` over ``nodes``; what cannot be extended is flushed and a new run starts."""
    for node in nodes:
        part = _strings(node)
        if part is not None and len(run) * len(part) <= STRINGS:
            run = {a + b for a in run for b in part}
            continue
        _flush(run, clauses)
        op, arg = node
        if op is sre.SUBPATTERN:
            run = _walk(arg[-1], {""}, clauses)
        elif op is sre.MAX_REPEAT and arg[0] >= 1:
            _flush(_walk(arg[2], {""}, clauses), clauses)
            run = {""}
        else:
            run = {""} if part is None else set(part)
    return run

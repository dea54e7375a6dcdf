"""Small finite-state transducers, composed on the fly.

A transducer reads one symbol and, by its state, writes one symbol and changes state.  ``chain``
runs several one after the other on the same input: the composed machine's state is the tuple of
their states, and its transitions are made once, when first met.
"""

from __future__ import annotations

from collections.abc import Callable


class Transducer:
    """``step(state, symbol) -> (state, symbol)`` over a finite set of states."""

    def __init__(self, start: int, step: Callable[[int, str], tuple[int, str]]):
        self.start, self.step = start, step


class Chain:
    def __init__(self, parts: list[Transducer]):
        self.parts = parts
        self.start = tuple(p.start for p in parts)
        self.arcs: dict[tuple, tuple[tuple, str]] = {}

    def step(self, state: tuple, symbol: str) -> tuple[tuple, str]:
        key = (state, symbol)
        if key not in self.arcs:
            after, out = [], symbol
            for part, s in zip(self.parts, state):
                s, out = part.step(s, out)
                after.append(s)
            self.arcs[key] = tuple(after), out
        return self.arcs[key]


def within(opens: str, reach: int, marks: dict[str, str]) -> Transducer:
    """After a symbol of ``opens``, the next ``reach`` symbols that ``marks`` names are rewritten."""
    def step(state: int, symbol: str) -> tuple[int, str]:
        if symbol in opens:
            return reach, symbol
        if state and symbol in marks:
            return state - 1, marks[symbol]
        return max(0, state - 1), symbol

    return Transducer(0, step)


def after(opens: str, marks: dict[str, str]) -> Transducer:
    """After a symbol of ``opens``, all later symbols that ``marks`` names are rewritten."""
    def step(state: int, symbol: str) -> tuple[int, str]:
        if symbol in opens:
            return 1, symbol
        return state, marks.get(symbol, symbol) if state else symbol

    return Transducer(0, step)


def rewrite(passes: list[Chain], symbols: str) -> str:
    """``symbols`` through the chains in turn, the first from left to right, the next from right to left, and so on."""
    for chain in passes:
        state, out = chain.start, []
        for symbol in symbols:
            state, sign = chain.step(state, symbol)
            out.append(sign)
        symbols = "".join(reversed(out))
    return symbols[::-1] if len(passes) % 2 else symbols

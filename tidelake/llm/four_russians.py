"""Four-Russians tables for the cheapest repair of a role sequence.

A state says what the repaired conversation ends with: nothing, system, user or assistant; the
conversation may end with nothing or an assistant.  A row is a symbol (its role's class, and whether
it is truncated or must go).  For the rows from some place on, ``cost[state]`` is the cheapest way to
finish from there.  Less its smallest entry such a vector is one of a few dozen, because an insertion
leads between states at a fixed price; ``step`` finds them all.  ``block`` then holds, for every vector
and every block of ``LENGTH`` symbols, the vector before the block.  So a sequence is worked through
backward by one lookup a block.  The way forward expands each block into its vectors again and takes
the least letter that stays cheapest: a letter and a state determine the role that is emitted, so
this is the least audit of all cheapest ones.
"""

from __future__ import annotations

import numpy as np

START, SYSTEM, USER, ASSISTANT = range(4)
OTHER, OK, TRUNCATED, DELETE = 3, 0, 1, 2  # role classes are 0 s, 1 u, 2 a, 3 other; a code is role * 3 + fault
GONE, PAD, SYMBOLS = 8, 9, 10  # role * 2 + truncated, or one of these
LENGTH = 4
DELETION, INSERTION, REROLE, CUT = 4, 3, 3, 3  # prices
ACCEPT = (0, 6, 3, 0)  # cost of finishing after the last row
NEXT = (USER, USER, ASSISTANT, USER)  # where an inserted or re-roled row leads
KEEP = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
SYMBOL = np.array([GONE if c % 3 == DELETE else c // 3 * 2 + c % 3 for c in range(12)], np.int64)


def options(state: int, symbol: int):
    """(letter, price, next state, role emitted) of what may happen to a row in a state."""
    if symbol == PAD:
        return [("", 0, state, None)]
    out = [("D", DELETION, state, None)]
    if symbol != GONE:
        cut = CUT * (symbol % 2)
        if (state, symbol // 2) in KEEP:
            out.append(("K", cut, KEEP[state, symbol // 2], None))
        out.append(("R", REROLE + cut, NEXT[state], NEXT[state]))
    return out


def row_costs(after, symbol: int) -> list[int]:
    """Costs before a row, from those after it."""
    cost = [min(p + after[t] for _, p, t, _ in options(s, symbol)) for s in range(4)]
    for _ in range(2):  # at most two insertions in a row pay
        cost = [min(cost[s], INSERTION + cost[NEXT[s]]) for s in range(4)]
    return cost


class Tables:
    def __init__(self, length: int = LENGTH):
        self.length = length
        self.vectors, number, rows = [ACCEPT], {ACCEPT: 0}, []
        for vector in self.vectors:  # grows while it is read
            for symbol in range(SYMBOLS):
                cost = vector if symbol == PAD else row_costs(vector, symbol)
                less = min(cost)
                to = tuple(c - less for c in cost)
                if to not in number:
                    number[to] = len(self.vectors)
                    self.vectors.append(to)
                rows.append((number[to], less))
        table = np.array(rows, np.int64).reshape(len(self.vectors), SYMBOLS, 2)
        self.step, self.less = table[:, :, 0], table[:, :, 1]
        self.block = self.step
        for _ in range(length - 1):  # a symbol before a shorter block
            self.block = np.stack([self.step[self.block, s] for s in range(SYMBOLS)], axis=1).reshape(len(self.vectors), -1)
        self.powers = SYMBOLS ** np.arange(length - 1, -1, -1)
        self.traced: dict[tuple[int, int, int], tuple[str, tuple, int]] = {}

    def blocks(self, codes: np.ndarray) -> list[int]:
        """Numbers of the blocks of a sequence of codes, padded at its end."""
        symbols = np.full(-(-len(codes) // self.length) * self.length, PAD, np.int64)
        symbols[:len(codes)] = SYMBOL[codes]
        return (symbols.reshape(-1, self.length) @ self.powers).tolist()

    def before(self, blocks: list[int], last):
        """The vector after each block, and the one before the first; ``last`` may be an array."""
        out = [last]
        for b in reversed(blocks):
            out.append(self.block[out[-1], b])
        return out[::-1]

    def trace(self, after: int, block: int, state: int) -> tuple[str, tuple, int]:
        """Letters of a block entered in ``state``, the repaired rows (row in the block or -1 for an
        inserted one, role class given or -1), and the state it is left in."""
        key = (after, block, state)
        if key in self.traced:
            return self.traced[key]
        symbols = [block // p % SYMBOLS for p in self.powers.tolist()]
        costs, at, total = [self.vectors[after]], after, 0
        for s in reversed(symbols):
            total += int(self.less[at, s])
            at = int(self.step[at, s])
            costs.append(tuple(c + total for c in self.vectors[at]))
        costs.reverse()
        letters, rows = [], []
        for i, symbol in enumerate(symbols):
            here, later = costs[i], costs[i + 1]
            while True:
                ways = [(letter, to, role, True) for letter, p, to, role in options(state, symbol) if p + later[to] == here[state]]
                if symbol != PAD and INSERTION + here[NEXT[state]] == here[state]:
                    ways.append(("I", NEXT[state], NEXT[state], False))
                letter, state, role, done = min(ways, key=lambda w: w[0])
                letters.append(letter)
                if letter in ("K", "R", "I"):
                    rows.append((i if done else -1, -1 if role is None else role - 1))
                if done:
                    break
        self.traced[key] = "".join(letters), tuple(rows), state
        return self.traced[key]

    def finish(self, state: int) -> list[int]:
        """Role classes inserted after the last row."""
        out = []
        while state not in (START, ASSISTANT):
            state = NEXT[state]
            out.append(state - 1)
        return out


_tables: list[Tables] = []


def tables() -> Tables:
    """The tables, made once for each Python worker."""
    if not _tables:
        _tables.append(Tables())
    return _tables[0]


def summary(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a stretch of rows does: the vector before it for each vector after it, and the state it
    is left in for each vector after it and state it is entered in."""
    t = tables()
    blocks, n = t.blocks(codes), len(t.vectors)
    after = t.before(blocks, np.arange(n))
    state = np.tile(np.arange(4), (n, 1))
    for b, vectors in zip(blocks, after[1:]):
        state = np.array([[t.trace(int(v), b, int(s))[2] for s in row] for v, row in zip(vectors, state)])
    return after[0], state


def compose(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The summary of consecutive stretches from their own."""
    vectors = [np.arange(len(parts[0][0]))]
    for to, _ in reversed(parts):
        vectors.append(to[vectors[-1]])
    vectors.reverse()
    state = np.tile(np.arange(4), (len(vectors[0]), 1))
    for (_, leave), after in zip(parts, vectors[1:]):
        state = leave[after[:, None], state]
    return vectors[0], state


def within(parts: list[tuple[np.ndarray, np.ndarray]], last: int, state: int) -> list[tuple[int, int]]:
    """(vector after, state before) of each of the consecutive stretches."""
    vectors = [last]
    for to, _ in reversed(parts):
        vectors.append(int(to[vectors[-1]]))
    out = []
    for (_, leave), after in zip(parts, vectors[-2::-1]):
        out.append((after, state))
        state = int(leave[after, state])
    return out

"""Vectorised word and shingle hashing over whole Arrow text columns.

A word is a run of bytes other than ``\\x20 \\x09-\\x0D`` with A-Z lower-cased.  Its hash is a
polynomial over the bytes modulo 2**64, mixed once; shingle hashes combine word hashes.  All
values are unsigned 64-bit and the same on every machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# splitmix64 finaliser and odd multipliers.
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE, GOLDEN = 0x9E3779B97F4A7C15 | 1, np.uint64(0x9E3779B97F4A7C15)
SLICE = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_ALNUM = np.ones(256, dtype=bool)  # ASCII letters, digits and all bytes of other letters stay
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below ``size``."""
    if "up" not in _powers or len(_powers["up"]) < size:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            _powers[name] = np.multiply.accumulate(t)
    return _powers["up"], _powers["down"]


def raw_text(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string array without nulls."""
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if len(col) == 0 or bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def word_starts(data: np.ndarray, off: np.ndarray, gap: np.ndarray = IS_SPACE) -> np.ndarray:
    space = gap[data]
    start = ~space
    before = np.ones(len(data), dtype=bool)
    before[1:] = space[:-1]
    before[off[:-1][off[:-1] < len(data)]] = True
    return np.flatnonzero(start & before)


def hash_words(col: pa.Array, gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in row order, and each row's offsets into them; ``gap`` tells the bytes
    between words."""
    data, off = raw_text(col)
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    starts = word_starts(data, off, gap)
    value = np.where(gap, np.uint64(0), LOWER.astype(np.uint64) + np.uint64(1))
    return run_hashes(data, starts, value), np.searchsorted(starts, off)


def run_hashes(data: np.ndarray, starts: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to the next one (or the end), by ``value`` of each byte;
    a byte of value 0 does not count.  Works in slices of about SLICE bytes."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + SLICE)))
        a = starts[lo]
        # a slice ends where its last run's successor starts; only a single giant run exceeds SLICE
        hi = hi - 1 if hi < len(starts) and hi - 1 > lo else hi
        b = starts[hi] if hi < len(starts) else len(data)
        up, down = power_tables(max(SLICE, int(b - a)))
        sums = np.add.reduceat(value[data[a:b]] * up[:b - a], starts[lo:hi] - a)
        out[lo:hi] = mix(sums * down[starts[lo:hi] - a])
        lo = hi
    return out


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words (across rows: the caller cuts by row)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    acc = np.full(len(words) - n + 1, (int(n) * int(GOLDEN)) % (1 << 64), dtype=np.uint64)
    for j in range(n):
        acc += words[j:len(words) - n + 1 + j] * np.uint64(pow(BASE, 2 * j + 3, 1 << 64))
    return mix(acc)


def by_bytes(col: pa.Array, limit: int = 1 << 19):
    """Row ranges of a string array of about ``limit`` bytes each (a longer row alone)."""
    off = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def shingle_sets(col: pa.Array, n: int):
    """For each row the sorted distinct hashes of its ``n``-word shingles; a row of fewer words
    has the hash of its whole sequence; a row without words has none.  Rows are hashed some at a
    time, so memory does not follow the column's size."""
    for a, b in by_bytes(col):
        words, rows = hash_words(col.slice(a, b - a))
        grams = ngram_hashes(words, n)
        for lo, hi in zip(rows[:-1], rows[1:]):
            if hi - lo >= n:
                yield np.unique(grams[lo:hi - n + 1])
            else:
                yield ngram_hashes(words[lo:hi], hi - lo) if hi > lo else np.zeros(0, np.uint64)

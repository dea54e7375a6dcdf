"""Token ids of whole texts by the ``tokenizers`` library, with a bounded cache of text parts.

Byte-level BPE never merges across pre-tokens.  Its pre-token pattern starts a new one wherever
white space follows another character, after a line feed alone between other characters, and at a
comma or full stop after a letter.  So a text is the concatenation of the parts between such places,
each encoded on its own, and a part that occurs again need not be encoded again.  Parts are found,
hashed (64 bits) and looked up for a whole Arrow column at once; the library encodes those not seen
before, many in a call.  Parts of more than ``LONG`` bytes are always encoded afresh.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from tidelake.llm.words import by_bytes, raw_text, run_hashes

SLOTS_LOG2 = 21  # slots of the cache's hash table, filled to a half
LONG = 64
PARTS = 20_000  # parts encoded in one call, line by line
PLAIN = np.arange(1, 257, dtype=np.uint64)

# White space of one byte (the separators 1C-1F, which only some engines count, are
# taken as such) and, as UTF-8, of more; letters that may stand before a comma or full stop.
SPACE = np.zeros(256, dtype=bool)
SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
WIDE_SPACE = [c.encode() for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000"]
WIDE_LEAD = np.zeros(256, dtype=bool)
WIDE_LEAD[[w[0] for w in WIDE_SPACE]] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def part_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Places where a pre-token certainly starts: each row's first byte, and within rows those named
    above."""
    n = len(data)
    first = np.zeros(n + 1, dtype=bool)
    first[off[:-1]] = True
    space = SPACE[data]
    ends, begins = space.copy(), space  # last and first bytes of white space
    wide = np.flatnonzero(WIDE_LEAD[data])
    if len(wide):
        begins = space.copy()
        for w in WIDE_SPACE:
            at = wide[wide + len(w) <= n]
            for k, byte in enumerate(w):
                at = at[data[at + k] == byte]
            begins[at] = True
            ends[at + len(w) - 1] = True
    after_text = np.zeros(n, dtype=bool)  # the byte before ends no white space and is of the same row
    after_text[1:] = ~ends[:-1]
    after_text &= ~first[:n]
    starts = after_text & ((data == 0x20) | (data == 0x0A))
    line = np.flatnonzero(starts & (data == 0x0A))
    line = line[line + 1 < n]
    line = line[~begins[line + 1] & ~first[line + 1]] + 1
    starts[line] = True
    mark = np.flatnonzero((data == 0x2C) | (data == 0x2E))
    mark = mark[mark > 0]
    mark = mark[~first[mark]]
    before = data[mark - 1]
    latin = (mark > 1) & (data[mark - 2] == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
    starts[mark[LETTER[before] | latin]] = True
    starts |= first[:n]
    return np.flatnonzero(starts)


class Encoder:
    """``encode(column)`` gives all ids of a string column and each row's offsets into them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.vocab = self.tok.get_vocab_size()
        line = self.library(["\n"])[0]
        self.line = line[0] if len(line) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(1 << SLOTS_LOG2, np.uint64)  # 0: free
        self.offset = np.zeros(1 << SLOTS_LOG2, np.uint32)
        self.size = np.zeros(1 << SLOTS_LOG2, np.uint16)
        self.pool, self.used, self.n = np.zeros(1 << 16, np.uint32), 0, 0

    def library(self, items: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(items, add_special_tokens=False)]

    def lines(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many parts and how many each has: one call, cut at the line feeds' ids."""
        ids, sizes = [], []
        for lo in range(0, len(parts), PARTS):
            some = parts[lo:lo + PARTS]
            if self.line is not None and not any("\n" in p for p in some):
                flat = np.array(self.library(["\n".join(some)])[0], np.uint32)
                cut = np.flatnonzero(flat == self.line)
                if len(cut) == len(some) - 1:
                    sizes.append(np.diff(np.concatenate([[-1], cut, [len(flat)]])) - 1)
                    ids.append(np.delete(flat, cut))
                    continue
            each = self.library(some)
            sizes.append(np.array([len(e) for e in each]))
            ids.append(np.array([i for e in each for i in e], np.uint32))
        return np.concatenate(ids), np.concatenate(sizes)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        mask = np.int64((1 << SLOTS_LOG2) - 1)
        slot = (keys >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            held = self.keys[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = slot[todo[hit]]
            todo = todo[~hit & (held != 0)]
            slot[todo] = (slot[todo] + 1) & mask
        return out

    def _add(self, keys: np.ndarray, parts: list[str]) -> None:
        """Encode new parts and enter them under their keys (all different)."""
        plain = [i for i, p in enumerate(parts) if "\n" not in p]
        other = [i for i, p in enumerate(parts) if "\n" in p]
        ids, size = self.lines([parts[i] for i in plain + other])
        keys = keys[plain + other]
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(ids)] = ids
        offset = self.used + np.cumsum(size) - size
        self.used += len(ids)
        self.n += len(keys)
        mask = np.int64((1 << SLOTS_LOG2) - 1)
        slot = (keys >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.keys[slot[won]], self.offset[slot[won]], self.size[slot[won]] = keys[won], offset[won], size[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & mask

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, off = raw_text(col)
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if self.n > 1 << (SLOTS_LOG2 - 1):
            self._clear()
        starts = part_starts(data, off)
        ends = np.append(starts[1:], len(data))
        keys = run_hashes(data, starts, PLAIN)
        keys[keys == 0] = 1
        raw = data.tobytes()
        short = ends - starts <= LONG
        slot = self._find(keys)
        new, at = np.unique(np.where(short & (slot < 0), keys, np.uint64(0)), return_index=True)
        if len(new) and new[0] == 0:
            new, at = new[1:], at[1:]
        if len(new):
            self._add(new, [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            missing = np.flatnonzero(slot < 0)
            slot[missing] = self._find(keys[missing])
        size = self.size[slot].astype(np.int64)
        offset = self.offset[slot].astype(np.int64)
        long = np.flatnonzero(~short)
        afresh = self.library([raw[a:b].decode() for a, b in zip(starts[long].tolist(), ends[long].tolist())]) if len(long) else []
        size[long] = [len(x) for x in afresh]
        offset[long] = 0
        total = np.concatenate([[0], np.cumsum(size)])
        index = np.repeat(offset - total[:-1], size) + np.arange(total[-1])
        index[index >= self.used] = 0  # places of the parts filled in below
        ids = self.pool[index]
        for i, x in zip(long.tolist(), afresh):
            ids[total[i]:total[i + 1]] = x
        return ids, total[np.searchsorted(starts, off)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def documents(enc: Encoder, col: pa.Array, end_id: int):
    """Ids of each row with ``end_id`` appended, in order."""
    end = np.array([end_id], np.uint32)
    for lo, hi in by_bytes(col):
        ids, at = enc.encode(col.slice(lo, hi - lo))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield np.concatenate([ids[a:b], end])

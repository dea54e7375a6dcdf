"""Operator 7: best-fit packing by exact-complement hashing.

Every text is tokenised once; each row's pieces carry their length and, within their task, their
rank among pieces of that length.  What the plan needs is only how many pieces there are of each
length: at most ``capacity`` numbers, whatever the size of the corpus.  ``plan_bins`` works on
these counts: for each length it looks up, in indexes of single, pair and triple length sums, the
combinations that fill the rest of a bin exactly and consumes as many as their availability
allows; what has no exact complement is placed best-fit, largest first.  The plan is a list of
slots "pieces ranked r0 .. r0+n-1 of length L lie at this offset of sequences s0 .. s0+n-1".
Ranks of all pieces follow from a running sum over the tasks' counts, so no task or group ever
holds all pieces of one length.

Defined cases: a null text is empty (its only id is the end id); rows without ``doc_id`` and
repeated rows are packed as documents of their own; an empty table gives an empty result; extra
columns are ignored.  ``piece`` 0 holds the remainder when a document is longer than a sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import column, stored, table, texts
from tidelake.llm.tokens import documents, encoder

CAPACITY, END_ID = 1024, 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, pos long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``pos`` is its rank among its task's pieces of that length."""
    def tokenise(batches):
        enc, task = encoder(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc, ids in zip(column(batch, "doc_id").to_pylist(), documents(enc, texts(batch, "text"), end_id)):
                for k, (a, n) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc, k, a, n, zlib.crc32(ids[a:a + n].astype("<u4")), task, int(seen[n])))
                    seen[n] += 1
            cols = list(zip(*rows)) or [()] * len(SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, SCHEMA.types)], schema=SCHEMA)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tokenise, PIECES)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("task", pa.int32()), ("pos", pa.int64())])


def fill_exactly(n: np.ndarray, length: int, capacity: int):
    """Combinations of at most three available lengths, none above ``length``, that complete one
    piece of ``length`` to ``capacity``: largest partner first."""
    gap = capacity - length
    if 0 < gap <= length and n[gap] > (gap == length):
        yield (gap,)
    b = np.arange((gap + 1) // 2, min(gap - 1, length) + 1)[::-1]
    for x in b[(n[b] > 0) & (n[gap - b] > 0)] if len(b) else ():
        yield int(x), int(gap - x)
    for c in range(min(gap - 2, length), (gap + 2) // 3 - 1, -1):
        if n[c] > 0:
            rest = gap - c
            b = np.arange((rest + 1) // 2, min(rest - 1, c) + 1)[::-1]
            for x in b[(n[b] > 0) & (n[rest - b] > 0)] if len(b) else ():
                yield c, int(x), int(rest - x)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one bin) and how many bins take each.  Its work depends on
    ``capacity`` alone: a pattern is recorded once however many bins use it."""
    n = np.zeros(capacity + 1, np.int64)
    for k, v in counts.items():
        n[k] = v
    done: list[tuple[tuple[int, ...], int]] = []
    if n[capacity]:
        done.append(((capacity,), int(n[capacity])))
        n[capacity] = 0
    rest = np.zeros(capacity + 1, np.int64)
    for length in range(capacity - 1, 0, -1):
        for combo in fill_exactly(n, length, capacity):
            if n[length] == 0:
                break
            pattern = (length, *combo)
            k = min(int(n[x]) // pattern.count(x) for x in set(pattern))
            if k > 0:
                for x in pattern:
                    n[x] -= k
                done.append((pattern, k))
        rest[length], n[length] = n[length], 0
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(capacity - 1, 0, -1):
        left = int(rest[length])
        for gap in range(length, capacity):
            while left and open_.get(gap):
                pattern, k = open_[gap].pop()
                each = min(gap // length, left)  # as many of this length as the bin still holds
                take = min(k, left // each)
                if k > take:
                    open_[gap].append((pattern, k - take))
                open_.setdefault(gap - each * length, []).append((pattern + (length,) * each, take))
                left -= take * each
            if not left:
                break
        if left:
            each = capacity // length
            for k, m in ((each, left // each), (left % each, 1)):
                if k and m:
                    open_.setdefault(capacity - k * length, []).append(((length,) * k, m))
    return done + [g for groups in open_.values() for g in groups]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, r0, n, sequence0, offset), sorted by length and r0."""
    used: dict[int, int] = {}
    rows, seq = [], 0
    for pattern, k in plan:
        offset = 0
        for x in pattern:
            rows.append((x, used.get(x, 0), k, seq, offset))
            used[x] = used.get(x, 0) + k
            offset += x
        seq += k
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack ``docs`` (doc_id, text); returns one row per piece with its sequence and offset."""
    cutup = stored(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    per_task = stored(cutup.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    place = slots(plan_bins(counts, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def assign(batches):
        stride = int(place[:, 1].max()) + 1 if len(place) else 1
        key = place[:, 0] * stride + place[:, 1]
        for batch in batches:
            length, rank = (column(batch, c).to_numpy() for c in ("length", "rank"))
            at = place[np.searchsorted(key, length * stride + np.minimum(rank, stride - 1), side="right") - 1]
            out = [column(batch, c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            out += [pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])]
            yield pa.RecordBatch.from_arrays(out, names=[*("doc_id piece start length ids_crc32 sequence_id offset".split())])

    ranked = cutup.join(base, ["length", "task"]).withColumn("rank", F.col("pos") + F.col("base"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(assign, PACKED)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` packed into sequences of at most 1024 ids."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

"""Operator 9: quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - f(text)) with one shared score f and ordered thresholds.
f sums weights of hashed features: words and word shapes by their share of the text, and bins of
length, repetition, and of what characters it is made of.  The expected grade and the tail
probability P(grade >= ``tail``) follow from the same thresholds, and selection uses the tail.

The fit takes about ``SAMPLE`` graded rows (a documented bound, by a hash of the id) into one
task as hashed features; scoring reads every whole text where it lies.

Defined cases: a null or empty text has only its bins; rows without a grade are not learnt from; a
doc_id graded twice counts once, by its lower grade; repeated rows and null ids are scored like
others; with fewer than two grades the expected grade is that grade (or 0) and the tail 0 or 1; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import column, id_bucket, table, texts
from tidelake.llm.words import IS_SPACE, hash_words, raw_text, word_starts

SAMPLE, BUCKETS, STEPS, RATE, RIDGE = 12_000, 1 << 16, 150, 0.05, 1e-4
SHAPE_AT, BIN_AT = BUCKETS, BUCKETS + 1024
WIDTH = BIN_AT + 256

CLASS = np.full(256, 4, np.int64)  # lower, upper, digit, other letter's byte, else
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:256] = 0, 1, 2, 3


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of all rows in one run: index, value, and each row's offsets."""
    words, rows = hash_words(col)
    data, off = raw_text(col)
    starts = word_starts(data, off)
    ends = np.append(starts[1:], len(data))
    size = np.maximum(1, np.minimum(ends - starts, 15))
    shape = SHAPE_AT + (CLASS[data[starts]] * 5 + CLASS[data[np.minimum(starts + 1, np.maximum(len(data) - 1, 0))]]) * 16 + size if len(starts) else starts
    bucket = (words >> np.uint64(48)).astype(np.int64) % BUCKETS
    index, value, bounds = [], [], [0]
    kinds = CLASS[data]
    letters = np.add.reduceat(np.append((kinds[:, None] == np.arange(5)), [[False] * 5], axis=0).astype(np.int64),
                              np.minimum(off[:-1], len(data)), axis=0) if len(off) > 1 else np.zeros((0, 5))
    for i, (lo, hi) in enumerate(zip(rows[:-1], rows[1:])):
        n = int(hi - lo)
        chars = max(1, int(off[i + 1] - off[i]))
        own = np.concatenate([bucket[lo:hi], shape[lo:hi]])
        u, c = np.unique(own, return_counts=True)
        w = words[lo:hi]
        distinct = len(np.unique(w)) / n if n else 0.0
        again = float((w[1:] == w[:-1]).mean()) if n > 1 else 0.0
        parts = letters[i] / chars if off[i + 1] > off[i] else np.zeros(5)
        bins = [min(15, int(np.log2(n + 1))), 16 + int(distinct * 15), 32 + int(again * 15),
                *(48 + 16 * k + int(min(1.0, parts[k]) * 15) for k in range(5))]
        index += [u, BIN_AT + np.array(bins)]
        value += [c / max(1, n), np.ones(len(bins))]
        bounds.append(bounds[-1] + len(u) + len(bins))
    if not index:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64)
    return np.concatenate(index), np.concatenate(value), np.array(bounds)


def row_sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, bounds[:-1]) if len(bounds) > 1 else np.zeros(0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def cumulative(f: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade <= k) for k = -1 .. K-1 (first column 0, last 1)."""
    mid = sigmoid(thresholds[None, :] - f[:, None])
    return np.hstack([np.zeros((len(f), 1)), mid, np.ones((len(f), 1))])


def fit_ordinal(index: np.ndarray, value: np.ndarray, bounds: np.ndarray, grade: np.ndarray, n_grades: int,
                steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds by Adam on the mean log-likelihood.  Thresholds are
    the first one plus exponentials of gaps, so they stay ordered."""
    share = np.cumsum(np.bincount(grade, minlength=n_grades))[:-1] / len(grade)
    cut = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    gap = np.log(np.maximum(np.diff(cut), 1e-2))
    theta = np.concatenate([np.zeros(WIDTH), cut[:1], gap])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    row = np.repeat(np.arange(len(grade)), np.diff(bounds))
    n = len(grade)
    for t in range(1, steps + 1):
        steps_up = np.exp(theta[WIDTH + 1:])
        tau = theta[WIDTH] + np.concatenate([[0.0], np.cumsum(steps_up)])
        f = row_sums(value * theta[index], bounds)
        cum = cumulative(f, tau)
        at = np.arange(n)
        hi, lo = cum[at, grade + 1], cum[at, grade]
        p = np.maximum(hi - lo, 1e-9)
        df = hi + lo - 1.0  # of log p by f
        grad = np.zeros_like(theta)
        grad[:WIDTH] = np.bincount(index, weights=value * df[row], minlength=WIDTH) / n
        dtau = np.zeros(n_grades - 1)
        up, down = hi * (1 - hi) / p, lo * (1 - lo) / p
        for k in range(n_grades - 1):
            dtau[k] = (up[grade == k].sum() - down[grade == k + 1].sum()) / n
        grad[WIDTH] = dtau.sum()
        grad[WIDTH + 1:] = steps_up * np.cumsum(dtau[::-1])[::-1][1:]
        grad[:WIDTH] -= ridge * theta[:WIDTH]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    tau = theta[WIDTH] + np.concatenate([[0.0], np.cumsum(np.exp(theta[WIDTH + 1:]))])
    return theta[:WIDTH], tau


def fit(docs: DataFrame, grades: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Weights, thresholds and the grades met, from ``docs`` (doc_id, text) and ``grades``
    (doc_id, grade int)."""
    marks = (grades.select(F.col("doc_id").cast("long"), F.col("grade").cast("int"))
             .where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade")))
    sizes = {r["grade"]: r["n"] for r in marks.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if len(names) < 2:
        return np.zeros(WIDTH), np.zeros(0), names
    share = min(1.0, sample / sum(sizes.values()))
    taken = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about ``sample`` rows of two numbers, whatever the input
    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .join(F.broadcast(taken), "doc_id").select("text", "grade"))
    rank = {g: i for i, g in enumerate(names)}

    def hashed(batches):
        for batch in batches:
            col = texts(batch, "text")
            for lo in range(0, len(col), 1000):
                i, x, b = features(col.slice(lo, 1000))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(b, pa.int32()), pa.array(i, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(b, pa.int32()), pa.array(x, pa.float32())),
                     column(batch, "grade").slice(lo, 1000)], names=["i", "x", "grade"])

    def train(batches):
        got = [b for b in batches if b.num_rows]
        if not got:  # no graded text
            yield pa.RecordBatch.from_pydict({"w": [[0.0] * WIDTH], "tau": [[float(k) for k in range(len(names) - 1)]]})
            return
        t = pa.Table.from_batches(got).combine_chunks()
        i, x = t["i"].combine_chunks(), t["x"].combine_chunks()
        i, x = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (i, x))
        bounds = i.offsets.to_numpy().astype(np.int64)
        grade = np.array([rank[g] for g in t["grade"].to_pylist()])
        w, tau = fit_ordinal(i.flatten().to_numpy().astype(np.int64), x.flatten().to_numpy().astype(float),
                             bounds - bounds[0], grade, len(names))
        yield pa.RecordBatch.from_pydict({"w": [w.tolist()], "tau": [tau.tolist()]})

    model = (rows.mapInArrow(hashed, "i array<int>, x array<float>, grade int").repartition(1)
             .mapInArrow(train, "w array<double>, tau array<double>").first())
    return np.array(model.w), np.array(model.tau), names


def score_quality(docs: DataFrame, weights: np.ndarray, thresholds: np.ndarray, names: list[int], tail: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, expected_grade, p_tail = P(grade >= tail)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    values = np.array(names or [0], float)
    first = sum(g < tail for g in names)

    def run(batches):
        w = shared.value
        for batch in batches:
            col, grade, p = texts(batch, "text"), [], []
            for lo in range(0, len(col), 1000):
                i, x, b = features(col.slice(lo, 1000))
                cum = cumulative(row_sums(x * w[i], b), thresholds)
                grade.append(np.diff(cum, axis=1) @ values)
                p.append(1.0 - cum[:, first] if names else np.zeros(len(cum)))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(np.concatenate(grade) if grade else np.zeros(0)),
                 pa.array(np.concatenate(p) if p else np.zeros(0))], names=["doc_id", "expected_grade", "p_tail"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, expected_grade double, p_tail double")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, graded 0 (low quality), 1 (good but toxic) or 2 (good); learnt from those
    whose id's crc32 is not 0 modulo 5; selected where P(grade >= 1) is at least one half."""
    docs = table(spark, sf_dir, "documents")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    grades = table(spark, sf_dir, "labels").where(id_bucket("doc_id", 5) != 0).select("doc_id", grade.alias("grade"))
    scored = score_quality(docs, *fit(docs, grades), tail=1)
    return scored.select("doc_id", (id_bucket("doc_id", 5) == 0).alias("held_out"), "expected_grade", "p_tail",
                         (F.col("p_tail") >= 0.5).alias("selected"))

"""Operator 8: benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

Words are lower-cased runs of letters and digits.  One pass counts the corpus frequency of every
``n``-gram of the test items.  Seeds are n-grams that the corpus holds at all: of each item the rarest
``KEPT`` share of them (ties by hash), and of every ``STRETCH`` consecutive n-grams the rarest, so any
run of 2 * STRETCH + n - 2 copied words holds a seed, however long the item.  A second pass joins every
passage to the items whose seeds it holds and groups hits that agree on where the item would begin.  A
group that holds ``HITS`` of the whole item's n-grams is aligned with the whole item; of any other group
each stretch with ``LEAST`` different seeds (hits further than ``REACH`` words apart are two stretches) is
aligned with the item's words around it.  Alignment is local: 1 for an equal word, -1 for another word
or a gap.  Of a copy that keeps 40 % of the n-grams every word stays with a chance of 0.4 ** (1 / 3),
so its alignment scores ``SCORE`` = 0.47 a word.  A passage is a match if it scores that much per word of
the whole item (items too short to ask for ``FEW`` that way need ``FEW``, or ``SHORT`` of their words if
that is less), or per word it spans with a score of ``SPAN`` at least: a part of an item, however long
the item.  The score column is divided by the item's words.  No passage is grouped by seed, so a seed
in a third of all rows costs nothing more.

The items are a stated query set: they go to the tasks in blocks of about ``BLOCK`` bytes, each
against all documents.

Defined cases: null or empty texts and items match nothing; items of fewer than ``n`` words have
one seed, all their words; rows of ``docs`` give results one by one, so repeated rows and null ids
give repeated results; repeated items (same id and text) count once; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import column, table, texts
from tidelake.llm.words import NOT_ALNUM, hash_words, ngram_hashes

NGRAM, KEPT, HITS, COPIED, BLOCK = 3, 0.75, 0.15, 0.4, 8 << 20
STRETCH, LEAST, REACH = 3, 2, 24
SCORE = 2 * COPIED ** (1 / NGRAM) - 1  # equal words less changed ones, when COPIED of the n-grams stay
SPAN, FEW, SHORT = 8, 6, 0.6
MATCH = "doc_id long, item_id long, score double, first_word long, last_word long"


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of ``item`` in ``window``: score, first and last window word."""
    return alignments(item, window, SCORE, SPAN)[0]


def alignments(item: np.ndarray, window: np.ndarray, least: float, span: int) -> tuple[tuple[int, int, int], tuple[int, int, int]]:
    """The best local alignment, and the best of those that score ``span`` and ``least`` for each word they span."""
    m = len(window)
    step = np.arange(m + 1)
    best, best_at, dense, dense_at = 0, (0, 0), 0, (0, 0)
    row, begin, top = np.zeros(m + 1, np.int64), np.arange(m + 1), np.zeros(m + 1, np.int64)  # top: first item word
    for i, w in enumerate(item, 1):
        same = np.where(window == w, 1, -1)
        diag, up = row[:-1] + same, row[1:] - 1
        score = np.zeros(m + 1, np.int64)
        score[1:] = np.maximum(np.maximum(diag, up), 0)
        origin, above = step.copy(), np.full(m + 1, i)
        origin[1:] = np.where(score[1:] == 0, step[1:], np.where(diag >= up, begin[:-1], begin[1:]))
        above[1:] = np.where(score[1:] == 0, i, np.where(diag >= up, top[:-1], top[1:]))
        reach = np.maximum.accumulate(score + step)  # a gap along the window costs 1 a word
        first = np.maximum.accumulate(np.where(score + step == reach, step, 0))
        row, begin, top = reach - step, origin[first], above[first]
        j = int(row.argmax())
        if row[j] > best:
            best, best_at = int(row[j]), (int(begin[j]), j)
        if row[j] >= max(span, dense + 1):
            fine = np.where(row >= least * np.maximum(i - top, step - begin), row, 0)
            j = int(fine.argmax())
            if fine[j] >= max(span, dense + 1):
                dense, dense_at = int(fine[j]), (int(begin[j]), j)
    return (best, best_at[0], best_at[1] - 1), (dense, dense_at[0], dense_at[1] - 1)


class Items:
    """A block of test items: word hashes, n-grams, and (after ``seed``) the seeds."""

    def __init__(self, ids: list[int], items: list[str], n: int):
        words, rows = hash_words(pc.utf8_lower(pa.array(items, pa.string())), NOT_ALNUM)
        keep = [i for i in range(len(ids)) if rows[i + 1] > rows[i]]
        self.n = n
        self.ids = [ids[i] for i in keep]
        self.words = [words[rows[i]:rows[i + 1]] for i in keep]
        self.grams = [ngram_hashes(w, min(n, len(w))) for w in self.words]
        self.sizes = sorted({min(n, len(w)) for w in self.words})
        self.known = np.unique(np.concatenate(self.grams)) if self.grams else np.zeros(0, np.uint64)

    def seed(self, counts: dict[int, int], kept: float) -> None:
        rows = []
        for i, g in enumerate(self.grams):
            held = [int(x) for x in np.unique(g) if counts.get(int(x), 0)]
            held.sort(key=lambda x: (counts[x], x))
            keep = set(held[:int(np.ceil(kept * len(held)))])
            for a in range(0, len(g), STRETCH):
                here = [x for x in g[a:a + STRETCH].tolist() if counts.get(x, 0)]
                keep.update([min(here, key=lambda x: (counts[x], x))] if here else [])
            rows += [(int(x), i, p) for p, x in enumerate(g.tolist()) if int(x) in keep]
        rows.sort()
        self.seed_hash = np.array([r[0] for r in rows], np.uint64)
        self.seed_item = np.array([r[1] for r in rows], np.int64)
        self.seed_pos = np.array([r[2] for r in rows], np.int64)
        self.n_grams = np.array([len(np.unique(g)) for g in self.grams])


class Finder:
    """Positions of known hashes in a stream of hashes: a bit table, then an exact search."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.table = np.zeros(1 << 20, bool)
        self.table[(known >> np.uint64(44)).astype(np.int64)] = True

    def at(self, grams: np.ndarray) -> np.ndarray:
        hit = np.flatnonzero(self.table[(grams >> np.uint64(44)).astype(np.int64)])
        if len(hit) and len(self.known):
            k = np.minimum(np.searchsorted(self.known, grams[hit]), len(self.known) - 1)
            hit = hit[self.known[k] == grams[hit]]
        return hit


def passages(batch: pa.RecordBatch):
    """Word hashes and row offsets of the batch, in slices of rows."""
    col = texts(batch, "text")
    for lo in range(0, len(col), 1000):
        words, rows = hash_words(pc.utf8_lower(col.slice(lo, 1000)), NOT_ALNUM)
        yield lo, words, rows


def gram_hits(finder: Finder, words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, row, hash) of known n-grams that lie within one row."""
    grams = ngram_hashes(words, n)
    at = finder.at(grams)
    row = np.searchsorted(rows, at, side="right") - 1
    inside = at + n <= rows[row + 1]
    return at[inside], row[inside], grams[at[inside]]


def match_row(items: Items, words: np.ndarray, at: np.ndarray, grams: np.ndarray, hits: float, least: float):
    """(item index, score, first, last) of the items found in one document."""
    lo = np.searchsorted(items.seed_hash, grams, side="left")
    hi = np.searchsorted(items.seed_hash, grams, side="right")
    owner = np.repeat(np.arange(len(at)), hi - lo)
    seed = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)]) if len(owner) else np.zeros(0, np.int64)
    for i in np.unique(items.seed_item[seed]).tolist():
        mine = items.seed_item[seed] == i
        item = items.words[i]
        slack = max(4, len(item) // 4)
        whole = min(SHORT * len(item), max(least * len(item), FEW))
        begin, s = at[owner[mine]] - items.seed_pos[seed[mine]], seed[mine]
        order = np.argsort(begin, kind="stable")
        begin, s = begin[order], s[order]
        best = (0, 0, 0)
        for part in np.split(np.arange(len(begin)), np.flatnonzero(np.diff(begin) > slack) + 1):
            seeds = len(np.unique(items.seed_hash[s[part]]))
            if seeds >= max(1, hits * items.n_grams[i]):
                a = max(0, int(begin[part[0]]) - slack)
                b = min(len(words), int(begin[part[-1]]) + len(item) + slack)
                found, dense = alignments(item, words[a:b], least, SPAN)
                score, first, last = found if found[0] >= whole else dense
                best = max(best, (score, a + first, a + last))
                continue
            if seeds < LEAST:
                continue
            at_item = items.seed_pos[s[part]]
            order = np.argsort(at_item, kind="stable")
            for run in np.split(part[order], np.flatnonzero(np.diff(at_item[order]) > REACH) + 1):
                if len(np.unique(items.seed_hash[s[run]])) < LEAST:
                    continue
                spot = items.seed_pos[s[run]]
                here = begin[run] + spot
                lo_i, hi_i = max(0, int(spot.min()) - REACH), min(len(item), int(spot.max()) + items.n + REACH)
                a, b = max(0, int(here.min()) - REACH), min(len(words), int(here.max()) + items.n + REACH)
                score, first, last = alignments(item[lo_i:hi_i], words[a:b], least, SPAN)[1]
                best = max(best, (score, a + first, a + last))
        if best[0]:
            yield i, best[0] / len(item), best[1], best[2]


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, kept: float = KEPT, hits: float = HITS,
                 least: float = SCORE, block_bytes: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): passages of ``docs`` (doc_id, text) that
    align with an item of ``benchmark`` (item_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tests = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    size = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size * 4 // block_bytes))
    out = None
    for b in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()
        items = Items([r[0] for r in part], [r[1] for r in part], n)
        found = _block(spark, docs, items, kept, hits, least)
        out = found if out is None else out.union(found)
    return out


def _block(spark: SparkSession, docs: DataFrame, items: Items, kept: float, hits: float, least: float) -> DataFrame:
    raw = spark.sparkContext.broadcast(items)

    def count(batches):
        finder, total = Finder(raw.value.known), {}
        for batch in batches:
            for _, words, rows in passages(batch):
                for k in raw.value.sizes:
                    u, c = np.unique(gram_hits(finder, words, rows, k)[2], return_counts=True)
                    for x, m in zip(u.tolist(), c.tolist()):
                        total[x] = total.get(x, 0) + m
        keys = np.fromiter(total, np.uint64, len(total)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(list(total.values()), pa.int64())], names=["g", "n"])

    # as many rows as the block has n-grams
    seen = docs.select("text").mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).collect()
    items.seed({int(np.int64(r.g).view(np.uint64)): r.n for r in seen}, kept)
    seeded = spark.sparkContext.broadcast(items)

    def run(batches):
        it = seeded.value
        finder = Finder(np.unique(it.seed_hash))
        for batch in batches:
            out = []
            ids = column(batch, "doc_id")
            for lo, words, rows in passages(batch):
                found = [gram_hits(finder, words, rows, k) for k in it.sizes]
                at, row, grams = (np.concatenate([f[j] for f in found]) for j in range(3)) if found else ([], [], [])
                for r in np.unique(row).tolist():
                    here = row == r
                    text = words[rows[r]:rows[r + 1]]
                    for i, score, a, b in match_row(it, text, at[here] - rows[r], grams[here], hits, least):
                        out.append((ids[lo + r].as_py(), it.ids[i], score, a, b))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                    names=["doc_id", "item_id", "score", "first_word", "last_word"])

    return docs.mapInArrow(run, MATCH)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against all items of ``benchmark``."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

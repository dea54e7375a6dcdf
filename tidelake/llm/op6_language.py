"""Operator 6: language identification by segmentation-marginalised unigrams.

The pieces are those of a public vocabulary, lower-cased, letters only.  Each language has a
probability for every piece; a word's probability is the sum over all its segmentations into
pieces, by the forward algorithm, and a text's is the product over its words.  Piece
probabilities come from expectation-maximisation (forward-backward) on the words of labelled
texts.  All words of a batch go through the recursions together, one position and one piece
length at a time, and a word's result is kept for its repetitions.  A run of more than ``WORD`` letters
goes through them by itself, piece by piece of the run, with the forward vector carried on, so it is one
word however long.

The fit takes about ``SAMPLE`` texts per language (a documented bound, chosen by a hash of the
id) and learns nothing from runs of more than ``WORD`` letters; scoring reads every whole text with all
pieces of the vocabulary, and does not look at lang, source or doc_id.

Defined cases: null texts and texts without letters give ``und`` with score 0; a row's other
columns never matter; if nothing is labelled every text is ``und``; equal scores go to the first
language in alphabetical order; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.common import column, id_bucket, stored, table, texts

SAMPLE, ROUNDS, WORD, STRETCH = 3000, 3, 48, 4096
SCALE, UNKNOWN = 150.0, 1e-7  # a factor per letter against underflow; probability of a letter outside the vocabulary
LETTERS = re.compile(r"[^\W\d_]+")
MULT = np.uint64(0x9E3779B97F4A7C15)
CACHE_WORDS = 300_000


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[str, ...]:
    """Lower-cased pieces of letters with an optional word start."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())}
    return tuple(sorted(p for p in pieces if p.lstrip("▁").isalpha() and p.count("▁") <= 1))


def coded(words: list[str]) -> np.ndarray:
    """Code points plus one, zero-padded, one word a row."""
    joined = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), int(size.max(initial=1))), np.uint64)
    out[np.arange(out.shape[1]) < size[:, None]] = joined.astype(np.uint64) + np.uint64(1)
    return out


class Lattice:
    """Which piece ends at each position of each word, by piece length."""

    def __init__(self, pieces: tuple[str, ...]):
        codes = coded(list(pieces))
        key = np.zeros(len(pieces), np.uint64)
        for t in range(codes.shape[1]):
            key = np.where(codes[:, t] > 0, key * MULT + codes[:, t], key)
        self.order = np.argsort(key).astype(np.int32)
        self.keys = key[self.order]
        self.longest = codes.shape[1]
        self.n = len(pieces)

    def find(self, words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Word sizes, and for each piece length l the piece id (or -1) that ends at t."""
        codes = coded(words)
        n, width = codes.shape
        prefix = np.zeros((n, width + 1), np.uint64)
        for t in range(width):
            prefix[:, t + 1] = prefix[:, t] * MULT + codes[:, t]
        ends = []
        power = np.uint64(1)
        for size in range(1, min(self.longest, width) + 1):
            power = np.uint64((int(power) * int(MULT)) % (1 << 64))
            key = prefix[:, size:] - prefix[:, :width + 1 - size] * power
            at = np.minimum(np.searchsorted(self.keys, key), self.n - 1)
            ends.append(np.where((self.keys[at] == key) & (codes[:, size - 1:] > 0), self.order[at], -1))
        return (codes > 0).sum(axis=1), ends


def scaled(prob: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Piece probabilities (piece, language) times SCALE per letter; a last row of zeros stands
    for "no piece"."""
    return np.vstack([prob * (SCALE ** sizes)[:, None], np.zeros((1, prob.shape[1]))])


def forward(sizes: np.ndarray, ends: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
    """alpha[t] (word, language): scaled probability of the first t letters."""
    width = ends[0].shape[1]
    alpha = np.zeros((width + 1, len(sizes), weight.shape[1]))
    alpha[0] = 1.0
    for t in range(1, width + 1):
        live = np.flatnonzero(sizes >= t)
        total = np.zeros((len(live), weight.shape[1]))
        for k, end in enumerate(ends[:t]):
            piece = end[live, t - 1 - k]
            if k == 0:
                total += alpha[t - 1][live] * np.where((piece < 0)[:, None], UNKNOWN * SCALE, weight[piece])
                continue
            there = np.flatnonzero(piece >= 0)  # few words have a piece of this length here
            if len(there):
                total[there] += alpha[t - 1 - k][live[there]] * weight[piece[there]]
        alpha[t, live] = total
    return alpha


def forward_long(word: str, lattice: Lattice, weight: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """Log probability (language) of a word of any length, by stretches of it: of the forward vector only
    the last positions are held, each language's scaled to 1 as it goes."""
    longest, languages = lattice.longest, weight.shape[1]
    past = np.zeros((longest, languages))  # newest first
    past[0], log = 1.0, np.zeros(languages)
    for a in range(0, len(word), stretch):
        b, base = min(a + stretch, len(word)), max(0, a - longest)
        _, ends = lattice.find([word[base:b]])
        piece = np.full((b - a, longest), -1)
        for k, end in enumerate(ends):
            starts = np.arange(a, b) - k - base
            piece[starts >= 0, k] = end[0, starts[starts >= 0]]
        w = weight[piece]
        w[:, 0] = np.where((piece[:, 0] < 0)[:, None], UNKNOWN * SCALE, w[:, 0])
        for at in range(b - a):
            new = (past * w[at]).sum(axis=0)
            past[1:] = past[:-1].copy()
            past[0] = new
            if (a + at) % 16 == 15:
                top = past.max(axis=0)
                log += np.log(top)
                past /= top
    return log + np.log(past[0]) - len(word) * np.log(SCALE)


def expected(sizes, ends, weight: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (piece, language) for words seen ``counts`` times."""
    alpha = forward(sizes, ends, weight)
    width, rows = ends[0].shape[1], np.arange(len(sizes))
    whole = np.maximum(alpha[sizes, rows], 1e-300)
    beta = np.zeros_like(alpha)
    beta[sizes, rows] = counts / whole
    out = np.zeros_like(weight)
    for t in range(width, 0, -1):
        live = np.flatnonzero(sizes >= t)
        for k, end in enumerate(ends[:t]):
            piece, rows = end[live, t - 1 - k], live
            if k:
                rows = live[piece >= 0]
                piece = piece[piece >= 0]
            w = weight[piece]
            if k == 0:
                w = np.where((piece < 0)[:, None], UNKNOWN * SCALE, w)
            use = w * beta[t][rows]
            np.add.at(out, piece, alpha[t - 1 - k][rows] * use)
            beta[t - 1 - k, rows] += use
    return out[:-1]


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return LETTERS.findall(text.lower())


def letters_only(words: list[str]) -> list[str]:
    return ["▁" + (w if w.isalpha() else "".join(c for c in w if c.isalpha())) for w in words]


class Model:
    """Piece log-probabilities by language; scores batches of texts."""

    def __init__(self, vocab: str, languages: list[str], prior: np.ndarray, prob: np.ndarray):
        self.vocab, self.languages, self.prior, self.prob = vocab, languages, prior, prob
        self.seen: dict[str, int] | None = None

    def _prepare(self) -> None:
        pieces = vocabulary(self.vocab)
        self.lattice = Lattice(pieces)
        self.weight = scaled(self.prob, np.array([len(p) for p in pieces]))
        self.seen, self.rows = {}, np.zeros((1024, len(self.languages) + 1))

    def _learn(self, words: list[str]) -> None:
        """Score words not seen before; the last column tells whether there is a letter."""
        for lo in range(0, len(words), 20_000):
            part = sorted((w for w in words[lo:lo + 20_000] if len(w) <= WORD), key=len)
            for a in range(0, len(part), 4000):  # words of like length share a lattice
                some = part[a:a + 4000]
                marked = letters_only(some)
                sizes, ends = self.lattice.find(marked)
                last = forward(sizes, ends, self.weight)[sizes, np.arange(len(sizes))]
                has = sizes > 1
                self._keep(some, np.where(has[:, None], np.log(np.maximum(last, 1e-300)) - (sizes * np.log(SCALE))[:, None], 0.0), has)
        for word in words:
            if len(word) > WORD:
                marked = letters_only([word])[0]
                has = len(marked) > 1
                self._keep([word], forward_long(marked, self.lattice, self.weight) if has else 0.0, has)

    def _keep(self, words: list[str], rows, has) -> None:
        at = len(self.seen)
        while at + len(words) > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        self.rows[at:at + len(words), :-1] = rows
        self.rows[at:at + len(words), -1] = has
        self.seen.update(zip(words, range(at, at + len(words))))

    def score(self, items: list[str]) -> tuple[list[str], np.ndarray]:
        if self.seen is None or len(self.seen) > CACHE_WORDS:
            self._prepare()
        if not self.languages:
            return ["und"] * len(items), np.zeros(len(items))
        split = [words_of(t) for t in items]
        self._learn(list({w for ws in split for w in ws if w not in self.seen}))
        total = np.zeros((len(items), len(self.languages) + 1))
        for i, ws in enumerate(split):
            if ws:
                total[i] = self.rows[[self.seen[w] for w in ws]].sum(axis=0)
        like = total[:, :-1] + self.prior
        best = like.argmax(axis=1)
        score = 1.0 / np.exp(like - like.max(axis=1, keepdims=True)).sum(axis=1)
        known = total[:, -1] > 0
        return ([self.languages[b] if k else "und" for b, k in zip(best, known)], np.where(known, score, 0.0))


def fit(docs: DataFrame, vocab: str, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Fit on about ``sample`` rows of ``docs`` (doc_id, text, lang) per language."""
    spark = docs.sparkSession
    rows = docs.where("lang is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    number = {k: i for i, k in enumerate(languages)}
    prior = np.log([sizes[k] / sum(sizes.values()) for k in languages]) if languages else np.zeros(0)
    pieces = vocabulary(vocab)
    prob = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    if not languages:
        return Model(vocab, languages, prior, prob)
    share = spark.createDataFrame([(k, min(1.0, sample / n)) for k, n in sizes.items()], "lang string, share double")
    taken = (rows.join(F.broadcast(share), "lang")  # one row per language
             .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)))

    def count(batches):
        for batch in batches:
            seen: dict[tuple[int, str], int] = {}
            for lang, text in zip(column(batch, "lang").to_pylist(), texts(batch, "text").to_pylist()):
                for w in words_of(text):
                    if len(w) > WORD:
                        continue  # the fit's bound
                    seen[number[lang], w] = seen.get((number[lang], w), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.int32()), pa.array([k[1] for k in seen], pa.string()),
                 pa.array(list(seen.values()), pa.int64())], names=["l", "word", "n"])

    words = stored(taken.mapInArrow(count, "l int, word string, n long").groupBy("l", "word")
                   .agg(F.sum("n").alias("n")), "language-words")
    size = np.array([len(p) for p in pieces])

    for _ in range(rounds):
        current = spark.sparkContext.broadcast(prob.astype(np.float32))

        def expect(batches):
            lattice, weight = Lattice(vocabulary(vocab)), scaled(current.value.astype(float), size)
            total = np.zeros((len(size), len(languages)))
            for batch in batches:
                word, lang, n = column(batch, "word").to_pylist(), column(batch, "l").to_numpy(), column(batch, "n").to_numpy()
                order = sorted(range(len(word)), key=lambda i: len(word[i]))
                for a in range(0, len(order), 4000):
                    pick = np.array(order[a:a + 4000])
                    at, ends = lattice.find(letters_only([word[i] for i in pick]))
                    counts = np.zeros((len(pick), len(languages)))
                    counts[np.arange(len(pick)), lang[pick]] = n[pick]
                    total += expected(at, ends, weight, counts)
            p, k = np.nonzero(total > 1e-6)
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(k.astype(np.int32)),
                                              pa.array(total[p, k])], names=["p", "l", "x"])

        got = (words.mapInArrow(expect, "p int, l int, x double").groupBy("p", "l").agg(F.sum("x").alias("x")).toPandas())
        found = np.full((len(pieces), len(languages)), 0.05)  # at most vocabulary x languages numbers
        found[got["p"], got["l"]] += got["x"]
        prob = found / found.sum(axis=0)
        current.unpersist()
    return Model(vocab, languages, prior, prob)


def label(docs: DataFrame, model: Model, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its probability appended under these names (its own
    columns of the same names are replaced)."""
    plain = docs.drop(pred, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = plain.columns

    def run(batches):
        for batch in batches:
            items, found, prob = texts(batch, "text"), [], []
            for lo in range(0, len(items), 500):
                p, x = shared.value.score(items.slice(lo, 500).to_pylist())
                found += p
                prob.append(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()),
                                              pa.array(np.concatenate(prob) if prob else np.zeros(0))],
                                             names=[*names, pred, score])

    schema = T.StructType([*plain.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return plain.mapInArrow(run, schema)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, learnt from those whose id's crc32 is not 2 modulo 4."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    bucket = id_bucket("doc_id", 4)
    model = fit(docs.where(bucket != 2), public_tokenizers.path("piece_bpe_32k.model"))
    out = label(docs.select("doc_id", "text", (bucket == 2).alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")

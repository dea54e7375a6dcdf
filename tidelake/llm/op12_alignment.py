"""Operator 12: alignment of two tokenizers' ids over whole texts, on Arrow columns.

A task encodes a slice of texts with both tokenizers into two list columns, flattens them with their
parent indices, looks up each token's bytes and sums them up within each document: the byte offsets
at which tokens end.  A hash join on (document, end) gives the links; a ``group_by`` counts the linked
id pairs of a block of texts.  Spark merges these partial counts and finds each B id's highest.

What a document needs back are the counts of its own pairs.  A block keeps its links as positions in
its own list of distinct pairs, so only (block, pair) rows meet the corpus-wide counts: a pair that
every document holds has one row a block.  They return to the block's links by a co-group.  The id
pairs are never broadcast, and neither the driver nor a task sees more than one block.

Defined cases: null and empty texts, and texts whose joined token bytes are not the space and the
text (a text that holds U+2581 for one), have no tokens: zeros and ''.  Every row gives a result row,
rows without ``doc_id`` and repeated rows included, and each counts; ties for a B id's highest count
all count as best; an empty table gives an empty result; extra columns are ignored.  A text is never
cut: one longer than a block is a block.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import column, stored, table, texts
from tidelake.llm.tokens import encoder
from tidelake.llm.words import by_bytes, raw_text

BLOCK_BYTES = 4 << 20
ENCODED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<int>, "
           "pairs array<long>, counts array<long>")
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
SIDE = 32  # a pair is (A id) << SIDE | (B id)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 letters stand for
    themselves, the other bytes in order for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass
class Side:
    """One tokenizer: ``ids`` gives a list column for texts; ``parts`` holds each id's bytes."""

    ids: object
    parts: pa.Array

    def __post_init__(self):
        self.size = pc.binary_length(self.parts).cast(pa.int64())


def byte_side(path: str) -> Side:
    enc, letter = encoder(path), byte_letters()
    entries = {i: t for t, i in enc.tok.get_vocab().items()}
    parts = [bytes(letter[c] for c in entries.get(i, "")) for i in range(max(entries) + 1)]

    def ids(col: pa.Array) -> pa.ListArray:
        flat, at = enc.encode(col)
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.astype(np.int32)))

    return Side(ids, pa.array(parts, pa.binary()))


def piece_side(path: str) -> Side:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    parts = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
             for i in range(sp.get_piece_size())]

    def ids(col: pa.Array) -> pa.ListArray:
        return pa.array(sp.encode(col.to_pylist(), num_threads=1), pa.list_(pa.int32()))

    return Side(ids, pa.array(parts, pa.binary()))


_sides: dict[tuple[str, str], tuple[Side, Side, pa.Array]] = {}


def sides(a_path: str, b_path: str) -> tuple[Side, Side, pa.Array]:
    """Both tokenizers and the decimal ids with each separator, once for each Python worker."""
    if (a_path, b_path) not in _sides:
        a, b = byte_side(a_path), piece_side(b_path)
        n = max(len(a.parts), len(b.parts))
        _sides[a_path, b_path] = a, b, pa.array([f"{i}{mark}" for mark in ",|;" for i in range(n)], pa.string())
    return _sides[a_path, b_path]


def joined_bytes(parts: pa.Array, flat: pa.Array) -> np.ndarray:
    """The bytes of a run of tokens, joined."""
    taken = pc.take(parts, flat)
    off = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset:taken.offset + len(taken) + 1]
    return np.frombuffer(taken.buffers()[2], np.uint8)[off[0]:off[-1]] if len(taken) and taken.buffers()[2] else np.zeros(0, np.uint8)


class Tokens:
    """The tokens of a slice of texts by one tokenizer: ids, documents and byte ends in them."""

    def __init__(self, side: Side, lists: pa.ListArray, data: np.ndarray, off: np.ndarray):
        self.flat, self.doc = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
        total = pc.cumulative_sum(pc.take(side.size, self.flat)).to_numpy(zero_copy_only=False)
        at = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        marks = np.concatenate([[0], total])[at]  # bytes before each document's tokens
        self.end = pc.subtract(pa.array(total, pa.int64()), pc.take(pa.array(marks[:-1], pa.int64()), self.doc))
        mine = joined_bytes(side.parts, self.flat)
        self.true = np.diff(marks) == np.diff(off)
        if not (self.true.all() and np.array_equal(mine, data)):
            for i in np.flatnonzero(self.true):
                self.true[i] = np.array_equal(mine[marks[i]:marks[i + 1]], data[off[i]:off[i + 1]])

    def table(self, kept: np.ndarray, side: str) -> pa.Table:
        t = pa.table({"doc": self.doc, "end": self.end, side: self.flat})
        return t if kept.all() else t.filter(pc.take(pa.array(kept), self.doc))


def links_of(ta: pa.Table, tb: pa.Table) -> pa.Table:
    """(doc, end, a, b): all pairs of tokens that end together, in order of document and end."""
    return ta.join(tb, ["doc", "end"], join_type="inner", use_threads=False).sort_by([("doc", "ascending"), ("end", "ascending")])


def differs(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has a new value."""
    return np.append(True, x[1:] != x[:-1])[:len(x)]


def group_texts(ta: pa.Table, tb: pa.Table, links: pa.Table, off: np.ndarray, written: pa.Array) -> list[str]:
    """Digest of each document's groups; '' for one without tokens."""
    n = len(off) - 1
    doc_a, doc_b, doc_l = (t["doc"].to_numpy() for t in (ta, tb, links))
    end_a, end_b = ta["end"].to_numpy() + off[doc_a], tb["end"].to_numpy() + off[doc_b]
    cuts = links["end"].to_numpy() + off[doc_l]
    cuts = cuts[differs(cuts)]
    in_a, in_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    last_a, last_b = (np.append(g[1:] != g[:-1], True)[:len(g)] for g in (in_a, in_b))
    ids = len(written) // 3
    out = np.empty(len(in_a) + len(in_b), np.int64)
    out[np.arange(len(in_a)) + np.searchsorted(in_b, in_a)] = ta["a"].to_numpy() + ids * last_a
    out[np.arange(len(in_b)) + np.searchsorted(in_a, in_b, side="right")] = tb["b"].to_numpy() + 2 * ids * last_b
    line = pc.take(written, pa.array(out))
    if len(line) == 0:
        return [""] * n
    at = np.frombuffer(line.buffers()[1], np.int32)[line.offset:line.offset + len(line) + 1]
    raw = memoryview(line.buffers()[2])
    row = np.arange(n + 1)
    ends = at[np.searchsorted(doc_a, row) + np.searchsorted(doc_b, row)]
    return [hashlib.sha256(raw[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]


def align_slice(col: pa.Array, a: Side, b: Side, written: pa.Array):
    """Counts (n_a, n_b, n_groups, n_links), digests, and the links' pairs in order of document."""
    spaced = pc.binary_join_element_wise(pa.scalar(" "), col, pa.scalar(""))
    data, off = raw_text(spaced)
    full = pc.greater(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    tokens_a, tokens_b = Tokens(a, a.ids(spaced), data, off), Tokens(b, b.ids(col), data, off)
    kept = full & tokens_a.true & tokens_b.true
    ta, tb = tokens_a.table(kept, "a"), tokens_b.table(kept, "b")
    links = links_of(ta, tb)
    n = len(col)
    count = lambda t: np.bincount(t["doc"].to_numpy(), minlength=n)
    doc = links["doc"].to_numpy()
    groups = np.bincount(doc[differs(links["end"].to_numpy() + off[doc])], minlength=n)
    pairs = pc.bit_wise_or(pc.shift_left(links["a"].cast(pa.int64()), SIDE), links["b"].cast(pa.int64()))
    return (count(ta), count(tb), groups, count(links)), group_texts(ta, tb, links, off, written), pairs


def block_rows(block: int, ids: list, counts: list, digests: list, pairs: list) -> pa.RecordBatch:
    """A block's documents, with links as positions in its distinct pairs, which, with their
    counts, go with the first row."""
    n = np.concatenate([np.stack(c) for c in counts], axis=1).astype(np.int64)
    coded = pa.chunked_array([c for p in pairs for c in p.chunks], pa.int64()).combine_chunks().dictionary_encode()
    per = pa.table({"code": coded.indices}).group_by("code", use_threads=False).aggregate([([], "count_all")]).sort_by("code")
    at = np.concatenate([[0], np.cumsum(n[3])])
    once = lambda x: pa.ListArray.from_arrays(pa.array([0, *[len(x)] * n.shape[1]], pa.int32()), x,
                                              mask=pa.array(np.arange(n.shape[1]) > 0))
    links = pa.ListArray.from_arrays(pa.array(at, pa.int32()), coded.indices.cast(pa.int32()))
    cols = [pa.array(np.full(n.shape[1], block)), pa.array(ids, pa.int64()), *[pa.array(x) for x in n],
            pa.array([d for some in digests for d in some], pa.string()), links, once(coded.dictionary),
            once(per["count_all"].combine_chunks().cast(pa.int64()))]
    names = "block doc_id n_a n_b n_groups n_links groups_sha256 links pairs counts".split()
    return pa.RecordBatch.from_arrays(cols, names=names)


def encoded(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document with its block, its digest and its links; partial counts per block."""
    def run(batches):
        a, b, written = sides(a_path, b_path)
        block, held, size = TaskContext.get().partitionId() << SIDE, ([], [], [], []), 0
        for batch in batches:
            ids, col = column(batch, "doc_id").to_pylist(), texts(batch, "text")
            for lo, hi in by_bytes(col):
                some = col.slice(lo, hi - lo)
                found = align_slice(some, a, b, written)
                for have, new in zip(held, (ids[lo:hi], *found)):
                    have.extend(new) if have is held[0] else have.append(new)
                size += pc.sum(pc.binary_length(some)).as_py()
                if size >= block_bytes:
                    yield block_rows(block, *held)
                    block, held, size = block + 1, ([], [], [], []), 0
        if held[0]:
            yield block_rows(block, *held)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): how many links hold each id pair, and whether no other pair of its B id
    has more.  A B id has at most as many pairs as A has ids."""
    merged = blocks.groupBy("pair").agg(F.sum("n").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << SIDE) - 1)))
    return merged.withColumn("best", F.col("count") == F.max("count").over(of_b))


def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents with the corpus-wide counts of its pairs."""
    count = np.zeros(right.num_rows + 1, np.int64)
    best = np.zeros(right.num_rows + 1, np.int64)
    if right.num_rows:
        code = right["code"].to_numpy()
        count[code], best[code] = right["count"].to_numpy(), right["best"].to_numpy().astype(np.int64)
    n = left["n_links"].to_numpy()
    at = np.concatenate([[0], np.cumsum(n)])
    code = pc.list_flatten(left["links"].combine_chunks()).to_numpy()
    total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[code])])[at])
    names = "doc_id n_a n_b n_groups n_links".split()
    return pa.table([*[left[c] for c in names], pa.array(total(best)), pa.array(total(count)), left["groups_sha256"]],
                    names=[*names, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): token, group and link counts, its links' corpus-wide counts
    and the digest of its groups."""
    rows = stored(encoded(docs, a_path, b_path, block_bytes), "aligned")
    held = rows.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "p"))
    blocks = held.select("block", "code", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    back = blocks.join(stored(pair_counts(blocks), "pair-counts"), "pair").select(F.col("block").alias("of"), "code", "count", "best")
    return rows.drop("pairs", "counts").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(resolve, ALIGNED)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` by a byte-level and a piece vocabulary."""
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))

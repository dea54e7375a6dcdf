"""Operator 2: nearest neighbours through learned partitions.

A bounded sample of the vectors gives a neighbour graph; the graph is cut into balanced parts,
and a small classifier learns to tell a vector's parts.  Every vector is indexed under its most
probable part.  A query goes to its most probable parts, and all vectors there are ranked by the
exact inner product.  How many parts that takes for a recall of ``RECALL`` is measured on held-out
vectors: a second bounded sample that trained nothing, searched exactly against all vectors.

Equal vectors are one class with its smallest ids (a query's 20 nearest need no more than 21 of
them), so copies cost one row however many there are.  Parts are split into blocks of candidates
and of queries, and a task sees one block of each; a query gets one row from a block, the list of its
best there, and the lists are then merged.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part, neither do vectors whose size is not the commonest one (ties: the larger) or rows without id;
rows that repeat an id and its vector count once; a table smaller than one part is searched whole;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import column, stored, table
from tidelake.llm.graph_partition import balanced_parts, neighbours, train_router

SAMPLE, HELD_OUT, PART_ROWS, GRAPH_K, RECALL = 8192, 1024, 4096, 10, 0.985
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024


def usable(vec: str) -> Column:
    x = F.col(vec)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & fine & F.exists(x, lambda v: v != 0)


def matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def classes_of(vectors: DataFrame, keep: int) -> DataFrame:
    """(cid, vec, ids): distinct vectors with their ``keep`` smallest ids."""
    rank = Window.partitionBy("vec").orderBy("vec_id")  # limited before the shuffle, so copies do not pile up
    first = vectors.select("vec_id", "vec").withColumn("r", F.dense_rank().over(rank)).where(F.col("r") <= keep)
    return first.groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("cid"), "vec", "ids")


class Index:
    """Routes vectors to parts; ``probes`` is all of them until ``probes_needed`` says less."""

    def __init__(self, sample: np.ndarray, parts: int):
        self.parts = self.probes = parts
        if parts > 1:
            near = neighbours(sample, GRAPH_K)
            self.router = train_router(sample, near, balanced_parts(sample, near, parts), parts)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        if self.parts == 1:
            return np.zeros((len(x), 1), np.int64)
        return np.argsort(-self.router.logits(x), axis=1, kind="stable")


BEST = pa.list_(pa.struct([("s", pa.float64()), ("cid", pa.int64())]))


def best_lists(who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.Table:
    """A row per query: its list of (-score, cid), from matrices of a row per query."""
    pairs = pa.StructArray.from_arrays([pa.array(-scores.ravel()), pa.array(ids.ravel())], fields=list(BEST.value_type))
    ends = np.arange(len(who) + 1, dtype=np.int32) * ids.shape[1]
    return pa.table({"query": pa.array(who, pa.int64()), "best": pa.ListArray.from_arrays(pa.array(ends), pairs).cast(BEST)})


def merged(lists: DataFrame, keep: int) -> DataFrame:
    """(query, best): the ``keep`` best of all of a query's lists, ties to the smaller id."""
    return lists.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, keep).alias("best"))


def build_index(classes: DataFrame, n: int, sample: int = SAMPLE, part_rows: int = PART_ROWS,
                held_out: int = HELD_OUT) -> tuple[Index, pa.Table]:
    """The index, fitted on about ``sample`` classes, and about ``held_out`` others (cid, vec) to
    measure it with (documented bounds, by a hash of the id)."""
    parts = max(1, min(-(-n // part_rows), sample // 32))
    if parts == 1:
        return Index(np.zeros((0, 0)), 1), classes.limit(0).select("cid", "vec").toArrow()
    held = min(0.25, held_out / n)
    share = min(1.0 - held, sample / n)
    place = F.pmod(F.xxhash64("cid"), F.lit(1 << 30))
    first, last = int(share * (1 << 30)), int((share + held) * (1 << 30))
    rows = classes.where(place < first).select("vec").toArrow()
    others = classes.where((place >= first) & (place < last)).select("cid", "vec").toArrow()
    return Index(matrix(rows["vec"].combine_chunks()), parts), others


def probes_needed(cand: DataFrame, index: Index, held_out: pa.Table, k: int) -> int:
    """How many parts hold ``RECALL`` of the true ``k`` nearest of the held-out rows, which are
    compared with all of ``cand`` (cid, vec, part)."""
    if index.parts == 1 or not held_out.num_rows:
        return index.parts
    who, x = held_out["cid"].to_numpy(), matrix(held_out["vec"].combine_chunks())
    shared = cand.sparkSession.sparkContext.broadcast((who, x))

    def run(batches):
        who, x = shared.value
        score, ids = np.zeros((len(who), 0)), np.zeros((len(who), 0), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                block = batch.slice(lo, 4096)
                cid = column(block, "cid").to_numpy()
                s = x @ matrix(column(block, "vec")).T
                s[who[:, None] == cid[None, :]] = -np.inf
                some = np.argpartition(-s, min(k, len(cid)) - 1, axis=1)[:, :k]
                score = np.hstack([score, np.take_along_axis(s, some, axis=1)])
                ids = np.hstack([ids, cid[some]])
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                score, ids = np.take_along_axis(score, top, axis=1), np.take_along_axis(ids, top, axis=1)
        if ids.shape[1]:
            yield best_lists(who, ids, score).combine_chunks().to_batches()[0]

    exact = cand.select("cid", "vec").mapInArrow(run, "query long, best array<struct<s: double, cid: long>>")
    pairs = merged(exact, k).select("query", F.explode("best").alias("b")).select("query", "b.cid")
    found = pairs.join(cand.select("cid", "part"), "cid").select("query", "part").toArrow()  # k numbers a held-out row
    order = index.ranked(x)
    place = np.empty_like(order)  # at which rank a part stands for a row
    np.put_along_axis(place, order, np.arange(index.parts)[None, :], axis=1)
    by_id = np.argsort(who)
    row = by_id[np.searchsorted(who, found["query"].to_numpy(), sorter=by_id)]
    rank = place[row, found["part"].to_numpy()]
    return next(p for p in range(1, index.parts + 1) if (rank < p).mean() >= RECALL or p == index.parts)


def routed(rows: DataFrame, index: Index, probes: int, sizes: dict[int, int] | None = None, least: int = 0) -> DataFrame:
    """``rows`` (cid, vec) once per part of its first ``probes``; with ``sizes``, more parts until
    they hold ``least`` candidates."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        it = shared.value
        size = np.array([(sizes or {}).get(p, 0) for p in range(it.parts)])
        for batch in batches:
            order = it.ranked(matrix(column(batch, "vec")))
            enough = np.full(len(order), probes)
            if sizes:
                held = np.cumsum(size[order], axis=1)
                enough = np.maximum(enough, 1 + (held < least).sum(axis=1))
            take = np.arange(it.parts) < enough[:, None]
            row = np.nonzero(take)[0]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "cid").take(pa.array(row)), column(batch, "vec").take(pa.array(row)),
                 pa.array(order[take].astype(np.int32))], names=["cid", "vec", "part"])

    return rows.select("cid", "vec").mapInArrow(run, "cid long, vec array<double>, part int")


def best_in_block(keep: int):
    def run(cand: pa.Table, query: pa.Table) -> pa.Table:
        if not cand.num_rows or not query.num_rows:
            return pa.schema([("query", pa.int64()), ("best", BEST)]).empty_table()
        cand = cand.sort_by("cid")
        ids = cand["cid"].to_numpy()
        x, q = matrix(cand["vec"].combine_chunks()), matrix(query["vec"].combine_chunks())
        top, score = [], []
        k = min(keep, len(ids))
        for lo in range(0, len(q), 256):
            s = q[lo:lo + 256] @ x.T
            t = np.argsort(-s, axis=1, kind="stable")[:, :k]  # ties to the smaller id
            top.append(ids[t])
            score.append(np.take_along_axis(s, t, axis=1))
        return best_lists(query["cid"].to_numpy(), np.concatenate(top), np.concatenate(score))

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, sample: int = SAMPLE, part_rows: int = PART_ROWS) -> DataFrame:
    """``vectors`` (vec_id, embedding): the ``k`` nearest others found for each row that ``is_query``
    names (over vec_id): query_id, rank, vec_id, score."""
    rows = (vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vec"))
            .where(F.col("vec_id").isNotNull() & usable("vec")))
    widths = rows.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    rows = rows.where(F.size("vec") == (widths.w if widths else 0))
    classes = stored(classes_of(rows, k + 1), "vector-classes")
    n = classes.count()
    index, held_out = build_index(classes, n, sample, part_rows)
    asked = stored(rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vec").distinct()
                   .join(classes.select("vec", "cid"), "vec").select("query_id", "cid"), "queries")
    cand = stored(routed(classes, index, 1), "parts")
    index.probes = probes_needed(cand, index, held_out, k)
    sizes = {r["part"]: r["n"] for r in cand.groupBy("part").agg(F.count("*").alias("n")).collect()}
    wanted = classes.join(asked.select("cid").distinct(), "cid", "left_semi")
    query = stored(routed(wanted, index, index.probes, sizes, k + 1), "routed-queries")
    n_queries = {r["part"]: r["n"] for r in query.groupBy("part").agg(F.count("*").alias("n")).collect()}

    # Blocks: every block of a part's candidates meets every block of its queries.
    blocks = [(p, -(-sizes.get(p, 0) // BLOCK_ROWS), -(-n_queries.get(p, 0) // BLOCK_QUERIES)) for p in range(index.parts)]
    plan = F.broadcast(vectors.sparkSession.createDataFrame(blocks, "part int, cb int, qb int"))  # a row per part
    hashed = F.xxhash64("cid")
    c = (cand.join(plan, "part").withColumn("c", F.pmod(hashed, "cb").cast("int"))
         .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("qb") - 1))).where("qb > 0"))
    q = (query.join(plan, "part").withColumn("q", F.pmod(hashed, "qb").cast("int"))
         .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("cb") - 1))).where("cb > 0"))
    keys, cols = ("part", "c", "q"), ("part", "c", "q", "cid", "vec")
    found = c.select(*cols).groupBy(*keys).cogroup(q.select(*cols).groupBy(*keys)).applyInArrow(
        best_in_block(k + 1), "query long, best array<struct<s: double, cid: long>>")

    top = merged(found, k + 1).select("query", F.explode("best").alias("b")).select("query", "b.s", "b.cid")
    each = top.join(classes.select("cid", "ids"), "cid").select("query", "s", F.explode("ids").alias("vec_id"))
    lists = (each.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("s", "vec_id")))
                                       .alias("all")))  # at most (k + 1)**2 entries
    others = F.slice(F.filter("all", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asked.join(lists, asked.cid == lists.query).select("query_id", F.posexplode(others).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                    (-F.col("x.s")).alias("score")))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row of ``embeddings`` whose vec_id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)

"""Operator 3: near-duplicates by bottom-k sketches from one hash function.

1. One pass hashes each text's word shingles (64 bits) and keeps the set's size, a 128-bit
   digest of the set and its ``k`` smallest hashes.  Equal sets form one class, represented by
   its smallest doc_id; only classes go further, so groups of copies cost one row each.
2. Inverted lists of the retained values give candidates.  Linked classes share at least ``c``
   retained values (``c`` leaves a chance below 1e-9 of missing a link at the threshold; sets
   that fit in the sketch are exact), so a class with ``s`` values enters the lists of its
   ``s - c + 1`` rarest values only: a value common to many otherwise different documents is not
   followed.  Short lists give all their pairs.  A long list gives each member's pair with the
   list's smallest member, which after verification leaves most members in one component.
   Lists that still have several components are finished exactly on full sets: among their
   members, those outside their list's commonest component look for partners of other components
   by their rarest shingles (prefix and positional filter): shingles that no other member has
   come first, so a member with too many of them is paired with nobody, and a large group that
   is already one component pairs nothing.
3. Union-sketch estimates drop hopeless pairs, and the Jaccard similarity of the full sets
   decides, as ``den * intersection >= num * union``.
4. Components of the links (``components``) give every document its component.

Defined cases: a text with fewer words than a shingle has one shingle, its whole sequence; a null
text, or one without words, has none and is linked with nothing; rows without ``doc_id`` are linked
with nothing and stay (component null); rows of one ``doc_id`` are one document; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import column, stored, table, texts
from tidelake.llm.components import components
from tidelake.llm.words import mix, shingle_sets

SHINGLE, SKETCH, SHORT_LIST, BITS = 5, 32, 8, 1 << 24
HOT_ROWS, HOT_VALUES = 1000, 50_000  # a value with more rows is joined without shuffling them; at most so many values
MISSED = 1e-9


def least_shared(k: int, num: int, den: int) -> int:
    """Retained values that a linked pair shares but for a chance of ``MISSED``."""
    p, below, c = num / den, 0.0, 0
    while c < k and (below := below + comb(k, c) * p**c * (1 - p) ** (k - c)) <= MISSED:
        c += 1
    return max(1, c)


def sketch_rows(docs: DataFrame, shingle: int, k: int) -> DataFrame:
    salt = np.uint64(0x632BE59BD9B4E019)

    def run(batches):
        for batch in batches:
            n, d1, d2, sk = [], [], [], []
            for s in shingle_sets(texts(batch, "text"), shingle):
                n.append(len(s))
                d1.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
                d2.append(int(mix(s ^ salt).sum(dtype=np.uint64).view(np.int64)))
                sk.append(np.sort(s.view(np.int64))[:k])
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(sk, pa.list_(pa.int64()))], names=["doc_id", "n", "d1", "d2", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, d1 long, d2 long, sketch array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, items): full shingle sets of the documents whose id is in ``wanted`` (node), found
    without moving texts: a bit table of fixed size (``BITS``) with the wanted ids' hashes goes to the
    tasks, and a document whose bit is unset is skipped.  Some others come along unasked; they
    match nothing later."""
    place = F.pmod(F.xxhash64(F.col("node")), F.lit(BITS))
    words = (wanted.withColumn("place", place)
             .selectExpr("cast(place div 32 as int) as w", "shiftleft(1, cast(place % 32 as int)) as x").groupBy("w").agg(F.bit_or("x").alias("x")).toArrow())  # at most BITS / 32 rows
    table_ = np.zeros(BITS // 32, np.uint32)
    table_[words["w"].to_numpy()] = words["x"].to_numpy().view(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(table_)

    def run(batches):
        for batch in batches:
            at = column(batch, "place").to_numpy()
            asked = (shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1)
            batch = batch.filter(pa.array(asked.astype(bool)))
            sets = [s.view(np.int64) for s in shingle_sets(texts(batch, "text"), shingle)]
            yield pa.RecordBatch.from_arrays([column(batch, "node"), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["node", "items"])

    named = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string")).where("node is not null")
    return named.withColumn("place", place.cast("long")).mapInArrow(run, "node long, items array<long>")


def sizes_agree(a: str, b: str, num: int, den: int) -> Column:
    return F.least(F.col(a), F.col(b)) * den >= F.greatest(F.col(a), F.col(b)) * num


class Linker:
    """Verifies candidate pairs of classes and collects links."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, shingle: int, k: int, num: int, den: int):
        self.docs, self.nodes, self.shingle = docs, nodes, shingle
        self.k, self.num, self.den, self.c = k, num, den, least_shared(k, num, den)

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """(node, items): full shingle sets of ``nodes`` (node), one row each."""
        return stored(full_sets(self.docs, nodes, self.shingle).dropDuplicates(["node"]), "sets")

    def near(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that the union-sketch estimate does not rule out."""
        sk = self.nodes.select("node", "sketch")
        near = (pairs.join(sk.toDF("a", "sa"), "a").join(sk.toDF("b", "sb"), "b")
                .withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, self.k))
                .withColumn("m", F.size(F.array_intersect(F.array_intersect("u", "sa"), "sb")))
                .where(F.when(F.size("u") < self.k, F.col("m") * self.den >= F.size("u") * self.num)
                       .otherwise(F.col("m") >= self.c)))
        return stored(near.select("a", "b"), "near-pairs")

    def verified(self, pairs: DataFrame, full: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) whose full sets reach the threshold."""
        both = (pairs.join(full.toDF("a", "ia"), "a").join(full.toDF("b", "ib"), "b")
                .withColumn("i", F.size(F.array_intersect("ia", "ib")))
                .where(F.col("i") * self.den >= (F.size("ia") + F.size("ib") - F.col("i")) * self.num))
        return stored(both.select("a", "b"), "links")


def join_values(rows: DataFrame, values: DataFrame, count: str, total: int) -> DataFrame:
    """``rows`` joined by ``v`` with ``values``, which have one row per ``v`` and in ``count`` its number of
    rows among the ``total``.  Frequent values, ``HOT_VALUES`` at most by the threshold, go to all tasks, so
    their rows stay where they are; the others' rows are shuffled."""
    hot = max(HOT_ROWS, -(-total // HOT_VALUES))
    often = F.broadcast(values.where(F.col(count) >= hot))
    rest = rows.join(F.broadcast(values.where(F.col(count) >= hot).select("v")), "v", "left_anti")
    return rows.join(often, "v").unionByName(rest.join(values.where(F.col(count) < hot), "v"))


def inverted_lists(nodes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(v, node, n): each class under its rarest retained values, as many as a link needs."""
    c = least_shared(k, num, den)
    posts = nodes.select("node", "n", F.size("sketch").alias("s"), F.explode("sketch").alias("v"))
    shared = stored(posts.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "value-counts")
    total = shared.agg(F.sum("df")).first()[0] or 0
    held = (join_values(posts, shared, "df", total).groupBy("node", "n", "s")
            .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs")))  # at most k values
    need = F.ceil(F.col("n") * num / den)
    prefix = F.when(F.col("n") * den <= k * num, F.col("n") - need + 1).otherwise(F.col("s") - c + 1)
    room = F.greatest(F.lit(0), prefix - (F.col("s") - F.size("vs"))).cast("int")
    return held.select("node", "n", F.explode(F.slice("vs", F.lit(1), room)).alias("x")).select("x.v", "node", "n")


def ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def link_classes(docs: DataFrame, nodes: DataFrame, shingle: int, k: int, num: int, den: int) -> DataFrame:
    """(node, comp) of every class that has a link."""
    linker = Linker(docs, nodes, shingle, k, num, den)
    index = stored(inverted_lists(nodes, k, num, den), "index")
    lists = index.groupBy("v").agg(F.count("*").alias("m"), F.min("node").alias("hub"), F.min_by("n", "node").alias("hub_n"))
    lists = stored(lists.where("m > 1"), "lists")
    total = index.count()
    listed = stored(join_values(index, lists, "m", total), "lists-of-classes")
    short, long = listed.where(F.col("m") <= SHORT_LIST).select("v", "node", "n"), listed.where(F.col("m") > SHORT_LIST)
    pairs = (short.join(short.toDF("v", "node2", "n2"), "v").where(F.col("node") < F.col("node2"))
             .where(sizes_agree("n", "n2", num, den)).select(*ordered("node", "node2")))
    stars = (long.where(F.col("node") != F.col("hub")).where(sizes_agree("n", "hub_n", num, den))
             .select(*ordered("node", "hub")))
    near = linker.near(pairs.union(stars).distinct())
    wanted = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    links = linker.verified(near, linker.sets_of(wanted))
    comps = components(links)

    member = long.select("v", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    member = stored(member, "members")
    per = member.groupBy("v", "comp").agg(F.count("*").alias("k"))
    per = per.groupBy("v").agg(F.max(F.struct("k", "comp")).getField("comp").alias("main"), F.count("*").alias("comps"),
                               F.sum("k").alias("m"))
    several = join_values(member, stored(per.where("comps > 1"), "open-lists"), "m", total)
    left = stored(several.groupBy("node", "comp").agg(F.max(F.col("comp") != F.col("main")).alias("outer")), "open-classes")
    if not left.limit(1).count():
        return comps
    full = linker.sets_of(left.select("node"))
    more = stored(across_components(full.join(left, "node"), num, den), "near-pairs")
    found = linker.verified(more, full)
    return components(links.union(found)) if found.limit(1).count() else comps


def across_components(classes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs of an ``outer`` one of ``classes`` (node, items, comp, outer) and a class of
    another component that may reach the threshold, by prefix and positional filter over the outer
    one's shingles in order of rarity."""
    rows = classes.select("node", "comp", "outer", F.size("items").alias("n"), F.explode("items").alias("g"))
    rarity = rows.groupBy("g").agg(F.count("*").alias("df"))
    rank = Window.partitionBy("node").orderBy("df", "g")  # a class's own shingles
    outer = rows.where("outer").drop("outer").join(rarity, "g").withColumn("p", F.row_number().over(rank))
    outer = outer.where((F.col("p") <= F.col("n") - F.ceil(F.col("n") * num / den) + 1) & (F.col("df") > 1)).drop("df")
    other = rows.drop("outer").toDF("node2", "comp2", "n2", "g")
    reach = 1 + F.col("n") - F.col("p")  # largest possible intersection, if this is the first shared shingle
    fits = ((F.col("comp") != F.col("comp2")) & sizes_agree("n", "n2", num, den)
            & (reach * (num + den) >= (F.col("n") + F.col("n2")) * num))
    return outer.join(other, "g").where(fits).select(*ordered("node", "node2")).distinct()


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100, shingle: int = SHINGLE, k: int = SKETCH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    rows = stored(sketch_rows(docs, shingle, k), "sketches")
    nodes = stored(rows.where("n > 0 and doc_id is not null").groupBy("n", "d1", "d2")
                   .agg(F.min("doc_id").alias("node"), F.first("sketch").alias("sketch")), "classes")
    comps = link_classes(docs.select(F.col("doc_id").cast("long"), "text"), nodes, shingle, k, num, den)
    named = nodes.select("n", "d1", "d2", "node").join(comps, "node", "left").select(
        "n", "d1", "d2", F.coalesce("comp", "node").alias("comp"))
    out = rows.drop("sketch").join(named, ["n", "d1", "d2"], "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("comp")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.col("doc_id").eqNullSafe(own).alias("kept"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` at similarity 0.85 of five-word shingle sets."""
    return near_duplicates(table(spark, sf_dir, "documents"))

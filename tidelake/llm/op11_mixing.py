"""Operator 11: mixing sources to target weights by systematic sampling, in DataFrame functions only.

A source's target is its share by weight of the words the mix takes; it stops at ``most`` times the
source's size, and what is over is shared again by weight among the others.  A document's expected
copies are target / size of its source.  Within a source documents are put in order of size, the
expected copies are summed up along that order, one random offset is added, and a document is emitted
once for each whole number that its stretch of the sum crosses.  So a document comes at most
ceil(``most``) times, the number of copies of any run of documents is right to within one, and, as
neighbours in the order are alike in size, so is a source's number of words to about its longest
document.  The offset follows from ``seed`` and the source, so reruns agree.

The order is made by ranges (see ``ranks``), without the texts: a source with a third of all rows is
in many tasks.  The levels come from the sorted ratios of limit to weight, in one pass.

Defined cases: a null text has size 0; a source without words has target 0 and is not taken; rows
without ``doc_id`` and repeated rows are documents of their own (equal ones are interchangeable);
equal sizes go by ``doc_id`` (null first), then by a hash of the text; the null source is a source, the last; an
empty table gives an empty result; extra columns are ignored by ``expected`` and kept by ``mix``,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import stored, table
from tidelake.llm.ranks import ordered, ranked, running

WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2.0, 11
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) that belongs to the source and the seed."""
    key = F.concat(F.lit(str(seed)), F.coalesce(F.concat(F.lit(":"), source), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))


def levels(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: weights go round the sources in order."""
    in_order = ranked(ordered(sizes, [F.asc_nulls_last("source")], "mix-sources"))
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    rows = in_order.withColumn("weight", F.element_at(wheel, ((F.col("_rank") - 1) % len(weights) + 1).cast("int")))
    rows = rows.select("source", "source_size", "weight", (F.col("source_size") * F.lit(most)).alias("limit"))
    rows = running(ordered(rows, [F.col("limit") / F.col("weight"), F.asc_nulls_last("source")], "mix-limits"),
                   ["limit", "weight"])
    rows = stored(rows, "mix-stops")
    whole = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    words, weights_sum = whole[0] * share, whole[1]  # two numbers
    free, left = F.lit(words) - F.col("before_limit"), F.lit(weights_sum) - F.col("before_weight")
    stops = F.col("weight") * free > F.col("limit") * left
    rest = rows.agg(F.sum(F.when(stops, F.col("limit"))), F.sum(F.when(~stops, F.col("weight")))).first()
    shared = F.col("weight") * F.lit(words - (rest[0] or 0.0)) / F.lit(rest[1] or 1.0)
    return rows.select("source", "source_size", F.when(stops, F.col("limit")).otherwise(shared).alias("target"))


def expected(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED,
             carry: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` (doc_id, source, size and the columns ``carry``) with source_size, target and
    ``copies``: how often the mix holds each."""
    rows = rows.select("doc_id", "source", "size", *carry)
    keys = [F.asc_nulls_last("source"), "size", "doc_id", F.xxhash64(*rows.columns)]
    placed = ordered(rows, keys, "mix-order")
    sizes = stored(placed.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    goals = stored(levels(sizes, weights, share, most), "mix-targets").withColumnRenamed("source", "_source")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = offset(F.col("source"), seed)
    up, down = (F.floor((F.col("_rank") - back).cast("double") * F.col("_each") + F.col("_start")) for back in (0, 1))
    out = ranked(placed, "source").join(goals, F.col("source").eqNullSafe(F.col("_source")))
    out = out.withColumn("_each", each).withColumn("_start", start)
    return out.select("doc_id", "source", "size", *carry, "source_size", "target", (up - down).alias("copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the rows of ``docs`` (doc_id, text, source and others), each as often as it is taken."""
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.struct(*docs.columns).alias("_row"))
    out = expected(rows, carry=("_row",), **how).where("copies > 0")
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each of ``documents`` the mix takes."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), n_words(F.col("text")).alias("size"))
    rows = stored(rows, "mix-rows")  # sampling for the ranges and dealing out would both count words
    return expected(rows).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                                 "source", "copies")


def oracle(weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> str:
    """The same result as DuckDB SQL."""
    wheel = ", ".join(f"{float(w)}::double" for w in weights)
    return rf"""with docs as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size from documents),
    sizes as (select source, sum(size)::bigint as source_size from docs group by source),
    weighed as (select *, ([{wheel}])[(row_number() over (order by source nulls last) - 1) % {len(weights)} + 1] as weight,
                       source_size * {most}::double as cap from sizes),
    sums as (select *, coalesce(sum(cap) over w, 0) as before_cap, coalesce(sum(weight) over w, 0) as before_weight,
                    sum(source_size) over () * {share}::double as words, sum(weight) over () as weights
             from weighed window w as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
    marked as (select *, weight * (words - before_cap) > cap * (weights - before_weight) as stops from sums),
    goals as (select source, source_size, case when stops then cap else weight * rest / rest_weight end as target from marked,
              (select max(words) - coalesce(sum(cap) filter (stops), 0) as rest, sum(weight) filter (not stops) as rest_weight from marked)),
    placed as (select doc_id, source, size, row_number() over (partition by source order by size, doc_id nulls first) as rank,
                      ('0x' || substr(md5('{seed}' || coalesce(':' || source, '')), 1, 8))::bigint / 4294967296.0::double as start from docs),
    each as (select p.*, source_size, target, case when source_size > 0 then target / source_size else 0 end as each
             from placed p join goals g on p.source is not distinct from g.source),
    out as (select *, (floor(rank * each + start) - floor((rank - 1) * each + start))::bigint as copies from each)
    select doc_id, size, source_size, target, copies * size as taken, source, copies from out"""

"""Order, ranks and running sums over tables of any size, in DataFrame functions only.

``ordered`` deals rows out by ranges of the sort keys, so a group that holds a third of all rows lies
in many tasks, and numbers them along the order.  Ranks and sums then need only each range's totals:
at most one row for each range and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import stored

PLACE, PART = "_place", "_part"
BITS = 33  # rows of one range are numbered in as many bits
BEFORE = (Window.unboundedPreceding, -1)


def ordered(rows: DataFrame, keys: list, name: str) -> DataFrame:
    """``rows``, stored, with ``_place`` (grows along ``keys``) and ``_part`` (the range a row is in).
    Rows equal in all keys are split too and numbered in any order: give keys that tell apart what
    must not be interchanged."""
    spread = [*keys, F.monotonically_increasing_id()]
    placed = (rows.repartitionByRange(*spread).sortWithinPartitions(*keys)
              .withColumn(PLACE, F.monotonically_increasing_id()))
    return stored(placed.withColumn(PART, F.shiftright(PLACE, BITS)), name)


def _joined(rows: DataFrame, totals: DataFrame, group: str | None) -> DataFrame:
    on = F.col("r." + PART) == F.col("t._tpart")
    if group:
        on = on & F.col("r." + group).eqNullSafe(F.col("t._tgroup"))
    return rows.alias("r").join(totals.alias("t"), on).drop("_tpart", "_tgroup")


def _totals(placed: DataFrame, group: str | None, **sums: Column) -> DataFrame:
    keys = [F.col(PART).alias("_tpart"), *([F.col(group).alias("_tgroup")] if group else [])]
    return placed.groupBy(*keys).agg(*[c.alias(k) for k, c in sums.items()])


def _before(group: str | None):
    return Window.partitionBy(*(["_tgroup"] if group else [])).orderBy("_tpart").rowsBetween(*BEFORE)


def ranked(placed: DataFrame, group: str | None = None, name: str = "_rank") -> DataFrame:
    """``placed`` (sorted by ``group`` first) with its rank in the group, from 1."""
    totals = _totals(placed, group, _n=F.count("*"), _first=F.min(PLACE))
    totals = totals.withColumn("_ahead", F.coalesce(F.sum("_n").over(_before(group)), F.lit(0)))
    out = _joined(placed, totals, group).withColumn(name, F.col(PLACE) - F.col("_first") + F.col("_ahead") + 1)
    return out.drop("_n", "_first", "_ahead")


def running(placed: DataFrame, values: list[str]) -> DataFrame:
    """``placed`` with ``before_<value>``: the sum of each value over all earlier rows."""
    totals = _totals(placed, None, **{f"_s{i}": F.sum(v) for i, v in enumerate(values)})
    for i in range(len(values)):
        totals = totals.withColumn(f"_a{i}", F.coalesce(F.sum(f"_s{i}").over(_before(None)), F.lit(0)))
    inside = Window.partitionBy(PART).orderBy(PLACE).rowsBetween(*BEFORE)
    out = _joined(placed, totals, None)
    for i, v in enumerate(values):
        out = out.withColumn(f"before_{v}", F.col(f"_a{i}") + F.coalesce(F.sum(v).over(inside), F.lit(0)))
    return out.drop(*[f"_{k}{i}" for i in range(len(values)) for k in "sa"])

"""Prefix routing of files (or archive members) to tables.

Control rows ``(line_no, pattern, table_name, ...)`` are matched against names with
``name startsWith pattern``.  The match is an exact equi-join, not a nested loop: every name
is cut to each distinct pattern length (a handful) and joined on
``(prefix, length) == (pattern, length(pattern))``, so the work is names × distinct lengths
instead of names × control rows, and no pair is produced that does not match.  Spark picks
the join from its own size estimates: a small control table is broadcast, a large one and the
names are shuffled on the prefix (AQE splits a hot prefix).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _matches(files: DataFrame, control: DataFrame, name_col: str, pattern_col: str) -> DataFrame:
    # distinct pattern lengths: bounded by the longest pattern, collected to build the cut
    lengths = sorted(r[0] for r in control.select(F.length(pattern_col).alias("n"))
                     .where(F.col("n").isNotNull()).distinct().collect())
    if not lengths:  # no usable pattern: nothing matches (empty result, same columns)
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in control.schema.fields]
        return files.where(F.lit(False)).select("*", *nulls)
    cut = (files.withColumn("_plen", F.explode(F.array(*[F.lit(n) for n in lengths])))
           .withColumn("_prefix", F.expr(f"substring({name_col}, 1, _plen)")))
    ctrl = control.withColumn("_plen_c", F.length(pattern_col))
    joined = cut.join(ctrl, (F.col("_prefix") == F.col(pattern_col)) &
                      (F.col("_plen") == F.col("_plen_c")))
    return joined.drop("_plen", "_prefix", "_plen_c")


def route_all_matches(files: DataFrame, control: DataFrame, name_col: str = "file_name",
                      pattern_col: str = "pattern") -> DataFrame:
    """Every matching control row routes the file (a file matching two rows lands twice)."""
    return _matches(files, control, name_col, pattern_col)


def route_first_match(files: DataFrame, control: DataFrame, key_cols=("file_name",),
                      name_col: str = "file_name", pattern_col: str = "pattern",
                      order_col: str = "line_no") -> DataFrame:
    """Only the first matching control row (lowest ``order_col``) routes the file.

    The reduction keeps just the winning ``order_col`` per file key (a fixed-width buffer,
    so Spark uses a hash aggregate with map-side partial aggregation); the control row's
    other columns are then looked up by that number.  A file has at most one match per
    control line, so no group can be hot.  ``order_col`` must identify a control row.
    """
    key_cols = list(key_cols)
    file_cols = [c for c in files.columns if c not in key_cols]
    m = _matches(files, control, name_col, pattern_col)
    first = m.groupBy(*key_cols).agg(F.min(order_col).alias(order_col))
    if file_cols:
        first = first.join(files, key_cols)
    return first.join(control, order_col).select(*key_cols, order_col, *file_cols,
                                              *[c for c in control.columns if c != order_col])

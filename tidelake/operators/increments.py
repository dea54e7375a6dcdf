"""Increment predicates for relational imports.

Contract (the comparison itself was left to the import tool by the source system):

* ``append``: rows with ``last < check_col <= hi`` where ``hi`` is the column maximum taken
  once at run start, so rows inserted while the import runs wait for the next run;
* ``lastmodified``: rows with ``last <= check_col < run_start``; changed rows are appended,
  never merged.

Both are plain ``where`` clauses, so a JDBC or file source receives them as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _typed(df: DataFrame, column: str, value) -> Column:
    if isinstance(value, Column):
        return value
    dtype = df.schema[column].dataType.simpleString()
    return F.lit(str(value)).cast(dtype)


def increment_bounds(df: DataFrame, check_col: str, last) -> dict:
    """``{"hi": max above last}`` (None when nothing is new): one MAX over the pushed range,
    an index-only query on a database with an index on the check column."""
    row = df.where(F.col(check_col) > _typed(df, check_col, last)).agg(F.max(check_col).alias("hi")).first()
    return {"hi": row["hi"]}


def append_increment(df: DataFrame, check_col: str, last, hi=None) -> DataFrame:
    c = F.col(check_col)
    out = df.where(c > _typed(df, check_col, last))
    if hi is not None:
        out = out.where(c <= _typed(df, check_col, hi))
    return out


def lastmodified_increment(df: DataFrame, check_col: str, last, run_start) -> DataFrame:
    c = F.col(check_col)
    return df.where((c >= _typed(df, check_col, last)) & (c < _typed(df, check_col, run_start)))


def read_increment(df: DataFrame, check_col: str, last, mode: str = "append", run_start=None,
                   hi=None) -> DataFrame:
    """Increment of ``df`` by mode: ``append`` -> ``(last, hi]`` (``hi`` = maximum at run
    start, taken here when not given); ``lastmodified`` -> ``[last, run_start)``."""
    if mode == "append":
        if hi is None:
            hi = increment_bounds(df, check_col, last)["hi"]
        if hi is None:
            return df.where(F.lit(False))
        return append_increment(df, check_col, last, hi)
    if mode == "lastmodified":
        if run_start is None:
            raise ValueError("lastmodified needs run_start")
        return lastmodified_increment(df, check_col, last, run_start)
    raise ValueError(f"mode must be 'append' or 'lastmodified', got {mode!r}")

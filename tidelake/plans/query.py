"""Querying lake tables: projection, equality filter, optional preview limit, row display."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.text import pipe_line


def query_table(spark: SparkSession, table, columns=None, where: dict | str | None = None,
                limit: int | None = None, order_by=None) -> DataFrame:
    """``SELECT columns FROM table WHERE ... [ORDER BY ...] [LIMIT n]``; ``table`` is a catalog name or a
    DataFrame.  Filters and the projection reach the scan (pushed filters, pruned schema,
    partition pruning on ``date_part``)."""
    df = spark.table(table) if isinstance(table, str) else table
    if isinstance(where, dict):
        for c, v in where.items():
            df = df.where(F.col(c) == F.lit(v))
    elif where:
        df = df.where(where)
    if columns:
        df = df.select(*([columns] if isinstance(columns, str) else columns))
    if order_by:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    if limit is not None:
        df = df.limit(int(limit))
    return df


def display_lines(df: DataFrame, columns=None, sep: str = "|") -> DataFrame:
    """One text line per row: the chosen columns joined by ``|`` (NULL shown as ``null``)."""
    cols = columns or df.columns
    return df.select(pipe_line(*cols, sep=sep).alias("line"))

"""What was loaded exactly at the watermark.

A watermark is a value; rows or files that arrive later with exactly this value are neither newer nor
loaded.  So each load also keeps the keys of what it took at its new value, in ``<state>_edges``, and the
next one reads back with ``>=`` and leaves these keys out.  The keys are written before the data, by a Spark
job, and the load takes of the boundary only what they name: whatever appears in between is in neither and
waits for the next run.  They count only once the load is committed, and only for the value they belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "_edge_key"
EDGES = "source string, load_id string, value string, key string"


def edges_path(state_path: str) -> str:
    return state_path.rstrip("/") + "_edges"


def row_key(df: DataFrame) -> Column:
    """A row's identity: a digest of all its values.  Equal rows are one row."""
    return F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)


def write_edges(keys: DataFrame, state_path: str, source: str, load_id: str, value: str) -> DataFrame:
    """Keep the column ``key`` of ``keys`` as what the load takes at ``value``; returns it as written, as column KEY."""
    spark = keys.sparkSession
    path = f"{edges_path(state_path)}/of={load_id}"
    rows = keys.select(F.lit(source).alias("source"), F.lit(load_id).alias("load_id"), F.lit(value).alias("value"), "key")
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(EDGES).parquet(path).select(F.col("key").alias(KEY))


def known_keys(spark: SparkSession, state_path: str, source: str, value: str, state: DataFrame | None) -> DataFrame | None:
    """Keys that committed loads of ``source`` took at ``value``, or None where none were kept (column KEY)."""
    from tidelake.session import path_exists

    if state is None or not path_exists(spark, edges_path(state_path)):
        return None
    done = state.where(F.col("load_id").isNotNull() & (F.col("source") == source)).select(F.col("load_id").alias("_id"))
    rows = spark.read.schema(EDGES).parquet(edges_path(state_path)).where((F.col("source") == source) & (F.col("value") == value))
    return rows.join(done, F.col("load_id") == F.col("_id"), "left_semi").select(F.col("key").alias(KEY))


def compact_edges(spark: SparkSession, state_path: str, state: DataFrame, current: DataFrame) -> None:
    """Keep only the keys of committed loads at the sources' present watermarks; ``current`` is
    ``(source, value, load_id)``, with the load that will stand for the source in the state."""
    from tidelake.session import path_exists, sibling_staging, swap_into_place

    path = edges_path(state_path)
    if not path_exists(spark, path):
        return
    done = state.where(F.col("load_id").isNotNull()).select(F.col("load_id").alias("_id")).distinct()
    now = current.select(F.col("source").alias("_s"), F.col("value").alias("_v"), F.col("load_id").alias("_now"))
    rows = spark.read.schema(EDGES).parquet(path).join(done, F.col("load_id") == F.col("_id"), "left_semi")
    rows = rows.join(now, (F.col("source") == F.col("_s")) & (F.col("value") == F.col("_v")))
    staging = sibling_staging(path)
    rows.select("source", F.col("_now").alias("load_id"), "value", "key").distinct().write.parquet(f"{staging}/of=compacted")
    swap_into_place(spark, staging, path)

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.session import scratch_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``, with its scheme (nothing is created)."""
    path = f"{scratch_root(spark)}/tidelake-llm/{name}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: cuts the lineage,
    survives lost executors, and keeps later steps from repeating the work."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_bucket(doc_id: str, mod: int) -> Column:
    """``crc32(doc_id as text) mod mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod


def texts(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column of an Arrow batch as plain strings, nulls as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))

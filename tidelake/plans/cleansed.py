"""Layer promotion: tmp -> raw (repair) and raw -> cleansed (dated Avro)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidelake.operators.repair import repair_escaped_lines
from tidelake.sinks.raw import write_lines
from tidelake.sinks.tables import AVRO, write_cleansed
from tidelake.sources.raw import read_raw


def raw_to_cleansed(spark: SparkSession, raw_path, cleansed_path: str, run_date=None,
                    schema=None, null_marker="\\N", fmt: str = AVRO, mode: str = "append",
                    raw_partitions=None):
    """Read a raw table (root or one partition), stamp ``date_part = run_date`` (replacing a
    discovered ``date_part``) and append it to the cleansed table, partitioned by date.

    ``raw_partitions`` (dates) limits a table-root read to those ``date_part`` folders; the
    filter prunes folders in the scan, so yesterday's history is not read again."""
    df = read_raw(spark, raw_path, schema=schema, null_marker=null_marker)
    if raw_partitions and "date_part" in df.columns:
        days = [F.lit(str(d)).cast("date") for d in raw_partitions]
        df = df.where(F.col("date_part").isin(*days))
    write_cleansed(df, cleansed_path, run_date=run_date, fmt=fmt, mode=mode)
    return spark.read.format(fmt).load(cleansed_path)


def repair_raw(spark: SparkSession, tmp_path, raw_path: str, mode: str = "append"):
    """Join escaped line breaks and write one record per line into the raw folder."""
    fixed = repair_escaped_lines(spark, tmp_path)
    write_lines(fixed.select("value"), raw_path, mode=mode)
    return spark.read.text(raw_path)

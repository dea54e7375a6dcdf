"""Date-partitioned lake table writes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidelake.functions.time import run_date_col

# Fixed value: the Avro data source name available without extra packages.
AVRO = "com.databricks.spark.avro"
PARTITION = "date_part"


def stamp_date(df: DataFrame, run_date=None, column: str = PARTITION) -> DataFrame:
    """Add (or replace) the load-date partition column as DATE."""
    return df.withColumn(column, run_date_col(run_date))


def write_cleansed(df: DataFrame, path: str, run_date=None, fmt: str = AVRO,
                   mode: str = "append"):
    """Cleansed sink: stamp ``date_part`` and write partitioned by it.

    ``mode="append"`` adds to the table (a rerun on the same day duplicates, as the
    source system does); ``mode="replace_partition"`` overwrites only the partitions
    present in ``df`` (dynamic partition overwrite), which makes reruns idempotent.
    """
    out = stamp_date(df, run_date)
    w = out.write.format(fmt).partitionBy(PARTITION)
    if mode == "replace_partition":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    w.save(path)


def replace_snapshot(df: DataFrame, path: str, run_date=None, fmt: str = "parquet",
                     staged: bool = True, **options):
    """Snapshot replace: the whole target (every ``date_part``) becomes ``df`` under today.

    With ``staged`` (default) the snapshot is written in full next to the target and then
    renamed into place, so a failing source read never leaves the target empty or half
    written; the data is written once.
    """
    from tidelake.session import recover_target, sibling_staging, swap_into_place

    recover_target(df.sparkSession, path)
    out = stamp_date(df, run_date)
    dest = sibling_staging(path) if staged else path
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .format(fmt).options(**options).partitionBy(PARTITION).save(dest))
    if staged:
        swap_into_place(df.sparkSession, dest, path)


def write_catalog_table(df: DataFrame, name: str, path: str | None = None,
                        target: str = "hive", mode: str = "append", fmt: str = "parquet",
                        partition_by=None):
    """``hive`` -> register a catalog table (external when ``path`` is given);
    ``normal`` -> plain path write."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if target == "hive":
        if path is not None:
            w = w.option("path", path)
        w.saveAsTable(name)
    elif target == "normal":
        if path is None:
            raise ValueError("normal target needs a path")
        w.save(path)
    else:
        raise ValueError(f"target must be 'hive' or 'normal', got {target!r}")

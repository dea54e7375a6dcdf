"""Control tables: CSV with a header line, fixed positional columns, real CSV quoting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Column layout of the two control-file kinds.
FILE_CONTROL = "pattern string, table_name string, source_dir string, target_dir string"
TABLE_CONTROL = (
    "table_type string, db_name string, hive_normal string, rdbms_table_name string, "
    "schema_name string, hive_table_name string, target_dir string, where_clause string, "
    "split_by_col string, fetch_size int, num_mapper int, check_column string, last_value string"
)
TABLE_COLUMNS = [c.split()[0] for c in TABLE_CONTROL.split(", ")]
KINDS = {"files": FILE_CONTROL, "tables": TABLE_CONTROL}


def read_control(spark: SparkSession, path, kind: str = "tables") -> DataFrame:
    """Control rows with ``line_no`` = position after the header within each control file.

    Blank fields become NULL; surrounding spaces are trimmed.  ``line_no`` follows file
    order (split start, then position in the split), which first-match routing relies on.
    The ordinal is computed per control file, so different files never share a task.
    """
    ddl = KINDS[kind]
    df = (spark.read.schema(ddl)
          .options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=True,
                   ignoreTrailingWhiteSpace=True, mode="PERMISSIVE")
          .csv(path))
    names = df.columns
    ordered = df.select(
        *names,
        F.col("_metadata.file_path").alias("control_file"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    w = Window.partitionBy("control_file").orderBy("_blk", "_seq")
    out = ordered.withColumn("line_no", F.row_number().over(w)).drop("_blk", "_seq")
    cleaned = [F.nullif(F.col(c), F.lit("")).alias(c) if dict(df.dtypes)[c] == "string"
               else F.col(c) for c in names]
    return out.select("control_file", "line_no", *cleaned)


def first_row(control: DataFrame) -> DataFrame:
    """First data row of each control file (zip mode takes ``source_dir`` from it)."""
    return control.where(F.col("line_no") == 1)

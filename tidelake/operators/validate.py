"""Control-row validation and mode dispatch, as one projection over the control table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values accepted in relational control rows.
VENDORS = ("teradata", "oracle", "sqlserver")
TARGETS = ("hive", "normal")
INCREMENTAL_TYPES = ("append", "lastmodified")
SNAPSHOT_TYPES = ("snapshot", "full")


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def table_mode(table_type: Column) -> Column:
    """``append``/``lastmodified`` -> incremental; ``snapshot``/``full``/blank -> snapshot;
    anything else -> NULL (a typo must not trigger a snapshot that deletes the target)."""
    t = F.lower(F.trim(table_type))
    return (F.when(t.isin(*INCREMENTAL_TYPES), F.lit("incremental"))
            .when(_blank(table_type) | t.isin(*SNAPSHOT_TYPES), F.lit("snapshot")))


def validate_table_control(control: DataFrame) -> DataFrame:
    """Adds ``mode`` and ``error`` (comma list of bad fields, NULL when the row is valid).  Names and
    keywords are normalised here, once: trimmed, and vendor, target kind and table type in lower
    case, so that later steps compare them as they are."""
    names = [c for c in ("rdbms_table_name", "schema_name", "hive_table_name", "target_dir", "check_column",
                         "split_by_col") if c in control.columns]
    words = [c for c in ("db_name", "hive_normal", "table_type") if c in control.columns]
    control = control.withColumns({**{c: F.trim(c) for c in names}, **{c: F.lower(F.trim(c)) for c in words}})
    staged = control.withColumn("_mode", table_mode(F.col("table_type")))
    mode = F.col("_mode")
    checks = [
        F.when(mode.isNull(), F.lit("table_type")),
        F.when(~F.coalesce(F.lower(F.trim("db_name")).isin(*VENDORS), F.lit(False)), F.lit("db_name")),
        F.when(~F.coalesce(F.lower(F.trim("hive_normal")).isin(*TARGETS), F.lit(False)),
               F.lit("hive_normal")),
        F.when(_blank(F.col("rdbms_table_name")), F.lit("rdbms_table_name")),
        F.when((mode == "incremental") & _blank(F.col("check_column")), F.lit("check_column")),
    ]
    if "hive_table_name" in control.columns:  # a catalog target needs a name to register
        checks.append(F.when((F.col("hive_normal") == "hive") & _blank(F.col("hive_table_name")), F.lit("hive_table_name")))
    staged = staged.withColumn("error", F.nullif(F.concat_ws(",", *checks), F.lit("")))
    return (staged.withColumn("mode", F.when(F.col("error").isNull(), mode)).drop("_mode")
            .select(*control.columns, "mode", "error"))


def validate_file_control(control: DataFrame) -> DataFrame:
    checks = [
        F.when(_blank(F.col("pattern")), F.lit("pattern")),
        F.when(_blank(F.col("table_name")), F.lit("table_name")),
        F.when(_blank(F.col("source_dir")), F.lit("source_dir")),
        F.when(_blank(F.col("target_dir")), F.lit("target_dir")),
    ]
    return control.withColumn("error", F.nullif(F.concat_ws(",", *checks), F.lit("")))

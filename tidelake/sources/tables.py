"""Lake tables in the catalog: external tables over raw folders, queries and DDL lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidelake.functions.text import BEL, NULL_MARKER, literal_regex
from tidelake.session import local_frame
from tidelake.sinks.loads import LOAD

LINES = "__lines"  # the table of lines (or loads) behind a view


def _sql_str(s: str) -> str:
    out = []
    for ch in s:
        if ch in "\\'":
            out.append("\\" + ch)
        elif ord(ch) < 32:
            out.append(f"\\u{ord(ch):04x}")
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def quoted_part(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> str:
    return ".".join(quoted_part(p) for p in name.split("."))


def _raw_columns(ddl: str, sep: str, null_marker: str) -> str:
    """Select list that splits a raw line (column ``value``) as ``read_raw`` does: an empty field is the
    empty string, the marker NULL, a trailing empty field is kept, a value that does not fit its type NULL."""
    cols = []
    for i, f in enumerate(StructType.fromDDL(ddl).fields):
        text = f"get(split(value, {_sql_str(literal_regex(sep))}, -1), {i})"
        text = f"nullif({text}, {_sql_str(null_marker)})" if null_marker is not None else text
        kind = f.dataType.simpleString()
        cols.append(f"{text if kind == 'string' else f'try_cast({text} AS {kind})'} AS {quoted_part(f.name)}")
    return ", ".join(cols)


def _new_table(spark: SparkSession, name: str, replace: bool):
    for one in (name, f"{name}{LINES}"):
        if not spark.catalog.tableExists(one):
            continue
        kind = spark.catalog.getTable(one).tableType
        if not replace or kind == "MANAGED":
            raise ValueError(f"table {name} exists")
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {quoted(one)}")


def register_raw_table(spark: SparkSession, name: str, path: str, ddl: str,
                       partitioned: bool = True, sep: str = BEL, null_marker: str = NULL_MARKER,
                       replace: bool = False):
    """Catalog relation over a raw folder: an external text table of its lines, ``<name>__lines``
    (``date_part=`` sub-folders are a partition column), and a view ``name`` that splits the fields,
    with the values that :func:`tidelake.sources.raw.read_raw` gives; a filter on ``date_part``
    prunes folders.  A relation of this name that exists is only replaced when ``replace`` says so,
    and never when it is a managed table, whose data dropping it would delete."""
    _new_table(spark, name, replace)
    part = ", date_part DATE" if partitioned else ""
    spark.sql(f"CREATE TABLE {quoted(name + LINES)} (value STRING{part}) USING text "
              + ("PARTITIONED BY (date_part) " if partitioned else "") + f"LOCATION {_sql_str(path)}")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {quoted(name + LINES)}")
    spark.sql(f"CREATE VIEW {quoted(name)} AS SELECT {_raw_columns(ddl, sep, null_marker)}"
              + (", date_part" if partitioned else "") + f" FROM {quoted(name + LINES)}")


def sync_partitions(spark: SparkSession, name: str):
    """Bring a registered raw table up to date with the ``date_part`` folders that are there."""
    spark.sql(f"MSCK REPAIR TABLE {quoted(name + LINES)} SYNC PARTITIONS")
    spark.catalog.refreshTable(name + LINES)  # drop cached file listings of the table
    spark.catalog.refreshTable(name)


def _loads_view(spark: SparkSession, name: str, columns: str, only: str | None):
    where = f" WHERE {LOAD} = {_sql_str(only)}" if only else ""
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS SELECT {columns}, date_part FROM {quoted(name + LINES)}{where}")


def register_loads(spark: SparkSession, name: str, target: str, ddl: str, fmt: str, loads: list[tuple[str, str]],
                   only: str | None = None):
    """Catalog relation over a target made of loads: an external table partitioned by ``date_part`` and
    load, which has the partitions of committed loads only, and a view ``name`` over it.  For a
    snapshot the view shows the load ``only``: replacing the view is the switch."""
    _new_table(spark, name, False)
    if fmt == "raw":
        held, columns = "value STRING", _raw_columns(ddl, BEL, NULL_MARKER)
    else:
        held, columns = ddl, ", ".join(quoted_part(f.name) for f in StructType.fromDDL(ddl).fields)
    spark.sql(f"CREATE TABLE {quoted(name + LINES)} ({held}, date_part DATE, {LOAD} STRING) USING {'text' if fmt == 'raw' else fmt} "
              f"PARTITIONED BY (date_part, {LOAD}) LOCATION {_sql_str(target)}")
    for folder, load_id in loads:
        day = folder.rstrip("/").split("date_part=")[-1].split("/")[0]
        _add_partition(spark, name, day, load_id)
    _loads_view(spark, name, columns, only)


def _add_partition(spark: SparkSession, name: str, day, load_id: str):
    spark.sql(f"ALTER TABLE {quoted(name + LINES)} ADD IF NOT EXISTS PARTITION "
              f"(date_part = {_sql_str(str(day))}, {LOAD} = {_sql_str(load_id)})")


def add_load(spark: SparkSession, name: str, run_date, load_id: str, replaces: bool):
    """Show one more committed load, or, when it replaces the table, only it: the view switches to it
    in one step, and the partitions that it hides go afterwards."""
    _add_partition(spark, name, run_date, load_id)
    if not replaces:
        spark.catalog.refreshTable(name + LINES)
        return
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'View Text'").first()["data_type"]
    columns = text[len("SELECT "):text.rindex(", date_part FROM ")]
    _loads_view(spark, name, columns, load_id)
    for r in spark.sql(f"SHOW PARTITIONS {quoted(name + LINES)}").collect():  # one row a load
        day, _, other = r[0].partition(f"/{LOAD}=")
        if other != load_id:
            spark.sql(f"ALTER TABLE {quoted(name + LINES)} DROP IF EXISTS PARTITION "
                      f"(date_part = {_sql_str(day.split('=', 1)[1])}, {LOAD} = {_sql_str(other)})")


def table_ddl(spark: SparkSession, name: str) -> DataFrame:
    """``SHOW CREATE TABLE`` as a one-row DataFrame (column ``createtab_stmt``)."""
    return spark.sql(f"SHOW CREATE TABLE {quoted(name)}")


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """Column list of a table or view, in order: ``(position, col_name, data_type)``."""
    cols = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(spark.table(name).schema.fields, start=1)]
    return local_frame(spark, cols, "position int, col_name string, data_type string")

"""Relational sources over JDBC.

The import pushes everything it can to the database: the per-table ``where``, the increment
predicate (both become ``PushedFilters`` of the JDBC scan) and the column list (pruned
``ReadSchema``).  Parallel reads split on a column into ``num_partitions`` ranges: of equal width between
the column's least and greatest value, or, with ``even``, holding equally many rows.  Equal width puts
nearly all rows of a skewed key into one split; even boundaries are ranks in the database's own order,
so they work for text keys too.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Supported vendors, their URL layouts and driver classes.
VENDORS = {
    "teradata": ("jdbc:teradata://{server}/DATABASE={schema}", "com.teradata.jdbc.TeraDriver"),
    "oracle": ("jdbc:oracle:thin:@{server}:{port}/{sid}", "oracle.jdbc.OracleDriver"),
    "sqlserver": ("jdbc:sqlserver://{server}:{port};databaseName={schema}",
                  "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
}


def jdbc_options(vendor: str, server: str, table: str, schema: str | None = None,
                 port: int | str | None = None, sid: str | None = None,
                 user: str | None = None, password: str | None = None, **extra) -> dict:
    """Connection options for one source table.

    Oracle addresses the table as ``schema.table``; Teradata and SQL Server put the schema
    in the URL as the database.  Unknown vendors are rejected.
    """
    vendor = (vendor or "").strip().lower()
    if vendor not in VENDORS:
        raise ValueError(f"unsupported database {vendor!r}; expected one of {sorted(VENDORS)}")
    if not table:
        raise ValueError("relational table name is required")
    url_t, driver = VENDORS[vendor]
    opts = {
        "url": url_t.format(server=server, port=port, sid=sid, schema=schema),
        "dbtable": f"{schema}.{table}" if vendor == "oracle" and schema else table,
        "driver": driver,
    }
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    opts.update({k: str(v) for k, v in extra.items() if v is not None})
    return opts


def split_bounds(spark: SparkSession, options: dict, split_by: str, where: str | None = None):
    """``(lower, upper)`` of the split column, read with one aggregate query."""
    cond = f" WHERE {where}" if where else ""
    q = f"SELECT MIN({split_by}) AS lo, MAX({split_by}) AS hi FROM {options['dbtable']}{cond}"
    o = {k: v for k, v in options.items() if k != "dbtable"}
    row = spark.read.format("jdbc").options(**o).option("query", q).load().first()
    return row["lo"], row["hi"]


def split_query(table: str, split_by: str, n: int, where: str | None = None) -> str:
    """One statement of every supported vendor that gives the least value of each of ``n`` runs of
    equally many rows, in the database's order."""
    cond = f"({where}) AND {split_by} IS NOT NULL" if where else f"{split_by} IS NOT NULL"
    ranks = (f"SELECT {split_by} AS k, ROW_NUMBER() OVER (ORDER BY {split_by}) AS r, COUNT(*) OVER () AS c "
             f"FROM {table} WHERE {cond}")
    return f"SELECT MIN(k) AS lo, MIN(r) AS r FROM ({ranks}) q GROUP BY FLOOR((r - 1) * {int(n)} / c)"


def even_bounds(spark: SparkSession, options: dict, split_by: str, n: int, where: str | None = None) -> list:
    """Boundaries between ``n`` splits of equally many rows: fewer where one value has several splits' rows."""
    o = {k: v for k, v in options.items() if k != "dbtable"}
    rows = (spark.read.format("jdbc").options(**o).option("query", split_query(options["dbtable"], split_by, n, where))
            .load().collect())  # n rows
    return distinct_bounds([r["lo"] for r in sorted(rows, key=lambda r: r["r"])][1:])


def distinct_bounds(values: list) -> list:
    """Without repetitions, which would make empty splits."""
    return [v for i, v in enumerate(values) if v is not None and (i == 0 or v != values[i - 1])]


def sql_literal(value, url: str = "") -> str:
    """A boundary as the vendor writes it."""
    if isinstance(value, (dt.date, dt.datetime)):
        stamp = isinstance(value, dt.datetime)
        text = value.isoformat(sep=" ") if stamp else value.isoformat()
        kind = "" if url.startswith("jdbc:sqlserver:") else "TIMESTAMP " if stamp else "DATE "
        return f"{kind}'{text}'"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def split_predicates(split_by: str, bounds: list, url: str = "") -> list[str]:
    """Conditions that put every row, those without a value included, into exactly one split."""
    if not bounds:
        return ["1 = 1"]
    at = [sql_literal(b, url) for b in bounds]
    inner = [f"{split_by} >= {lo} AND {split_by} < {hi}" for lo, hi in zip(at, at[1:])]
    return [f"{split_by} < {at[0]} OR {split_by} IS NULL", *inner, f"{split_by} >= {at[-1]}"]


def sampled_bounds(df: DataFrame, split_by: str, n: int, sample_rows: int = 20_000) -> list:
    """Boundaries between ``n`` splits of about equally many rows of a DataFrame, from a sample of about
    ``sample_rows`` values (the bound on what the driver gets), in Spark's order."""
    keys = df.select(F.col(split_by).alias("k")).where("k is not null")
    total = keys.count()
    if total == 0:
        return []
    found = keys.sample(fraction=min(1.0, sample_rows / total), seed=17).sort("k").collect()
    held = [r["k"] for r in found]
    return distinct_bounds([held[len(held) * i // n] for i in range(1, n)]) if held else []


def split_number(split_by: str, bounds: list) -> Column:
    """Number of the split that a row falls into."""
    out = F.lit(0)
    for i, b in enumerate(bounds, start=1):
        out = F.when(F.col(split_by) >= F.lit(b), F.lit(i)).otherwise(out)
    return out


def read_jdbc(spark: SparkSession, options: dict, where: str | None = None,
              split_by: str | None = None, num_partitions: int | None = None,
              fetch_size: int | None = None, bounds=None, even: bool = False) -> DataFrame:
    """Snapshot scan of one table.  ``where`` is text of the database's own dialect and goes to it
    as it is, inside the relation that is read; later filters are pushed down by Spark.  ``even`` splits
    by equally many rows (any column the database can sort) instead of equal widths between
    ``bounds`` (numeric, date and timestamp columns; others are then read unsplit)."""
    relation = f"(SELECT * FROM {options['dbtable']} WHERE {where}) q" if where else options["dbtable"]
    extra = {"fetchsize": str(int(fetch_size))} if fetch_size else {}
    reader = spark.read.format("jdbc").options(**{**options, "dbtable": relation, "preferTimestampNTZ": "true", **extra})
    if split_by and num_partitions and int(num_partitions) > 1:
        if even and bounds is None:
            at = even_bounds(spark, options, split_by, int(num_partitions), where)
            rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
            return spark.read.jdbc(options["url"], relation, predicates=split_predicates(split_by, at, options["url"]),
                                   properties={**rest, "preferTimestampNTZ": "true", **extra})
        lo, hi = bounds if bounds is not None else split_bounds(spark, options, split_by, where)
        # Spark splits only numeric, date and timestamp columns; a text column is read unsplit
        if lo is not None and hi is not None and not isinstance(lo, str):
            reader = (reader.option("partitionColumn", split_by).option("lowerBound", str(lo))
                      .option("upperBound", str(hi)).option("numPartitions", str(int(num_partitions))))
    return reader.load()

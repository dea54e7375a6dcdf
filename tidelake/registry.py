"""Registered queries: each runs one library operator end to end over the given tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame; intermediate lake data is
written below the session's scratch root (``spark.checkpoint.dir``), a fresh folder per call,
and stays there so the returned DataFrame can be read lazily.  Tables are always used whole.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.text import BEL, before_first, split_exact
from tidelake.functions.time import compact_stamp
from tidelake.operators import filters, routing, state
from tidelake.operators.increments import append_increment, increment_bounds, lastmodified_increment
from tidelake.operators.repair import repair_escaped_lines
from tidelake.operators.validate import validate_table_control
from tidelake.plans.cleansed import raw_to_cleansed
from tidelake.plans.ingest import ingest_tables, open_source
from tidelake.plans.landing import land_files
from tidelake.plans.query import display_lines, query_table
from tidelake.session import local_frame, scratch_path
from tidelake.sinks.loads import read_loads
from tidelake.sinks.raw import write_lines, write_raw
from tidelake.sinks.tables import replace_snapshot, write_catalog_table
from tidelake.sources.control import TABLE_COLUMNS, read_control
from tidelake.sources.raw import parse_raw_lines, read_raw
from tidelake.sources.tables import register_raw_table, table_columns
from tidelake.streaming.landing import stream_land

# Fixed values of the registered queries (shared with their oracle SQL).
RUN_DATE = "2024-01-02"
PREV_DATE = "2024-01-01"
WATERMARK = dt.datetime(2024, 1, 15, 12, 1, 10)
ROUTES = [(1, "s", "s_tab"), (2, "sig", "sig_tab"), (3, "p", "p_tab")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ddl_of(df: DataFrame) -> str:
    """DDL string of a DataFrame's schema."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File manifest derived from ``events``: one file per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.col("event_type"), F.lit("_"), F.col("event_id").cast("string"), F.lit(".txt"))
        .alias("file_name"),
        (F.col("event_id") % 4).alias("length"),
        F.col("ts").alias("modified"),
        F.col("event_type"),
    )


def _raw_copy(spark, df: DataFrame, name: str, **kw) -> str:
    path = scratch_path(spark, name)
    write_raw(df, path, **kw)
    return path


# ---------------------------------------------------------------- raw text format

def raw_delimited_scan(spark, sf_dir):
    """customer through the raw sink and the typed raw reader."""
    cust = table(spark, sf_dir, "customer")
    return read_raw(spark, _raw_copy(spark, cust, "raw-customer"), schema=ddl_of(cust))


def raw_scan_untyped(spark, sf_dir):
    """Raw reader without a schema: string columns _c0.._cN."""
    return read_raw(spark, _raw_copy(spark, table(spark, sf_dir, "customer"), "raw-untyped"))


def raw_scan_ragged(spark, sf_dir):
    """Lines of different widths in one folder: no field of the wider ones is lost."""
    path = _raw_copy(spark, table(spark, sf_dir, "supplier"), "raw-ragged")
    write_raw(table(spark, sf_dir, "customer"), path)
    return read_raw(spark, path)


def _priority_nulls(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")))


def null_marker_roundtrip(spark, sf_dir):
    """NULLs written as \\N and read back as NULL."""
    df = _priority_nulls(spark, sf_dir)
    return read_raw(spark, _raw_copy(spark, df, "raw-nulls"), schema=ddl_of(df))


def null_marker_literal(spark, sf_dir):
    """null_marker=None keeps \\N as text, as a reader without the option does."""
    df = _priority_nulls(spark, sf_dir)
    return read_raw(spark, _raw_copy(spark, df, "raw-nulls"), schema=ddl_of(df), null_marker=None)


def field_split_exact(spark, sf_dir):
    """Empty vs NULL vs text and a trailing empty field survive the exact splitter."""
    cust = table(spark, sf_dir, "customer")
    v = (F.when(F.col("c_custkey") % 3 == 0, F.lit(""))
         .when(F.col("c_custkey") % 3 == 1, F.lit(None).cast("string"))
         .otherwise(F.col("c_name")))
    df = cust.select("*", v.alias("v"), F.lit("").alias("tail"))
    return read_raw(spark, _raw_copy(spark, df, "raw-split"), schema=ddl_of(df))


def multiline_repair(spark, sf_dir):
    """Escaped line breaks (documents written as raw lines) joined again, line-based."""
    return _doc_fields(repair_escaped_lines(spark, _escaped_documents(spark, sf_dir)))


# ---------------------------------------------------------------- layer promotion and sinks

def _orders_raw_partition(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "raw-orders")
    write_raw(orders, f"{root}/date_part={PREV_DATE}")
    return orders, root


def raw_to_cleansed_query(spark, sf_dir):
    """Raw partition -> typed -> date_part replaced -> Avro."""
    orders, root = _orders_raw_partition(spark, sf_dir)
    out = scratch_path(spark, "cleansed-orders")
    return raw_to_cleansed(spark, root, out, run_date=RUN_DATE, schema=ddl_of(orders))


def cleansed_append_twice(spark, sf_dir):
    """Two cleansed appends of the same load: UNION ALL semantics (K1, D8 default)."""
    orders, root = _orders_raw_partition(spark, sf_dir)
    out = scratch_path(spark, "cleansed-orders")
    raw_to_cleansed(spark, root, out, run_date=RUN_DATE, schema=ddl_of(orders))
    return raw_to_cleansed(spark, root, out, run_date=RUN_DATE, schema=ddl_of(orders))


def snapshot_replace(spark, sf_dir):
    """Two snapshots: only the latest date_part remains (K4)."""
    orders = table(spark, sf_dir, "orders")
    target = scratch_path(spark, "snapshot-orders")
    replace_snapshot(orders, target, run_date=PREV_DATE)
    replace_snapshot(orders, target, run_date=RUN_DATE)
    return spark.read.parquet(target)


def catalog_table_sink(spark, sf_dir):
    """hive target: external catalog table read back."""
    cust = table(spark, sf_dir, "customer")
    name = f"tidelake_customer_{uuid.uuid4().hex[:8]}"
    write_catalog_table(cust, name, path=scratch_path(spark, "catalog-customer"), target="hive")
    return spark.table(name)


# ---------------------------------------------------------------- relational increments

def append_increment_query(spark, sf_dir):
    """Rows above the last value up to the maximum at run start."""
    orders = table(spark, sf_dir, "orders")
    b = increment_bounds(orders, "o_orderkey", "10000")
    return append_increment(orders, "o_orderkey", "10000", b["hi"])


def lastmodified_increment_query(spark, sf_dir):
    """Rows changed in [last, run_start)."""
    orders = table(spark, sf_dir, "orders")
    return lastmodified_increment(orders, "o_orderdate", "1998-01-01 00:00:00", "1999-01-01 00:00:00")


def source_where_pushdown(spark, sf_dir):
    """Per-table where evaluated at the source (F2; PushedFilters)."""
    orders = table(spark, sf_dir, "orders")
    row = {"where_clause": "o_orderstatus = 'F' AND o_totalprice > 100000"}
    return open_source(lambda r: orders, row).select("o_orderkey", "o_custkey")


def _table_control(spark, rows) -> DataFrame:
    whole = ("fetch_size", "num_mapper")
    return local_frame(spark, rows, ", ".join(f"{c} {'int' if c in whole else 'string'}" for c in TABLE_COLUMNS))


def ingest_where(spark, sf_dir):
    """A control row's where clause decides what a snapshot import lands."""
    orders = table(spark, sf_dir, "orders")
    target = scratch_path(spark, "lake-orders")
    ctrl = _table_control(spark, [("snapshot", "oracle", "normal", "ORDERS", "TPCH", None, target,
                                   "o_orderstatus = 'F' AND o_totalprice > 100000", None, None, None, None, None)])
    st = scratch_path(spark, "state")
    ingest_tables(spark, ctrl, st, source=lambda row: orders, app="erp", run_date=RUN_DATE).collect()
    return read_loads(spark, target, st, schema=ddl_of(orders))


def _orders_ingest(spark, sf_dir, first_source):
    orders = table(spark, sf_dir, "orders")
    target = scratch_path(spark, "lake-orders")
    st = scratch_path(spark, "state")
    ctrl = _table_control(spark, [("append", "oracle", "normal", "ORDERS", "TPCH", None, target, None,
                                   None, None, None, "o_orderkey", None)])
    sources = [first_source(orders), orders]
    for run_date, src in zip((PREV_DATE, RUN_DATE), sources):
        ingest_tables(spark, ctrl, st, source=lambda row, s=src: s, app="erp", run_date=run_date).collect()
    return read_loads(spark, target, st, schema=ddl_of(orders))


def incremental_append(spark, sf_dir):
    """Control-driven append: first load, then the increment under a new date_part."""
    return _orders_ingest(spark, sf_dir, lambda o: o.where(F.col("o_orderkey") <= 10000))


def incremental_no_new_rows(spark, sf_dir):
    """Second append run with nothing new leaves the target untouched."""
    return _orders_ingest(spark, sf_dir, lambda o: o)


def run_report(spark, sf_dir):
    """Per-table run report of a four-row control table, one invalid."""
    srcs = {n: table(spark, sf_dir, n) for n in ("customer", "orders", "supplier")}
    root = scratch_path(spark, "lake")
    ctrl = _table_control(spark, [
        ("snapshot", "teradata", "normal", "customer", "TPCH", None, f"{root}/customer", None,
         None, None, None, None, None),
        ("append", "oracle", "normal", "orders", "TPCH", None, f"{root}/orders", None,
         None, None, None, "o_orderkey", None),
        ("", "sqlserver", "normal", "supplier", "TPCH", None, f"{root}/supplier", None,
         None, None, None, None, None),
        ("snapshot", "mysql", "normal", "part", "TPCH", None, f"{root}/part", None,
         None, None, None, None, None),
    ])
    rep = ingest_tables(spark, ctrl, scratch_path(spark, "state"),
                        source=lambda row: srcs[row["rdbms_table_name"]], app="erp", run_date=RUN_DATE)
    return rep.select("table_name", "mode", "status", "n_rows")


# ---------------------------------------------------------------- listings and watermarks

def file_listing(spark, sf_dir):
    """Listing projection: name and compact stamp."""
    return manifest(spark, sf_dir).select("file_name", compact_stamp("modified").alias("stamp"))


def files_newer_than(spark, sf_dir):
    """Strictly newer than the watermark, second precision."""
    return filters.files_newer_than(manifest(spark, sf_dir), WATERMARK).select("file_name")


def files_newer_than_minute(spark, sf_dir):
    """Newer than the minute after the watermark."""
    return filters.files_newer_than_minute(manifest(spark, sf_dir), WATERMARK).select("file_name")


def files_non_empty(spark, sf_dir):
    """Non-empty files only."""
    return filters.files_non_empty(manifest(spark, sf_dir)).select("file_name")


def file_prefix_filter(spark, sf_dir):
    """Names starting with a prefix."""
    return filters.files_with_prefix(manifest(spark, sf_dir), "sig").select("file_name")


def latest_file(spark, sf_dir):
    """Newest file, ties to the greatest name."""
    return filters.latest_file(manifest(spark, sf_dir)).select("file_name")


def watermark_advance(spark, sf_dir):
    """Newest stamp and its file per source (K9, A3)."""
    return state.advance_watermarks(manifest(spark, sf_dir), "event_type")


def watermark_default(spark, sf_dir):
    """Stored watermark where present, default 2000-01-01 elsewhere."""
    m = manifest(spark, sf_dir)
    st_path = scratch_path(spark, "state")
    state.append_state(state.advance_watermarks(m.where(F.col("event_type") == "click"), "event_type"),
                       st_path)
    return state.watermarks_with_default(m, state.read_state(spark, st_path), source_col="event_type")


def watermark_compacted(spark, sf_dir):
    """Watermarks appended by three runs (earlier events first), then compacted."""
    m = manifest(spark, sf_dir)
    st_path = scratch_path(spark, "state")
    for cut in ("1995-01-01", "2000-01-01", None):
        part = m if cut is None else m.where(F.col("modified") < F.lit(cut).cast("timestamp_ntz"))
        state.append_state(state.advance_watermarks(part, "event_type"), st_path)
    compacted = state.compact_state(spark, st_path)
    return state.current_watermarks(compacted).select("source", "high_water", "file_name")


def watermark_parse(spark, sf_dir):
    """Text before the first | of a stamp|name line."""
    line = F.concat_ws("|", compact_stamp("modified"), F.col("file_name"))
    return manifest(spark, sf_dir).select(before_first(line, "|").alias("stamp"))


def watermark_seed_join(spark, sf_dir):
    """Saved state wins over the control row's seed value."""
    cust = table(spark, sf_dir, "customer")
    st_path = scratch_path(spark, "state")
    seeded = cust.where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("string").alias("source"), F.lit("7").alias("value"),
        F.lit("bigint").alias("value_type"))
    state.append_state(seeded, st_path)
    ctrl = cust.select("c_custkey", F.lit("0").alias("last_value"))
    out = state.seed_from_state(ctrl, state.read_state(spark, st_path), F.col("c_custkey").cast("string"))
    return out.select("c_custkey", "last_value")


def _routes(spark):
    return local_frame(spark, ROUTES, "line_no int, pattern string, table_name string")


def route_first_match(spark, sf_dir):
    """First matching control line routes each file."""
    m = manifest(spark, sf_dir).select("file_name")
    return routing.route_first_match(m, _routes(spark)).select("file_name", "table_name")


def route_all_matches(spark, sf_dir):
    """Every matching control line routes the file."""
    m = manifest(spark, sf_dir).select("file_name")
    return routing.route_all_matches(m, _routes(spark)).select("file_name", "table_name")


# ---------------------------------------------------------------- landing

def _file_control(spark, rows) -> DataFrame:
    return local_frame(
        spark, [("ctl", i, *r) for i, r in enumerate(rows, start=1)],
        "control_file string, line_no int, pattern string, table_name string, "
        "source_dir string, target_dir string")


def gzip_landing(spark, sf_dir):
    """Per-table landing of gzip drops under <target>/<table>/date_part."""
    cust = table(spark, sf_dir, "customer")
    src = scratch_path(spark, "landing-src")
    target = scratch_path(spark, "landing-target")
    write_raw(cust, src, compression="gzip")
    ctrl = _file_control(spark, [("part-", "customer", src, target)])
    st = scratch_path(spark, "state")
    land_files(spark, ctrl, st, app="crm", run_date=RUN_DATE).collect()
    return read_loads(spark, f"{target}/customer", st, schema=ddl_of(cust))


def gzip_landing_two_patterns(spark, sf_dir):
    """Two control rows feed one table, run twice: every file lands once (C4, K6)."""
    cust = table(spark, sf_dir, "customer")
    one, two = scratch_path(spark, "landing-one"), scratch_path(spark, "landing-two")
    target, st = scratch_path(spark, "landing-target"), scratch_path(spark, "state")
    ctrl = _file_control(spark, [("part-", "customer", one, target), ("part-0", "customer", two, target)])
    for k, day in enumerate((PREV_DATE, RUN_DATE)):
        write_raw(cust.where(F.col("c_custkey") % 4 == 2 * k), one, compression="gzip")
        write_raw(cust.where(F.col("c_custkey") % 4 == 2 * k + 1), two, compression="gzip")
        land_files(spark, ctrl, st, app="crm", run_date=day).collect()
    return read_loads(spark, f"{target}/customer", st, schema=ddl_of(cust))


def landing_report(spark, sf_dir):
    """Files and rows per table in the landing's report (A1, A4)."""
    target, rows = scratch_path(spark, "landing-target"), []
    for i, name in enumerate(("customer", "supplier", "part"), start=1):
        src = scratch_path(spark, f"landing-{name}")
        write_raw(table(spark, sf_dir, name).repartition(i), src)
        rows.append(("part-", name, src, target))
    rows.append(("none-", "nation", rows[0][2], target))
    rep = land_files(spark, _file_control(spark, rows), scratch_path(spark, "state"), app="crm", run_date=RUN_DATE)
    return rep.select("table_name", "status", "n_files", "n_rows")


def _set_times(spark, path, stamp):
    """Modification time of all files of a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(p):
        fs.setTimes(st.getPath(), int(stamp.replace(tzinfo=dt.timezone.utc).timestamp() * 1000), -1)


def gzip_landing_minute(spark, sf_dir):
    """Minute-granular cut-off against a stored watermark: of two later drops, the one in the
    watermark's own minute stays out (F4, C4)."""
    cust = table(spark, sf_dir, "customer")
    root, target, st = scratch_path(spark, "landing"), scratch_path(spark, "landing-target"), scratch_path(spark, "state")
    ctrl = _file_control(spark, [("part-", "customer", f"{root}/*", target)])
    seg = F.col("c_mktsegment")
    drops = [(seg == "BUILDING", "a", dt.datetime(2024, 1, 1, 12, 0, 30)), (seg == "FURNITURE", "b", dt.datetime(2024, 1, 1, 12, 0, 50)),
             (~seg.isin("BUILDING", "FURNITURE") | seg.isNull(), "c", dt.datetime(2024, 1, 1, 12, 1, 30))]
    for runs in (drops[:1], drops[1:]):
        for rows, name, stamp in runs:
            write_raw(cust.where(rows), f"{root}/{name}", compression="gzip")
            _set_times(spark, f"{root}/{name}", stamp)
        land_files(spark, ctrl, st, app="crm", run_date=RUN_DATE, precision="minute").collect()
    return read_loads(spark, f"{target}/customer", st, schema=ddl_of(cust))


def _raw_line(df: DataFrame):
    from tidelake.sources.raw import TIMESTAMP_TEXT
    return F.to_csv(F.struct(*df.columns), {"sep": BEL, "nullValue": "\\N", "emptyValue": "",
                                             "quote": "", "escapeQuotes": "false",
                                             "ignoreLeadingWhiteSpace": "false",
                                             "ignoreTrailingWhiteSpace": "false",
                                             "timestampNTZFormat": TIMESTAMP_TEXT})


def zip_landing(spark, sf_dir):
    """Consolidated zip drop: members routed by first match, landed per table."""
    from tidelake.sources.archives import pack_zip_drops

    cust, supp = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    lines = (cust.select(F.lit("customer").alias("table_name"), _raw_line(cust).alias("value"))
             .unionByName(supp.select(F.lit("supplier").alias("table_name"), _raw_line(supp).alias("value"))))
    src = scratch_path(spark, "zip-src")
    one, two = scratch_path(spark, "zip-one"), scratch_path(spark, "zip-two")
    pack_zip_drops(lines, src).collect()
    ctrl = _file_control(spark, [("customer_", "customer", src, one),
                                 ("supplier_", "supplier", src, two),
                                 ("cust", "other", src, one)])
    st = scratch_path(spark, "state")
    land_files(spark, ctrl, st, app="crm", mode="consolidated", run_date=RUN_DATE).collect()
    c = read_loads(spark, f"{one}/customer", st, schema=ddl_of(cust))
    s = read_loads(spark, f"{two}/supplier", st, schema=ddl_of(supp))
    return c.select(F.lit("customer").alias("table_name"), *c.columns).unionByName(
        s.select(F.lit("supplier").alias("table_name"), *[F.col(x).alias(x.replace("s_", "c_", 1).replace("suppkey", "custkey"))
                                                          for x in s.columns]), allowMissingColumns=True)


# ---------------------------------------------------------------- control tables

def _derived_control(spark, sf_dir) -> DataFrame:
    """A relational control table built from ``customer`` (one row per customer)."""
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    name = F.regexp_replace("c_name", "#", "_")
    return c.select(
        F.when(seg == "AUTOMOBILE", "snapshot").when(seg == "BUILDING", "append")
        .when(seg == "FURNITURE", "lastmodified").when(seg == "HOUSEHOLD", "").otherwise("bogus")
        .alias("table_type"),
        F.when(F.col("c_nationkey") < 5, "teradata").when(F.col("c_nationkey") < 12, "oracle")
        .when(F.col("c_nationkey") < 20, "sqlserver").otherwise("mysql").alias("db_name"),
        F.when(F.col("c_acctbal") < -900, "both").when(F.col("c_acctbal") < 0, "normal")
        .otherwise("hive").alias("hive_normal"),
        F.when(F.col("c_acctbal") > 9900, "").otherwise(F.upper(name)).alias("rdbms_table_name"),
        F.lit("TPCH").alias("schema_name"),
        F.lower(name).alias("hive_table_name"),
        F.concat(F.lit("/lake/"), F.col("c_custkey").cast("string")).alias("target_dir"),
        F.when(seg == "BUILDING", "o_orderstatus in ('F','O')").alias("where_clause"),
        F.when(seg == "AUTOMOBILE", "n_nationkey").alias("split_by_col"),
        F.when(F.col("c_nationkey") > 0, F.col("c_nationkey") * 100).alias("fetch_size"),
        F.when(F.col("c_nationkey") > 10, F.lit(4)).alias("num_mapper"),
        F.when(seg == "BUILDING", "o_orderkey").when(seg == "FURNITURE", "o_orderdate").alias("check_column"),
        F.when(seg == "BUILDING", F.col("c_custkey").cast("string"))
        .when(seg == "FURNITURE", "1998-01-01").alias("last_value"),
    )


def _control_file(spark, sf_dir) -> str:
    path = scratch_path(spark, "control")
    _derived_control(spark, sf_dir).write.option("header", True).csv(path)
    return path


def control_table_scan(spark, sf_dir):
    """Control file derived from customer, read back with quoting and blanks."""
    return read_control(spark, _control_file(spark, sf_dir), "tables").select(*TABLE_COLUMNS)


def control_validate(spark, sf_dir):
    """Validation and mode dispatch over the derived control table."""
    ctrl = read_control(spark, _control_file(spark, sf_dir), "tables")
    return validate_table_control(ctrl).select("target_dir", "mode", "error")


# ---------------------------------------------------------------- streaming

def stream_landing(spark, sf_dir):
    """File-source stream over two drops: each file once (G1)."""
    cust = table(spark, sf_dir, "customer")
    src, target = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-target")
    ckpt = scratch_path(spark, "stream-ckpt")
    first = F.col("c_mktsegment") <= "FURNITURE"
    for drop in (cust.where(first), cust.where(~first | F.col("c_mktsegment").isNull())):
        write_raw(drop, src)
        stream_land(spark, src, target, checkpoint=ckpt, run_date=RUN_DATE)
    return read_raw(spark, target, schema=ddl_of(cust)).drop("date_part")


def stream_cleansed(spark, sf_dir):
    """Raw -> cleansed as a stream over two raw drops of orders."""
    from tidelake.streaming.landing import stream_raw_to_cleansed
    orders = table(spark, sf_dir, "orders")
    raw, out, ckpt = scratch_path(spark, "raw-orders"), scratch_path(spark, "cleansed"), scratch_path(spark, "ckpt")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    for drop in (orders.where(~late | F.col("o_orderdate").isNull()), orders.where(late)):
        write_raw(drop, raw)
        stream_raw_to_cleansed(spark, raw, out, ddl_of(orders), checkpoint=ckpt, run_date=RUN_DATE)
    return spark.read.format("com.databricks.spark.avro").load(out)


def stream_landing_archive(spark, sf_dir):
    """Three stream runs with archive: files of committed batches archived (K8)."""
    src, target = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-target")
    archive, ckpt = scratch_path(spark, "stream-archive"), scratch_path(spark, "stream-ckpt")
    key = "spark.sql.streaming.fileSource.cleaner.numThreads"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "0")  # archive synchronously, inside the batch that commits
    try:
        for name in ("customer", "supplier", "part"):
            write_raw(table(spark, sf_dir, name), f"{src}/{name}")
            stream_land(spark, f"{src}/*", target, checkpoint=ckpt, archive_dir=archive, run_date=RUN_DATE)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    return _placed(spark, landed=target, archived=archive)


def _placed(spark, **folders) -> DataFrame:
    """Records of each folder (whatever table they are of) as six text fields."""
    out = None
    for place, folder in folders.items():
        lines = spark.read.option("recursiveFileLookup", "true").text(folder)
        part = parse_raw_lines(lines, ", ".join(f"f{i} string" for i in range(6))).withColumn("place", F.lit(place))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- catalog tables and queries

def _registered_customer(spark, sf_dir) -> str:
    cust = table(spark, sf_dir, "customer")
    root = scratch_path(spark, "lake-customer")
    write_raw(cust, f"{root}/date_part={RUN_DATE}")
    name = f"tidelake_customer_{uuid.uuid4().hex[:8]}"
    register_raw_table(spark, name, root, ddl_of(cust))
    return name


def table_query(spark, sf_dir):
    """Projection + equality filter over an external raw table."""
    return query_table(spark, _registered_customer(spark, sf_dir), ["c_custkey"],
                       {"c_mktsegment": "FURNITURE"})


def pipe_display(spark, sf_dir):
    """Rows shown as |-joined lines, NULL as null."""
    t = query_table(spark, _registered_customer(spark, sf_dir))
    return display_lines(t.select("c_custkey", "c_name",
                                  F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("seg")))


def table_preview(spark, sf_dir):
    """The first ten rows by key."""
    return query_table(spark, _registered_customer(spark, sf_dir), limit=10, order_by="c_custkey")


def table_ddl_query(spark, sf_dir):
    """Columns of the registered raw table."""
    return table_columns(spark, _registered_customer(spark, sf_dir)).drop("position")


# ---------------------------------------------------------------- further operator paths

def _escaped_documents(spark, sf_dir) -> str:
    docs = table(spark, sf_dir, "documents")
    escaped = F.concat(F.col("doc_id").cast("string"), F.lit(BEL),
                       F.regexp_replace("text", "\n", "\\\\\n"))
    tmp = scratch_path(spark, "tmp-documents")
    write_lines(docs.select(escaped.alias("value")), tmp)
    return tmp


def _doc_fields(df: DataFrame) -> DataFrame:
    return df.select(F.expr("substr(value, 1, instr(value, char(7)) - 1)").cast("bigint").alias("doc_id"),
                     F.expr("substr(value, instr(value, char(7)) + 1)").alias("text"))


def whole_file_repair(spark, sf_dir):
    """Whole-file scan and repair (S2, X1) on the escaped documents."""
    from tidelake.operators.repair import repair_documents
    return _doc_fields(repair_documents(spark, _escaped_documents(spark, sf_dir)))


def repair_to_raw(spark, sf_dir):
    """Repair written back as raw text and read again."""
    from tidelake.plans.cleansed import repair_raw
    raw = scratch_path(spark, "raw-documents")
    return _doc_fields(repair_raw(spark, _escaped_documents(spark, sf_dir), f"{raw}/date_part={RUN_DATE}")
                       .select("value"))


def route_first_match_equijoin(spark, sf_dir):
    """First-match routing by a shuffled join (the plan of a large control table)."""
    m = manifest(spark, sf_dir).select("file_name")
    return routing.route_first_match(m, _routes(spark).hint("merge")).select("file_name", "table_name")


def route_all_matches_equijoin(spark, sf_dir):
    """Every-match routing by a shuffled join (the plan of a large control table)."""
    m = manifest(spark, sf_dir).select("file_name")
    return routing.route_all_matches(m, _routes(spark).hint("merge")).select("file_name", "table_name")


def bucket_listing_line(spark, sf_dir):
    """stamp|name listing lines."""
    from tidelake.sources.listing import listing_line
    return listing_line(manifest(spark, sf_dir))


def bucket_pickup(spark, sf_dir):
    """Bucket pickup over real files; a second run finds nothing new."""
    from tidelake.plans.landing import pickup_files
    cust = table(spark, sf_dir, "customer")
    bucket, stage, st = scratch_path(spark, "bucket"), scratch_path(spark, "stage"), scratch_path(spark, "state")
    write_raw(cust, bucket)
    pickup_files(spark, bucket, stage, st, source="crm", run_date=RUN_DATE).collect()
    pickup_files(spark, bucket, stage, st, source="crm", run_date=RUN_DATE).collect()  # nothing new
    return read_loads(spark, stage, st, schema=ddl_of(cust)).drop("date_part")


def bucket_pickup_archive(spark, sf_dir):
    """Two drops (customer, then supplier); the second run archives the first batch."""
    from tidelake.plans.landing import pickup_files
    bucket, stage = scratch_path(spark, "bucket"), scratch_path(spark, "stage")
    archive, st = scratch_path(spark, "archive"), scratch_path(spark, "state")
    for name in ("customer", "supplier"):
        write_raw(table(spark, sf_dir, name), f"{bucket}/{name}")
        pickup_files(spark, f"{bucket}/*", stage, st, source="crm", run_date=RUN_DATE,
                     archive_dir=archive).collect()
    return _placed(spark, staged=stage, archived=archive)


def incremental_lastmodified(spark, sf_dir):
    """Control-driven lastmodified import over two runs of a source whose stamps lie far behind this
    driver's clock: every row once, under the date of the run that first saw it (C3, S5)."""
    orders = table(spark, sf_dir, "orders")
    target, st = scratch_path(spark, "lake-orders"), scratch_path(spark, "state")
    ctrl = _table_control(spark, [("LastModified", "Oracle", "normal", "ORDERS", "TPCH", None, target, None,
                                   None, None, None, "o_orderdate", None)])
    early = orders.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    for run_date, src in ((PREV_DATE, early), (RUN_DATE, orders)):
        ingest_tables(spark, ctrl, st, source=lambda row, s=src: s, app="erp", run_date=run_date).collect()
    return read_loads(spark, target, st, schema=ddl_of(orders))


def lastmodified_clock(spark, sf_dir):
    """Lastmodified import up to the source's own current time."""
    orders = table(spark, sf_dir, "orders")
    target = scratch_path(spark, "lake-orders")
    ctrl = _table_control(spark, [("lastmodified", "oracle", "normal", "ORDERS", "TPCH", None, target, None,
                                   None, None, None, "o_orderdate", "1998-01-01 00:00:00")])
    st = scratch_path(spark, "state")
    ingest_tables(spark, ctrl, st, source=lambda row: orders, app="erp",
                  run_date=RUN_DATE, source_now=lambda row: "1999-01-01 00:00:00").collect()
    return read_loads(spark, target, st, schema=ddl_of(orders))


def cleansed_replace_partition(spark, sf_dir):
    """Cleansed load run twice with partition replace: no duplicates (D8 option)."""
    orders, root = _orders_raw_partition(spark, sf_dir)
    out = scratch_path(spark, "cleansed-orders")
    raw_to_cleansed(spark, root, out, run_date=RUN_DATE, schema=ddl_of(orders), mode="replace_partition")
    return raw_to_cleansed(spark, root, out, run_date=RUN_DATE, schema=ddl_of(orders), mode="replace_partition")


def raw_scan_csv_mode(spark, sf_dir):
    """Raw reader on Spark's CSV source (exact=False)."""
    cust = table(spark, sf_dir, "customer")
    return read_raw(spark, _raw_copy(spark, cust, "raw-customer"), schema=ddl_of(cust), exact=False)


def run_summary(spark, sf_dir):
    """Run report of two runs summarised per table and status (A4)."""
    from tidelake.operators.report import summarize
    srcs = {n: table(spark, sf_dir, n) for n in ("customer", "orders")}
    root, st = scratch_path(spark, "lake"), scratch_path(spark, "state")
    ctrl = _table_control(spark, [
        ("snapshot", "teradata", "normal", "customer", "TPCH", None, f"{root}/customer", None,
         None, None, None, None, None),
        ("append", "oracle", "normal", "orders", "TPCH", None, f"{root}/orders", None,
         None, None, None, "o_orderkey", None),
    ])
    reports = [ingest_tables(spark, ctrl, st, source=lambda row: srcs[row["rdbms_table_name"]], app="erp",
                             run_date=RUN_DATE) for _ in range(2)]
    return summarize(reports[0].unionByName(reports[1]))


QUERIES = {
    "raw_delimited_scan": raw_delimited_scan,
    "raw_scan_untyped": raw_scan_untyped,
    "null_marker_roundtrip": null_marker_roundtrip,
    "null_marker_literal": null_marker_literal,
    "field_split_exact": field_split_exact,
    "multiline_repair": multiline_repair,
    "raw_to_cleansed": raw_to_cleansed_query,
    "cleansed_append_twice": cleansed_append_twice,
    "snapshot_replace": snapshot_replace,
    "catalog_table_sink": catalog_table_sink,
    "append_increment": append_increment_query,
    "lastmodified_increment": lastmodified_increment_query,
    "source_where_pushdown": source_where_pushdown,
    "incremental_append": incremental_append,
    "incremental_no_new_rows": incremental_no_new_rows,
    "run_report": run_report,
    "file_listing": file_listing,
    "files_newer_than": files_newer_than,
    "files_newer_than_minute": files_newer_than_minute,
    "files_non_empty": files_non_empty,
    "file_prefix_filter": file_prefix_filter,
    "latest_file": latest_file,
    "watermark_advance": watermark_advance,
    "watermark_default": watermark_default,
    "watermark_parse": watermark_parse,
    "watermark_seed_join": watermark_seed_join,
    "route_first_match": route_first_match,
    "route_all_matches": route_all_matches,
    "gzip_landing": gzip_landing,
    "zip_landing": zip_landing,
    "control_table_scan": control_table_scan,
    "control_validate": control_validate,
    "stream_landing": stream_landing,
    "stream_landing_archive": stream_landing_archive,
    "table_query": table_query,
    "pipe_display": pipe_display,
    "table_preview": table_preview,
    "table_ddl": table_ddl_query,
    "whole_file_repair": whole_file_repair,
    "repair_to_raw": repair_to_raw,
    "route_first_match_equijoin": route_first_match_equijoin,
    "route_all_matches_equijoin": route_all_matches_equijoin,
    "bucket_listing_line": bucket_listing_line,
    "bucket_pickup": bucket_pickup,
    "incremental_lastmodified": incremental_lastmodified,
    "cleansed_replace_partition": cleansed_replace_partition,
    "raw_scan_csv_mode": raw_scan_csv_mode,
    "run_summary": run_summary,
    "bucket_pickup_archive": bucket_pickup_archive,
    "stream_cleansed": stream_cleansed,
    "watermark_compacted": watermark_compacted,
    "gzip_landing_minute": gzip_landing_minute,
    "gzip_landing_two_patterns": gzip_landing_two_patterns,
    "landing_report": landing_report,
    "raw_scan_ragged": raw_scan_ragged,
    "ingest_where": ingest_where,
    "lastmodified_clock": lastmodified_clock,
}

from tidelake.registry_loads import LOAD_QUERIES  # noqa: E402  (they use the helpers above)

QUERIES.update(LOAD_QUERIES)

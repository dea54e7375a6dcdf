"""Control-table driven import of relational tables (snapshot, append, lastmodified)."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tidelake.operators.boundary import KEY, known_keys, row_key, write_edges
from tidelake.operators.increments import lastmodified_increment
from tidelake.operators.report import FAILED, INVALID, NO_NEW_DATA, OK, Outcome, report_frame, timed
from tidelake.operators.state import read_state, seed_from_state
from tidelake.operators.validate import validate_table_control
from tidelake.session import today
from tidelake.sinks.loads import TASKS_COMMIT, Load, commit_load, content_check, discard_unfinished, drop_load, open_load, reconcile, visible_loads
from tidelake.sinks.raw import write_raw
from tidelake.sinks.tables import PARTITION
from tidelake.sources.raw import read_raw
from tidelake.sources.relational import jdbc_options, read_jdbc
from tidelake.sources.tables import add_load, register_loads

Source = Callable[[dict], DataFrame]


def jdbc_source(spark: SparkSession, connections: dict, even: bool = True) -> Source:
    """Source factory over JDBC; ``connections[vendor]`` holds server/port/sid/user/password.

    Snapshots split on ``split_by_col`` at boundaries between equally many rows (``even=False``: into equal
    widths with bounds from a MIN/MAX query over the table).  An
    increment covers only part of the key range, so whole-table bounds would put nearly all
    of it into the last split: increments are first read without splitting for one
    aggregate (append bound and split range of the increment), then read again split over
    ``row["split_bounds"]``.
    """
    def read(row: dict) -> DataFrame:
        opts = jdbc_options(row["db_name"], table=row["rdbms_table_name"], schema=row["schema_name"],
                            **connections.get(row["db_name"], {}))
        bounds = row.get("split_bounds")
        split = row.get("split_by_col") if bounds is not None or row.get("mode") != "incremental" else None
        # the where text is the database's: it also bounds the split query
        return read_jdbc(spark, opts, where=row.get("where_clause"), split_by=split,
                         num_partitions=row.get("num_mapper"), fetch_size=row.get("fetch_size"),
                         bounds=bounds, even=even)
    read.applies_where = True
    return read


def open_source(source: Source, row: dict) -> DataFrame:
    """The rows of a control row's table that its ``where_clause`` keeps, evaluated at the source: by the
    database where the source says so (``applies_where``), else as a pushed-down filter."""
    where = None if getattr(source, "applies_where", False) else row.get("where_clause")
    return source(row).where(where) if where else source(row)


def _write(df: DataFrame, folder: str, fmt: str, obs: Observation, check: bool) -> int:
    """Write a load's rows into its folder; the date is the folder's.  With ``check`` they are read back
    and compared.  Returns their number."""
    rows = df.drop(PARTITION)
    counts = content_check(rows.columns)
    out = rows.observe(obs, *(counts if check else counts[:1]))
    if fmt == "raw":
        write_raw(out, folder, **TASKS_COMMIT)
    else:
        out.write.format(fmt).options(**TASKS_COMMIT).save(folder)
    seen = obs.get
    if check and seen["n"]:
        spark = df.sparkSession
        back = read_raw(spark, folder, schema=rows.schema) if fmt == "raw" else spark.read.schema(rows.schema).format(fmt).load(folder)
        reconcile(back.select(*rows.columns), seen)
    return seen["n"]


def _register(spark, row, df: DataFrame, fmt: str, run_date, load: Load, state_path: str):
    """``hive`` target: the catalog table sees the load (all visible ones when it is first made)."""
    name = row.get("hive_table_name")
    if row["hive_normal"] != "hive":  # normalised by the validation, which also asks for the name
        return
    replaces = row["mode"] == "snapshot"
    if spark.catalog.tableExists(name):
        add_load(spark, name, run_date, load.load_id, replaces)
        return
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.drop(PARTITION).schema.fields)
    loads = visible_loads(spark, state_path, row["target_dir"]).select("folder", "load_id").collect()  # one row a load
    register_loads(spark, name, row["target_dir"], ddl, fmt, [tuple(x) for x in loads], load.load_id if replaces else None)


def state_key(app: str):
    """``app/vendor/schema/table@target``: tables of one name in two schemas, and one table loaded into
    two targets, keep two watermarks, whatever other rows the control table has."""
    some = [F.nullif(F.trim(c), F.lit("")) for c in (F.lower("db_name"), F.col("schema_name"), F.col("rdbms_table_name"))]
    return F.concat(F.concat_ws("/", F.lit(app), *some), F.lit("@"), F.rtrim(F.coalesce("target_dir", F.lit("")), F.lit("/")))


def _one_row_each(rows: list[dict]) -> None:
    """Of rows that would load one table into one target twice, or replace what another row loads
    there, the first stays and the others are invalid."""
    held: dict[str, list[dict]] = {}
    for r in rows:
        if r["error"] is not None or not r["target_dir"]:
            continue
        others = held.setdefault(r["target_dir"].rstrip("/"), [])
        if any(o["source_key"] == r["source_key"] or "snapshot" in (o["mode"], r["mode"]) for o in others):
            r["error"] = "target_dir (another row's)"
        else:
            others.append(r)


def ingest_tables(spark: SparkSession, control: DataFrame, state_path: str, source: Source,
                  app: str = "app", run_date=None, run_start=None, fmt: str = "raw", max_parallel: int = 4,
                  source_now: Callable[[dict], object] | None = None, check: bool = False) -> DataFrame:
    """Import every control row; returns the run report.

    * snapshot: the table becomes today's load at the moment of its commit (a failing source leaves it
      as it was);
    * append: rows above the stored (or seeded) value up to the maximum seen at run start;
    * lastmodified: changed rows, appended.  The upper bound is the source's, never this driver's
      clock: ``source_now(row)``, the source's current timestamp, loads ``[last, now)``; without it
      the largest stamp seen at run start is the bound (from a seed ``[seed, largest]``).
      ``run_start`` fixes the bound by hand.

    Rows that appear later with exactly the stored value are loaded too, unless they equal, in all
    columns, a row that was loaded at that value (see :mod:`tidelake.operators.boundary`).

    A first increment without stored value or seed also loads the rows whose check column is NULL.
    Every load lies in its own folder and is committed by its state row, the watermark (see
    :mod:`tidelake.sinks.loads`; read targets with ``read_loads``).  One table may be loaded into several
    targets, each with its own watermark; a row that would load a table into a target twice, or
    replace what another row loads there, is invalid.  A failing table is reported and the others
    still run.  With ``check`` every load is read back before its commit and must hold the rows that were
    written, by number and content.  Control rows are configuration and are handed out on the driver; each table's read
    and write run as Spark jobs, up to ``max_parallel`` at a time.
    """
    run_date = run_date or today(spark)  # one load date for every table of the run
    state = read_state(spark, state_path)
    seeded = seed_from_state(control, state, state_key(app), flag_col="stored")
    checked = validate_table_control(seeded).withColumn("source_key", state_key(app))
    order = [c for c in ("control_file", "line_no") if c in checked.columns]
    rows = [r.asDict() for r in (checked.orderBy(*order) if order else checked).collect()]
    _one_row_each(rows)
    state_lock = threading.Lock()
    # once, before any load of this run begins
    discard_unfinished(spark, state_path, [r["source_key"] for r in rows if r["error"] is None], state)

    def run(row: dict) -> Outcome:
        table = row.get("rdbms_table_name")
        spark.sparkContext.setJobDescription(f"tidelake ingest {app}/{table}")
        if row["error"] is not None or not row.get("target_dir"):
            return Outcome(app, table, row.get("mode"), INVALID, message=row["error"] or "target_dir")
        kind = row.get("table_type") or "snapshot"
        try:
            now = run_start if run_start is not None else source_now(row) if source_now else None
            return _import_one(spark, row, kind, source, state_path, state_lock, app, run_date, now, fmt, state, check)
        except Exception as e:  # reported per table; the others still run
            return Outcome(app, table, kind, FAILED, message=str(e))

    # tables are independent Spark jobs: run a few at once so small tables do not leave a
    # large cluster idle (Spark schedules concurrent jobs from several driver threads)
    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(rows) or 1))) as pool:
        outcomes = list(pool.map(inheritable_thread_target(spark)(timed(run)), rows))
    return report_frame(spark, outcomes)


def _import_one(spark, row, kind, source, state_path, state_lock, app, run_date, now, fmt, state, check_content) -> Outcome:
    table, key, target = row.get("rdbms_table_name"), row["source_key"], row["target_dir"]
    df = open_source(source, row)
    obs = Observation(f"rows_{table}_{uuid.uuid4().hex[:6]}")

    def mark(value, ctype) -> list[tuple]:
        return [(key, None, None, value, ctype)]

    if row["mode"] == "snapshot":
        load = open_load(spark, state_path, key, target, run_date, replaces=True, lock=state_lock)
        n = _write(df, load.folder(), fmt, obs, check_content)
        commit_load(spark, state_path, load, mark(None, None), state_lock)
        _register(spark, row, df, fmt, run_date, load, state_path)
        return Outcome(app, table, kind, OK, n_rows=n)

    check, last = row["check_column"], row.get("last_value")
    ctype = df.schema[check].dataType.simpleString()
    split = row.get("split_by_col") if (row.get("num_mapper") or 0) > 1 else None
    by_clock = kind == "lastmodified" and now is not None
    col = F.col(check)

    def at(value):
        return F.lit(str(value)).cast(ctype)

    def above(frame: DataFrame) -> DataFrame:
        """Rows of this run, the upper bound still open; the boundary itself is looked at below."""
        if last is None:  # first load: everything so far, rows without a check value included
            return frame.where((col < at(now)) | col.isNull()) if by_clock else frame
        if by_clock:
            return lastmodified_increment(frame, check, last, str(now))
        return frame.where(col >= at(last)) if kind == "lastmodified" and not row["stored"] else frame.where(col > at(last))

    # one aggregate over the pushed increment range: the upper bound (fixed once at run start,
    # so every split reads the same range) and the split column's range
    aggs = ([] if by_clock else [F.max(check).alias("hi")]) + \
        ([F.min(split).alias("s_lo"), F.max(split).alias("s_hi")] if split else [])
    b = above(df).agg(*aggs).first() if aggs else None
    hi = None if by_clock else b["hi"]
    late = None  # rows at the stored value that were not there when it was stored
    if row["stored"] and not by_clock:
        known = known_keys(spark, state_path, key, str(last), state)
        if known is not None:
            here = df.where(col == at(last))
            late = here.join(known, row_key(here) == F.col(KEY), "left_anti")
            if hi is None and late.isEmpty():
                late = None
    if not by_clock and hi is None and late is None:
        return Outcome(app, table, kind, NO_NEW_DATA, n_rows=0)
    wide = df  # read over splits where the increment is large
    if split and b["s_lo"] is not None:
        wide = open_source(source, {**row, "split_bounds": (b["s_lo"], b["s_hi"])})
    load = open_load(spark, state_path, key, target, run_date, lock=state_lock)
    if by_clock:
        inc, new_value = above(wide), str(now)
    else:
        new_value = str(last if hi is None else hi)
        here = df.where(col == at(new_value)) if hi is not None else late
        edge = write_edges(here.select(row_key(df).alias("key")), state_path, key, load.load_id, new_value)
        here = here.join(edge, row_key(here) == F.col(KEY), "left_semi")
        inc = here
        if hi is not None:
            upper = (col < at(hi)) | col.isNull() if last is None else col < at(hi)
            inc = above(wide).where(upper).unionByName(here)
            inc = inc if late is None else inc.unionByName(late)
    n = _write(inc, load.folder(), fmt, obs, check_content)
    if not n:  # an empty increment leaves target and watermark as they were
        drop_load(spark, state_path, load, state_lock)
        return Outcome(app, table, kind, NO_NEW_DATA, n_rows=0)
    commit_load(spark, state_path, load, mark(new_value, ctype), state_lock)
    _register(spark, row, df, fmt, run_date, load, state_path)
    return Outcome(app, table, kind, OK, n_rows=n)

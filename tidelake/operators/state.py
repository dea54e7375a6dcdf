"""Watermark state table.

One append-only table (parquet at a path) replaces the watermark text files:
``source string, high_water <timestamp>, file_name string, value string,
value_type string, run_ts timestamp, load_id string``.  ``high_water``/``file_name`` serve file pickers,
``value``/``value_type`` serve relational increments (the check column may be a number,
date or timestamp).  Reads reduce to one row per source with partial aggregation, so a
source with a long history is no hot group.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidelake.functions.time import DEFAULT_WATERMARK, watermark_literal
from tidelake.session import append_rows


def advance_watermarks(manifest: DataFrame, source, ts_col: str = "modified",
                       name_col: str = "file_name") -> DataFrame:
    """Newest stamp and its file per source: ``(source, high_water, file_name)``.

    ``source`` is a column name or a Column.  Ties on the stamp go to the greatest name.
    """
    src = F.col(source) if isinstance(source, str) else source
    best = F.max(F.struct(F.col(ts_col).alias("t"), F.col(name_col).alias("n")))
    return (manifest.groupBy(src.alias("source")).agg(best.alias("_b"))
            .select("source", F.col("_b.t").alias("high_water"), F.col("_b.n").alias("file_name")))


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state table, or None before the first run wrote one."""
    from tidelake.session import path_exists

    if not path_exists(spark, path):
        return None
    try:
        state = spark.read.parquet(path)
    except AnalysisException:  # folder without data files yet
        return None
    if "load_id" not in state.columns:  # written before loads carried an id
        state = state.withColumn("load_id", F.lit(None).cast("string"))
    return state


STATE = ("source string, high_water timestamp, file_name string, value string, value_type string, run_ts timestamp, "
         "load_id string")


def append_state(rows, path: str, run_ts=None, load_id: str | None = None, spark: SparkSession | None = None):
    """Append watermark rows; call only after the data they describe is there.  ``rows`` is a DataFrame,
    or a list of ``(source, high_water, file_name, value, value_type)`` of the driver's (with ``spark``),
    which is one small file.  ``load_id`` marks the load these rows commit (see
    :mod:`tidelake.sinks.loads`)."""
    if isinstance(rows, list):
        now = dt.datetime.now(dt.timezone.utc) if run_ts is None else run_ts
        append_rows(spark, path, [(*r, now, load_id) for r in rows], STATE)
        return
    ts = F.current_timestamp() if run_ts is None else F.lit(str(run_ts)).cast("timestamp")
    cols = {"high_water": None, "file_name": "string", "value": "string", "value_type": "string"}
    out = rows
    for c, t in cols.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(t or "timestamp"))
    (out.select("source", "high_water", "file_name", "value", "value_type")
     .withColumn("run_ts", ts).withColumn("load_id", F.lit(load_id).cast("string"))
     .coalesce(1).write.mode("append").parquet(path))


def current_watermarks(state: DataFrame) -> DataFrame:
    """Latest entry per source: ``(source, high_water, file_name, value, value_type)``.

    File watermarks never go backwards (greatest ``high_water``); relational values are
    those of the latest run.
    """
    hw = F.max(F.struct("high_water", "file_name")).alias("_h")
    last = F.max(F.struct("run_ts", "value", "value_type")).alias("_v")
    return (state.groupBy("source").agg(hw, last)
            .select("source", F.col("_h.high_water").alias("high_water"),
                    F.col("_h.file_name").alias("file_name"),
                    F.col("_v.value").alias("value"), F.col("_v.value_type").alias("value_type")))


def watermarks_with_default(sources: DataFrame, state: DataFrame | None,
                            default=DEFAULT_WATERMARK, dtype: str = "timestamp_ntz",
                            source_col: str = "source") -> DataFrame:
    """Watermark per requested source; a source without state gets ``default``."""
    d = watermark_literal(default, dtype)
    s = sources.select(F.col(source_col).alias("source")).distinct()
    if state is None:
        return s.withColumn("high_water", d)
    cur = current_watermarks(state).select("source", F.col("high_water").cast(dtype).alias("hw"))
    return (s.join(cur, "source", "left")
            .select("source", F.coalesce(F.col("hw"), d).alias("high_water")))


def seed_from_state(control: DataFrame, state: DataFrame | None, key, seed_col: str = "last_value",
                    state_key: str = "source", out_col: str = "last_value",
                    flag_col: str | None = None) -> DataFrame:
    """Existing state wins, otherwise the control row seeds the value (exact key match);
    ``flag_col`` tells whether the value is a stored one."""
    if state is None:
        return control.withColumn(flag_col, F.lit(False)) if flag_col else control
    cur = current_watermarks(state).select(F.col(state_key).alias("_k"), F.col("value").alias("_sv"))
    k = F.col(key) if isinstance(key, str) else key
    joined = control.join(cur, k == F.col("_k"), "left")
    if flag_col:
        joined = joined.withColumn(flag_col, F.col("_sv").isNotNull())
    return joined.withColumn(out_col, F.coalesce(F.col("_sv"), F.col(seed_col))).drop("_k", "_sv")


def compact_state(spark: SparkSession, path: str) -> DataFrame | None:
    """Rewrite the state table as one row per source (its current watermark and the id of
    its latest committed load), replacing the many small files that one append per run
    leaves behind.  Run it when no pipeline writes to the same state table."""
    from tidelake.session import recover_target, sibling_staging, swap_into_place

    from tidelake.operators.boundary import compact_edges
    from tidelake.sinks.loads import compact_ledger

    recover_target(spark, path)
    state = read_state(spark, path)
    if state is None:
        return None
    compact_ledger(spark, path, state)  # first: it keeps the ids of all committed loads
    last_run = (state.groupBy("source")
                .agg(F.max(F.struct("run_ts", "load_id")).alias("_r"))
                .select("source", F.col("_r.run_ts").alias("run_ts"), F.col("_r.load_id").alias("load_id")))
    now = current_watermarks(state)
    rows = now.join(last_run, "source")
    at = F.coalesce(F.unix_micros(F.col("high_water").cast("timestamp")).cast("string"), "value")
    compact_edges(spark, path, state, rows.select("source", at.alias("value"), "load_id"))
    staging = sibling_staging(path)
    rows.select(*state.columns).coalesce(1).write.parquet(staging)
    swap_into_place(spark, staging, path)
    return read_state(spark, path)

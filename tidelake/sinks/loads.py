"""Loads: every load lies in a folder of its own, and a state row is its commit.

An append and the watermark that follows it are two writes; a driver that dies between them would,
on rerun, load the same range again.  A load therefore goes:

1. an *intent* row ``(source, load_id, target, folder, replaces)`` is appended to ``<state>_loads``;
2. the data is written, by the tasks themselves, to ``<target>/date_part=D/load=<id>``.  No other load
   ever has this folder, so nothing is renamed, and what the driver does is the same however many files
   there are;
3. the watermark rows are appended to the state table carrying ``load_id``: one file that appears at
   once.  This is the commit; ``_SUCCESS`` in the target comes after it, for marker-driven schedulers.

Readers (:func:`read_loads`) see the loads whose id a state row carries and no others.  A load that
*replaces* (a snapshot) hides all earlier loads of its target from the moment of its commit: a reader
sees the old table or the new one, never none or both.  The version it replaced keeps its files until
the target's next load begins, for readers still busy with it.

A run first deletes what its sources' earlier runs left uncommitted (:func:`discard_unfinished`), once,
before any of its own loads begins; a folder belongs to one load, so no other load can be hit.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake.session import append_rows, path_exists

LEDGER = ("source string, load_id string, target string, folder string, replaces boolean, run_ts timestamp, "
          "committed_at timestamp, closed boolean")
LOAD = "load"  # the partition column of load folders
# Task commits move a task's files into the load's folder themselves: nothing is left to the driver.
TASKS_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def loads_path(state_path: str) -> str:
    return state_path.rstrip("/") + "_loads"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _log(spark: SparkSession, state_path: str, rows: list[tuple]) -> None:
    """Append ``(source, load_id, target, folder, replaces, closed)`` rows to the ledger."""
    now = dt.datetime.now(dt.timezone.utc)
    append_rows(spark, loads_path(state_path), [(*r[:5], now, None, r[5]) for r in rows], LEDGER)


@dataclass
class Load:
    """A load in progress: its id and the folder of each target it writes to."""

    source: str
    load_id: str
    folders: dict[str, str]

    def folder(self, target: str | None = None) -> str:
        return self.folders[target] if target is not None else next(iter(self.folders.values()))


def open_load(spark: SparkSession, state_path: str, source: str, targets, run_date, replaces: bool = False,
              lock=None) -> Load:
    """Record the intent of a load of ``source`` into each of ``targets``; write the data into
    ``load.folder(target)`` and then :func:`commit_load`."""
    targets = [targets] if isinstance(targets, str) else list(targets)
    load_id = "L" + uuid.uuid4().hex[:16]  # never reads as a number, so its column stays text
    load = Load(source, load_id, {t: f"{t.rstrip('/')}/date_part={run_date}/{LOAD}={load_id}" for t in targets})
    if targets:
        with lock or nullcontext():
            _log(spark, state_path, [(source, load_id, t.rstrip("/"), f, replaces, False) for t, f in load.folders.items()])
    return load


def commit_load(spark: SparkSession, state_path: str, load: Load, state_rows, lock=None) -> None:
    """Make the load visible, together with ``state_rows`` (see :func:`tidelake.operators.state.append_state`)."""
    from tidelake.operators import state

    with lock or nullcontext():
        state.append_state(state_rows, state_path, load_id=load.load_id, spark=spark)
    for target in load.folders:
        p, fs = _path(spark, f"{target.rstrip('/')}/_SUCCESS")
        if not fs.exists(p):
            fs.create(p, True).close()


def content_check(columns: list[str]) -> list:
    """Number of rows and a sum over their digests, which no order of rows changes: observed while rows are
    written, and taken again from what was written."""
    digest = F.xxhash64(*columns).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(digest), F.lit(0).cast("decimal(38,0)")).alias("check")]


def reconcile(written: DataFrame, seen: dict) -> None:
    """Compare what a folder holds with what was observed on its way there; a difference is an error."""
    back = written.agg(*content_check(written.columns)).first()
    if (back["n"], back["check"]) != (seen["n"], seen["check"]):
        raise OSError(f"written {seen['n']} rows, read back {back['n']}, content {'differs' if back['n'] == seen['n'] else 'incomplete'}")


def drop_load(spark: SparkSession, state_path: str, load: Load, lock=None) -> None:
    """Give a load up that was not committed."""
    for folder in load.folders.values():
        p, fs = _path(spark, folder)
        fs.delete(p, True)
    if not load.folders:
        return
    with lock or nullcontext():
        _log(spark, state_path, [(load.source, load.load_id, t.rstrip("/"), f, False, True) for t, f in load.folders.items()])


def _ledger(spark: SparkSession, state_path: str, wanted=None) -> DataFrame | None:
    """Open ledger rows (those of no closed load) that ``wanted`` (a condition on source or target) picks,
    or None before the first load.  They are one row a load: one task reads them, without a shuffle."""
    lp = loads_path(state_path)
    if not path_exists(spark, lp):
        return None
    rows = spark.read.schema(LEDGER).parquet(lp).where(F.col("folder").isNotNull())
    rows = (rows if wanted is None else rows.where(wanted)).coalesce(1)
    per = rows.groupBy("source", "load_id", "target", "folder").agg(
        F.max("replaces").alias("replaces"), F.min("run_ts").alias("run_ts"), F.max("committed_at").alias("committed_at"),
        F.max(F.coalesce("closed", F.lit(False))).alias("closed"))
    return per.where("not closed").drop("closed")


def _with_commits(ledger: DataFrame, state: DataFrame | None) -> DataFrame:
    """``ledger`` with ``committed_at`` from the state rows that carry a load's id."""
    if state is None:
        return ledger
    done = (state.where(F.col("load_id").isNotNull()).coalesce(1).groupBy(F.col("load_id").alias("_id"))
            .agg(F.min("run_ts").alias("_at")))
    return (ledger.join(done.hint("shuffle_hash"), F.col("load_id") == F.col("_id"), "left")
            .withColumn("committed_at", F.coalesce("committed_at", "_at")).drop("_id", "_at"))


def committed_loads(spark: SparkSession, state_path: str, state: DataFrame | None = None, wanted=None) -> DataFrame:
    """``(source, load_id, target, folder, replaces, run_ts, committed_at)`` of all committed loads."""
    from tidelake.operators.state import read_state

    ledger = _ledger(spark, state_path, wanted)
    if ledger is None:
        return spark.createDataFrame([], StructType.fromDDL(LEDGER)).drop("closed")
    state = state if state is not None else read_state(spark, state_path)
    return _with_commits(ledger, state).where(F.col("committed_at").isNotNull())


def visible_loads(spark: SparkSession, state_path: str, target: str, state: DataFrame | None = None) -> DataFrame:
    """The committed loads that make up ``target`` now: from its last replacing load on."""
    mine = committed_loads(spark, state_path, state, F.col("target") == target.rstrip("/"))
    cut = F.max(F.when(F.col("replaces"), F.col("committed_at"))).over(Window.partitionBy("target"))
    return mine.withColumn("_cut", cut).where(F.col("_cut").isNull() | (F.col("committed_at") >= F.col("_cut"))).drop("_cut")


def discard_unfinished(spark: SparkSession, state_path: str, sources, state: DataFrame | None = None) -> int:
    """Delete the folders of loads of ``sources`` that were never committed, and of versions that were
    replaced before the current one; returns how many.  Call it before any load of the run begins."""
    ledger = _ledger(spark, state_path, F.col("source").isin(sorted(set(sources))))
    if ledger is None:
        return 0
    cut = F.max(F.when(F.col("replaces"), F.col("committed_at"))).over(Window.partitionBy("target"))
    dead = _with_commits(ledger, state).withColumn("_cut", cut).where(
        F.col("committed_at").isNull() | (F.col("committed_at") < F.col("_cut")))
    found = dead.select("source", "load_id", "target", "folder").collect()  # crashed or replaced loads since the last run
    for r in found:
        p, fs = _path(spark, r["folder"])
        fs.delete(p, True)
    if found:
        _log(spark, state_path, [(r["source"], r["load_id"], r["target"], r["folder"], False, True) for r in found])
    return len(found)


def read_loads(spark: SparkSession, target: str, state_path: str, schema=None, fmt: str = "raw", **options) -> DataFrame:
    """A table made of loads: the rows of its visible loads, with ``date_part``.  ``schema`` (DDL) types
    raw text; without a visible load the result is empty and needs it."""
    from tidelake.sources.raw import read_raw

    loads = visible_loads(spark, state_path, target)
    ids = loads.select(F.col("load_id").alias("_id"))
    if path_exists(spark, target):
        df = (read_raw(spark, target, schema=schema, **options) if fmt == "raw"
              else spark.read.format(fmt).options(**options).load(target))
        if LOAD in df.columns:
            return df.join(ids, df[LOAD] == F.col("_id"), "left_semi").drop(LOAD)
    if schema is None:
        raise ValueError(f"no load in {target}")
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return spark.createDataFrame([], st).withColumn("date_part", F.lit(None).cast("date"))


def compact_ledger(spark: SparkSession, state_path: str, state: DataFrame | None) -> None:
    """Rewrite the ledger without closed loads, with the commit times of committed ones.  Run it, as
    :func:`tidelake.operators.state.compact_state` does, when no pipeline uses the state."""
    from tidelake.session import sibling_staging, swap_into_place

    ledger = _ledger(spark, state_path)
    if ledger is None:
        return
    lp = loads_path(state_path)
    staging = sibling_staging(lp)
    rows = _with_commits(ledger, state).withColumn("closed", F.lit(False))
    rows.select(*StructType.fromDDL(LEDGER).names).coalesce(1).write.parquet(staging)
    swap_into_place(spark, staging, lp)

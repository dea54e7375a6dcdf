"""Run report: one row per control row and outcome."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = ("app string, table_name string, mode string, status string, "
                 "n_files bigint, n_rows bigint, message string, seconds double")

# Outcome names.
OK, NO_NEW_DATA, FAILED, INVALID = "ok", "no_new_data", "failed", "invalid"


@dataclass
class Outcome:
    app: str
    table_name: str | None
    mode: str | None
    status: str
    n_files: int | None = None
    n_rows: int | None = None
    message: str | None = None
    seconds: float | None = None

    def row(self):
        return (self.app, self.table_name, self.mode, self.status,
                None if self.n_files is None else int(self.n_files),
                None if self.n_rows is None else int(self.n_rows), self.message,
                None if self.seconds is None else round(float(self.seconds), 3))


def timed(fn):
    """Wrap a per-table step so its Outcome (or each of a list) carries the elapsed wall-clock seconds."""
    import functools
    import time

    @functools.wraps(fn)
    def run(*args, **kwargs):
        t0 = time.perf_counter()
        out = fn(*args, **kwargs)
        for one in out if isinstance(out, list) else [out]:
            one.seconds = time.perf_counter() - t0
        return out
    return run


def report_frame(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    """Outcomes are per control row (configuration-sized), gathered on the driver."""
    from tidelake.session import local_frame

    return local_frame(spark, [o.row() for o in outcomes], REPORT_SCHEMA)


def summarize(report: DataFrame) -> DataFrame:
    """Per table and status: number of runs, files and rows."""
    return (report.groupBy("table_name", "status")
            .agg(F.count(F.lit(1)).alias("n_runs"),
                 F.sum("n_files").alias("n_files"), F.sum("n_rows").alias("n_rows")))

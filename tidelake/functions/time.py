"""Time functions: load dates, compact stamps and watermark cut-offs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compact stamp layout and the watermark used when none is stored yet.
STAMP_FORMAT = "yyyyMMddHHmmss"
DEFAULT_WATERMARK = dt.datetime(2000, 1, 1, 0, 0, 0)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def run_date_col(run_date=None) -> Column:
    """Load date as DATE: ``run_date`` (str / date) or today when omitted."""
    if run_date is None:
        return F.current_date()
    return F.lit(str(run_date)).cast("date")


def compact_stamp(ts) -> Column:
    return F.date_format(_col(ts), STAMP_FORMAT)


def parse_stamp(s) -> Column:
    return F.to_timestamp_ntz(_col(s), F.lit(STAMP_FORMAT))


def minute_cutoff(ts) -> Column:
    """Start of the minute after ``ts`` (hour / day carry handled by timestamp arithmetic)."""
    c = _col(ts)
    truncated = F.date_trunc("minute", c)
    return truncated + F.expr("INTERVAL 1 MINUTE")


def watermark_literal(value, dtype: str = "timestamp_ntz") -> Column:
    """A watermark as a literal of the manifest's timestamp type.

    A Python ``datetime`` compared with a zoned ``timestamp`` is passed as is: PySpark turns
    naive datetimes into instants with the same (system) zone it uses when collecting them,
    so a watermark read back from the state table compares exactly whatever the session
    time zone is.  For ``timestamp_ntz`` the wall-clock text is used (no zone involved).
    """
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, dt.datetime):
        if dtype == "timestamp":
            return F.lit(value)
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast(dtype)

"""Raw layer writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidelake.functions.text import BEL, NULL_MARKER
from tidelake.sources.raw import TIMESTAMP_TEXT


def write_raw(df: DataFrame, path: str, mode: str = "append", partition_by=None,
              sep: str = BEL, null_marker: str = NULL_MARKER, compression: str | None = None, **options):
    """Delimited raw sink: BEL-separated, NULL as ``\\N``, empty as empty, never quoted.

    Values are written as they are (no trimming of surrounding spaces).  Timestamps keep
    microseconds so a raw round trip is lossless.  A value that itself holds
    the separator or a line break cannot be carried by this format (as in the source system).
    """
    w = (df.write.mode(mode)
         .options(sep=sep, nullValue=null_marker, emptyValue="", quote="", escapeQuotes=False,
                  header=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                  timestampNTZFormat=TIMESTAMP_TEXT, timestampFormat=TIMESTAMP_TEXT,
                  dateFormat="yyyy-MM-dd", **options))
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.csv(path)


def write_lines(df: DataFrame, path: str, mode: str = "append", partition_by=None,
                compression: str | None = None, **options):
    """Text sink for already-formatted lines (single string column plus partition columns)."""
    w = df.write.mode(mode).options(**options)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.text(path)

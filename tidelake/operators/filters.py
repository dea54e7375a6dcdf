"""Manifest filters: watermark cut-offs, empty files, name prefixes, newest file.

A manifest is any DataFrame with a file name, a length and a modification time, e.g. the
output of :func:`tidelake.sources.listing.list_files`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.time import minute_cutoff, watermark_literal


def _wm(manifest: DataFrame, ts_col: str, watermark) -> Column:
    dtype = manifest.schema[ts_col].dataType.simpleString()
    return watermark_literal(watermark, dtype)


def files_newer_than(manifest: DataFrame, watermark, ts_col: str = "modified") -> DataFrame:
    """Strictly newer than the watermark (second precision stamps compare the same way)."""
    return manifest.where(F.col(ts_col) > _wm(manifest, ts_col, watermark))


def files_newer_than_minute(manifest: DataFrame, watermark, ts_col: str = "modified") -> DataFrame:
    """Minute-precision variant: newer than the start of the minute after the watermark."""
    dtype = manifest.schema[ts_col].dataType.simpleString()
    cut = minute_cutoff(_wm(manifest, ts_col, watermark)).cast(dtype)
    return manifest.where(F.col(ts_col) > cut)


def files_non_empty(manifest: DataFrame, length_col: str = "length") -> DataFrame:
    return manifest.where(F.col(length_col) > 0)


def files_with_prefix(manifest: DataFrame, prefix: str, name_col: str = "file_name") -> DataFrame:
    return manifest.where(F.col(name_col).startswith(prefix))


def latest_file(manifest: DataFrame, ts_col: str = "modified",
                name_col: str = "file_name") -> DataFrame:
    """Newest file; ties on the stamp go to the greatest name (numeric sort, keep last)."""
    return manifest.orderBy(F.col(ts_col).desc(), F.col(name_col).desc()).limit(1)

"""Text functions for control-character-delimited lake files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the raw text format (must equal the lake's for right results):
# field separator BEL (U+0007), NULL written as backslash + N, no quoting.
BEL = "\u0007"
NULL_MARKER = "\\N"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_regex(s: str) -> str:
    """Java regex matching ``s`` literally."""
    return "\\Q" + s + "\\E"


def repair_escaped_breaks(c) -> Column:
    """Backslash followed by CRLF, LF or CR -> backslash + space.

    CRLF is tried first so that a Windows line break is consumed whole.
    """
    return F.regexp_replace(_col(c), r"\\(\r\n|\n|\r)", r"\\ ")


def split_exact(c, sep: str = BEL) -> Column:
    """Split keeping every field, trailing empty ones included."""
    return F.split(_col(c), literal_regex(sep), -1)


def join_fields(c, sep: str = BEL) -> Column:
    return F.array_join(_col(c), sep)


def before_first(c, sep: str = "|") -> Column:
    """Text before the first ``sep`` (all of it when absent)."""
    return F.substring_index(_col(c), sep, 1)


def after_last(c, sep: str = "|") -> Column:
    """Text after the last ``sep`` (all of it when absent)."""
    return F.substring_index(_col(c), sep, -1)


def basename(c) -> Column:
    return F.substring_index(_col(c), "/", -1)


def default_if_blank(c, default) -> Column:
    """NULL, empty or blank -> ``default`` (a Column or a literal)."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(F.trim(_col(c)), F.lit("")), d)


def pipe_line(*cols, sep: str = "|") -> Column:
    """Row display: values joined by ``|``, NULL shown as ``null``."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("null")) for c in cols])

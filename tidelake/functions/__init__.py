"""Column functions (all JVM-side built-ins, usable inside whole-stage codegen)."""

from tidelake.functions.text import (
    BEL,
    NULL_MARKER,
    after_last,
    basename,
    before_first,
    default_if_blank,
    join_fields,
    pipe_line,
    repair_escaped_breaks,
    split_exact,
)
from tidelake.functions.time import (
    DEFAULT_WATERMARK,
    STAMP_FORMAT,
    compact_stamp,
    minute_cutoff,
    parse_stamp,
    run_date_col,
)

__all__ = [
    "BEL", "NULL_MARKER", "after_last", "basename", "before_first", "default_if_blank",
    "join_fields", "pipe_line", "repair_escaped_breaks", "split_exact",
    "DEFAULT_WATERMARK", "STAMP_FORMAT", "compact_stamp", "minute_cutoff", "parse_stamp",
    "run_date_col",
]

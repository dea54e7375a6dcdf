"""Sinks: raw delimited text, cleansed Avro, snapshot / append / partition-replace writes,
load folders committed by the state, and catalog tables."""

from tidelake.sinks.loads import commit_load, open_load, read_loads
from tidelake.sinks.raw import write_lines, write_raw
from tidelake.sinks.tables import (
    AVRO,
    replace_snapshot,
    write_catalog_table,
    write_cleansed,
)

__all__ = ["open_load", "commit_load", "read_loads", "write_lines", "write_raw", "AVRO", "replace_snapshot",
           "write_catalog_table", "write_cleansed"]

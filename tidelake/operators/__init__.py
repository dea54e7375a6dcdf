"""Operators on manifests, control tables, state tables and raw text."""

from tidelake.operators.filters import (
    files_newer_than,
    files_newer_than_minute,
    files_non_empty,
    files_with_prefix,
    latest_file,
)
from tidelake.operators.increments import (
    append_increment,
    increment_bounds,
    lastmodified_increment,
    read_increment,
)
from tidelake.operators.repair import repair_escaped_lines, repair_documents
from tidelake.operators.routing import route_all_matches, route_first_match
from tidelake.operators.state import (
    advance_watermarks,
    compact_state,
    current_watermarks,
    seed_from_state,
    watermarks_with_default,
)
from tidelake.operators.validate import validate_file_control, validate_table_control

__all__ = [
    "files_newer_than", "files_newer_than_minute", "files_non_empty", "files_with_prefix",
    "latest_file", "increment_bounds", "lastmodified_increment", "append_increment",
    "read_increment", "compact_state",
    "repair_escaped_lines", "repair_documents", "route_all_matches", "route_first_match",
    "advance_watermarks", "current_watermarks", "seed_from_state", "watermarks_with_default",
    "validate_file_control", "validate_table_control",
]

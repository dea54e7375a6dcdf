"""Sources: raw delimited text, whole documents, file listings, archives, relational
tables, control tables and catalog tables."""

from tidelake.sources.control import read_control
from tidelake.sources.listing import list_files
from tidelake.sources.raw import read_documents, read_raw, read_raw_lines

__all__ = ["read_control", "list_files", "read_documents", "read_raw", "read_raw_lines"]

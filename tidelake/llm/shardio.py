"""Files that executors write and read next to Spark's own tables."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs as pafs


def at(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (pafs.LocalFileSystem(), uri)


def local_uri(uri: str) -> str:
    """``file:/x`` as ``file:///x``; other URIs unchanged."""
    return "file:///" + uri[5:].lstrip("/") if uri.startswith("file:") else uri


def make_folder(uri: str) -> None:
    fs, path = at(local_uri(uri))
    fs.create_dir(path, recursive=True)


def open_write(uri: str):
    fs, path = at(local_uri(uri))
    return fs.open_output_stream(path)


def open_read(uri: str):
    """A random-access file; memory-mapped (zero-copy) where the store is a mounted file system."""
    fs, path = at(local_uri(uri))
    return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)

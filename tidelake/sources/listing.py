"""File listings (manifests), without reading file content: by Spark's file index, which the driver
holds, or by the tasks, for folders of any size; and the lines of the files of a manifest."""

from __future__ import annotations

import gzip
import os
import re
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.text import basename
from tidelake.session import is_local_path, local_frame, local_os_path, scratch_path
from tidelake.sources.archives import READ_BYTES, arrow_fs, open_binary


def glob_escape(s: str) -> str:
    return re.sub(r"([\[\]\{\}\*\?\\])", r"\\\1", s)


def list_files(spark: SparkSession, path, pattern: str | None = None,
               recursive: bool = False, modified_after=None) -> DataFrame:
    """Manifest ``(path, file_name, length, modified)`` of the files under ``path``.

    ``pattern`` keeps names starting with it (``pattern*``), ``recursive`` walks all
    sub-folders, ``modified_after`` (strict) is handed to the file index so old files are
    skipped before any task runs.  The ``content`` column of ``binaryFile`` is never
    selected, so no file body is read.
    """
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", glob_escape(pattern) + "*")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if modified_after is not None:
        # the option takes whole seconds, read in the session time zone
        text = (modified_after.strftime("%Y-%m-%dT%H:%M:%S") if hasattr(modified_after, "strftime")
                else str(modified_after).replace(" ", "T")[:19])
        reader = reader.option("modifiedAfter", text)
    df = reader.load(path)
    return df.select(
        F.col("path"),
        basename("path").alias("file_name"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )


LISTED = "path string, file_name string, length bigint, us bigint, folder boolean"
LISTING_ROWS = 8192


def _entries(folder: str):
    """``(name, length, modified in microseconds, is a folder)`` of a folder, as it is read: a local
    folder of any size is never held whole."""
    if is_local_path(folder):
        with os.scandir(local_os_path(folder)) as found:
            for e in found:
                try:
                    st = e.stat()
                except FileNotFoundError:  # gone since
                    continue
                yield e.name, st.st_size, st.st_mtime_ns // 1_000_000 * 1000, e.is_dir()
        return
    from pyarrow import fs as pafs

    filesystem, inner = arrow_fs(folder)
    for info in filesystem.get_file_info(pafs.FileSelector(inner, recursive=False)):
        yield info.base_name, info.size or 0, (info.mtime_ns or 0) // 1_000_000 * 1000, info.type == pafs.FileType.Directory


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _list_folders(batches):
    names = ["path", "file_name", "length", "us", "folder"]
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            entries = ((f"{folder.rstrip('/')}/{n}", n, size, us, sub) for n, size, us, sub in _entries(folder) if not _hidden(n))
            while rows := list(islice(entries, LISTING_ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)


def list_folders(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False,
                 stored: bool = True) -> DataFrame:
    """The manifest of :func:`list_files`, made by the tasks and written as Parquet (without ``stored``, one
    folder is listed whenever the result is read): folders are dealt to
    tasks, those found in them are the next round's.  The driver holds neither file names nor a file
    index, only the number of folders of each round; a folder is streamed, not held.  ``path`` may be a
    glob; it must be reachable from Python workers (local, HDFS, S3 and the like)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    roots = [st.getPath().toString() for st in fs.globStatus(p) or [] if st.isDirectory()]
    if not roots:
        raise FileNotFoundError(path)
    rounds, folders, n = [], local_frame(spark, [(r,) for r in roots], "path string"), len(roots)
    while n:
        tasks = max(1, min(n, 4 * spark.sparkContext.defaultParallelism))
        out = scratch_path(spark, "listing")
        found = folders.select("path").repartition(tasks).mapInArrow(_list_folders, LISTED)
        if stored or recursive:
            found.write.parquet(out)
            found = spark.read.schema(LISTED).parquet(out)
        rounds.append(found.where("not folder"))
        folders = found.where("folder")
        n = folders.count() if recursive else 0
    files = reduce(DataFrame.unionByName, rounds)
    if pattern:
        files = files.where(F.col("file_name").startswith(pattern))
    return files.select("path", "file_name", "length", F.timestamp_micros("us").alias("modified"))


def _unchanged(path: str, length: int, us: int) -> bool:
    """Whether a file is still the one that was listed."""
    if is_local_path(path):
        try:
            st = os.stat(local_os_path(path))
        except FileNotFoundError:
            return False
        return (st.st_size, st.st_mtime_ns // 1_000_000 * 1000) == (length, us)
    filesystem, inner = arrow_fs(path)
    info = filesystem.get_file_info(inner)
    return (info.size, (info.mtime_ns or 0) // 1_000_000 * 1000) == (length, us)


def _line_start(fh, start: int) -> int | None:
    """Where the first line that begins at ``start`` or later begins, or None."""
    if start == 0:
        return 0
    fh.seek(start - 1)
    at = start - 1
    while block := fh.read(READ_BYTES):
        cut = block.find(b"\n")
        if cut >= 0:
            return at + cut + 1
        at += len(block)
    return None


def _blocks(fh, size: int | None):
    """The next ``size`` bytes (None: all there are) in blocks."""
    while size is None or size > 0:
        block = fh.read(READ_BYTES if size is None else min(READ_BYTES, size))
        if not block:
            return
        size = None if size is None else size - len(block)
        yield block


def _part_blocks(path: str, start: int, stop: int):
    """The lines that begin in [start, stop), in blocks without their last line feed."""
    with open_binary(path) as fh:
        if path.lower().endswith(".gz"):
            raw, size = gzip.GzipFile(fileobj=fh), None
        else:
            at = _line_start(fh, start)
            if at is None or at >= stop:
                return
            fh.seek(at)
            raw, size = fh, stop - at
        carry = []
        for block in _blocks(raw, size):
            last = block.rfind(b"\n")
            if last < 0:
                carry.append(block)
                continue
            yield b"".join(carry) + block[:last]
            carry = [block[last + 1:]]
        if not any(carry):
            return
        for block in _blocks(raw, None):  # the rest of a line that began before ``stop``
            cut = block.find(b"\n")
            carry.append(block if cut < 0 else block[:cut])
            if cut >= 0:
                break
        yield b"".join(carry)


def line_array(block: bytes) -> pa.Array:
    """The lines of a block as they are, byte for byte, without a CR before the line feed."""
    data = block + b"\n"
    if b"\r" in data:
        data = data.replace(b"\r\n", b"\n")
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data.replace(b"\n", b"")))


def _read_parts(as_listed: bool):
    def run(batches):
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for path, length, us, start, stop, tag in zip(*cols):
                if as_listed and not _unchanged(path, length, us):
                    continue
                for block in _part_blocks(path, start, stop):
                    lines = line_array(block)
                    yield pa.RecordBatch.from_arrays([lines, pa.array([tag] * len(lines), pa.int32())], names=["value", "tag"])
    return run


def manifest_lines(files: DataFrame, tag: str | None = None, part_bytes: int = 64 << 20, as_listed: bool = True) -> DataFrame:
    """``(value, tag)``: the lines of the files of a manifest, read by the tasks without a file index;
    ``tag`` names an integer column to carry along.  Plain files are cut into ranges of ``part_bytes``,
    a gzip file is one task's.  A file that changed since it was listed gives no lines: its new stamp
    brings it up in the next run (with ``as_listed=False``, for pickers that know files by name alone, what
    the listed length covers is read all the same)."""
    tagged = (F.col(tag) if tag else F.lit(None)).cast("int").alias("tag")
    whole = F.lower("path").endswith(".gz")
    starts = F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(part_bytes).cast("long")))
    parts = files.select("path", "length", F.unix_micros("modified").alias("us"), F.explode(starts).alias("start"), whole.alias("w"), tagged)
    stop = F.when(F.col("w"), F.col("length")).otherwise(F.least(F.col("start") + part_bytes, F.col("length")))
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = parts.select("path", "length", "us", "start", stop.alias("stop"), "tag").repartition(n, "path", "start")
    return spread.mapInArrow(_read_parts(as_listed), "value string, tag int")


def listing_line(manifest: DataFrame, ts_col: str = "modified",
                 name_col: str = "file_name") -> DataFrame:
    """Bucket-listing projection: ``YYYYMMDDHHMMSS|name`` per object."""
    from tidelake.functions.time import compact_stamp

    return manifest.select(F.concat_ws("|", compact_stamp(ts_col), F.col(name_col)).alias("line"))

"""Compressed drops.

* gzip: decompressed by suffix, one task per file, since gzip cannot be split (Spark's text and
  CSV sources, and :func:`tidelake.sources.listing.manifest_lines`).
* zip: Hadoop has no zip codec.  Archives are opened on executors: one pass lists the
  members of each archive (central directory only), the member list is routed and
  re-partitioned so that members spread over tasks, and a second pass streams the lines
  out in Arrow batches.  A deflated member can only be read from its start, so each is
  inflated once, by one task, block by block: it never becomes one value, and a task's
  memory does not grow with it.
"""

from __future__ import annotations

import lzma
import zipfile
import zlib
from itertools import chain, groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.session import is_local_path, local_os_path, qualified

MEMBER_SCHEMA = "archive string, member string, position int, member_size bigint"
LINE_SCHEMA = "archive string, member string, line_no bigint, value string, error string"
DAMAGE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, NotImplementedError, RuntimeError, OSError)
BATCH_LINES = 8192
DIRECTORY_SCHEMA = MEMBER_SCHEMA + ", error string, modified timestamp"


def arrow_fs(path: str):
    from pyarrow import fs as pafs

    # Hadoop's S3 connector schemes name the same store pyarrow calls s3
    for scheme in ("s3a://", "s3n://"):
        if path.startswith(scheme):
            path = "s3://" + path[len(scheme):]
    return pafs.FileSystem.from_uri(path)


def open_binary(path: str):
    """Random-access binary handle for a local or cluster file system path."""
    if is_local_path(path):
        return open(local_os_path(path), "rb")
    filesystem, inner = arrow_fs(path)
    return filesystem.open_input_file(inner)


def _signed(path: str) -> bool:
    with open_binary(path) as fh:
        return fh.read(2) == b"PK"


def _list_members(batches):
    cols = ["archive", "member", "position", "member_size", "error", "modified"]
    for pdf in batches:
        rows = []
        for archive, modified in zip(pdf["archive"], pdf["modified"]):
            try:
                with open_binary(archive) as fh, zipfile.ZipFile(fh) as zf:
                    for i, info in enumerate(zf.infolist()):
                        if info.flag_bits & 1:
                            raise zipfile.BadZipFile(f"member {info.filename} is encrypted")
                        if not info.is_dir():
                            rows.append((archive, info.filename, i, info.file_size, None, modified))
                            if len(rows) >= BATCH_LINES:
                                yield pd.DataFrame(rows, columns=cols).astype({"position": "Int32", "member_size": "Int64"})
                                rows = []
            except (zipfile.BadZipFile, EOFError) as e:
                if archive.lower().endswith(".zip") or _signed(archive):  # damaged; other files are no archives
                    rows.append((archive, None, None, None, f"{archive}: {e}", modified))
        if rows:
            yield pd.DataFrame(rows, columns=cols).astype({"position": "Int32", "member_size": "Int64"})


READ_BYTES = 1 << 20


def member_line_batches(raw):
    """Lines of a member stream in blocks: ``(first_line_no, lines)``.  Blocks are split and
    decoded with single C-level calls.  Lines end at LF; a CR before the LF is dropped."""
    line_no, carry = 0, []
    while block := raw.read(READ_BYTES):
        last = block.rfind(b"\n")
        if last < 0:
            carry.append(block)  # joined once, when the line ends
            continue
        parts = (b"".join(carry) + block[:last]).split(b"\n")
        carry = [block[last + 1:]]
        yield line_no, decoded_lines(parts)
        line_no += len(parts)
    rest = b"".join(carry)
    if rest:
        yield line_no, decoded_lines([rest])


def decoded_lines(parts: list) -> list:
    joined = b"\n".join(parts)
    text = joined.decode("utf-8", errors="replace").split("\n")
    if b"\r" in joined:
        text = [t[:-1] if t.endswith("\r") else t for t in text]
    return text


def _member_lines_fn(extra, with_lines=True):
    def run(batches):
        for pdf in batches:
            for archive, group in pdf.groupby("archive", sort=False):
                with open_binary(archive) as fh, zipfile.ZipFile(fh) as zf:
                    infos = zf.infolist()
                    for rec in group.itertuples(index=False):
                        tags = {c: getattr(rec, c) for c in extra}
                        try:
                            # by position: names may repeat
                            with zf.open(infos[int(rec.position)]) as raw:
                                for first, lines in member_line_batches(raw):
                                    for i in range(0, len(lines) if with_lines else 0, BATCH_LINES):
                                        chunk = lines[i:i + BATCH_LINES]
                                        nos = range(first + i, first + i + len(chunk))
                                        yield _lines_frame(archive, rec.member, nos, chunk, tags)
                        except DAMAGE as e:
                            yield _lines_frame(archive, rec.member, [-1], [None], tags, f"{archive}: {rec.member}: {e}")
    return run


def _lines_frame(archive, member, line_nos, lines, tags, error=None):
    n = len(lines)
    cols = {"archive": [archive] * n, "member": [member] * n, "line_no": line_nos, "value": lines, "error": [error] * n}
    for c, v in tags.items():
        cols[c] = [v] * n
    return pd.DataFrame(cols)


def zip_directory(archives: DataFrame, path_col: str = "path") -> DataFrame:
    """``(archive, member, position, member_size, error, modified)``: a row for every file inside each
    archive, by its position there, or one row with ``error`` for an archive (by name or signature)
    that cannot be read or holds encrypted members."""
    modified = F.col("modified") if "modified" in archives.columns else F.lit(None).cast("timestamp").alias("modified")
    return archives.select(F.col(path_col).alias("archive"), modified).mapInPandas(_list_members, DIRECTORY_SCHEMA)


def zip_members(archives: DataFrame, path_col: str = "path") -> DataFrame:
    """``(archive, member, position, member_size)`` for every file inside each readable archive; see
    :func:`zip_directory` for the others."""
    return zip_directory(archives, path_col).where("error is null").drop("error", "modified")


def zip_member_lines(members: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Lines of the given members: ``(archive, member, line_no, value, error)`` plus any other
    string columns of ``members`` (e.g. the routed table name), carried along per member.  A member
    that breaks off or is damaged gives a last row with ``error``.
    Members are hash-spread over ``num_partitions`` tasks (default: shuffle partitions)."""
    return _over_members(members, num_partitions, True)


def damaged_members(members: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``(archive, member, error)`` of members that cannot be read to their end: reads them all."""
    return _over_members(members, num_partitions, False).select("archive", "member", "error")


def _over_members(members: DataFrame, num_partitions: int | None, with_lines: bool) -> DataFrame:
    n = num_partitions or int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    extra = [c for c in members.columns if c not in ("archive", "member", "position", "member_size")]
    wanted = members.select("archive", "member", "position", *[F.col(c).cast("string") for c in extra])
    schema = LINE_SCHEMA + "".join(f", {c} string" for c in extra)
    return wanted.repartition(n, "archive", "position").mapInPandas(_member_lines_fn(extra, with_lines), schema)


def open_output(path: str):
    """Writable binary handle for a local or cluster file system path."""
    if is_local_path(path):
        import os

        p = local_os_path(path)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        return open(p, "wb")
    filesystem, inner = arrow_fs(path)
    return filesystem.open_output_stream(inner)


def _pack_fn(out_dir: str, suffix: str, run_tag: str):
    """Writes a task's lines, sorted by table, member after member as they come."""
    def run(batches):
        from pyspark import TaskContext

        rows = ((t, v) for pdf in batches for t, v in zip(pdf["table_name"], pdf["value"]))
        first = next(rows, None)
        if first is None:
            return
        # named by partition: a retried or speculative attempt rewrites the same archive
        tag = f"{run_tag}_{TaskContext.get().partitionId():05d}"
        archive, done = f"{out_dir.rstrip('/')}/drop_{tag}.zip", []
        with open_output(archive) as fh, zipfile.ZipFile(fh, "w", zipfile.ZIP_DEFLATED) as zf:
            for table, lines in groupby(chain([first], rows), key=lambda r: r[0]):
                member, n = f"{table}_{tag}{suffix}", 0
                with zf.open(member, "w", force_zip64=True) as out:
                    for _, value in lines:
                        out.write(value.encode() + b"\n")
                        n += 1
                done.append((archive, member, n))
        yield pd.DataFrame(done, columns=["archive", "member", "n_lines"])
    return run


def pack_zip_drops(lines: DataFrame, out_dir: str, num_archives: int | None = None,
                   suffix: str = ".txt") -> DataFrame:
    """Write ``(table_name, value)`` lines as zip drops, each archive holding one member per
    table (``<table>_<tag><suffix>``).  By default there is one archive per input partition,
    so archive size follows the split size, not the data size.  Returns the member list
    ``(archive, member, n_lines)``; evaluating it writes the archives."""
    import uuid

    n = num_archives or lines.rdd.getNumPartitions()
    spread = lines.select("table_name", "value").repartition(max(1, int(n))).sortWithinPartitions("table_name")
    return spread.mapInPandas(_pack_fn(qualified(lines.sparkSession, out_dir), suffix, uuid.uuid4().hex[:8]),
                              "archive string, member string, n_lines bigint")

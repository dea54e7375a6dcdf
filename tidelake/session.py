"""Session helpers: where scratch data goes and the few settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and stream checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (a shared file system
    or object store path); a cluster session that names none is refused, because a folder of
    the driver's machine is not what executors see.  Only a ``local`` master without the
    setting gets a local folder, registered as the checkpoint dir so that ``checkpoint()``
    works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidelake-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the scratch root (nothing is created yet)."""
    return f"{scratch_root(spark)}/tidelake/{name}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system (the session's default one for ``/x``)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_os_path(path: str) -> str:
    """``file:/x``, ``file:///x`` or ``/x`` -> ``/x``."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def sibling_staging(path: str) -> str:
    """Staging folder next to ``path`` (same file system, so it can be renamed into place)."""
    return f"{path.rstrip('/')}.__staging-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def move_path(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename ``src`` to ``dst`` on the cluster file system (parents created); False when
    ``src`` does not exist."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(conf)
    if not fs.exists(s):
        return False
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"cannot move {src} to {dst}")
    return True


def swap_into_place(spark: SparkSession, staging: str, target: str):
    """Replace ``target`` by the fully written ``staging`` folder with file-system renames
    (a metadata operation on HDFS-like stores), so readers never see a half-written table."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(staging), jvm.org.apache.hadoop.fs.Path(target)
    fs = dst.getFileSystem(conf)
    old = None
    if fs.exists(dst):
        old = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.__old-{uuid.uuid4().hex[:12]}")
        if not fs.rename(dst, old):
            raise OSError(f"cannot move {target} aside")
    else:
        fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        if old is not None:
            fs.rename(old, dst)
        raise OSError(f"cannot move {staging} to {target}")
    if old is not None:
        fs.delete(old, True)


def recover_target(spark: SparkSession, target: str) -> None:
    """Before writing to ``target``: undo a swap that a dead driver left half done (target
    moved aside, replacement not yet in place: the old folder comes back, the interrupted
    load simply runs again) and delete staging / moved-aside siblings of loads that never
    finished.  A run calls it once per target, before any of its own loads begins (another
    load's staging folder in mid-write would otherwise be taken for a dead one)."""
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    dst = Path(target)
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = target.rstrip("/")

    def siblings(tag):
        found = fs.globStatus(Path(f"{base}.__{tag}-*"))
        return sorted(found or [], key=lambda st: st.getModificationTime())

    olds = siblings("old")
    if olds and not fs.exists(dst):
        fs.rename(olds[-1].getPath(), dst)
        olds = olds[:-1]
    for st in olds + siblings("staging"):
        fs.delete(st.getPath(), True)


def local_table(rows, ddl: str):
    """Driver-side rows as an Arrow table, and for each column whether Spark has to cast it still (a number
    given as text).  Naive stamps are the driver's local time."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StringType, StructType, TimestampType

    schema = StructType.fromDDL(ddl)
    columns, texts = [], []
    for field, values in zip(schema.fields, zip(*rows)):
        if isinstance(field.dataType, TimestampType):
            values = [v.astimezone() if hasattr(v, "astimezone") else v for v in values]
        try:
            columns.append(pa.array(values, to_arrow_type(field.dataType)))
            texts.append(False)
        except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError):
            columns.append(pa.array([None if v is None else str(v) for v in values], to_arrow_type(StringType())))
            texts.append(True)
    return pa.Table.from_arrays(columns, names=schema.names), texts


def local_frame(spark: SparkSession, rows, ddl: str):
    """A small DataFrame from driver-side rows (control rows, report rows, state rows), handed
    over as one Arrow table, so its cost does not grow with an expression per value.  Values
    that do not fit their column's type as they are (a number given as text) are cast by
    Spark.  Only for configuration-sized data."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], schema)
    table, _ = local_table(rows, ddl)
    return spark.createDataFrame(table).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def append_rows(spark: SparkSession, path: str, rows, ddl: str) -> None:
    """Append a few driver-side rows to the Parquet folder ``path``: one small file that appears at once,
    without a Spark job."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    table, texts = local_table(rows, ddl)
    if any(texts):
        raise TypeError(f"rows do not fit {ddl}")
    out = pa.BufferOutputStream()
    pq.write_table(table, out)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder, name = Path(path), f"part-{uuid.uuid4().hex}.parquet"
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    stream = fs.create(Path(folder, f"_{name}"), True)
    stream.write(bytearray(out.getvalue().to_pybytes()))
    stream.close()
    if not fs.rename(Path(folder, f"_{name}"), Path(folder, name)):
        raise OSError(f"cannot write {path}/{name}")


def today(spark: SparkSession) -> str:
    """The session's current date (``YYYY-MM-DD``), fixed once so that every table of a run
    is stamped with the same load date even when the run crosses midnight."""
    from pyspark.sql import functions as F

    return spark.range(1).select(F.date_format(F.current_date(), "yyyy-MM-dd")).first()[0]

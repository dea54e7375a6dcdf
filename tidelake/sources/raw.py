"""Raw layer readers.

A raw table is a directory of text files: one record per line, fields separated by BEL,
no header, no quoting, ``\\N`` for NULL, usually below ``date_part=YYYY-MM-DD`` folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake.functions.text import BEL, NULL_MARKER, split_exact

# Fixed value: text layout of timestamps in raw files (microseconds kept).
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _as_schema(spark: SparkSession, schema) -> StructType | None:
    if schema is None or isinstance(schema, StructType):
        return schema
    return StructType.fromDDL(schema)


def read_raw_lines(spark: SparkSession, path, **options) -> DataFrame:
    """Lines of the raw files as ``value`` plus any discovered partition columns."""
    reader = spark.read.format("text")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def _typed_date_part(df: DataFrame) -> DataFrame:
    """A ``date_part`` folder that is not a date (e.g. ``2018-09-47``) makes partition
    discovery fall back to strings for every folder; keep the column a DATE and give rows of
    invalid folders NULL instead."""
    if "date_part" in df.columns and dict(df.dtypes)["date_part"] == "string":
        return df.withColumn("date_part", F.col("date_part").try_cast("date"))
    return df


def read_raw(
    spark: SparkSession,
    path,
    schema=None,
    sep: str = BEL,
    null_marker: str | None = NULL_MARKER,
    exact: bool = True,
    rejects: str | None = None,
    **options,
) -> DataFrame:
    """Delimited raw scan.

    Without ``schema`` every field is a string named ``_c0.._cN``, as many as the widest line
    has (one pass over the text), so fields that later files added are kept; with a schema
    (StructType or DDL) fields are converted with ``try_cast`` so a bad value becomes NULL
    instead of failing the job.  ``rejects="name"`` adds an array column of that name with the
    names of the fields whose text could not be converted (empty when all could).

    ``exact=True`` (default) splits the text line itself, so an empty field stays ``''``
    and only the null marker becomes NULL.  ``exact=False`` uses Spark's CSV source, which
    also maps empty fields to NULL.  ``null_marker=None`` keeps ``\\N`` as text.
    Partition columns found in the directory layout (``date_part=...``) are kept.
    """
    st = _as_schema(spark, schema)
    if not exact:
        reader = spark.read.options(sep=sep, header=False, quote="", escape="",
                                    timestampNTZFormat=TIMESTAMP_TEXT,
                                    timestampFormat=TIMESTAMP_TEXT, dateFormat="yyyy-MM-dd")
        if null_marker is not None:
            reader = reader.option("nullValue", null_marker)
        for k, v in options.items():
            reader = reader.option(k, v)
        if st is not None:
            reader = reader.schema(st)
        return _typed_date_part(reader.csv(path))

    lines = _typed_date_part(read_raw_lines(spark, path, **options))
    if st is None:
        width = lines.agg(F.max(F.size(split_exact("value", sep)))).first()[0] or 0
        st = StructType.fromDDL(", ".join(f"_c{i} string" for i in range(width))) if width else StructType()
    return parse_raw_lines(lines, st, sep=sep, null_marker=null_marker, rejects=rejects)


def parse_raw_lines(lines: DataFrame, schema, sep: str = BEL,
                    null_marker: str | None = NULL_MARKER, rejects: str | None = None) -> DataFrame:
    """Fields of raw lines (column ``value``) as typed columns; other columns (partition
    columns) are kept.  Works on batch and streaming DataFrames alike."""
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    part_cols = [c for c in lines.columns if c != "value"]
    f = F.col("_f")
    cols, bad = [], []
    for i, fld in enumerate(st.fields):
        v = F.get(f, i)
        if null_marker is not None:
            v = F.when(v != F.lit(null_marker), v)
        if fld.dataType.simpleString() != "string":
            text, v = v, v.try_cast(fld.dataType)
            bad.append(F.when(text.isNotNull() & v.isNull(), F.lit(fld.name)))
        cols.append(v.alias(fld.name))
    if rejects:
        none = F.array().cast("array<string>")
        cols.append((F.array_compact(F.array(*bad)) if bad else none).alias(rejects))
    return lines.select(split_exact("value", sep).alias("_f"), *part_cols).select(*cols, *part_cols)


# Fixed value: names of files that the text source decompresses; their size is not their content's.
COMPRESSED = r"\.(?:gz|bz2|zst|lz4|snappy|deflate)$"


def read_documents(spark: SparkSession, path, lines: bool = False) -> DataFrame:
    """Whole-file scan: one row per file, ``(file_path, content)``.

    A file is one value, so it must fit in one row (< 2 GB) and is read by one task.  ``lines=True``
    gives the same content in rows of a line, a file of any size spread over its splits:
    ``(file_path, block_start, file_size, octets, cr, value)``, in file order within a split.
    A line ends with CRLF, LF or CR; ``cr`` says that a CR ends it.  What lies between two LF is read as one
    row: its first line has in ``octets`` its bytes and one for the LF, though a file's last LF may be missing,
    and its other lines 0.  ``file_size`` is null where it does not count the content (compressed files).
    """
    if not lines:
        return (spark.read.text(path, wholetext=True)
                .select(F.col("_metadata.file_path").alias("file_path"),
                        F.col("value").alias("content")))
    m = "_metadata."
    text = F.col("value")
    cr = F.endswith(text, F.lit("\r"))
    size = F.when(~F.col(m + "file_path").rlike(COMPRESSED), F.col(m + "file_size"))
    stretch = spark.read.text(path, lineSep="\n").select(
        F.col(m + "file_path").alias("file_path"), F.col(m + "file_block_start").alias("block_start"),
        size.alias("file_size"), (F.octet_length(text) + 1).cast("long").alias("octets"),
        F.split(F.make_valid_utf8(F.when(cr, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)), "\r", -1)
        .alias("lines"), cr.alias("cr"))
    return (stretch.select("*", F.posexplode("lines").alias("at", "value"))
            .select("file_path", "block_start", "file_size", F.when(F.col("at") == 0, F.col("octets")).otherwise(0).alias("octets"),
                    (F.col("cr") | (F.col("at") < F.size("lines") - 1)).alias("cr"), "value"))

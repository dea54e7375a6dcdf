"""Repair of escaped line breaks in raw text.

In a landed file a field may hold a backslash followed by a line break; the break is data,
not a record end.  Repair joins such lines, replacing backslash + break with backslash +
space, so each record is one line again.

``repair_escaped_lines`` works line by line on Spark's splittable text scan, so a file of
any size is spread over many tasks:

1. one ordered pass over each split joins its lines and emits every record that begins and ends
   in it; nothing of these is shuffled;
2. what may belong to a record across a split border, the lines up to the first record end of a
   split that is not its file's first, and the open record at its end, comes out of a second scan
   as at most two fragments per split; these few rows are stitched per file in order.

``repair_documents`` is the whole-file form: the same pass over the lines of whole files, with each record's
number in its file (a row per split says how many records begin before it).
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.functions.text import repair_escaped_breaks
from tidelake.sources.raw import read_documents

RECORDS = "file_path string, block_start bigint, line_seq bigint, value string"
FRAGMENTS = RECORDS + ", open boolean"
DOCUMENT = FRAGMENTS + ", octets bigint, cr boolean, file_size bigint, blank boolean"  # these of a split's own row


def _split_pass(fragments: bool):
    """A task's splits, line by line: its finished records, or its border fragments."""
    def run(batches):
        split, seq, held, at, head = None, 0, [], 0, True  # ``held``: lines of the record in progress
        out: list[tuple] = []

        def flush(is_open: bool):
            border = is_open or (head and split[1] > 0)
            if border == fragments:
                out.append((*split, at, " ".join(held), is_open) if fragments else (*split, at, " ".join(held)))

        def frame():
            cols = list(zip(*out)) or [()] * (5 if fragments else 4)
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            names = ["file_path", "block_start", "line_seq", "value", "open"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names[:len(cols)])

        for batch in batches:
            files, blocks, values = (batch.column(i) for i in range(3))
            cont = pc.ends_with(values, "\\").to_pylist()
            lines, out = values.to_pylist(), []
            for i, key in enumerate(zip(files.to_pylist(), blocks.to_pylist())):
                if key != split:
                    if held:
                        flush(True)
                    split, seq, held, head = key, 0, [], True
                if not held:
                    at = seq
                held.append(lines[i])
                seq += 1
                if not cont[i]:
                    flush(False)
                    held, head = [], False
            yield frame()
        if held:
            out = []
            flush(True)
            yield frame()
    return run


def repair_escaped_lines(spark: SparkSession, path, **options) -> DataFrame:
    """Repaired records ``(file_path, block_start, line_seq, value)``.

    ``(file_path, block_start, line_seq)`` orders records as in the file.
    """
    reader = spark.read.format("text")
    for k, v in options.items():
        reader = reader.option(k, v)
    lines = reader.load(path).select(F.col("_metadata.file_path").alias("file_path"),
                                     F.col("_metadata.file_block_start").alias("block_start"), F.col("value"))
    whole = lines.mapInArrow(_split_pass(False), RECORDS)
    parts = lines.mapInArrow(_split_pass(True), FRAGMENTS)
    in_file = Window.partitionBy("file_path").orderBy("block_start", "line_seq")
    begins = (~F.coalesce(F.lag("open").over(in_file), F.lit(False))).cast("int")
    number = F.sum("begins").over(in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stitched = (parts.withColumn("begins", begins).withColumn("record", number).groupBy("file_path", "record")
                .agg(F.sort_array(F.collect_list(F.struct("block_start", "line_seq", "value", "open"))).alias("p")))
    text = F.array_join(F.transform("p", lambda x: x["value"]), " ")
    # a file whose last line ends in "\" ended with an escaped break as well
    text = F.when(F.element_at("p", -1)["open"], F.concat(text, F.lit(" "))).otherwise(text)
    return whole.unionByName(stitched.select(
        "file_path", F.col("p")[0]["block_start"].alias("block_start"), F.col("p")[0]["line_seq"].alias("line_seq"),
        text.alias("value")))


def _document_pass(fragments: bool):
    """As ``_split_pass``, with escaped breaks as LF and ``line_seq`` as the record's number in its split; after a
    split's fragments comes its own row: how many records it holds, whether the last is open, bytes and size."""
    def run(batches):
        split, seq, held, head = None, 0, [], True
        octets, size, cr, blank = 0, None, False, True
        out: list[tuple] = []

        def flush(is_open: bool):
            border = is_open or (head and split[1] > 0)
            if border == fragments:
                out.append((*split, seq, "\n".join(held), is_open, None, None, None, None)[:9 if fragments else 4])

        def end():
            if held:
                flush(True)
            if fragments:
                out.append((*split, seq + bool(held), None, bool(held), octets, cr, size, blank))

        def frame():
            cols = list(zip(*out)) or [()] * (9 if fragments else 4)
            kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
            fields = [c.split() for c in DOCUMENT.split(", ")][:len(cols)]
            return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])

        for batch in batches:
            files, blocks, sizes, counts, crs, values = (batch.column(i) for i in range(6))
            cont = pc.ends_with(values, "\\").to_pylist()
            lines, out = values.to_pylist(), []
            for i, (key, size_, n, cr_) in enumerate(zip(zip(files.to_pylist(), blocks.to_pylist()), sizes.to_pylist(),
                                                         counts.to_pylist(), crs.to_pylist())):
                if key != split:
                    if split:
                        end()
                    split, seq, held, head = key, 0, [], True
                    octets, blank = 0, True
                held.append(lines[i])
                octets, size, cr, blank = octets + n, size_, cr_, blank and not lines[i]
                if not cont[i]:
                    flush(False)
                    seq, held, head = seq + 1, [], False
            yield frame()
        if split:
            out = []
            end()
            yield frame()
    return run


def repair_documents(spark: SparkSession, path) -> DataFrame:
    """Whole-file repair: ``(file_path, line_no, value)``, one row per record."""
    lines = read_documents(spark, path, lines=True)
    whole = lines.mapInArrow(_document_pass(False), RECORDS)
    parts = lines.mapInArrow(_document_pass(True), DOCUMENT)
    in_file = Window.partitionBy("file_path").orderBy("block_start", "line_seq")
    file, before = Window.partitionBy("file_path"), in_file.rowsBetween(Window.unboundedPreceding, -1)

    # a row per split: the number of its first record, and what is known of its file
    goes_on = F.coalesce(F.lag("open").over(in_file), F.lit(False)).cast("int")
    splits = (parts.where("octets is not null").withColumn("goes_on", goes_on).withColumn("begun", F.col("line_seq") - F.col("goes_on"))
              .select("file_path", "block_start", (F.coalesce(F.sum("begun").over(before), F.lit(0)) - F.col("goes_on")).alias("first"),
                      F.sum("begun").over(file).alias("of"), F.min("blank").over(file).alias("blank"),
                      F.max_by("cr", "block_start").over(file).alias("cr"),
                      (F.sum("octets").over(file) - F.col("file_size")).alias("over")))
    # bytes counted beyond the size: 1 for a missing last LF, -3 for a byte order mark that the line reader skips
    ended = F.col("cr") | F.coalesce(~F.col("over").isin(1, -2), F.lit(True))

    begins = (~F.coalesce(F.lag("open").over(in_file), F.lit(False))).cast("int")
    number = F.sum("begins").over(in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stitched = (parts.where("octets is null").withColumn("begins", begins).withColumn("record", number).groupBy("file_path", "record")
                .agg(F.sort_array(F.collect_list(F.struct("block_start", "line_seq", "value", "open"))).alias("p"))
                .select("file_path", F.col("p")[0]["block_start"].alias("block_start"), F.col("p")[0]["line_seq"].alias("line_seq"),
                        F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"),
                        F.element_at("p", -1)["open"].alias("open")))
    records = (whole.withColumn("open", F.lit(False)).unionByName(stitched).join(F.broadcast(splits), ["file_path", "block_start"])
               .withColumn("line_no", (F.col("first") + F.col("line_seq")).cast("int")))
    text = F.when(F.col("open") & ended, F.concat("value", F.lit("\n"))).otherwise(F.col("value"))
    mark = F.when((F.col("line_no") == 0) & F.coalesce(F.col("over") < 0, F.lit(False)), F.lit("\ufeff")).otherwise("")
    # an empty record at a file's end is not given
    last = (F.col("line_no") == F.col("of") - 1) & (F.col("value") == "")
    return (records.where(~last & ~(F.col("blank") & (F.col("of") <= 2)))
            .select("file_path", "line_no", F.concat(mark, repair_escaped_breaks(text)).alias("value")))

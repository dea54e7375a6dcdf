import datetime as dt

from pyspark.sql import functions as F

from tidelake.functions.text import (
    after_last,
    basename,
    before_first,
    default_if_blank,
    join_fields,
    pipe_line,
    split_exact,
)
from tidelake.functions.time import compact_stamp, minute_cutoff, parse_stamp, run_date_col


def test_text_functions(spark):
    df = spark.createDataFrame([("20240115120110|/in/a/f_1.txt", "  ", "a\u0007\u0007b\u0007")],
                               "line string, blank string, raw string")
    r = df.select(
        before_first("line").alias("stamp"), after_last("line").alias("path"),
        basename(after_last("line")).alias("name"), default_if_blank("blank", "x").alias("d"),
        split_exact("raw").alias("f"), join_fields(split_exact("raw")).alias("back"),
        pipe_line(F.lit(1), F.lit(None).cast("string"), F.lit("z")).alias("shown"),
    ).first()
    assert (r.stamp, r.path, r.name, r.d) == ("20240115120110", "/in/a/f_1.txt", "f_1.txt", "x")
    assert r.f == ["a", "", "b", ""] and r.back == "a\u0007\u0007b\u0007"
    assert r.shown == "1|null|z"


def test_time_functions(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 23, 59, 42, 5),)], "ts timestamp_ntz")
    r = df.select(compact_stamp("ts").alias("s"), parse_stamp(compact_stamp("ts")).alias("p"),
                  minute_cutoff("ts").cast("timestamp_ntz").alias("c"),
                  run_date_col("2024-01-02").alias("d")).first()
    assert r.s == "20240115235942"
    assert r.p == dt.datetime(2024, 1, 15, 23, 59, 42)
    assert r.c == dt.datetime(2024, 1, 16, 0, 0, 0)
    assert r.d == dt.date(2024, 1, 2)

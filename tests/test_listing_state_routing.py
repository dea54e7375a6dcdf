import datetime as dt
import os

from pyspark.sql import functions as F

from tidelake.operators import filters, routing, state
from tidelake.sources.listing import list_files


def _touch(path, when, size=10):
    with open(path, "w") as f:
        f.write("x" * size)
    ts = when.replace(tzinfo=dt.timezone.utc).timestamp()
    os.utime(path, (ts, ts))


def _files(tmp):
    d = tmp + "/src"
    os.makedirs(d + "/sub")
    base = dt.datetime(2024, 1, 15, 12, 1, 10)
    _touch(f"{d}/sig_1.txt", base)                                   # equal to watermark
    _touch(f"{d}/sig_2.txt", base + dt.timedelta(seconds=20))        # same minute, later
    _touch(f"{d}/sig_3.txt", base + dt.timedelta(minutes=2))
    _touch(f"{d}/sales_1.txt", base + dt.timedelta(minutes=3))
    _touch(f"{d}/empty_1.txt", base + dt.timedelta(minutes=4), size=0)
    _touch(f"{d}/sub/sig_4.txt", base + dt.timedelta(minutes=5))
    return d, base


def test_listing_filters(spark, tmp):
    d, base = _files(tmp)
    m = list_files(spark, d)
    names = lambda df: sorted(r.file_name for r in df.select("file_name").collect())
    # Spark's file index skips zero-length files, so empty drops never enter a manifest
    assert names(m) == ["sales_1.txt", "sig_1.txt", "sig_2.txt", "sig_3.txt"]
    wm = base.replace(tzinfo=dt.timezone.utc).astimezone().replace(tzinfo=None)
    assert names(filters.files_newer_than(m, wm)) == ["sales_1.txt", "sig_2.txt", "sig_3.txt"]
    assert names(filters.files_newer_than_minute(m, wm)) == ["sales_1.txt", "sig_3.txt"]
    assert names(filters.files_non_empty(m)) == ["sales_1.txt", "sig_1.txt", "sig_2.txt", "sig_3.txt"]
    assert names(list_files(spark, d, pattern="sig")) == ["sig_1.txt", "sig_2.txt", "sig_3.txt"]
    assert "sig_4.txt" in names(list_files(spark, d, recursive=True))
    assert [r.file_name for r in filters.latest_file(m).collect()] == ["sales_1.txt"]


def test_listing_never_reads_content(spark, tmp):
    d, _ = _files(tmp)
    plan = list_files(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_minute_cutoff_carries_over_midnight(spark):
    rows = [dt.datetime(2024, 1, 1, 23, 59, 55), dt.datetime(2024, 1, 2, 0, 0, 0),
            dt.datetime(2024, 1, 2, 0, 0, 0, 1)]
    df = spark.createDataFrame([(r,) for r in rows], "modified timestamp_ntz")
    out = filters.files_newer_than_minute(df, dt.datetime(2024, 1, 1, 23, 59, 50))
    assert [r.modified for r in out.collect()] == [dt.datetime(2024, 1, 2, 0, 0, 0, 1)]


def test_watermark_state_roundtrip(spark, tmp):
    m = spark.createDataFrame([("a", "a1", dt.datetime(2024, 1, 1)), ("a", "a2", dt.datetime(2024, 1, 3)),
                               ("b", "b1", dt.datetime(2024, 1, 2))],
                              "src string, file_name string, modified timestamp_ntz")
    path = tmp + "/state"
    assert state.read_state(spark, path) is None
    state.append_state(state.advance_watermarks(m, "src"), path)
    older = m.where(F.col("file_name") == "a1")
    state.append_state(state.advance_watermarks(older, "src"), path)  # never goes backwards
    cur = {r.source: (r.high_water, r.file_name) for r in state.current_watermarks(state.read_state(spark, path)).collect()}
    assert cur["a"] == (dt.datetime(2024, 1, 3), "a2")
    want = spark.createDataFrame([("a",), ("c",)], "source string")
    got = {r.source: r.high_water for r in state.watermarks_with_default(want, state.read_state(spark, path)).collect()}
    assert got == {"a": dt.datetime(2024, 1, 3), "c": dt.datetime(2000, 1, 1)}


def _manifest(spark):
    return spark.createDataFrame([(n,) for n in ["sig_1", "sales_2", "p_3", "x_4", "s", "signal"]],
                                 "file_name string")


ROUTES = [(1, "s", "s_tab"), (2, "sig", "sig_tab"), (3, "p", "p_tab"), (4, "", "all_tab")]


def test_routing_broadcast_and_equi_join_paths_agree(spark):
    ctrl = spark.createDataFrame(ROUTES, "line_no int, pattern string, table_name string")
    m = _manifest(spark)
    for fn in (routing.route_first_match, routing.route_all_matches):
        a = sorted(tuple(r) for r in fn(m, ctrl).select("file_name", "table_name").collect())
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            b = sorted(tuple(r) for r in fn(m, ctrl).select("file_name", "table_name").collect())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert a == b
    first = dict(routing.route_first_match(m, ctrl).select("file_name", "table_name").collect())
    assert first == {"sig_1": "s_tab", "sales_2": "s_tab", "p_3": "p_tab", "x_4": "all_tab",
                     "s": "s_tab", "signal": "s_tab"}
    all_sig = routing.route_all_matches(m, ctrl).where("file_name = 'sig_1'").count()
    assert all_sig == 3


def test_routing_is_an_equi_join_never_a_nested_loop(spark):
    ctrl = spark.createDataFrame(ROUTES, "line_no int, pattern string, table_name string")
    for threshold in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = routing.route_all_matches(_manifest(spark), ctrl)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert threshold != "-1" or "SortMergeJoin" in plan


def test_seed_from_state_prefers_state(spark, tmp):
    path = tmp + "/state"
    state.append_state(spark.createDataFrame([("erp/ORDERS", "500", "bigint")],
                                             "source string, value string, value_type string"), path)
    ctrl = spark.createDataFrame([("ORDERS", "10"), ("PARTS", "3")], "t string, last_value string")
    out = state.seed_from_state(ctrl, state.read_state(spark, path), F.concat(F.lit("erp/"), F.col("t")))
    assert dict(out.select("t", "last_value").collect()) == {"ORDERS": "500", "PARTS": "3"}


def test_compact_state_keeps_current_watermarks(spark, tmp):
    path = tmp + "/state"
    for day in (1, 2, 3):
        m = spark.createDataFrame([("a", f"a{day}", dt.datetime(2024, 1, day)), ("b", f"b{day}", dt.datetime(2024, 2, day))],
                                  "src string, file_name string, modified timestamp_ntz")
        state.append_state(state.advance_watermarks(m, "src"), path)
    before = sorted(tuple(r) for r in state.current_watermarks(state.read_state(spark, path)).collect())
    compacted = state.compact_state(spark, path)
    assert compacted.count() == 2
    after = sorted(tuple(r) for r in state.current_watermarks(compacted).collect())
    assert after == before


def test_invalid_date_part_folder_stays_a_date_column(spark, tmp):
    from tidelake.sinks.raw import write_raw
    from tidelake.sources.raw import read_raw
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    write_raw(df, tmp + "/t/date_part=2018-09-17")
    write_raw(df, tmp + "/t/date_part=2018-09-47")
    out = read_raw(spark, tmp + "/t", schema="k int, v string")
    assert dict(out.dtypes)["date_part"] == "date"
    got = sorted((r.date_part.isoformat() if r.date_part else "") for r in out.collect())
    assert got == ["", "2018-09-17"]


def test_routing_with_no_usable_pattern_is_empty(spark):
    ctrl = spark.createDataFrame([(1, None, "t")], "line_no int, pattern string, table_name string")
    out = routing.route_all_matches(_manifest(spark), ctrl)
    assert out.count() == 0 and "table_name" in out.columns
    assert routing.route_first_match(_manifest(spark), ctrl).count() == 0


def test_listing_modified_after_option(spark, tmp):
    d, base = _files(tmp)
    wm = base.replace(tzinfo=dt.timezone.utc) + dt.timedelta(minutes=2, microseconds=5)
    wm_session = wm.replace(tzinfo=None)  # session time zone is UTC in tests
    names = sorted(r.file_name for r in list_files(spark, d, modified_after=wm_session).collect())
    assert names == ["sales_1.txt"]

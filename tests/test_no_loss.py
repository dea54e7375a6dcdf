"""Multi-run pipelines lose and repeat nothing: one table fed by several control rows, crashes at
each step, late and damaged files, sources with clocks of their own."""

import os
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_pipelines import _crash_once, _file_control, _table_control
from tidelake.plans.ingest import ingest_tables
from tidelake.plans.landing import land_files, pickup_files
from tidelake.registry import ddl_of, table
from tidelake.session import local_frame
from tidelake.sinks.loads import read_loads
from tidelake.sources.raw import read_raw
from tidelake.streaming.landing import stream_land


def _put(path, text, age=0.0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    t = time.time() - age
    os.utime(path, (t, t))


def _lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


@pytest.mark.parametrize("parallel", [1, 4])
@pytest.mark.parametrize("same_day", [True, False])
def test_two_patterns_one_table(spark, tmp, parallel, same_day):
    src, lake, st = tmp + "/src", tmp + "/lake", tmp + "/state"
    ctrl = _file_control(spark, [("a_", "t", src, lake), ("b_", "t", src, lake)])
    for k, day in ((1, "2024-01-01"), (2, "2024-01-01" if same_day else "2024-01-02")):
        for x in "ab":
            _put(f"{src}/{x}_{k}.txt", f"{x}{k}\n", age=100 - 10 * k)
        rep = land_files(spark, ctrl, st, app="x", run_date=day, max_parallel=parallel).collect()
        assert [(r.status, r.n_files, r.n_rows) for r in rep] == [("ok", 1, 1), ("ok", 1, 1)]
    assert _lines(spark, lake + "/t") == ["a1", "a2", "b1", "b2"]
    rep = land_files(spark, ctrl, st, app="x", max_parallel=parallel).collect()
    assert {r.status for r in rep} == {"no_new_data"}


@pytest.mark.parametrize("module,name", [("tidelake.operators.state", "append_state"), ("tidelake.plans.landing", "write_lines"), ("tidelake.plans.landing", "write_edges"), ("tidelake.sinks.loads", "_log")])
def test_crash_between_steps_loads_once(spark, tmp, monkeypatch, module, name):
    import importlib
    src, lake, st = tmp + "/src", tmp + "/lake", tmp + "/state"
    ctrl = _file_control(spark, [("a_", "t", src, lake), ("b_", "t", src, lake), ("c_", "u", src, lake)])
    for x in "abc":
        _put(f"{src}/{x}_1.txt", f"{x}1\n", age=100)
    land_files(spark, ctrl, st, run_date="2024-01-01").collect()
    for x in "abc":
        _put(f"{src}/{x}_2.txt", f"{x}2\n", age=50)
    _crash_once(monkeypatch, importlib.import_module(module), name)
    rep = land_files(spark, ctrl, st, run_date="2024-01-01", max_parallel=1).collect()
    assert [r.status for r in rep] == ["failed", "failed", "ok"]
    land_files(spark, ctrl, st, run_date="2024-01-01").collect()
    assert _lines(spark, lake + "/t") == ["a1", "a2", "b1", "b2"]
    assert _lines(spark, lake + "/u") == ["c1", "c2"]


def test_pickup_after_a_crash_archives_only_committed_batches(spark, tmp, monkeypatch):
    import tidelake.operators.state as state_mod
    src, stage, arch, st = tmp + "/src", tmp + "/stage", tmp + "/archive", tmp + "/state"
    _put(src + "/1.txt", "one\n", age=100)
    _crash_once(monkeypatch, state_mod, "append_state")
    with pytest.raises(RuntimeError):
        pickup_files(spark, src, stage, st, archive_dir=arch, run_date="2024-01-01")
    pickup_files(spark, src, stage, st, archive_dir=arch, run_date="2024-01-01").collect()
    assert _lines(spark, stage) == ["one"]
    old = [os.path.join(d, f) for d, _, fs in os.walk(arch) for f in fs if f.endswith(".txt")]
    assert old == []
    _put(src + "/2.txt", "two\n", age=50)
    pickup_files(spark, src, stage, st, archive_dir=arch, run_date="2024-01-02").collect()
    assert _lines(spark, stage) == ["two"] and _lines(spark, arch + "/*") == ["one"]


def test_success_marker_only_after_the_watermark(spark, tmp, monkeypatch):
    import tidelake.operators.state as state_mod
    src, lake = tmp + "/src", tmp + "/lake"
    _put(src + "/a_1.txt", "a\n")
    ctrl = _file_control(spark, [("a_", "t", src, lake)])
    _crash_once(monkeypatch, state_mod, "append_state")
    assert land_files(spark, ctrl, tmp + "/state").collect()[0].status == "failed"
    assert not os.path.exists(lake + "/t/_SUCCESS")
    assert land_files(spark, ctrl, tmp + "/state").collect()[0].status == "ok"
    assert os.path.exists(lake + "/t/_SUCCESS")


def test_stream_lands_late_files(spark, tmp):
    src, lake, ck = tmp + "/src", tmp + "/lake", tmp + "/ck"
    _put(src + "/n1.txt", "n1\n")
    stream_land(spark, src, lake, checkpoint=ck, run_date="2024-01-01")
    _put(src + "/late.txt", "late\n", age=30 * 86400)
    stream_land(spark, src, lake, checkpoint=ck, run_date="2024-01-01")
    assert _lines(spark, lake) == ["late", "n1"]
    with pytest.raises(TypeError):
        stream_land(spark, src, lake)


def _zip(path, members, age=0.0, cut=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as zf:
        for n, text in members.items():
            zf.writestr(n, text)
    if cut:
        data = open(path, "rb").read()
        open(path, "wb").write(data[:cut])
    t = time.time() - age
    os.utime(path, (t, t))


def test_consolidated_targets_and_damaged_archives(spark, tmp):
    src, one, two, st = tmp + "/src", tmp + "/one", tmp + "/two", tmp + "/state"
    ctrl = _file_control(spark, [("cust", "customer", src, one), ("supp", "supplier", src, two), ("", "bad", src, one)])
    _zip(src + "/1.zip", {"cust_1.txt": "1\n2\n", "supp_1.txt": "4\n"}, age=300)
    _zip(src + "/2.zip", {"cust_2.txt": "3\n" * 50}, age=200, cut=60)
    _zip(src + "/3.zip", {"cust_3.txt": "5\n"}, age=100)
    _put(src + "/readme.txt", "no archive\n", age=400)
    land = lambda: sorted((r.status, r.table_name or "", r.n_rows) for r in land_files(
        spark, ctrl, st, app="a", mode="consolidated", run_date="2024-01-02").collect())
    rep = land()
    assert ("ok", "customer", 3) in rep and ("ok", "supplier", 1) in rep  # later archives go on
    assert [s for s, t, _ in rep if t.endswith("2.zip")] == ["failed"] and [t for s, t, _ in rep if s == "invalid"] == ["bad"]
    assert _lines(spark, one + "/customer") == ["1", "2", "5"] and _lines(spark, two + "/supplier") == ["4"]
    assert not os.path.exists(one + "/supplier") and not os.path.exists(two + "/customer")
    assert [s for s, _, _ in land() if s not in ("invalid", "no_new_data")] == ["failed"]  # still waiting
    _zip(src + "/2.zip", {"cust_2.txt": "3\n"}, age=250)  # replaced, with a stamp long passed
    assert ("ok", "customer", 1) in land()
    assert _lines(spark, one + "/customer") == ["1", "2", "3", "5"]
    _zip(src + "/4.zip", {"other.txt": "x\n"}, age=10)
    assert ("ok", "customer", 0) in land()
    assert {s for s, _, _ in land() if s != "invalid"} == {"no_new_data"}  # the unmatched archive is done


def test_lastmodified_follows_the_source_clock(spark, tmp):
    old = spark.sql("select id k, timestamp'2001-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) ts from range(10)")
    old = old.union(spark.sql("select 99L, cast(null as timestamp)"))
    new = spark.sql("select id + 100 k, timestamp'2001-01-01 00:01:00' + make_interval(0,0,0,0,0,0,id) ts from range(5)")
    ctrl = _table_control(spark, [("LastModified", "Oracle", "NORMAL", "T", "S", None, tmp + "/t", None, None, None, None, "ts", None)])
    seen = []
    for src in (old, old.union(new), old.union(new)):
        r = ingest_tables(spark, ctrl, tmp + "/state", source=lambda row, s=src: s, run_date="2024-01-01").collect()[0]
        seen.append((r.status, r.n_rows))
    assert seen == [("ok", 11), ("ok", 5), ("no_new_data", 0)]
    got = read_loads(spark, tmp + "/t", tmp + "/state", schema="k bigint, ts timestamp").select("k")
    assert sorted(r.k for r in got.collect()) == [*range(10), 99, *range(100, 105)]


def test_lastmodified_with_the_source_now(spark, tmp):
    rows = spark.sql("select id k, timestamp'2001-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) ts from range(10)")
    ctrl = _table_control(spark, [("lastmodified", "oracle", "normal", "T", "S", None, tmp + "/t", None, None, None, None, "ts", None)])
    n = [ingest_tables(spark, ctrl, tmp + "/state", source=lambda row: rows, source_now=lambda row, t=t: t).collect()[0].n_rows
         for t in ("2001-01-01 00:00:04", "2001-01-01 00:00:20")]
    assert n == [4, 6]


def test_mixed_case_control_row_registers_and_schemas_keep_their_own_state(spark, tmp):
    orders = table(spark, SF_SMALL, "orders")
    ctrl = _table_control(spark, [("Append", "ORACLE ", "HIVE", "ORDERS", "S1", "tl_mixed_one", tmp + "/s1", None, None, None, None, "o_orderkey", None),
                                  ("append", "oracle", "hive", "ORDERS", "S2", "tl_mixed_two", tmp + "/s2", None, None, None, None, "o_orderkey", None),
                                  ("append", "oracle", "hive", "ORDERS", "S3", " ", tmp + "/s3", None, None, None, None, "o_orderkey", None)])
    source = lambda row: orders if row["schema_name"] == "S1" else orders.where("o_orderkey < 100")
    rep = ingest_tables(spark, ctrl, tmp + "/state", source=source, app="erp").collect()
    assert [(r.status, r.message) for r in rep] == [("ok", None), ("ok", None), ("invalid", "hive_table_name")]
    assert spark.table("tl_mixed_one").count() == orders.count()
    assert spark.table("tl_mixed_two").count() == orders.where("o_orderkey < 100").count()
    rep = ingest_tables(spark, ctrl, tmp + "/state", source=lambda row: orders, app="erp").collect()
    assert [r.n_rows for r in rep[:2]] == [0, orders.where("o_orderkey >= 100").count()]


def test_failure_message_is_whole(spark, tmp):
    def source(row):
        raise ValueError("x" * 3000 + " root cause")
    ctrl = _table_control(spark, [("snapshot", "oracle", "normal", "T", "S", None, tmp + "/t", None, None, None, None, None, None)])
    assert ingest_tables(spark, ctrl, tmp + "/state", source=source).collect()[0].message.endswith("root cause")


def test_ragged_lines_keep_every_field_and_bad_values_are_named(spark, tmp):
    _put(tmp + "/raw/f.txt", "1\u0007a\n2\u0007b\u00072024-01-01\u0007new\nx\u0007c\u0007\\N\n")
    wide = read_raw(spark, tmp + "/raw")
    assert wide.columns == ["_c0", "_c1", "_c2", "_c3"]
    assert [r._c3 for r in wide.orderBy("_c0").collect()] == [None, "new", None]
    typed = read_raw(spark, tmp + "/raw", schema="k int, v string, d date", rejects="bad")
    assert {r.v: list(r.bad) for r in typed.collect()} == {"a": [], "b": [], "c": ["k"]}


def test_register_never_drops_a_table(spark, tmp):
    from tidelake.sources.tables import register_raw_table
    _put(tmp + "/raw/f.txt", "1\n")
    spark.range(3).write.saveAsTable("tl_kept")
    for replace in (False, True):
        with pytest.raises(ValueError):
            register_raw_table(spark, "tl_kept", tmp + "/raw", "k int", partitioned=False, replace=replace)
    assert spark.table("tl_kept").count() == 3


def test_local_frame_of_many_rows_is_quick(spark):
    t = time.time()
    rows = [(f"t{i}", i, str(i), None) for i in range(15_000)]
    df = local_frame(spark, rows, "name string, n bigint, parsed int, ts timestamp")
    assert df.agg(F.sum("n"), F.sum("parsed"), F.count("ts")).first()[:] == (112492500, 112492500, 0)
    assert time.time() - t < 20
    assert ddl_of(df) == "`name` string, `n` bigint, `parsed` int, `ts` timestamp"


def test_scratch_folder_must_be_shared(monkeypatch):
    from tidelake import session

    class Conf:
        def get(self, k, d=None):
            return d

    class Sc:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Fake:
        conf, sparkContext = Conf(), Sc()

    with pytest.raises(RuntimeError):
        session.scratch_root(Fake())

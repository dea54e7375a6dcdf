"""Load folders: what is committed is seen, once, whatever happens in between; equal values at the
watermark; listings by the tasks."""

import gzip
import importlib
import os
import random
import threading
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.test_no_loss import _lines, _put, _zip
from tests.test_pipelines import _crash_once, _file_control, _table_control
from tidelake.plans.ingest import ingest_tables
from tidelake.plans.landing import land_files, pickup_files
from tidelake.sinks.loads import committed_loads, loads_path, read_loads
from tidelake.sources import listing
from tidelake.sources.raw import read_raw
from tidelake.sources.tables import register_raw_table

K = "k bigint, v string"


def _rows(spark, n):
    return spark.range(1, n + 1).select(F.col("id").alias("k"), F.lit("x").alias("v"))


def _two_targets(spark, tmp, kind="append"):
    row = lambda target, where: (kind, "oracle", "normal", "ORDERS", "S", None, target, where, None, None, None, "k", None)
    return _table_control(spark, [row(tmp + "/a", "k % 2 = 0"), row(tmp + "/b/", "k % 2 = 1")])


def _keys(spark, target, st):
    return sorted(r.k for r in read_loads(spark, target, st, schema=K).collect())


@pytest.mark.parametrize("parallel", [1, 4])
@pytest.mark.parametrize("same_day", [True, False])
def test_one_table_into_two_targets(spark, tmp, parallel, same_day):
    ctrl, st = _two_targets(spark, tmp), tmp + "/state"
    for i, n in enumerate((10, 20, 30, 30)):
        rep = ingest_tables(spark, ctrl, st, source=lambda row, n=n: _rows(spark, n), max_parallel=parallel,
                            run_date="2024-01-01" if same_day else f"2024-01-0{i + 1}").collect()
        assert [r.status for r in rep] == (["ok"] * 2 if i < 3 else ["no_new_data"] * 2)
        assert _keys(spark, tmp + "/a", st) == list(range(2, n + 1, 2))
        assert _keys(spark, tmp + "/b", st) == list(range(1, n + 1, 2))


STEPS = [("tidelake.sinks.loads", "_log"), ("tidelake.plans.ingest", "write_edges"), ("tidelake.plans.ingest", "_write"),
         ("tidelake.operators.state", "append_state"), ("tidelake.plans.ingest", "_register")]


@pytest.mark.parametrize("parallel", [1, 4])
@pytest.mark.parametrize("module,name", STEPS)
def test_a_crash_at_any_step_loads_once(spark, tmp, monkeypatch, module, name, parallel):
    ctrl, st = _two_targets(spark, tmp), tmp + "/state"
    ingest_tables(spark, ctrl, st, source=lambda row: _rows(spark, 10), run_date="2024-01-01").collect()
    _crash_once(monkeypatch, importlib.import_module(module), name)
    rep = ingest_tables(spark, ctrl, st, source=lambda row: _rows(spark, 20), run_date="2024-01-01", max_parallel=parallel).collect()
    assert sorted(r.status for r in rep) == ["failed", "ok"]
    for n in (20, 30):
        ingest_tables(spark, ctrl, st, source=lambda row, n=n: _rows(spark, n), run_date="2024-01-01", max_parallel=parallel).collect()
        assert _keys(spark, tmp + "/a", st) == list(range(2, n + 1, 2)) and _keys(spark, tmp + "/b", st) == list(range(1, n + 1, 2))
    done = {r.load_id for r in committed_loads(spark, st).collect()}
    assert {d.split("=")[1] for t in "ab" for d in os.listdir(f"{tmp}/{t}/date_part=2024-01-01") if d.startswith("load=")} <= done


def test_a_table_twice_into_one_target_is_invalid(spark, tmp):
    row = lambda kind, name, target: (kind, "oracle", "normal", name, "S", None, target, None, None, None, None, "k", None)
    ctrl = _table_control(spark, [row("append", "T", tmp + "/a"), row("append", "T", tmp + "/a/"), row("snapshot", "U", tmp + "/a"),
                                  row("append", "U", tmp + "/a")])
    rep = ingest_tables(spark, ctrl, tmp + "/state", source=lambda row: _rows(spark, 3)).collect()
    assert [r.status for r in rep] == ["ok", "invalid", "invalid", "ok"]
    assert _keys(spark, tmp + "/a", tmp + "/state") == [1, 1, 2, 2, 3, 3]


def test_a_reader_of_a_snapshot_sees_the_old_or_the_new(spark, tmp):
    ctrl = _table_control(spark, [("snapshot", "oracle", "hive", "T", "S", "tl_switch", tmp + "/t", None, None, None, None, None, None)])
    st, seen, stop = tmp + "/state", [], threading.Event()
    load = lambda n: ingest_tables(spark, ctrl, st, source=lambda row: _rows(spark, n), run_date="2024-01-01").collect()
    load(5)

    def read():
        while not stop.is_set():
            seen.append((read_loads(spark, tmp + "/t", st, schema=K).count(), spark.table("tl_switch").count()))

    reader = threading.Thread(target=read)
    reader.start()
    for n in (7, 11):
        assert load(n)[0].status == "ok"
    stop.set()
    reader.join()
    assert {a for a, _ in seen} <= {5, 7, 11} and {b for _, b in seen} <= {5, 7, 11} and len(seen) > 1
    assert read_loads(spark, tmp + "/t", st, schema=K).count() == 11 and spark.table("tl_switch").count() == 11
    load(3)
    assert len([d for d in os.listdir(tmp + "/t/date_part=2024-01-01") if d.startswith("load=")]) == 2  # and the one before


def test_the_driver_does_the_same_for_any_number_of_files(spark, tmp, monkeypatch):
    from tidelake.sinks import loads
    calls = []
    real = loads._path

    def counted(s, p):
        calls.append(p)
        return real(s, p)
    monkeypatch.setattr(loads, "_path", counted)
    ctrl = _table_control(spark, [("append", "oracle", "normal", "T", "S", None, tmp + "/t", None, None, None, None, "k", None)])
    per = []
    for n, parts in ((50, 1), (200, 40)):
        calls.clear()
        ingest_tables(spark, ctrl, tmp + "/state", source=lambda row: _rows(spark, n).repartition(parts), run_date="2024-01-01").collect()
        per.append(len(calls))
    assert per[0] == per[1]
    assert _keys(spark, tmp + "/t", tmp + "/state") == list(range(1, 201))


# --- equal values at the watermark ----------------------------------------------------------------

@pytest.mark.parametrize("kind", ["append", "lastmodified"])
def test_rows_that_arrive_later_with_the_stored_value(spark, tmp, kind):
    day = lambda d: f"timestamp'2024-01-0{d} 10:00:00'"
    frame = lambda *rows: spark.sql(" union all ".join(f"select {k}L k, '{v}' v, {day(d)} t" for k, v, d in rows))
    ctrl = _table_control(spark, [(kind, "oracle", "normal", "T", "S", None, tmp + "/t", None, None, None, None, "t", None)])
    runs = [frame((1, "a", 1), (2, "b", 2)), frame((1, "a", 1), (2, "b", 2), (3, "late", 2)), frame((1, "a", 1), (2, "b", 2), (3, "late", 2)),
            frame((1, "a", 1), (2, "b", 2), (3, "late", 2), (4, "later", 2), (5, "c", 3)), frame((5, "c", 3), (6, "d", 3), (7, "old", 1))]
    n = [ingest_tables(spark, ctrl, tmp + "/state", source=lambda row, s=s: s).collect()[0].n_rows for s in runs]
    assert n == [2, 1, 0, 2, 1]
    got = read_loads(spark, tmp + "/t", tmp + "/state", schema="k bigint, v string, t timestamp")
    assert sorted(r.k for r in got.collect()) == [1, 2, 3, 4, 5, 6]


def test_rows_that_appear_while_a_load_runs_wait(spark, tmp, monkeypatch):
    import tidelake.plans.ingest as mod
    ctrl = _table_control(spark, [("append", "oracle", "normal", "T", "S", None, tmp + "/t", None, None, None, None, "k", None)])
    _rows(spark, 3).write.parquet(tmp + "/src")
    real = mod.write_edges

    def then_more(*a):
        out = real(*a)
        spark.sql("select 3L k, 'meanwhile' v").write.mode("append").parquet(tmp + "/src")
        monkeypatch.setattr(mod, "write_edges", real)
        return out
    monkeypatch.setattr(mod, "write_edges", then_more)
    n = [ingest_tables(spark, ctrl, tmp + "/state", source=lambda row: spark.read.parquet(tmp + "/src")).collect()[0].n_rows for _ in range(3)]
    assert sum(n) == 4 and n[2] == 0
    assert _keys(spark, tmp + "/t", tmp + "/state") == [1, 2, 3, 3]


def test_files_that_arrive_later_with_the_stored_stamp(spark, tmp):
    src, lake, stage = tmp + "/src", tmp + "/lake", tmp + "/stage"
    ctrl = _file_control(spark, [("f", "t", src, lake)])

    def both(*names):
        for name in names:
            _put(f"{src}/{name}", name + "\n")
            os.utime(f"{src}/{name}", (1_700_000_000, 1_700_000_000))
        land = land_files(spark, ctrl, tmp + "/state", run_date="2024-01-01").collect()[0].n_files
        pick = pickup_files(spark, src, stage, tmp + "/pstate", run_date="2024-01-01").collect()[0].n_files
        return land, pick
    assert both("f1", "f2") == (2, 2)
    assert both("f0 late") == (1, 1)
    assert both() == (0, 0)
    assert both("f3") == (1, 1)
    want = ["f0 late", "f1", "f2", "f3"]
    assert _lines(spark, lake + "/t") == want and _lines(spark, stage) == want
    _zip(tmp + "/z/1.zip", {"f1": "1\n"})
    _zip(tmp + "/z/2.zip", {"f2": "2\n"})
    for x in "12":
        os.utime(f"{tmp}/z/{x}.zip", (1_700_000_000, 1_700_000_000))
    os.rename(tmp + "/z/2.zip", tmp + "/2.zip")
    ctrl = _file_control(spark, [("f", "z", tmp + "/z", lake)])
    land = lambda: land_files(spark, ctrl, tmp + "/zstate", mode="consolidated").collect()[0].n_rows
    assert (land(), land()) == (1, 0)
    os.rename(tmp + "/2.zip", tmp + "/z/2.zip")
    assert (land(), land()) == (1, 0) and _lines(spark, lake + "/z") == ["1", "2"]


# --- landing: keys, numbering, members ------------------------------------------------------------

def test_a_target_added_later_does_not_disturb_the_first(spark, tmp):
    src, st = tmp + "/src", tmp + "/state"
    _put(src + "/a1", "a1\n", age=50)
    rows = [("a", "t", src, tmp + "/one")]
    land_files(spark, _file_control(spark, rows), st, run_date="2024-01-01").collect()
    _put(src + "/a2", "a2\n", age=20)
    rows.append(("a", "t", src, tmp + "/two"))
    land_files(spark, _file_control(spark, rows), st, run_date="2024-01-01").collect()
    assert _lines(spark, tmp + "/one/t") == _lines(spark, tmp + "/two/t") == ["a1", "a2"]


def test_two_control_files_route_each_member_once(spark, tmp):
    from tidelake.sources.control import read_control
    src = tmp + "/src"
    _zip(src + "/1.zip", {"cust_1": "c\n", "supp_1": "s\n"})
    os.makedirs(tmp + "/ctl")
    for name, pattern, table in (("a", "cust", "customer"), ("b", "supp", "supplier")):
        _put(f"{tmp}/ctl/{name}.csv", f"pattern,table_name,source_dir,target_dir\n{pattern},{table},{src},{tmp}/lake\n")
    land_files(spark, read_control(spark, tmp + "/ctl", "files"), tmp + "/state", mode="consolidated").collect()
    assert _lines(spark, tmp + "/lake/customer") == ["c"] and _lines(spark, tmp + "/lake/supplier") == ["s"]


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_members_of_one_name_and_damaged_members(spark, tmp):
    src = tmp + "/src"
    os.makedirs(src)
    with zipfile.ZipFile(src + "/1.zip", "w") as z:
        z.writestr("cust_1.txt", "one\n")
        z.writestr("cust_1.txt", "two\n")
    with zipfile.ZipFile(src + "/2.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("cust_2.txt", "".join(f"{i}\n" for i in range(5000)))
        z.writestr("cust_3.txt", "whole\n")
    data = bytearray(open(src + "/2.zip", "rb").read())
    data[200] ^= 0xFF  # inside the first member: its sum no longer holds
    open(src + "/2.zip", "wb").write(bytes(data))
    with zipfile.ZipFile(src + "/3.zip", "w") as z:
        z.writestr("cust_4.txt", "secret\n")
    data = bytearray(open(src + "/3.zip", "rb").read())
    data[data.index(b"PK\x01\x02") + 8] |= 1  # the directory says that it is encrypted
    open(src + "/3.zip", "wb").write(bytes(data))
    ctrl = _file_control(spark, [("cust", "customer", src, tmp + "/lake")])
    rep = land_files(spark, ctrl, tmp + "/state", mode="consolidated").collect()
    assert sorted((r.status, os.path.basename(r.table_name)) for r in rep) == [("failed", "2.zip"), ("failed", "3.zip"), ("ok", "customer")]
    assert _lines(spark, tmp + "/lake/customer") == ["one", "two"]
    _zip(src + "/2.zip", {"cust_2.txt": "good\n"})
    land_files(spark, ctrl, tmp + "/state", mode="consolidated").collect()
    assert _lines(spark, tmp + "/lake/customer") == ["good", "one", "two"]


# --- listings and lines by the tasks --------------------------------------------------------------

def test_listing_by_tasks_equals_the_file_index(spark, tmp):
    for name in ("a.txt", "b c#1.txt", "sub/x%20y.txt", "sub/deep/é.txt", "_hidden", ".also", "ä[1]{2}*.txt", "empty"):
        _put(f"{tmp}/src/{name}", "" if name == "empty" else name + "\n", age=1000)
    for args in ({}, {"recursive": True}, {"pattern": "b c#"}, {"pattern": "x", "recursive": True}):
        want = sorted(map(tuple, listing.list_files(spark, tmp + "/src", **args).collect()))
        found = listing.list_folders(spark, tmp + "/src", **args).where("length > 0")  # the index skips empty files
        got = sorted(map(tuple, found.collect()))
        assert got == want, args
    assert listing.list_folders(spark, tmp + "/src/*").count() == 1
    with pytest.raises(FileNotFoundError):
        listing.list_folders(spark, tmp + "/none")


def test_a_large_folder_is_listed_and_landed_by_tasks(spark, tmp):
    src = tmp + "/src"
    os.makedirs(src)
    for i in range(100_000):
        os.close(os.open(f"{src}/f{i:06d}", os.O_CREAT))
    _put(src + "/g1", "line\n")
    t = time.time()
    files = listing.list_folders(spark, src)
    assert files.count() == 100_001 and time.time() - t < 60
    assert not [op for op in ("binaryFile", "content") if op in files._jdf.queryExecution().toString()]
    rep = land_files(spark, _file_control(spark, [("g", "t", src, tmp + "/lake")]), tmp + "/state").collect()[0]
    assert (rep.n_files, rep.n_rows) == (1, 1)


def test_parts_of_a_file_give_each_line_once(tmp, monkeypatch):
    r = random.Random(0)
    path, packed = tmp + "/f", tmp + "/f.gz"
    for n in range(1200):
        monkeypatch.setattr(listing, "READ_BYTES", r.choice([1, 3, 7, 64]))
        text = b"".join(r.choice([b"a", b"bc", b"\n", b"\n\n", b"long" * 4, b"\r\n", b"\xff"]) for _ in range(r.randint(0, 14)))
        whole = text[:-1] if text.endswith(b"\n") else text
        want = [x[:-1] if x.endswith(b"\r") and (i < len(text.split(b"\n")) - 1) else x for i, x in enumerate(whole.split(b"\n"))] if text else []
        open(path, "wb").write(text)
        open(packed, "wb").write(gzip.compress(text))
        step = r.choice([1, 2, 3, 5, 8, 50])
        lines = lambda p, s: [x for a in range(0, max(len(text), 1), s) for b in listing._part_blocks(p, a, min(a + s, len(text)))
                              for x in listing.line_array(b).cast("binary").to_pylist()]
        got = lines(path, step)
        assert [x.rstrip(b"\r") for x in got] == [x.rstrip(b"\r") for x in want]
        assert [x.rstrip(b"\r") for x in lines(packed, 1 << 30)] == [x.rstrip(b"\r") for x in want]


def test_landed_bytes_are_kept_and_a_rewritten_file_waits(spark, tmp):
    src = tmp + "/src"
    os.makedirs(src)
    open(src + "/f1", "wb").write(b"caf\xe9\x07x\n")
    ctrl = _file_control(spark, [("f", "t", src, tmp + "/lake")])
    land_files(spark, ctrl, tmp + "/state", run_date="2024-01-01").collect()
    part = [os.path.join(d, f) for d, _, fs in os.walk(tmp + "/lake") for f in fs if f.startswith("part-")]
    assert b"".join(open(p, "rb").read() for p in part) == b"caf\xe9\x07x\n"
    files = listing.list_folders(spark, src)
    files.count()
    _put(src + "/f1", "more than before\n")
    assert listing.manifest_lines(files).count() == 0


# --- catalog relations ----------------------------------------------------------------------------

def test_sql_and_reader_agree_on_every_field(spark, tmp):
    _put(tmp + "/raw/date_part=2024-01-01/f", "1\x07\x07\\N\x07\n2\x07a\x072024-01-05\x07t\nx\x07\\N\x07bad\x07\n3\n")
    _put(tmp + "/raw/date_part=2024-01-02/f", "4\x07 b \x072024-01-06\x07q\"\n")
    ddl = "k int, `v w` string, d date, tail string"
    register_raw_table(spark, "tl_exact", tmp + "/raw", ddl)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(spark.table("tl_exact")) == rows(read_raw(spark, tmp + "/raw", schema=ddl))
    assert (None, None, None, "") in [tuple(r)[:4] for r in spark.table("tl_exact").collect()]
    plan = spark.sql("select k from tl_exact where date_part = date'2024-01-02'")
    assert [r.k for r in plan.collect()] == [4]
    assert "PartitionFilters: [isnotnull(date_part" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fmt", ["raw", "parquet"])
def test_catalog_relation_shows_committed_loads_only(spark, tmp, monkeypatch, fmt):
    import tidelake.operators.state as state_mod
    name = f"tl_committed_{fmt}"
    ctrl = _table_control(spark, [("append", "oracle", "hive", "T", "S", name, tmp + "/t", None, None, None, None, "k", None)])
    load = lambda n: ingest_tables(spark, ctrl, tmp + "/state", source=lambda row: _rows(spark, n), fmt=fmt).collect()[0].status
    assert load(3) == "ok"
    _crash_once(monkeypatch, state_mod, "append_state")
    assert load(5) == "failed" and spark.table(name).count() == 3
    assert read_loads(spark, tmp + "/t", tmp + "/state", schema=K, fmt=fmt).count() == 3
    assert load(5) == "ok" and spark.table(name).columns == ["k", "v", "date_part"]
    assert sorted(r.k for r in spark.table(name).collect()) == [1, 2, 3, 4, 5]
    assert spark.read.parquet(loads_path(tmp + "/state")).where("closed").count() == 1


# --- reconciliation and splits --------------------------------------------------------------------

@pytest.mark.parametrize("zipped", [False, True])
def test_a_line_lost_on_the_way_fails_the_load(spark, tmp, monkeypatch, zipped):
    import tidelake.plans.landing as mod
    src, st = tmp + "/src", tmp + "/state"
    if zipped:
        _zip(src + "/1.zip", {"f1": "a\nb\nc\n"})
    else:
        _put(src + "/f1", "a\nb\nc\n")
    ctrl = _file_control(spark, [("f", "t", src, tmp + "/lake")])
    real = mod.write_lines
    monkeypatch.setattr(mod, "write_lines", lambda df, folder, **o: real(df.where("value <> 'b'"), folder, **o))
    land = lambda: land_files(spark, ctrl, st, mode="consolidated" if zipped else None, check=True).collect()[0]
    rep = land()
    assert rep.status == "failed" and "written 3 rows, read back 2" in rep.message
    monkeypatch.setattr(mod, "write_lines", lambda df, folder, **o: real(df.select(F.replace("value", F.lit("b"), F.lit("B")).alias("value")), folder, **o))
    assert "content differs" in land().message
    monkeypatch.setattr(mod, "write_lines", real)
    assert (land().status, sorted(r._c0 for r in read_loads(spark, tmp + "/lake/t", st).collect())) == ("ok", ["a", "b", "c"])


def test_a_value_that_the_format_cannot_carry_fails_a_checked_import(spark, tmp):
    ctrl = _table_control(spark, [("append", "oracle", "normal", "T", "S", None, tmp + "/t", None, None, None, None, "k", None)])
    for text, status in (("two\nlines", "failed"), ("sep\x07arator", "failed"), ("plain", "ok")):
        df = spark.createDataFrame([(1, text), (2, None), (3, "")], "k long, v string")
        assert ingest_tables(spark, ctrl, tmp + "/state", source=lambda row: df, check=True).collect()[0].status == status


class _DuckJdbc:
    """Stands in for ``spark``: queries run in DuckDB, reads over predicates are recorded."""

    def __init__(self, spark, con):
        self.spark, self.con, self.predicates, self.query = spark, con, None, None

    @property
    def read(self):
        return self

    def format(self, f):
        return self

    def options(self, **o):
        return self

    def option(self, k, v):
        self.query = v if k == "query" else self.query
        return self

    def load(self):
        return self.spark.createDataFrame(self.con.execute(self.query).df())

    def jdbc(self, url, table, predicates, properties):
        self.predicates, self.table, self.properties = predicates, table, properties
        return self.spark.range(1)


def test_even_splits_of_skewed_and_text_keys(spark, tmp):
    import duckdb

    from tidelake.sources.relational import jdbc_options, read_jdbc
    con = duckdb.connect()
    con.execute("create schema S")
    con.execute("create table S.T as select case when i % 50 = 0 then null else i * i * i end as num, "
                "case when i % 3 = 0 then 'O''Brien' || (i % 100) else 'Customer#' || i end as txt, date '2020-01-01' + (i % 97)::int as day "
                "from range(1, 2001) r(i)")
    fake = _DuckJdbc(spark, con)
    opts = jdbc_options("oracle", server="db", port=1521, sid="X", schema="S", table="T")
    for column, where in (("num", None), ("txt", None), ("num", "num > 1000"), ("day", "txt like 'C%'")):
        read_jdbc(fake, opts, where=where, split_by=column, num_partitions=8, fetch_size=100, even=True)
        assert len(fake.predicates) == 8 and fake.properties["fetchsize"] == "100"
        total = con.execute(f"select count(*) from {fake.table}").fetchone()[0]
        per = [con.execute(f"select count(*) from {fake.table} where {p}").fetchone()[0] for p in fake.predicates]
        assert sum(per) == total and max(per) <= 2 * total / 8, (column, per)
    con.execute("create table S.H as select case when i < 900 then 5 else i end as num from range(1000) r(i)")
    read_jdbc(fake, jdbc_options("oracle", server="db", port=1, sid="X", schema="S", table="H"), split_by="num", num_partitions=4, even=True)
    per = [con.execute(f"select count(*) from S.H where {p}").fetchone()[0] for p in fake.predicates]
    assert sum(per) == 1000  # one value is one split, whatever its size


# --- landing streams ------------------------------------------------------------------------------

@pytest.mark.parametrize("zipped", [False, True])
def test_a_replayed_batch_lands_once(spark, tmp, monkeypatch, zipped):
    import tidelake.operators.state as state_mod
    from tidelake.streaming.landing import stream_land_tables
    src, st = tmp + "/src", tmp + "/state"

    def drop(k):
        if zipped:
            _zip(f"{src}/{k}.zip", {f"a{k}": f"a{k}\n", f"b{k}": f"b{k}\n"})
        else:
            _put(f"{src}/a{k}", f"a{k}\n")
            _put(f"{src}/b{k}", f"b{k}\n")
    ctrl = _file_control(spark, [("a", "ta", src, tmp + "/lake"), ("b", "tb", src, tmp + "/lake"), ("a1", "tc", src, tmp + "/lake")])
    run = lambda: stream_land_tables(spark, ctrl, st, tmp + "/ck", mode="consolidated" if zipped else None, run_date="2024-01-01").collect()
    drop(1)
    assert {r.status for r in run()} == {"ok"} and run() == []
    drop(2)
    real, calls = state_mod.append_state, []

    def dies(*a, **k):
        calls.append(1)
        if len(calls) == (1 if zipped else 2):  # the first table is committed, the second is not
            raise RuntimeError("driver died")
        return real(*a, **k)
    monkeypatch.setattr(state_mod, "append_state", dies)
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(state_mod, "append_state", real)
    run()
    _put(f"{src}/late.zip" if zipped else f"{src}/a0", "", age=0) if zipped else _put(f"{src}/a0", "a0\n", age=9e6)
    run()
    got = {t: sorted(r._c0 for r in read_loads(spark, f"{tmp}/lake/{t}", st).collect()) for t in ("ta", "tb")}
    assert got == {"ta": ["a1", "a2"] if zipped else ["a0", "a1", "a2"], "tb": ["b1", "b2"]}
    if not zipped:
        assert [r._c0 for r in read_loads(spark, f"{tmp}/lake/tc", st).collect()] == ["a1"]

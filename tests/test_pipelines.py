import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidelake.operators.validate import validate_table_control
from tidelake.plans.ingest import ingest_tables
from tidelake.plans.landing import land_files, pickup_files
from tidelake.registry import _file_control, _table_control, ddl_of, table
from tidelake.sinks.loads import read_loads
from tidelake.sinks.raw import write_raw
from tidelake.sources.control import read_control
from tidelake.sources.raw import read_raw
from tidelake.streaming.landing import stream_land


def test_control_file_quoting_header_and_order(spark, tmp):
    p = tmp + "/app.ctrl"
    with open(p, "w") as f:
        f.write("table_type,db_name,hive_normal,rdbms_table_name,schema_name,hive_table_name,target_dir,"
                "where_clause,split_by_col,fetch_size,num_mapper,check_column,last_value\n"
                "snapshot,oracle,normal,NATION,TPCH,,/t/nation,,n_nationkey,100,2,,\n"
                "append,sqlserver,hive,ORDERS,TPCH,orders,/t/orders,\"o_orderstatus in ('F','O')\",,,,o_orderkey,10000\n"
                "bogus,mysql,both,,TPCH,,,,,,,,\n")
    ctrl = read_control(spark, p, "tables")
    rows = validate_table_control(ctrl).orderBy("line_no").collect()
    assert [r.line_no for r in rows] == [1, 2, 3]
    assert rows[1].where_clause == "o_orderstatus in ('F','O')"
    assert (rows[0].fetch_size, rows[0].num_mapper, rows[1].fetch_size) == (100, 2, None)
    assert [(r.mode, r.error) for r in rows] == [
        ("snapshot", None), ("incremental", None),
        (None, "table_type,db_name,hive_normal,rdbms_table_name")]


def _orders_ctrl(spark, target, table_type="append"):
    return _table_control(spark, [(table_type, "oracle", "normal", "ORDERS", "TPCH", None, target, None,
                                   None, None, None, "o_orderkey", None)])


def test_append_three_runs(spark, tmp):
    orders = table(spark, SF_SMALL, "orders")
    target, st = tmp + "/orders", tmp + "/state"
    ctrl = _orders_ctrl(spark, target)
    runs = [(orders.where("o_orderkey <= 700"), "2024-01-01"), (orders, "2024-01-02"), (orders, "2024-01-03")]
    statuses = []
    for src, day in runs:
        rep = ingest_tables(spark, ctrl, st, source=lambda row, s=src: s, app="erp", run_date=day).collect()
        statuses.append((rep[0].status, rep[0].n_rows))
    n_first = orders.where("o_orderkey <= 700").count()
    assert statuses == [("ok", n_first), ("ok", orders.count() - n_first), ("no_new_data", 0)]
    out = read_raw(spark, target, schema=ddl_of(orders))
    assert out.count() == orders.count()
    assert {r.date_part.isoformat() for r in out.select("date_part").distinct().collect()} == {"2024-01-01", "2024-01-02"}


def test_snapshot_replaces_all_partitions_and_failure_keeps_target(spark, tmp):
    orders = table(spark, SF_SMALL, "orders")
    target, st = tmp + "/orders", tmp + "/state"
    ctrl = _orders_ctrl(spark, target, "snapshot")
    ingest_tables(spark, ctrl, st, source=lambda row: orders, run_date="2024-01-01").collect()
    ingest_tables(spark, ctrl, st, source=lambda row: orders.where("o_orderstatus = 'F'"), run_date="2024-01-02").collect()
    out = read_loads(spark, target, st, schema=ddl_of(orders))
    assert out.count() == orders.where("o_orderstatus = 'F'").count()
    assert [r[0].isoformat() for r in out.select("date_part").distinct().collect()] == ["2024-01-02"]

    def broken(row):
        return orders.withColumn("o_totalprice", F.raise_error(F.lit("source went away")))
    rep = ingest_tables(spark, ctrl, st, source=broken, run_date="2024-01-03").collect()
    assert rep[0].status == "failed"
    assert read_loads(spark, target, st, schema=ddl_of(orders)).count() == orders.where("o_orderstatus = 'F'").count()


def test_one_failed_table_does_not_stop_the_others(spark, tmp):
    nation = table(spark, SF_SMALL, "nation")
    ctrl = _table_control(spark, [
        ("snapshot", "oracle", "normal", "MISSING", "TPCH", None, tmp + "/m", None, None, None, None, None, None),
        ("snapshot", "oracle", "hive", "NATION", "TPCH", "tidelake_nation_t", tmp + "/n", None, None, None, None, None, None),
        ("lastmodified", "teradata", "normal", "X", "TPCH", None, tmp + "/x", None, None, None, None, None, None),
    ])

    def source(row):
        if row["rdbms_table_name"] == "MISSING":
            raise RuntimeError("table not found")
        return nation
    rep = {r.table_name: r for r in ingest_tables(spark, ctrl, tmp + "/state", source=source).collect()}
    assert rep["MISSING"].status == "failed" and rep["NATION"].status == "ok"
    assert rep["X"].status == "invalid" and rep["X"].message == "check_column"
    assert spark.table("tidelake_nation_t").count() == 25


def test_lastmodified_window(spark, tmp):
    orders = table(spark, SF_SMALL, "orders")
    ctrl = _table_control(spark, [("lastmodified", "oracle", "normal", "ORDERS", "TPCH", None, tmp + "/o",
                                   None, None, None, None, "o_orderdate", "1998-01-01")])
    rep = ingest_tables(spark, ctrl, tmp + "/state", source=lambda r: orders, run_start="1998-06-01 00:00:00").collect()
    want = orders.where("o_orderdate >= '1998-01-01' and o_orderdate < '1998-06-01'").count()
    assert rep[0].n_rows == want
    rep2 = ingest_tables(spark, ctrl, tmp + "/state", source=lambda r: orders, run_start="1999-01-01 00:00:00").collect()
    assert rep2[0].n_rows == orders.where("o_orderdate >= '1998-06-01' and o_orderdate < '1999-01-01'").count()
    rep3 = ingest_tables(spark, ctrl, tmp + "/state", source=lambda r: orders, run_start="1999-01-01 00:00:00").collect()
    assert rep3[0].status == "no_new_data"
    assert read_raw(spark, tmp + "/o", schema=ddl_of(orders)).count() == rep[0].n_rows + rep2[0].n_rows


def test_gzip_landing_twice_then_nothing_new(spark, tmp):
    cust = table(spark, SF_SMALL, "customer")
    src, target, st = tmp + "/src", tmp + "/lake", tmp + "/state"
    write_raw(cust.where("c_nationkey < 10"), src, compression="gzip")
    ctrl = _file_control(spark, [("part-", "customer", src, target), ("nomatch", "other", src, target)])
    r1 = {r.table_name: r for r in land_files(spark, ctrl, st, app="crm", run_date="2024-01-01").collect()}
    assert r1["customer"].status == "ok" and r1["other"].status == "no_new_data"
    write_raw(cust.where("c_nationkey >= 10"), src, compression="gzip")
    r2 = {r.table_name: r for r in land_files(spark, ctrl, st, app="crm", run_date="2024-01-02").collect()}
    r3 = {r.table_name: r for r in land_files(spark, ctrl, st, app="crm", run_date="2024-01-03").collect()}
    assert r2["customer"].n_rows == cust.where("c_nationkey >= 10").count()
    assert r3["customer"].status == "no_new_data"
    out = read_loads(spark, target + "/customer", st, schema=ddl_of(cust))
    assert out.drop("date_part").exceptAll(cust).count() == 0 and out.count() == cust.count()


def test_invalid_landing_mode_rejected(spark, tmp):
    ctrl = _file_control(spark, [("p", "t", tmp, tmp)])
    with pytest.raises(ValueError):
        land_files(spark, ctrl, tmp + "/state", mode="zipped")


def test_pickup_only_newer_files(spark, tmp):
    src, stage, st = tmp + "/bucket", tmp + "/stage", tmp + "/state"
    os.makedirs(src)
    for i in range(3):
        with open(f"{src}/f{i}.txt", "w") as f:
            f.write(f"a{i}\nb{i}\n")
        os.utime(f"{src}/f{i}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    assert pickup_files(spark, src, stage, st).first().n_rows == 6
    with open(f"{src}/f9.txt", "w") as f:
        f.write("z\n")
    rep = pickup_files(spark, src, stage, st).first()
    assert (rep.n_files, rep.n_rows) == (1, 1)
    assert pickup_files(spark, src, stage, st).first().status == "no_new_data"
    assert spark.read.text(stage).count() == 7


def test_stream_landing_runs_and_archives_with_one_run_lag(spark, tmp):
    src, target, archive, ckpt = tmp + "/src", tmp + "/lake", tmp + "/archive", tmp + "/ckpt"
    spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")
    try:
        seen = []
        for i in range(3):
            os.makedirs(f"{src}/d{i}")
            with open(f"{src}/d{i}/f.txt", "w") as f:
                f.write(f"row{i}a\nrow{i}b\n")
            seen.append(stream_land(spark, f"{src}/*", target, checkpoint=ckpt, archive_dir=archive)["rows"])
        assert seen == [2, 2, 2]
        assert stream_land(spark, f"{src}/*", target, checkpoint=ckpt, archive_dir=archive)["rows"] == 0
    finally:
        spark.conf.unset("spark.sql.streaming.fileSource.cleaner.numThreads")
    assert spark.read.text(target).count() == 6
    archived = spark.read.option("recursiveFileLookup", "true").text(archive).count()
    assert archived >= 4


def test_watermark_not_advanced_when_the_write_fails(spark, tmp):
    from tidelake.operators.state import read_state
    orders = table(spark, SF_SMALL, "orders")
    target, st = tmp + "/orders", tmp + "/state"
    ctrl = _orders_ctrl(spark, target)
    broken = orders.withColumn("o_comment", F.raise_error(F.lit("disk full")))
    rep = ingest_tables(spark, ctrl, st, source=lambda row: broken, app="erp").collect()
    assert rep[0].status == "failed" and read_state(spark, st) is None
    rep = ingest_tables(spark, ctrl, st, source=lambda row: orders, app="erp").collect()
    assert (rep[0].status, rep[0].n_rows) == ("ok", orders.count())


def test_file_names_with_spaces_land(spark, tmp):
    src, target = tmp + "/src", tmp + "/lake"
    os.makedirs(src)
    with open(src + "/daily sales 01.txt", "w") as f:
        f.write("1\u0007a\n2\u0007b\n")
    ctrl = _file_control(spark, [("daily sales", "sales", src, target)])
    rep = land_files(spark, ctrl, tmp + "/state", app="shop").collect()
    assert (rep[0].status, rep[0].n_files, rep[0].n_rows) == ("ok", 1, 2)
    assert spark.read.text(target + "/sales").count() == 2


def test_first_control_row_per_file(spark, tmp):
    from tidelake.sources.control import first_row
    p = tmp + "/files.ctrl"
    with open(p, "w") as f:
        f.write("pattern,table_name,source_dir,target_dir\n"
                "cust,customer,/in/a,/lake\n"
                "supp,supplier,/in/b,/lake\n")
    ctrl = read_control(spark, p, "files")
    assert [(r.line_no, r.source_dir) for r in first_row(ctrl).collect()] == [(1, "/in/a")]


def test_read_increment_modes(spark):
    from tidelake.operators.increments import read_increment
    orders = table(spark, SF_SMALL, "orders")
    assert read_increment(orders, "o_orderkey", "1000").count() == orders.where("o_orderkey > 1000").count()
    assert read_increment(orders, "o_orderkey", "99999").count() == 0
    lm = read_increment(orders, "o_orderdate", "1998-01-01", "lastmodified", run_start="1999-01-01")
    assert lm.count() == orders.where("o_orderdate >= '1998-01-01' and o_orderdate < '1999-01-01'").count()
    with pytest.raises(ValueError):
        read_increment(orders, "o_orderkey", "1", "merge")


def test_pickup_archives_previous_batch(spark, tmp):
    src, stage, arch, st = tmp + "/bucket", tmp + "/stage", tmp + "/archive", tmp + "/state"
    os.makedirs(src)

    def drop(name, t, text):
        with open(f"{src}/{name}", "w") as f:
            f.write(text)
        os.utime(f"{src}/{name}", (t, t))
    drop("a.txt", 1_700_000_000, "a1\na2\n")
    pickup_files(spark, src, stage, st, archive_dir=arch).collect()
    drop("b.txt", 1_700_000_100, "b1\n")
    pickup_files(spark, src, stage, st, archive_dir=arch).collect()
    assert sorted(r.value for r in spark.read.text(stage).collect()) == ["b1"]
    assert sorted(r.value for r in spark.read.option("recursiveFileLookup", "true").text(arch).collect()) == ["a1", "a2"]
    assert pickup_files(spark, src, stage, st, archive_dir=arch).first().status == "no_new_data"
    assert sorted(r.value for r in spark.read.text(stage).collect()) == ["b1"]


def test_stream_raw_to_cleansed_runs(spark, tmp):
    from tidelake.streaming.landing import stream_raw_to_cleansed
    nation = table(spark, SF_SMALL, "nation")
    raw, out, ckpt = tmp + "/raw", tmp + "/cleansed", tmp + "/ckpt"
    write_raw(nation.where("n_regionkey < 2"), raw)
    r1 = stream_raw_to_cleansed(spark, raw, out, ddl_of(nation), checkpoint=ckpt, run_date="2024-01-01")
    write_raw(nation.where("n_regionkey >= 2"), raw)
    r2 = stream_raw_to_cleansed(spark, raw, out, ddl_of(nation), checkpoint=ckpt, run_date="2024-01-02")
    r3 = stream_raw_to_cleansed(spark, raw, out, ddl_of(nation), checkpoint=ckpt, run_date="2024-01-03")
    assert (r1["rows"] + r2["rows"], r3["rows"]) == (25, 0)
    got = spark.read.format("com.databricks.spark.avro").load(out)
    assert got.drop("date_part").exceptAll(nation).count() == 0 and got.count() == 25
    assert {r[0].isoformat() for r in got.select("date_part").distinct().collect()} == {"2024-01-01", "2024-01-02"}


def test_pickup_watermark_independent_of_session_time_zone(spark, tmp):
    src, stage, st = tmp + "/bucket", tmp + "/stage", tmp + "/state"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("a\n")
    os.utime(f"{src}/a.txt", (1_700_000_000, 1_700_000_000))
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert pickup_files(spark, src, stage, st).first().n_files == 1
        with open(f"{src}/b.txt", "w") as f:
            f.write("b\n")
        os.utime(f"{src}/b.txt", (1_700_000_060, 1_700_000_060))
        rep = pickup_files(spark, src, stage, st).first()
        assert (rep.status, rep.n_files) == ("ok", 1)
        assert pickup_files(spark, src, stage, st).first().status == "no_new_data"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_catalog_partitions_follow_appends_and_snapshots(spark, tmp):
    orders = table(spark, SF_SMALL, "orders")
    app_ctrl = _table_control(spark, [("append", "oracle", "hive", "ORDERS", "TPCH", "tl_orders_app",
                                       tmp + "/a", None, None, None, None, "o_orderkey", None)])
    snap_ctrl = _table_control(spark, [("snapshot", "oracle", "hive", "ORDERS", "TPCH", "tl_orders_snap",
                                        tmp + "/s", None, None, None, None, None, None)])
    for day, src in (("2024-01-01", orders.where("o_orderkey <= 700")), ("2024-01-02", orders)):
        for ctrl, st in ((app_ctrl, tmp + "/st_a"), (snap_ctrl, tmp + "/st_s")):
            rep = ingest_tables(spark, ctrl, st, source=lambda row, s=src: s, run_date=day).collect()
            assert rep[0].status == "ok"
    parts = lambda t: sorted(r[0].split("/")[0] for r in spark.sql(f"SHOW PARTITIONS {t}__lines").collect())
    assert parts("tl_orders_app") == ["date_part=2024-01-01", "date_part=2024-01-02"]
    assert spark.table("tl_orders_app").count() == orders.count()
    assert parts("tl_orders_snap") == ["date_part=2024-01-02"]
    assert spark.table("tl_orders_snap").count() == orders.count()


def _crash_once(monkeypatch, module, name):
    real = getattr(module, name)
    calls = {"n": 0}

    def boom(*a, **k):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("driver died")
        return real(*a, **k)
    monkeypatch.setattr(module, name, boom)


def test_append_rerun_after_crash_before_watermark_loads_once(spark, tmp, monkeypatch):
    import tidelake.operators.state as state_mod
    orders = table(spark, SF_SMALL, "orders")
    target, st = tmp + "/orders", tmp + "/state"
    ctrl = _orders_ctrl(spark, target)
    _crash_once(monkeypatch, state_mod, "append_state")
    rep = ingest_tables(spark, ctrl, st, source=lambda row: orders, app="erp").collect()
    assert rep[0].status == "failed"
    assert read_raw(spark, target, schema=ddl_of(orders)).count() == orders.count()  # data written, uncommitted
    assert read_loads(spark, target, st, schema=ddl_of(orders)).count() == 0
    rep = ingest_tables(spark, ctrl, st, source=lambda row: orders, app="erp").collect()
    assert (rep[0].status, rep[0].n_rows) == ("ok", orders.count())
    out = read_loads(spark, target, st, schema=ddl_of(orders))
    assert out.count() == orders.count() and out.drop("date_part").exceptAll(orders).count() == 0


def test_landing_rerun_after_crash_midway_through_the_write_loads_once(spark, tmp, monkeypatch):
    import tidelake.plans.landing as landing_mod
    cust = table(spark, SF_SMALL, "customer")
    src, target, st = tmp + "/src", tmp + "/lake", tmp + "/state"
    write_raw(cust.repartition(4), src, compression="gzip")
    ctrl = _file_control(spark, [("part-", "customer", src, target)])
    real = landing_mod.write_lines

    def half(lines, folder, **options):
        real(lines.limit(20), folder, **options)  # some files are there, then the driver dies
        raise RuntimeError("driver died")
    monkeypatch.setattr(landing_mod, "write_lines", half)
    assert land_files(spark, ctrl, st, app="crm").collect()[0].status == "failed"
    assert read_loads(spark, target + "/customer", st, schema=ddl_of(cust)).count() == 0
    monkeypatch.setattr(landing_mod, "write_lines", real)
    rep = land_files(spark, ctrl, st, app="crm").collect()[0]
    assert (rep.status, rep.n_rows) == ("ok", cust.count())
    out = read_raw(spark, target + "/customer", schema=ddl_of(cust))
    assert out.count() == cust.count()
    assert land_files(spark, ctrl, st, app="crm").collect()[0].status == "no_new_data"


def test_compaction_keeps_committed_loads(spark, tmp):
    from tidelake.operators.state import compact_state, read_state
    from tidelake.sinks.loads import committed_loads
    orders = table(spark, SF_SMALL, "orders")
    target, st = tmp + "/orders", tmp + "/state"
    ctrl = _orders_ctrl(spark, target)
    for src in (orders.where("o_orderkey <= 700"), orders):
        ingest_tables(spark, ctrl, st, source=lambda row, s=src: s, app="erp").collect()
    compact_state(spark, st)
    assert read_state(spark, st).count() == 1 and committed_loads(spark, st).count() == 2
    rep = ingest_tables(spark, ctrl, st, source=lambda row: orders, app="erp").collect()
    assert rep[0].status == "no_new_data"
    top = orders.agg(F.max("o_orderkey")).first()[0]
    late = orders.where(F.col("o_orderkey") == top).limit(1).withColumn("o_totalprice", F.lit(0.5))  # a row at the watermark
    for n in (1, 0):
        rep = ingest_tables(spark, ctrl, st, source=lambda row: orders.unionByName(late), app="erp").collect()
        assert rep[0].n_rows == n
    assert read_loads(spark, target, st, schema=ddl_of(orders)).count() == orders.count() + 1


def test_stream_land_continuous_mode_returns_running_query(spark, tmp):
    src, target = tmp + "/src", tmp + "/lake"
    os.makedirs(src)
    with open(src + "/a.txt", "w") as f:
        f.write("x\ny\n")
    q = stream_land(spark, src, target, checkpoint=tmp + "/ckpt", processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.text(target).count() == 2


class _RecordingJdbc:
    """Stands in for ``spark`` inside ``jdbc_source``: records each JDBC read's options and
    returns a fixed table instead of querying a database."""

    def __init__(self, frame):
        self.frame, self.loads = frame, []

    @property
    def read(self):
        outer, opts = self, {}

        class R:
            def format(self, f):
                return self

            def options(self, **o):
                opts.update(o)
                return self

            def option(self, k, v):
                opts[k] = v
                return self

            def load(self):
                outer.loads.append(dict(opts))
                return outer.frame
        return R()


def test_jdbc_increment_splits_over_the_increment_range(spark, tmp):
    from tidelake.plans.ingest import jdbc_source
    orders = table(spark, SF_SMALL, "orders")
    fake = _RecordingJdbc(orders)
    ctrl = _table_control(spark, [("append", "oracle", "normal", "ORDERS", "TPCH", None, tmp + "/o", None,
                                   "o_orderkey", 1000, 4, "o_orderkey", "700")])
    rep = ingest_tables(spark, ctrl, tmp + "/st", app="erp",
                        source=jdbc_source(fake, {"oracle": {"server": "db", "port": 1521, "sid": "X"}})).collect()
    want = orders.where("o_orderkey > 700")
    assert (rep[0].status, rep[0].n_rows) == ("ok", want.count())
    first, second = fake.loads
    assert "partitionColumn" not in first and first["fetchsize"] == "1000"
    lo, hi = want.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    assert (second["partitionColumn"], second["lowerBound"], second["upperBound"], second["numPartitions"]) == \
        ("o_orderkey", str(lo), str(hi), "4")


def test_landing_file_names_with_glob_characters(spark, tmp):
    src, target = tmp + "/src", tmp + "/lake"
    os.makedirs(src)
    for name in ("feed[1].txt", "feed{a,b}.txt", "feed*.txt"):
        with open(f"{src}/{name}", "w") as f:
            f.write(name + "\n")
    ctrl = _file_control(spark, [("feed", "feed", src, target)])
    rep = land_files(spark, ctrl, tmp + "/state", app="x").collect()[0]
    assert (rep.status, rep.n_files, rep.n_rows) == ("ok", 3, 3)
    assert sorted(r.value for r in spark.read.text(target + "/feed").collect()) == \
        ["feed*.txt", "feed[1].txt", "feed{a,b}.txt"]


def test_raw_to_cleansed_reads_only_selected_partitions(spark, tmp):
    from tidelake.plans.cleansed import raw_to_cleansed
    nation = table(spark, SF_SMALL, "nation")
    for day in ("2024-01-01", "2024-01-02"):
        write_raw(nation, f"{tmp}/raw/date_part={day}")
    out = raw_to_cleansed(spark, tmp + "/raw", tmp + "/cleansed", run_date="2024-01-03",
                          schema=ddl_of(nation), raw_partitions=["2024-01-02"])
    assert out.count() == 25
    from tidelake.sources.raw import read_raw as rr
    plan = (rr(spark, tmp + "/raw", schema=ddl_of(nation)).where(F.col("date_part").isin(F.lit("2024-01-02").cast("date")))
            ._jdf.queryExecution().executedPlan().toString())
    assert "PartitionFilters: [isnotnull(date_part" in plan


def test_recover_target_after_interrupted_swap(spark, tmp):
    from tidelake.session import recover_target
    nation = table(spark, SF_SMALL, "nation")
    target = tmp + "/t"
    nation.write.parquet(target + ".__old-aaa")          # target moved aside, never replaced
    nation.limit(3).write.parquet(target + ".__staging-bbb")  # half-finished replacement
    recover_target(spark, target)
    assert spark.read.parquet(target).count() == 25
    assert sorted(os.listdir(tmp)) == ["t"]
    nation.limit(2).write.parquet(target + ".__staging-ccc")  # stale staging next to a good target
    recover_target(spark, target)
    assert sorted(os.listdir(tmp)) == ["t"] and spark.read.parquet(target).count() == 25

import io
import os
import zipfile

import pytest

from tests.conftest import SF_SMALL
from tidelake.plans.landing import land_files
from tidelake.registry import _file_control, table
from tidelake.sources.archives import zip_member_lines, zip_members
from tidelake.sources.listing import list_files
from tidelake.sources.relational import jdbc_options


def test_jdbc_options_per_vendor():
    o = jdbc_options("oracle", server="db", port=1521, sid="ORCL", schema="TPCH", table="NATION")
    assert o["dbtable"] == "TPCH.NATION" and o["url"] == "jdbc:oracle:thin:@db:1521/ORCL"
    s = jdbc_options("sqlserver", server="db", port=1433, schema="TPCH", table="ORDERS", fetchsize=100)
    assert s["dbtable"] == "ORDERS" and "databaseName=TPCH" in s["url"] and s["fetchsize"] == "100"
    t = jdbc_options("Teradata", server="td", schema="TPCH", table="T")
    assert t["url"] == "jdbc:teradata://td/DATABASE=TPCH"
    with pytest.raises(ValueError):
        jdbc_options("mysql", server="x", table="T")
    with pytest.raises(ValueError):
        jdbc_options("oracle", server="x", table="")


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text)
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def test_zip_members_and_lines(spark, tmp):
    os.makedirs(tmp + "/src/sub")
    _zip(tmp + "/src/a.zip", {"cust_1.txt": "1\u0007x\n2\u0007y\n", "dir/supp_1.txt": "7\r\n8\r\n"})
    _zip(tmp + "/src/sub/b c#1.zip", {"cust_2.txt": "3\u0007z", "junk.txt": "q\n"})
    with open(tmp + "/src/readme.txt", "w") as f:  # not an archive: skipped
        f.write("hello\n")
    archives = list_files(spark, tmp + "/src", recursive=True)
    members = zip_members(archives)
    assert members.count() == 4
    lines = zip_member_lines(members.select("archive", "member", "position"), num_partitions=3)
    got = sorted((r.member, r.line_no, r.value) for r in lines.collect())
    assert ("cust_2.txt", 0, "3\u0007z") in got and ("dir/supp_1.txt", 1, "8") in got
    assert len(got) == 6


def test_zip_landing_first_match_and_purge(spark, tmp):
    src, target = tmp + "/src", tmp + "/lake"
    os.makedirs(src)
    _zip(src + "/drop.zip", {"cust_1.txt": "1\n2\n", "customer_x.txt": "3\n", "supp_1.txt": "4\n", "junk.txt": "5\n"})
    ctrl = _file_control(spark, [("cust", "customer", src, target), ("customer", "other", src, target),
                                 ("supp", "supplier", src, target)])
    rep = {r.table_name: r for r in land_files(spark, ctrl, tmp + "/state", app="a", mode="consolidated",
                                               run_date="2024-01-02").collect()}
    assert (rep["customer"].n_files, rep["customer"].n_rows) == (2, 3)
    assert rep["other"].n_rows == 0 and rep["supplier"].n_rows == 1
    import os as _os
    assert sorted(d for d in _os.listdir(target) if d[0] not in "_.") == ["customer", "supplier"]
    landed = {(t, r.value) for t in ("customer", "supplier") for r in spark.read.text(f"{target}/{t}").collect()}
    assert ("customer", "3") in landed and all(v != "5" for _, v in landed)
    assert {r.date_part.isoformat() for r in spark.read.text(f"{target}/customer").collect()} == {"2024-01-02"}
    again = land_files(spark, ctrl, tmp + "/state", app="a", mode="consolidated").collect()
    assert {r.status for r in again} == {"no_new_data"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_projection_reach_the_scan(spark):
    from tidelake.registry import source_where_pushdown
    p = _plan(source_where_pushdown(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in p


def test_increment_predicate_is_pushed(spark):
    from tidelake.operators.increments import append_increment
    p = _plan(append_increment(table(spark, SF_SMALL, "orders"), "o_orderkey", "100", 900))
    assert "GreaterThan(o_orderkey,100)" in p and "LessThanOrEqual(o_orderkey,900)" in p


def test_partition_pruning_on_catalog_table(spark):
    from tidelake.registry import _registered_customer
    name = _registered_customer(spark, SF_SMALL)
    p = _plan(spark.table(name).where("date_part = date'2024-01-02'").select("c_custkey"))
    assert "PartitionFilters: [isnotnull(date_part" in p
    assert "ReadSchema: struct<value:string>" in p and "c_name" not in p


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 1500 and "date_part" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    from tidelake.registry import QUERIES
    assert set(QUERIES) <= set(q) and set(QUERIES) - set(o) == set()


def test_large_member_is_streamed(spark, tmp):
    import random
    rnd = random.Random(5)
    lines = ["" if rnd.random() < 0.05 else "r%d_" % i + "y" * rnd.randint(0, 40) for i in range(3000)]
    body = "".join(l + ("\r\n" if i % 7 == 0 else "\n") for i, l in enumerate(lines))
    body = body.rstrip("\n").rstrip("\r")  # last line without a line break
    os.makedirs(tmp + "/src")
    _zip(tmp + "/src/big.zip", {"big.txt": body, "small.txt": "a\nb\n"})
    members = zip_members(list_files(spark, tmp + "/src"))
    whole = sorted((r.member, r.line_no, r.value) for r in zip_member_lines(members).collect())
    assert [v for m, _, v in whole if m == "big.txt"] == lines
    assert [n for m, n, _ in whole if m == "big.txt"] == list(range(len(lines)))


class _Counting(io.BytesIO):
    """Counts the bytes handed out."""
    given = 0

    def read(self, n=-1):
        out = super().read(n)
        self.given += len(out)
        return out


@pytest.mark.parametrize("read_bytes", [7, 64, 1 << 20])
def test_member_is_read_once(monkeypatch, read_bytes):
    import random
    from tidelake.sources import archives
    monkeypatch.setattr(archives, "READ_BYTES", read_bytes)
    rnd = random.Random(read_bytes)
    lines = ["é%d" % i + "z" * rnd.randint(0, 30) if rnd.random() > 0.1 else "" for i in range(400)]
    body = "".join(l + ("\r\n" if rnd.random() < 0.3 else "\n") for l in lines).encode() + b"tail"
    raw = _Counting(body)
    got = [x for first, batch in archives.member_line_batches(raw) for x in enumerate(batch, start=first)]
    assert got == list(enumerate(lines + ["tail"]))
    assert raw.given == len(body)


class _FakeReader:
    """Records what a JDBC read would be configured with (no database needed)."""

    def __init__(self, log, frame):
        self.log, self.frame = log, frame

    def format(self, f):
        self.log["format"] = f
        return self

    def options(self, **o):
        self.log.setdefault("options", {}).update(o)
        return self

    def option(self, k, v):
        self.log.setdefault("options", {})[k] = v
        return self

    def load(self):
        return self.frame


class _FakeSpark:
    def __init__(self, log, frame):
        self.read = _FakeReader(log, frame)


def test_read_jdbc_wires_split_fetch_and_where(spark):
    from tidelake.sources.relational import read_jdbc
    log = {}
    frame = table(spark, SF_SMALL, "nation")
    opts = jdbc_options("oracle", server="db", port=1521, sid="ORCL", schema="TPCH", table="NATION")
    where = "NVL(n_regionkey, 1) = 1 AND ROWNUM < 9"  # the database's own dialect
    df = read_jdbc(_FakeSpark(log, frame), opts, where=where, split_by="n_nationkey",
                   num_partitions=4, fetch_size=500, bounds=(0, 24))
    o = log["options"]
    assert log["format"] == "jdbc" and o["dbtable"] == f"(SELECT * FROM TPCH.NATION WHERE {where}) q"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("n_nationkey", "0", "24", "4")
    assert o["fetchsize"] == "500" and o["preferTimestampNTZ"] == "true"
    assert df.count() == frame.count()
    read_jdbc(_FakeSpark(log, frame), opts)
    assert log["options"]["dbtable"] == "TPCH.NATION"


def test_split_bounds_query_uses_the_where(spark):
    from tidelake.sources.relational import split_bounds
    log = {}
    frame = spark.createDataFrame([(3, 9)], "lo int, hi int")
    opts = jdbc_options("sqlserver", server="db", port=1433, schema="TPCH", table="ORDERS")
    assert split_bounds(_FakeSpark(log, frame), opts, "o_orderkey", "o_orderstatus = 'F'") == (3, 9)
    assert log["options"]["query"] == ("SELECT MIN(o_orderkey) AS lo, MAX(o_orderkey) AS hi FROM ORDERS "
                                       "WHERE o_orderstatus = 'F'")
    assert "dbtable" not in log["options"]


def test_read_jdbc_text_split_column_reads_unsplit(spark):
    from tidelake.sources.relational import read_jdbc
    log = {}
    opts = jdbc_options("teradata", server="td", schema="TPCH", table="NATION")
    read_jdbc(_FakeSpark(log, table(spark, SF_SMALL, "nation")), opts, split_by="n_name",
              num_partitions=4, bounds=("ALGERIA", "VIETNAM"))
    assert "partitionColumn" not in log["options"]


def test_catalog_sink_targets(spark, tmp):
    from tidelake.sinks.tables import write_catalog_table
    from tidelake.sources.tables import register_raw_table, table_ddl
    from tidelake.sinks.raw import write_raw
    region = table(spark, SF_SMALL, "region")
    write_catalog_table(region, "unused_name", path=tmp + "/normal", target="normal")
    assert spark.read.parquet(tmp + "/normal").count() == 5
    with pytest.raises(ValueError):
        write_catalog_table(region, "x", path=tmp + "/x", target="both")
    write_raw(region, tmp + "/flat")
    register_raw_table(spark, "tl_region_flat", tmp + "/flat", "r_regionkey int, r_name string", partitioned=False)
    assert spark.table("tl_region_flat").count() == 5
    assert "CREATE VIEW" in table_ddl(spark, "tl_region_flat").first()[0]
    assert "CREATE TABLE" in table_ddl(spark, "tl_region_flat__lines").first()[0]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abé\r", max_size=6), max_size=30), st.booleans(), st.integers(min_value=1, max_value=9))
def test_member_lines_property(lines, final_break, read_bytes):
    from tidelake.sources import archives
    old = archives.READ_BYTES
    archives.READ_BYTES = read_bytes
    try:
        body = "\n".join(lines) + ("\n" if final_break and lines else "")
        whole = [t for _, b in archives.member_line_batches(io.BytesIO(body.encode())) for t in b]
        expected = body.split("\n")
        if expected and expected[-1] == "":
            expected = expected[:-1]
        assert whole == [t[:-1] if t.endswith("\r") else t for t in expected]
    finally:
        archives.READ_BYTES = old

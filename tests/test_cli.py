import io
import json

from tests.conftest import SF_SMALL
from tidelake.__main__ import main
from tidelake.registry import ddl_of, table
from tidelake.sinks.raw import write_raw
from tidelake.sources.tables import register_raw_table


def test_cli_raw_to_cleansed_and_query(spark, tmp):
    nation = table(spark, SF_SMALL, "nation")
    write_raw(nation, tmp + "/raw/date_part=2024-01-01")
    assert main(["raw-to-cleansed", tmp + "/raw", tmp + "/cleansed", "--schema", ddl_of(nation),
                 "--run-date", "2024-01-02"], spark=spark) == 0
    assert spark.read.format("com.databricks.spark.avro").load(tmp + "/cleansed").count() == 25
    register_raw_table(spark, "cli_nation", tmp + "/raw", ddl_of(nation))
    out = io.StringIO()
    assert main(["query", "cli_nation", "--columns", "n_nationkey,n_name", "--where", "n_regionkey=1"],
                spark=spark, out=out) == 0
    lines = out.getvalue().split()
    assert len(lines) == nation.where("n_regionkey = 1").count() and all("|" in l for l in lines)


def test_cli_land_and_pickup_report(spark, tmp):
    write_raw(table(spark, SF_SMALL, "region"), tmp + "/src", compression="gzip")
    with open(tmp + "/files.ctrl", "w") as f:
        f.write("pattern,table_name,source_dir,target_dir\n"
                f"part-,region,{tmp}/src,{tmp}/lake\n")
    out = io.StringIO()
    assert main(["land", "--control", tmp + "/files.ctrl", "--state", tmp + "/st", "--app", "a"],
                spark=spark, out=out) == 0
    assert "|region|files|ok|" in out.getvalue()
    out = io.StringIO()
    assert main(["pickup", tmp + "/src", tmp + "/stage", "--state", tmp + "/st2"], spark=spark, out=out) == 0
    assert "|ok|" in out.getvalue()


def test_cli_ingest_failure_sets_exit_status(spark, tmp):
    with open(tmp + "/app.ctrl", "w") as f:
        f.write("table_type,db_name,hive_normal,rdbms_table_name,schema_name,hive_table_name,target_dir,"
                "where_clause,split_by_col,fetch_size,num_mapper,check_column,last_value\n"
                f"snapshot,oracle,normal,NATION,TPCH,,{tmp}/t,,,,,,\n"
                "bogus,mysql,both,,TPCH,,,,,,,,\n")
    with open(tmp + "/conn.json", "w") as f:
        json.dump({"oracle": {"server": "nowhere.invalid", "port": 1521, "sid": "X"}}, f)
    out = io.StringIO()
    assert main(["ingest", "--control", tmp + "/app.ctrl", "--state", tmp + "/st", "--app", "erp",
                 "--connections", tmp + "/conn.json"], spark=spark, out=out) == 1
    text = out.getvalue()
    assert "|NATION|snapshot|failed|" in text and "|invalid|" in text


def test_cli_repair_overwrite_is_idempotent(spark, tmp):
    import os
    os.makedirs(tmp + "/tmpdrop")
    with open(tmp + "/tmpdrop/a.txt", "w") as f:
        f.write("1\u0007a\\\nb\n2\u0007c\n")
    for _ in range(2):
        assert main(["repair", tmp + "/tmpdrop", tmp + "/raw/date_part=2024-01-02", "--mode", "overwrite"],
                    spark=spark) == 0
    assert sorted(r.value for r in spark.read.text(tmp + "/raw").collect()) == ["1\u0007a\\ b", "2\u0007c"]


def test_cli_stream_land_remembers_files(spark, tmp):
    import os
    os.makedirs(tmp + "/in")
    with open(tmp + "/in/a.txt", "w") as f:
        f.write("x\ny\n")
    args = ["stream-land", tmp + "/in", tmp + "/lake", "--checkpoint", tmp + "/ckpt"]
    out = io.StringIO()
    assert main(args, spark=spark, out=out) == 0 and out.getvalue().strip().endswith("|2")
    out = io.StringIO()
    assert main(args, spark=spark, out=out) == 0 and out.getvalue().strip().endswith("|0")

"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, canon

from tidelake.registry import QUERIES

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    assert name in ORACLES
    rel = con.execute(ORACLES[name])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(rows, df.columns) == canon(rel.fetchall(), cols)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
PYTHON_MAP = ("MapInPandas", "PythonMapInArrow", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_plan_shape(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], plan
    if "zip" not in name and name not in ("multiline_repair", "repair_to_raw", "folder_listing"):  # passes over members, splits and files
        assert not [op for op in PYTHON_MAP if op in plan], plan

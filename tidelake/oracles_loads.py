"""DuckDB SQL of the queries in ``registry_loads``."""

STATEMENT = ("'CREATE TABLE spark_catalog.default.customer__lines ( value STRING, date_part DATE) USING text "
             "PARTITIONED BY (date_part) LOCATION ''customer'''")

STREAMED = " union all ".join(
    f"select '{t}' as table_name, cast({k} as varchar) as key, case when {k} % 2 = 0 then date '2024-01-01' else date '2024-01-02' end as date_part from {t}"
    for t, k in (("customer", "c_custkey"), ("supplier", "s_suppkey")))

LOAD_ORACLES = {
    "ingest_two_targets": ("select case when o_orderkey % 2 = 0 then 'even' else 'odd' end as target, *, "
                           "case when o_orderkey <= 5000 then date '2024-01-01' else date '2024-01-02' end as date_part from orders"),
    "snapshot_switch": "select *, date '2024-01-02' as date_part from orders",
    "increment_equal_values": (
        "with m as (select *, date_trunc('month', o_orderdate)::timestamp as o_month from orders), "
        "h as (select max(o_month) as hi from m where o_orderkey % 2 = 0) "
        "select m.*, case when o_orderkey % 2 = 0 then date '2024-01-01' else date '2024-01-02' end as date_part "
        "from m, h where o_orderkey % 2 = 0 or o_month >= hi"),
    "landing_equal_stamps": ("select *, case when c_custkey % 3 = 0 then date '2024-01-01' else date '2024-01-02' end as date_part "
                             "from customer where c_custkey % 3 < 2"),
    "landing_added_target": ("select 'one' as target, *, case when c_custkey % 2 = 0 then date '2024-01-01' else date '2024-01-02' end "
                             "as date_part from customer union all select 'two', *, date '2024-01-02' from customer"),
    "landing_overlapping_patterns": (
        "select 'all' as target, *, date '2024-01-02' as date_part from customer union all "
        "select 'even', *, date '2024-01-02' from customer where c_custkey % 2 = 0"),
    "zip_two_controls": ("select 'customer' as table_name, cast(c_custkey as varchar) as key, date '2024-01-02' as date_part from customer "
                         "union all select 'supplier', cast(s_suppkey as varchar), date '2024-01-02' from supplier"),
    "zip_bad_archive": "select *, case when c_custkey % 2 = 0 then date '2024-01-01' else date '2024-01-02' end as date_part from customer",
    "folder_listing": ("select c_nationkey as nation, cast(sum(strlen(c_name) + 1) as bigint) as bytes, count(*) as n_lines "
                       "from customer group by 1"),
    "sql_relation": ("select *, case when c_custkey % 3 = 0 then '' when c_custkey % 3 = 1 then null else c_name end as v, '' as tail, "
                     "date '2024-01-02' as date_part from customer"),
    "table_statement": (
        "select cast(ordinal_position as integer) as position, column_name as col_name, case data_type when 'VARCHAR' then 'string' "
        f"when 'INTEGER' then 'int' else lower(data_type) end as data_type, {STATEMENT} as statement "
        f"from information_schema.columns where table_name = 'customer' union all select 6, 'date_part', 'date', {STATEMENT}"),
    "stream_late_files": "select * from customer",
    "pipe_display_all": ("select concat_ws('|', c_custkey, coalesce(c_name, 'null'), coalesce(cast(c_nationkey as varchar), 'null'), "
                         "coalesce(c_mktsegment, 'null')) as line from customer"),
    "even_splits": ("select 'number' as key, cast(8 as bigint) as n_splits, count(*) as n_rows, true as even from lineitem "
                    "union all select 'text', 8, count(*), true from customer"),
    "reconciled_loads": " union all ".join(f"select '{t}' as table_name, 'ok' as status, count(*) as n_rows, null::varchar as message from {t}"
                                           for t in ("part", "orders", "events", "customer", "supplier")),
    "stream_zip_landing": STREAMED,
    "stream_table_landing": STREAMED,
}

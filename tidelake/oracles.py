"""Independent DuckDB SQL for each registered query (same column names and types)."""

from tidelake.oracles_loads import LOAD_ORACLES

M = ("(select event_type || '_' || event_id || '.txt' as file_name, event_id % 4 as length, "
     "ts as modified, event_type from events)")
W = "timestamp '2024-01-15 12:01:10'"
ROUTES = "(select * from (values (1,'s','s_tab'),(2,'sig','sig_tab'),(3,'p','p_tab')) v(line_no, pattern, tab))"

CONTROL = """(select
  nullif(case c_mktsegment when 'AUTOMOBILE' then 'snapshot' when 'BUILDING' then 'append'
       when 'FURNITURE' then 'lastmodified' when 'HOUSEHOLD' then '' else 'bogus' end, '') as table_type,
  case when c_nationkey < 5 then 'teradata' when c_nationkey < 12 then 'oracle'
       when c_nationkey < 20 then 'sqlserver' else 'mysql' end as db_name,
  case when c_acctbal < -900 then 'both' when c_acctbal < 0 then 'normal' else 'hive' end as hive_normal,
  nullif(case when c_acctbal > 9900 then '' else upper(replace(c_name, '#', '_')) end, '') as rdbms_table_name,
  'TPCH' as schema_name,
  lower(replace(c_name, '#', '_')) as hive_table_name,
  '/lake/' || cast(c_custkey as varchar) as target_dir,
  case when c_mktsegment = 'BUILDING' then 'o_orderstatus in (''F'',''O'')' end as where_clause,
  case when c_mktsegment = 'AUTOMOBILE' then 'n_nationkey' end as split_by_col,
  case when c_nationkey > 0 then c_nationkey * 100 end as fetch_size,
  case when c_nationkey > 10 then 4 end as num_mapper,
  case c_mktsegment when 'BUILDING' then 'o_orderkey' when 'FURNITURE' then 'o_orderdate' end as check_column,
  case c_mktsegment when 'BUILDING' then cast(c_custkey as varchar) when 'FURNITURE' then '1998-01-01' end
    as last_value
from customer)"""

FIELDS = {"customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
          "part": "p_partkey p_name p_brand p_type p_size p_retailprice"}


def _placed(place, *tables):
    """Records of tables as six text fields, with the folder they are expected in."""
    def one(t):
        cols = [f"cast({c} as varchar)" for c in FIELDS[t].split()] + ["null"] * 6
        return f"select {', '.join(f'{c} as f{i}' for i, c in enumerate(cols[:6]))}, '{place}' as place from {t}"
    return " union all ".join(map(one, tables))


ORACLES = {
    "raw_delimited_scan": "select * from customer",
    "raw_scan_untyped": ("select cast(c_custkey as varchar) as _c0, c_name as _c1, "
                         "cast(c_nationkey as varchar) as _c2, cast(c_acctbal as varchar) as _c3, c_mktsegment as _c4 from customer"),
    "raw_scan_ragged": ("select cast(c_custkey as varchar) as _c0, c_name as _c1, cast(c_nationkey as varchar) as _c2, "
                        "cast(c_acctbal as varchar) as _c3, c_mktsegment as _c4 from customer union all "
                        "select cast(s_suppkey as varchar), s_name, cast(s_nationkey as varchar), "
                        "cast(s_acctbal as varchar), null from supplier"),
    "null_marker_roundtrip": "select * replace (nullif(o_orderpriority, '3-MEDIUM') as o_orderpriority) from orders",
    "null_marker_literal": ("select * replace (coalesce(nullif(o_orderpriority, '3-MEDIUM'), '\\N') as o_orderpriority) "
                            "from orders"),
    "field_split_exact": ("select *, case when c_custkey % 3 = 0 then '' when c_custkey % 3 = 1 "
                          "then null else c_name end as v, '' as tail from customer"),
    "multiline_repair": "select doc_id, replace(text, chr(10), chr(92) || ' ') as text from documents",
    "raw_to_cleansed": "select *, date '2024-01-02' as date_part from orders",
    "cleansed_append_twice": ("select *, date '2024-01-02' as date_part from orders union all "
                              "select *, date '2024-01-02' as date_part from orders"),
    "snapshot_replace": "select *, date '2024-01-02' as date_part from orders",
    "catalog_table_sink": "select * from customer",
    "append_increment": "select * from orders where o_orderkey > 10000",
    "lastmodified_increment": ("select * from orders where o_orderdate >= timestamp '1998-01-01' "
                               "and o_orderdate < timestamp '1999-01-01'"),
    "source_where_pushdown": ("select o_orderkey, o_custkey from orders "
                              "where o_orderstatus = 'F' and o_totalprice > 100000"),
    "incremental_append": ("select *, case when o_orderkey <= 10000 then date '2024-01-01' "
                           "else date '2024-01-02' end as date_part from orders"),
    "incremental_no_new_rows": "select *, date '2024-01-01' as date_part from orders",
    "run_report": ("select 'customer' as table_name, 'snapshot' as mode, 'ok' as status, count(*) as n_rows "
                   "from customer union all "
                   "select 'orders', 'append', 'ok', count(*) from orders union all "
                   "select 'supplier', 'snapshot', 'ok', count(*) from supplier union all "
                   "select 'part', null, 'invalid', null"),
    "file_listing": f"select file_name, strftime(modified, '%Y%m%d%H%M%S') as stamp from {M}",
    "files_newer_than": f"select file_name from {M} where modified > {W}",
    "files_newer_than_minute": (f"select file_name from {M} "
                                f"where modified > date_trunc('minute', {W}) + interval 1 minute"),
    "files_non_empty": f"select file_name from {M} where length > 0",
    "file_prefix_filter": f"select file_name from {M} where starts_with(file_name, 'sig')",
    "latest_file": f"select file_name from {M} order by modified desc, file_name desc limit 1",
    "watermark_advance": (f"select event_type as source, max(modified) as high_water, "
                          f"arg_max(file_name, (modified, file_name)) as file_name from {M} group by 1"),
    "watermark_default": (f"select event_type as source, coalesce(max(modified) filter (where event_type = 'click'), "
                          f"timestamp '2000-01-01 00:00:00') as high_water from {M} group by 1"),
    "watermark_parse": (f"select split_part(strftime(modified, '%Y%m%d%H%M%S') || '|' || file_name, '|', 1) "
                        f"as stamp from {M}"),
    "watermark_seed_join": ("select c_custkey, coalesce(case when c_acctbal > 0 then '7' end, '0') "
                            "as last_value from customer"),
    "route_first_match": (f"select file_name, arg_min(tab, line_no) as table_name from {M} m "
                          f"join {ROUTES} c on starts_with(file_name, pattern) group by 1"),
    "route_all_matches": (f"select file_name, tab as table_name from {M} m "
                          f"join {ROUTES} c on starts_with(file_name, pattern)"),
    "gzip_landing": "select *, date '2024-01-02' as date_part from customer",
    "zip_landing": ("select 'customer' as table_name, *, date '2024-01-02' as date_part from customer union all "
                    "select 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, null, date '2024-01-02' from supplier"),
    "control_table_scan": f"select * from {CONTROL}",
    "control_validate": f"""
with c as (select * from {CONTROL}),
m as (select *, case when lower(trim(table_type)) in ('append', 'lastmodified') then 'incremental'
                     when coalesce(trim(table_type), '') = '' or lower(trim(table_type)) in ('snapshot', 'full')
                     then 'snapshot' end as mode0 from c),
e as (select target_dir, mode0, nullif(concat_ws(',',
        case when mode0 is null then 'table_type' end,
        case when not coalesce(lower(trim(db_name)) in ('teradata', 'oracle', 'sqlserver'), false) then 'db_name' end,
        case when not coalesce(lower(trim(hive_normal)) in ('hive', 'normal'), false) then 'hive_normal' end,
        case when coalesce(trim(rdbms_table_name), '') = '' then 'rdbms_table_name' end,
        case when mode0 = 'incremental' and coalesce(trim(check_column), '') = '' then 'check_column' end
      ), '') as error from m)
select target_dir, case when error is null then mode0 end as mode, error from e""",
    "stream_landing": "select * from customer",
    "stream_landing_archive": f"{_placed('landed', 'customer', 'supplier', 'part')} union all {_placed('archived', 'customer', 'supplier')}",
    "table_query": "select c_custkey from customer where c_mktsegment = 'FURNITURE'",
    "pipe_display": ("select concat_ws('|', c_custkey, c_name, coalesce(nullif(c_mktsegment, 'FURNITURE'), 'null')) "
                     "as line from customer"),
    "whole_file_repair": "select doc_id, replace(text, chr(10), chr(92) || ' ') as text from documents",
    "repair_to_raw": "select doc_id, replace(text, chr(10), chr(92) || ' ') as text from documents",
    "route_first_match_equijoin": (f"select file_name, arg_min(tab, line_no) as table_name from {M} m "
                                   f"join {ROUTES} c on starts_with(file_name, pattern) group by 1"),
    "route_all_matches_equijoin": (f"select file_name, tab as table_name from {M} m "
                                   f"join {ROUTES} c on starts_with(file_name, pattern)"),
    "bucket_listing_line": f"select strftime(modified, '%Y%m%d%H%M%S') || '|' || file_name as line from {M}",
    "bucket_pickup": "select * from customer",
    "incremental_lastmodified": ("select *, case when o_orderdate < timestamp '1997-01-01' or o_orderdate is null "
                                 "then date '2024-01-01' else date '2024-01-02' end as date_part from orders"),
    "lastmodified_clock": ("select *, date '2024-01-02' as date_part from orders "
                           "where o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1999-01-01'"),
    "ingest_where": ("select *, date '2024-01-02' as date_part from orders "
                     "where o_orderstatus = 'F' and o_totalprice > 100000"),
    "gzip_landing_two_patterns": ("select *, case when c_custkey % 4 < 2 then date '2024-01-01' else date '2024-01-02' end "
                                  "as date_part from customer"),
    "landing_report": ("select 'customer' as table_name, 'ok' as status, cast(1 as bigint) as n_files, count(*) as n_rows "
                       "from customer union all select 'supplier', 'ok', 2, count(*) from supplier union all "
                       "select 'part', 'ok', 3, count(*) from part union all select 'nation', 'no_new_data', 0, 0"),
    "table_preview": "select *, date '2024-01-02' as date_part from customer order by c_custkey limit 10",
    "table_ddl": ("select column_name as col_name, case data_type when 'VARCHAR' then 'string' when 'INTEGER' then 'int' else lower(data_type) end "
                  "as data_type from information_schema.columns where table_name = 'customer' "
                  "union all select 'date_part', 'date'"),
    "cleansed_replace_partition": "select *, date '2024-01-02' as date_part from orders",
    "raw_scan_csv_mode": "select * from customer",
    "run_summary": ("select 'customer' as table_name, 'ok' as status, cast(2 as bigint) as n_runs, "
                    "cast(null as bigint) as n_files, 2 * count(*) as n_rows from customer union all "
                    "select 'orders', 'ok', 1, null, count(*) from orders union all "
                    "select 'orders', 'no_new_data', 1, null, 0"),
    "bucket_pickup_archive": f"{_placed('staged', 'supplier')} union all {_placed('archived', 'customer')}",
    "stream_cleansed": "select *, date '2024-01-02' as date_part from orders",
    "watermark_compacted": (f"select event_type as source, max(modified) as high_water, "
                            f"arg_max(file_name, (modified, file_name)) as file_name from {M} group by 1"),
    "gzip_landing_minute": ("select *, date '2024-01-02' as date_part from customer "
                            "where c_mktsegment is distinct from 'FURNITURE'"),
}

ORACLES.update(LOAD_ORACLES)

"""Command-line jobs (run with ``spark-submit -m``-style launchers or ``python -m tidelake``).

    python -m tidelake raw-to-cleansed RAW_PATH CLEANSED_PATH [--schema DDL] [--run-date D] [--partition D]
    python -m tidelake repair TMP_PATH RAW_PATH [--mode overwrite]
    python -m tidelake ingest --control APP.ctrl --state STATE --app APP --connections conn.json
    python -m tidelake land --control APP.ctrl --state STATE --app APP [--mode consolidated] [--stream CKPT]
    python -m tidelake pickup SOURCE_DIR STAGE_DIR --state STATE [--archive DIR] [--source NAME]
    python -m tidelake stream-land SOURCE_DIR TARGET_DIR --checkpoint CKPT [--archive DIR]
    python -m tidelake query TABLE [--columns a,b] [--where col=value ...] [--limit N]

Pipelines print their run report; the exit status is 1 when any table failed or was
invalid, 0 otherwise.  ``query`` prints one ``|``-joined line per row, streaming rows from
the executors instead of collecting them all on the driver.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidelake")
    sub = p.add_subparsers(dest="command", required=True)

    c = sub.add_parser("raw-to-cleansed", help="raw BEL text -> dated Avro")
    c.add_argument("raw_path")
    c.add_argument("cleansed_path")
    c.add_argument("--schema", help="DDL of the raw columns (default: all strings)")
    c.add_argument("--run-date", help="load date YYYY-MM-DD (default: today)")
    c.add_argument("--mode", default="append", choices=["append", "replace_partition"])
    c.add_argument("--partition", action="append", default=[],
                   help="raw date_part to read (repeatable; default: the whole raw path)")

    r = sub.add_parser("repair", help="join escaped line breaks into one record per line")
    r.add_argument("tmp_path")
    r.add_argument("raw_path")
    r.add_argument("--mode", default="append", choices=["append", "overwrite", "errorifexists"],
                   help="overwrite makes a rerun into the same raw partition idempotent")

    i = sub.add_parser("ingest", help="control-table driven relational import")
    i.add_argument("--control", required=True)
    i.add_argument("--state", required=True)
    i.add_argument("--app", required=True)
    i.add_argument("--connections", required=True,
                   help="JSON file: {vendor: {server, port, sid, user, password}}")
    i.add_argument("--run-date")
    i.add_argument("--run-start", help="the source's current time: lastmodified loads up to it, not including it")
    i.add_argument("--check", action="store_true", help="read every load back before its commit")
    i.add_argument("--parallel", type=int, default=4)

    la = sub.add_parser("land", help="control-table driven file landing")
    la.add_argument("--control", required=True)
    la.add_argument("--state", required=True)
    la.add_argument("--app", required=True)
    la.add_argument("--mode", choices=["consolidated"])
    la.add_argument("--precision", default="second", choices=["second", "minute"])
    la.add_argument("--run-date")
    la.add_argument("--check", action="store_true", help="read every load back before its commit")
    la.add_argument("--stream", metavar="CHECKPOINT", help="land as a stream, remembering files by name here")
    la.add_argument("--parallel", type=int, default=4)

    pk = sub.add_parser("pickup", help="copy objects newer than the stored stamp to a stage folder")
    pk.add_argument("source_dir")
    pk.add_argument("stage_dir")
    pk.add_argument("--state", required=True)
    pk.add_argument("--source", default="bucket")
    pk.add_argument("--archive")
    pk.add_argument("--run-date")

    sl = sub.add_parser("stream-land", help="land files not seen before (file-source stream, run to completion)")
    sl.add_argument("source_dir")
    sl.add_argument("target_dir")
    sl.add_argument("--checkpoint", required=True, help="same folder on every run")
    sl.add_argument("--archive", help="move files of committed batches here")
    sl.add_argument("--run-date")

    q = sub.add_parser("query", help="projection + equality filters over a catalog table")
    q.add_argument("table")
    q.add_argument("--columns", help="comma-separated (default: all)")
    q.add_argument("--where", action="append", default=[], help="col=value (repeatable)")
    q.add_argument("--limit", type=int)
    return p


def _report(report, out) -> int:
    rows = report.collect()  # one row per control row
    for r in rows:
        print("|".join("" if v is None else str(v) for v in r), file=out)
    return 1 if any(r["status"] in ("failed", "invalid") for r in rows) else 0


def main(argv=None, spark: SparkSession | None = None, out=sys.stdout) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tidelake-{args.command}").getOrCreate()

    if args.command == "raw-to-cleansed":
        from tidelake.plans.cleansed import raw_to_cleansed
        raw_to_cleansed(spark, args.raw_path, args.cleansed_path, run_date=args.run_date,
                        schema=args.schema, mode=args.mode, raw_partitions=args.partition or None)
        return 0
    if args.command == "repair":
        from tidelake.plans.cleansed import repair_raw
        repair_raw(spark, args.tmp_path, args.raw_path, mode=args.mode)
        return 0
    if args.command == "ingest":
        from tidelake.plans.ingest import ingest_tables, jdbc_source
        from tidelake.sources.control import read_control
        with open(args.connections) as f:
            connections = json.load(f)
        report = ingest_tables(spark, read_control(spark, args.control, "tables"), args.state,
                               source=jdbc_source(spark, connections), app=args.app,
                               run_date=args.run_date, run_start=args.run_start, max_parallel=args.parallel,
                               check=args.check)
        return _report(report, out)
    if args.command == "land":
        from tidelake.plans.landing import land_files
        from tidelake.sources.control import read_control
        from tidelake.streaming.landing import stream_land_tables
        control = read_control(spark, args.control, "files")
        if args.stream:
            report = stream_land_tables(spark, control, args.state, args.stream, app=args.app, mode=args.mode,
                                        run_date=args.run_date, max_parallel=args.parallel)
        else:
            report = land_files(spark, control, args.state, app=args.app, mode=args.mode, run_date=args.run_date,
                                precision=args.precision, max_parallel=args.parallel, check=args.check)
        return _report(report, out)
    if args.command == "pickup":
        from tidelake.plans.landing import pickup_files
        report = pickup_files(spark, args.source_dir, args.stage_dir, args.state, source=args.source,
                              run_date=args.run_date, archive_dir=args.archive)
        return _report(report, out)
    if args.command == "stream-land":
        from tidelake.streaming.landing import stream_land
        res = stream_land(spark, args.source_dir, args.target_dir, checkpoint=args.checkpoint,
                          archive_dir=args.archive, run_date=args.run_date)
        print(f"{args.source_dir}|{res['batches']}|{res['rows']}", file=out)
        return 0
    if args.command == "query":
        from tidelake.plans.query import display_lines, query_table
        where = dict(w.split("=", 1) for w in args.where)
        cols = args.columns.split(",") if args.columns else None
        df = query_table(spark, args.table, cols, where or None, args.limit)
        for row in display_lines(df).toLocalIterator():
            print(row["line"], file=out)
        return 0
    raise AssertionError(args.command)


if __name__ == "__main__":
    sys.exit(main())

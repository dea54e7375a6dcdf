"""File landing: new flat files (gzip per table, or one zip with many tables) into the lake.

A run fixes what it lands once: the tasks list the folder, and the files that are newer than the stored
watermark, or have exactly its stamp and were not landed with it, are stored as a manifest.  The tasks
then read the files that the manifest names; neither the driver nor a file index holds their names, and
a file rewritten meanwhile waits for the next run.  Every load is a folder of its own, committed by the
watermark (see :mod:`tidelake.sinks.loads`).
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tidelake.operators.boundary import KEY, known_keys, write_edges
from tidelake.operators.filters import files_newer_than, files_newer_than_minute, files_non_empty
from tidelake.operators.report import FAILED, INVALID, NO_NEW_DATA, OK, Outcome, report_frame, timed
from tidelake.operators.routing import route_first_match
from tidelake.operators.state import read_state, watermarks_with_default
from tidelake.operators.validate import validate_file_control
from tidelake.session import local_frame, move_path, scratch_path, today
from tidelake.sinks.loads import TASKS_COMMIT, commit_load, content_check, discard_unfinished, drop_load, open_load, reconcile
from tidelake.sinks.raw import write_lines
from tidelake.sources.archives import damaged_members, zip_directory, zip_member_lines
from tidelake.sources.control import first_row
from tidelake.sources.listing import list_folders, manifest_lines


EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _watermarks(spark, state, sources) -> dict:
    """Current watermark of each source (default when none is stored), in one job."""
    src = local_frame(spark, [(s,) for s in sorted(set(sources))], "source string")
    return {r["source"]: r["high_water"]
            for r in watermarks_with_default(src, state, dtype="timestamp").collect()}


def _watermark(spark, state, source: str):
    return _watermarks(spark, state, [source])[source]


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _kept_files(files: DataFrame, *counts: Column):
    """``files`` written once and read again, and, seen on the way, their number ``n``, the newest stamp
    (``us``, microseconds, so no local time is in the way) with the name of its file, and ``counts``."""
    obs = Observation(f"files_{uuid.uuid4().hex[:6]}")
    newest = F.max(F.struct(F.unix_micros("modified").alias("us"), "file_name")).alias("hi")
    kept = _kept(files.observe(obs, F.count(F.lit(1)).alias("n"), newest, *counts), "new-files")
    return kept, obs.get


def _new_files(manifest: DataFrame, wm, precision: str, known: DataFrame | None) -> DataFrame:
    """Files newer than the watermark and, to the second, those with its stamp that did not land with it."""
    if precision == "minute":
        return files_non_empty(files_newer_than_minute(manifest, wm))
    newer = files_newer_than(manifest, wm)
    if known is None:
        return files_non_empty(newer)
    same = manifest.where(F.col("modified") == F.lit(wm)).join(known, F.col("path") == F.col(KEY), "left_anti")
    return files_non_empty(newer.unionByName(same))


def _us(stamp) -> str | None:
    """A stamp as the text of its microseconds, by which boundary keys are kept."""
    if stamp is None:
        return None
    return str((stamp.astimezone(dt.timezone.utc) - EPOCH) // dt.timedelta(microseconds=1))


def _mark(source: str, hi) -> tuple:
    """State row of a new watermark."""
    return source, EPOCH + dt.timedelta(microseconds=hi["us"]), hi["file_name"], None, None


def _keep_edge(files: DataFrame, state_path: str, load, hi) -> None:
    """Remember the files that land with exactly the newest stamp."""
    edge = files.where(F.unix_micros("modified") == F.lit(hi["us"])).select(F.col("path").alias("key"))
    write_edges(edge, state_path, load.source, load.load_id, str(hi["us"]))


def _first_match(patterns: list[str], numbers: list[int]) -> Column:
    """Number of the first pattern that the file name begins with, or NULL."""
    out = F.lit(None).cast("int")
    for p, i in reversed(list(zip(patterns, numbers))):
        out = F.when(F.col("file_name").startswith(p), F.lit(i)).otherwise(out)
    return out


def land_files(spark: SparkSession, control: DataFrame, state_path: str, app: str = "app",
               mode: str | None = None, run_date=None, precision: str = "second",
               max_parallel: int = 4, check: bool = False) -> DataFrame:
    """Land new files named by a file control table; returns the run report.

    ``mode=None``: files ``pattern*`` in a row's ``source_dir`` newer than the table's watermark
    and not empty are read (gzip is decompressed) and appended to ``<target>/<table>``.  Rows that name
    the same table and target are one load with one watermark: each file lands once, counted for the
    first row whose pattern it begins with.  A file matching rows of two tables lands in both; a
    table landing in two targets has a watermark for each.

    ``mode="consolidated"``: all files below the first control row's ``source_dir`` (even if that
    row is otherwise invalid) newer than the app's watermark are zip archives; their members are
    routed to the first valid control row whose pattern prefixes the member name and appended to
    that row's ``<target>/<table>``, all tables committed by one watermark; unmatched members are
    dropped.  An archive that cannot be read, or holds an encrypted or damaged member, is reported as
    ``failed`` in every run until it is replaced, and lands then; the others go on.

    A file that appears later with exactly the watermark's stamp lands too.  ``precision="minute"``
    reproduces the minute-granular cut-off of the source system, which passes such files by.
    With ``check`` every table's lines are read back before the commit and must be those that were
    written, by number and content.  Targets are made of load folders: read them with :func:`tidelake.sinks.loads.read_loads`.
    """
    if mode not in (None, "", "consolidated"):
        raise ValueError(f"mode must be None or 'consolidated', got {mode!r}")
    run_date = run_date or today(spark)  # one load date for every table of the run
    state = read_state(spark, state_path)
    ctrl = validate_file_control(control)
    rows = [r.asDict() for r in ctrl.orderBy("control_file", "line_no").collect()]
    if mode == "consolidated":
        return _land_consolidated(spark, ctrl, rows, state, state_path, app, run_date, precision, max_parallel, check)
    state_lock = threading.Lock()
    groups: dict[tuple[str, str], list[int]] = {}
    for i, r in enumerate(rows):
        if r["error"] is None:
            groups.setdefault((r["table_name"], r["target_dir"].rstrip("/")), []).append(i)
    source_of = {(t, d): f"{app}/{t}@{d}" for t, d in groups}
    discard_unfinished(spark, state_path, source_of.values(), state)
    marks = _watermarks(spark, state, source_of.values()) if groups else {}
    # one listing per source folder, shared by every control row reading from it
    listings, missing = {}, {}
    for d in sorted({r["source_dir"] for r in rows if r["error"] is None}):
        readers = sum(d in {rows[i]["source_dir"] for i in mine} for mine in groups.values())
        try:
            listings[d] = list_folders(spark, d, stored=readers > 1 or state is not None)
        except FileNotFoundError as e:
            missing[d] = f"no folder {e}"

    def run(key: tuple[str, str]) -> list[Outcome]:
        spark.sparkContext.setJobDescription(f"tidelake land {app}/{key[0]}")
        mine = [rows[i] for i in groups[key]]
        try:
            for r in mine:
                if r["source_dir"] in missing:
                    raise FileNotFoundError(missing[r["source_dir"]])
            return _land_table(spark, mine, listings, marks[source_of[key]], state_path, state_lock, app,
                               source_of[key], run_date, precision, state, check)
        except Exception as e:
            return [Outcome(app, key[0], "files", FAILED, message=str(e)) for _ in mine]

    # tables are independent jobs; a few run at once to keep a large cluster busy
    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(groups) or 1))) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(timed(run)), groups))
    outcomes = {i: Outcome(app, r["table_name"], "files", INVALID, message=r["error"], seconds=0.0)
                for i, r in enumerate(rows) if r["error"] is not None}
    for key, found in zip(groups, done):
        outcomes.update(zip(groups[key], found))
    return report_frame(spark, [outcomes[i] for i in range(len(rows))])


def _land_table(spark, rows, listings, wm, state_path, state_lock, app, source, run_date, precision,
                state=None, check=False) -> list[Outcome]:
    table = rows[0]["table_name"]
    by_dir: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        by_dir.setdefault(r["source_dir"], []).append(i)
    known = known_keys(spark, state_path, source, _us(wm), state)
    parts = []
    for folder, mine in by_dir.items():
        named = _first_match([rows[i]["pattern"] for i in mine], mine)
        parts.append(_new_files(listings[folder], wm, precision, known).withColumn("_row", named).where(F.col("_row").isNotNull()))
    per_row = [F.count_if(F.col("_row") == i).alias(f"n{i}") for i in range(len(rows))]
    files, found = _kept_files(reduce(DataFrame.unionByName, parts), *per_row)
    if not found["n"]:
        return [Outcome(app, table, "files", NO_NEW_DATA, n_files=0, n_rows=0) for _ in rows]
    target = f"{rows[0]['target_dir'].rstrip('/')}/{table}"
    load = open_load(spark, state_path, source, target, run_date, lock=state_lock)
    _keep_edge(files, state_path, load, found["hi"])
    obs = Observation(f"land_{table}_{uuid.uuid4().hex[:6]}")
    lines = manifest_lines(files, "_row")
    per_row = [F.sum(F.when(F.col("tag") == i, 1).otherwise(0)).alias(f"r{i}") for i in range(len(rows))]
    lines = lines.observe(obs, *per_row, *(content_check(["value"]) if check else []))
    write_lines(lines.select("value"), load.folder(), **TASKS_COMMIT)
    if check:
        _check_lines(spark, load.folder(), obs.get)
    commit_load(spark, state_path, load, [_mark(source, found["hi"])], state_lock)
    counts = obs.get
    return [Outcome(app, table, "files", OK if found[f"n{i}"] else NO_NEW_DATA, n_files=found[f"n{i}"],
                    n_rows=counts.get(f"r{i}") or 0) for i in range(len(rows))]


def _check_lines(spark, folder: str, seen: dict) -> None:
    reconcile(spark.read.option("lineSep", "\n").text(folder).select("value"), seen)


FAILED_ARCHIVE = "!failed!"  # state rows of archives that could not be read: app, this, path


def _known_bad(state: DataFrame | None, app: str) -> DataFrame | None:
    """``(_bad, _was)``: path and ``microseconds:length`` of archives that are still waiting to be replaced."""
    if state is None:
        return None
    prefix = f"{app}{FAILED_ARCHIVE}"
    rows = state.where(F.col("source").startswith(prefix)).groupBy("source").agg(F.max(F.struct("run_ts", "value")).alias("v"))
    return rows.where("v.value <> ''").select(F.substring("source", len(prefix) + 1, 1 << 20).alias("_bad"), F.col("v.value").alias("_was"))


def _places(spark, valid: list[dict]):
    """Tables by target folder, the folders, and the routing rows.  A target is one place, whichever and
    however many rows name it; rows are numbered once, in order."""
    places: dict[str, str] = {}
    for r in valid:
        places.setdefault(f"{r['target_dir'].rstrip('/')}/{r['table_name']}", r["table_name"])
    names = list(places)
    routing = local_frame(spark, [(i, r["pattern"], names.index(f"{r['target_dir'].rstrip('/')}/{r['table_name']}"))
                                  for i, r in enumerate(valid)], "line_no int, pattern string, place int")
    return places, names, routing


def _land_consolidated(spark, ctrl, rows, state, state_path, app, run_date, precision, max_parallel, check):
    valid = [r for r in rows if r["error"] is None]
    invalid = [Outcome(app, r["table_name"], "zip", INVALID, message=r["error"]) for r in rows if r["error"] is not None]
    if not valid:
        return report_frame(spark, invalid)
    places, names, routing = _places(spark, valid)
    discard_unfinished(spark, state_path, [app], state)
    folder = (first_row(ctrl).orderBy("control_file").first()["source_dir"] or "").strip() or valid[0]["source_dir"]
    try:
        listing = list_folders(spark, folder, recursive=True)
        archives, listed, waiting = _new_archives(spark, listing, state, state_path, app, precision)
        still = [Outcome(app, r["path"], "zip", FAILED, n_files=1, message="not replaced yet") for r in waiting]
        if not listed["n"]:
            return report_frame(spark, invalid + still + [Outcome(app, t, "zip", NO_NEW_DATA, 0, 0) for t in places.values()])
        directory = _kept(zip_directory(archives), "zip-members")
        bad = _by_archive(directory.where(F.col("error").isNotNull()))
        counts, broken = _land_members(spark, directory, bad, archives, routing, names, state_path, app, run_date,
                                       listed["hi"], max_parallel, _known_bad(state, app), check)
        if counts is None:  # members that break off: leave their archives out and write the others again
            counts, broken = _land_members(spark, directory, broken, archives, routing, names, state_path, app, run_date,
                                           listed["hi"], max_parallel, _known_bad(state, app), check)
        if counts is None:
            raise OSError("archives change while they are read")
    except Exception as e:
        return report_frame(spark, invalid + [Outcome(app, t, "zip", FAILED, message=str(e)) for t in places.values()])
    failed = [Outcome(app, path, "zip", FAILED, n_files=1, message=error) for path, error in broken.items()]
    return report_frame(spark, invalid + still + failed + [
        Outcome(app, t, "zip", OK, n_files=counts[i][1], n_rows=counts[i][0]) for i, t in enumerate(places.values())])


def _new_archives(spark, listing, state, state_path, app, precision):
    """New archives and replaced bad ones, stored; and the bad ones that are as they were."""
    wm = _watermark(spark, state, app)
    new = _new_files(listing, wm, precision, known_keys(spark, state_path, app, _us(wm), state))
    bad = _known_bad(state, app)
    if bad is None:
        return *_kept_files(new), []
    now = F.concat_ws(":", F.unix_micros("modified").cast("string"), F.col("length").cast("string"))
    seen = _kept(listing.join(bad, F.col("path") == F.col("_bad")).select("path", "file_name", "length", "modified", (now != F.col("_was")).alias("changed")),
                 "bad-archives")
    again = files_non_empty(seen.where("changed").drop("changed"))
    fresh = new.join(seen.select(F.col("path").alias("_seen")), F.col("path") == F.col("_seen"), "left_anti")
    return *_kept_files(fresh.unionByName(again)), seen.where("not changed").select("path").collect()


def _by_archive(errors: DataFrame) -> dict[str, str]:
    """An error for each unreadable archive; each becomes a report row."""
    return {r["archive"]: r["error"] for r in errors.groupBy("archive").agg(F.first("error").alias("error")).collect()}


def _land_members(spark, directory, bad, archives, routing, places, state_path, app, run_date, hi, max_parallel, known_bad, check, mark=None):
    """Write the members of all readable archives, a table at a time, and commit them together: (lines,
    files) per place, and the unreadable archives.  Where a member turns out damaged nothing is committed:
    None, and all archives with a damaged member.  ``mark`` is the state row that commits them, for callers
    without a watermark."""
    members = directory.where(F.col("error").isNull()).withColumn("file_name", F.substring_index("member", "/", -1))
    left_out = local_frame(spark, [(path,) for path in bad], "archive string")
    members = members.join(left_out, "archive", "left_anti") if bad else members
    keys = ("archive", "member", "file_name", "position", "member_size")
    routed = _kept(route_first_match(members.select(*keys), routing, key_cols=keys).select("archive", "member", "position", "place"), "zip-routed")
    used = sorted(r["place"] for r in routed.select("place").distinct().collect())
    load = open_load(spark, state_path, app, [places[i] for i in used], run_date)
    if mark is None:
        _keep_edge(archives, state_path, load, hi)

    def write(i: int):
        obs = Observation(f"zip_rows_{uuid.uuid4().hex[:6]}")
        lines = zip_member_lines(routed.where(F.col("place") == i).select("archive", "member", "position"))
        good = F.col("error").isNull()
        lines = lines.observe(obs, F.sum(F.when(good & (F.col("line_no") == 0), 1).otherwise(0)).alias("f"),
                              F.sum(F.when(good, 0).otherwise(1)).alias("e"))
        kept = Observation(f"zip_lines_{uuid.uuid4().hex[:6]}")
        lines = lines.where(good).select("value").observe(kept, *(content_check(["value"]) if check else content_check(["value"])[:1]))
        write_lines(lines, load.folder(places[i]), **TASKS_COMMIT)
        if check:
            _check_lines(spark, load.folder(places[i]), kept.get)
        return obs.get | kept.get

    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(used) or 1))) as pool:
        found = dict(zip(used, pool.map(inheritable_thread_target(spark)(write), used)))
    if any(c["e"] for c in found.values()):
        drop_load(spark, state_path, load)
        return None, bad | _by_archive(damaged_members(routed.select("archive", "member", "position")))
    marks = [_mark(app, hi) if mark is None else mark]
    stamp = F.concat_ws(":", F.unix_micros("modified").cast("string"), F.col("length").cast("string")).alias("stamp")
    if bad:  # they wait until they are replaced
        waiting = archives.join(left_out, F.col("path") == F.col("archive"), "left_semi").select("path", "file_name", stamp)
        marks += [(f"{app}{FAILED_ARCHIVE}{r['path']}", None, r["file_name"], r["stamp"], None) for r in waiting.collect()]
    if known_bad is not None:  # replaced ones that landed are done
        done = archives.join(known_bad, F.col("path") == F.col("_bad"), "left_semi").select("path", "file_name")
        marks += [(f"{app}{FAILED_ARCHIVE}{r['path']}", None, r["file_name"], "", None) for r in done.collect() if r["path"] not in bad]
    commit_load(spark, state_path, load, marks)
    return [(found[i]["n"] or 0, found[i]["f"] or 0) if i in found else (0, 0) for i in range(len(places))], bad


def pickup_files(spark: SparkSession, source_dir: str, stage_dir: str, state_path: str,
                 source: str = "bucket", run_date=None, archive_dir: str | None = None) -> DataFrame:
    """Bucket pickup: objects newer (to the second, strictly) than the stored stamp, or with that stamp
    and not seen then, are copied as lines into ``stage_dir``; the stamp advances to the newest one.

    With ``archive_dir``, the batch staged by the previous run is moved (one folder rename)
    to ``archive_dir/batch-<time>`` before the new batch is written, so ``stage_dir`` holds
    only the latest batch for the dependent load.  What a run that died left uncommitted in
    ``stage_dir`` is removed first, so it is not archived.  Nothing is moved when nothing is new.
    """
    run_date = run_date or today(spark)
    state = read_state(spark, state_path)
    wm = _watermark(spark, state, source)
    known = known_keys(spark, state_path, source, _us(wm), state)
    listing = list_folders(spark, source_dir, stored=known is not None)
    newer = files_newer_than(listing, wm)
    if known is not None:
        same = listing.where(F.col("modified") == F.lit(wm))
        newer = newer.unionByName(same.join(known, F.col("path") == F.col(KEY), "left_anti"))
    files, found = _kept_files(files_non_empty(newer))
    if not found["n"]:
        return report_frame(spark, [Outcome(source, None, "pickup", NO_NEW_DATA, 0, 0)])
    discard_unfinished(spark, state_path, [source], state)
    if archive_dir:
        stamp = dt.datetime.now().strftime("%Y%m%d%H%M%S%f")
        move_path(spark, stage_dir, f"{archive_dir.rstrip('/')}/batch-{stamp}")
    load = open_load(spark, state_path, source, stage_dir, run_date)
    _keep_edge(files, state_path, load, found["hi"])
    obs = Observation(f"pickup_{uuid.uuid4().hex[:6]}")
    lines = manifest_lines(files).select("value").observe(obs, F.count(F.lit(1)).alias("n"))
    write_lines(lines, load.folder(), **TASKS_COMMIT)
    commit_load(spark, state_path, load, [_mark(source, found["hi"])])
    return report_frame(spark, [Outcome(source, None, "pickup", OK, found["n"], obs.get["n"])])

"""Landing as a file-source stream.

The file source remembers every file it has processed in the checkpoint, so a run picks up
exactly the files not seen before (late files included, unlike a timestamp watermark: see
``max_file_age``) and
the file sink commits each micro-batch once; a rerun after a failure resumes from the
checkpoint.  ``availableNow`` (default) processes what is there and stops, which is how a
scheduled pickup runs; ``processing_time="1 minute"`` keeps the query running and returns
its handle (``run_date`` left empty then stamps each micro-batch with its own day).  With
``archive_dir`` the source moves the files of a committed batch there (the batch before the
current one), like the source system's archive step.

``max_file_age`` is handed to Spark's ``maxFileAge``: files older than the newest one seen by
more than this are never landed.  Spark's own default of seven days would drop late files for
good, so the default here is a hundred years, which loses nothing; a shorter age bounds the
number of file names that the checkpoint remembers, at the price of files later than that.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.text import basename
from tidelake.functions.time import run_date_col
from tidelake.operators.report import FAILED, INVALID, OK, Outcome, report_frame
from tidelake.operators.state import read_state
from tidelake.operators.validate import validate_file_control
from tidelake.plans.landing import _by_archive, _first_match, _kept, _land_members, _places
from tidelake.session import today
from tidelake.sinks.loads import TASKS_COMMIT, commit_load, discard_unfinished, open_load
from tidelake.sinks.raw import write_lines
from tidelake.sources.archives import zip_directory
from tidelake.sources.listing import manifest_lines

KEEP_ALL = "36500d"
BINARY = "path string, modificationTime timestamp, length bigint, content binary"  # fixed: the source's columns


def _run(writer, target: str, processing_time: str | None, timeout_s: float | None = None):
    if processing_time:
        return writer.trigger(processingTime=processing_time).start(target)
    q = writer.trigger(availableNow=True).start(target)
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
        q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    progress = q.recentProgress
    return {"batches": len([p for p in progress if p["numInputRows"] > 0]),
            "rows": int(sum(p["numInputRows"] for p in progress))}


def stream_land(spark: SparkSession, source_dir: str, target_dir: str,
                checkpoint: str, archive_dir: str | None = None,
                run_date=None, max_files_per_trigger: int | None = None,
                timeout_s: float | None = None, processing_time: str | None = None,
                max_file_age: str = KEEP_ALL):
    """Land new lines of ``source_dir`` into ``target_dir/date_part=D`` (text); returns
    ``{"batches": n, "rows": n}`` for this run, or the running query with
    ``processing_time``.  Pass the same ``checkpoint`` on every run: it is what remembers the
    files already landed."""
    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    lines = reader.load(source_dir).withColumn("date_part", run_date_col(run_date))
    writer = (lines.writeStream.format("text").partitionBy("date_part")
              .option("checkpointLocation", checkpoint))
    return _run(writer, target_dir, processing_time, timeout_s)


def stream_raw_to_cleansed(spark: SparkSession, raw_dir: str, cleansed_dir: str, schema,
                           checkpoint: str, run_date=None, sep: str = "\u0007",
                           null_marker: str | None = "\\N", fmt: str = "com.databricks.spark.avro",
                           max_files_per_trigger: int | None = None, processing_time: str | None = None,
                           max_file_age: str = KEEP_ALL):
    """Raw -> cleansed as a stream: new raw files are parsed with the batch reader's rules,
    stamped with ``date_part`` and appended to a date-partitioned Avro table by the file sink
    (exactly once per file via the checkpoint and the sink log).  Readers of ``cleansed_dir``
    see only committed batches; keep batch writers out of a stream-written folder.  As with
    :func:`stream_land`, pass the same ``checkpoint`` on every run."""
    from tidelake.sources.raw import parse_raw_lines

    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    parsed = parse_raw_lines(reader.load(raw_dir).select("value"), schema, sep=sep, null_marker=null_marker)
    out = parsed.withColumn("date_part", run_date_col(run_date))
    writer = out.writeStream.format(fmt).partitionBy("date_part").option("checkpointLocation", checkpoint)
    return _run(writer, cleansed_dir, processing_time)


def _done(spark, state_path: str, source: str, stream: str, batch_id: int) -> bool:
    """Whether a source has committed this batch (or a later one) of the stream."""
    state = read_state(spark, state_path)
    if state is None:
        return False
    last = state.where((F.col("source") == source) & F.col("value").startswith(f"{stream}:"))
    got = last.agg(F.max(F.substring_index("value", ":", -1).cast("long"))).first()[0]
    return got is not None and got >= batch_id


def stream_land_tables(spark: SparkSession, control: DataFrame, state_path: str, checkpoint: str, app: str = "app",
                       mode: str | None = None, run_date=None, max_files_per_trigger: int | None = None,
                       max_file_age: str = KEEP_ALL, max_parallel: int = 4) -> DataFrame:
    """The landing of a file control table as a stream, several tables at once; returns the run report.

    One file-source stream for each ``source_dir`` (``mode="consolidated"``: one, over the first row's, for zip
    archives) hands each micro-batch's files, by name and length only, to the batch reader; every table
    (consolidated: all of them together) is a load, committed by a state row that carries the batch's number.
    A batch that is replayed after a failure writes only the tables that had not committed it, so every
    file lands once.  Late files land too, since the checkpoint knows files by name; so a file that is
    rewritten under its name does not land again.  Read targets with ``read_loads``.
    """
    run_date = run_date or today(spark)
    ctrl = validate_file_control(control)
    rows = [r.asDict() for r in ctrl.orderBy("control_file", "line_no").collect()]
    valid = [r for r in rows if r["error"] is None]
    outcomes = [Outcome(app, r["table_name"], "stream", INVALID, message=r["error"]) for r in rows if r["error"] is not None]
    if mode not in (None, "", "consolidated"):
        raise ValueError(f"mode must be None or 'consolidated', got {mode!r}")
    for folder in [valid[0]["source_dir"]] if mode and valid else sorted({r["source_dir"] for r in valid}):
        stream = hashlib.md5(f"{checkpoint}\n{folder}".encode()).hexdigest()[:12]
        mine = valid if mode else [r for r in valid if r["source_dir"] == folder]

        def land(batch: DataFrame, batch_id: int, stream=stream, mine=mine):
            listed = batch.select("path", basename("path").alias("file_name"), "length", F.col("modificationTime").alias("modified"))
            files = _kept(listed.where("length > 0"), "stream-files")
            one = _stream_archives if mode else _stream_files
            outcomes.extend(one(spark, files, mine, state_path, app, run_date, stream, batch_id, max_parallel))

        reader = spark.readStream.format("binaryFile").schema(BINARY).option("maxFileAge", max_file_age)
        if mode:
            reader = reader.option("recursiveFileLookup", "true")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        writer = (reader.load(folder).drop("content").writeStream.foreachBatch(land)
                  .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{stream}"))
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
    return report_frame(spark, outcomes)


def _stream_files(spark, files, rows, state_path, app, run_date, stream, batch_id, max_parallel) -> list[Outcome]:
    groups: dict[tuple[str, str], list[dict]] = {}
    for r in rows:
        groups.setdefault((r["table_name"], r["target_dir"].rstrip("/")), []).append(r)
    out = []
    for (table, target), mine in groups.items():
        source = f"{app}/{table}@{target}!stream"
        if _done(spark, state_path, source, stream, batch_id):
            continue
        discard_unfinished(spark, state_path, [source], read_state(spark, state_path))
        named = _first_match([r["pattern"] for r in mine], list(range(len(mine))))
        picked = files.withColumn("_row", named).where(F.col("_row").isNotNull())
        n = picked.count()
        if not n:
            continue
        load = open_load(spark, state_path, source, f"{target}/{table}", run_date)
        obs = Observation(f"stream_{uuid.uuid4().hex[:6]}")
        lines = manifest_lines(picked, "_row", as_listed=False).select("value").observe(obs, F.count(F.lit(1)).alias("n"))
        write_lines(lines, load.folder(), **TASKS_COMMIT)
        commit_load(spark, state_path, load, [(source, None, None, f"{stream}:{batch_id}", None)])
        out.append(Outcome(app, table, "stream", OK, n_files=n, n_rows=obs.get["n"]))
    return out


def _stream_archives(spark, archives, rows, state_path, app, run_date, stream, batch_id, max_parallel) -> list[Outcome]:
    source = f"{app}!stream"
    if _done(spark, state_path, source, stream, batch_id):
        return []
    discard_unfinished(spark, state_path, [source], read_state(spark, state_path))
    places, names, routing = _places(spark, rows)
    directory = _kept(zip_directory(archives), "zip-members")
    broken = _by_archive(directory.where(F.col("error").isNotNull()))
    mark = (source, None, None, f"{stream}:{batch_id}", None)
    for _ in range(2):  # again without archives whose members turn out damaged
        counts, broken = _land_members(spark, directory, broken, archives, routing, names, state_path, source, run_date, None,
                                       max_parallel, None, False, mark)
        if counts is not None:
            break
    else:
        raise OSError("archives change while they are read")
    return [Outcome(app, path, "stream", FAILED, n_files=1, message=error) for path, error in broken.items()] + [
        Outcome(app, t, "stream", OK, n_files=counts[i][1], n_rows=counts[i][0]) for i, t in enumerate(places.values())]

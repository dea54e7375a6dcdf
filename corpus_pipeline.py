"""The corpus pipeline: language ID, near-duplicates, decontamination, secrets, packing.

``STAGES`` lists (name, function) in order.  A function takes (spark, docs, sf_dir) and returns the
documents that stay, with the columns they came with; the last returns packed pieces.  Each stage
works on all that its predecessor kept; ``run`` writes every stage's result as Parquet in the
shared folder and reads it again.

Stages decide by row, not by ``doc_id``: rows without one, and several texts of one id, are documents
like others.  A text is never changed, and columns of any name are kept as they were.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import stored, table
from tidelake.llm.op3_minhash import near_duplicates
from tidelake.llm.op6_language import fit, label
from tidelake.llm.op7_packing import pack
from tidelake.llm.op8_decontaminate import contaminated
from tidelake.llm.op10_secrets import scan_secrets

MIN_LANGUAGE_SCORE = 0.5
ROW = "_row_of_file"
BATCH_ROWS = 1000
NEAR = (80, 100)  # similarity of the near-duplicate stage


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows from here on: texts are long, and a task holds a batch on
    its way to Python and one on its way back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def renamed(docs: DataFrame) -> tuple[DataFrame, list]:
    """``docs`` with its columns as c0, c1, ... (``text`` stays), and the columns that give them back."""
    names = {c: c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), [F.col(n).alias(c) for c, n in names.items()]


def numbered(docs: DataFrame) -> tuple[DataFrame, list]:
    """``renamed`` documents with ``doc_id``, the number of the row, and ``own``, its id.  A row's number is
    its file's and its place there, if ``docs`` is one Parquet folder as Spark writes it (a stage's result
    is); other frames are stored first."""
    files = [re.search(r"/part-(\d+)-[^/]*$", f) for f in docs.inputFiles()]
    numbers = {f.group(1) for f in files if f}
    if files and len(numbers) == len(files):
        try:
            part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)-", 1).cast("long")
            place = F.shiftleft(part, 33) + F.col("_metadata.row_index")
            found, back = renamed(docs.withColumn(ROW, place))
            return found.withColumnRenamed(f"c{len(docs.columns)}", "doc_id").withColumn("own", _own(docs)), back[:-1]
        except AnalysisException:
            pass  # not the folder's rows as they are
    rows, back = renamed(docs)
    return stored(rows.select(F.monotonically_increasing_id().alias("doc_id"), _own(docs).alias("own"), "*"), "numbered"), back


def _own(docs: DataFrame):
    return F.col(f"c{docs.columns.index('doc_id')}").cast("long")


def without(rows: DataFrame, back: list, drop: DataFrame) -> DataFrame:
    """The documents of ``numbered`` rows that ``drop`` (doc_id) does not name; stored first, so that its
    size is known and few rows are not joined by shuffling all texts."""
    gone = stored(drop.select("doc_id").distinct(), "dropped")
    return rows.join(gone, "doc_id", "left_anti").select(*back)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is recognised: not ``und``, and with a probability of at least one half."""
    import public_tokenizers

    small_batches(spark)
    model = fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    rows, back = renamed(docs)
    return label(rows, model, "_pred", "_score").where(
        (F.col("_pred") != "und") & (F.col("_score") >= MIN_LANGUAGE_SCORE)).select(*back)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id (none: last)."""
    small_batches(spark)
    rows, back = numbered(docs)
    found = stored(near_duplicates(rows.select("doc_id", "text"), *NEAR), "near")
    several = found.where("not kept").select("component_id").distinct()
    group = found.join(several, "component_id").select("doc_id", "component_id").join(rows.select("doc_id", "own"), "doc_id")
    first = F.min(F.struct(F.col("own").isNull(), "own", "doc_id")).alias("first")
    stays = group.groupBy("component_id").agg(first).select(F.col("first.doc_id").alias("doc_id"))
    return without(rows, back, group.join(stays, "doc_id", "left_anti"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    small_batches(spark)
    rows, back = numbered(docs)
    return without(rows, back, contaminated(rows.select("doc_id", "text"), table(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without secrets."""
    rows, back = numbered(docs)
    return without(rows, back, scan_secrets(rows.select("doc_id", "text")).where(F.size("found") > 0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    import public_tokenizers

    small_batches(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("near_duplicates", dedup), ("decontamination", decontaminate),
          ("secrets", secrets), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

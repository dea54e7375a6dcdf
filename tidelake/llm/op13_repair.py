"""Operator 13: conversation structure repair by Four-Russians block tables.

Every conversation is edited at the least price into turns of user and assistant, after at most one
system turn (see ``four_russians`` for prices and tables).  Rows are put in order by ranges of
(conversation, turn), without their texts, and cut into segments of at most 4,096 rows and 8 MB of
text, so a conversation of any length lies in many tasks.  A segment is the string of its rows' codes.
Where a conversation has several, each one's effect on all cost vectors and entry states is made by
itself, and these effects are composed by 256 at a time, up and down again: then every segment knows
the vector after it and the state before it, and is traced alone.  Texts are joined only to the rows
that stay and are put together by segment; the digest of a conversation of several segments streams
over them in order, as SHA-256 has no other way.

Faults: a row is blank, else a duplicate (role and text as an earlier row of its conversation; the
first is found by a grouped minimum, so a text that all rows share is no hot group), else truncated.

Defined cases: nulls in role or text count as one space, and are one space in the damage key; a null
``conv_id`` is a conversation of its own; rows of one turn go by role, then by the SHA-256 of the text;
a repeated row is a duplicate; a conversation without rows after damage has zeros, an empty audit and
the digest of the empty string; an empty table gives an empty result; extra columns are ignored; a text
of any length is whole.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm import four_russians as fr
from tidelake.llm.common import column, stored, table
from tidelake.llm.ranks import PART, PLACE, ordered

ROWS_LOG2, BYTES, FAN = 12, 8 << 20, 256
WORD = r"[^\x20\x09-\x0D]"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
ROLES = ("system", "user", "assistant")
EDITED = ("conv string, seg long, audit string, blank long, duplicate long, truncated long, illegal long, cost long, head int, "
          "tail int, lines array<struct<idx:int,place:long,role:string>>")
EFFECT = "conv string, node long, vector array<int>, state array<int>"
KNOWN = "conv string, node long, last int, entry int"


def keyed(rows: DataFrame) -> DataFrame:
    """conv (a key that tells null from text), conv_id, turn, role and text."""
    one = F.lit(" ")
    return rows.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), "conv_id",
                       F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), one).alias("role"),
                       F.coalesce(F.col("text").cast("string"), one).alias("text"))


def damage(rows: DataFrame) -> DataFrame:
    """Rows as the damage leaves them, by the checksum of ``conv_id:turn``: dropped, emptied, without
    marks, repeated or said by the user."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    rows = rows.withColumn("_kind", kind).where("_kind != 0")
    rows = rows.withColumn("text", F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                           .otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")))
    times = F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))
    return rows.withColumn("_time", F.explode(times)).drop("_kind", "_time")


def role_class(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(fr.OTHER)


def marked(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text) without texts: digest, size, blank and truncated."""
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    return rows.select("conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").alias("bytes"),
                       (F.char_length(bare) == 0).alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))


def in_segments(rows: DataFrame) -> DataFrame:
    """``rows`` in order, stored, with place and segment: both grow along the order."""
    light = stored(marked(rows), "conv-marks")  # read twice: sampling for the ranges, and dealing out
    placed = ordered(light, ["conv", F.asc_nulls_first("turn"), "role", "digest"], "conv-order")
    before = Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # rows by 4,096, and within these by 8 MB of the range; a range has less than 2**24 of the latter
    many = (F.sum("bytes").over(before) / F.lit(BYTES)).cast("long") % (1 << 24)
    seg = F.shiftleft(F.shiftright(PLACE, ROWS_LOG2), 24) + many
    return stored(placed.withColumn("seg", seg).withColumnRenamed(PLACE, "place").drop(PART, "bytes"), "conv-rows")


def codes(light: DataFrame) -> DataFrame:
    """(conv, seg, first, codes): the segments, stored.  Places in a segment are consecutive."""
    said = light.where("not blank")
    firsts = said.groupBy("conv", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    rows = light.join(firsts, "place", "left")
    gone = F.col("blank") | F.col("new").isNull()
    code = role_class(F.col("role")) * 3 + F.when(gone, fr.DELETE).when(F.col("cut"), fr.TRUNCATED).otherwise(fr.OK)
    code = F.when(F.col("blank"), code + 12).otherwise(code)  # blank and duplicate are told apart for their counts
    per = rows.groupBy("conv", "seg").agg(F.min("place").alias("first"), F.array_sort(F.collect_list(F.struct("place", code.alias("code"))))
                                          .alias("rows"))
    return stored(per.select("conv", "seg", "first", F.transform("rows", lambda r: r["code"]).alias("codes")), "conv-segments")


def plain(values) -> np.ndarray:
    found = np.asarray(values, np.int64)
    return found - 12 * (found >= 12)


def effects(batches):
    for batch in batches:
        out = [(c, n, *(x.ravel().tolist() for x in fr.summary(plain(row))))
               for c, n, row in zip(*(column(batch, x).to_pylist() for x in ("conv", "node", "codes")))]
        cols = list(zip(*out)) or [()] * 4
        types = (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["conv", "node", "vector", "state"])


def _parts(group: pd.DataFrame):
    return [(np.asarray(v), np.asarray(s).reshape(-1, 4)) for v, s in zip(group["vector"], group["state"])]


def _up(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    vector, state = fr.compose(_parts(group.sort_values("node")))
    return pd.DataFrame({"conv": [key[0]], "node": [key[1]], "vector": [vector.tolist()], "state": [state.ravel().tolist()]})


def _down(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("node")
    known = fr.within(_parts(group), int(group["last"].iloc[0]), int(group["entry"].iloc[0]))
    return pd.DataFrame({"conv": group["conv"], "node": group["node"], "last": [v for v, _ in known], "entry": [s for _, s in known]})


def surroundings(segments: DataFrame, fan: int = FAN) -> DataFrame:
    """(conv, seg, last, entry, end, n_seg) of every segment: the vector after it, the state before it, and whether
    its conversation ends with it."""
    count = segments.groupBy("conv").agg(F.count("*").alias("n_seg"))
    keys = segments.select("conv", "seg").join(count, "conv")
    alone = keys.where("n_seg = 1").select("conv", "seg", F.lit(0).alias("last"), F.lit(fr.START).alias("entry"), F.lit(True).alias("end"), "n_seg")
    order = Window.partitionBy("conv").orderBy("seg")  # of segments, not rows
    several = stored(keys.where("n_seg > 1").withColumn("node", F.row_number().over(order).cast("long") - 1), "conv-several")
    levels = [stored(segments.join(several.select("conv", "seg", "node"), ["conv", "seg"]).select("conv", "node", "codes")
                     .mapInArrow(effects, EFFECT), "conv-effects")]
    above = F.floor(F.col("node") / fan).cast("long").alias("above")
    while (levels[-1].agg(F.max("node")).first()[0] or 0) > 0:
        up = levels[-1].select("conv", above, "node", "vector", "state").groupBy("conv", "above").applyInPandas(_up, EFFECT)
        levels.append(stored(up, "conv-effects"))
    known = levels[-1].select("conv", "node", F.lit(0).alias("last"), F.lit(fr.START).alias("entry"))
    for level in levels[-2::-1]:
        told = known.select("conv", F.col("node").alias("above"), "last", "entry")
        down = level.select("conv", above, "node", "vector", "state").join(told, ["conv", "above"])
        known = stored(down.groupBy("conv", "above").applyInPandas(_down, KNOWN), "conv-known")
    told = several.join(known, ["conv", "node"]).select("conv", "seg", "last", "entry", (F.col("node") == F.col("n_seg") - 1).alias("end"), "n_seg")
    return alone.unionByName(told)


def edit(codes_: list[int], first: int, last: int, entry: int, end: bool) -> tuple:
    """A segment's audit, counts and repaired rows."""
    t, found = fr.tables(), np.asarray(codes_, np.int64)
    code = plain(found)
    blocks, letters, lines, state = t.blocks(code), [], [], entry
    for i, (b, after) in enumerate(zip(blocks, t.before(blocks, last)[1:])):
        some, rows, state = t.trace(int(after), b, state)
        letters.append(some)
        lines.extend((None if at < 0 else first + i * t.length + at, None if role < 0 else ROLES[role]) for at, role in rows)
    if end:
        extra = t.finish(state)
        letters.append("I" * len(extra))
        lines.extend((None, ROLES[role]) for role in extra)
    audit, role, fault = "".join(letters), code // 3, code % 3
    taken = np.frombuffer(audit.replace("I", "").encode(), np.uint8) != ord("D")
    cost = (fr.DELETION * audit.count("D") + fr.INSERTION * audit.count("I") + fr.REROLE * audit.count("R")
            + fr.CUT * int((taken & (fault == fr.TRUNCATED)).sum()))
    blank = int((found >= 12).sum())
    return (audit, blank, int((fault == fr.DELETE).sum()) - blank, int((fault == fr.TRUNCATED).sum()), int(illegal(role[:-1], role[1:]).sum()),
            cost, int(role[0]), int(role[-1]), [{"idx": i, "place": p, "role": r} for i, (p, r) in enumerate(lines)])


def illegal(one, two):
    """Whether role class ``two`` may not follow ``one``."""
    return ~(((one != fr.OTHER) & (one != 1) & (two == 1)) | ((one == 1) & (two == 2)))


def edited(batches):
    names = [f.split()[0] for f in EDITED.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 5, pa.int32(), pa.int32(),
             pa.list_(pa.struct([("idx", pa.int32()), ("place", pa.int64()), ("role", pa.string())]))]
    for batch in batches:
        rows = zip(*(column(batch, c).to_pylist() for c in ("conv", "seg", "codes", "first", "last", "entry", "end")))
        out = [(conv, seg, *edit(*rest)) for conv, seg, *rest in rows]
        cols = list(zip(*out)) or [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


@dataclass
class Repair:
    """``audits``: conv, blank, duplicate, truncated, illegal, cost, audit, gaps.  ``rows``: the repaired
    rows, conv, seg, n_seg, idx (in the segment), role and text."""

    audits: DataFrame
    rows: DataFrame


def repair(rows: DataFrame, fan: int = FAN) -> Repair:
    """Repair ``rows`` (conv, turn, role, text; see ``keyed``)."""
    light = in_segments(rows)
    segments = codes(light)
    around = stored(surroundings(segments, fan), "conv-around")
    done = stored(segments.join(around, ["conv", "seg"]).select("conv", "seg", "codes", "first", "last", "entry", "end").mapInArrow(edited, EDITED),
                  "conv-edited")
    before = F.lag("tail").over(Window.partitionBy("conv").orderBy("seg"))  # of segments, not rows
    seams = done.select("conv", "seg", "audit", "blank", "duplicate", "truncated", "illegal", "cost", "head", before.alias("was"))
    good = (F.col("was").isin(0, 2) & (F.col("head") == 1)) | ((F.col("was") == 1) & (F.col("head") == 2))
    seams = seams.withColumn("illegal", F.col("illegal") + F.when(F.col("was").isNotNull() & ~good, 1).otherwise(0))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda s: s["audit"]), "")
    turns = light.groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    audits = seams.groupBy("conv").agg(*sums, audit.alias("audit")).join(turns, "conv")

    lines = done.join(around.select("conv", "seg", "n_seg"), ["conv", "seg"]).select("conv", "seg", "n_seg", F.explode("lines").alias("l"))
    lines = lines.select("conv", "seg", "n_seg", "l.idx", "l.place", F.col("l.role").alias("given"))
    kept = lines.where("place is not null").join(light.select("place", "role", "digest"), "place")
    said = rows.where(F.regexp_like("text", F.lit(WORD))).withColumn("digest", F.unhex(F.sha2("text", 256)))
    said = said.groupBy("conv", "role", "digest").agg(F.first("text").alias("text"))  # kept rows differ in these
    kept = kept.join(said, ["conv", "role", "digest"]).select("conv", "seg", "n_seg", "idx", F.coalesce("given", "role").alias("role"), "text")
    new = lines.where("place is null").select("conv", "seg", "n_seg", "idx", F.col("given").alias("role"), F.lit("").alias("text"))
    return Repair(audits, kept.unionByName(new))


def streamed(batches):
    """Digests of conversations whose segments come in order."""
    conv, state = None, None
    for batch in batches:
        out = []
        for c, text in zip(column(batch, "conv").to_pylist(), column(batch, "text")):
            if state is not None and c == conv:
                state.update(b"\n")
            else:
                if state is not None:
                    out.append((conv, state.hexdigest()))
                conv, state = c, hashlib.sha256()
            state.update(text.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in (0, 1)], names=["conv", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], names=["conv", "sha"])


def digests(rows: DataFrame) -> DataFrame:
    """(conv, sha) of repaired rows: SHA-256 of their ``role:text``, joined by line feeds."""
    line = F.struct("idx", F.concat("role", F.lit(":"), "text").alias("line"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]), "\n")
    parts = stored(rows.groupBy("conv", "seg", "n_seg").agg(whole.alias("text"))
                   .select("conv", "seg", "n_seg", F.when(F.col("n_seg") > 1, F.col("text")).alias("text"),
                           F.when(F.col("n_seg") == 1, F.sha2("text", 256)).alias("sha")), "conv-texts")
    long = parts.where("n_seg > 1").select("conv", "seg", "text").repartition("conv").sortWithinPartitions("conv", "seg")
    return parts.where("n_seg = 1").select("conv", "sha").unionByName(long.select("conv", "text").mapInArrow(streamed, "conv string, sha string"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``, damaged and repaired."""
    rows = keyed(table(spark, sf_dir, "conversations"))
    fixed = repair(damage(rows).select("conv", "turn", "role", "text"))
    return report(rows, fixed)


def report(rows: DataFrame, fixed: Repair) -> DataFrame:
    """One row for each conversation of ``rows``, those that lost all their rows included."""
    convs = rows.groupBy("conv", "conv_id").agg(F.lit(1)).select("conv", "conv_id")
    out = convs.join(fixed.audits, "conv", "left").join(digests(fixed.rows), "conv", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(EMPTY_SHA)).alias("repaired_sha256"))

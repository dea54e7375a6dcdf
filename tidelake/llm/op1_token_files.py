"""Operator 1: token ids as Arrow files of fixed-size-list batches.

Documents are range-partitioned by ``doc_id``, so shard *i* holds the ids before shard *i+1*.
Each task streams its documents into one Arrow IPC file (the stream format plus a footer of
batch positions): columns ``ids`` and ``mask`` are ``fixed_size_list[seq_len]``, every batch
but the last has ``batch_rows`` sequences, nothing is compressed.  Sequence *s* of a shard is
row ``s % batch_rows`` of batch ``s // batch_rows``, found without reading anything else, and a
memory-mapped read copies nothing.  ``mask`` is false on the padding after the last document.
A second file lists the shard's documents (id, start in the shard, ids).  Task attempts write
under names of their own; the manifest table, committed by Spark's Parquet writer, names the
files of the attempts that count, so retried or speculative tasks leave no trace in results.

Defined cases: a null text is empty (its only id is the end id); rows without ``doc_id`` come
first; rows of one ``doc_id`` (copies or not) are documents of their own, ordered by text hash;
an empty table gives no shard and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import column, shared_folder, table, texts
from tidelake.llm.shardio import make_folder, open_read, open_write
from tidelake.llm.tokens import documents, encoder

SEQ_LEN, BATCH_ROWS, END_ID = 1024, 256, 0
MANIFEST = "shard long, tokens_file string, docs_file string, n_docs long, n_tokens long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long, tokens_file string"


class ShardWriter:
    """Appends ids to fixed-length sequences and writes them by batch."""

    def __init__(self, uri: str, seq_len: int, batch_rows: int, wide: bool):
        self.width, self.kind = seq_len, np.dtype("<u4" if wide else "<u2")
        self.arrow = pa.uint32() if wide else pa.uint16()
        self.block = seq_len * batch_rows
        self.schema = pa.schema([("ids", pa.list_(self.arrow, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))],
                                {b"seq_len": str(seq_len).encode(), b"batch_rows": str(batch_rows).encode()})
        self.sink = open_write(uri)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind))
        self.n_held += len(ids)
        if self.n_held >= self.block:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.block * self.block
            for i in range(0, whole, self.block):
                self._write(flat[i:i + self.block], self.block)
            self.held, self.n_held = [flat[whole:]], len(flat) - whole

    def _write(self, flat: np.ndarray, used: int) -> None:
        mask = np.arange(len(flat)) < used
        self.writer.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(flat, self.arrow), self.width),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.width)], schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-len(flat) // self.width) * self.width, self.kind)
            padded[:len(flat)] = flat
            self._write(padded, len(flat))
        self.writer.close()
        self.sink.close()


class TokenShard:
    """Random access to one shard; arrays are views of the mapped file where it is local."""

    def __init__(self, uri: str):
        self.file = pa.ipc.open_file(open_read(uri))
        meta = self.file.schema.metadata
        self.seq_len, self.batch_rows = int(meta[b"seq_len"]), int(meta[b"batch_rows"])

    def sequence(self, s: int) -> tuple[np.ndarray, pa.Array]:
        batch = self.file.get_batch(s // self.batch_rows)
        r = s % self.batch_rows
        return (batch.column(0)[r].values.to_numpy(zero_copy_only=True), batch.column(1)[r].values)

    def block(self, b: int) -> np.ndarray:
        """All ids of batch ``b``."""
        col = self.file.get_batch(b).column(0)
        return col.flatten().to_numpy(zero_copy_only=True)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the shard."""
        size, parts = self.seq_len * self.batch_rows, []
        while n > 0:
            view = self.block(start // size)[start % size:][:n]
            parts.append(view)
            start, n = start + len(view), n - len(view)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID,
                      seq_len: int = SEQ_LEN, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards below ``folder``; returns the manifest."""
    spark = docs.sparkSession
    make_folder(folder)

    def shard(batches):
        enc = encoder(tokenizer_path)
        ctx = TaskContext.get()
        pid, name = ctx.partitionId(), f"{ctx.partitionId():06d}-{ctx.taskAttemptId()}"
        out, ids, sizes = None, [], []
        tokens_file, docs_file = f"{folder}/tokens-{name}.arrow", f"{folder}/docs-{name}.arrow"
        for batch in batches:
            if batch.num_rows and out is None:
                out = ShardWriter(tokens_file, seq_len, batch_rows, enc.vocab > 1 << 16)
            col = texts(batch, "text")
            ids.append(pa.array(column(batch, "doc_id").to_pylist(), pa.int64()))  # a copy: the batch may go
            for flat in documents(enc, col, end_id):
                out.add(flat)
                sizes.append(len(flat))
        if out is None:
            return
        out.close()
        n = np.array(sizes, np.int64)
        t = pa.table({"doc_id": pa.chunked_array(ids, pa.int64()), "start": np.cumsum(n) - n, "n_tokens": n})
        with open_write(docs_file) as sink, pa.ipc.new_file(sink, t.schema) as w:
            w.write_table(t)
        yield pa.RecordBatch.from_pydict(
            {"shard": [pid], "tokens_file": [tokens_file], "docs_file": [docs_file],
             "n_docs": [len(n)], "n_tokens": [int(n.sum())]})

    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .withColumn("_h", F.xxhash64("text")).withColumn("_r", F.monotonically_increasing_id())
            .repartitionByRange(F.col("doc_id").asc_nulls_first(), "_h", "_r")
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_h", "_r").select("doc_id", "text"))
    rows.mapInArrow(shard, MANIFEST).write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32, tokens_file.  One row of
    the manifest is one shard, so the running sum over it is over as many rows as files."""
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                shard = TokenShard(r["tokens_file"])
                t = pa.ipc.open_file(open_read(r["docs_file"])).read_all()
                start, n = t["start"].to_numpy(), t["n_tokens"].to_numpy()
                crc = [zlib.crc32(shard.ids(a, k).astype("<u4").tobytes()) for a, k in zip(start.tolist(), n.tolist())]
                full = pa.table({"doc_id": t["doc_id"], "start": pa.array(start + r["base"]), "n_tokens": t["n_tokens"],
                                 "ids_crc32": pa.array(crc, pa.int64()),
                                 "tokens_file": pa.array([r["tokens_file"].rsplit("/", 1)[-1]] * len(n), pa.string())})
                yield from full.to_batches(max_chunksize=20_000)

    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    return based.repartition(max(1, manifest.rdd.getNumPartitions())).mapInArrow(read, DOCS)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` through the files and back."""
    import public_tokenizers

    folder = shared_folder(spark, "tokens")
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), folder,
                                              public_tokenizers.path("byte_bpe_50k.json")))

"""Shared by the operators: input columns, seeded splits and packed blocks of documents.

A block is one row that holds the documents of a few megabytes as a compressed
Arrow stream.  Blocks are written once to the shared folder, so their content
is fixed: a task can ask questions about a block in one job and use the
answers in a later one.  Questions go out as one row per (block, bucket) and
the answers come back the same way, so what is shuffled are packed arrays of
distinct keys of a block, never a row per character or word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.session import write_stage

#: Raw bytes of text in one block; a longer document is a block of its own.
BLOCK_BYTES = 2 << 20
#: log2 of the bits in a table of keys, kept as rows of 64 bits: at most 2 ** 18 small rows are broadcast, with keys in any number.
KEY_BITS = 24


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def key_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text, so other columns of any name cannot clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def _slot(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - KEY_BITS)


def split_by_keys(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose ``column`` may be among the ``keys`` (one column), and those whose is surely not.

    A bit table of fixed size decides, so rows with texts are not shuffled to be
    looked up.  It only saves work: the first part holds every row whose key is
    among the keys, and others whose bit is the same; an exact join settles them.
    """
    slots = keys.select(_slot(F.col(keys.columns[0])).alias("slot"))
    bit = F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")
    table = F.broadcast(slots.groupBy(F.shiftright("slot", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits")))
    found = rows.withColumn("_slot", _slot(F.col(column))).withColumn("_word", F.shiftright("_slot", 6)).join(table, "_word", "left")
    held = F.coalesce(F.expr("shiftrightunsigned(_bits, CAST(_slot & 63 AS INT)) & 1"), F.lit(0)) == 1
    return found.filter(held).select(*rows.columns), found.filter(~held).select(*rows.columns)


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds


def texts_of(batch: pa.RecordBatch | pa.Table, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null is empty."""
    col = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
    return col.to_pylist()


def small_batches(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def write_blocks(docs: DataFrame, label: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (with a ``text`` column) as written blocks: block, n_bytes, payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, part in enumerate(small_batches(batches, limit=block_bytes)):
            n = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            yield pa.record_batch({"block": pa.array([first + i], pa.int64()), "n_bytes": pa.array([n], pa.int64()), "payload": pa.array([pack(part)], pa.binary())})

    return write_stage(docs.mapInArrow(run, "block long, n_bytes long, payload binary"), label)


def buckets_for(blocks: DataFrame, bytes_per_key_byte: float, bucket_bytes: int = 4 << 20) -> int:
    """A power of two of buckets, so that a bucket gets about ``bucket_bytes`` of keys."""
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    want = max(16, int(total * bytes_per_key_byte / bucket_bytes))
    return 1 << (want - 1).bit_length()


def answers_by_block(answers: DataFrame) -> DataFrame:
    """One row per block: its (bucket, answer) pairs in bucket order."""
    return answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias("answers"))


def with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks next to what their buckets answered; blocks that asked nothing have a null list."""
    return blocks.join(answers_by_block(answers), "block", "left")


def over_blocks(fn: Callable[[pa.Table, list | None], Iterator[pa.RecordBatch]]) -> Callable:
    """A ``mapInArrow`` function that opens each block and hands over its answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = "answers" in batch.schema.names
            for i in range(batch.num_rows):
                answers = batch.column("answers")[i].as_py() if has else None
                yield from fn(batch.column("block")[i].as_py(), unpack(batch.column("payload")[i].as_py()), answers)

    return run

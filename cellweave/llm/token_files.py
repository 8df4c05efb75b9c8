"""Token-id shards with a minimal perfect hash index.

Files of one data set:

* **Payload shards**, raw files: the ids of consecutive documents in ascending
  key order (little-endian unsigned integers of one width), then the offset of
  each document (64-bit, counted in ids, with a last one for the end), then a
  footer of four 64-bit integers: magic, width in bytes, documents, ids.
* **Manifest**, a table with a row per shard: its file and how many ids and documents of the
  whole data set stand before it.
* **Index**, a table with a row per bucket of keys: a minimal perfect hash over
  the bucket's keys and, at each key's slot, a stored fingerprint and the
  (shard, first record, records) of the key.

The hash is a cascade of bit arrays: a key that falls alone on a bit of a level
has its slot there, the others go on to the next level; the slot is the number
of set bits before it.  So a lookup reads a few words of one bucket, compares
the fingerprint, and then the shard's offsets and the ids themselves, however
many keys there are.

A task writes its shards under names of its own attempt, and only the manifest,
which Spark commits, says which files count: a lost or repeated attempt leaves
files that nothing refers to.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import key_and_text, small_batches
from cellweave.llm.rolling import mix
from cellweave.session import scratch_path, write_stage

#: Ids after which a shard is closed; a longer document is a shard of its own.
SHARD_IDS = 1 << 22
#: Raw bytes of text that one writing task is meant to get.
TASK_BYTES = 64 << 20
#: Keys that one bucket of the index is meant to get.
BUCKET_KEYS = 1 << 17
_MAGIC = 0x53444944
_GAMMA = 2.0
_LEVELS = 64


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it can be seen, else the next free one."""
    seen = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Pieces(dict):
    """Lower-case pieces to packed ids, by the tokenizer's merges alone."""

    _LETTER = byte_letters()

    def __init__(self, tokenizer, width: str, most: int) -> None:
        super().__init__()
        self.split, self.kind, self.most = tokenizer.model.tokenize, np.dtype(width).char, most

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        packed = self[piece] = array(self.kind, [t.id for t in self.split("".join(map(self._LETTER.__getitem__, piece.encode("utf-8"))))]).tobytes()
        return packed


class Encoder(dict):
    """Parts between blanks to packed ids, memorised.

    The tokenizer drops white space and joins nothing across it, so parts are
    encoded by themselves.  Where its rules say no more about printable ASCII and
    the letters of Latin-1 than the fixed values below, such a part goes piece by
    piece to the merges; every other part goes to the tokenizer whole.
    """

    #: A normaliser that only lower-cases those characters, and the pieces they are split into next.
    _LOWER = {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    }
    _SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    _PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[!-/:-@\[-`{-~]+").findall
    _SIMPLE = re.compile(r"[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch

    def __init__(self, tokenizer: str, width: str, most: int = 1_200_000) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer, self.width, self.most = Tokenizer.from_str(tokenizer), np.dtype(width), most
        rules = json.loads(tokenizer)
        steps = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.plain = rules["normalizer"] == self._LOWER and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        self.plain = self.plain and steps[0]["pattern"] == {"Regex": self._SPLIT}
        self.pieces = Pieces(self.tokenizer, width, most)
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first = re.compile("|".join(re.escape(t[0]) for t in self.special) or "(?!)").search

    def __missing__(self, part: bytes) -> bytes:
        text = part.decode("utf-8")
        low = text.lower()
        if self.plain and self._SIMPLE(text) and not (self.first(low) and any(t in low for t in self.special)):
            packed = b"".join(map(self.pieces.__getitem__, self._PARTS(low)))
        else:
            ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            packed = np.array(ids, dtype=self.width).tobytes()
        if len(part) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[part] = packed
        return packed

    def encode(self, text: bytes, end: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split())) + end


_WORKER: dict[tuple, Encoder] = {}


def _encoder(path: str, tokenizer: str, width: str) -> Encoder:
    """One encoder per worker process, which later tasks find again."""
    if (path, width) not in _WORKER:
        _WORKER.clear()
        _WORKER[path, width] = Encoder(tokenizer, width)
    return _WORKER[path, width]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, which may be a plain local one."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def write_shard(path: str, width: str, documents: list[bytes]) -> None:
    """One payload file from the packed ids of its documents."""
    size = np.dtype(width).itemsize
    offsets = np.concatenate([[0], np.cumsum([len(d) // size for d in documents])]).astype("<u8")
    files, name = _open(path)
    with files.open_output_stream(name, compression=None) as out:
        for d in documents:
            out.write(d)
        out.write(offsets.tobytes())
        out.write(np.array([_MAGIC, size, len(documents), offsets[-1]], dtype="<u8").tobytes())


class Shard:
    """One payload file opened for reading."""

    def __init__(self, path: str) -> None:
        files, name = _open(path)
        self.file = files.open_input_file(name)
        end = self.file.size()
        magic, size, docs, ids = np.frombuffer(self.file.read_at(32, end - 32), dtype="<u8").tolist()
        if magic != _MAGIC:
            raise ValueError(f"{path} is no payload shard")
        self.width, self.size = np.dtype(f"<u{size}"), size
        self.offsets = np.frombuffer(self.file.read_at(8 * (docs + 1), ids * size), dtype="<u8").astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of records ``first`` to ``last`` - 1."""
        start, stop = int(self.offsets[first]), int(self.offsets[last])
        return np.frombuffer(self.file.read_at((stop - start) * self.size, start * self.size), dtype=self.width)

    def close(self) -> None:
        self.file.close()


class PerfectHash:
    """A minimal perfect hash over distinct pairs of 64-bit hashes."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.first = np.concatenate([[0], np.cumsum(sizes // 64)]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @staticmethod
    def place(h: np.ndarray, k: np.ndarray, level: int, size: int) -> np.ndarray:
        return mix(h + k * np.uint64(2 * level + 1) + np.uint64(level)) % np.uint64(size)

    @classmethod
    def build(cls, h: np.ndarray, k: np.ndarray) -> PerfectHash:
        sizes, words, level = [], [np.zeros(0, dtype=np.uint64)], 0
        while len(h):
            if level == _LEVELS:
                raise ValueError("two keys have the same 128-bit hash")
            size = max(64, -(-int(_GAMMA * len(h)) // 64) * 64)
            at = cls.place(h, k, level, size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            sizes.append(size)
            left = ~alone[at.astype(np.int64)]
            h, k, level = h[left], k[left], level + 1
        return cls(np.array(sizes, dtype=np.int64), np.concatenate(words))

    def slots(self, h: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The slot of each key; a key that is not in the table gets some slot or -1."""
        out = np.full(len(h), -1, dtype=np.int64)
        left = np.arange(len(h))
        for level, size in enumerate(self.sizes.tolist()):
            at = self.place(h[left], k[left], level, size)
            word = self.first[level] + (at >> np.uint64(6)).astype(np.int64)
            bit = at & np.uint64(63)
            found = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[found]] = (self.before[word] + np.bitwise_count(below))[found]
            left = left[~found]
            if not len(left):
                break
        return out


@dataclass(frozen=True)
class TokenFiles:
    """What ``write`` has written: folder, manifest, index and the number of index buckets."""

    folder: str
    manifest: DataFrame
    index: DataFrame
    buckets: int


def _hashes(key: Column, run: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of (key, run number); a null key is a key of its own."""
    return tuple(F.xxhash64(F.lit(seed), key.isNull(), key, run) for seed in (1, 2))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(F.shiftright(h, 40), F.lit(buckets)).cast("int")


def write(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    width: str = "<u2", shard_ids: int = SHARD_IDS, task_bytes: int = TASK_BYTES, bucket_keys: int = BUCKET_KEYS,
) -> TokenFiles:
    """Encode every text, end it with ``end_id``, and write shards, manifest and index.

    ``tokenizer`` is a tokenizer file on the driver that drops white space; its few
    megabytes travel with the tasks.  ``width`` must hold its largest id.  Documents are written in ascending key order, null keys
    first; rows of one key stand next to each other in no stated order.  A null
    text is empty and is the end id alone.  An empty table gives no shards.
    Rows are dealt by range of (key, place of the row), so copies of one key are
    split over tasks like any others.
    """
    spark = docs.sparkSession
    rows = key_and_text(docs, id_col, text_col).withColumn("place", F.monotonically_increasing_id())
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")) if total > task_bytes else 1, -(-total // task_bytes))
    dealt = rows.repartitionByRange(tasks, "doc_id", "place").sortWithinPartitions("doc_id", "place")
    folder = scratch_path(spark, "token-files")
    files, name = _open(folder)
    files.create_dir(name, recursive=True)
    end = np.array([end_id], dtype=width).tobytes()
    size = np.dtype(width).itemsize
    kind = rows.schema["doc_id"].dataType.simpleString()
    with open(tokenizer, encoding="utf-8") as text:
        shared = spark.sparkContext.broadcast(text.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = _encoder(tokenizer, shared.value, width), TaskContext.get().partitionId()
        own, number, start = f"{folder}/{task:08d}-{uuid.uuid4().hex}", 0, 0
        keys, held, ids = [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, start, keys, held, ids
            if held:
                file = f"{own}-{number:06d}.ids"
                write_shard(file, width, held)
                shard = (task << 32) | number
                key = pa.concat_arrays(keys)
                n = len(held)
                yield _written(key, shard, np.arange(n), None, None)
                yield _written(pa.nulls(1, key.type), shard, np.array([n]), start, (file, ids))
                number, start, keys, held, ids = number + 1, start + ids, [], [], 0

        for batch in small_batches(batches):
            texts = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"").to_pylist()
            packed, at = [encoder.encode(t, end) for t in texts], 0
            while at < len(packed):
                stop = at
                while stop < len(packed) and (ids == 0 or ids + len(packed[stop]) // size <= shard_ids):
                    ids += len(packed[stop]) // size
                    stop += 1
                held += packed[at:stop]
                keys.append(batch.column("doc_id").slice(at, stop - at))
                at = stop
                if at < len(packed):
                    yield from close()
        yield from close()

    schema = f"doc_id {kind}, shard long, record long, start long, file string, n_ids long"
    written = write_stage(dealt.mapInArrow(run, schema), "token-records")
    shards = written.filter("file is not null").withColumn("task", F.shiftright("shard", 32))
    # one row per writing task, so this window over all of them stays small
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sums = shards.groupBy("task").agg(F.sum("n_ids").alias("n"), F.sum("record").alias("d"))
    sums = sums.select("task", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "d")))
    manifest = shards.join(sums, "task").select("shard", "file", "n_ids", F.col("record").alias("n_docs"), (F.col("start") + F.col("n_before")).alias("start"))
    manifest = write_stage(manifest, "token-manifest")
    runs = written.filter("file is null").groupBy("doc_id", "shard").agg(F.min("record").alias("record"), F.count(F.lit(1)).alias("records"))
    index, buckets = _index(runs, bucket_keys)
    return TokenFiles(folder, manifest, index, buckets)


def _written(key: pa.Array, shard: int, record: np.ndarray, start: int | None, file: tuple[str, int] | None) -> pa.RecordBatch:
    n = len(record)
    return pa.record_batch(
        {
            "doc_id": key, "shard": pa.array(np.full(n, shard), pa.int64()), "record": pa.array(record, pa.int64()),
            "start": pa.array([start] * n, pa.int64()), "file": pa.array([file and file[0]] * n, pa.string()), "n_ids": pa.array([file and file[1]] * n, pa.int64()),
        }
    )


_INDEX = "bucket int, keys long, sizes binary, words binary, fingerprints binary, shards binary, records binary, counts binary, runs binary"


def _index(runs: DataFrame, bucket_keys: int) -> tuple[DataFrame, int]:
    """The index over (key, run) where a key has one run for each shard that holds some of its records."""
    order = Window.partitionBy("doc_id").orderBy("shard")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = runs.withColumn("run", F.row_number().over(order) - 1).withColumn("runs", F.count(F.lit(1)).over(whole))
    h, k = _hashes(F.col("doc_id"), F.col("run"))
    keyed = write_stage(runs.select(h.alias("h"), k.alias("k"), "shard", "record", "records", "runs"), "token-keys")
    buckets = -(-keyed.count() // bucket_keys) or 1

    def build(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).to_numpy()
        h, k = column("h").astype(np.uint64), column("k").astype(np.uint64)
        table_hash = PerfectHash.build(h, k)
        at = table_hash.slots(h, k)

        def put(values: np.ndarray) -> bytes:
            out = np.empty(len(values), dtype=values.dtype)
            out[at] = values
            return out.tobytes()

        stored = {"fingerprints": fingerprint(h, k), "shards": column("shard"), "records": column("record"), "counts": column("records"), "runs": column("runs").astype(np.int64)}
        row = {"bucket": [column("bucket")[0]], "keys": [len(h)], "sizes": [table_hash.sizes.tobytes()], "words": [table_hash.words.tobytes()]}
        row |= {name: [put(values)] for name, values in stored.items()}
        return pa.table({name: pa.array(v, pa.int32() if name == "bucket" else pa.int64() if name == "keys" else pa.binary()) for name, v in row.items()})

    built = keyed.withColumn("bucket", _bucket(F.col("h"), buckets)).groupBy("bucket").applyInArrow(build, _INDEX)
    return write_stage(built, "token-index"), buckets


def fingerprint(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    return (mix(h ^ (k * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(32)).astype(np.uint32)


def _probe(asked: pa.Table, index: pa.Table) -> pa.Table:
    """Slots of asked keys in one bucket, compared with the stored fingerprints."""
    h, k = (asked.column(c).to_numpy().astype(np.uint64) for c in ("h", "k"))
    fields = {"shards": "<i8", "records": "<i8", "counts": "<i8", "runs": "<i8"}
    got = {name: np.zeros(0, dtype=np.int64) for name in fields}
    hit = np.zeros(len(h), dtype=bool)
    if index.num_rows and len(h):
        raw = {name: index.column(name)[0].as_py() for name in index.schema.names}
        at = PerfectHash(np.frombuffer(raw["sizes"], dtype=np.int64), np.frombuffer(raw["words"], dtype=np.uint64)).slots(h, k)
        hit = (at >= 0) & (np.frombuffer(raw["fingerprints"], dtype=np.uint32)[at] == fingerprint(h, k))
        got = {name: np.frombuffer(raw[name], dtype=dtype)[at[hit]] for name, dtype in fields.items()}
    kept = asked.filter(pa.array(hit, pa.bool_()))
    return pa.table(
        {"doc_id": kept.column("doc_id"), "shard": got["shards"], "record": got["records"], "records": got["counts"], "runs": got["runs"]}
    )


def lookup(files: TokenFiles, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(doc_id, shard, record, records, runs): where the records of each distinct asked key stand.

    Keys that are not in the data set give no row; by the 32-bit fingerprint one
    in four milliards of them is taken for another.  ``key_col`` must have the type of the written keys.
    """
    asked = keys.select(F.col(key_col).alias("doc_id")).distinct()
    kind = asked.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, shard long, record long, records long, runs long"

    def of(asked: DataFrame) -> DataFrame:
        h, k = _hashes(F.col("doc_id"), F.col("run"))
        asked = asked.select("doc_id", h.alias("h"), k.alias("k")).withColumn("bucket", _bucket(F.col("h"), files.buckets))
        return asked.groupBy("bucket").cogroup(files.index.groupBy("bucket")).applyInArrow(_probe, schema)

    first = write_stage(of(asked.withColumn("run", F.lit(0))), "token-found")
    more = first.filter("runs > 1").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("runs").cast("int") - 1)).alias("run"))
    return first.unionAll(of(more))


def read(files: TokenFiles, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, ids) of every record of the asked keys, read back from the shards.

    ``start`` counts the ids of all records before it in the whole data set;
    ``ids`` are packed little-endian unsigned 32-bit integers.
    """
    found = lookup(files, keys, key_col)
    kind = found.schema["doc_id"].dataType.simpleString()
    places = found.join(files.manifest.select("shard", "file", F.col("start").alias("before")), "shard")

    def fetch(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.sort_by("record")
        shard = Shard(table.column("file")[0].as_py())
        before = table.column("before")[0].as_py()
        first, many = table.column("record").to_numpy(), table.column("records").to_numpy()
        sizes = shard.offsets[first + many] - shard.offsets[first]
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (1 << 20), prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(first)]):
            out, starts, which = [], [], []
            for row in range(a, b):
                for record in range(first[row], first[row] + many[row]):
                    out.append(shard.ids(record, record + 1).astype("<u4").tobytes())
                    starts.append(before + int(shard.offsets[record]))
                    which.append(row)
            ids = table.column("doc_id").take(pa.array(which, pa.int64())).combine_chunks()
            yield pa.record_batch({"doc_id": ids, "start": pa.array(starts, pa.int64()), "ids": pa.array(out, pa.binary())})
        shard.close()

    def group(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(fetch(table))

    return places.groupBy("shard").applyInArrow(group, f"doc_id {kind}, start long, ids binary")

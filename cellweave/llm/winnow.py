"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` consecutive words the smallest hash among its
``GRAM``-word shingles is kept (the last one on ties).  The choice depends on
the words of the window alone, so equal windows keep equal fingerprints, and
every shared span of ``WINDOW`` words is found.  Documents and items meet on
their fingerprints; each hit is extended to the windows around it, whose words
are compared in full.

A bit table of fixed size over the items' fingerprints keeps fingerprints that
cannot meet out of the join.  It only saves work: with a benchmark of any size
the join decides, and a full table lets everything through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import key_and_text, small_batches, texts_of
from cellweave.llm.rolling import Rolling, mix
from cellweave.session import write_stage

WINDOW = 10
GRAM = 5
#: log2 of the bits in the table; at most so many slot numbers reach the driver.
TABLE_BITS = 22

_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_STEP = np.uint64(0x9DDFEA08EB382D69)


class Words:
    """The words of a list of texts: where they stand, their hashes, whose they are."""

    def __init__(self, texts: list[bytes]) -> None:
        self.data = b"\0".join(texts).lower() + b"\0"
        raw = np.frombuffer(self.data, dtype=np.uint8)
        edge = np.diff(_WORD[raw].astype(np.int8), prepend=np.int8(0))
        self.start, self.stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
        self.doc = np.searchsorted(ends, self.start, "right")
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.hash = Rolling(raw).of(self.start, self.stop)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-word shingles by first word, and which stay inside one text."""
        size = max(0, len(self.start) - n + 1)
        out = np.zeros(size, dtype=np.uint64)
        for j in range(n):
            out = out * _STEP + self.hash[j : j + size]
        return mix(out + np.uint64(n)), self.doc[:size] == self.doc[n - 1 : n - 1 + size]

    def winnowed(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and fingerprint of every whole window."""
        hashes, _ = self.shingles(gram)
        size = max(0, len(self.start) - window + 1)
        kept = hashes[:size].copy()
        for j in range(1, window - gram + 1):
            np.minimum(kept, hashes[j : j + size], out=kept)
        whole = np.flatnonzero(self.doc[:size] == self.doc[window - 1 : window - 1 + size])
        return whole, kept[whole]

    def text(self, first: int, n: int) -> str:
        return b" ".join([self.data[a:b] for a, b in zip(self.start[first : first + n], self.stop[first : first + n])]).decode("utf-8", "replace")

    def fingerprints(self, n: int, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and fingerprint of all windows of n words; short windows are their own shingle."""
        if n == window:
            return self.winnowed(window, gram)
        hashes, inside = self.shingles(n)
        at = np.flatnonzero(inside)
        return at, hashes[at]


def _slots(prints: np.ndarray) -> np.ndarray:
    return (prints >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(item_id, size, fingerprint, words): the distinct windows of every item.

    An item with fewer words than ``window`` is one window; one without words,
    or without an id, has none.
    """
    rows = key_and_text(items, item_col, text_col).select(F.col("doc_id").cast("string").alias("item_id"), "text").filter("item_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, limit=1 << 20):
            words = Words(texts_of(batch))
            counts = np.diff(words.first)
            ids = batch.column("item_id").to_pylist()
            for n in sorted({*np.minimum(counts, window).tolist()} - {0}):
                at, prints = words.fingerprints(n, window, gram)
                own = np.minimum(counts, window)[words.doc[at]] == n
                at, prints = at[own], prints[own]
                yield pa.record_batch(
                    {
                        "item_id": pa.array([ids[d] for d in words.doc[at]], pa.string()),
                        "size": pa.array(np.full(len(at), n), pa.int32()),
                        "fingerprint": pa.array(prints.view(np.int64)),
                        "words": pa.array([words.text(i, n) for i in at.tolist()], pa.string()),
                    }
                )

    return rows.mapInArrow(run, "item_id string, size int, fingerprint long, words string").distinct()


def _candidates(docs: DataFrame, sizes: list[int], table: np.ndarray, window: int, gram: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        kind = pa.list_(pa.struct([("first", pa.int32()), ("size", pa.int32()), ("fingerprint", pa.int64()), ("words", pa.string())]))
        for batch in small_batches(batches, limit=1 << 20):
            words = Words(texts_of(batch))
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for n in sizes:
                at, prints = words.fingerprints(n, window, gram)
                hit = bits[_slots(prints)]
                for i, p in zip(at[hit].tolist(), prints[hit].view(np.int64).tolist()):
                    d = words.doc[i]
                    found[d].append({"first": i - words.first[d], "size": n, "fingerprint": p, "words": words.text(i, n)})
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "n_words": pa.array(np.diff(words.first), pa.int64()), "found": pa.array(found, kind)}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_words long, found array<struct<first:int, size:int, fingerprint:long, words:string>>")


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of an item's window,
    ``items`` lists the items with occurring windows, sorted as strings, and
    ``spans`` the maximal runs of hit words as (first, stop).  Null and wordless
    texts have no words and no hits.  Rows are told apart by their place, so
    repeated and missing keys are allowed.  Without items nothing is hit.
    """
    tests = write_stage(item_windows(items, item_col, item_text_col, window, gram), "item-windows")
    sizes = sorted(r[0] for r in tests.select("size").distinct().collect())
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    slots = tests.select(F.shiftrightunsigned("fingerprint", 64 - TABLE_BITS).alias("slot")).distinct().toPandas()["slot"].to_numpy(dtype=np.int64)
    table[slots] = True
    rows = _candidates(key_and_text(docs, id_col, text_col), sizes, table, window, gram)
    rows = write_stage(rows.withColumn("row", F.monotonically_increasing_id()), "windows")
    asked = rows.select("row", F.inline("found"))
    on = ["size", "fingerprint", "words"]
    hits = asked.join(tests.select(*on).distinct(), on, "left_semi").select("row", "first", (F.col("first") + F.col("size")).alias("stop"))
    before = Window.partitionBy("row").orderBy("first", "stop").rowsBetween(Window.unboundedPreceding, -1)
    opened = hits.distinct().withColumn("reach", F.max("stop").over(before))
    opened = opened.withColumn("fresh", (F.col("reach").isNull() | (F.col("first") > F.col("reach"))).cast("int"))
    runs = opened.withColumn("run", F.sum("fresh").over(Window.partitionBy("row").orderBy("first", "stop")))
    spans = runs.groupBy("row", "run").agg(F.min("first").alias("first"), F.max("stop").alias("stop"))
    spans = spans.groupBy("row").agg(F.sum(F.col("stop") - F.col("first")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("first", "stop"))).alias("spans"))
    named = asked.select("row", *on).distinct().join(tests, on).groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    # rows without a candidate have no hits, so only the others, keys and all, are shuffled
    hit = rows.filter(F.size("found") > 0).select("row", "doc_id", "n_words").join(spans.join(named, "row"), "row", "left")
    clear = rows.filter(F.size("found") <= 0).select("row", "doc_id", "n_words")
    return clear.unionByName(hit, allowMissingColumns=True).select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,stop:int>>")).alias("spans"),
    )

"""Exact removal of long repeated substrings by blockwise suffix comparison.

A byte is removed when it lies in a string of ``length`` bytes that also starts
anywhere else.  Comparing all suffixes at once would take many times the text,
so the work is cut twice, as in blockwise suffix sorting with a difference cover.

* **Cover samples.**  A difference cover ``D`` modulo ``v`` has, for any two
  positions, a shift below ``v`` that brings both into ``D``.  Two equal strings
  of ``length`` bytes therefore contain, at one shift, samples of both that
  agree in ``length - v + 1`` bytes.  Only samples (8.8 % of the positions) are
  ranked against the whole corpus: the samples are sorted one hash bucket at a
  time and get the rank "shared" or "alone".
* **Suffix buckets.**  A suffix whose next ``v`` samples are all alone cannot
  tie with another over ``length`` bytes, however long its common prefix with
  others is; it is settled by the ranks and never sorted.  The other suffixes,
  cut to ``length`` bytes, are sorted one bucket at a time; those that tie are
  repeats.

* **Segments.**  Inside a long repeat all suffixes tie.  A few content-defined
  anchors cut the suffixes that are left into segments; a segment whose whole
  string (up to its last suffix's end) occurs again is settled as one tie, and
  only one of its copies sends its suffixes, for others to tie with.  Where the
  anchors fall changes the work, not the result.

Suffixes are ordered by fingerprints of their first bytes (32 bits and the bucket
for samples, where a false match only adds work; 96 bits for suffixes) instead
of alphabetically: a deduplication asks which suffixes are equal, not which is
less.  Every block sends a key once, however often it holds it, so a passage
that a third of all documents share costs one key per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import buckets_for, key_and_text, over_blocks, texts_of, with_answers, write_blocks
from cellweave.llm.rolling import Rolling, mix
from cellweave.session import write_stage

LENGTH = 400
#: Difference cover parameter: 181 is the period and 220 bytes are left for a sample of a 400-byte string.
COVER = 2
#: One position in so many is an anchor; segments of more than LONGEST suffixes are not settled as one.
ANCHOR = 16
LONGEST = 256


def difference_cover(r: int) -> tuple[np.ndarray, int]:
    """The cover of Colbourn and Ling: 6r + 4 residues modulo 24r^2 + 36r + 13."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return np.cumsum([0, *steps]), 24 * r * r + 36 * r + 13


class Block:
    """The documents of one block as one byte array, with where each ends."""

    def __init__(self, table: pa.Table, length: int, cover: int) -> None:
        texts = texts_of(table)
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.length = length
        self.residues, self.period = difference_cover(cover)
        self.sample = length - self.period + 1
        if self.sample < 1:
            raise ValueError(f"length must be at least {self.period} for this cover")
        self.rolling = Rolling(self.data)

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions whose sample lies inside one document, and the sample's hash."""
        n = len(self.data)
        at = (np.arange(0, n, self.period)[:, None] + self.residues[None, :]).ravel()
        at = at[at + self.sample <= n]
        doc = np.searchsorted(self.ends, at, "right")
        at = at[at + self.sample <= self.ends[doc]] if len(at) else at
        return at, self.rolling.of(at, at + self.sample)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of whole strings that contain a shared sample."""
        marks = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(marks, np.maximum(shared - (self.length - self.sample), 0), 1)
        np.add.at(marks, shared + 1, -1)
        at = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
        doc = np.searchsorted(self.ends, at, "right")
        return at[at + self.length <= self.ends[doc]] if len(at) else at

    def keys(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """96-bit keys of the strings between ``start`` and ``stop``."""
        out = np.empty(len(start), dtype=_KEY)
        size = (stop - start).astype(np.uint64)
        out["high"] = mix(self.rolling.of(start, stop) + size)
        out["low"] = (mix(Rolling(self.data, 1).of(start, stop) + size) >> np.uint64(32)).astype(np.uint32)
        return out

    def segments(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``at`` (sorted candidates) of the first suffix of each segment and of the next one's."""
        anchors = np.flatnonzero(self.rolling.of(at, at + min(8, self.length)) % np.uint64(ANCHOR) == 0)
        first, last = anchors[:-1], anchors[1:]
        whole = (at[last] - at[first] == last - first) & (last - first <= LONGEST)
        return first[whole], last[whole]


_KEY = np.dtype([("high", "<u8"), ("low", "<u4")])


def _fold(high: np.ndarray, low: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First of each distinct key in order, whether it occurs again, and each key's place among the distinct."""
    order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
    new = np.ones(len(order), dtype=bool)
    new[1:] = high[order[1:]] != high[order[:-1]]
    if low is not None:
        new[1:] |= low[order[1:]] != low[order[:-1]]
    group = np.cumsum(new) - 1
    place = np.empty(len(order), dtype=np.int64)
    place[order] = group
    return order[new], np.bincount(group, minlength=int(new.sum())) > 1, place


def _asked(block: int, keys: np.ndarray, again: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per bucket for keys in bucket order."""
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else np.zeros(0, dtype=np.int64)
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        yield pa.record_batch(
            {
                "block": pa.array([block], pa.int64()),
                "bucket": pa.array([int(bucket[a])], pa.int32()),
                "keys": pa.array([keys[a:b].tobytes()], pa.binary()),
                "again": pa.array([np.packbits(again[a:b]).tobytes()], pa.binary()),
            }
        )


_ASKED = "block long, bucket int, keys binary, again binary"


def _repeats(kind: np.dtype):
    """Answers one bucket: which keys occur again, and which of their copies is the first.

    An answer holds two bits for each key in the order sent: all "occurs again"
    bits, then all "is the first copy" bits.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parts = [np.frombuffer(x, dtype=kind) for x in table.column("keys").to_pylist()]
        again = [np.unpackbits(np.frombuffer(x, dtype=np.uint8))[: len(p)] for x, p in zip(table.column("again").to_pylist(), parts)]
        keys = np.concatenate(parts)
        first, twice, place = _fold(keys["high"], keys["low"]) if kind.names else _fold(keys)
        np.logical_or.at(twice, place, np.concatenate(again).astype(bool))
        leads = np.zeros(len(keys), dtype=bool)
        leads[first] = True
        out, at = [], 0
        for part in parts:
            own = slice(at, at + len(part))
            out.append(np.packbits(twice[place[own]]).tobytes() + np.packbits(leads[own]).tobytes())
            at += len(part)
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "answer": pa.array(out, pa.binary())})

    return run


def _bits(answers: dict[int, bytes], bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both answers for keys that were sent in the order of ``bucket``."""
    again, leads = [], []
    for number, n in zip(*(x.tolist() for x in np.unique(bucket, return_counts=True))):
        raw = np.frombuffer(answers[number], dtype=np.uint8)
        again.append(np.unpackbits(raw[: len(raw) // 2])[:n])
        leads.append(np.unpackbits(raw[len(raw) // 2 :])[:n])
    none = np.zeros(0, dtype=np.uint8)
    return np.concatenate([none, *again]).astype(bool), np.concatenate([none, *leads]).astype(bool)


class Round:
    """Keys of one block for one question: folded, in bucket order."""

    def __init__(self, keys: np.ndarray, shift: int) -> None:
        wide = keys.dtype.names is not None
        self.first, self.again, self.place = _fold(keys["high"], keys["low"]) if wide else _fold(keys)
        keys = keys[self.first]
        high = keys["high"] if wide else keys
        self.bucket = (high >> np.uint64(shift)).astype(np.int64)
        self.keys = keys if wide else (high >> np.uint64(shift - 32)).astype(np.uint32)

    def asked(self, block: int) -> Iterator[pa.RecordBatch]:
        yield from _asked(block, self.keys, self.again, self.bucket)

    def answered(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For every key as given: does it occur again, and is it the first copy."""
        again, leads = _bits(answers, self.bucket)
        front = np.zeros(len(self.place), dtype=bool)
        front[self.first] = leads
        return again[self.place], front


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, cover: int = COVER) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row.

    ``spans`` are the maximal runs (start, stop) of bytes covered by a string of
    ``length`` bytes that starts more than once in the table, the same document
    included, overlaps too; strings never cross documents.  ``kept`` holds the
    other bytes.  A null text is empty; shorter texts lose nothing; a repeated
    row of at least ``length`` bytes is removed like any copy.  Keys may be null
    or repeated, since rows are told apart by their place.
    """
    rows = key_and_text(docs, id_col, text_col)
    blocks = write_blocks(rows, "blocks")
    density = len(difference_cover(cover)[0]) / difference_cover(cover)[1]
    shift = 64 - (buckets_for(blocks, 4 * density).bit_length() - 1)

    def told(answers: list | None) -> list[dict[int, bytes]]:
        """The answers of each round by bucket."""
        out: list[dict[int, bytes]] = [{}, {}, {}]
        for x in answers or []:
            out[x["bucket"] % 3][x["bucket"] // 3] = x["answer"]
        return out

    def rank(block: Block) -> tuple[np.ndarray, Round]:
        at, hashes = block.samples()
        return at, Round(hashes, shift)

    def segment(block: Block, told: list[dict]) -> tuple:
        at, ranks = rank(block)
        at = block.candidates(at[ranks.answered(told[0])[0]])
        first, last = block.segments(at)
        return at, first, last, Round(block.keys(at[first], at[last] + length), shift)

    def tie(block: Block, told: list[dict]) -> tuple:
        at, first, last, segments = segment(block, told)
        again, leads = segments.answered(told[1])
        settled, sent = np.zeros((2, len(at) + 1), dtype=np.int32)
        for marks, which in ((settled, again), (sent, again & ~leads)):
            np.add.at(marks, first[which], 1)
            np.add.at(marks, last[which], -1)
        settled, open_ = np.cumsum(settled[:-1]) > 0, np.cumsum(sent[:-1]) == 0
        own = at[open_]
        return at[settled], own, Round(block.keys(own, own + length), shift)

    def ask_ranks(number: int, table: pa.Table, _: list | None) -> Iterator[pa.RecordBatch]:
        yield from rank(Block(table, length, cover))[1].asked(number)

    def ask_segments(number: int, table: pa.Table, answers: list | None) -> Iterator[pa.RecordBatch]:
        yield from segment(Block(table, length, cover), told(answers))[3].asked(number)

    def ask_ties(number: int, table: pa.Table, answers: list | None) -> Iterator[pa.RecordBatch]:
        yield from tie(Block(table, length, cover), told(answers))[2].asked(number)

    def cut(number: int, table: pa.Table, answers: list | None) -> Iterator[pa.RecordBatch]:
        block, known = Block(table, length, cover), told(answers)
        settled, own, ties = tie(block, known)
        marks = np.zeros(len(block.data) + 1, dtype=np.int32)
        for hit in (settled, own[ties.answered(known[2])[0]]):
            np.add.at(marks, hit, 1)
            np.add.at(marks, hit + length, -1)
        gone = np.cumsum(marks[:-1]) > 0
        spans, kept = [], []
        for a, b in zip(block.starts.tolist(), block.ends.tolist()):
            own = gone[a:b]
            edge = np.flatnonzero(np.diff(own.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
            spans.append([{"start": s, "stop": e} for s, e in edge.reshape(-1, 2).tolist()])
            kept.append(block.data[a:b][~own].tobytes())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        ids = table.column("doc_id").combine_chunks()
        yield pa.record_batch(
            {"doc_id": ids, "n_bytes": pa.array(block.ends - block.starts, pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())}
        )

    answers = None
    for label, ask, kind in (("ranks", ask_ranks, np.dtype("<u4")), ("segments", ask_segments, _KEY), ("ties", ask_ties, _KEY)):
        number = {"ranks": 0, "segments": 1, "ties": 2}[label]
        asked = (blocks if answers is None else with_answers(blocks, answers)).mapInArrow(over_blocks(ask), _ASKED)
        found = asked.groupBy("bucket").applyInArrow(_repeats(kind), "block long, bucket int, answer binary")
        found = write_stage(found.withColumn("bucket", F.col("bucket").cast("long") * 3 + number), label)
        answers = found if answers is None else answers.unionAll(found)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return with_answers(blocks, answers).mapInArrow(over_blocks(cut), f"doc_id {kind}, n_bytes long, spans array<struct<start:long, stop:long>>, kept binary")

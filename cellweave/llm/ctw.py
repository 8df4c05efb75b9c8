"""Context-tree weighting over bytes, trained and applied block by block.

The next byte is coded bit by bit: each of the 255 nodes of the binary
decomposition of a byte is a source of its own, with a context tree over the
preceding bytes.  At every context, Krichevsky-Trofimov estimates ``Pe`` from
the training counts and the weighted product of the deeper contexts are mixed
half and half, which gives each node on the path a posterior weight

    weight = (Pe / 2) / Pw,   Pw = Pe / 2 + (product of the children's Pw) / 2,

so a bit's probability is a mixture of the estimates of all depths.  A context
that the training text does not have leaves its weight to the depth above.  Texts
are lower-cased (A-Z) and end in a byte that UTF-8 does not use, so the
probabilities of all texts sum to one at most.

What is counted are distinct (context, byte) pairs.  A block of documents sends
each of its pairs once with its training count; pairs that share their last two
context bytes meet in one task, which builds that part of the tree.  The two
depths above need the sums of 65,280 nodes at most (256 contexts of 255 nodes),
which go to the driver and out again.  Word counts for the base score take the
same way.  So nothing that grows with the text is gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import buckets_for, over_blocks, texts_of, with_answers, write_blocks
from cellweave.llm.rolling import Rolling, distinct, grouped, mix
from cellweave.session import write_stage

#: Context bytes; at most 6, so that a pair and a document's number in a chunk fit 64 bits.
DEPTH = 5
#: Code lengths travel as whole multiples of 1/256 bit (at most 256 bits), rounded up, which keeps them code lengths.
GRAIN = 256
END = 0xFF
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _shut(array: np.ndarray) -> bytes:
    return zstandard.compress(array.tobytes(), 1)


def _open(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype=kind)


def _close_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences, byte by byte in columns, which compresses well."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _open_sorted(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def _counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with how often each occurs in training documents."""
    sorted_ = np.sort(keys[train])
    first = np.flatnonzero(np.diff(sorted_, prepend=~sorted_[:1]) != 0) if len(sorted_) else np.zeros(0, dtype=np.int64)
    known, times = sorted_[first], np.diff(first, append=len(sorted_))
    every = distinct(np.concatenate([known, distinct(keys[~train])]))
    counts = np.zeros(len(every), dtype=np.uint32)
    counts[np.searchsorted(every, known)] = times
    return every, counts


class Texts:
    """The documents of a block, as byte pairs and as words."""

    def __init__(self, table: pa.Table, depth: int) -> None:
        texts = [t.lower() for t in texts_of(table)]
        self.train = ~np.asarray(table.column("held_out").to_numpy(), dtype=bool)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        pad = bytes(depth)
        self.data = np.frombuffer(b"".join([x for t in texts for x in (pad, t, b"\xff")]), dtype=np.uint8)
        self.depth = depth
        self.stop = np.cumsum(sizes + depth + 1)
        self.start = self.stop - sizes - 1

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Key of every byte with its context, latest context byte first; and its document."""
        data, depth = self.data.astype(np.uint64), self.depth
        keys = data.copy()
        for back in range(1, depth + 1):
            keys[back:] |= data[:-back] << np.uint64(8 * (depth + 1 - back))
        coded = np.ones(len(data), dtype=bool)
        for back in range(1, depth + 1):
            coded[self.start - back] = False
        return keys[coded], np.repeat(np.arange(len(self.stop)), self.stop - self.start)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and document of every word."""
        inside = ~_SPACE[self.data]
        edge = np.ones(len(self.data), dtype=bool)
        for back in range(1, self.depth + 1):
            edge[self.start - back] = False
        edge[self.stop - 1] = False
        turn = np.diff((inside & edge).astype(np.int8), prepend=np.int8(0), append=np.int8(0))
        first, last = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        return Rolling(self.data).of(first, last), np.searchsorted(self.stop, first, "right")


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 1/2, by Stirling's series eight steps up."""
    down = np.ones_like(x)
    for k in range(8):
        down *= x + k
    y = x + 8
    series = (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(down)


def kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of so many zeros and ones in any order under the Krichevsky-Trofimov estimate."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1.0)


def _groups(keys: np.ndarray) -> np.ndarray:
    """Number of each run of equal keys."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.cumsum(new) - 1


def _weighted(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """log Pw of nodes, and the weight of their own estimate; ``below`` is the children's log Pw."""
    own = kt_log(zeros, ones)
    if below is None:
        return own, np.ones_like(own)
    both = np.logaddexp(own, below) - np.log(2)
    return both, np.exp(own - np.log(2) - both)


class Subtree:
    """Contexts from ``top`` bytes down to the full depth, for pairs that share a task.

    ``mixed[b]`` is the probability of each pair's bit ``b`` mixed over depths
    ``top`` and deeper, ``seen[b]`` whether the node at depth ``top`` has counts.
    """

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, depth: int, top: int = 2) -> None:
        counts = counts.astype(np.float64)
        self.mixed = np.full((8, len(pairs)), 0.5)
        self.seen = np.zeros((8, len(pairs)), dtype=bool)
        self.nodes: list[tuple] = []
        byte = (pairs & np.uint64(0xFF)).astype(np.int64)
        orders = {at: np.argsort((pairs >> np.uint64(8 * (depth + 1 - at))) << np.uint64(8) | (pairs & np.uint64(0xFF)), kind="stable") for at in range(top, depth)}
        for bit in range(8):
            one = (byte >> (7 - bit)) & 1
            prefix = (byte >> (8 - bit)).astype(np.uint64)
            below = group_below = None
            for at in range(depth, top - 1, -1):
                context = (pairs >> np.uint64(8 * (depth + 1 - at))) << np.uint64(8)
                node = context | prefix
                if at == depth:
                    group = _groups(node)
                else:
                    group = np.empty(len(node), dtype=np.int64)
                    group[orders[at]] = _groups(node[orders[at]])
                size = int(group.max()) + 1 if len(group) else 0
                ones = np.bincount(group, counts * one, size)
                zeros = np.bincount(group, counts * (1 - one), size)
                if below is not None:
                    parent = np.zeros(len(below), dtype=np.int64)
                    parent[group_below] = group
                    below = np.bincount(parent, below, size)
                weighted, weight = _weighted(zeros, ones, below)
                total = (zeros + ones)[group]
                own = np.where(one == 1, ones[group], zeros[group]) + 0.5
                own /= total + 1
                deeper = np.where(self.seen[bit], self.mixed[bit], own)
                w = weight[group]
                self.mixed[bit] = np.where(total > 0, w * own + (1 - w) * deeper, 0.5)
                self.seen[bit] = total > 0
                below, group_below = weighted, group
            if len(pairs):
                last = np.zeros(len(below), dtype=np.uint64)
                last[group_below] = ((pairs >> np.uint64(8 * depth)) << np.uint64(8)) | np.uint64(1 << bit) | prefix
                keys, merged = grouped(last)
                self.nodes.append(tuple([keys, *(np.bincount(merged, x, len(keys)) for x in (zeros, ones, below))]))

    def tops(self) -> np.ndarray:
        """(first context byte, node, zeros, ones, sum of log Pw) for the depths above."""
        kind = [("context", "u1"), ("node", "u1"), ("zeros", "f8"), ("ones", "f8"), ("below", "f8")]
        out = np.zeros(sum(len(n[0]) for n in self.nodes), dtype=kind)
        at = 0
        for keys, zeros, ones, below in self.nodes:
            part = out[at : at + len(keys)]
            part["context"], part["node"] = keys >> np.uint64(8), keys & np.uint64(0xFF)
            part["zeros"], part["ones"], part["below"] = zeros, ones, below
            at += len(keys)
        return out


class Top:
    """Depths 0 and 1: arrays over (context byte, node)."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> None:
        shape = (256, 256)
        zeros, ones, below = (x.reshape(shape) for x in (zeros, ones, below))
        self.total1 = zeros + ones
        weighted, self.weight1 = _weighted(zeros, ones, below)
        self.one1 = (ones + 0.5) / (self.total1 + 1)
        zeros0, ones0 = zeros.sum(0), ones.sum(0)
        self.total0 = zeros0 + ones0
        _, self.weight0 = _weighted(zeros0, ones0, weighted.sum(0))
        self.one0 = (ones0 + 0.5) / (self.total0 + 1)

    def log10(self, pairs: np.ndarray, mixed: np.ndarray, seen: np.ndarray, depth: int) -> np.ndarray:
        """log10 probability of each pair's byte after its context."""
        byte = (pairs & np.uint64(0xFF)).astype(np.int64)
        context = (pairs >> np.uint64(8 * depth)).astype(np.int64)
        out = np.zeros(len(pairs))
        for bit in range(8):
            node = (1 << bit) | (byte >> (8 - bit))
            one = (byte >> (7 - bit)) & 1
            own1 = np.where(one == 1, self.one1[context, node], 1 - self.one1[context, node])
            own0 = np.where(one == 1, self.one0[node], 1 - self.one0[node])
            w1, w0 = self.weight1[context, node], self.weight0[node]
            p = np.where(seen[bit], w1 * own1 + (1 - w1) * mixed[bit], own1)
            p = np.where(self.total1[context, node] > 0, w0 * own0 + (1 - w0) * p, own0)
            out += np.log10(np.where(self.total0[node] > 0, p, 0.5))
        return out


def _bucket_rows(block: int, offset: int, bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(bucket, kind="stable")
    numbers, first = np.unique(bucket[order], return_index=True)
    for number, own in zip(numbers.tolist(), np.split(order, first[1:]) if len(numbers) else []):
        yield pa.record_batch(
            {
                "block": pa.array([block], pa.int64()), "bucket": pa.array([offset + number], pa.int32()),
                "keys": pa.array([_close_sorted(keys[own])], pa.binary()), "counts": pa.array([_shut(counts[own].astype("<u4"))], pa.binary()),
            }
        )


_ASKED = "block long, bucket int, keys binary, counts binary"
_TOLD = "block long, bucket int, answer binary"


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    parts = [_open_sorted(k) for k in table.column("keys").to_pylist()]
    keys = distinct(np.concatenate(parts))
    counts = np.zeros(len(keys))
    for part, own in zip(parts, table.column("counts").to_pylist()):
        counts[np.searchsorted(keys, part)] += _open(own, "<u4")
    return keys, counts, parts


def _per_document(pairs: np.ndarray, doc: np.ndarray, keys: np.ndarray, cost: np.ndarray, size: int) -> np.ndarray:
    """Sum of the costs of each document's pairs, 256 documents at a time.

    A pair and its document's number are sorted as one integer, so that each
    distinct pair is looked up once and no inverse is kept.
    """
    out = np.zeros(size)
    cuts = np.searchsorted(doc, np.arange(0, size + 256, 256))
    for at, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        both = np.sort((pairs[a:b] << np.uint64(8)) | (doc[a:b] - 256 * at).astype(np.uint64))
        own = both >> np.uint64(8)
        first = np.flatnonzero(np.diff(own, prepend=~own[:1]) != 0) if len(own) else np.zeros(0, dtype=np.int64)
        values = np.repeat(cost[np.searchsorted(keys, own[first])], np.diff(first, append=len(own)))
        sums = np.bincount((both & np.uint64(0xFF)).astype(np.int64), values, 256)
        out[256 * at : 256 * at + 256] = sums[: size - 256 * at]
    return out


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """Score every text under a model of the texts where ``held_out`` is false.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probability of the lower-cased text and its end) and bits_per_byte, the
    code length per byte (the end counts as one).  A null text is empty: its score
    is that of the end alone.  A null ``held_out`` counts as held out.  Without
    training texts every bit costs one bit.  Keys may be null or repeated.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6")
    flag = docs.select(F.coalesce(held_out, F.lit(True)).alias("held_out"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = write_blocks(flag, "blocks", 4 << 20)
    n = buckets_for(blocks, 1.0)

    def pair_bucket(pairs: np.ndarray) -> np.ndarray:
        return (mix(pairs >> np.uint64(8 * (depth - 1))) % np.uint64(n)).astype(np.int64)

    def pairs_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        pairs, doc = texts.pairs()
        return _counted(pairs, texts.train[doc])

    def ask_pairs(block: int, table: pa.Table, _: list | None) -> Iterator[pa.RecordBatch]:
        pairs, counts = pairs_of(Texts(table, depth))
        yield from _bucket_rows(block, 0, pair_bucket(pairs), pairs, counts)

    def ask_all(block: int, table: pa.Table, _: list | None) -> Iterator[pa.RecordBatch]:
        texts = Texts(table, depth)
        yield from ask_pairs(block, table, None)
        words, doc = texts.words()
        keys, counts = _counted(words, texts.train[doc])
        yield from _bucket_rows(block, n, (keys % np.uint64(n)).astype(np.int64), keys, counts)

    def build(table: pa.Table) -> pa.Table:
        """A bucket of pairs becomes part of the tree; a bucket of words is answered at once."""
        bucket = table.column("bucket")[0].as_py()
        keys, counts, parts = _merged(table)
        if bucket >= n:
            told = [_shut(counts[np.searchsorted(keys, p)].astype("<u8")) for p in parts]
            own = np.array([np.count_nonzero(counts), counts.sum()], dtype="<f8").tobytes()
            return pa.table({"block": [*table.column("block").to_pylist(), -1], "bucket": pa.array([bucket] * (len(parts) + 1), pa.int32()), "answer": pa.array([*told, own], pa.binary())})
        tree = Subtree(keys, counts, depth)
        model = _close_sorted(keys), _shut(tree.mixed.astype("<f4")), _shut(np.packbits(tree.seen)), _shut(tree.tops())
        return pa.table({"block": pa.array([-2, -3, -4, -5], pa.int64()), "bucket": pa.array([bucket] * 4, pa.int32()), "answer": pa.array(model, pa.binary())})

    told = write_stage(blocks.mapInArrow(over_blocks(ask_all), _ASKED).groupBy("bucket").applyInArrow(build, _TOLD), "ctw")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype([("context", "u1"), ("node", "u1"), ("zeros", "f8"), ("ones", "f8"), ("below", "f8")])
        for batch in batches:
            for data in batch.column("answer").to_pylist():
                x = np.frombuffer(zstandard.decompress(data), dtype=kind)
                place = x["context"].astype(np.int32) * 256 + x["node"]
                yield pa.record_batch({"place": place, "zeros": x["zeros"].copy(), "ones": x["ones"].copy(), "below": x["below"].copy()})

    sums = told.filter("block = -5").select("answer").mapInArrow(spread, "place int, zeros double, ones double, below double")
    sums = sums.groupBy("place").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).toPandas()
    flat = np.zeros((3, 65536))
    flat[:, sums["place"].to_numpy(dtype=np.int64)] = sums[["zeros", "ones", "below"]].to_numpy(dtype=float).T
    top = docs.sparkSession.sparkContext.broadcast(Top(*flat))

    def per_bucket(asked: pa.Table, model: pa.Table) -> pa.Table:
        part = {k: a for k, a in zip(model.column("block").to_pylist(), model.column("answer").to_pylist())}
        keys = _open_sorted(part[-2])
        mixed = _open(part[-3], "<f4").reshape(8, -1)
        seen = np.unpackbits(_open(part[-4], "u1"))[: 8 * len(keys)].reshape(8, -1).astype(bool)
        bits = -top.value.log10(keys, mixed, seen, depth) / np.log10(2.0)
        cost = np.minimum(np.ceil(bits * GRAIN), 0xFFFF).astype("<u2")
        out = [_shut(cost[np.searchsorted(keys, _open_sorted(k))]) for k in asked.column("keys").to_pylist()]
        return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"), "answer": pa.array(out, pa.binary())})

    asked = blocks.mapInArrow(over_blocks(ask_pairs), _ASKED).groupBy("bucket")
    costs = asked.cogroup(told.filter("block between -4 and -2").groupBy("bucket")).applyInArrow(per_bucket, _TOLD)
    answers = told.filter("block >= 0").unionAll(costs)

    def answer_for(keys: np.ndarray, bucket: np.ndarray, given: dict[int, bytes], offset: int, kind: str) -> np.ndarray:
        """Each distinct key's answer."""
        out = np.zeros(len(keys))
        order = np.argsort(bucket, kind="stable")
        numbers, first = np.unique(bucket[order], return_index=True)
        for number, own in zip(numbers.tolist(), np.split(order, first[1:]) if len(numbers) else []):
            out[own] = _open(given[offset + number], kind)
        return out

    def summed(values: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(doc, values, size).astype(float)  # of nothing it counts integers

    def finish(block: int, table: pa.Table, answers: list | None) -> Iterator[pa.RecordBatch]:
        texts = Texts(table, depth)
        given = {x["bucket"]: x["answer"] for x in answers or []}
        size = len(texts.stop)
        pairs, doc = texts.pairs()
        keys = distinct(pairs)
        cost = answer_for(keys, pair_bucket(keys), given, 0, "<u2") / GRAIN
        scores = -np.log10(2.0) * _per_document(pairs, doc, keys, cost, size)
        words, doc = texts.words()
        keys, place = grouped(words)
        seen = answer_for(keys, (keys % np.uint64(n)).astype(np.int64), given, n, "<u8")[place]
        yield pa.record_batch(
            {
                "doc_id": table.column("doc_id").combine_chunks(), "held_out": pa.array(~texts.train),
                "n_tokens": pa.array(np.bincount(doc, minlength=size) + 1, pa.int64()), "n_known": pa.array(summed(seen > 0, doc, size).astype(np.int64)),
                "logs": pa.array(summed(np.log10(seen + 1), doc, size)), "score": pa.array(scores),
                "n_coded": pa.array((texts.stop - texts.start).astype(np.int64)),
            }
        )

    kind = flag.schema["doc_id"].dataType.simpleString()
    scored = with_answers(blocks, answers).mapInArrow(
        over_blocks(finish), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, score double, n_coded long"
    )
    ends = flag.filter("not held_out").count()
    totals = np.zeros(2)
    for row in told.filter("block = -1").select("answer").toLocalIterator():
        totals += np.frombuffer(row["answer"], dtype="<f8")
    vocabulary, running = int(totals[0]) + (ends > 0), int(totals[1]) + ends
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.lit(int(ends > 0))).alias("n_known"), F.lit(running).cast("long").alias("train_tokens"),
        (F.col("logs") + F.log10(F.lit(float(ends + 1))) - F.col("n_tokens") * F.log10(F.lit(float(running + vocabulary + 1)))).alias("base_score"),
        "score", (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_coded")).alias("bits_per_byte"),
    )

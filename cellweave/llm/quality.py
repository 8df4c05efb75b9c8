"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

Random cosine features approximate a Gaussian kernel over standardised
statistics of a text.  Ridge regression on them needs only the sums of products
of features, which every task adds up for itself before they are combined; so
the fit sees every labelled row and moves a matrix of fixed size.  A monotone
step function, fitted by pooling adjacent violators over score bins, turns the
raw score into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import key_and_text, small_batches, texts_of
from cellweave.session import write_stage

FEATURES, RIDGE, BINS = 256, 1.0, 2000
_SENTENCE = re.compile(rb"[.!?]")


def statistics(text: bytes) -> list[float]:
    """Statistics of one whole text; all zero but the last for an empty one."""
    raw = np.frombuffer(text, dtype=np.uint8)
    n = max(1, len(raw))
    count = np.bincount(raw, minlength=256)
    words, lines = text.split(), text.split(b"\n")
    m = max(1, len(words))
    lower, upper, digit = count[97:123].sum(), count[65:91].sum(), count[48:58].sum()
    ends = Counter(w[-1] for w in words)
    share = count[count > 0] / n
    symbols = sum(ends.get(s, 0) for s in b"#$%&*|!=~^+<>")
    alone = sum(1 for w in words if len(w) == 1 and not w.isalnum())
    full = [line for line in lines if line.strip()]
    return [
        float(np.log1p(len(words))), lower / n, upper / n, digit / n, count[128:].sum() / n, (count[32] + count[10]) / n,
        (count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()) / n, count[44] / n, count[46] / n, count[33] / n, count[124] / n,
        (count[35] + count[36] + count[37] + count[38] + count[42]) / n, sum(map(len, words)) / m / 10, len(set(words)) / m, symbols / m, alone / m,
        len(set(full)) / max(1, len(full)), float(np.log1p(len(words) / max(1, len(full)))), float(np.log1p(m / (1 + len(_SENTENCE.findall(text))))),
        float(-(share * np.log(share)).sum()), sum(w[:1].isupper() for w in words) / m, float(not words),
    ]


WIDTH = len(statistics(b""))


def _with_statistics(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "x": pa.array([statistics(t) for t in texts_of(batch)], pa.list_(pa.float64()))})

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>")


class Fourier:
    """Cosine features of a Gaussian kernel; drawn by a fixed seed, with a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES) -> None:
        draw = np.random.default_rng(11)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.w = draw.normal(size=(len(mean), features)) * (0.5 / np.sqrt(len(mean)) * 2)
        self.b = draw.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.hstack([np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])


def _rows_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, WIDTH)


def fit_ridge(train: DataFrame, fourier: Fourier, ridge: float = RIDGE) -> np.ndarray:
    """Weights from the normal equations; every task sends one triangle of sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FEATURES + 2
        total = np.zeros((size, size))
        for batch in batches:
            z = np.hstack([fourier(_rows_of(batch)), batch.column("label").to_numpy().astype(float)[:, None]])
            total += z.T @ z
        i, j = np.triu_indices(size)
        yield pa.record_batch({"cell": pa.array(i * size + j, pa.int64()), "v": pa.array(total[i, j])})

    size = FEATURES + 2
    sums = train.select("x", "label").mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
    full = np.zeros(size * size)
    full[sums["cell"].to_numpy(dtype=np.int64)] = sums["v"].to_numpy()
    full = full.reshape(size, size)
    full = full + np.triu(full, 1).T
    penalty = ridge * np.eye(size - 1)
    penalty[-1, -1] = 1e-9
    return np.linalg.solve(full[:-1, :-1] + penalty, full[:-1, -1])


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing sequence in weighted least squares."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def quality(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, score) of every row of ``docs``, from the whole text alone.

    Labels are learned from rows where ``learn`` (over ``doc_id``) is true.  Null
    texts are empty texts.  When those labels lack one of the two classes the
    score is the share of label 1 (0.5 without any).  A label given twice counts
    by its largest value; repeated rows come back repeated.
    """
    rows = write_stage(_with_statistics(key_and_text(docs, id_col, text_col)), "statistics")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).filter(learn)
    train = write_stage(rows.join(known, "doc_id").select("x", "label"), "training")
    n, good = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < good < n:
        return rows.select("doc_id", F.lit(good / n if n else 0.5).alias("score"))
    moments = rows.agg(*[F.avg(F.col("x")[i]) for i in range(WIDTH)], *[F.stddev_pop(F.col("x")[i]) for i in range(WIDTH)]).first()
    fourier = Fourier(np.array(moments[:WIDTH]), np.array(moments[WIDTH:]))
    weights = fit_ridge(train, fourier)

    def raw(batch: pa.RecordBatch) -> np.ndarray:
        return np.clip(fourier(_rows_of(batch)) @ weights, -0.5, 1.5)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"bin": pa.array(np.rint((raw(batch) + 0.5) / 2 * BINS).astype(np.int64)), "label": batch.column("label")})

    bins = train.mapInArrow(binned, "bin long, label int").groupBy("bin").agg(F.avg("label").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("bin").toPandas()
    steps = pool_adjacent(bins["y"].to_numpy(dtype=float), bins["n"].to_numpy(dtype=float))
    places = bins["bin"].to_numpy(dtype=float)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = (raw(batch) + 0.5) / 2 * BINS
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(np.interp(place, places, steps))})

    return rows.mapInArrow(scored, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")

"""The fits of the quality and toxicity scores: direct solutions, one class, no labels, empty tables, odd rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellweave.llm import quality, toxicity

SCHEMA = "doc_id long, text string, score double, label string, row int"


@pytest.fixture(scope="module")
def docs(spark):
    good = "The committee met on Tuesday and agreed that the harbour should be repaired before winter. "
    bad = "!!! $$$ WIN 777 click>>> ### 000 @@@ "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 5), 0.1, "x", 1) for i in range(60)]
    rows += [(100, None, 0.1, "x", 1), (101, "", 0.1, "x", 1), (1, rows[1][1], 0.1, "x", 1), (None, good, 0.1, "x", 1), (102, good * 2000, 0.1, "x", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def labels(spark, pairs, name):
    return spark.createDataFrame(pairs, f"doc_id long, {name} int")


def test_ridge_is_the_direct_solution(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(40, quality.WIDTH)), rng.integers(0, 2, 40)
    fourier = quality.Fourier(x.mean(axis=0), x.std(axis=0))
    train = spark.createDataFrame(pd.DataFrame({"x": list(map(list, x)), "label": y}), "x array<double>, label int").repartition(3)
    z = fourier(x)
    penalty = np.diag([quality.RIDGE] * (z.shape[1] - 1) + [1e-9])
    want = np.linalg.solve(z.T @ z + penalty, z.T @ y)
    assert np.allclose(fourier(x) @ quality.fit_ridge(train, fourier), z @ want, atol=1e-6)


def test_isotonic_is_the_best_monotone_sequence():
    rng = np.random.default_rng(6)
    for _ in range(50):
        v, w = rng.integers(0, 5, 6).astype(float), rng.integers(1, 4, 6).astype(float)
        # the max-min formula of isotonic regression
        mean = lambda i, j: np.average(v[i : j + 1], weights=w[i : j + 1])
        want = [max(min(mean(i, j) for j in range(k, 6)) for i in range(k + 1)) for k in range(6)]
        assert np.allclose(quality.pool_adjacent(v, w), want)
    assert len(quality.pool_adjacent(np.zeros(0), np.zeros(0))) == 0


def test_quality_tells_classes_apart(spark, docs):
    known = labels(spark, [(i, i % 2) for i in range(40)] + [(3, 0), (99, 1), (100, None)], "quality")
    got = quality.quality(docs, known, F.col("doc_id") < 30).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    held = {r.doc_id: r.score for r in got if r.doc_id is not None and 30 <= r.doc_id < 60}
    assert all((s >= 0.5) == bool(i % 2) for i, s in held.items())


@pytest.mark.parametrize("operator, name, none", [(quality.quality, "quality", 0.5), (toxicity.toxicity, "toxic", 0.0)])
def test_missing_classes_and_tables(spark, docs, operator, name, none):
    score = lambda pairs: {r.score for r in operator(docs, labels(spark, pairs, name), F.lit(True)).collect()}
    assert score([]) == score([(999, 1)]) == {none}
    assert score([(1, 1), (3, 1)]) == {1.0} and score([(1, 0)]) == {0.0}
    assert operator(docs.filter("false"), labels(spark, [(1, 1), (2, 0)], name), F.lit(True)).count() == 0


def test_toxicity_finds_hidden_words(spark):
    plain = ["you are kind and the day is bright", "the train leaves the station at noon", "we read a long book about the sea"]
    rude = ["you are an idiot and a moron", "what an idiot he is", "such a moron he is", "go away you idiot moron"]
    rows = [(i, plain[i % 3]) for i in range(0, 60)] + [(100 + i, rude[i % 4]) for i in range(40)]
    hidden = [(500, "you 1d10t"), (501, "what a m.o.r.o.n"), (502, "i d i o t he is"), (503, "iddiiot"), (504, "a kind day at the sea"), (505, None), (506, "")]
    docs = spark.createDataFrame(rows + hidden, "doc_id long, text string")
    known = labels(spark, [(k, int(k >= 100)) for k, _ in rows], "toxic")
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, known, F.col("doc_id") < 500).collect()}
    assert all(got[k] >= 0.5 for k in (500, 501, 502, 503)) and all(got[k] < 0.5 for k in (504, 505, 506))

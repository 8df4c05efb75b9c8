import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellweave.functions.probability import t_two_sided
from cellweave.operators import align, concat, filters, markers, normalize, qc, ranking, variable


def dense(x, obs, var):
    cells = sorted(r.cell_id for r in obs.collect())
    genes = sorted(r.gene for r in var.collect())
    frame = x.toPandas().pivot(index="cell_id", columns="gene", values="value").reindex(index=cells, columns=genes).fillna(0.0)
    return cells, genes, frame.to_numpy()


def test_cell_metrics_keep_empty_cells(tiny):
    x, obs, _ = tiny
    got = {r.cell_id: (r.n_genes_by_counts, r.total_counts) for r in qc.cell_metrics(x, obs).collect()}
    assert got["c5"] == (0, 0.0) and got["c3"] == (3, 13.0)


def test_mt_share_is_null_without_counts(tiny):
    x, obs, var = tiny
    flagged = var.withColumn("mt", qc.mt_flag("gene_name"))
    got = {r.cell_id: r.pct_counts_mt for r in qc.subset_share(x, obs, flagged, "mt", "mt").collect()}
    assert got["c5"] is None and got["c4"] == pytest.approx(100.0) and got["c2"] == pytest.approx(100 * 5 / 7)
    assert {r.gene for r in var.where(qc.mt_flag("gene_name", any_case=False)).collect()} == {"g1"}


def test_gene_metrics_keep_empty_genes(tiny):
    x, obs, var = tiny
    got = {r.gene: r for r in qc.gene_metrics(x, obs, var).collect()}
    assert got["g6"].n_cells_by_counts == 0 and got["g6"].pct_dropout_by_counts == 100.0
    assert got["g1"].mean_counts == pytest.approx(13 / 5)


def test_block_median_counts_zeros(tiny):
    x, obs, var = tiny
    row = qc.dense_median_mean(x, obs, var.where("gene = 'g1'")).first()
    assert row.median_value == 2.0 and row.mean_value == pytest.approx(13 / 5) and row.n_entries == 5


def test_filter_order_matters(tiny):
    x, _, _ = tiny
    first = filters.keep_cells(filters.keep_genes(x, min_cells=2), min_counts=5)
    other = filters.keep_genes(filters.keep_cells(x, min_counts=5), min_cells=2)
    assert {r.cell_id for r in first.collect()} == {"c1", "c2"}
    assert {r.cell_id for r in other.collect()} == {"c1", "c2", "c3"}


def test_group_moments_fill_absent_pairs(tiny):
    x, obs, var = tiny
    rows = {(r.gene, r.label): r for r in qc.group_moments(x, obs, "label", var).collect()}
    assert len(rows) == 12
    assert rows[("g4", "a")].s1 == 0 and rows[("g4", "b")].s2 == 81.0 and rows[("g6", "a")].n == 2


def test_normalize_and_q3(spark, both_ways, tiny):
    x, obs, var = tiny
    sums = normalize.normalize_total(x, 100).groupBy("cell_id").agg(F.sum("norm").alias("s")).collect()
    assert all(r.s == pytest.approx(100) for r in sums)
    cells, genes, m = dense(x, obs, var)
    q3 = np.percentile(m, 75, axis=1)
    q3[q3 == 0] = 1
    scale = np.exp(np.log(q3).mean())
    got = {(r.cell_id, r.gene): r.q3_norm for r in normalize.q3_normalize(x, obs, var).collect()}
    for (cell, gene), value in got.items():
        i, j = cells.index(cell), genes.index(gene)
        assert value == pytest.approx(m[i, j] / q3[i] * scale)


def test_zscale_is_folded_but_whole(tiny):
    x, obs, var = tiny
    cells, genes, m = dense(x, obs, var)
    z = (m - m.mean(axis=0)) / m.std(axis=0, ddof=1)
    for r in normalize.zscale(x, obs, clip=1.5).collect():
        i, j = cells.index(r.cell_id), genes.index(r.gene)
        assert r.z == pytest.approx(np.clip(z[i, j], -1.5, 1.5))
        assert r.z_zero == pytest.approx(np.clip((0 - m[:, j].mean()) / m[:, j].std(ddof=1), -1.5, 1.5))


def test_dispersion_rule(spark):
    rng = np.random.default_rng(3)
    m = rng.poisson(rng.gamma(1, 2, 60), (40, 60)).astype(float)
    x = spark.createDataFrame(
        [(i, j, math.log1p(m[i, j])) for i in range(40) for j in range(60) if m[i, j]], "cell_id long, gene long, value double"
    )
    obs, var = spark.range(40).toDF("cell_id"), spark.range(60).toDF("gene")
    mean, v = m.mean(axis=0), m.var(axis=0, ddof=1)
    frame = pd.DataFrame({"mean": np.log1p(np.where(mean == 0, 1e-12, mean))})
    with np.errstate(all="ignore"):
        d = v / np.where(mean == 0, 1e-12, mean)
        frame["disp"] = np.where(d > 0, np.log(d), np.nan)
    frame["bin"] = pd.cut(frame["mean"], 20, labels=False)
    stats = frame.groupby("bin")["disp"].agg(["mean", "std"])
    alone = stats["std"].isna()
    stats.loc[alone, "std"] = stats.loc[alone, "mean"]
    stats.loc[alone, "mean"] = 0
    want = (frame["disp"] - frame["bin"].map(stats["mean"])) / frame["bin"].map(stats["std"])
    got = {r.gene: r for r in variable.dispersion_genes(x, obs, var, 10).collect()}
    for j in range(60):
        assert (got[j].dispersion_norm is None) == bool(np.isnan(want[j]))
        if not np.isnan(want[j]):
            assert got[j].dispersion_norm == pytest.approx(want[j])
    cut = np.sort(want.dropna())[::-1][9]
    assert {j for j in got if got[j].highly_variable} == set(np.flatnonzero(want >= cut - 1e-9))


def _avg_rank(values):
    return pd.Series(values).rank(method="average").to_numpy()


@pytest.mark.parametrize("reference", [None, "b"])
def test_rank_sum_against_dense_ranks(spark, both_ways, reference):
    rng = np.random.default_rng(4)
    n, genes = 60, 8
    m = rng.poisson(0.7, (n, genes)).astype(float)
    m[:, 0] = rng.integers(1, 4, n)
    m[:, 7] = 0
    labels = np.array(["a", "b", "c"])[rng.integers(0, 3, n)]
    x = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(n) for j in range(genes) if m[i, j]], "cell_id long, gene long, value double")
    obs = spark.createDataFrame([(i, str(labels[i])) for i in range(n)], "cell_id long, label string")
    got = {(r.gene, r.label): r.score for r in markers.rank_sum(x, obs, "label", reference, spark.range(genes).toDF("gene")).collect()}
    for g in sorted(set(labels) - {reference}):
        keep = np.ones(n, bool) if reference is None else np.isin(labels, [g, reference])
        mine = labels[keep] == g
        n1, total = mine.sum(), keep.sum()
        for j in range(genes):
            r = _avg_rank(m[keep, j])[mine].sum()
            want = (r - n1 * (total + 1) / 2) / math.sqrt(n1 * (total - n1) * (total + 1) / 12)
            assert got[(j, g)] == pytest.approx(want, abs=1e-9)


def test_welch_and_p_values(spark, tiny):
    x, obs, var = tiny
    rows = markers.welch_tests(x, obs, "label", var).collect()
    cells, genes, m = dense(x, obs, var)
    for r in rows:
        own = [cells.index(c) for c in (("c1", "c2") if r.label == "a" else ("c3", "c4"))]
        rest = [cells.index(c) for c in (("c3", "c4") if r.label == "a" else ("c1", "c2"))]
        a, b = m[own, genes.index(r.gene)], m[rest, genes.index(r.gene)]
        se = math.sqrt(a.var(ddof=1) / 2 + b.var(ddof=1) / 2)
        assert r.score == pytest.approx((a.mean() - b.mean()) / se if se else 0.0)
        assert 0 <= r.p <= r.p_adj <= 1
    # Known two-sided probabilities of Student's t.
    want = [1.0, 0.5, 0.0733880348, 0.00136582]
    got = t_two_sided(np.array([0.0, 1.0, 2.0, 3.3]), np.array([3.0, 1.0, 10.0, 100.0]))
    assert got[:3] == pytest.approx(want[:3], rel=1e-6) and got[3] == pytest.approx(want[3], rel=2e-2)


def test_unique_names(spark, both_ways):
    df = spark.createDataFrame([(i, n) for i, n in enumerate("ABABAC")], "pos long, name string")
    got = [r.unique_name for r in ranking.unique_names(df, "name", "pos").orderBy("pos").collect()]
    assert got == ["A", "B", "A-1", "B-1", "A-2", "C"]


def test_one_to_one_join_rejects_duplicates(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, w int")
    assert align.left_join_one_to_one(left, right.limit(1), ["k"]).count() == 2
    with pytest.raises(Exception, match="duplicate key"):
        align.left_join_one_to_one(left, right, ["k"]).collect()


def test_lookup_keeps_the_first_row(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("b", 9, 4)], "k string, v int, pos int")
    got = {r.k: r.m__v for r in align.prefixed_lookup(df.withColumn("Unnamed: 0", F.lit(0)), "k", "m", "pos").collect()}
    assert got == {"a": 2, "b": 9}


def test_too_few_genes_is_an_error(spark):
    scores = spark.createDataFrame([("s", "g1", 1.0, True)], "sample string, gene string, score double, hvg boolean")
    with pytest.raises(Exception, match="fewer than 5"):
        ranking.global_gene_list(scores, scores.select("gene"), 5).collect()


def test_merge_rules(spark):
    var = spark.createDataFrame(
        [("s1", "g", 1, 1), ("s2", "g", 1, 2), ("s1", "h", 3, 3)], "sample string, gene string, same int, other int"
    )
    kept = {r.column: r.kept for r in concat.merge_same(var, "sample", ["same", "other"]).collect()}
    assert kept == {"same": True, "other": False}
    assert {r.gene: r.other for r in concat.merge_first(var, "sample", ["other"]).collect()} == {"g": 1, "h": 3}

"""Aggregations and quality metrics over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import qc, summaries
from cellweave.operators.ordering import quantiles
from cellweave.plans import views as v
from cellweave.plans.registry import query

v.add_sql_view(
    "metrics",
    """SELECT obs.*, COALESCE(n, 0) AS n_genes_by_counts, COALESCE(t, 0.0) AS total_counts FROM obs LEFT JOIN
    (SELECT cell_id, COUNT(*) FILTER (value > 0) AS n, SUM(value) AS t FROM x GROUP BY 1) c USING (cell_id)""",
    "x obs",
)


def _r(*columns):
    return [F.round(c, 4).alias(c) for c in columns]


def _metrics(spark, sf):
    return qc.cell_metrics(v.counts(spark, sf), v.cells(spark, sf))


@query(
    "qc_cell_metrics",
    "SELECT cell_id, sample, n_genes_by_counts, total_counts FROM metrics",
    "metrics",
)
def qc_cell_metrics(spark, sf):
    return _metrics(spark, sf).select("cell_id", "sample", "n_genes_by_counts", "total_counts")


@query(
    "qc_pct_mt",
    """SELECT cell_id, COALESCE(t, 0.0) AS total_counts, COALESCE(mt, 0.0) AS total_counts_mt,
    CASE WHEN t > 0 THEN round(100 * mt / t, 4) END AS pct_counts_mt
    FROM obs LEFT JOIN (SELECT cell_id, SUM(value) AS t, SUM(CASE WHEN is_mt THEN value ELSE 0 END) AS mt
    FROM x LEFT JOIN var USING (gene) GROUP BY 1) USING (cell_id)""",
    "x obs var",
)
def qc_pct_mt(spark, sf):
    out = qc.subset_share(v.counts(spark, sf), v.cells(spark, sf), v.features(spark, sf), "is_mt", "mt")
    return out.select("cell_id", "total_counts", "total_counts_mt", *_r("pct_counts_mt"))


@query(
    "qc_gene_metrics",
    """SELECT gene, COALESCE(k, 0) AS n_cells_by_counts, COALESCE(t, 0.0) AS total_counts,
    round(COALESCE(t, 0.0) / n, 6) AS mean_counts, round(100 * (1 - COALESCE(k, 0) / n), 4) AS pct_dropout_by_counts
    FROM var LEFT JOIN (SELECT gene, COUNT(*) FILTER (value > 0) AS k, SUM(value) AS t FROM x GROUP BY 1) USING (gene),
    (SELECT COUNT(*) AS n FROM obs)""",
    "x obs var",
)
def qc_gene_metrics(spark, sf):
    out = qc.gene_metrics(v.counts(spark, sf), v.cells(spark, sf), v.features(spark, sf))
    return out.select(
        "gene", "n_cells_by_counts", "total_counts", F.round("mean_counts", 6).alias("mean_counts"),
        *_r("pct_dropout_by_counts"),
    )


@query(
    "qc_pct_top",
    """SELECT cell_id, n_genes_by_counts, round(ln(1 + n_genes_by_counts), 4) AS log1p_n_genes_by_counts, total_counts,
    round(ln(1 + total_counts), 4) AS log1p_total_counts,
    round(100 * t1 / nullif(total_counts, 0), 4) AS pct_counts_in_top_1_genes,
    round(100 * t3 / nullif(total_counts, 0), 4) AS pct_counts_in_top_3_genes,
    round(100 * t50 / nullif(total_counts, 0), 4) AS pct_counts_in_top_50_genes
    FROM metrics LEFT JOIN (SELECT cell_id, SUM(value) FILTER (r <= 1) AS t1, SUM(value) FILTER (r <= 3) AS t3,
        SUM(value) FILTER (r <= 50) AS t50
        FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY value DESC, gene) AS r FROM x) GROUP BY 1)
    USING (cell_id)""",
    "metrics",
)
def qc_pct_top(spark, sf):
    out = qc.top_share(v.counts(spark, sf), v.cells(spark, sf), tops=(1, 3, 50))
    return out.select(
        "cell_id", "n_genes_by_counts", "total_counts",
        *_r("log1p_n_genes_by_counts", "log1p_total_counts", "pct_counts_in_top_1_genes",
            "pct_counts_in_top_3_genes", "pct_counts_in_top_50_genes"),
    )


@query(
    "qc_sample_summary",
    """SELECT sample, COUNT(*) AS n_cells, round(AVG(total_counts), 4) AS mean_total_counts,
    quantile_cont(total_counts, 0.5) AS median_total_counts, round(AVG(n_genes_by_counts), 4) AS mean_genes,
    quantile_cont(n_genes_by_counts::DOUBLE, 0.5) AS median_genes, round(AVG(area), 2) AS mean_cell_area,
    round(quantile_cont(area, 0.5), 4) AS median_cell_area FROM metrics GROUP BY 1 ORDER BY 2 DESC, 1""",
    "metrics",
)
def qc_sample_summary(spark, sf):
    out = qc.sample_summary(_metrics(spark, sf))
    return out.select(
        "sample", "n_cells", *_r("mean_total_counts"), "median_total_counts", *_r("mean_genes"), "median_genes",
        F.round("mean_cell_area", 2).alias("mean_cell_area"), *_r("median_cell_area"),
    )


@query(
    "qc_group_median",
    """SELECT condition, quantile_cont(total_counts, 0.5) AS median_total_counts,
    quantile_cont(n_genes_by_counts::DOUBLE, 0.5) AS median_n_genes_by_counts,
    round(quantile_cont(area, 0.5), 4) AS median_area FROM metrics GROUP BY 1 ORDER BY 1""",
    "metrics",
)
def qc_group_median(spark, sf):
    out = qc.group_medians(_metrics(spark, sf), "condition", ["total_counts", "n_genes_by_counts", "area"])
    return out.withColumn("median_area", F.round("median_area", 4))


def _describe_sql():
    text = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", SUM(n)::BIGINT AS "count", COUNT(*) AS n_unique, arg_min(v, (-n, v)) AS top,
        MAX(n) AS freq, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS "min", NULL::DOUBLE AS "max",
        NULL::DOUBLE AS q25, NULL::DOUBLE AS q50, NULL::DOUBLE AS q75
        FROM (SELECT {c} AS v, COUNT(*) AS n FROM obs WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in ("sample", "condition", "stage")
    )
    numbers = " UNION ALL ".join(
        f"""SELECT '{c}', COUNT({c}), NULL, NULL, NULL, round(AVG({c}), 2), round(stddev_samp({c}), 2), MIN({c}), MAX({c}),
        round(quantile_cont({c}::DOUBLE, 0.25), 4), round(quantile_cont({c}::DOUBLE, 0.5), 4),
        round(quantile_cont({c}::DOUBLE, 0.75), 4) FROM obs"""
        for c in ("donor", "area")
    )
    return f"{text} UNION ALL {numbers}"


@query("describe_columns", _describe_sql(), "obs")
def describe_columns(spark, sf):
    out = summaries.describe(v.cells(spark, sf), ["sample", "condition", "stage"], ["donor", "area"])
    return out.select(
        "column", "count", "n_unique", "top", "freq", F.round("mean", 2).alias("mean"), F.round("std", 2).alias("std"),
        "min", "max", *_r("q25", "q50", "q75"),
    )


@query(
    "value_counts",
    "SELECT sex, COUNT(*) AS n FROM entries GROUP BY 1 ORDER BY 2 DESC, 1",
    "entries",
)
def value_counts(spark, sf):
    return summaries.value_counts(v.catalog_entries(spark, sf), "sex", keep_null=True)


@query(
    "count_distinct_by_group",
    """SELECT batch, condition, stage, tissue, COUNT(DISTINCT sample) AS n_sample, COUNT(DISTINCT donor) AS n_donor
    FROM obs GROUP BY 1, 2, 3, 4""",
    "obs",
)
def count_distinct_by_group(spark, sf):
    keys = ["batch", "condition", "stage", "tissue"]
    obs = v.cells(spark, sf)
    return summaries.distinct_by_group(obs, keys, "sample").join(summaries.distinct_by_group(obs, keys, "donor"), keys)


@query("group_size", "SELECT batch, sample, COUNT(*) AS n FROM obs GROUP BY 1, 2", "obs")
def group_size(spark, sf):
    return v.cells(spark, sf).groupBy("batch", "sample").agg(F.count("*").alias("n"))


@query(
    "control_totals",
    """SELECT cell_id, COALESCE(a, 0.0) AS n_count_neg, COALESCE(b, 0.0) AS n_count_sys FROM obs LEFT JOIN
    (SELECT cell_id, SUM(CASE WHEN feature_type = 'PROMO' THEN value ELSE 0 END) AS a,
    SUM(CASE WHEN feature_type = 'SMALL' THEN value ELSE 0 END) AS b FROM x JOIN var USING (gene) GROUP BY 1)
    USING (cell_id)""",
    "x obs var",
)
def control_totals(spark, sf):
    return qc.class_totals(
        v.counts(spark, sf), v.cells(spark, sf), v.features(spark, sf),
        {"n_count_neg": "PROMO", "n_count_sys": "SMALL"}, "feature_type",
    )


@query(
    "integer_like_profile",
    """SELECT (SELECT round(AVG(CASE WHEN abs(value - round(value)) > 1e-6 THEN 1.0 ELSE 0.0 END), 4) FROM px)
      AS frac_non_integer,
    (SELECT round(MIN(value), 2) FROM px) AS min_value, (SELECT round(MAX(value), 2) FROM px) AS max_value,
    round(MIN(t), 2) AS min_row_sum, round(quantile_cont(t, 0.5), 2) AS median_row_sum, round(MAX(t), 2) AS max_row_sum,
    FALSE AS integer_like
    FROM (SELECT cell_id, COALESCE(SUM(value), 0) AS t FROM obs LEFT JOIN px USING (cell_id) GROUP BY 1)""",
    "px obs",
)
def integer_like_profile(spark, sf):
    out = qc.integer_profile(v.intensity(spark, sf), v.cells(spark, sf))
    money = ["min_value", "max_value", "min_row_sum", "median_row_sum", "max_row_sum"]
    return out.select(*_r("frac_non_integer"), *[F.round(c, 2).alias(c) for c in money], "integer_like")


@query(
    "sparsity",
    """SELECT nnz, n_obs, n_vars, round(1 - nnz / (n_obs::DOUBLE * n_vars), 6) AS sparsity FROM
    (SELECT COUNT(*) FILTER (value <> 0) AS nnz FROM x), (SELECT COUNT(*) AS n_obs FROM obs),
    (SELECT COUNT(*) AS n_vars FROM var)""",
    "x obs var",
)
def sparsity(spark, sf):
    out = qc.sparsity(v.counts(spark, sf), v.cells(spark, sf), v.features(spark, sf))
    return out.withColumn("sparsity", F.round("sparsity", 6))


@query(
    "expression_summary",
    """SELECT gene, COUNT(*) AS n_expressing, n AS n_cells, CASE WHEN COUNT(*) < n THEN 0.0 ELSE MIN(value) END AS min_raw,
    MAX(value) AS max_raw, round(ln(1 + CASE WHEN COUNT(*) < n THEN 0.0 ELSE MIN(value) END), 4) AS min_log1p,
    round(ln(1 + MAX(value)), 4) AS max_log1p
    FROM x, (SELECT COUNT(*) AS n FROM obs) WHERE value > 0 GROUP BY gene, n""",
    "x obs",
)
def expression_summary(spark, sf):
    out = qc.expression_summary(v.counts(spark, sf), v.cells(spark, sf))
    return out.select("gene", "n_expressing", "n_cells", "min_raw", "max_raw", *_r("min_log1p", "max_log1p"))


@query(
    "coordinate_extent",
    """SELECT library, MIN(x) AS x_min, MAX(x) AS x_max, MIN(y) AS y_min, MAX(y) AS y_max,
    round(quantile_cont(sqrt(x * x + y * y), 0.5), 6) AS median_radius FROM space GROUP BY 1""",
    "space",
)
def coordinate_extent(spark, sf):
    space = v.plane(spark, sf).withColumn("radius", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")))
    middle = quantiles(space, ["library"], ["radius"], [0.5])
    return summaries.extent(space, "library").join(
        middle.select("library", F.round("radius__q50", 6).alias("median_radius")), "library"
    )


@query(
    "neg_probe_background",
    """SELECT CASE WHEN z >= (n * m) / 2.0 + 1 THEN 0.0 END AS median_value, round(s / (n * m), 6) AS mean_value,
    n * m AS n_entries FROM (SELECT COUNT(*) AS n FROM obs), (SELECT COUNT(*) AS m FROM var WHERE feature_type = 'PROMO'),
    (SELECT SUM(value) AS s, (SELECT COUNT(*) FROM obs) * (SELECT COUNT(*) FROM var WHERE feature_type = 'PROMO')
       - COUNT(*) AS z FROM x JOIN var USING (gene) WHERE feature_type = 'PROMO')""",
    "x obs var",
)
def neg_probe_background(spark, sf):
    negative = v.features(spark, sf).where(F.col("feature_type") == "PROMO")
    out = qc.dense_median_mean(v.counts(spark, sf), v.cells(spark, sf), negative)
    return out.withColumn("mean_value", F.round("mean_value", 6))


@query(
    "pct_aligned",
    """SELECT l_orderkey AS cell_id, round(SUM(l_extendedprice * (1 - l_discount)) / SUM(l_extendedprice) * 100, 4)
    AS pct_aligned, round(ln(1 + SUM(l_quantity)), 4) AS log_total_counts FROM lineitem GROUP BY 1""",
)
def pct_aligned(spark, sf):
    reads = v.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("cell_id")).agg(
        F.sum("l_extendedprice").alias("raw_reads"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("aligned_reads"),
        F.sum("l_quantity").alias("total"),
    )
    return reads.select(
        "cell_id",
        F.round(F.try_divide(F.col("aligned_reads"), F.col("raw_reads")) * 100, 4).alias("pct_aligned"),
        F.round(F.log1p("total"), 4).alias("log_total_counts"),
    )


@query(
    "sample_manifest",
    """SELECT sample, n_cells, COALESCE(g, 0) AS n_genes, COALESCE(i, TRUE) AS integer_like, r IS NOT NULL AS has_raw, r AS raw_integer_like FROM
    (SELECT sample, COUNT(*) AS n_cells FROM obs GROUP BY 1) LEFT JOIN
    (SELECT sample, COUNT(DISTINCT gene) AS g, MAX(abs(value - round(value))) <= 1e-6 AS i
     FROM x JOIN obs USING (cell_id) GROUP BY 1) USING (sample) LEFT JOIN
    (SELECT sample, MAX(abs(value - round(value))) <= 1e-6 AS r FROM px JOIN obs USING (cell_id) WHERE sample < 'J' GROUP BY 1) USING (sample)""",
    "x px obs",
)
def sample_manifest(spark, sf):
    """The intensities stand in for raw layers, which the samples before J have."""
    obs = v.cells(spark, sf)
    raw = v.intensity(spark, sf).join(obs.where("sample < 'J'").select("cell_id"), "cell_id", "left_semi")
    return summaries.matrix_flags(v.counts(spark, sf), obs, "sample", raw)


@query(
    "dataset_summary",
    """SELECT (SELECT COUNT(*) FROM obs) AS n_cells, (SELECT COUNT(DISTINCT sample) FROM obs) AS n_samples,
    (SELECT COUNT(*) FROM var) AS n_genes, COUNT(*) AS nnz, MAX(abs(value - round(value))) <= 1e-6 AS integer_like,
    (SELECT COUNT(*) > 0 FROM space WHERE x IS NOT NULL AND y IS NOT NULL) AS has_spatial,
    (SELECT COUNT(*) > 0 FROM rep WHERE len(vec) > 0) AS has_embedding FROM x""",
    "x obs var space rep",
)
def dataset_summary(spark, sf):
    return summaries.dataset_overview(
        v.counts(spark, sf), v.cells(spark, sf), v.features(spark, sf), v.plane(spark, sf), v.representation(spark, sf)
    )


@query(
    "group_by_nvars",
    """SELECT n_genes, COUNT(*) AS n_samples, SUM(n_cells)::BIGINT AS n_cells FROM
    (SELECT sample, COUNT(DISTINCT cell_id) AS n_cells, COUNT(DISTINCT gene) AS n_genes
     FROM obs LEFT JOIN x USING (cell_id) GROUP BY 1) GROUP BY 1""",
    "x obs",
)
def group_by_nvars(spark, sf):
    return summaries.group_by_feature_count(v.counts(spark, sf), v.cells(spark, sf), "sample")


@query(
    "hist_fixed_bins",
    """SELECT bin, round(lo + bin * w, 4) AS left_edge, round(lo + (bin + 1) * w, 4) AS right_edge, COUNT(v) AS n FROM
    (SELECT unnest(range(50)) AS bin), (SELECT MIN(total_counts) AS lo, (MAX(total_counts) - MIN(total_counts)) / 50 AS w
     FROM metrics) LEFT JOIN (SELECT total_counts AS v, least(49, floor((total_counts - (SELECT MIN(total_counts) FROM metrics))
     / (SELECT (MAX(total_counts) - MIN(total_counts)) / 50 FROM metrics)))::BIGINT AS b FROM metrics) ON b = bin
    GROUP BY bin, lo, w""",
    "metrics",
)
def hist_fixed_bins(spark, sf):
    out = summaries.histogram(_metrics(spark, sf), "total_counts", 50)
    return out.select("bin", *_r("left_edge", "right_edge"), "n")


@query(
    "boxplot_stats",
    """SELECT b.*, n, whisker_low, whisker_high FROM (SELECT stage, quantile_cont(total_counts, 0.25) AS q25,
    quantile_cont(total_counts, 0.5) AS median, quantile_cont(total_counts, 0.75) AS q75 FROM metrics GROUP BY 1) b JOIN
    (SELECT m.stage, COUNT(total_counts) AS n, MIN(total_counts) FILTER (total_counts >= q25 - 1.5 * (q75 - q25)) AS whisker_low,
    MAX(total_counts) FILTER (total_counts <= q75 + 1.5 * (q75 - q25)) AS whisker_high FROM metrics m JOIN
    (SELECT stage, quantile_cont(total_counts, 0.25) AS q25, quantile_cont(total_counts, 0.75) AS q75 FROM metrics GROUP BY 1)
    USING (stage) GROUP BY 1) USING (stage)""",
    "metrics",
)
def boxplot_stats(spark, sf):
    return summaries.box_stats(_metrics(spark, sf), "stage", "total_counts")


@query(
    "dotplot_stats",
    """SELECT gene, condition, round(m, 6) AS mean_value, round(f, 6) AS frac_expressing,
    round(COALESCE((m - lo) / nullif(hi - lo, 0), 0), 4) AS scaled_mean FROM
    (SELECT *, MIN(m) OVER (PARTITION BY gene) AS lo, MAX(m) OVER (PARTITION BY gene) AS hi FROM
      (SELECT gene, condition, COALESCE(s, 0) / n AS m, COALESCE(k, 0) / n AS f FROM
        ((SELECT DISTINCT gene FROM x) CROSS JOIN (SELECT condition, COUNT(*) AS n FROM obs GROUP BY 1)) g LEFT JOIN
        (SELECT gene, condition, SUM(value) AS s, COUNT(*) FILTER (value > 0) AS k FROM x JOIN obs USING (cell_id) GROUP BY 1, 2)
        USING (gene, condition)))""",
    "x obs",
)
def dotplot_stats(spark, sf):
    out = qc.dot_stats(v.counts(spark, sf), v.cells(spark, sf), "condition")
    return out.select(
        "gene", "condition", F.round("mean_value", 6).alias("mean_value"),
        F.round("frac_expressing", 6).alias("frac_expressing"), *_r("scaled_mean"),
    )

"""Normalisation, variable genes and markers over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import filters, markers, normalize, ordering, variable
from cellweave.plans import views as v
from cellweave.plans.registry import query
from cellweave.session import write_stage

v.add_sql_view(
    "normed",
    """SELECT cell_id, gene, value, SUM(value) OVER (PARTITION BY cell_id) AS t FROM x""",
    "x",
)
v.add_sql_view("lognorm", "SELECT cell_id, gene, ln(1 + value * 10000 / t) AS value FROM normed", "normed")


def _lognorm(spark, sf):
    return normalize.lognorm(v.counts(spark, sf))


@query(
    "normalize_total",
    """SELECT cell_id, gene, round(value * 10000 / t, 4) AS norm_1e4, round(value * 100 / t, 4) AS norm_100, t AS cell_total
    FROM normed""",
    "normed",
)
def normalize_total(spark, sf):
    out = normalize.normalize_total(v.counts(spark, sf), 1e4)
    return out.select(
        "cell_id", "gene", F.round("norm", 4).alias("norm_1e4"),
        F.round(F.col("value") * 100 / F.col("cell_total"), 4).alias("norm_100"), "cell_total",
    )


@query("normalize_log1p", "SELECT cell_id, gene, round(value, 6) AS lognorm FROM lognorm", "lognorm")
def normalize_log1p(spark, sf):
    return _lognorm(spark, sf).select("cell_id", "gene", F.round("value", 6).alias("lognorm"))


v.add_sql_view("roi", "SELECT sample AS roi, gene, SUM(value) AS value FROM x JOIN obs USING (cell_id) GROUP BY 1, 2", "x obs")


@query(
    "q3_normalize",
    """SELECT roi, gene, q3, round(value / q3 * g, 4) AS q3_norm, round(ln(1 + value / q3 * g), 4) AS lognorm FROM roi JOIN
    (SELECT *, exp(AVG(ln(q3)) OVER ()) AS g FROM (SELECT roi, CASE WHEN q = 0 THEN 1.0 ELSE q END AS q3 FROM
     (SELECT r.roi, quantile_cont(COALESCE(value, 0.0), 0.75) AS q FROM (SELECT DISTINCT sample AS roi FROM obs) r CROSS JOIN var
      LEFT JOIN roi ON roi.roi = r.roi AND roi.gene = var.gene GROUP BY 1))) USING (roi)""",
    "roi var",
)
def q3_normalize(spark, sf):
    obs = v.cells(spark, sf)
    roi = (
        v.counts(spark, sf).join(obs.select("cell_id", F.col("sample").alias("roi")), "cell_id")
        .groupBy("roi", "gene").agg(F.sum("value").alias("value"))
    )
    regions = obs.select(F.col("sample").alias("roi")).distinct()
    out = normalize.q3_normalize(write_stage(roi, "roi"), regions, v.features(spark, sf), key="roi")
    return out.select("roi", "gene", "q3", F.round("q3_norm", 4).alias("q3_norm"), F.round("lognorm", 4).alias("lognorm"))


@query(
    "zscale_clip",
    """SELECT cell_id, gene, round(greatest(-10, least(10, (value - m) / s)), 4) + 0.0 AS z, round(greatest(-10, least(10, -m / s)), 4) + 0.0 AS z_zero
    FROM (SELECT cell_id, gene, asinh(value / 5) AS value FROM px) JOIN (SELECT gene, m, sqrt((s2 - n * m * m) / (n - 1)) AS s FROM
    (SELECT gene, SUM(asinh(value / 5)) / (SELECT COUNT(*) FROM obs) AS m, SUM(asinh(value / 5) * asinh(value / 5)) AS s2,
    (SELECT COUNT(*) FROM obs) AS n FROM px GROUP BY 1)) USING (gene)""",
    "px obs",
)
def zscale_clip(spark, sf):
    scaled = v.intensity(spark, sf).select("cell_id", "gene", F.asinh(F.col("value") / 5).alias("value"))
    out = normalize.zscale(scaled, v.cells(spark, sf))
    return out.select("cell_id", "gene", (F.round("z", 4) + 0.0).alias("z"), (F.round("z_zero", 4) + 0.0).alias("z_zero"))


def _dispersion_sql(moments, by):
    keys = f"{by}, " if by else ""
    using = f"USING ({by}, bin)" if by else "USING (bin)"
    part = f"PARTITION BY {by}" if by else ""
    return f"""SELECT *, CASE WHEN bs IS NULL THEN dispersion / nullif(bm, 0) ELSE (dispersion - bm) / nullif(bs, 0) END AS norm FROM
    (SELECT *, least(19, greatest(0, COALESCE(ceil((mean - lo) / nullif((hi - lo) / 20, 0)) - 1, 0)))::INT AS bin FROM
     (SELECT *, MIN(mean) OVER ({part}) AS lo, MAX(mean) OVER ({part}) AS hi FROM
      (SELECT {keys}gene, ln(1 + m) AS mean, CASE WHEN d > 0 THEN ln(d) END AS dispersion FROM
       (SELECT *, var / m AS d FROM (SELECT {keys}gene, CASE WHEN s1 = 0 THEN 1e-12 ELSE s1 / n END AS m,
         (s2 - n * (s1 / n) * (s1 / n)) / (n - 1) AS var FROM ({moments}))))))
    JOIN (SELECT {keys}bin, AVG(dispersion) AS bm, stddev_samp(dispersion) AS bs FROM
     (SELECT *, least(19, greatest(0, COALESCE(ceil((mean - lo) / nullif((hi - lo) / 20, 0)) - 1, 0)))::INT AS bin FROM
     (SELECT *, MIN(mean) OVER ({part}) AS lo, MAX(mean) OVER ({part}) AS hi FROM
      (SELECT {keys}gene, ln(1 + m) AS mean, CASE WHEN d > 0 THEN ln(d) END AS dispersion FROM
       (SELECT *, var / m AS d FROM (SELECT {keys}gene, CASE WHEN s1 = 0 THEN 1e-12 ELSE s1 / n END AS m,
         (s2 - n * (s1 / n) * (s1 / n)) / (n - 1) AS var FROM ({moments})))))) GROUP BY {keys}bin) {using}"""


v.add_sql_view(
    "dispersions",
    _dispersion_sql(
        """SELECT gene, COALESCE(s1, 0) AS s1, COALESCE(s2, 0) AS s2, (SELECT COUNT(*) FROM obs) AS n FROM var LEFT JOIN
        (SELECT gene, SUM(exp(value) - 1) AS s1, SUM((exp(value) - 1) * (exp(value) - 1)) AS s2 FROM lognorm GROUP BY 1) USING (gene)""",
        "",
    ),
    "lognorm obs var",
)
v.add_sql_view(
    "batch_dispersions",
    _dispersion_sql(
        """SELECT batch, gene, s1, s2, n FROM (SELECT batch, gene, SUM(exp(value) - 1) AS s1,
        SUM((exp(value) - 1) * (exp(value) - 1)) AS s2 FROM lognorm JOIN obs USING (cell_id) GROUP BY 1, 2)
        JOIN (SELECT batch, COUNT(*) AS n FROM obs GROUP BY 1) USING (batch)""",
        "batch",
    ),
    "lognorm obs",
)


def _hvg(spark, sf, n_top=200):
    return variable.dispersion_genes(_lognorm(spark, sf), v.cells(spark, sf), v.features(spark, sf), n_top)


@query(
    "hvg_dispersion",
    """SELECT gene, round(mean, 6) + 0.0 AS mean, round(dispersion, 6) + 0.0 AS dispersion, bin, round(norm, 4) + 0.0 AS dispersion_norm,
    COALESCE(round(norm, 9) >= (SELECT round(MIN(norm), 9) FROM (SELECT norm FROM dispersions WHERE norm IS NOT NULL ORDER BY norm DESC LIMIT 200)), FALSE)
    AS highly_variable FROM dispersions""",
    "dispersions",
)
def hvg_dispersion(spark, sf):
    out = _hvg(spark, sf)
    return out.select(
        "gene", (F.round("mean", 6) + 0.0).alias("mean"), (F.round("dispersion", 6) + 0.0).alias("dispersion"), "bin",
        (F.round("dispersion_norm", 4) + 0.0).alias("dispersion_norm"), "highly_variable",
    )


@query(
    "select_hvg_subset",
    """SELECT cell_id, gene, value FROM x WHERE gene IN (SELECT gene FROM dispersions WHERE round(norm, 9) >=
    (SELECT round(MIN(norm), 9) FROM (SELECT norm FROM dispersions WHERE norm IS NOT NULL ORDER BY norm DESC LIMIT 200)))""",
    "dispersions x",
)
def select_hvg_subset(spark, sf):
    return filters.keep_features(v.counts(spark, sf), _hvg(spark, sf), F.col("highly_variable")).select(
        "cell_id", "gene", "value"
    )


@query(
    "hvg_dispersion_batched",
    """SELECT gene, nb AS n_batches, round(mn, 4) + 0.0 AS mean_dispersion_norm FROM
    (SELECT gene, COUNT(*) FILTER (round(norm, 9) >= round(cut, 9)) AS nb, COALESCE(SUM(norm), 0) /
      nullif((SELECT COUNT(DISTINCT batch) FROM obs) - COUNT(*) FILTER (norm IS NULL), 0) AS mn
     FROM batch_dispersions JOIN (SELECT batch, MIN(norm) AS cut FROM (SELECT batch, norm, row_number() OVER
      (PARTITION BY batch ORDER BY norm DESC, gene) AS r FROM batch_dispersions WHERE norm IS NOT NULL) WHERE r <= 200 GROUP BY 1)
     USING (batch) GROUP BY 1) ORDER BY nb DESC, round(mn, 8) DESC NULLS LAST, gene LIMIT 200""",
    "batch_dispersions",
)
def hvg_dispersion_batched(spark, sf):
    out = variable.dispersion_genes_by_batch(_lognorm(spark, sf), v.cells(spark, sf), "batch", 200)
    return out.select("gene", "n_batches", (F.round("mean_dispersion_norm", 4) + 0.0).alias("mean_dispersion_norm"))


v.add_sql_view(
    "logs",
    """SELECT *, row_number() OVER (ORDER BY lx, gene) AS r, COUNT(*) OVER () AS g, greatest(1, CAST(floor(0.3 * COUNT(*) OVER () + 1e-9) AS BIGINT)) AS q FROM
    (SELECT gene, m AS mean, var, log10(m) AS lx, log10(var) AS ly FROM (SELECT gene, s1 / n AS m, (s2 - n * (s1 / n) * (s1 / n)) / (n - 1) AS var FROM
    (SELECT gene, SUM(value) AS s1, SUM(value * value) AS s2, (SELECT COUNT(*) FROM obs) AS n FROM x GROUP BY 1)) WHERE var > 0 AND m > 0)""",
    "x obs",
)
v.add_sql_view(
    "moments",
    """SELECT c, SUM(w) AS s0, SUM(w * u) AS s1, SUM(w * u * u) AS s2, SUM(w * u * u * u) AS s3, SUM(w * u * u * u * u) AS s4,
    SUM(w * ly) AS t0, SUM(w * u * ly) AS t1, SUM(w * u * u * ly) AS t2 FROM
    (SELECT c, u, ly, CASE WHEN h = 0 THEN 1 ELSE pow(1 - pow(abs(u) / h, 3), 3) END AS w FROM (SELECT *, MAX(abs(u)) OVER (PARTITION BY c) AS h FROM
      (SELECT c, lx - c AS u, ly FROM (SELECT DISTINCT lx AS c FROM logs WHERE r IN (SELECT 1 + (i * (g - 1)) // 127 FROM logs, range(128) t(i))), logs
       QUALIFY row_number() OVER (PARTITION BY c ORDER BY abs(lx - c), ly) <= q))) GROUP BY 1""",
    "logs",
)
v.add_sql_view(
    "knots",
    """SELECT *, lead(c) OVER o AS c1, lead(f) OVER o AS f1, lead(d) OVER o AS d1 FROM
    (SELECT c, (t0*(s2*s4-s3*s3) - s1*(t1*s4-s3*t2) + s2*(t1*s3-s2*t2)) / det AS f, (s0*(t1*s4-s3*t2) - t0*(s1*s4-s3*s2) + s2*(s1*t2-t1*s2)) / det AS d
     FROM (SELECT *, s0*(s2*s4-s3*s3) - s1*(s1*s4-s3*s2) + s2*(s1*s3-s2*s2) AS det FROM moments)) WINDOW o AS (ORDER BY c)""",
    "moments",
)
v.add_sql_view(
    "expected",
    """SELECT gene, mean, var, sqrt(pow(10, CASE WHEN c1 IS NULL THEN f ELSE (1 + 2*p)*(1-p)*(1-p)*f + p*(1-p)*(1-p)*(c1-c)*d + p*p*(3-2*p)*f1 - p*p*(1-p)*(c1-c)*d1 END)) AS sd
    FROM (SELECT logs.*, knots.*, (lx - c) / (c1 - c) AS p FROM logs JOIN knots ON lx >= c AND (c1 IS NULL OR lx < c1))""",
    "logs knots",
)


@query(
    "hvg_vst",
    """SELECT gene, round(mean, 6) AS mean, round(var, 6) AS variance, round(vn, 4) AS variance_norm FROM
    (SELECT e.gene, e.mean, e.var, (n * e.mean * e.mean + SUM(least(value, cap) * least(value, cap)) - 2 * e.mean * SUM(least(value, cap)))
      / ((n - 1) * sd * sd) AS vn FROM (SELECT *, mean + sd * sqrt(n) AS cap FROM expected, (SELECT COUNT(*) AS n FROM obs)) e
     JOIN x ON x.gene = e.gene GROUP BY e.gene, e.mean, e.var, n, sd)
    ORDER BY round(vn, 8) DESC, gene LIMIT 200""",
    "expected obs x",
)
def hvg_vst(spark, sf):
    out = variable.variance_genes(v.counts(spark, sf), v.cells(spark, sf), 200)
    return out.select(
        "gene", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"),
        F.round("variance_norm", 4).alias("variance_norm"),
    )


v.add_sql_view(
    "welch",
    """SELECT gene, condition, COALESCE((m1 - m2) / nullif(sqrt(a + b), 0), 0) AS score,
    log2((exp(m1) - 1 + 1e-9) / (exp(m2) - 1 + 1e-9)) AS logfc,
    COALESCE((a + b) * (a + b) / nullif(a * a / (n - 1) + b * b / (rn - 1), 0), 1) AS df FROM
    (SELECT gene, condition, n, rn, s1 / n AS m1, r1 / rn AS m2,
      greatest(0, (s2 - n * (s1 / n) * (s1 / n)) / (n - 1)) / n AS a, greatest(0, (r2 - rn * (r1 / rn) * (r1 / rn)) / (rn - 1)) / rn AS b FROM
     (SELECT *, SUM(n) OVER (PARTITION BY gene) - n AS rn, SUM(s1) OVER (PARTITION BY gene) - s1 AS r1,
       SUM(s2) OVER (PARTITION BY gene) - s2 AS r2 FROM
      (SELECT g.gene, c.condition, c.n, COALESCE(s1, 0) AS s1, COALESCE(s2, 0) AS s2 FROM (SELECT gene FROM var) g
       CROSS JOIN (SELECT condition, COUNT(*) AS n FROM obs GROUP BY 1) c LEFT JOIN
       (SELECT gene, condition, SUM(value) AS s1, SUM(value * value) AS s2 FROM lognorm JOIN obs USING (cell_id) GROUP BY 1, 2) k
       ON k.gene = g.gene AND k.condition = c.condition)))""",
    "lognorm obs var",
)


def _welch(spark, sf):
    return markers.welch(_lognorm(spark, sf), v.cells(spark, sf), "condition", v.features(spark, sf))


@query(
    "rank_genes_ttest",
    "SELECT gene, condition, round(score, 4) + 0.0 AS score, round(logfc, 4) + 0.0 AS logfc, round(df, 2) AS df FROM welch",
    "welch",
)
def rank_genes_ttest(spark, sf):
    return _welch(spark, sf).select(
        "gene", "condition", (F.round("score", 4) + 0.0).alias("score"), (F.round("logfc", 4) + 0.0).alias("logfc"), F.round("df", 2).alias("df")
    )


@query("rank_genes_ttest_p")
def rank_genes_ttest_p(spark, sf):
    return markers.welch_tests(_lognorm(spark, sf), v.cells(spark, sf), "condition", v.features(spark, sf)).select(
        "gene", "condition", "score", "logfc", "p", "p_adj"
    )


@query(
    "markers_sorted",
    "SELECT condition, gene, round(logfc, 4) + 0.0 AS logfc FROM welch ORDER BY 1, logfc DESC",
    "welch",
)
def markers_sorted(spark, sf):
    return markers.sorted_markers(_welch(spark, sf), "condition").select("condition", "gene", (F.round("logfc", 4) + 0.0).alias("logfc"))


@query(
    "markers_topn_union",
    """SELECT gene, p.condition AS condition, p.rank AS rank FROM (SELECT gene, MIN({'condition': condition, 'rank': r}) AS p FROM
    (SELECT *, row_number() OVER (PARTITION BY condition ORDER BY round(score, 6) DESC, gene) AS r FROM welch) WHERE r <= 5 GROUP BY 1)""",
    "welch",
)
def markers_topn_union(spark, sf):
    return markers.top_union(_welch(spark, sf), "condition", 5)


@query(
    "rank_genes_wilcoxon",
    """SELECT gene, condition, round((r - n1 * (n + 1) / 2.0) / sqrt(n1::DOUBLE * (n - n1) * (n + 1) / 12), 4) + 0.0 AS score FROM
    (SELECT gene, condition, n1, n, COALESCE(s, 0) + COALESCE(k, 0) * (n - nnz) + (n1 - COALESCE(k, 0)) * (n - nnz + 1) / 2.0 AS r FROM
      (SELECT gene, COUNT(*) AS nnz FROM x GROUP BY 1) CROSS JOIN (SELECT condition, COUNT(*) AS n1 FROM obs GROUP BY 1) c
      CROSS JOIN (SELECT COUNT(*) AS n FROM obs) LEFT JOIN
      (SELECT gene, condition, SUM(rk) AS s, COUNT(*) AS k FROM (SELECT *, rank() OVER (PARTITION BY gene ORDER BY value)
        + (COUNT(*) OVER (PARTITION BY gene, value) - 1) / 2.0 AS rk FROM x) JOIN obs USING (cell_id) GROUP BY 1, 2) USING (gene, condition))""",
    "x obs",
)
def rank_genes_wilcoxon(spark, sf):
    out = markers.rank_sum(v.counts(spark, sf), v.cells(spark, sf), "condition")
    return out.select("gene", "condition", (F.round("score", 4) + 0.0).alias("score"))


@query(
    "rank_genes_wilcoxon_reference",
    """SELECT gene, condition, round((r - n1 * (n + 1) / 2.0) / sqrt(n1::DOUBLE * (n - n1) * (n + 1) / 12), 4) + 0.0 AS score FROM
    (SELECT gene, condition, n1, n1 + n0 AS n, COALESCE(s, 0) + COALESCE(k, 0) * (n1 + n0 - COALESCE(nnz, 0))
       + (n1 - COALESCE(k, 0)) * (n1 + n0 - COALESCE(nnz, 0) + 1) / 2.0 AS r FROM
      (SELECT DISTINCT gene FROM x) CROSS JOIN (SELECT condition, COUNT(*) AS n1 FROM obs WHERE condition <> '5-LOW' GROUP BY 1) c
      CROSS JOIN (SELECT COUNT(*) AS n0 FROM obs WHERE condition = '5-LOW') LEFT JOIN
      (SELECT gene, contrast AS condition, SUM(rk) FILTER (mine) AS s, COUNT(*) FILTER (mine) AS k, COUNT(*) AS nnz FROM
       (SELECT *, rank() OVER (PARTITION BY gene, contrast ORDER BY value) + (COUNT(*) OVER (PARTITION BY gene, contrast, value) - 1) / 2.0 AS rk
        FROM (SELECT gene, value, condition AS contrast, TRUE AS mine FROM x JOIN obs USING (cell_id) WHERE condition <> '5-LOW'
         UNION ALL SELECT gene, value, o.condition, FALSE FROM x JOIN obs USING (cell_id), (SELECT DISTINCT condition FROM obs
          WHERE condition <> '5-LOW') o WHERE obs.condition = '5-LOW')) GROUP BY 1, 2) USING (gene, condition))""",
    "x obs",
)
def rank_genes_wilcoxon_reference(spark, sf):
    out = markers.rank_sum(v.counts(spark, sf), v.cells(spark, sf), "condition", reference="5-LOW")
    return out.select("gene", "condition", (F.round("score", 4) + 0.0).alias("score"))


@query("rank_genes_wilcoxon_p")
def rank_genes_wilcoxon_p(spark, sf):
    return markers.rank_sum_tests(v.counts(spark, sf), v.cells(spark, sf), "condition", genes=v.features(spark, sf))


@query(
    "bh_adjust",
    """SELECT gene, genome, p, round(least(1.0, MIN(p * m / r) OVER (PARTITION BY genome ORDER BY p DESC, r DESC
    ROWS UNBOUNDED PRECEDING)), 6) AS p_adj FROM (SELECT *, COUNT(*) OVER (PARTITION BY genome) AS m,
    row_number() OVER (PARTITION BY genome ORDER BY p, gene) AS r FROM (SELECT gene, genome, size * size / 2500 AS p FROM var))""",
    "var",
)
def bh_adjust(spark, sf):
    tests = v.features(spark, sf).select("gene", "genome", (F.col("size") * F.col("size") / 2500).alias("p"))
    return ordering.bh_adjust(tests, ["genome"], "p").withColumn("p_adj", F.round("p_adj", 6))


@query(
    "spatial_gene_vector",
    """SELECT cell_id, x, y, round(ln(1 + COALESCE(e, 0)), 6) AS value FROM space LEFT JOIN (SELECT cell_id, SUM(value) AS e FROM x
    JOIN var USING (gene) WHERE gene_name = 'red bolt' GROUP BY 1) USING (cell_id)""",
    "space x var",
)
def spatial_gene_vector(spark, sf):
    named = v.counts(spark, sf).join(v.features(spark, sf).select("gene", "gene_name"), "gene")
    out = normalize.gene_vector(named, v.plane(spark, sf), "red bolt", "gene_name")
    return out.select("cell_id", "x", "y", F.round("value", 6).alias("value"))


@query(
    "protein_vector",
    """SELECT cell_id, x, y, round(COALESCE(e, 0), 2) AS value FROM space LEFT JOIN (SELECT cell_id, SUM(value) AS e FROM px
    JOIN var USING (gene) WHERE gene_name = 'blue rod' GROUP BY 1) USING (cell_id)""",
    "space px var",
)
def protein_vector(spark, sf):
    named = v.intensity(spark, sf).join(v.features(spark, sf).select("gene", "gene_name"), "gene")
    out = normalize.gene_vector(named, v.plane(spark, sf), "blue rod", "gene_name", log=False)
    return out.select("cell_id", "x", "y", F.round("value", 2).alias("value"))

"""Concatenation, set operations and ordered selections over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import align, concat, qc, ranking, summaries
from cellweave.plans import views as v
from cellweave.plans.registry import query

v.add_sql_view(
    "xs",
    "SELECT x.*, sample, batch, stage FROM x JOIN obs USING (cell_id)",
    "x obs",
)


def _xs(spark, sf):
    return v.counts(spark, sf).join(v.cells(spark, sf).select("cell_id", "sample", "batch", "stage"), "cell_id")


@query(
    "concat_inner",
    """SELECT batch, cell_id, gene, value FROM xs WHERE gene IN (SELECT gene FROM xs GROUP BY 1 HAVING
    COUNT(DISTINCT batch) = (SELECT COUNT(DISTINCT batch) FROM xs))""",
    "xs",
)
def concat_inner(spark, sf):
    return concat.inner_features(_xs(spark, sf), v.cells(spark, sf), "batch").select("batch", "cell_id", "gene", "value")


@query(
    "concat_outer_fill0",
    """SELECT cell_id, stage AS label, CASE stage WHEN 'F' THEN area END AS area, CASE stage WHEN 'O' THEN tissue END AS tissue,
    CASE stage WHEN 'P' THEN donor END AS donor, COALESCE(t, 0.0) AS total_counts FROM obs LEFT JOIN
    (SELECT cell_id, SUM(value) AS t FROM x GROUP BY 1) USING (cell_id)""",
    "x obs",
)
def concat_outer_fill0(spark, sf):
    obs = v.cells(spark, sf).withColumnRenamed("stage", "label")
    stacked = concat.outer_columns(obs, "label", {"F": ["area"], "O": ["tissue"], "P": ["donor"]})
    return qc.cell_metrics(v.counts(spark, sf), stacked).drop("n_genes_by_counts")


def _sample_var(spark, sf):
    return (
        v.table(spark, sf, "lineitem").join(v.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("gene"))
        .agg(F.max("p_type").alias("feature_type"), F.max("p_size").alias("size"), F.max("l_tax").alias("max_tax"))
    )


v.add_sql_view(
    "sample_var",
    """SELECT l_returnflag AS sample, l_partkey AS gene, MAX(p_type) AS feature_type, MAX(p_size) AS size, MAX(l_tax) AS max_tax
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)


@query(
    "concat_merge_same",
    """SELECT col AS "column", COUNT(*) AS n_genes, SUM(CASE WHEN d = 1 THEN 0 ELSE 1 END)::BIGINT AS n_conflicts,
    SUM(CASE WHEN d = 1 THEN 0 ELSE 1 END) = 0 AS kept FROM (SELECT gene, 'feature_type' AS col, COUNT(DISTINCT feature_type) AS d, COUNT(*) AS s
    FROM sample_var GROUP BY 1 UNION ALL SELECT gene, 'size', COUNT(DISTINCT size), COUNT(*) FROM sample_var GROUP BY 1
    UNION ALL SELECT gene, 'max_tax', COUNT(DISTINCT max_tax), COUNT(*) FROM sample_var GROUP BY 1)
    WHERE s = (SELECT COUNT(DISTINCT sample) FROM sample_var) GROUP BY 1""",
    "sample_var",
)
def concat_merge_same(spark, sf):
    return concat.merge_same(_sample_var(spark, sf), "sample", ["feature_type", "size", "max_tax"])


@query(
    "concat_merge_first",
    "SELECT gene, arg_min(feature_type, sample) AS feature_type, arg_min(max_tax, sample) AS max_tax FROM sample_var GROUP BY 1",
    "sample_var",
)
def concat_merge_first(spark, sf):
    return concat.merge_first(_sample_var(spark, sf), "sample", ["feature_type", "max_tax"])


@query("concat_index_unique", "SELECT cell_id, cell_id || '-' || sample AS cell_key FROM obs", "obs")
def concat_index_unique(spark, sf):
    return concat.unique_index(v.cells(spark, sf), "sample").select("cell_id", "cell_key")


@query(
    "concat_uns_merge",
    """SELECT key, arg_min(value, sample) AS first_value, CASE WHEN COUNT(DISTINCT value) = 1 AND COUNT(DISTINCT sample) =
    (SELECT COUNT(DISTINCT c_nationkey) FROM customer) THEN arg_min(value, sample) END AS same_value FROM
    (SELECT c_nationkey AS sample, c_mktsegment AS key, 'organism' AS value FROM customer UNION ALL
     SELECT c_nationkey, 'n_' || c_mktsegment, COUNT(*)::VARCHAR FROM customer GROUP BY 1, 2) GROUP BY 1""",
)
def concat_uns_merge(spark, sf):
    customer = v.table(spark, sf, "customer")
    sample = F.col("c_nationkey").alias("sample")
    fixed = customer.select(sample, F.col("c_mktsegment").alias("key"), F.lit("organism").alias("value")).distinct()
    sizes = customer.groupBy(sample, F.concat(F.lit("n_"), "c_mktsegment").alias("key")).agg(
        F.count("*").cast("string").alias("value")
    )
    return concat.merge_metadata(fixed.unionByName(sizes), "sample")


@query(
    "set_common_features",
    "SELECT gene FROM xs GROUP BY 1 HAVING COUNT(DISTINCT batch) = (SELECT COUNT(DISTINCT batch) FROM xs)",
    "xs",
)
def set_common_features(spark, sf):
    return concat.common_features(_xs(spark, sf), v.cells(spark, sf), "batch")


@query(
    "set_difference_requested",
    "SELECT p_partkey AS gene FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.08)",
)
def set_difference_requested(spark, sf):
    available = v.table(spark, sf, "lineitem").where("l_returnflag = 'R' AND l_discount > 0.08")
    return concat.missing_names(
        v.features(spark, sf), available.select(F.col("l_partkey").alias("gene")), "gene"
    )


@query(
    "set_missing_markers",
    """SELECT genome AS category, gene, gene IN (SELECT gene FROM x GROUP BY 1 HAVING COUNT(*) >= 30) AS present FROM var""",
    "x var",
)
def set_missing_markers(spark, sf):
    panel = v.features(spark, sf).select(F.col("genome").alias("category"), "gene")
    available = v.counts(spark, sf).groupBy("gene").agg(F.count("*").alias("n")).where("n >= 30")
    return concat.marker_presence(panel, available)


@query(
    "make_unique_names",
    """SELECT gene, gene_name, CASE WHEN r = 0 THEN gene_name ELSE gene_name || '-' || r END AS unique_name FROM
    (SELECT *, row_number() OVER (PARTITION BY gene_name ORDER BY gene) - 1 AS r FROM var)""",
    "var",
)
def make_unique_names(spark, sf):
    var = v.features(spark, sf).select("gene", "gene_name")
    return ranking.unique_names(var, "gene_name", "gene")


@query(
    "dedup_keep_first",
    """SELECT user_id, event_id, event_type, value FROM events WHERE event_id IN (SELECT MIN(event_id) FROM events GROUP BY user_id)""",
)
def dedup_keep_first(spark, sf):
    events = v.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    ordered = events.withColumn("_o", F.col("event_id"))
    return align.keep_first(ordered, ["user_id"], "_o").drop("_o")


@query(
    "global_gene_ranking",
    """SELECT *, row_number() OVER (ORDER BY hvg_count DESC, mean_score DESC, missing_scores, gene) AS rank FROM
    (SELECT gene, SUM((n >= 8)::INT)::BIGINT AS hvg_count, round(AVG(CASE WHEN n > 3 THEN s / n END), 6) AS mean_score,
     COUNT(*) FILTER (n <= 3) AS missing_scores FROM (SELECT batch, gene, COUNT(*) AS n, SUM(value) AS s FROM xs GROUP BY 1, 2)
     WHERE gene IN (SELECT gene FROM xs GROUP BY 1 HAVING COUNT(DISTINCT batch) = (SELECT COUNT(DISTINCT batch) FROM xs))
     AND gene IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1)
    ORDER BY hvg_count DESC, mean_score DESC, missing_scores, gene LIMIT 100""",
    "xs",
)
def global_gene_ranking(spark, sf):
    xs = _xs(spark, sf)
    per = xs.groupBy("batch", "gene").agg(F.count("*").alias("n"), F.sum("value").alias("s"))
    scores = per.select(
        "batch", "gene", F.when(F.col("n") > 3, F.col("s") / F.col("n")).alias("score"), (F.col("n") >= 8).alias("hvg")
    )
    atac = v.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("gene"))
    eligible = concat.common_features(xs, v.cells(spark, sf), "batch").join(atac, "gene", "left_semi")
    out = ranking.global_gene_list(scores, eligible, 100)
    return out.withColumn("mean_score", F.round("mean_score", 6))


@query(
    "hvg_panel_in_other_modality",
    """SELECT gene, score FROM var WHERE size > 25 AND gene IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')
    ORDER BY score DESC, gene LIMIT 50""",
    "var",
)
def hvg_panel_in_other_modality(spark, sf):
    var = v.features(spark, sf).withColumn("variable", F.col("size") > 25)
    other = v.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("gene"))
    return ranking.panel_from_scores(var, other, 50, "score", "variable").select("gene", "score")


@query(
    "topk_groups",
    "SELECT * FROM (SELECT donor, COUNT(*) AS n FROM obs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20) ORDER BY donor",
    "obs",
)
def topk_groups(spark, sf):
    return summaries.top_groups(v.cells(spark, sf), "donor", 20)


@query(
    "ordered_category_sort",
    """SELECT t.stage, rank, COUNT(obs.cell_id) AS n, round(AVG(area), 2) AS mean_area
    FROM (VALUES ('P', 0), ('F', 1), ('X', 2), ('O', 3)) t(stage, rank) LEFT JOIN obs ON obs.stage = t.stage GROUP BY 1, 2 ORDER BY 2""",
    "obs",
)
def ordered_category_sort(spark, sf):
    return ranking.by_category(
        v.cells(spark, sf), "stage", ["P", "F", "X", "O"], {"mean_area": F.round(F.avg("area"), 2)}
    )


@query(
    "de_table_format",
    """SELECT rank, gene, printf('%+.2f', round(round(fc, 3)::DECIMAL(18, 3), 2)::DOUBLE) AS log2fc,
    printf('%.2f', round(round(score, 3)::DECIMAL(18, 3), 2)::DOUBLE) AS score,
    printf('%.1f%%', round(round(a, 3)::DECIMAL(18, 3) * 100, 1)::DOUBLE) AS pct_expr_a,
    printf('%.1f%%', round(round(b, 3)::DECIMAL(18, 3) * 100, 1)::DOUBLE) AS pct_expr_b FROM
    (SELECT gene AS rank, gene_name AS gene, log2(score / 1000) AS fc, size / 7 AS score, size / 51 AS a, (50 - size) / 50 AS b FROM var)""",
    "var",
)
def de_table_format(spark, sf):
    table = v.features(spark, sf).select(
        F.col("gene").alias("rank"),
        F.col("gene_name").alias("gene"),
        F.log2(F.col("score") / 1000).alias("log2fc_a_vs_b"),
        (F.col("size") / 7).alias("score"),
        (F.col("size") / 51).alias("pct_expr_a"),
        ((50 - F.col("size")) / 50).alias("pct_expr_b"),
    )
    return ranking.format_markers(table)


@query(
    "quantile_clip_color",
    """SELECT cell_id, gene, round(vmax, 4) AS vmax, round(least(value, vmax) / vmax, 4) AS shade FROM x JOIN
    (SELECT gene, quantile_cont(value, 0.98) AS vmax FROM x WHERE value > 0 GROUP BY 1) USING (gene) WHERE value > 0""",
    "x",
)
def quantile_clip_color(spark, sf):
    out = ranking.clip_at_quantile(v.counts(spark, sf), 0.98)
    return out.select("cell_id", "gene", F.round("vmax", 4).alias("vmax"), F.round("shade", 4).alias("shade"))

"""Projections and filters over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import filters
from cellweave.plans import views as v
from cellweave.plans.registry import query


@query(
    "project_available",
    """SELECT cell_id, sample, stage, NULL::DOUBLE AS mean_dapi, area AS cell_area, NULL::VARCHAR AS panel
    FROM (SELECT cell_id, sample, stage, area FROM obs)""",
    "obs",
)
def project_available(spark, sf):
    obs = v.cells(spark, sf).withColumnRenamed("area", "cell_area")
    return filters.project_available(
        obs,
        {"cell_id": "bigint", "sample": "string", "stage": "string", "mean_dapi": "double", "cell_area": "double", "panel": "string"},
    )


@query(
    "coordinate_fallback",
    """SELECT cell_id, CASE library % 4 WHEN 0 THEN pxl_col WHEN 1 THEN pxl_col + 1 WHEN 2 THEN array_col END AS spatial_x,
    CASE library % 4 WHEN 0 THEN pxl_row WHEN 1 THEN pxl_row + 1 WHEN 2 THEN array_row END AS spatial_y,
    CASE library % 4 WHEN 0 THEN 'x,y' WHEN 1 THEN 'centroid_x,centroid_y' WHEN 2 THEN 'array_col,array_row' END
    AS spatial_source FROM spots""",
    "spots",
)
def coordinate_fallback(spark, sf):
    spots = v.lattice(spark, sf)
    kind = F.col("library") % 4
    mixed = spots.select(
        "cell_id",
        F.when(kind == 0, F.col("pxl_col")).alias("x"),
        F.when(kind == 0, F.col("pxl_row")).alias("y"),
        F.when(kind == 1, F.col("pxl_col") + 1).alias("centroid_x"),
        F.when(kind == 1, F.col("pxl_row") + 1).alias("centroid_y"),
        F.when(kind == 2, F.col("array_col")).alias("array_col"),
        F.when(kind >= 2, F.col("array_row")).alias("array_row"),
    )
    out = filters.coordinate_fallback(mixed)
    return out.select("cell_id", "spatial_x", "spatial_y", "spatial_source")


@query(
    "sample_key_fallback",
    """SELECT cell_id, COALESCE(CASE WHEN stage <> 'P' THEN sample END, CASE WHEN condition <> '5-LOW' THEN batch END, 'table_1')
    AS sample_id FROM obs""",
    "obs",
)
def sample_key_fallback(spark, sf):
    obs = v.cells(spark, sf).select(
        "cell_id",
        F.when(F.col("stage") != "P", F.col("sample")).alias("sample"),
        F.when(F.col("condition") != "5-LOW", F.col("batch")).alias("region"),
    )
    return obs.select("cell_id", filters.key_fallback(obs, "table_1").alias("sample_id"))


@query(
    "coords_project_2d",
    "SELECT cell_id, CASE WHEN library < 5 THEN vec[4] ELSE vec[1] END AS x, CASE WHEN library < 5 THEN vec[5] ELSE vec[2] END AS y FROM rep",
    "rep",
)
def coords_project_2d(spark, sf):
    rep = v.representation(spark, sf).select(
        "cell_id", F.when(F.col("library") < 5, F.slice("vec", 4, 3)).alias("spatial_3d"), F.slice("vec", 1, 2).alias("spatial")
    )
    x, y = filters.coords_2d(F.col("spatial_3d"), F.col("spatial"))
    return rep.select("cell_id", x.alias("x"), y.alias("y"))


@query(
    "alias_col_fallback",
    """SELECT cell_id, COALESCE(CASE WHEN stage = 'F' THEN donor::VARCHAR END, CASE WHEN stage = 'O' THEN tissue END, batch) AS alias,
    CASE stage WHEN 'F' THEN 'meta__cluster_alias' WHEN 'O' THEN 'cluster_alias' ELSE 'cluster' END AS alias_column FROM obs""",
    "obs",
)
def alias_col_fallback(spark, sf):
    obs = v.cells(spark, sf).select(
        "cell_id",
        F.when(F.col("stage") == "F", F.col("donor")).alias("meta__cluster_alias"),
        F.when(F.col("stage") == "O", F.col("tissue")).alias("cluster_alias"),
        F.col("batch").alias("cluster"),
    )
    return filters.alias_fallback(obs, "meta__cluster_alias").select("cell_id", "alias", "alias_column")


@query(
    "counts_layer_fallback",
    """SELECT l_orderkey AS cell_id, l_partkey AS gene, l_linenumber AS line,
    CASE l_returnflag WHEN 'R' THEN l_quantity WHEN 'A' THEN l_extendedprice ELSE l_discount END AS counts FROM lineitem""",
)
def counts_layer_fallback(spark, sf):
    lines = v.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("cell_id"),
        F.col("l_partkey").alias("gene"),
        F.col("l_linenumber").alias("line"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("layer_raw"),
        F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice")).alias("raw"),
        F.col("l_discount").alias("X"),
    )
    return lines.select("cell_id", "gene", "line", filters.layer_fallback("layer_raw", "raw", "X").alias("counts"))


@query(
    "filter_fov_limit",
    "SELECT cell_id, sample FROM obs WHERE sample IN ('NATION_1', 'NATION_2', 'NATION_3') ORDER BY cell_id LIMIT 500",
    "obs",
)
def filter_fov_limit(spark, sf):
    obs = v.cells(spark, sf).select("cell_id", "sample")
    return filters.fov_limit(obs, "sample", ["NATION_1", "NATION_2", "NATION_3"], "cell_id", 500)


@query("filter_in_tissue", "SELECT cell_id, library, array_row, array_col FROM spots WHERE in_tissue = 1", "spots")
def filter_in_tissue(spark, sf):
    return v.lattice(spark, sf).where("in_tissue = 1").select("cell_id", "library", "array_row", "array_col")


@query(
    "filter_notna_label",
    "SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL",
)
def filter_notna_label(spark, sf):
    docs = v.table(spark, sf, "documents").join(v.table(spark, sf, "labels"), "doc_id", "left")
    return docs.where(F.col("quality").isNotNull()).select("doc_id", "lang", "quality")


@query(
    "filter_feature_type",
    "SELECT cell_id, gene, value FROM x WHERE gene IN (SELECT gene FROM var WHERE feature_type NOT IN ('PROMO', 'SMALL'))",
    "x var",
)
def filter_feature_type(spark, sf):
    return filters.keep_features(
        v.counts(spark, sf), v.features(spark, sf), ~F.col("feature_type").isin("PROMO", "SMALL")
    ).select("cell_id", "gene", "value")


@query(
    "classify_features",
    """SELECT gene, name, CASE WHEN regexp_matches(lower(name), '^(negprb|negprobe|neg_prb|negative)') THEN 'negative'
    WHEN regexp_matches(lower(name), '^(systemcontrol|sys_control|falsecode)') THEN 'system' ELSE 'gene' END AS rna_class,
    CASE WHEN regexp_matches(name, '^(Ms IgG|Rb IgG)') THEN 'isotype' WHEN name LIKE 'Channel-%' THEN 'channel' ELSE 'protein'
    END AS protein_class FROM (SELECT gene, CASE feature_type WHEN 'PROMO' THEN 'NegPrb' || gene WHEN 'SMALL' THEN 'FalseCode' || gene
    WHEN 'LARGE' THEN 'Rb IgG' || gene WHEN 'MEDIUM' THEN 'Channel-' || gene WHEN 'ECONOMY' THEN 'ms igg' || gene ELSE gene_name END AS name
    FROM var)""",
    "var",
)
def classify_features(spark, sf):
    kind = F.col("feature_type")
    gene = F.col("gene").cast("string")
    named = v.features(spark, sf).select(
        "gene",
        F.when(kind == "PROMO", F.concat(F.lit("NegPrb"), gene))
        .when(kind == "SMALL", F.concat(F.lit("FalseCode"), gene))
        .when(kind == "LARGE", F.concat(F.lit("Rb IgG"), gene))
        .when(kind == "MEDIUM", F.concat(F.lit("Channel-"), gene))
        .when(kind == "ECONOMY", F.concat(F.lit("ms igg"), gene))
        .otherwise(F.col("gene_name"))
        .alias("name"),
    )
    return named.select(
        "gene", "name", filters.rna_class(F.col("name")).alias("rna_class"),
        filters.protein_class(F.col("name")).alias("protein_class"),
    )


@query(
    "filter_cells",
    """SELECT cell_id, gene, value FROM x WHERE cell_id IN
    (SELECT cell_id FROM x GROUP BY 1 HAVING SUM(value) >= 100 AND COUNT(*) FILTER (value > 0) >= 4)""",
    "x",
)
def filter_cells(spark, sf):
    kept = filters.keep_cells(v.counts(spark, sf), min_counts=100, min_genes=4)
    return kept.select("cell_id", "gene", "value")


@query(
    "filter_genes",
    "SELECT cell_id, gene, value FROM x WHERE gene IN (SELECT gene FROM x GROUP BY 1 HAVING COUNT(*) FILTER (value > 0) >= 30)",
    "x",
)
def filter_genes(spark, sf):
    return filters.keep_genes(v.counts(spark, sf), min_cells=30).select("cell_id", "gene", "value")


@query(
    "filter_genes_then_cells",
    """SELECT cell_id, gene, value FROM (SELECT *, SUM(value) OVER (PARTITION BY cell_id) AS t FROM x WHERE gene IN
    (SELECT gene FROM x GROUP BY 1 HAVING COUNT(*) FILTER (value > 0) >= 30)) WHERE t >= 100""",
    "x",
)
def filter_genes_then_cells(spark, sf):
    genes = filters.keep_genes(v.counts(spark, sf), min_cells=30)
    return filters.keep_cells(genes, min_counts=100).select("cell_id", "gene", "value")


@query("drop_zero_genes", "SELECT gene, gene_name FROM var WHERE gene IN (SELECT gene FROM x WHERE value <> 0)", "x var")
def drop_zero_genes(spark, sf):
    seen = v.counts(spark, sf).where("value <> 0").select("gene").distinct()
    return v.features(spark, sf).join(seen, "gene", "left_semi").select("gene", "gene_name")


@query("drop_mt_genes", "SELECT cell_id, gene, value FROM x WHERE gene NOT IN (SELECT gene FROM var WHERE is_mt)", "x var")
def drop_mt_genes(spark, sf):
    kept = filters.drop_features(v.counts(spark, sf), v.features(spark, sf), F.col("is_mt"))
    return kept.select("cell_id", "gene", "value")


@query(
    "bbox_zoom",
    """SELECT s.library, cell_id, round(x0, 6) + 0.0 AS zoom_x0, round(x1, 6) + 0.0 AS zoom_x1, round(y0, 6) + 0.0 AS zoom_y0,
    round(y1, 6) + 0.0 AS zoom_y1 FROM space s JOIN
    (SELECT library, MIN(x) - 0.25 * (MAX(x) - MIN(x)) AS x0, MAX(x) + 0.25 * (MAX(x) - MIN(x)) AS x1,
    MIN(y) - 0.45 * (MAX(y) - MIN(y)) AS y0, MAX(y) + 0.45 * (MAX(y) - MIN(y)) AS y1
    FROM space WHERE abs(x) < 0.05 AND abs(y) < 0.05 GROUP BY 1) b ON s.library = b.library
    AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1""",
    "space",
)
def bbox_zoom(spark, sf):
    space = v.plane(spark, sf)
    region = space.where((F.abs("x") < 0.05) & (F.abs("y") < 0.05))
    seen = filters.cells_in_view(space, filters.zoom_boxes(region, "library"), "library")
    ends = [(F.round(c, 6) + 0.0).alias(c) for c in ("zoom_x0", "zoom_x1", "zoom_y0", "zoom_y1")]
    return seen.select("library", "cell_id", *ends)


@query(
    "sanitize_nonfinite",
    """SELECT l_orderkey AS cell_id, l_partkey AS gene, l_linenumber AS line,
    CASE WHEN l_returnflag = 'R' OR l_discount = 0 THEN 0.0 ELSE l_quantity END AS value FROM lineitem""",
)
def sanitize_nonfinite(spark, sf):
    raw = v.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("cell_id"),
        F.col("l_partkey").alias("gene"),
        F.col("l_linenumber").alias("line"),
        F.when(F.col("l_returnflag") == "R", float("nan"))
        .when((F.col("l_discount") == 0) & (F.col("l_tax") > 0.04), float("inf"))
        .when(F.col("l_discount") == 0, float("-inf"))
        .otherwise(F.col("l_quantity"))
        .alias("value"),
    )
    return raw.withColumn("value", filters.finite_or_zero("value"))

"""Neighbour graphs, niches and clusters over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import communities, delaunay, embed, neighbours, niches, normalize, qc, variable
from cellweave.plans import views as v
from cellweave.plans.registry import query
from cellweave.session import write_stage

v.add_sql_view(
    "knn6",
    """SELECT library, src, dst, distance, rank FROM (SELECT a.library, a.cell_id AS src, b.cell_id AS dst,
    sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance, row_number() OVER (PARTITION BY a.cell_id ORDER BY
    sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), b.cell_id) AS rank
    FROM space a JOIN space b ON a.library = b.library AND a.cell_id <> b.cell_id) WHERE rank <= 6""",
    "space",
)


v.add_sql_view("sites", "SELECT library, x, y, MIN(cell_id) AS cell_id FROM space GROUP BY 1, 2, 3", "space")


@query("spatial_knn", "SELECT src, dst, round(distance, 8) AS distance, rank FROM knn6", "knn6")
def spatial_knn(spark, sf):
    return neighbours.spatial_knn(v.plane(spark, sf), 6).withColumn("distance", F.round("distance", 8))


@query(
    "spatial_gabriel",
    """SELECT a.library, a.cell_id AS src, b.cell_id AS dst, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 8) AS distance
    FROM sites a JOIN sites b ON a.library = b.library AND a.cell_id < b.cell_id WHERE NOT EXISTS (SELECT 1 FROM sites c
    WHERE c.library = a.library AND (a.x - c.x) * (b.x - c.x) + (a.y - c.y) * (b.y - c.y) < 0)""",
    "sites",
)
def spatial_gabriel(spark, sf):
    return neighbours.spatial_gabriel(v.plane(spark, sf)).withColumn("distance", F.round("distance", 8))


@query(
    "spatial_delaunay",
    """SELECT library, src, dst, round(distance, 8) AS distance FROM
    (SELECT a.library, a.cell_id AS src, b.cell_id AS dst, MAX(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS distance,
     COALESCE(MAX(CASE WHEN w < 0 THEN d / w END), '-inf'::DOUBLE) AS low, COALESCE(MIN(CASE WHEN w > 0 THEN d / w END), 'inf'::DOUBLE) AS high,
     COALESCE(bool_or(w = 0 AND d < 0), FALSE) AS blocked
     FROM sites a JOIN sites b ON a.library = b.library AND a.cell_id < b.cell_id LEFT JOIN sites c
     ON c.library = a.library AND c.cell_id <> a.cell_id AND c.cell_id <> b.cell_id,
     LATERAL (SELECT (a.x - c.x) * (b.x - c.x) + (a.y - c.y) * (b.y - c.y) AS d, (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) AS w)
     GROUP BY 1, 2, 3) WHERE NOT blocked AND (low <= high OR low - high <= 1e-9 * (1 + abs(low) + abs(high)))""",
    "sites",
)
def spatial_delaunay(spark, sf):
    return delaunay.spatial_delaunay(v.plane(spark, sf)).withColumn("distance", F.round("distance", 8))


@query(
    "knn_features",
    """SELECT src, dst, round(distance, 6) AS distance, rank FROM (SELECT a.cell_id AS src, b.cell_id AS dst,
    list_distance(a.vec, b.vec) AS distance, row_number() OVER (PARTITION BY a.cell_id ORDER BY list_distance(a.vec, b.vec), b.cell_id)
    AS rank FROM rep a JOIN rep b ON a.cell_id <> b.cell_id) WHERE rank <= 14""",
    "rep",
)
def knn_features(spark, sf):
    return neighbours.feature_knn(v.representation(spark, sf), 14).withColumn("distance", F.round("distance", 6))


@query(
    "spatial_grid",
    """SELECT a.library, a.cell_id AS src, b.cell_id AS dst, 1.0::DOUBLE AS distance FROM spots a JOIN spots b ON a.library = b.library AND
    ((abs(a.array_row - b.array_row) = 1 AND abs(a.array_col - b.array_col) = 1) OR (a.array_row = b.array_row AND abs(a.array_col - b.array_col) = 2))""",
    "spots",
)
def spatial_grid(spark, sf):
    return neighbours.spatial_grid(v.lattice(spark, sf))


@query(
    "remove_long_edges",
    """SELECT src, dst, round(distance, 8) AS distance FROM knn6 WHERE distance <= (SELECT quantile_cont(distance, 0.99) FROM knn6)""",
    "knn6",
)
def remove_long_edges(spark, sf):
    edges = write_stage(neighbours.spatial_knn(v.plane(spark, sf), 6), "edges")
    return niches.drop_long_edges(edges).select("src", "dst", F.round("distance", 8).alias("distance"))


v.add_sql_view("sym", "SELECT src, dst FROM knn6 UNION SELECT dst, src FROM knn6", "knn6")
v.add_sql_view(
    "hop2",
    """SELECT DISTINCT a.src, b.dst FROM sym a JOIN sym b ON a.dst = b.src WHERE a.src <> b.dst
    AND (a.src, b.dst) NOT IN (SELECT (src, dst) FROM sym)""",
    "sym",
)
v.add_sql_view(
    "hop3",
    """SELECT DISTINCT a.src, b.dst FROM hop2 a JOIN sym b ON a.dst = b.src WHERE (a.src, b.dst) NOT IN (SELECT (src, dst) FROM sym)
    AND (a.src, b.dst) NOT IN (SELECT (src, dst) FROM hop2)""",
    "hop2",
)


@query(
    "aggregate_neighbors",
    """SELECT c.cell_id, hop * 64 + p AS pos, round(COALESCE(m, 0), 4) + 0.0 AS value FROM
    (SELECT cell_id, hop, p FROM rep, (SELECT unnest(range(4)) AS hop), (SELECT unnest(range(64)) AS p)) c LEFT JOIN
    (SELECT src, h, p AS q, AVG(vec[p + 1]) AS m FROM (SELECT cell_id AS src, cell_id AS dst, 0 AS h FROM rep UNION ALL
      SELECT src, dst, 1 FROM sym UNION ALL SELECT src, dst, 2 FROM hop2 UNION ALL SELECT src, dst, 3 FROM hop3)
      JOIN rep ON rep.cell_id = dst, (SELECT unnest(range(64)) AS p) GROUP BY 1, 2, 3) ON src = c.cell_id AND h = hop AND q = p""",
    "rep hop3",
)
def aggregate_neighbors(spark, sf):
    edges = neighbours.spatial_knn(v.plane(spark, sf), 6)
    out = niches.niche_vectors(v.representation(spark, sf), edges, 3)
    return out.select("cell_id", F.posexplode("niche").alias("pos", "value")).select(
        "cell_id", F.col("pos").cast("long").alias("pos"), (F.round("value", 4) + 0.0).alias("value")
    )


def _knn_edges(spark, sf):
    return write_stage(neighbours.feature_knn(v.representation(spark, sf), 14), "knn")


@query("fuzzy_connectivities")
def fuzzy_connectivities(spark, sf):
    return niches.fuzzy_weights(_knn_edges(spark, sf))


@query("graph_communities")
def graph_communities(spark, sf):
    weights = write_stage(niches.fuzzy_weights(_knn_edges(spark, sf)), "weights")
    return communities.multilevel(weights, v.representation(spark, sf), (0.1, 0.5, 0.6, 0.7, 1.0))


v.add_sql_view(
    "ends", "SELECT least(src, dst) AS src, greatest(src, dst) AS dst, 1 / (1 + MAX(distance)) AS w FROM knn6 GROUP BY 1, 2", "knn6"
)
v.add_sql_view("lab", "SELECT cell_id, library * 2 + CASE WHEN x > 0 THEN 1 ELSE 0 END AS label FROM space", "space")


@query(
    "graph_modularity",
    """SELECT resolution::DOUBLE AS resolution, n_communities, round(a - resolution * b, 6) + 0.0 AS modularity FROM
    (SELECT unnest([0.1, 0.5, 0.6, 0.7, 1.0]) AS resolution), (SELECT COUNT(*) AS n_communities, SUM(i) / MAX(m) AS a,
     SUM((d / (2 * m)) * (d / (2 * m))) AS b FROM (SELECT l, SUM(w) AS d, SUM(CASE WHEN l = o THEN w ELSE 0 END) / 2 AS i FROM
      (SELECT x.label AS l, y.label AS o, w FROM ends JOIN lab x ON x.cell_id = src JOIN lab y ON y.cell_id = dst UNION ALL
       SELECT y.label, x.label, w FROM ends JOIN lab x ON x.cell_id = src JOIN lab y ON y.cell_id = dst) GROUP BY 1),
     (SELECT SUM(w) AS m FROM ends))""",
    "ends lab",
)
def graph_modularity(spark, sf):
    space = v.plane(spark, sf)
    knn = neighbours.spatial_knn(space, 6)
    edges = (
        knn.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.max("distance").alias("distance"))
        .select("src", "dst", (1 / (1 + F.col("distance"))).alias("weight"))
    )
    labels = space.select("cell_id", F.when(F.col("x") > 0, 1).otherwise(0).alias("_a"), "library").select(
        "cell_id", (F.col("library") * 2 + F.col("_a")).alias("label")
    )
    out = niches.modularity(write_stage(edges, "edges"), labels, (0.1, 0.5, 0.6, 0.7, 1.0))
    return out.withColumn("modularity", F.round("modularity", 6) + 0.0)


@query(
    "communities_checked",
    """SELECT resolution::DOUBLE AS resolution, n_cells, round(m, 6) AS total_weight, n_cells AS n_connected, TRUE AS beats_quadrants FROM
    (SELECT unnest([0.5, 1.0]) AS resolution), (SELECT COUNT(*) AS n_cells FROM space), (SELECT SUM(w) AS m FROM ends)""",
    "ends space",
)
def communities_checked(spark, sf):
    """Communities of the spatial graph: every cell once, reached inside its community, better than labels by quadrant."""
    space = v.plane(spark, sf)
    knn = neighbours.spatial_knn(space, 6)
    edges = knn.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.max("distance").alias("distance"))
    edges = write_stage(edges.select("src", "dst", (1 / (1 + F.col("distance"))).alias("weight")), "edges")
    found = write_stage(communities.multilevel(edges, space, (0.5, 1.0)), "communities")
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    links = write_stage(both.join(found.select("resolution").distinct()), "links")
    state = found.select("resolution", F.col("cell_id").alias("src"), F.lit(1.0).alias("k"), "label", F.col("label").alias("part"))
    reached = communities.connected_parts(links, state).groupBy("resolution").agg(F.count_if(F.col("label") == F.col("part")).alias("n_connected"))
    quadrants = space.select("cell_id", (F.col("library") * 2 + F.when(F.col("x") > 0, 1).otherwise(0)).alias("label"))
    plain = niches.modularity(edges, quadrants, (0.5, 1.0)).select("resolution", F.col("modularity").alias("plain"))
    ours = [niches.modularity(edges, found.where(F.col("resolution") == r).select("cell_id", "label"), (r,)) for r in (0.5, 1.0)]
    ours = ours[0].unionByName(ours[1]).select("resolution", "modularity")
    sizes = found.groupBy("resolution").agg(F.count_distinct("cell_id").alias("n_cells"))
    total = edges.select(F.round(F.sum("weight"), 6)).scalar()
    return sizes.join(reached, "resolution").join(ours, "resolution").join(plain, "resolution").select(
        "resolution", "n_cells", total.alias("total_weight"), "n_connected", (F.col("modularity") >= F.col("plain")).alias("beats_quadrants")
    )


v.add_sql_view(
    "two_labels",
    """SELECT cell_id, sample, n_genes_by_counts % 4 AS rna_label, CASE WHEN p > 300000 THEN 'high' WHEN p > 100000 THEN 'mid' ELSE 'low' END
    AS protein_label FROM metrics LEFT JOIN (SELECT cell_id, SUM(value) AS p FROM px GROUP BY 1) USING (cell_id)""",
    "metrics px",
)


def _two_labels(spark, sf):
    rna = qc.cell_metrics(v.counts(spark, sf), v.cells(spark, sf)).select(
        "cell_id", "sample", (F.col("n_genes_by_counts") % 4).alias("rna_label")
    )
    total = v.intensity(spark, sf).groupBy("cell_id").agg(F.sum("value").alias("p"))
    protein = F.when(F.col("p") > 300000, "high").when(F.col("p") > 100000, "mid").otherwise("low")
    return rna.join(total, "cell_id", "left").withColumn("protein_label", protein).drop("p")


@query(
    "cluster_sizes",
    """SELECT sample, rna_label, n, COUNT(*) OVER (PARTITION BY sample) AS n_clusters FROM
    (SELECT sample, rna_label, COUNT(*) AS n FROM two_labels GROUP BY 1, 2) ORDER BY sample, n DESC""",
    "two_labels",
)
def cluster_sizes(spark, sf):
    labels = _two_labels(spark, sf)
    sizes = labels.groupBy("sample", "rna_label").agg(F.count("*").alias("n"))
    clusters = labels.groupBy("sample").agg(F.count_distinct("rna_label").alias("n_clusters"))
    return sizes.join(clusters, "sample").orderBy("sample", F.desc("n"))


@query(
    "modality_label_compare",
    "SELECT rna_label, protein_label, COUNT(*) AS n FROM two_labels GROUP BY 1, 2",
    "two_labels",
)
def modality_label_compare(spark, sf):
    return _two_labels(spark, sf).groupBy("rna_label", "protein_label").agg(F.count("*").alias("n"))


@query(
    "gram_matrix",
    """SELECT a.gene AS gene_i, b.gene AS gene_j, SUM(a.value * b.value) AS xtx,
    round((SUM(a.value * b.value) - MAX(si.s) * MAX(sj.s) / MAX(n)) / (MAX(n) - 1), 8) + 0.0 AS covariance
    FROM x a JOIN x b ON a.cell_id = b.cell_id AND a.gene <= b.gene
    JOIN (SELECT gene, SUM(value) AS s FROM x GROUP BY 1) si ON si.gene = a.gene JOIN (SELECT gene, SUM(value) AS s FROM x GROUP BY 1) sj ON sj.gene = b.gene,
    (SELECT COUNT(*) AS n FROM obs) WHERE a.value <> 0 AND b.value <> 0 GROUP BY 1, 2""",
    "x obs",
)
def gram_matrix(spark, sf):
    out = embed.gram_pairs(v.counts(spark, sf), v.features(spark, sf), v.cells(spark, sf))
    return out.withColumn("covariance", F.round("covariance", 8) + 0.0)


def _panel(spark, sf, n=2000):
    """Highly variable panel on log-normalised counts."""
    log_x = normalize.lognorm(v.counts(spark, sf))
    chosen = variable.dispersion_genes(log_x, v.cells(spark, sf), v.features(spark, sf), n).where("highly_variable")
    return log_x, chosen.orderBy(F.desc("dispersion_norm"), "gene").limit(n)


@query("pca_embed")
def pca_embed(spark, sf):
    log_x, panel = _panel(spark, sf)
    scores, ratios = embed.pca(log_x, v.cells(spark, sf), panel, 30)
    return scores.select("cell_id", *[F.col("pcs")[i].alias(f"pc{i + 1}") for i in range(len(ratios))])


@query("svd_embed")
def svd_embed(spark, sf):
    log_x, panel = _panel(spark, sf)
    found, values = embed.svd(log_x, v.cells(spark, sf), panel, 20)
    return found.select("cell_id", *[F.col("components")[i].alias(f"svd{i + 1}") for i in range(len(values))])


def _whole(found, column):
    """What the components hold and what they leave out, per table."""
    held = F.aggregate(column, F.lit(0.0), lambda total, c: total + c * c)
    return found.agg(F.count("*").alias("n_cells"), F.sum(held + F.col("lost")).alias("total"))


@query(
    "pca_reconstruction",
    """SELECT (SELECT COUNT(*) FROM obs) AS n_cells, round(SUM(q - s * s / n) / (MAX(n) - 1), 6) AS total_variance
    FROM (SELECT gene, SUM(value) AS s, SUM(value * value) AS q FROM lognorm GROUP BY 1), (SELECT COUNT(*) AS n FROM obs)""",
    "lognorm obs",
)
def pca_reconstruction(spark, sf):
    """Components and residuals of all genes together hold the whole variance."""
    found, _ = embed.pca(normalize.lognorm(v.counts(spark, sf)), v.cells(spark, sf), v.features(spark, sf), 30)
    return _whole(found, "pcs").select("n_cells", F.round(F.col("total") / (F.col("n_cells") - 1), 6).alias("total_variance"))


@query(
    "svd_reconstruction",
    "SELECT (SELECT COUNT(*) FROM obs) AS n_cells, round(SUM(value * value), 5) AS total_square FROM lognorm",
    "lognorm obs",
)
def svd_reconstruction(spark, sf):
    """Components and residuals of all genes together hold the whole square sum."""
    found, _ = embed.svd(normalize.lognorm(v.counts(spark, sf)), v.cells(spark, sf), v.features(spark, sf), 20)
    return _whole(found, "components").select("n_cells", F.round("total", 5).alias("total_square"))


@query("kmeans_clusters")
def kmeans_clusters(spark, sf):
    return embed.kmeans(embed.pca_vectors(v.representation(spark, sf), 20).select("cell_id", "features"))


def _niche_features(spark, sf):
    """Niche vectors reduced to ten components, staged for repeated fits."""
    edges = niches.drop_long_edges(write_stage(neighbours.spatial_knn(v.plane(spark, sf), 6), "edges"))
    vectors = niches.niche_vectors(v.representation(spark, sf), edges, 3)
    return write_stage(embed.pca_vectors(vectors, 10, "niche").select("cell_id", "features"), "niches")


@query("gmm_niches")
def gmm_niches(spark, sf):
    return embed.gmm_labels(_niche_features(spark, sf), (5, 7, 10, 15, 20))


@query("gmm_bic_aic")
def gmm_bic_aic(spark, sf):
    return embed.gmm_criteria(_niche_features(spark, sf), 10, (5, 7, 10, 15, 20))

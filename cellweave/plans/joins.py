"""Key joins and alignment over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import align, qc
from cellweave.plans import views as v
from cellweave.plans.registry import query


@query(
    "join_left_1to1",
    """SELECT o_orderkey AS cell_id, o_orderstatus AS stage, n_genes, total_counts, x, y FROM orders
    LEFT JOIN (SELECT cell_id, COUNT(*) AS n_genes, SUM(value) AS total_counts FROM x GROUP BY 1) m ON o_orderkey = m.cell_id
    LEFT JOIN space s ON o_orderkey = s.cell_id""",
    "x space",
)
def join_left_1to1(spark, sf):
    obs = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderstatus").alias("stage"))
    meta = v.counts(spark, sf).groupBy("cell_id").agg(F.count("*").alias("n_genes"), F.sum("value").alias("total_counts"))
    space = v.plane(spark, sf).select("cell_id", "x", "y")
    return align.left_join_one_to_one(align.left_join_one_to_one(obs, meta, ["cell_id"]), space, ["cell_id"])


@query(
    "join_left_composite",
    """SELECT a.*, price FROM (SELECT l_orderkey AS cell_id, l_partkey AS gene, l_suppkey AS fov, SUM(l_quantity) AS value
    FROM lineitem GROUP BY 1, 2, 3) a LEFT JOIN (SELECT l_orderkey AS cell_id, l_partkey AS gene, l_suppkey AS fov,
    round(SUM(l_extendedprice), 2) AS price FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3) b USING (cell_id, gene, fov)""",
)
def join_left_composite(spark, sf):
    keys = [F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene"), F.col("l_suppkey").alias("fov")]
    lines = v.table(spark, sf, "lineitem")
    left = lines.groupBy(*keys).agg(F.sum("l_quantity").alias("value"))
    right = lines.where("l_returnflag = 'R'").groupBy(*keys).agg(F.round(F.sum("l_extendedprice"), 2).alias("price"))
    return left.join(right, ["cell_id", "gene", "fov"], "left")


def _labelled(spark, sf):
    customer = v.table(spark, sf, "customer")
    twice = customer.where("c_acctbal > 0").withColumn("pos", F.col("c_custkey")).unionByName(
        customer.withColumn("c_acctbal", F.col("c_acctbal") + 1).where("c_acctbal > 0").withColumn("pos", F.col("c_custkey") + 10**12)
    )
    meta = twice.select(F.col("c_custkey").alias("donor"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("cluster_alias"), "pos")
    parc = v.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("donor"), F.col("s_name").alias("parcellation"), F.col("s_suppkey").alias("pos")
    )
    return (
        v.cells(spark, sf).select("cell_id", "donor")
        .join(align.prefixed_lookup(meta, "donor", "meta", "pos"), "donor", "left")
        .join(align.prefixed_lookup(parc, "donor", "parc", "pos"), "donor", "left")
    )


v.add_sql_view(
    "labelled",
    """SELECT cell_id, donor, CASE WHEN c_acctbal > 0 THEN c_acctbal WHEN c_acctbal + 1 > 0 THEN c_acctbal + 1 END AS meta__balance,
    CASE WHEN c_acctbal + 1 > 0 THEN c_mktsegment END AS meta__cluster_alias, s_name AS parc__parcellation
    FROM obs JOIN customer ON donor = c_custkey LEFT JOIN supplier ON donor = s_suppkey""",
    "obs",
)


@query(
    "join_lookup_prefixed",
    "SELECT cell_id, donor, round(meta__balance, 2) AS meta__balance, meta__cluster_alias, parc__parcellation FROM labelled",
    "labelled",
)
def join_lookup_prefixed(spark, sf):
    return _labelled(spark, sf).withColumn("meta__balance", F.round("meta__balance", 2))


def _chained(spark, sf):
    annotation = (
        v.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("cluster_alias"))
        .agg(F.count("*").alias("size"), F.min("c_custkey").alias("pos"))
        .where("cluster_alias <> 'MACHINERY'")
    )
    lookup = align.prefixed_lookup(annotation, "cluster_alias", "clu", "pos")
    return _labelled(spark, sf).join(
        lookup.withColumnRenamed("cluster_alias", "meta__cluster_alias"), "meta__cluster_alias", "left"
    )


v.add_sql_view(
    "chained",
    """SELECT labelled.*, n AS clu__size FROM labelled LEFT JOIN (SELECT c_mktsegment AS a, COUNT(*) AS n FROM customer
    WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1) ON a = meta__cluster_alias""",
    "labelled",
)


@query("join_lookup_chain", "SELECT cell_id, meta__cluster_alias, clu__size FROM chained", "chained")
def join_lookup_chain(spark, sf):
    return _chained(spark, sf).select("cell_id", "meta__cluster_alias", "clu__size")


@query(
    "join_match_rate",
    """SELECT lookup, k AS n_matched, n AS n_rows, round(100 * k / n, 4) AS pct_matched FROM (SELECT COUNT(*) AS n,
    COUNT(meta__cluster_alias) AS m, COUNT(parc__parcellation) AS p, COUNT(clu__size) AS c FROM chained),
    LATERAL (VALUES ('meta', m), ('parc', p), ('clu', c)) t(lookup, k)""",
    "chained",
)
def join_match_rate(spark, sf):
    out = align.match_rate(
        _chained(spark, sf), {"meta": "meta__cluster_alias", "parc": "parc__parcellation", "clu": "clu__size"}
    )
    return out.withColumn("pct_matched", F.round("pct_matched", 4))


@query(
    "join_fail_on_missing",
    """SELECT cell_id, COUNT(*) AS n_rows, COUNT(*) OVER () AS n_missing_cells FROM x WHERE cell_id NOT IN
    (SELECT cell_id FROM obs WHERE stage <> 'P') GROUP BY 1 ORDER BY 1 LIMIT 10""",
    "x obs",
)
def join_fail_on_missing(spark, sf):
    return align.missing_metadata(v.counts(spark, sf), v.cells(spark, sf).where("stage <> 'P'"))


@query(
    "align_strict",
    """SELECT sample, COUNT(*) FILTER (l AND r) AS n_shared, COUNT(*) FILTER (l AND NOT r) AS n_left_only,
    COUNT(*) FILTER (r AND NOT l) AS n_right_only, COUNT(*) FILTER (l AND r) = COUNT(*) AS aligned FROM (SELECT sample,
    cell_id % 10 <> 3 AS l, cell_id % 10 <> 7 AND c IS NOT NULL AS r FROM obs LEFT JOIN (SELECT DISTINCT cell_id AS c FROM x)
    ON c = cell_id) WHERE l OR r GROUP BY 1""",
    "x obs",
)
def align_strict(spark, sf):
    obs = v.cells(spark, sf).select("cell_id", "sample")
    seen = v.counts(spark, sf).where("cell_id % 10 <> 7").select("cell_id").distinct().join(obs, "cell_id")
    return align.key_overlap(obs.where("cell_id % 10 <> 3"), seen, "cell_id", by="sample")


@query(
    "align_intersection",
    """SELECT cell_id, rna, protein FROM (SELECT l_orderkey AS cell_id, SUM(l_quantity) AS rna FROM lineitem GROUP BY 1) JOIN
    (SELECT l_orderkey AS cell_id, round(SUM(l_extendedprice), 2) AS protein FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) USING (cell_id)""",
)
def align_intersection(spark, sf):
    lines = v.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "cell_id")
    rna = lines.groupBy("cell_id").agg(F.sum("l_quantity").alias("rna"))
    protein = lines.where("l_returnflag = 'R'").groupBy("cell_id").agg(F.round(F.sum("l_extendedprice"), 2).alias("protein"))
    left, right = align.restrict_to_shared(rna, protein, "cell_id")
    return left.join(right, "cell_id")


@query(
    "align_barcode_suffix",
    """SELECT library, 'S' || cell_id || '-1' AS barcode, CASE WHEN cell_id % 10 <> 3 THEN array_row END AS array_row FROM spots""",
    "spots",
)
def align_barcode_suffix(spark, sf):
    spots = v.lattice(spark, sf)
    barcode = F.concat(F.lit("S"), F.col("cell_id"))
    obs = spots.select("library", F.concat(barcode, F.lit("-1")).alias("barcode"))
    bare = F.col("library") % 2 == 0
    positions = spots.where("cell_id % 10 <> 3").select(
        "library", F.when(bare, barcode).otherwise(F.concat(barcode, F.lit("-1"))).alias("barcode"), "array_row"
    )
    return align.align_barcodes(obs, positions, "library")


@query(
    "order_equality_check",
    """SELECT 'by_key' AS pair, COUNT(*) AS n_left, COUNT(*) AS n_right, COUNT(*) AS n_same, TRUE AS identical FROM orders
    UNION ALL SELECT 'by_price', COUNT(*), COUNT(*), COUNT(*) FILTER (a = b), COUNT(*) = COUNT(*) FILTER (a = b) FROM
    (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS a, row_number() OVER (ORDER BY o_totalprice) AS b FROM
     (SELECT o_orderkey, o_totalprice + o_orderkey * 1e-6 AS o_totalprice FROM orders))""",
)
def order_equality_check(spark, sf):
    left = v.cells(spark, sf).select("cell_id")
    orders = v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("cell_id"), (F.col("o_totalprice") + F.col("o_orderkey") * 1e-6).alias("price")
    )
    by_key = align.same_order(left, orders.select("cell_id"), "cell_id", "cell_id", "cell_id")
    by_price = align.same_order(left, orders, "cell_id", "cell_id", "price")
    return by_key.withColumn("pair", F.lit("by_key")).unionByName(by_price.withColumn("pair", F.lit("by_price")))


@query(
    "map_labels_back",
    """SELECT cell_id, CASE WHEN total_counts >= 100 THEN 'cluster ' || (n_genes_by_counts % 3) END AS cluster FROM metrics""",
    "metrics",
)
def map_labels_back(spark, sf):
    obs = v.cells(spark, sf).select("cell_id")
    big = qc.cell_metrics(v.counts(spark, sf), obs).where("total_counts >= 100")
    subset = big.withColumn("cluster", F.concat(F.lit("cluster "), F.col("n_genes_by_counts") % 3))
    return align.map_back(obs, subset, ["cluster"])


@query(
    "probe_to_gene_agg",
    """SELECT l_orderkey AS cell_id, l_partkey AS gene, SUM(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_type <> 'PROMO' GROUP BY 1, 2""",
)
def probe_to_gene_agg(spark, sf):
    probe = F.concat_ws("_", F.lit("RTS"), "l_partkey", "l_suppkey").alias("probe")
    lines = v.table(spark, sf, "lineitem")
    counts = lines.select(F.col("l_orderkey").alias("cell_id"), probe, F.col("l_quantity").alias("count"))
    known = v.table(spark, sf, "part").where("p_type <> 'PROMO'").select(F.col("p_partkey").alias("gene"))
    kit = lines.select(probe, F.col("l_partkey").alias("gene")).distinct().join(known, "gene", "left_semi")
    return align.probes_to_genes(counts, kit, "cell_id")


@query(
    "join_sample_metadata",
    """SELECT o_orderkey AS cell_id, n_name AS sample, r_name AS genotype, n_nationkey AS replicate FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def join_sample_metadata(spark, sf):
    obs = v.cells(spark, sf).select("cell_id", "sample")
    design = (
        v.table(spark, sf, "nation").join(v.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("sample"), F.col("r_name").alias("genotype"), F.col("n_nationkey").alias("replicate"))
    )
    return obs.join(design, "sample", "left")


@query(
    "modality_panel",
    """SELECT cell_id, gene::VARCHAR AS feature, 'RNA' AS modality, value FROM x WHERE gene IN (SELECT gene FROM var WHERE size = 50)
    AND cell_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    UNION ALL SELECT l_orderkey, 'ATAC_' || l_partkey, 'ATAC', round(SUM(l_extendedprice), 2) FROM lineitem
    WHERE l_returnflag = 'R' AND l_partkey IN (SELECT gene FROM var WHERE size = 50) GROUP BY 1, 2""",
    "x var",
)
def modality_panel(spark, sf):
    lines = v.table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    atac = lines.groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("value")
    )
    panel = v.features(spark, sf).where("size = 50")
    return align.modality_panel(v.counts(spark, sf), atac, panel)

"""Scans, sinks and checks: the views are written as vendor text by Spark and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import text as names
from cellweave.operators import catalog as cat
from cellweave.operators import checks, qc
from cellweave.plans import views as v
from cellweave.plans.registry import query
from cellweave.session import scratch_path, write_stage
from cellweave.sources import manifest, sinks, text


def _csv(df, spark, label):
    path = scratch_path(spark, label)
    df.write.option("header", True).option("compression", "gzip").csv(path)
    return path


@query(
    "scan_metadata_typed",
    """SELECT o_orderkey AS "cell_ID", CASE WHEN o_custkey % 7 <> 0 THEN o_custkey::INT END AS fov, o_totalprice::FLOAT::DOUBLE
    AS "Area.um2", o_orderstatus AS "Panel" FROM orders""",
)
def scan_metadata_typed(spark, sf):
    orders = v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("cell_ID"),
        F.when(F.col("o_custkey") % 7 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("fov"),
        F.col("o_totalprice").alias("Area.um2"),
        F.col("o_orderstatus").alias("Panel"),
        F.lit("unused").alias("Run_name"),
    )
    path = _csv(orders, spark, "metadata")
    out = text.metadata_table(
        spark, path, {"cell_ID": "bigint", "fov": "int", "Area.um2": "float", "Panel": "string", "Missing": "string"}
    )
    return out.withColumn("Area.um2", F.col("`Area.um2`").cast("double"))


@query(
    "scan_wide_to_long",
    """SELECT l_orderkey % 40 || '__' || l_orderkey AS cell_key, 'G' || l_linenumber AS gene, SUM(l_quantity) AS value FROM lineitem
    GROUP BY 1, 2""",
)
def scan_wide_to_long(spark, sf):
    wide = (
        v.table(spark, sf, "lineitem")
        .groupBy((F.col("l_orderkey") % 40).alias("fov"), F.col("l_orderkey").alias("cell_ID"))
        .pivot("l_linenumber").agg(F.sum("l_quantity"))
        .fillna(0)
    )
    wide = wide.select("fov", "cell_ID", *[F.col(c).cast("int").alias(f"G{c}") for c in wide.columns[2:]])
    return text.wide_to_long(spark, _csv(wide, spark, "wide")).select("cell_key", "gene", "value")


def _ordered_text(df, spark, label, order, by=None):
    """Write the ``value`` lines of ``df`` so that part files and lines follow ``order``."""
    path = scratch_path(spark, label)
    keys = ([by] if by else []) + order
    lines = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*([by] if by else []), "value")
    writer = lines.write.partitionBy(by) if by else lines.write
    writer.text(path)
    return path


def _matrix_lines(spark, sf, x, order):
    """The count matrix as Matrix Market lines: banner, comment, size line, then 1-based entries."""
    n_genes, n_cells = qc.n_rows(v.features(spark, sf)), qc.n_rows(v.cells(spark, sf))
    head = x.agg(F.count("*").alias("nnz")).select(
        F.explode(
            F.array(
                F.struct(F.lit(-3).alias("k"), F.lit("%%MatrixMarket matrix coordinate real general").alias("value")),
                F.struct(F.lit(-2).alias("k"), F.lit("% made from the count view").alias("value")),
                F.struct(F.lit(-1).alias("k"), F.concat_ws(" ", n_genes, n_cells, "nnz").alias("value")),
            )
        ).alias("_h")
    ).select(F.col("_h.k").cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "_h.value")
    line = F.concat_ws(" ", F.col("gene") + 1, F.col("cell_id") + 1, F.col("value").cast("long"))
    first, second = order
    return head.unionByName(x.select(F.col(first).alias("a"), F.col(second).alias("b"), line.alias("value")))


def _matrix(spark, sf, x=None, order=("cell_id", "gene")):
    x = write_stage(v.counts(spark, sf), "counts") if x is None else x
    path = _ordered_text(_matrix_lines(spark, sf, x, order), spark, "matrix", ["a", "b"])
    return text.matrix_market(text.read_lines(spark, path))


@query("scan_matrix_market", "SELECT gene + 1 AS row, cell_id + 1 AS col, value FROM x", "x")
def scan_matrix_market(spark, sf):
    entries, _ = _matrix(spark, sf)
    return entries.select("row", "col", "value")


@query(
    "check_shape_match",
    """SELECT (SELECT COUNT(*) FROM var) AS n_rows, (SELECT COUNT(*) FROM obs) AS n_cols, COUNT(*) AS nnz, TRUE AS header_ok,
    COUNT(*) AS n_entries, MAX(gene) + 1 AS max_row, MAX(cell_id) + 1 AS max_col, TRUE AS valid FROM x""",
    "x var obs",
)
def check_shape_match(spark, sf):
    return text.shape_report(*_matrix(spark, sf)).drop("folder")


@query(
    "check_sorted_columns",
    """SELECT 'by_cell' AS layout, COUNT(*) AS n_entries, TRUE AS sorted FROM x UNION ALL
    SELECT 'by_gene', COUNT(*), COUNT(*) FILTER (cell_id < p) = 0 FROM (SELECT cell_id, lag(cell_id) OVER (ORDER BY gene, cell_id) AS p FROM x)""",
    "x",
)
def check_sorted_columns(spark, sf):
    x = write_stage(v.counts(spark, sf), "counts")

    def report(layout, order):
        entries, _ = _matrix(spark, sf, x, order)
        entries = write_stage(entries.select("folder", "file", "block", "seq", "col"), "columns")
        wrong = text.unordered_lines(entries, "col").select(F.count("*")).scalar()
        return entries.agg(F.count("*").alias("n_entries")).select(F.lit(layout).alias("layout"), "n_entries", (wrong == 0).alias("sorted"))

    return report("by_cell", ("cell_id", "gene")).unionByName(report("by_gene", ("gene", "cell_id")))


@query(
    "scan_10x_triplet",
    """SELECT 'BC' || cell_id AS barcode, 'ENS' || gene AS gene_id, gene_name, feature_type, value FROM x JOIN var USING (gene)""",
    "x var",
)
def scan_10x_triplet(spark, sf):
    cells = v.cells(spark, sf).select("cell_id", F.concat(F.lit("BC"), "cell_id").alias("value"))
    genes = v.features(spark, sf).select("gene", F.concat_ws("\t", F.concat(F.lit("ENS"), "gene"), "gene_name", "feature_type").alias("value"))
    barcodes = text.read_lines(spark, _ordered_text(cells, spark, "barcodes", ["cell_id"]))
    features = text.read_lines(spark, _ordered_text(genes, spark, "features", ["gene"]))
    entries, _ = _matrix(spark, sf)
    one = F.lit("sample")
    return text.triplet(
        barcodes.withColumn("folder", one), features.withColumn("folder", one), entries.withColumn("folder", one)
    ).drop("folder")


@query(
    "scan_tissue_positions",
    """SELECT layout, 'S' || cell_id AS barcode, in_tissue, array_row::INT AS array_row, array_col::INT AS array_col,
    round(pxl_row, 6) + 0.0 AS pxl_row_in_fullres, round(pxl_col, 6) + 0.0 AS pxl_col_in_fullres FROM spots,
    (SELECT unnest(['bare', 'hd', 'header']) AS layout)""",
    "spots",
)
def scan_tissue_positions(spark, sf):
    spots = v.lattice(spark, sf).select(
        F.concat(F.lit("S"), "cell_id").alias("barcode"), "in_tissue", "array_row", "array_col",
        F.round("pxl_row", 6).alias("pxl_row_in_fullres"), F.round("pxl_col", 6).alias("pxl_col_in_fullres"),
    )
    parts = []
    for layout in ("bare", "header"):
        path = scratch_path(spark, layout)
        spots.write.option("header", layout == "header").csv(path)
        parts.append(text.positions_csv(text.read_lines(spark, path)).withColumn("layout", F.lit(layout)).drop("folder"))
    path = scratch_path(spark, "hd")
    spots.withColumnsRenamed({"barcode": "Barcode", "pxl_row_in_fullres": "pixel_y", "pxl_col_in_fullres": "imageX"}).write.parquet(path)
    hd = text.standard_positions(spark.read.parquet(path)).withColumn("layout", F.lit("hd"))
    hd = hd.withColumns({"array_row": F.col("array_row").cast("int"), "array_col": F.col("array_col").cast("int")})
    return parts[0].unionByName(parts[1]).unionByName(hd)


def _profile(spark, sf):
    """One region profile per sample as text lines under its own folder."""
    counts = (
        v.counts(spark, sf).join(v.cells(spark, sf).select("cell_id", "sample"), "cell_id")
        .groupBy("sample", "gene").agg(F.sum("value").cast("int").alias("n"))
    )
    counts = write_stage(counts, "probes")
    region = F.concat(F.lit("GSM"), F.regexp_extract("sample", r"(\d+)$", 1), F.lit("_DSP"))
    reads = counts.groupBy("sample").agg(F.sum("n").alias("raw"), F.max("n").alias("aligned"))
    head = [
        "<Header>", "FileVersion,0.02", "</Header>", "", "<Scan_Attributes>", 'ID,"DSP-{s}"', "Plate_ID,P1", "</Scan_Attributes>", "",
        "<NGS_Processing_Attributes>", "Raw,{raw}", "Aligned,{aligned}", "umiQ30,0.9875", "</NGS_Processing_Attributes>", "", "<Code_Summary>",
    ]
    filled = F.array(*[F.lit(line) for line in head])
    value = F.replace(
        F.replace(F.replace(F.col("_l"), F.lit("{s}"), F.col("sample")), F.lit("{raw}"), F.col("raw").cast("string")),
        F.lit("{aligned}"), F.col("aligned").cast("string"),
    )
    top = reads.select("sample", "raw", "aligned", F.posexplode(filled).alias("_p", "_l")).select(
        region.alias("region"), (F.col("_p") - 1000).cast("long").alias("o"), value.alias("value")
    )
    body = counts.select(region.alias("region"), F.col("gene").alias("o"), F.concat(F.lit("RTS"), "gene", F.lit(","), "n").alias("value"))
    end = reads.select(region.alias("region"), F.lit(10**15).alias("o"), F.lit("</Code_Summary>").alias("value"))
    return _ordered_text(top.unionByName(body).unionByName(end), spark, "dcc", ["o"], by="region")


@query(
    "scan_dcc",
    """SELECT 'GSM' || regexp_extract(sample, '(\\d+)$', 1) AS gsm_id, 'RTS' || gene AS rts_id, SUM(value)::INT AS "count", raw AS raw_reads,
    0::BIGINT AS trimmed_reads, al AS aligned_reads, 0.9875::DOUBLE AS umi_q30, 0.0::DOUBLE AS rts_q30, 'DSP-' || sample AS scan_id,
    'P1' AS plate_id, '' AS well FROM x JOIN obs USING (cell_id) JOIN (SELECT sample, SUM(n)::BIGINT AS raw, MAX(n)::BIGINT AS al FROM
    (SELECT sample, SUM(value) AS n FROM x JOIN obs USING (cell_id) GROUP BY sample, gene) GROUP BY 1) USING (sample) GROUP BY ALL""",
    "x obs",
)
def scan_dcc(spark, sf):
    lines = text.read_lines(spark, _profile(spark, sf) + "/*")
    tagged = lines.withColumn("folder", F.regexp_replace("folder", "^region=", ""))
    fields = write_stage(text.dcc_fields(tagged), "fields")
    regions = write_stage(text.dcc_regions(fields).drop("folder"), "regions")
    return text.dcc_counts(fields).join(regions, "gsm_id")


@query(
    "scan_pkc",
    """SELECT 'RTS' || p_partkey || s AS rts_id, p_name AS gene, CASE WHEN p_type = 'PROMO' THEN 'Negative' ELSE 'Endogenous' END AS code_class
    FROM part, (SELECT unnest(['a', 'b']) AS s)""",
)
def scan_pkc(spark, sf):
    probe = lambda s: F.struct(F.concat(F.lit("RTS"), "p_partkey", F.lit(s)).alias("RTS_ID"))
    kits = v.table(spark, sf, "part").select(
        F.lit("kit").alias("Name"),
        F.array(
            F.struct(
                F.col("p_name").alias("DisplayName"),
                F.when(F.col("p_type") == "PROMO", "Negative").otherwise("Endogenous").alias("CodeClass"),
                F.array(probe("a"), probe("b")).alias("Probes"),
            )
        ).alias("Targets"),
    )
    path = scratch_path(spark, "pkc")
    kits.write.json(path, compression="gzip")
    return text.probe_kit(spark, path, multi_line=False)


@query("scan_json_metadata", "SELECT event_id, (props::JSON->>'k')::BIGINT AS k, NULL::VARCHAR AS panel_name FROM events")
def scan_json_metadata(spark, sf):
    events = v.table(spark, sf, "events").select("event_id", "props")
    return text.json_fields(events, "props", {"k": "bigint", "panel_name": "string"})


@query(
    "scan_catalog_csv",
    """SELECT filename, n_cells, n_vars, CASE WHEN n_donors % 2 = 0 THEN n_donors ELSE 0 END AS n_donors, organism, tissue
    FROM entries WHERE error IS NULL""",
    "entries",
)
def scan_catalog_csv(spark, sf):
    entries = v.catalog_entries(spark, sf).withColumn(
        "n_donors", F.when(F.col("n_donors") % 2 == 0, F.col("n_donors").cast("string")).otherwise("many")
    )
    out = cat.clean_entries(spark.read.option("header", True).csv(_csv(entries, spark, "catalog")))
    return out.select("filename", "n_cells", "n_vars", "n_donors", "organism", "tissue")


@query(
    "scan_reference_table",
    """SELECT 'sample=' || p_type AS sample, p_partkey::VARCHAR AS gene, p_name AS gene_name, p_size::VARCHAR AS counts FROM part
    WHERE p_type NOT IN ('PROMO', 'SMALL')""",
)
def scan_reference_table(spark, sf):
    part = v.table(spark, sf, "part").withColumn(
        "file", F.when(F.col("p_type").isin("PROMO", "SMALL"), "other.csv").otherwise("genes.csv")
    )
    path = scratch_path(spark, "reference")
    table = part.select(
        F.col("p_type").alias("sample"), "file", F.col("p_partkey").alias("gene"), F.col("p_name").alias("gene_name"),
        F.col("p_size").alias("counts"), F.col("p_brand").alias("unused"),
    )
    table.write.partitionBy("sample", "file").option("header", True).csv(path)
    return text.reference_tables(spark, path, "file=genes.csv", ["gene", "gene_name", "counts"])


@query(
    "scan_multi_file_tagged",
    "SELECT 'sample=' || stage AS source, COUNT(*) AS n_rows, SUM(donor)::BIGINT AS donors FROM obs GROUP BY 1",
    "obs",
)
def scan_multi_file_tagged(spark, sf):
    path = scratch_path(spark, "tagged")
    v.cells(spark, sf).withColumn("sample", F.col("stage")).write.partitionBy("sample").parquet(path)
    return text.tagged_folder(spark, path).groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("donor").alias("donors"))


@query(
    "classify_path",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'coronal' WHEN 1 THEN 'sagittal' WHEN 2 THEN 'sagittal' ELSE 'unknown' END AS orientation,
    CASE WHEN c_custkey % 4 <> 3 THEN 'GSM' || c_custkey END AS gsm, CASE c_custkey % 4 WHEN 0 THEN 'WU1_HD_CORONAL' WHEN 1 THEN 'x_Sagittal'
    WHEN 2 THEN 'y_sagital' ELSE 'plain' || c_custkey END AS specimen, CASE c_custkey % 4 WHEN 0 THEN 'Visium HD' ELSE 'Visium' END AS platform FROM customer""",
)
def classify_path(spark, sf):
    key = F.col("c_custkey")
    tail = F.when(key % 4 == 0, "WU1_HD_CORONAL").when(key % 4 == 1, "x_Sagittal").otherwise("y_sagital")
    name = F.when(key % 4 == 3, F.concat(F.lit("plain"), key)).otherwise(F.concat(F.lit("GSM"), key, F.lit("_"), tail))
    return v.table(spark, sf, "customer").select(
        "c_custkey", names.orientation(name).alias("orientation"), names.accession(name).alias("gsm"),
        names.specimen(name).alias("specimen"), names.platform(name).alias("platform"),
    )


@query(
    "pair_discovery",
    """SELECT sample, CASE WHEN r THEN sample || '_RNA' END AS first, CASE WHEN a THEN sample || '_ATAC' END AS second,
    CASE WHEN r AND a THEN 'paired' WHEN r THEN 'missing ATAC' ELSE 'missing RNA' END AS status FROM
    (SELECT s_name AS sample, s_suppkey % 5 <> 0 AS r, s_suppkey % 3 <> 0 AS a FROM supplier) WHERE r OR a""",
)
def pair_discovery(spark, sf):
    supplier = v.table(spark, sf, "supplier")
    rna = supplier.where("s_suppkey % 5 <> 0").select(F.concat("s_name", F.lit("_RNA")).alias("name"))
    atac = supplier.where("s_suppkey % 3 <> 0").select(F.concat("s_name", F.lit("_ATAC")).alias("name"))
    return manifest.pair_modalities(rna.unionByName(atac))


@query(
    "validate_sample_inputs",
    """SELECT s_name AS sample, CASE WHEN k % 6 = 0 THEN 'cells, experiment, matrix' WHEN k % 3 = 0 THEN 'experiment' WHEN k % 4 = 0 THEN 'matrix' ELSE '' END AS missing,
    CASE WHEN k % 6 = 0 THEN 'requested but absent' WHEN k % 3 <> 0 AND k % 4 <> 0 THEN 'valid' WHEN k % 2 = 0 THEN 'requested but incomplete'
    ELSE 'incomplete' END AS status FROM (SELECT s_name, s_suppkey AS k FROM supplier)""",
)
def validate_sample_inputs(spark, sf):
    supplier = v.table(spark, sf, "supplier").select(F.col("s_name").alias("sample"), F.col("s_suppkey").alias("k"))
    kinds = F.array_compact(
        F.array(F.lit("cells"), F.when(~(F.col("k") % 4 == 0), "matrix"), F.when(F.col("k") % 3 != 0, "experiment"), F.lit("image"))
    )
    files = supplier.where("k % 6 <> 0").select("sample", F.explode(kinds).alias("kind"))
    requested = supplier.where("k % 2 = 0").select("sample")
    return manifest.validate_inputs(files, requested, ["cells", "matrix", "experiment"])


@query(
    "sink_partitioned",
    "SELECT sample, COUNT(*) AS n_rows, COUNT(*) AS n_combined, SUM(donor)::BIGINT AS donors FROM obs GROUP BY 1",
    "obs",
)
def sink_partitioned(spark, sf):
    path = scratch_path(spark, "sink")
    sinks.write_samples(v.cells(spark, sf), path, "sample", per_sample=True, combined=True)
    back = spark.read.parquet(f"{path}/samples").groupBy("sample").agg(F.count("*").alias("n_rows"), F.sum("donor").alias("donors"))
    both = spark.read.parquet(f"{path}/combined").groupBy("sample").agg(F.count("*").alias("n_combined"))
    return back.join(both, "sample").select("sample", "n_rows", "n_combined", "donors")


@query(
    "sink_tables_csv",
    """SELECT 'obs' AS name, COUNT(*) AS n_rows FROM obs UNION ALL SELECT 'qc', COUNT(DISTINCT sample) FROM obs
    UNION ALL SELECT 'var', COUNT(*) FROM var""",
    "obs var",
)
def sink_tables_csv(spark, sf):
    path = scratch_path(spark, "csv")
    obs, var = v.cells(spark, sf), v.features(spark, sf)
    tables = {"obs": obs, "var": var, "qc": obs.groupBy("sample").agg(F.avg("area").alias("mean_area"))}
    sinks.write_csv_tables(tables, path)
    back = [spark.read.option("header", True).csv(f"{path}/{n}").agg(F.count("*").alias("n_rows")).withColumn("name", F.lit(n)) for n in tables]
    return back[0].unionByName(back[1]).unionByName(back[2])


@query(
    "sink_json_rows",
    """SELECT json_object('filename', filename, 'n_cells', n_cells, 'organism', organism, 'tissue', tissue)::VARCHAR AS json FROM entries""",
    "entries",
)
def sink_json_rows(spark, sf):
    entries = v.catalog_entries(spark, sf)
    return entries.select(sinks.json_rows(entries, "filename", "n_cells", "organism", "tissue").alias("json"))


@query(
    "dataset_provenance",
    """SELECT sample, n_cells, n_donors, 'sample__cell' AS cell_key, 'counts' AS layer, json_object('sample', sample, 'n_cells', n_cells,
    'n_donors', n_donors, 'cell_key', 'sample__cell', 'layer', 'counts')::VARCHAR AS record
    FROM (SELECT sample, COUNT(*) AS n_cells, COUNT(DISTINCT donor) AS n_donors FROM obs GROUP BY 1)""",
    "obs",
)
def dataset_provenance(spark, sf):
    sizes = v.cells(spark, sf).groupBy("sample").agg(F.count("*").alias("n_cells"), F.count_distinct("donor").alias("n_donors"))
    return manifest.provenance(sizes, "sample", {"cell_key": "sample__cell", "layer": "counts"})


@query(
    "check_unique_keys",
    """SELECT COUNT(*) AS n_duplicate_keys, COALESCE(SUM(n), 0)::BIGINT AS n_rows, COUNT(*) = 0 AS "unique" FROM
    (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)""",
)
def check_unique_keys(spark, sf):
    return checks.duplicate_report(v.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_required_fields",
    """SELECT field, COUNT(*) AS n_rows, SUM(m)::BIGINT AS n_missing, SUM(m) = 0 AS complete FROM (SELECT 'filename' AS field, (filename IS NULL)::INT AS m
    FROM entries UNION ALL SELECT 'sex', (sex IS NULL)::INT FROM entries UNION ALL SELECT 'publication_doi', (publication_doi IS NULL)::INT FROM entries
    UNION ALL SELECT 'library_key', 1 FROM entries) GROUP BY 1""",
    "entries",
)
def check_required_fields(spark, sf):
    return checks.required_fields(v.catalog_entries(spark, sf), ["filename", "sex", "publication_doi", "library_key"])


@query(
    "check_enough_features",
    """SELECT sample, COUNT(*) AS n_eligible, COUNT(*) >= 400 AS enough FROM (SELECT sample, gene FROM x JOIN obs USING (cell_id)
    GROUP BY 1, 2 HAVING COUNT(*) >= 2) GROUP BY 1""",
    "x obs",
)
def check_enough_features(spark, sf):
    eligible = (
        v.counts(spark, sf).join(v.cells(spark, sf).select("cell_id", "sample"), "cell_id")
        .groupBy("sample", "gene").agg(F.count("*").alias("n")).where("n >= 2")
    )
    return checks.enough(eligible, "sample", 400)


@query(
    "infer_obs_types",
    """SELECT 'key_text' AS "column", COUNT(*) AS n_values, 'numeric' AS inferred FROM orders UNION ALL SELECT 'flag', COUNT(*), 'boolean' FROM orders
    UNION ALL SELECT 'mixed', COUNT(*), 'string' FROM orders UNION ALL SELECT 'nothing', 0, 'string'
    UNION ALL SELECT 'price', COUNT(*) FILTER (o_orderstatus = 'F'), 'numeric' FROM orders""",
)
def infer_obs_types(spark, sf):
    orders = v.table(spark, sf, "orders")
    return checks.infer_types(
        orders.select(
            F.col("o_orderkey").cast("string").alias("key_text"),
            F.when(F.col("o_orderstatus") == "F", "True").otherwise("false").alias("flag"),
            F.when(F.col("o_orderstatus") == "F", "1.5").otherwise(F.col("o_orderpriority")).alias("mixed"),
            F.lit(None).cast("string").alias("nothing"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("string")).alias("price"),
        )
    )

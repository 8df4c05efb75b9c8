"""Catalogue queries over the documents and the collection documents made from the customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import text
from cellweave.operators import catalog as cat
from cellweave.plans import views as v
from cellweave.plans.registry import query


def _quoted(words):
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


v.add_sql_view("clean", "SELECT * FROM entries WHERE error IS NULL OR error = ''", "entries")
v.add_sql_view(
    "scored",
    f"""SELECT *, least(5, CASE WHEN n_donors >= 10 THEN 3 WHEN n_donors >= 5 THEN 2 WHEN n_donors >= 2 THEN 1 ELSE 0 END
    + is_spatial::INT + (trim(COALESCE(publication_doi, '')) <> '')::INT)::INT AS score FROM (SELECT *,
    len(list_filter([{_quoted(cat.SPATIAL_ASSAYS)}], lambda s: contains(lower(assay), s))) > 0 AS is_spatial FROM clean)""",
    "clean",
)
_COLORS = "MAP {" + ", ".join(f"{_quoted([a])}: '{c}'" for a, c in cat.ASSAY_COLORS.items()) + "}"
v.add_sql_view(
    "rowset",
    f"""SELECT replace(filename, '.h5ad', '') AS filename, n_cells, n_vars, n_donors, n_conditions, n_sections, organism, assay,
    COALESCE({_COLORS}[assay], '{cat.DEFAULT_COLOR}') AS assay_color, tissue, COALESCE(sex, '') AS sex, conditions,
    CASE WHEN COALESCE(publication_doi, '') <> '' THEN '<a href="https://doi.org/' || publication_doi ||
    '" target="_blank" title="' || publication_title || '">' || publication_doi || '</a>' ELSE '' END AS pub_html,
    publication_title AS pub_title, score, [{_quoted(cat.SCORE_LABELS)}][score + 1] AS score_label,
    [{_quoted(cat.SCORE_COLORS)}][score + 1] AS score_color, is_spatial FROM scored""",
    "scored",
)


def _clean(spark, sf):
    return cat.clean_entries(v.catalog_entries(spark, sf))


def _rows(spark, sf):
    return cat.table_rows(_clean(spark, sf))


@query("catalog_rows", "SELECT * FROM rowset ORDER BY n_cells DESC, filename", "rowset")
def catalog_rows(spark, sf):
    return _rows(spark, sf)


@query(
    "catalog_facets",
    """SELECT 'organism' AS facet, organism AS value FROM rowset GROUP BY 2 UNION ALL SELECT 'assay', assay FROM rowset GROUP BY 2
    UNION ALL SELECT 'max_cells', MAX(n_cells)::VARCHAR FROM rowset UNION ALL SELECT 'max_donors', MAX(n_donors)::VARCHAR FROM rowset""",
    "rowset",
)
def catalog_facets(spark, sf):
    return cat.facets(_rows(spark, sf))


@query(
    "catalog_scatter",
    """SELECT filename, greatest(n_donors::DOUBLE, 0.5) AS x, n_cells AS y, greatest(4.0::DOUBLE, (score * 2.5)::DOUBLE) AS r FROM rowset""",
    "rowset",
)
def catalog_scatter(spark, sf):
    return cat.scatter_points(_rows(spark, sf))


@query(
    "catalog_search",
    """SELECT filename, organism, assay, n_cells, n_donors, score FROM rowset WHERE is_spatial AND score >= 2 AND n_donors >= 2
    AND n_cells >= 1000 AND contains(lower(concat_ws(' ', filename, tissue, assay, organism, conditions, pub_title)), 'brain 1')
    ORDER BY score DESC, filename""",
    "rowset",
)
def catalog_search(spark, sf):
    found = cat.search(_rows(spark, sf), spatial=True, min_score=2, min_donors=2, min_cells=1000, text="Brain 1")
    return found.select("filename", "organism", "assay", "n_cells", "n_donors", "score")


@query(
    "suitability_score",
    """SELECT filename, score, [{labels}][score + 1] AS label, is_spatial FROM scored""".replace("{labels}", _quoted(cat.SCORE_LABELS)),
    "scored",
)
def suitability_score(spark, sf):
    rows = cat.scored(_clean(spark, sf))
    return rows.select("filename", "score", cat.score_text(F.col("score"), cat.SCORE_LABELS).alias("label"), "is_spatial")


@query(
    "corpus_totals",
    """SELECT COUNT(*) AS n_files, SUM(n_cells)::BIGINT AS n_cells, COUNT(*) FILTER (organism = 'Homo sapiens') AS n_human,
    COUNT(*) FILTER (organism = 'Mus musculus') AS n_mouse, COUNT(*) FILTER (is_spatial) AS n_spatial,
    COUNT(*) FILTER (score >= 4) AS n_very_good,
    (SELECT COUNT(DISTINCT trim(t)) FROM (SELECT unnest(split(tissue, ';')) AS t FROM clean)) AS n_tissues,
    (SELECT COUNT(DISTINCT trim(t)) FROM (SELECT unnest(split(assay, ';')) AS t FROM clean)) AS n_assays FROM scored""",
    "scored",
)
def corpus_totals(spark, sf):
    return cat.totals(_clean(spark, sf))


@query(
    "corpus_chart_data",
    f"""SELECT 'assay' AS chart, assay AS label, SUM(n_cells)::BIGINT AS n_cells, COALESCE({_COLORS}[assay], '{cat.DEFAULT_COLOR}') AS color
    FROM clean GROUP BY 2 UNION ALL (SELECT 'tissue', trim(split(tissue, ';')[1]) AS t, SUM(n_cells)::BIGINT AS n, NULL FROM clean
    GROUP BY 2 ORDER BY n DESC, t LIMIT 20) UNION ALL SELECT 'organism', organism, SUM(n_cells)::BIGINT, NULL FROM clean GROUP BY 2""",
    "clean",
)
def corpus_chart_data(spark, sf):
    return cat.chart_data(_clean(spark, sf))


@query(
    "corpus_row",
    """SELECT sample AS filename, n_cells, COALESCE(n_vars, 0) AS n_vars, n_donors, n_conditions, n_tissue_types, n_sections, tissue,
    sex, condition_ids, organism FROM (SELECT sample, COUNT(*) AS n_cells, COUNT(DISTINCT donor) AS n_donors,
    COUNT(DISTINCT condition) FILTER (condition <> '4-NOT SPECIFIED') AS n_conditions, COUNT(DISTINCT tissue) AS n_tissue_types,
    COUNT(DISTINCT stage) AS n_sections, string_agg(DISTINCT tissue, '; ' ORDER BY tissue) AS tissue,
    string_agg(DISTINCT stage, '; ' ORDER BY stage) AS sex,
    string_agg(DISTINCT condition, '; ' ORDER BY condition) FILTER (condition <> '4-NOT SPECIFIED') AS condition_ids,
    string_agg(DISTINCT batch, '; ' ORDER BY batch) AS organism FROM obs GROUP BY 1)
    LEFT JOIN (SELECT sample, COUNT(DISTINCT gene) AS n_vars FROM x JOIN obs USING (cell_id) GROUP BY 1) USING (sample)""",
    "x obs",
)
def corpus_row(spark, sf):
    obs = v.cells(spark, sf).withColumn(
        "condition", F.when(F.col("condition") == "4-NOT SPECIFIED", " Unknown ").otherwise(F.col("condition"))
    )
    n_vars = v.counts(spark, sf).join(obs.select("cell_id", "sample"), "cell_id").groupBy("sample").agg(
        F.count_distinct("gene").alias("n_vars")
    )
    return cat.corpus_rows(
        obs,
        "sample",
        {"tissue": "tissue", "sex": "stage", "condition_ids": "condition", "organism": "batch"},
        {"n_donors": "donor", "n_conditions": "condition", "n_tissue_types": "tissue", "n_sections": "stage"},
        n_vars,
    ).withColumnRenamed("sample", "filename")


def collections(spark, sf):
    """JSON collection documents, one per customer, with one to three data sets each."""
    key = F.col("c_custkey")
    label = lambda *names: F.array(*[F.struct(n.alias("label")) for n in names])

    def dataset(i):
        name = F.concat(F.lit("D"), key, F.lit("-"), i)
        visium = (key + i) % 2 == 0
        return F.struct(
            name.alias("dataset_id"),
            F.concat(name, F.lit("-v1")).alias("dataset_version_id"),
            F.concat(F.lit("Title "), i).alias("title"),
            (key * 10 + i).alias("cell_count"),
            F.concat(F.lit("explore/"), name).alias("explorer_url"),
            F.when(visium, label(F.lit("Visium Spatial Gene Expression"), F.lit("10x 3' v3"))).otherwise(label(F.lit("Xenium"))).alias("assay"),
            label(F.col("c_mktsegment")).alias("tissue"),
            F.when(i == 1, label(F.lit("Homo sapiens"))).otherwise(label(F.lit("Homo sapiens"), F.lit("Mus musculus"))).alias("organism"),
            label(F.lit("normal")).alias("disease"),
            F.when(
                i < 3,
                F.array(
                    F.struct(F.lit("RDS").alias("filetype"), F.concat(name, F.lit(".rds")).alias("url"), F.lit(5).cast("long").alias("filesize")),
                    F.struct(F.lit("H5AD").alias("filetype"), F.concat(name, F.lit(".h5ad")).alias("url"), (key * 1300000 + 50000).alias("filesize")),
                ),
            ).alias("assets"),
        )

    # a customer is few bytes and its document many, so the rows are dealt out before the documents are made
    return v.table(spark, sf, "customer").repartition("c_custkey").select(
        F.to_json(
            F.struct(
                F.concat(F.lit("C"), key).alias("collection_id"),
                F.concat(F.lit(" Atlas: "), F.col("c_name"), F.lit(" (v 1)!_")).alias("name"),
                F.when(key % 4 != 0, F.concat(F.lit("10.1/"), key)).alias("doi"),
                F.concat(F.lit("coll/"), key).alias("collection_url"),
                F.when(key % 3 != 0, F.struct(F.lit("Journal").alias("journal"))).alias("publisher_metadata"),
                F.array(
                    F.struct(F.lit("RAW_DATA").alias("link_type"), F.concat(F.lit("raw/"), key).alias("link_url")),
                    F.struct(F.lit("OTHER").alias("link_type"), F.lit("other").alias("link_url")),
                    F.struct(F.lit("RAW_DATA").alias("link_type"), F.lit("raw/extra").alias("link_url")),
                ).alias("links"),
                F.transform(F.sequence(F.lit(1).cast("long"), key % 3 + 1), dataset).alias("datasets"),
            )
        ).alias("json")
    )


v.add_sql_view(
    "sets",
    """SELECT c_custkey AS k, i, 'D' || c_custkey || '-' || i AS dataset_id, 'C' || c_custkey AS collection_id,
    ' Atlas: ' || c_name || ' (v 1)!_' AS name, c_mktsegment AS tissue, 'Atlas_' || replace(c_name, '#', '') || '_v_1' AS folder,
    CASE WHEN c_custkey % 4 <> 0 THEN '10.1/' || c_custkey ELSE '' END AS doi,
    CASE WHEN i = 1 THEN 'Homo sapiens' ELSE 'Homo sapiens, Mus musculus' END AS organism,
    CASE WHEN i < 3 THEN 'D' || c_custkey || '-' || i || '.h5ad' END AS h5ad_url,
    CASE WHEN i < 3 THEN round((c_custkey * 1300000 + 50000) / 1e6, 1) END AS h5ad_size_mb
    FROM customer, LATERAL (SELECT unnest(range(1, c_custkey % 3 + 2)) AS i) WHERE (c_custkey + i) % 2 = 0""",
)


@query(
    "api_flatten",
    """SELECT collection_id, name AS collection_name, dataset_id, dataset_id || '-v1' AS dataset_version_id,
    'Visium Spatial Gene Expression, 10x 3'' v3' AS assay, tissue, organism FROM sets""",
    "sets",
)
def api_flatten(spark, sf):
    return cat.assay_hits(collections(spark, sf))


def _catalog(spark, sf):
    docs = collections(spark, sf)
    return cat.build_catalog(docs, cat.assay_hits(docs))


@query(
    "catalog_build",
    """SELECT dataset_id, collection_id, 'Title ' || i AS title, name AS collection, doi,
    CASE WHEN k % 3 <> 0 THEN 'Journal' ELSE '' END AS journal, 'coll/' || k AS collection_url, 'raw/' || k || ', raw/extra' AS raw_data_links,
    organism, tissue, 'normal' AS disease, k * 10 + i AS cell_count, 'Visium Spatial Gene Expression, 10x 3'' v3' AS assay,
    h5ad_url, h5ad_size_mb, 'explore/' || dataset_id AS explorer_url FROM sets""",
    "sets",
)
def catalog_build(spark, sf):
    return _catalog(spark, sf)


@query(
    "catalog_size_report",
    """SELECT 'total' AS section, 'n_datasets' AS label, COUNT(*)::DOUBLE AS value FROM sets
    UNION ALL SELECT 'total', 'total_gb', round(SUM(h5ad_size_mb) / 1000, 1) FROM sets
    UNION ALL SELECT 'organism', organism, COUNT(*)::DOUBLE FROM sets GROUP BY 2
    UNION ALL (SELECT 'tissue', tissue, COUNT(*)::DOUBLE AS n FROM sets GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)""",
    "sets",
)
def catalog_size_report(spark, sf):
    return cat.size_report(_catalog(spark, sf))


@query(
    "transfer_plan_counts",
    """SELECT collection_id, folder, doi, COUNT(*) AS n_datasets,
    COUNT(*) FILTER (h5ad_url IS NOT NULL AND i = 1 AND k % 5 = 0) AS n_present,
    COUNT(*) FILTER (h5ad_url IS NOT NULL AND NOT (i = 1 AND k % 5 = 0)) AS n_to_fetch,
    COUNT(*) FILTER (h5ad_url IS NULL) AS n_no_url FROM sets GROUP BY 1, 2, 3""",
    "sets",
)
def transfer_plan_counts(spark, sf):
    files = v.table(spark, sf, "customer").where("c_custkey % 5 = 0").select(
        F.concat(F.lit("Atlas_"), F.replace("c_name", F.lit("#"), F.lit("")), F.lit("_v_1")).alias("folder"),
        F.concat(F.lit("D"), "c_custkey", F.lit("-1.h5ad")).alias("file"),
    )
    return cat.transfer_plan(_catalog(spark, sf), files)


@query(
    "split_first_token",
    """SELECT filename, trim(split(tissue, ';')[1]) AS first_tissue, split(filename, '_')[1] AS condition, trim(t) AS token
    FROM (SELECT filename, tissue, unnest(split(tissue, ';')) AS t FROM entries)""",
    "entries",
)
def split_first_token(spark, sf):
    return v.catalog_entries(spark, sf).select(
        "filename",
        text.first_token(F.col("tissue")).alias("first_tissue"),
        F.split("filename", "_")[0].alias("condition"),
        F.explode(text.tokens(F.col("tissue"))).alias("token"),
    )


@query(
    "humanize_count",
    """SELECT filename, n, CASE WHEN n >= 1000000 THEN printf('%.2fM', ((n * 100 + 500000) // 1000000) / 100)
    WHEN n >= 1000 THEN printf('%.1fk', ((n * 10 + 500) // 1000) / 10) ELSE n::VARCHAR END AS shown
    FROM (SELECT filename, unnest([n_cells, n_vars, n_cells * 100]) AS n FROM entries)""",
    "entries",
)
def humanize_count(spark, sf):
    numbers = v.catalog_entries(spark, sf).select(
        "filename", F.explode(F.array("n_cells", "n_vars", F.col("n_cells") * 100)).alias("n")
    )
    return numbers.withColumn("shown", text.short_count(F.col("n")))

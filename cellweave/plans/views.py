"""Domain views over the given tables, once for Spark and once as SQL text.

Cells are orders, genes are parts, and the counts are the summed line
quantities; the embeddings give a representation and a plane per library; the
documents give a catalogue of data sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def counts(spark: SparkSession, sf: str) -> DataFrame:
    """x(cell_id, gene, value): summed quantity per order and part."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene"))
        .agg(F.sum("l_quantity").alias("value"))
    )


def intensity(spark: SparkSession, sf: str) -> DataFrame:
    """The second modality on the same keys: summed price, continuous."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene"))
        .agg(F.sum("l_extendedprice").alias("value"))
    )


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """obs: one row per order with its sample, batch, condition, donor and stage."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("o_orderkey").alias("cell_id"),
            F.col("n_name").alias("sample"),
            F.col("r_name").alias("batch"),
            F.col("o_orderpriority").alias("condition"),
            F.col("o_custkey").alias("donor"),
            F.col("o_orderstatus").alias("stage"),
            F.col("c_mktsegment").alias("tissue"),
            F.col("o_totalprice").alias("area"),
        )
    )


def features(spark: SparkSession, sf: str) -> DataFrame:
    """var: one row per part; names repeat, 'blue' names play the mitochondrial genes."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("gene"),
        F.col("p_name").alias("gene_name"),
        F.col("p_type").alias("feature_type"),
        F.col("p_brand").alias("genome"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("score"),
        F.col("p_name").startswith("blue").alias("is_mt"),
    )


def plane(spark: SparkSession, sf: str) -> DataFrame:
    """space(cell_id, library, x, y) from the first two vector entries."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("cell_id"),
        F.col("label").alias("library"),
        F.col("embedding")[0].cast("double").alias("x"),
        F.col("embedding")[1].cast("double").alias("y"),
    )


def representation(spark: SparkSession, sf: str) -> DataFrame:
    """rep(cell_id, library, vec): the whole vectors as doubles."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("cell_id"),
        F.col("label").alias("library"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )


def lattice(spark: SparkSession, sf: str) -> DataFrame:
    """spots(cell_id, library, array_row, array_col, in_tissue) on hexagonal rows of 20 spots."""
    row = F.floor(F.col("vec_id") / 20)
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("cell_id"),
        F.col("label").alias("library"),
        row.cast("long").alias("array_row"),
        (2 * (F.col("vec_id") % 20) + row % 2).cast("long").alias("array_col"),
        F.when(F.col("label") < 7, 1).otherwise(0).alias("in_tissue"),
        (F.col("embedding")[0].cast("double") * 1000).alias("pxl_col"),
        (F.col("embedding")[1].cast("double") * 1000).alias("pxl_row"),
    )


# Assay names given to the catalogue's data sets, by data set number modulo five.
ASSAYS = ["Xenium", "MERFISH", "10x 3' v3", "Visium; 10x 3' v2", "bulk"]


def catalog_entries(spark: SparkSession, sf: str) -> DataFrame:
    """One catalogue row per source and language of the documents.

    The file name, the assay, the tissue list and the DOI are made from the
    source number; every third source has no DOI, every seventh an error.
    """
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("long")
    return (
        docs.groupBy("source", "lang")
        .agg(
            F.sum("n_chars").alias("n_cells"),
            F.count("*").alias("n_vars"),
            F.sum(F.coalesce(F.col("quality"), F.lit(0))).cast("long").alias("n_donors"),
            F.count_distinct("toxic").alias("n_conditions"),
            F.count("quality").alias("n_sections"),
        )
        .select(
            F.concat_ws("_", "source", "lang", F.lit("atlas.h5ad")).alias("filename"),
            "n_cells",
            "n_vars",
            "n_donors",
            "n_conditions",
            "n_sections",
            F.element_at(F.array(*[F.lit(a) for a in ASSAYS]), (number % 5 + 1).cast("int")).alias("assay"),
            F.when(F.col("lang") == "en", "Homo sapiens")
            .when(F.col("lang") == "de", "Mus musculus")
            .otherwise(F.col("lang"))
            .alias("organism"),
            F.concat(F.lit("brain "), number % 3, F.lit("; "), F.lit(" liver "), number % 4).alias("tissue"),
            F.when(number % 2 == 0, "male").alias("sex"),
            F.concat(F.lit("cond"), number).alias("conditions"),
            F.when(number % 3 != 0, F.concat(F.lit("10.1000/"), number)).otherwise(
                F.when(number % 2 == 0, "").otherwise(F.lit(None))
            ).alias("publication_doi"),
            F.concat(F.lit("Paper "), number).alias("publication_title"),
            F.when(number % 7 == 6, "cannot open").alias("error"),
        )
    )


# The same views for DuckDB.
SQL_VIEWS = {
    "x": "SELECT l_orderkey AS cell_id, l_partkey AS gene, SUM(l_quantity) AS value FROM lineitem GROUP BY 1, 2",
    "px": "SELECT l_orderkey AS cell_id, l_partkey AS gene, SUM(l_extendedprice) AS value FROM lineitem GROUP BY 1, 2",
    "obs": """SELECT o_orderkey AS cell_id, n_name AS sample, r_name AS batch, o_orderpriority AS condition,
        o_custkey AS donor, o_orderstatus AS stage, c_mktsegment AS tissue, o_totalprice AS area
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "var": """SELECT p_partkey AS gene, p_name AS gene_name, p_type AS feature_type, p_brand AS genome, p_size AS size,
        p_retailprice AS score, starts_with(p_name, 'blue') AS is_mt FROM part""",
    "space": """SELECT vec_id AS cell_id, label AS library, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y
        FROM embeddings""",
    "rep": "SELECT vec_id AS cell_id, label AS library, embedding::DOUBLE[] AS vec FROM embeddings",
    "spots": """SELECT vec_id AS cell_id, label AS library, vec_id // 20 AS array_row,
        2 * (vec_id % 20) + (vec_id // 20) % 2 AS array_col, CASE WHEN label < 7 THEN 1 ELSE 0 END AS in_tissue,
        embedding[1]::DOUBLE * 1000 AS pxl_col, embedding[2]::DOUBLE * 1000 AS pxl_row FROM embeddings""",
    "entries": """SELECT source || '_' || lang || '_atlas.h5ad' AS filename, n_cells, n_vars, n_donors, n_conditions,
        n_sections,
        ['Xenium', 'MERFISH', '10x 3'' v3', 'Visium; 10x 3'' v2', 'bulk'][num % 5 + 1] AS assay,
        CASE lang WHEN 'en' THEN 'Homo sapiens' WHEN 'de' THEN 'Mus musculus' ELSE lang END AS organism,
        'brain ' || (num % 3) || ';  liver ' || (num % 4) AS tissue,
        CASE WHEN num % 2 = 0 THEN 'male' END AS sex,
        'cond' || num AS conditions,
        CASE WHEN num % 3 <> 0 THEN '10.1000/' || num WHEN num % 2 = 0 THEN '' END AS publication_doi,
        'Paper ' || num AS publication_title,
        CASE WHEN num % 7 = 6 THEN 'cannot open' END AS error
        FROM (SELECT source, lang, regexp_extract(source, '(\\d+)$', 1)::BIGINT AS num, SUM(n_chars)::BIGINT AS n_cells,
            COUNT(*) AS n_vars, SUM(COALESCE(quality, 0))::BIGINT AS n_donors, COUNT(DISTINCT toxic) AS n_conditions,
            COUNT(quality) AS n_sections
            FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2)""",
}

# Views that stand on other views.
SQL_NEEDS: dict[str, list[str]] = {}


def add_sql_view(name: str, sql: str, needs: str = "") -> None:
    """Name a further SQL view for use in oracles."""
    SQL_VIEWS[name] = sql
    SQL_NEEDS[name] = needs.split()


def with_views(names: list[str], body: str) -> str:
    """Put the named views, and those they stand on, in front of ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in SQL_NEEDS.get(name, []):
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    head = ",\n".join(f"{name} AS ({SQL_VIEWS[name]})" for name in ordered)
    return f"WITH {head}\n{body}"

"""Scalar expressions over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import numeric, text
from cellweave.plans import views as v
from cellweave.plans.registry import query


@query(
    "key_build",
    """SELECT cell_id, trim(sample) || '__' || cell_id AS cell_key, 'fov_' || lpad(donor::VARCHAR, greatest(3, length(donor::VARCHAR))::INT, '0')
    AS fov_key, sample || '_' || batch AS section_id FROM obs""",
    "obs",
)
def key_build(spark, sf):
    obs = v.cells(spark, sf)
    return obs.select(
        "cell_id",
        text.cell_key(F.concat(F.lit(" "), F.col("sample"), F.lit(" ")), F.col("cell_id")).alias("cell_key"),
        text.padded_fov(F.col("donor")).alias("fov_key"),
        F.concat_ws("_", "sample", "batch").alias("section_id"),
    )


@query(
    "title_sample_extract",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN substr(c_name, 1, 8) ELSE 'PSC' || c_custkey || '_A1' END AS sample_id FROM customer""",
)
def title_sample_extract(spark, sf):
    key = F.col("c_custkey")
    titled = v.table(spark, sf, "customer").withColumn(
        "title",
        F.when(key % 3 == 0, F.concat(F.lit("Liver sample "), key, F.lit(" tail end")))
        .otherwise(F.concat(F.lit("Liver section, sample  PSC"), key, F.lit("_A1"))),
    )
    return titled.select("c_custkey", text.sample_from_title(F.col("title"), F.col("c_name")).alias("sample_id"))


@query(
    "sanitize_folder_name",
    r"""SELECT doc_id, regexp_replace(substr(regexp_replace(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'),
    '[^\p{L}\p{N}_\s\-]', '', 'g'), '\s+', '_', 'g'), 1, 80), '_+$', '') AS folder FROM documents""",
)
def sanitize_folder_name(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", text.folder_name(F.col("text")).alias("folder"))


@query(
    "query_from_stem",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0
    THEN NULL ELSE 'Smith 2021 ' || c_name END AS query FROM customer""",
)
def query_from_stem(spark, sf):
    segment = F.col("c_mktsegment")
    stem = (
        F.when(segment == "BUILDING", F.concat(F.lit("10xGenomics_"), "c_name"))
        .when(segment == "MACHINERY", F.concat(F.lit("Vizgen-demo_"), "c_name"))
        .when((segment == "HOUSEHOLD") & (F.col("c_custkey") % 2 == 0), F.concat(F.lit("2021-"), "c_name"))
        .otherwise(F.concat(F.lit("Smith-2021_"), "c_name"))
    )
    return v.table(spark, sf, "customer").select("c_custkey", text.query_from_stem(stem).alias("query"))


@query(
    "px_to_um",
    """SELECT cell_id, library, round(x * 0.12, 6) + 0.0 AS x_um, round(MAX(y) OVER (PARTITION BY library) - y, 6) AS y_flipped FROM space""",
    "space",
)
def px_to_um(spark, sf):
    flipped = numeric.flip_y(v.plane(spark, sf), "library")
    return flipped.select(
        "cell_id", "library", (F.round(numeric.to_um(F.col("x")), 6) + 0.0).alias("x_um"), F.round("y_flipped", 6).alias("y_flipped")
    )


@query("arcsinh_scale", "SELECT cell_id, gene, round(asinh(value / 5), 4) AS scaled FROM px", "px")
def arcsinh_scale(spark, sf):
    return v.intensity(spark, sf).select("cell_id", "gene", F.round(numeric.arcsinh(F.col("value")), 4).alias("scaled"))


@query("log1p_counts", "SELECT cell_id, gene, round(ln(1 + value), 6) AS lognorm FROM x", "x")
def log1p_counts(spark, sf):
    return v.counts(spark, sf).select("cell_id", "gene", F.round(F.log1p("value"), 6).alias("lognorm"))

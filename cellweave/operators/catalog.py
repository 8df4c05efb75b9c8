"""The data-set catalogue: rows, totals, scores, search and the collection documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.text import first_token, folder_name, tokens
from cellweave.session import write_stage

# Assay names that count as spatial, matched as lower-case substrings.
SPATIAL_ASSAYS = [
    "xenium", "merfish", "seqfish", "starmap", "codex", "visium", "slideseq", "slide-seq", "stereo-seq", "stereoseq",
    "resolve", "cosmx", "merscope", "10x xenium",
]

# Chart colour per assay, and the colour of all others.
ASSAY_COLORS = {
    "Xenium": "#4f8ef7",
    "MERFISH": "#f97b4f",
    "10x 3' v2": "#4fc47e",
    "10x 3' v3": "#a78bfa",
    "10x 5' v2": "#f472b6",
    "10x transcription profiling": "#34d399",
    "10x 3' transcription profiling": "#60a5fa",
    "10x 5' transcription profiling": "#fb923c",
    "10x 3' v2; 10x 3' v3": "#94a3b8",
}
DEFAULT_COLOR = "#94a3b8"

# Label and colour per score, from 0 up.
SCORE_LABELS = ["Limited", "Limited", "Moderate", "Good", "Very good", "Excellent"]
SCORE_COLORS = ["#64748b", "#94a3b8", "#f97b4f", "#fbbf24", "#86efac", "#4fc47e"]

# Texts that stand for a missing value, after lower-casing and trimming.
TRIVIAL = ["nan", "unknown", "na", "n/a", ""]

NUMBER_COLUMNS = ["n_cells", "n_vars", "n_donors", "n_conditions", "n_tissue_types", "n_sections"]


def clean_entries(catalog: DataFrame) -> DataFrame:
    """Numbers coerced, missing to 0; rows with an error left out."""
    numbers = {
        c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).cast("long") for c in NUMBER_COLUMNS if c in catalog.columns
    }
    return catalog.withColumns(numbers).where(F.col("error").isNull() | (F.col("error") == ""))


def is_spatial(assay: Column) -> Column:
    low = F.lower(F.coalesce(assay, F.lit("")))
    return F.exists(F.array(*[F.lit(s) for s in SPATIAL_ASSAYS]), lambda s: low.contains(s))


def suitability(donors: Column, assay: Column, doi: Column) -> Column:
    """0 to 5: up to three points for donors, one for a spatial assay, one for a DOI."""
    by_donors = F.when(donors >= 10, 3).when(donors >= 5, 2).when(donors >= 2, 1).otherwise(0)
    has_doi = F.trim(F.coalesce(doi, F.lit(""))) != ""
    return F.least(F.lit(5), by_donors + is_spatial(assay).cast("int") + has_doi.cast("int"))


def score_text(score: Column, texts: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in texts]), score + 1)


def assay_color(assay: Column) -> Column:
    pairs = [F.lit(part) for pair in ASSAY_COLORS.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), assay), F.lit(DEFAULT_COLOR))


def scored(entries: DataFrame) -> DataFrame:
    score = suitability(F.col("n_donors"), F.col("assay"), F.col("publication_doi"))
    return entries.withColumn("score", score).withColumn("is_spatial", is_spatial(F.col("assay")))


def table_rows(entries: DataFrame) -> DataFrame:
    """Catalogue rows by cells, largest first, with label, colours and link text."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    doi, title = text("publication_doi"), text("publication_title")
    link = F.when(
        doi != "",
        F.concat(
            F.lit('<a href="https://doi.org/'), doi, F.lit('" target="_blank" title="'), title, F.lit('">'), doi, F.lit("</a>")
        ),
    ).otherwise("")
    return scored(entries).select(
        F.replace("filename", F.lit(".h5ad"), F.lit("")).alias("filename"),
        *[c for c in NUMBER_COLUMNS if c in entries.columns],
        text("organism").alias("organism"),
        text("assay").alias("assay"),
        assay_color(text("assay")).alias("assay_color"),
        text("tissue").alias("tissue"),
        text("sex").alias("sex"),
        text("conditions").alias("conditions"),
        link.alias("pub_html"),
        title.alias("pub_title"),
        "score",
        score_text(F.col("score"), SCORE_LABELS).alias("score_label"),
        score_text(F.col("score"), SCORE_COLORS).alias("score_color"),
        "is_spatial",
    ).orderBy(F.desc("n_cells"), "filename")


def search(
    rows: DataFrame,
    organism: str | None = None,
    assay: str | None = None,
    spatial: bool | None = None,
    min_score: int | None = None,
    min_donors: int = 0,
    min_cells: int = 0,
    text: str = "",
    sort: str = "score",
    descending: bool = True,
) -> DataFrame:
    """Rows that meet all given conditions, sorted by any column."""
    kept = rows.where((F.col("n_donors") >= min_donors) & (F.col("n_cells") >= min_cells))
    if organism:
        kept = kept.where(F.col("organism") == organism)
    if assay:
        kept = kept.where(F.col("assay") == assay)
    if spatial is not None:
        kept = kept.where(F.col("is_spatial") == F.lit(spatial))
    if min_score is not None:
        kept = kept.where(F.col("score") >= min_score)
    if text:
        hay = F.lower(F.concat_ws(" ", "filename", "tissue", "assay", "organism", "conditions", "pub_title"))
        kept = kept.where(hay.contains(text.lower()))
    return kept.orderBy(F.desc(sort) if descending else F.asc(sort), "filename")


def facets(rows: DataFrame) -> DataFrame:
    """Distinct organisms and assays, and the largest cell and donor numbers."""
    values = [
        rows.where(F.col(c) != "").select(F.lit(c).alias("facet"), F.col(c).alias("value")).distinct()
        for c in ("organism", "assay")
    ]
    ends = rows.agg(F.max("n_cells").alias("max_cells"), F.max("n_donors").alias("max_donors"))
    largest = ends.select(F.col("max_cells").cast("string").alias("max_cells"), F.col("max_donors").cast("string").alias("max_donors"))
    return (
        values[0].unionByName(values[1])
        .unionByName(largest.unpivot([], ["max_cells", "max_donors"], "facet", "value"))
        .orderBy("facet", "value")
    )


def scatter_points(rows: DataFrame) -> DataFrame:
    """Bubble chart points: donors (at least 0.5), cells, and a size from the score."""
    return rows.select(
        "filename",
        F.greatest(F.col("n_donors").cast("double"), F.lit(0.5)).alias("x"),
        F.col("n_cells").alias("y"),
        F.greatest(F.lit(4.0), F.col("score") * 2.5).alias("r"),
    )


def totals(entries: DataFrame) -> DataFrame:
    """One row of corpus totals."""
    base = scored(entries).agg(
        F.count("*").alias("n_files"),
        F.sum("n_cells").alias("n_cells"),
        F.count_if(F.col("organism") == "Homo sapiens").alias("n_human"),
        F.count_if(F.col("organism") == "Mus musculus").alias("n_mouse"),
        F.count_if(F.col("is_spatial")).alias("n_spatial"),
        F.count_if(F.col("score") >= 4).alias("n_very_good"),
    )
    parts = {
        f"n_{c}s": entries.select(F.explode(tokens(F.col(c))).alias("_t")).select(F.count_distinct("_t")).scalar()
        for c in ("tissue", "assay")
    }
    return base.withColumns(parts)


def chart_data(entries: DataFrame, top_tissues: int = 20) -> DataFrame:
    """Cells by assay, by first tissue token (largest ones) and by organism."""

    def by(label: Column, chart: str) -> DataFrame:
        return (
            entries.select(label.alias("label"), "n_cells").where(F.col("label").isNotNull())
            .groupBy("label").agg(F.sum("n_cells").alias("n_cells"))
            .select(F.lit(chart).alias("chart"), "label", "n_cells")
        )

    tissue = by(first_token(F.col("tissue")), "tissue").orderBy(F.desc("n_cells"), "label").limit(top_tissues)
    return (
        by(F.col("assay"), "assay").unionByName(tissue).unionByName(by(F.col("organism"), "organism"))
        .withColumn("color", F.when(F.col("chart") == "assay", assay_color(F.col("label"))))
        .orderBy("chart", F.desc("n_cells"), "label")
    )


def corpus_rows(
    obs: DataFrame, key: str, listed: dict[str, str], counted: dict[str, str], n_vars: DataFrame | None = None
) -> DataFrame:
    """One catalogue row per data set from its cells.

    ``listed`` maps output names to columns whose distinct non-trivial values are
    joined with ``"; "`` in sorted order; ``counted`` maps output names to
    columns whose distinct non-trivial values are counted.  Values are made
    distinct by a shuffle on (data set, column, value) before they are listed.
    """
    sizes = obs.groupBy(key).agg(F.count("*").alias("n_cells"))
    columns = sorted({*listed.values(), *counted.values()})
    long = obs.unpivot([key], [F.col(c).cast("string").alias(c) for c in columns], "_c", "_v")
    distinct = long.where(F.col("_v").isNotNull() & ~F.lower(F.trim("_v")).isin(TRIVIAL)).distinct()
    numbers = distinct.groupBy(key).agg(
        *[F.count_if(F.col("_c") == c).alias(out) for out, c in counted.items()]
    )
    names = distinct.where(F.col("_c").isin(list(listed.values()))).groupBy(key).agg(
        *[
            F.array_join(F.array_sort(F.collect_list(F.when(F.col("_c") == c, F.col("_v")))), "; ").alias(out)
            for out, c in listed.items()
        ]
    )
    out = sizes.join(numbers, key, "left").join(names, key, "left")
    if n_vars is not None:
        out = out.join(n_vars, key, "left")
    return out.fillna(0).fillna("")


# The parts of a collection document that are read.
_LABELS = "array<struct<label: string>>"
COLLECTION_SCHEMA = (
    "collection_id string, name string, doi string, collection_url string, "
    "publisher_metadata struct<journal: string>, links array<struct<link_type: string, link_url: string>>, "
    "datasets array<struct<dataset_id: string, dataset_version_id: string, title: string, cell_count: bigint, "
    f"explorer_url: string, assay: {_LABELS}, tissue: {_LABELS}, organism: {_LABELS}, disease: {_LABELS}, "
    "assets: array<struct<filetype: string, url: string, filesize: bigint>>>>"
)


def _joined(labels: str) -> Column:
    return F.array_join(F.transform(F.col(labels), lambda s: F.coalesce(s["label"], F.lit(""))), ", ")


def flatten_collections(documents: DataFrame, column: str = "json") -> DataFrame:
    """One row per data set of the JSON collection documents."""
    parsed = documents.select(F.from_json(column, COLLECTION_SCHEMA).alias("c"))
    return parsed.select("c", F.explode("c.datasets").alias("d"))


def has_assay(word: str) -> Column:
    return F.exists(F.col("d.assay"), lambda a: F.lower(a["label"]).contains(word))


def assay_hits(documents: DataFrame, word: str = "visium") -> DataFrame:
    """Data sets any of whose assay labels contain the word."""
    return flatten_collections(documents).where(has_assay(word)).select(
        "c.collection_id", F.col("c.name").alias("collection_name"), "d.dataset_id", "d.dataset_version_id",
        _joined("d.assay").alias("assay"), _joined("d.tissue").alias("tissue"), _joined("d.organism").alias("organism"),
    )


def build_catalog(documents: DataFrame, hits: DataFrame) -> DataFrame:
    """Full rows of the selected data sets, with the first H5AD asset and the raw-data links."""
    h5ad = F.try_element_at(F.filter(F.col("d.assets"), lambda a: a["filetype"] == "H5AD"), F.lit(1))
    raw = F.filter(F.col("c.links"), lambda k: k["link_type"] == "RAW_DATA")
    rows = flatten_collections(documents).join(
        hits.select(F.col("dataset_id").alias("_id")).distinct(), F.col("d.dataset_id") == F.col("_id"), "left_semi"
    )
    return rows.select(
        "d.dataset_id",
        "c.collection_id",
        F.coalesce("d.title", F.lit("")).alias("title"),
        F.col("c.name").alias("collection"),
        F.coalesce("c.doi", F.lit("")).alias("doi"),
        F.coalesce("c.publisher_metadata.journal", F.lit("")).alias("journal"),
        F.coalesce("c.collection_url", F.lit("")).alias("collection_url"),
        F.array_join(F.transform(raw, lambda k: k["link_url"]), ", ").alias("raw_data_links"),
        _joined("d.organism").alias("organism"),
        _joined("d.tissue").alias("tissue"),
        _joined("d.disease").alias("disease"),
        "d.cell_count",
        _joined("d.assay").alias("assay"),
        h5ad["url"].alias("h5ad_url"),
        F.round(h5ad["filesize"] / 1e6, 1).alias("h5ad_size_mb"),
        "d.explorer_url",
    )


def size_report(catalog: DataFrame, top_tissues: int = 10) -> DataFrame:
    """Number of data sets, total size in GB, counts by organism and the largest tissues.

    What is counted is written first, so the three parts do not read the documents anew.
    """
    catalog = write_stage(catalog.select("organism", "tissue", "h5ad_size_mb"), "sizes")
    whole = catalog.agg(
        F.count("*").cast("double").alias("n_datasets"),
        F.round(F.coalesce(F.sum("h5ad_size_mb"), F.lit(0.0)) / 1000, 1).alias("total_gb"),
    ).unpivot([], ["n_datasets", "total_gb"], "label", "value").withColumn("section", F.lit("total"))
    organism = catalog.groupBy(F.col("organism").alias("label")).agg(F.count("*").cast("double").alias("value"))
    tissue = (
        catalog.groupBy(F.col("tissue").alias("label")).agg(F.count("*").cast("double").alias("value"))
        .orderBy(F.desc("value"), "label").limit(top_tissues)
    )
    return (
        whole.unionByName(organism.withColumn("section", F.lit("organism")))
        .unionByName(tissue.withColumn("section", F.lit("tissue")))
    )


def transfer_plan(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Per collection: files already there, still to fetch and without a URL, with folder and DOI.

    ``files`` lists existing files as ``(folder, file)``.
    """
    placed = catalog.withColumn("folder", folder_name(F.col("collection"))).withColumn(
        "file", F.concat("dataset_id", F.lit(".h5ad"))
    )
    there = files.select("folder", "file").distinct().withColumn("_there", F.lit(True))
    status = (
        F.when(F.col("h5ad_url").isNull(), "no_url").when(F.col("_there"), "present").otherwise("to_fetch")
    )
    return (
        placed.join(there, ["folder", "file"], "left").withColumn("_s", status)
        .groupBy("collection_id", "folder", "doi")
        .agg(
            F.count("*").alias("n_datasets"),
            *[F.count_if(F.col("_s") == s).alias(f"n_{s}") for s in ("present", "to_fetch", "no_url")],
        )
    )

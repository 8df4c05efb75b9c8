"""Scans of vendor text files as distributed line and row tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.session import write_stage

# --- lines -------------------------------------------------------------------


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their folder and a place: (file, block, seq) sorts like the file.

    ``block`` is the byte offset of the split and ``seq`` grows within it, so no
    line needs its neighbours to know its order.
    """
    return spark.read.text(path).select(
        F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1).alias("folder"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def place() -> Column:
    return F.struct("file", "block", "seq")


def number_lines(lines: DataFrame, name: str = "line") -> DataFrame:
    """0-based line number per folder, counted split by split (a split is one read block)."""
    split = ["folder", "file", "block"]
    local = lines.withColumn("_local", F.row_number().over(W.partitionBy(*split).orderBy("seq")) - 1)
    sizes = lines.groupBy(*split).agg(F.count("*").alias("_n"))
    before = W.partitionBy("folder").orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*split, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return local.join(offsets, split).withColumn(name, F.col("_local") + F.col("_before")).drop("_local", "_before")


def unordered_lines(numbers: DataFrame, column: str) -> DataFrame:
    """Lines whose ``column`` is smaller than on the line before, in file order per folder.

    Splits are compared inside, then each with the last line of the split before
    it, so a file of any size is checked split by split.
    """
    split = ["folder", "file", "block"]
    inside = numbers.withColumn("_prev", F.lag(column).over(W.partitionBy(*split).orderBy("seq"))).where(
        F.col(column) < F.col("_prev")
    ).select("folder", "file", "block", column, "_prev")
    ends = numbers.groupBy(*split).agg(F.min_by(column, "seq").alias("_first"), F.max_by(column, "seq").alias("_last"))
    across = ends.withColumn("_prev", F.lag("_last").over(W.partitionBy("folder").orderBy("file", "block"))).where(
        F.col("_first") < F.col("_prev")
    ).select("folder", "file", "block", F.col("_first").alias(column), "_prev")
    return inside.unionByName(across)


# --- typed and wide CSV --------------------------------------------------------


def metadata_table(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """CSV scan of the named columns with coerced types; a value that does not fit becomes null.

    Columns the file lacks are left out.
    """
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in columns.items() if c in raw.columns])


# One field of a CSV line that starts with a comma: quoted, with doubled quotes inside, or plain.
_FIELD = r',(\s*"[^"]*+(?:""[^"]*+)*+"\s*|[^,]*)'


def csv_fields(value: Column) -> Column:
    """The fields of a CSV line as text, without the quotes around them."""

    def bare(field: Column) -> Column:
        f = F.trim(field)
        inside = F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
        return F.when(f.startswith('"') & f.endswith('"') & (F.length(f) > 1), inside).otherwise(f)

    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), value), F.lit(_FIELD), F.lit(1)), lambda f: bare(f))
    return F.when(value.contains('"'), quoted).otherwise(F.transform(F.split(value, ","), lambda f: F.trim(f)))


def wide_to_long(
    spark: SparkSession, path: str, keys: Sequence[str] = ("fov", "cell_ID"), fovs: Sequence[str] | None = None
) -> DataFrame:
    """Wide cells x genes CSV files as (keys..., cell_key, gene, value) without zeros.

    Every file is read by its own header, so files may order or choose their
    genes differently; quoted names may hold commas.  Header and line are paired
    by position before rows are made, so thousands of gene columns cost one
    expression.  A file without the keys in front, or a line of another width
    than its header, is an error; blank lines are skipped.
    """
    lines = read_lines(spark, path).where(F.trim("value") != "")
    first = lines.where(F.col("block") == 0).groupBy("file").agg(F.min_by("value", "seq").alias("_header"))
    names = csv_fields(F.col("_header"))
    front = F.slice(names, 1, len(keys)) == F.array(*[F.lit(k) for k in keys])
    no_keys = F.raise_error(F.concat(F.lit(f"expected the columns {list(keys)} first in "), F.col("file")))
    headers = write_stage(first.select("file", "_header", F.when(front, names).otherwise(no_keys).alias("_names")), "headers")
    rows = lines.select("file", "value").join(headers, "file").where(F.col("value") != F.col("_header"))
    fields = csv_fields(F.col("value"))
    torn = F.raise_error(F.concat(F.lit("a line does not have the width of its header in "), F.col("file")))
    cells = rows.select("_names", F.when(F.size(fields) == F.size("_names"), fields).otherwise(torn).alias("_v"))
    cells = cells.select("_names", "_v", *[F.col("_v")[i].alias(k) for i, k in enumerate(keys)])
    if fovs is not None:
        cells = cells.where(F.col(keys[0]).isin(list(fovs)))
    genes = F.slice(F.arrays_zip("_names", "_v"), len(keys) + 1, F.size("_v"))
    pairs = F.filter(
        F.transform(genes, lambda e: F.struct(e["_names"].alias("gene"), e["_v"].try_cast("double").alias("value"))),
        lambda e: e["value"] != 0,
    )
    return cells.select(*keys, F.concat_ws("__", *keys).alias("cell_key"), F.inline(pairs))


# --- Matrix Market and the barcode / feature / matrix triple ---------------------


def matrix_market(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (folder, row, col, value; 1-based) and sizes (folder, n_rows, n_cols, nnz, header_ok).

    The size lines, one per folder, are written first: Spark then knows how small
    they are, and does not deal the lines by folder to leave out the size line.
    """
    comment = F.col("value").startswith("%")
    body = lines.where(~comment & (F.trim("value") != ""))
    first = write_stage(body.groupBy("folder").agg(F.min(place()).alias("_at"), F.min_by("value", place()).alias("_size")), "sizes")
    banner = lines.groupBy("folder").agg(F.min_by("value", place()).alias("_banner"))
    size = F.split(F.trim("_size"), r"\s+")
    sizes = first.join(banner, "folder").select(
        "folder",
        size[0].cast("long").alias("n_rows"),
        size[1].cast("long").alias("n_cols"),
        size[2].cast("long").alias("nnz"),
        F.col("_banner").startswith("%%MatrixMarket matrix coordinate").alias("header_ok"),
    )
    parts = F.split(F.trim("value"), r"\s+")
    entries = body.join(first.select("folder", "_at"), "folder").where(place() != F.col("_at")).select(
        "folder", "file", "block", "seq",
        parts[0].cast("long").alias("row"), parts[1].cast("long").alias("col"), parts[2].cast("double").alias("value"),
    )
    return entries, sizes


def shape_report(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """Declared against found: entries, largest indices, and whether all fits."""
    found = entries.groupBy("folder").agg(
        F.count("*").alias("n_entries"), F.min("row").alias("_r0"), F.max("row").alias("max_row"),
        F.min("col").alias("_c0"), F.max("col").alias("max_col"),
    )
    fits = (
        F.col("header_ok") & (F.col("n_entries") == F.col("nnz")) & (F.col("_r0") >= 1) & (F.col("_c0") >= 1)
        & (F.col("max_row") <= F.col("n_rows")) & (F.col("max_col") <= F.col("n_cols"))
    )
    return sizes.join(found, "folder", "left").withColumn("valid", F.coalesce(fits, F.lit(False))).drop("_r0", "_c0")


def triplet(barcodes: DataFrame, features: DataFrame, entries: DataFrame) -> DataFrame:
    """Named entries (folder, barcode, gene, value) from numbered barcode and feature lines.

    ``folder`` of all three tables names the sample.
    """
    cells = number_lines(barcodes).select("folder", (F.col("line") + 1).alias("col"), F.split("value", "\t")[0].alias("barcode"))
    fields = F.split("value", "\t")
    genes = number_lines(features).select(
        "folder", (F.col("line") + 1).alias("row"), fields[0].alias("gene_id"), F.get(fields, F.lit(1)).alias("gene_name"),
        F.get(fields, F.lit(2)).alias("feature_type"),
    )
    return entries.join(cells, ["folder", "col"]).join(genes, ["folder", "row"]).select(
        "folder", "barcode", "gene_id", "gene_name", "feature_type", "value"
    )


# --- spot positions --------------------------------------------------------------

# The six position columns, and other names of the pixel columns.
POSITION_COLUMNS = ["barcode", "in_tissue", "array_row", "array_col", "pxl_row_in_fullres", "pxl_col_in_fullres"]
POSITION_ALIASES = {
    "barcode": ["barcode"],
    "pxl_row_in_fullres": ["pxl_row_in_fullres", "y", "pixel_y", "imagey"],
    "pxl_col_in_fullres": ["pxl_col_in_fullres", "x", "pixel_x", "imagex"],
}
_POSITION_TYPES = ["string", "int", "int", "int", "double", "double"]


def positions_csv(lines: DataFrame) -> DataFrame:
    """Spot positions from CSV lines, with or without a header line."""
    parts = F.split("value", ",")
    rows = lines.where((F.size(parts) >= 6) & (F.lower(F.trim(parts[0])) != "barcode"))
    return rows.select(
        "folder", *[F.trim(parts[i]).try_cast(t).alias(c) for i, (c, t) in enumerate(zip(POSITION_COLUMNS, _POSITION_TYPES))]
    )


def standard_positions(df: DataFrame) -> DataFrame:
    """Rename the known alias columns, in any case, to the standard names."""
    for wanted, aliases in POSITION_ALIASES.items():
        if wanted not in df.columns:
            found = next((c for c in df.columns if c.lower() in aliases), None)
            if found is not None:
                df = df.withColumnRenamed(found, wanted)
    return df


# --- region profiles ---------------------------------------------------------------

# The section names of a region profile, and the values read from them.
SECTIONS = ["Header", "Scan_Attributes", "NGS_Processing_Attributes", "Code_Summary"]
SCAN_FIELDS = {"scan_id": "ID", "plate_id": "Plate_ID", "well": "Well"}
READ_FIELDS = {"raw_reads": "Raw", "trimmed_reads": "Trimmed", "aligned_reads": "Aligned"}
QUALITY_FIELDS = {"umi_q30": "umiQ30", "rts_q30": "rtsQ30"}


def dcc_fields(lines: DataFrame) -> DataFrame:
    """``key,value`` lines with the section they stand in; one folder holds one region.

    The places of the section marks, one row per folder, are written first, as in ``matrix_market``.
    """
    tag = F.trim("value")
    marks = lines.where(tag.startswith("<")).groupBy("folder").agg(
        *[F.min(F.when(tag == f"<{s}>", place())).alias(f"_{s}0") for s in SECTIONS],
        *[F.max(F.when(tag == f"</{s}>", place())).alias(f"_{s}1") for s in SECTIONS],
    )
    marks = write_stage(marks, "marks")
    section = F.coalesce(
        *[F.when((place() > F.col(f"_{s}0")) & (place() < F.col(f"_{s}1")), F.lit(s)) for s in SECTIONS]
    )
    pair = lines.where(F.col("value").contains(",")).join(marks, "folder").withColumn("section", section)
    return pair.where(F.col("section").isNotNull()).select(
        "folder", "section",
        F.trim(F.regexp_extract("value", "^([^,]*),", 1)).alias("key"),
        F.regexp_replace(F.trim(F.regexp_extract("value", "^[^,]*,(.*)$", 1)), '^"+|"+$', "").alias("text"),
    )


def dcc_regions(fields: DataFrame) -> DataFrame:
    """One row per region: ids as text (missing empty), reads and quality (missing 0)."""

    def pick(section: str, key: str) -> Column:
        return F.max(F.when((F.col("section") == section) & (F.col("key") == key), F.col("text")))

    ngs = SECTIONS[2]
    return fields.groupBy("folder").agg(
        *[F.coalesce(pick(SECTIONS[1], k), F.lit("")).alias(n) for n, k in SCAN_FIELDS.items()],
        *[F.coalesce(pick(ngs, k).try_cast("long"), F.lit(0)).alias(n) for n, k in READ_FIELDS.items()],
        *[F.coalesce(pick(ngs, k).try_cast("double"), F.lit(0.0)).alias(n) for n, k in QUALITY_FIELDS.items()],
    ).withColumn("gsm_id", F.split("folder", "_")[0])


def dcc_counts(fields: DataFrame) -> DataFrame:
    return fields.where(F.col("section") == SECTIONS[3]).select(
        F.split("folder", "_")[0].alias("gsm_id"), F.col("key").alias("rts_id"), F.col("text").cast("int").alias("count")
    )


PKC_SCHEMA = "Targets array<struct<DisplayName: string, CodeClass: string, Probes: array<struct<RTS_ID: string>>>>"


def probe_kit(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(rts_id, gene, code_class) from probe kit JSON."""
    kit = spark.read.schema(PKC_SCHEMA).option("multiLine", multi_line).json(path)
    targets = kit.select(F.explode("Targets").alias("t"))
    return targets.select(F.explode("t.Probes").alias("p"), "t").select(
        F.col("p.RTS_ID").alias("rts_id"), F.col("t.DisplayName").alias("gene"), F.col("t.CodeClass").alias("code_class")
    )


# --- small JSON documents, reference tables and tagged folders -----------------------


def json_fields(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """A fixed set of keys from JSON text; missing keys are null."""
    schema = ", ".join(f"`{n}` {t}" for n, t in fields.items())
    return df.withColumn("_j", F.from_json(column, schema)).select(
        *[c for c in df.columns if c != column], *[F.col(f"_j.`{n}`").alias(n) for n in fields]
    )


def tagged_folder(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """All files below the folders of ``path``, each row tagged with its folder; hidden files are skipped."""
    df = spark.read.format(fmt).options(**options).load(f"{path}/*")
    return df.withColumn("source", F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1))


def reference_tables(spark: SparkSession, path: str, name: str, keep: Sequence[str]) -> DataFrame:
    """The optional sidecar ``name`` of every sample folder; samples without it add no rows."""
    raw = spark.read.option("header", True).csv(f"{path}/*/{name}")
    return raw.select(F.regexp_extract("_metadata.file_path", rf"([^/]+)/{name}/[^/]+$", 1).alias("sample"), *keep)

"""Projections and filters on cells, features and matrix entries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.ordering import first_n

# Candidate columns in the order in which they are tried.
COORDINATE_PAIRS = [
    ("x", "y"),
    ("X", "Y"),
    ("center_x", "center_y"),
    ("centroid_x", "centroid_y"),
    ("array_col", "array_row"),
    ("pxl_col_in_fullres", "pxl_row_in_fullres"),
]
SAMPLE_KEYS = ["sample_id", "library_id", "sample", "fov_labels", "region"]
ALIAS_COLUMNS = ["meta__cluster_alias", "cluster_alias", "meta__cluster", "cluster"]

# Feature name prefixes; the first two lists ignore case, the last two do not.
NEGATIVE_PREFIXES = ["negprb", "negprobe", "neg_prb", "negative"]
SYSTEM_PREFIXES = ["systemcontrol", "sys_control", "falsecode"]
ISOTYPE_PREFIXES = ["Ms IgG", "Rb IgG"]
CHANNEL_PREFIXES = ["Channel-"]


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of ``names`` that are columns of ``df``, matched with their case."""
    return [n for n in names if n in df.columns]


def project_available(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """The wanted columns with their types; absent ones are null."""
    return df.select(
        *[
            (F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast(t).alias(n)
            for n, t in wanted.items()
        ]
    )


def coordinate_fallback(df: DataFrame, pairs: Sequence[tuple[str, str]] = tuple(COORDINATE_PAIRS)) -> DataFrame:
    """Add ``spatial_x``, ``spatial_y`` and the pair they came from.

    The first pair with both values wins, row by row, so samples with different
    layouts can be stacked first.  Unresolved rows keep nulls.
    """
    usable = [(a, b) for a, b in pairs if a in df.columns and b in df.columns]
    if not usable:
        raise ValueError(f"no coordinate pair among {df.columns}")
    found = [
        F.when(
            F.col(a).isNotNull() & F.col(b).isNotNull(),
            F.struct(F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"), F.lit(f"{a},{b}").alias("src")),
        )
        for a, b in usable
    ]
    return (
        df.withColumn("_c", F.coalesce(*found))
        .withColumn("spatial_x", F.col("_c.x"))
        .withColumn("spatial_y", F.col("_c.y"))
        .withColumn("spatial_source", F.col("_c.src"))
        .drop("_c")
    )


def key_fallback(df: DataFrame, default: str, candidates: Sequence[str] = tuple(SAMPLE_KEYS)) -> Column:
    """First available sample key as text, else the constant."""
    return F.coalesce(*[F.col(c).cast("string") for c in present(df, candidates)], F.lit(default))


def alias_fallback(df: DataFrame, preferred: str | None = None) -> DataFrame:
    """Add the first usable cluster alias and the name of the column it came from."""
    names = present(df, ([preferred] if preferred else []) + ALIAS_COLUMNS)
    names = list(dict.fromkeys(names))
    if not names:
        return df.withColumn("alias", F.lit(None).cast("string")).withColumn("alias_column", F.lit(None).cast("string"))
    value = F.coalesce(*[F.col(n).cast("string") for n in names])
    source = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in names])
    return df.withColumn("alias", value).withColumn("alias_column", source)


def coords_2d(full: Column, flat: Column) -> tuple[Column, Column]:
    """x and y of the aligned 3-D vector when there is one, else of the flat one."""
    both = F.slice(F.coalesce(full, flat), 1, 2)
    return both[0], both[1]


def layer_fallback(*layers: str) -> Column:
    """Counts from the first layer that has a value."""
    return F.coalesce(*[F.col(n) for n in layers])


def fov_limit(df: DataFrame, column: str, wanted: Sequence[str] | None, order: str, max_cells: int | None) -> DataFrame:
    """Rows of the wanted fields of view, then the first ``max_cells`` in file order."""
    kept = df if wanted is None else df.where(F.col(column).isin(list(wanted)))
    return kept if max_cells is None else first_n(kept, order, max_cells)


def starts_with_any(column: Column, prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [column.startswith(p) for p in prefixes])


def rna_class(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(starts_with_any(low, NEGATIVE_PREFIXES), "negative")
        .when(starts_with_any(low, SYSTEM_PREFIXES), "system")
        .otherwise("gene")
    )


def protein_class(name: Column) -> Column:
    return (
        F.when(starts_with_any(name, ISOTYPE_PREFIXES), "isotype")
        .when(starts_with_any(name, CHANNEL_PREFIXES), "channel")
        .otherwise("protein")
    )


def keep_cells(x: DataFrame, min_counts: float | None = None, min_genes: int | None = None) -> DataFrame:
    """Matrix rows of the cells that reach the bounds (inclusive)."""
    return _keep(x, "cell_id", min_counts, min_genes)


def keep_genes(x: DataFrame, min_counts: float | None = None, min_cells: int | None = None) -> DataFrame:
    """Matrix rows of the genes that reach the bounds (inclusive)."""
    return _keep(x, "gene", min_counts, min_cells)


def _keep(x: DataFrame, key: str, min_total: float | None, min_hits: int | None) -> DataFrame:
    sums = x.groupBy(key).agg(F.sum("value").alias("_t"), F.count_if(F.col("value") > 0).alias("_n"))
    good = F.lit(True)
    if min_total is not None:
        good = good & (F.col("_t") >= min_total)
    if min_hits is not None:
        good = good & (F.col("_n") >= min_hits)
    return x.join(sums.where(good).select(key), key, "left_semi")


def keep_features(x: DataFrame, var: DataFrame, condition: Column) -> DataFrame:
    """Matrix rows of the features that meet the condition on ``var``."""
    return x.join(var.where(condition).select("gene"), "gene", "left_semi")


def drop_features(x: DataFrame, var: DataFrame, condition: Column) -> DataFrame:
    """Matrix rows without the features that meet the condition on ``var``."""
    return x.join(var.where(condition).select("gene"), "gene", "left_anti")


def zoom_boxes(vertices: DataFrame, key: str, pad_x: float = 0.25, pad_y: float = 0.45) -> DataFrame:
    """Bounding box of the vertices per key, widened by a share of its sides."""
    ends = vertices.groupBy(key).agg(
        F.min("x").alias("_x0"), F.max("x").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1")
    )
    wide, high = (F.col("_x1") - F.col("_x0")) * pad_x, (F.col("_y1") - F.col("_y0")) * pad_y
    return ends.select(
        key,
        (F.col("_x0") - wide).alias("zoom_x0"),
        (F.col("_x1") + wide).alias("zoom_x1"),
        (F.col("_y0") - high).alias("zoom_y0"),
        (F.col("_y1") + high).alias("zoom_y1"),
    )


def cells_in_view(space: DataFrame, boxes: DataFrame, key: str) -> DataFrame:
    """Cells within the zoom box of their key."""
    return space.join(boxes, key).where(
        F.col("x").between(F.col("zoom_x0"), F.col("zoom_x1")) & F.col("y").between(F.col("zoom_y0"), F.col("zoom_y1"))
    )


def finite_or_zero(column: str) -> Column:
    """NaN and infinities become 0; null stays null."""
    c = F.col(column)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)

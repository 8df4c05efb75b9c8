"""Frequencies, descriptions, histograms and other group summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.ordering import quantiles
from cellweave.operators.qc import one_row


def value_counts(df: DataFrame, column: str, keep_null: bool = False, top: int | None = None) -> DataFrame:
    """Frequency per value, largest first; null values are dropped unless kept."""
    kept = df if keep_null else df.where(F.col(column).isNotNull())
    counted = kept.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return counted if top is None else counted.limit(top)


def top_groups(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The k largest groups, then sorted by key."""
    return value_counts(df, column, top=k).orderBy(column)


def describe(df: DataFrame, text: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """One row per column: count, distinct, most frequent value, mean, sd, extremes and quartiles."""
    words = (
        df.unpivot([], [F.col(c).cast("string").alias(c) for c in text], "column", "_v")
        .where(F.col("_v").isNotNull())
        .groupBy("column", "_v")
        .agg(F.count("*").alias("_n"))
        .groupBy("column")
        .agg(
            F.sum("_n").alias("count"),
            F.count("*").alias("n_unique"),
            F.min_by("_v", F.struct(-F.col("_n"), F.col("_v"))).alias("top"),
            F.max("_n").alias("freq"),
        )
    )
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in numeric], "column", "_v").where("_v IS NOT NULL")
    moments = long.groupBy("column").agg(
        F.count("*").alias("count"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    quartiles = quantiles(long, ["column"], ["_v"], [0.25, 0.5, 0.75]).select(
        "column",
        F.col("_v__q25").alias("q25"),
        F.col("_v__q50").alias("q50"),
        F.col("_v__q75").alias("q75"),
    )
    return words.unionByName(moments.join(quartiles, "column"), allowMissingColumns=True)


def distinct_by_group(df: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """Number of distinct non-null values per group."""
    return df.groupBy(*groups).agg(F.count_distinct(column).alias(f"n_{column}"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram between the extremes; the last bin holds the maximum; empty bins are kept."""
    kept = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_v"))
    ends = kept.select(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    width = (high - low) / bins
    index = F.coalesce(F.floor(F.try_divide(F.col("_v") - low, width)), F.lit(0))
    counted = kept.groupBy(F.least(F.lit(bins - 1), index).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return (
        frame.join(counted, "bin", "left")
        .fillna({"n": 0})
        .select("bin", (low + F.col("bin") * width).alias("left_edge"), (low + (F.col("bin") + 1) * width).alias("right_edge"), "n")
    )


def box_stats(df: DataFrame, group: str, column: str) -> DataFrame:
    """Exact quartiles, extremes and the 1.5 IQR whisker ends per group."""
    kept = df.where(F.col(group).isNotNull())
    boxes = quantiles(kept, [group], [column], [0.25, 0.5, 0.75]).select(
        group,
        F.col(f"{column}__q25").alias("q25"),
        F.col(f"{column}__q50").alias("median"),
        F.col(f"{column}__q75").alias("q75"),
    )
    spread = 1.5 * (F.col("q75") - F.col("q25"))
    value = F.col(column).cast("double")
    inside = (value >= F.col("q25") - spread) & (value <= F.col("q75") + spread)
    ends = (
        kept.join(boxes, group)
        .groupBy(group)
        .agg(
            F.count(column).alias("n"),
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
        )
    )
    return boxes.join(ends, group)


def extent(space: DataFrame, sample: str) -> DataFrame:
    """Coordinate range per sample."""
    return space.groupBy(sample).agg(
        F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.min("y").alias("y_min"), F.max("y").alias("y_max")
    )


def matrix_flags(x: DataFrame, obs: DataFrame, sample: str, raw: DataFrame | None = None) -> DataFrame:
    """Per sample: cells, genes seen, whether all values are integers, and the same of its raw layer.

    ``raw`` holds the raw layers of those samples that have one, laid out like
    ``x``; ``has_raw`` tells which do, and ``raw_integer_like`` is null for the others.
    """
    cells = obs.select("cell_id", sample)
    gap = F.max(F.abs(F.col("value") - F.round("value"))).alias("_gap")
    seen = x.join(cells, "cell_id").groupBy(sample, "gene").agg(gap).groupBy(sample).agg(F.count("*").alias("n_genes"), F.max("_gap").alias("_gap"))
    out = obs.groupBy(sample).agg(F.count("*").alias("n_cells")).join(seen, sample, "left")
    out = out.select(
        sample, "n_cells", F.coalesce("n_genes", F.lit(0).cast("long")).alias("n_genes"), F.coalesce(F.col("_gap") <= 1e-6, F.lit(True)).alias("integer_like")
    )
    if raw is None:
        return out.select("*", F.lit(False).alias("has_raw"), F.lit(None).cast("boolean").alias("raw_integer_like")).orderBy(sample)
    layers = raw.join(cells, "cell_id").groupBy(sample).agg(gap).select(sample, (F.col("_gap") <= 1e-6).alias("raw_integer_like"))
    marked = out.join(layers.withColumn("has_raw", F.lit(True)), sample, "left")
    return marked.select(*out.columns, F.coalesce("has_raw", F.lit(False)).alias("has_raw"), "raw_integer_like").orderBy(sample)


def dataset_overview(x: DataFrame, obs: DataFrame, var: DataFrame, space: DataFrame, rep: DataFrame) -> DataFrame:
    """One row: cells, genes, samples, and flags for coordinates, embedding and integer counts."""
    cells = obs.agg(F.count("*").alias("n_cells"), F.count_distinct("sample").alias("n_samples"))
    genes = var.agg(F.count("*").alias("n_genes"))
    shape = x.agg(
        F.count("*").alias("nnz"),
        (F.max(F.abs(F.col("value") - F.round("value"))) <= 1e-6).alias("integer_like"),
    )
    where = space.agg((F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()) > 0).alias("has_spatial"))
    emb = rep.agg((F.count_if(F.size("vec") > 0) > 0).alias("has_embedding"))
    return one_row(cells, genes, shape, where, emb)


def group_by_feature_count(x: DataFrame, obs: DataFrame, sample: str) -> DataFrame:
    """Samples grouped by their number of features: group size and total cells."""
    per = matrix_flags(x, obs, sample)
    return per.groupBy("n_genes").agg(F.count("*").alias("n_samples"), F.sum("n_cells").alias("n_cells"))

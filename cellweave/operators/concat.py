"""Stacking samples: inner and outer, with the rules for feature and data-set metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.text import cell_key
from cellweave.operators.qc import group_moments


def stack(parts: dict[str, DataFrame], label: str) -> DataFrame:
    """Stack tables with a label column; columns absent in a part are null there."""
    labelled = [df.withColumn(label, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def outer_columns(obs: DataFrame, label: str, layout: dict[str, list[str]]) -> DataFrame:
    """``obs`` as the outer stack of its parts by ``label``, in one pass.

    ``layout`` names the columns that each part has; they are null in all other
    parts.  Rows of a part that is not named, or without a label, stay too.
    """
    columns = dict.fromkeys(c for names in layout.values() for c in names)
    holders = {c: [part for part, names in layout.items() if c in names] for c in columns}
    return obs.select("cell_id", label, *[F.when(F.col(label).isin(parts), F.col(c)).alias(c) for c, parts in holders.items()])


def common_features(x: DataFrame, obs: DataFrame, sample: str, feature: str = "gene") -> DataFrame:
    """Features that occur in every sample of ``obs``."""
    pairs = x.select(sample, feature).distinct()
    n = obs.select(F.count_distinct(sample)).scalar()
    return pairs.groupBy(feature).agg(F.count("*").alias("_n")).where(F.col("_n") == n).select(feature)


def inner_features(x: DataFrame, obs: DataFrame, sample: str) -> DataFrame:
    """Matrix rows of the features that every sample has."""
    return x.join(common_features(x, obs, sample), "gene", "left_semi")


def outer_totals(x: DataFrame, obs: DataFrame, sample: str) -> DataFrame:
    """Totals over the union of features per sample; 0 where a sample lacks the feature."""
    return group_moments(x, obs, sample).select(sample, "gene", F.col("s1").alias("total"))


def merge_same(var: DataFrame, sample: str, columns: Sequence[str]) -> DataFrame:
    """Per column: is it equal in all samples for every gene that all samples have?

    Returns (column, n_genes, n_conflicts, kept).
    """
    n = var.select(F.count_distinct(sample)).scalar()
    per_gene = (
        var.groupBy("gene")
        .agg(
            F.count_distinct(sample).alias("_samples"),
            *[
                ((F.count_distinct(F.col(c)) == 1) & (F.count(c) == F.count("*"))).cast("int").alias(c)
                for c in columns
            ],
        )
        .where(F.col("_samples") == n)
    )
    sums = per_gene.agg(F.count("*").alias("n_genes"), *[F.sum(1 - F.col(c)).alias(c) for c in columns])
    return sums.unpivot("n_genes", list(columns), "column", "n_conflicts").withColumn("kept", F.col("n_conflicts") == 0)


def merge_first(var: DataFrame, position: str, columns: Sequence[str]) -> DataFrame:
    """Per gene the values of the first sample that has it."""
    return var.groupBy("gene").agg(F.min_by(F.struct(*columns), position).alias("_r")).select("gene", "_r.*")


def unique_index(obs: DataFrame, sample: str, sep: str = "-", key: str = "cell_id") -> DataFrame:
    """Cell key = name, separator, sample."""
    return obs.withColumn("cell_key", cell_key(F.col(key), F.col(sample), sep))


def merge_metadata(uns: DataFrame, sample: str) -> DataFrame:
    """Data-set metadata rows (sample, key, value) under both merge rules.

    ``first_value`` is the first sample's; ``same_value`` is set only when all
    samples have the key with one value.
    """
    n = uns.select(F.count_distinct(sample)).scalar()
    merged = uns.groupBy("key").agg(
        F.min_by("value", sample).alias("first_value"),
        F.count_distinct("value").alias("_values"),
        F.count_distinct(sample).alias("_samples"),
    )
    same = F.when((F.col("_values") == 1) & (F.col("_samples") == n), F.col("first_value"))
    return merged.select("key", "first_value", same.alias("same_value"))


def missing_names(requested: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Requested names that are not available."""
    return requested.select(key).distinct().join(available.select(key), key, "left_anti")


def marker_presence(panel: DataFrame, available: DataFrame) -> DataFrame:
    """Marker panel rows (category, gene) with a flag whether the gene is available."""
    known = available.select("gene").distinct().withColumn("_k", F.lit(True))
    return panel.join(known, "gene", "left").select("category", "gene", F.coalesce("_k", F.lit(False)).alias("present"))

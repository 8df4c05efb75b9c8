"""Key joins and alignment between matrices, annotations and lookup tables.

No side is broadcast by hint: Spark broadcasts a side only when its size is
known to be below the session's threshold, and splits skewed keys otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.ordering import number_rows


def unique_rows(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` again, failing at run time when a key repeats."""
    rest = [c for c in df.columns if c not in keys]
    folded = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.any_value(F.struct(*rest)).alias("_r"))
    checked = F.when(F.col("_n") == 1, F.col("_r")).otherwise(
        F.raise_error(F.concat(F.lit(f"duplicate key in {what}: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys])))
    )
    return folded.withColumn("_r", checked).select(*keys, "_r.*")


def left_join_one_to_one(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join that fails when either side repeats a key."""
    return unique_rows(left, on, "left side").join(unique_rows(right, on, "right side"), list(on), "left")


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First row per key along ``order``; folded before the shuffle, so no key is gathered whole."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, "_r.*")


def prefixed_lookup(df: DataFrame, key: str, prefix: str, order: str) -> DataFrame:
    """A lookup table with one row per key, prefixed columns and no unnamed index columns."""
    named = df.drop(*[c for c in df.columns if c.startswith("Unnamed:")])
    first = keep_first(named, [key], order).drop(order)
    return first.select(key, *[F.col(c).alias(f"{prefix}__{c}") for c in first.columns if c != key])


def match_rate(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Per lookup: matched rows and their percentage, from the named column after a left join."""
    sums = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(name) for name, c in columns.items()])
    return sums.unpivot("_n", list(columns), "lookup", "n_matched").select(
        "lookup", "n_matched", F.col("_n").alias("n_rows"), F.try_divide(100 * F.col("n_matched"), F.col("_n")).alias("pct_matched")
    )


def missing_metadata(x: DataFrame, obs: DataFrame, show: int = 10) -> DataFrame:
    """The first cells that have matrix rows but no metadata, with the number of all such cells."""
    lost = x.join(obs.select("cell_id"), "cell_id", "left_anti").groupBy("cell_id").agg(F.count("*").alias("n_rows"))
    total = lost.select(F.count("*")).scalar()
    return lost.orderBy("cell_id").limit(show).withColumn("n_missing_cells", total)


def key_overlap(left: DataFrame, right: DataFrame, key: str, by: str | None = None) -> DataFrame:
    """Numbers of shared, left-only and right-only keys; ``by`` splits them, e.g. per sample."""
    on = [key] if by is None else [by, key]
    both = (
        left.select(*on).distinct().withColumn("_l", F.lit(1))
        .join(right.select(*on).distinct().withColumn("_r", F.lit(1)), on, "full")
    )
    groups = [] if by is None else [by]
    return both.groupBy(*groups).agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("n_shared"),
        F.count_if(F.col("_r").isNull()).alias("n_left_only"),
        F.count_if(F.col("_l").isNull()).alias("n_right_only"),
    ).withColumn("aligned", (F.col("n_left_only") == 0) & (F.col("n_right_only") == 0))


def restrict_to_shared(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both tables with only the keys they share."""
    return (
        left.join(right.select(key).distinct(), key, "left_semi"),
        right.join(left.select(key).distinct(), key, "left_semi"),
    )


def align_barcodes(obs: DataFrame, positions: DataFrame, sample: str, barcode: str = "barcode", suffix: str = "-1") -> DataFrame:
    """Left-align positions to cells; a sample none of whose barcodes match gets the suffix first."""
    seen = positions.join(obs.select(sample, barcode), [sample, barcode], "left_semi").select(sample).distinct()
    marked = positions.join(seen.withColumn("_hit", F.lit(True)), sample, "left")
    fixed = marked.withColumn(
        barcode, F.when(F.col("_hit").isNull(), F.concat(F.col(barcode), F.lit(suffix))).otherwise(F.col(barcode))
    ).drop("_hit")
    return obs.join(fixed, [sample, barcode], "left")


def same_order(left: DataFrame, right: DataFrame, key: str, left_order: str, right_order: str) -> DataFrame:
    """Are two key lists equal, place by place?"""
    a = number_rows(left, [], left_order, name="_pos").select("_pos", F.col(key).alias("_a"))
    b = number_rows(right, [], right_order, name="_pos").select("_pos", F.col(key).alias("_b"))
    return a.join(b, "_pos", "full").agg(
        F.count("_a").alias("n_left"),
        F.count("_b").alias("n_right"),
        F.count_if(F.col("_a") == F.col("_b")).alias("n_same"),
    ).withColumn("identical", (F.col("n_left") == F.col("n_right")) & (F.col("n_same") == F.col("n_left")))


def map_back(full: DataFrame, subset: DataFrame, columns: Sequence[str], key: str = "cell_id") -> DataFrame:
    """Copy columns of a subset to the full table; other cells get null."""
    return full.join(subset.select(key, *columns), key, "left")


def probes_to_genes(probes: DataFrame, kit: DataFrame, sample: str) -> DataFrame:
    """Sum probe counts to genes; probes the kit does not know are dropped.

    The counts are folded per probe before the kit is joined.
    """
    folded = probes.groupBy(sample, "probe").agg(F.sum("count").alias("count"))
    return folded.join(kit.select("probe", "gene"), "probe").groupBy(sample, "gene").agg(F.sum("count").alias("value"))


def modality_panel(rna: DataFrame, atac: DataFrame, panel: DataFrame, prefix: str = "ATAC_") -> DataFrame:
    """The same genes from two modalities side by side, on the cells both have."""
    rna_in, atac_in = restrict_to_shared(rna, atac, "cell_id")
    keep = panel.select("gene")
    name = F.col("gene").cast("string")
    return (
        rna_in.join(keep, "gene", "left_semi").select("cell_id", name.alias("feature"), F.lit("RNA").alias("modality"), "value")
    ).unionByName(
        atac_in.join(keep, "gene", "left_semi").select(
            "cell_id", F.concat(F.lit(prefix), name).alias("feature"), F.lit("ATAC").alias("modality"), "value"
        )
    )

"""Normalisation and scaling of long count tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.ordering import quantiles
from cellweave.operators.qc import n_rows


def normalize_total(x: DataFrame, target: float = 1e4) -> DataFrame:
    """Scale each cell to the target sum; keeps the cell total and the target."""
    totals = x.groupBy("cell_id").agg(F.sum("value").alias("cell_total"))
    divisor = F.when(F.col("cell_total") == 0, 1.0).otherwise(F.col("cell_total"))
    return (
        x.join(totals, "cell_id")
        .withColumn("norm", F.col("value") * target / divisor)
        .withColumn("target_sum", F.lit(float(target)))
    )


def lognorm(x: DataFrame, target: float = 1e4) -> DataFrame:
    """x(cell_id, gene, value) with ln(1 + normalised value); zeros stay absent."""
    return normalize_total(x, target).select("cell_id", "gene", F.log1p("norm").alias("value"))


def q3_normalize(x: DataFrame, obs: DataFrame, var: DataFrame, key: str = "cell_id") -> DataFrame:
    """Third-quartile normalisation per region.

    The 75th percentile runs over all genes, absent ones as 0; a percentile of 0
    becomes 1.  Values are scaled by the geometric mean of all percentiles and
    then log1p-transformed.
    """
    kept = x.join(var.select("gene"), "gene", "left_semi").where("value <> 0")
    genes = n_rows(var)
    found = kept.groupBy(key).agg(F.count("*").alias("_n"))
    zeros = obs.select(key).join(found, key, "left").select(
        key, (genes - F.coalesce("_n", F.lit(0))).alias("zeros")
    )
    q3 = quantiles(kept, [key], ["value"], [0.75], zeros=zeros).select(
        key, F.when(F.col("value__q75") == 0, 1.0).otherwise(F.col("value__q75")).alias("q3")
    )
    scale = q3.select(F.exp(F.avg(F.ln("q3")))).scalar()
    return (
        kept.join(q3, key)
        .withColumn("q3_norm", F.col("value") / F.col("q3") * scale)
        .withColumn("lognorm", F.log1p("q3_norm"))
    )


def zscale(x: DataFrame, obs: DataFrame, clip: float = 10.0) -> DataFrame:
    """Standardise each feature over all cells and clip.

    The dense result is kept folded: ``z`` for the stored entries and ``z_zero``,
    the common value of all cells where the feature is absent.
    """
    n = n_rows(obs)
    sums = x.groupBy("gene").agg(F.sum("value").alias("_s1"), F.sum(F.col("value") * F.col("value")).alias("_s2"))
    moments = sums.select("gene", (F.col("_s1") / n).alias("mean"), "_s2").select(
        "gene", "mean", F.sqrt((F.col("_s2") - n * F.col("mean") * F.col("mean")) / (n - 1)).alias("sd")
    )
    divisor = F.when(F.col("sd") == 0, 1.0).otherwise(F.col("sd"))

    def clipped(value):
        return F.greatest(F.lit(-clip), F.least(F.lit(clip), (value - F.col("mean")) / divisor))

    return x.join(moments, "gene").select(
        "cell_id", "gene", clipped(F.col("value")).alias("z"), clipped(F.lit(0.0)).alias("z_zero")
    )


def gene_vector(x: DataFrame, space: DataFrame, gene, name: str = "gene", log: bool = True) -> DataFrame:
    """One feature across the cells with coordinates; absent is 0."""
    picked = x.where(F.col(name) == gene).groupBy("cell_id").agg(F.sum("value").alias("value"))
    full = space.join(picked, "cell_id", "left").fillna({"value": 0.0})
    return full.withColumn("value", F.log1p("value")) if log else full

"""Highly variable genes by dispersion, per batch, and by standardised variance."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.operators.ordering import number_rows
from cellweave.operators.qc import n_rows
from cellweave.session import write_stage

# Number of mean-expression bins, and the share of the genes that a local fit looks at.
BINS = 20
SPAN = 0.3

# Places at which a local regression is fitted.
ANCHORS = 128


def _dispersions(moments: DataFrame, by: list[str]) -> DataFrame:
    """Normalised dispersion from rows (by, gene, n, s1, s2) of back-transformed values.

    The gene sums are staged: all later steps read one row per gene.
    """
    moments = write_stage(moments, "dispersions")
    mean = F.col("s1") / F.col("n")
    var = (F.col("s2") - F.col("n") * mean * mean) / (F.col("n") - 1)
    stats = (
        moments.withColumn("_m", F.when(mean == 0, 1e-12).otherwise(mean))
        .withColumn("_d", var / F.col("_m"))
        .select(
            *by, "gene", F.log1p("_m").alias("mean"), F.when(F.col("_d") > 0, F.ln("_d")).alias("dispersion")
        )
    )
    ends = stats.groupBy(*by).agg(F.min("mean").alias("_lo"), F.max("mean").alias("_hi"))
    ranged = stats.join(ends, by) if by else one_side(stats, ends)
    width = (F.col("_hi") - F.col("_lo")) / BINS
    place = F.coalesce(F.ceil(F.try_divide(F.col("mean") - F.col("_lo"), width)) - 1, F.lit(0))
    binned = ranged.withColumn("bin", F.least(F.lit(BINS - 1), F.greatest(F.lit(0), place)).cast("int"))
    bins = binned.groupBy(*by, "bin").agg(F.avg("dispersion").alias("_bm"), F.stddev_samp("dispersion").alias("_bs"))
    alone = F.col("_bs").isNull()
    centre = F.when(alone, 0.0).otherwise(F.col("_bm"))
    spread = F.when(alone, F.col("_bm")).otherwise(F.col("_bs"))
    return binned.join(bins, [*by, "bin"]).select(
        *by, "gene", "mean", "dispersion", "bin",
        F.try_divide(F.col("dispersion") - centre, spread).alias("dispersion_norm"),
    )


def one_side(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row aggregate, as a scalar subquery."""
    row = scalars.select(F.struct(*scalars.columns)).scalar()
    return df.withColumn("_row", row).select("*", "_row.*").drop("_row")


def dispersion_genes(log_x: DataFrame, obs: DataFrame, var: DataFrame, n_top: int) -> DataFrame:
    """Dispersion method on log data; flags all genes that reach the ``n_top``-th largest value."""
    back = F.expm1("value")
    sums = log_x.groupBy("gene").agg(F.sum(back).alias("s1"), F.sum(back * back).alias("s2"))
    moments = var.select("gene").join(sums, "gene", "left").fillna(0.0).withColumn("n", n_rows(obs))
    out = _dispersions(moments, [])
    cut = (
        out.where(F.col("dispersion_norm").isNotNull()).orderBy(F.desc("dispersion_norm")).limit(n_top)
        .select(F.min("dispersion_norm")).scalar()
    )
    return out.withColumn("highly_variable", _reaches(F.col("dispersion_norm"), cut))


def _reaches(value, cut):
    """``value >= cut`` to nine decimals, so equal dispersions are treated alike; null is False."""
    return F.coalesce(F.round(value, 9) >= F.round(cut, 9), F.lit(False))


def dispersion_genes_by_batch(log_x: DataFrame, obs: DataFrame, batch: str, n_top: int) -> DataFrame:
    """Dispersion method per batch on the genes seen there, then exactly ``n_top`` genes by the
    number of batches that select them and the mean normalised dispersion (0 where unseen)."""
    back = F.expm1("value")
    sizes = obs.groupBy(batch).agg(F.count("*").alias("n"))
    sums = (
        log_x.join(obs.select("cell_id", batch), "cell_id").groupBy(batch, "gene")
        .agg(F.sum(back).alias("s1"), F.sum(back * back).alias("s2"))
    )
    per_batch = _dispersions(sums.join(sizes, batch), [batch])
    order = W.partitionBy(batch).orderBy(F.desc("dispersion_norm"), "gene")
    cuts = (
        per_batch.where(F.col("dispersion_norm").isNotNull())
        .withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n_top)
        .groupBy(batch).agg(F.min("dispersion_norm").alias("_cut"))
    )
    flagged = per_batch.join(cuts, batch, "left")
    n_batches = n_rows(sizes)
    hit = _reaches(F.col("dispersion_norm"), F.col("_cut"))
    merged = flagged.groupBy("gene").agg(
        F.count_if(hit).alias("n_batches"),
        (
            F.coalesce(F.sum("dispersion_norm"), F.lit(0.0))
            / F.nullif(n_batches - F.count_if(F.col("dispersion_norm").isNull()), F.lit(0))
        ).alias("mean_dispersion_norm"),
    )
    return merged.orderBy(F.desc("n_batches"), F.desc_nulls_last(F.round("mean_dispersion_norm", 8)), "gene").limit(n_top)


def local_fit(points: DataFrame, span: float = SPAN, anchors: int = ANCHORS) -> DataFrame:
    """``points`` (gene, x, y) with ``fit``, a local quadratic regression of y on x.

    At each of ``anchors`` genes, spread evenly by rank of x, a parabola is fitted
    to the nearest ``span`` of all genes with tricube weights; in between, the
    cubic that meets the values and slopes of both anchors is taken.  Where a
    neighbourhood has too few different x a line, or the mean, takes its place.  An
    anchor only meets the genes that are near it by rank, so the work is
    ``anchors`` x ``span`` x genes rows.
    """
    ranked = write_stage(number_rows(points, [], "x", ["gene"], "r").select("gene", "x", "y", "r"), "ranked")
    n = ranked.count()
    if not n:
        return points.withColumn("fit", F.lit(None).cast("double"))
    near = max(1, min(n, math.floor(span * n + 1e-9)))
    places = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(anchors - 1)), lambda i: F.lit(1) + F.floor(i * (n - 1) / (anchors - 1))))
    chosen = ranked.sparkSession.range(1).select(F.explode(places).alias("r"))
    at = ranked.join(chosen, "r").groupBy("x").agg(F.min("r").alias("r")).select(F.col("x").alias("c"), (F.col("r") - near).alias("low"), (F.col("r") + near).alias("high"))
    met = ranked.join(F.broadcast(at), (F.col("r") > F.col("low")) & (F.col("r") < F.col("high"))).select("c", (F.col("x") - F.col("c")).alias("u"), "y")
    far = F.row_number().over(W.partitionBy("c").orderBy(F.abs("u"), "y"))
    kept = met.withColumn("_n", far).where(F.col("_n") <= near).withColumn("h", F.max(F.abs("u")).over(W.partitionBy("c")))
    t = F.abs("u") / F.col("h")
    weight = F.when(F.col("h") == 0, 1.0).otherwise(F.pow(1 - t * t * t, F.lit(3.0)))
    u, y, w = F.col("u"), F.col("y"), F.col("w")
    powers = kept.withColumn("w", weight).groupBy("c").agg(
        F.sum(w).alias("s0"), F.sum(w * u).alias("s1"), F.sum(w * u * u).alias("s2"), F.sum(w * u * u * u).alias("s3"),
        F.sum(w * u * u * u * u).alias("s4"), F.sum(w * y).alias("t0"), F.sum(w * u * y).alias("t1"), F.sum(w * u * u * y).alias("t2"),
    )
    s0, s1, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2"))
    square = s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2)
    line = s0 * s2 - s1 * s1
    curved, sloped = F.abs(square) > 1e-12 * s0 * s2 * s4, F.abs(line) > 1e-12 * s0 * s2
    value = F.when(curved, (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / square)
    slope = F.when(curved, (s0 * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)) / square)
    value, slope = value.when(sloped, (t0 * s2 - s1 * t1) / line).otherwise(t0 / s0), slope.when(sloped, (s0 * t1 - s1 * t0) / line).otherwise(0.0)
    after = W.orderBy("c")  # one row per anchor
    fitted = powers.select("c", value.alias("v"), slope.alias("g"))
    knots = fitted.select("c", "v", "g", *(F.lead(k).over(after).alias(f"{k}1") for k in ("c", "v", "g")))
    joined = ranked.join(F.broadcast(knots), (F.col("x") >= F.col("c")) & (F.col("x") < F.coalesce("c1", F.lit(math.inf))))
    step = F.col("c1") - F.col("c")
    p = (F.col("x") - F.col("c")) / step
    inside = (
        (1 + 2 * p) * (1 - p) * (1 - p) * F.col("v") + p * (1 - p) * (1 - p) * step * F.col("g")
        + p * p * (3 - 2 * p) * F.col("v1") - p * p * (1 - p) * step * F.col("g1")
    )
    return joined.select("gene", "x", "y", F.when(F.col("c1").isNull(), F.col("v")).otherwise(inside).alias("fit"))


def standardized_variance(x: DataFrame, obs: DataFrame) -> DataFrame:
    """Variance of standardised, clipped counts per gene.

    The expected variance is a local regression of log10 variance on log10 mean
    over all genes that vary, and values are clipped at mean + expected sd x
    sqrt(N).
    """
    n = n_rows(obs)
    sums = x.groupBy("gene").agg(F.sum("value").alias("_s1"), F.sum(F.col("value") * F.col("value")).alias("_s2"))
    sums = write_stage(sums, "sums")
    stats = sums.withColumn("mean", F.col("_s1") / n).withColumn(
        "variance", (F.col("_s2") - n * F.col("mean") * F.col("mean")) / (n - 1)
    )
    varied = write_stage(stats.where("variance > 0 AND mean > 0").select("gene", "mean", "variance"), "varied")
    fitted = local_fit(varied.select("gene", F.log10("mean").alias("x"), F.log10("variance").alias("y")))
    expected = varied.join(fitted.select("gene", F.sqrt(F.pow(F.lit(10.0), "fit")).alias("reg_sd")), "gene")
    expected = write_stage(expected.withColumn("_cap", F.col("mean") + F.col("reg_sd") * F.sqrt(n)), "expected")
    capped = F.least("value", "_cap")
    sums2 = x.join(expected.select("gene", "_cap"), "gene").groupBy("gene").agg(
        F.sum(capped).alias("_k1"), F.sum(capped * capped).alias("_k2")
    )
    m = F.col("mean")
    spread = n * m * m + F.col("_k2") - 2 * m * F.col("_k1")
    return expected.join(sums2, "gene").select(
        "gene", "mean", "variance", (spread / ((n - 1) * F.col("reg_sd") * F.col("reg_sd"))).alias("variance_norm")
    )


def variance_genes(x: DataFrame, obs: DataFrame, n_top: int) -> DataFrame:
    """The ``n_top`` genes of largest standardised variance."""
    return standardized_variance(x, obs).orderBy(F.desc(F.round("variance_norm", 8)), "gene").limit(n_top)

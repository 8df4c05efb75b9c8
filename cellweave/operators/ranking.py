"""Ordered selections: unique names, gene rankings, ordered categories and clipped colours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.functions.text import fixed_text
from cellweave.operators.ordering import number_rows, quantiles


def unique_names(df: DataFrame, name: str, position: str, out: str = "unique_name") -> DataFrame:
    """The n-th repeat of a name gets the suffix ``-n``, in order of appearance."""
    numbered = number_rows(df, [name], position, name="_no")
    repeat = F.col("_no") - 1
    return numbered.withColumn(
        out, F.when(repeat == 0, F.col(name)).otherwise(F.concat_ws("-", F.col(name), repeat))
    ).drop("_no")


def require_rows(df: DataFrame, n: int, message: str) -> DataFrame:
    """``df`` again, failing at run time when it has fewer than ``n`` rows."""
    have = df.select(F.count("*")).scalar()
    return df.where(F.when(have >= n, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(message + ": "), have))))


def global_gene_list(scores: DataFrame, eligible: DataFrame, n: int) -> DataFrame:
    """The ``n`` best genes over all samples.

    ``scores`` holds (sample, gene, score, hvg); genes rank by the number of
    samples where they are highly variable, then the mean score, then the fewest
    missing scores, then the name.  Fewer than ``n`` eligible genes is an error.
    """
    ranked = (
        scores.join(eligible.select("gene").distinct(), "gene", "left_semi")
        .groupBy("gene")
        .agg(
            F.sum(F.coalesce(F.col("hvg").cast("int"), F.lit(0))).alias("hvg_count"),
            F.avg("score").alias("mean_score"),
            F.count_if(F.col("score").isNull()).alias("missing_scores"),
        )
    )
    order = [F.desc("hvg_count"), F.desc_nulls_last("mean_score"), F.asc("missing_scores"), F.asc("gene")]
    best = require_rows(ranked, n, f"fewer than {n} shared genes").orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(W.orderBy(*order)).cast("long"))


def panel_from_scores(var: DataFrame, other: DataFrame, n: int, score: str, flag: str) -> DataFrame:
    """Top ``n`` highly variable genes by a precomputed score that the other modality has too."""
    shared = var.where(F.col(flag)).join(other.select("gene").distinct(), "gene", "left_semi")
    return require_rows(shared, n, f"fewer than {n} genes in both").orderBy(F.desc(score), "gene").limit(n)


def by_category(df: DataFrame, column: str, order: Sequence[str], aggregates: dict) -> DataFrame:
    """Group results in a declared category order; categories without rows are kept.

    ``aggregates`` maps output names to aggregate columns.
    """
    declared = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in order])).alias("rank", column))
    found = df.groupBy(column).agg(F.count("*").alias("n"), *[a.alias(name) for name, a in aggregates.items()])
    return declared.join(found, column, "left").fillna({"n": 0}).orderBy("rank")


def clip_at_quantile(x: DataFrame, prob: float = 0.98, key: str = "gene") -> DataFrame:
    """Colour value in 0..1: non-zero values clipped at their quantile per gene.

    Sort the genes that are drawn by ``value``; the whole table is not sorted.
    """
    shown = x.where("value > 0")
    top = quantiles(shown, [key], ["value"], [prob])
    vmax = [c for c in top.columns if c != key][0]
    return (
        shown.join(top.withColumnRenamed(vmax, "vmax"), key)
        .withColumn("shade", F.least("value", "vmax") / F.greatest(F.col("vmax"), F.lit(1e-9)))
    )


def format_markers(table: DataFrame) -> DataFrame:
    """Display text of a marker table: signed fold change, score and percentages."""
    percent = lambda c: F.concat(
        fixed_text(F.round(F.round(c, 3).cast("decimal(18,3)") * 100, 1).cast("double"), 1), F.lit("%")
    )
    return table.select(
        "rank",
        "gene",
        fixed_text(F.col("log2fc_a_vs_b"), 2, signed=True).alias("log2fc"),
        fixed_text(F.col("score"), 2).alias("score"),
        percent("pct_expr_a").alias("pct_expr_a"),
        percent("pct_expr_b").alias("pct_expr_b"),
    )

"""Differential expression per group, with the implicit zeros counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.functions.probability import normal_p, student_p
from cellweave.operators.ordering import bh_adjust, value_positions
from cellweave.operators.qc import group_moments
from cellweave.session import write_stage


def welch(log_x: DataFrame, obs: DataFrame, group: str, genes: DataFrame | None = None) -> DataFrame:
    """Each group against the rest: Welch t, degrees of freedom and log2 fold change."""
    moments = group_moments(log_x, obs, group, genes)
    gene = W.partitionBy("gene")
    both = moments.select(
        "gene", group, "n", "s1", "s2",
        (F.sum("n").over(gene) - F.col("n")).alias("rn"),
        (F.sum("s1").over(gene) - F.col("s1")).alias("r1"),
        (F.sum("s2").over(gene) - F.col("s2")).alias("r2"),
    )

    def mean_var(n, s1, s2):
        mean = F.col(s1) / F.col(n)
        return mean, F.greatest(F.lit(0.0), (F.col(s2) - F.col(n) * mean * mean) / (F.col(n) - 1))

    m1, v1 = mean_var("n", "s1", "s2")
    m2, v2 = mean_var("rn", "r1", "r2")
    parts = both.select(
        "gene", group, "n", "rn", m1.alias("mean_group"), m2.alias("mean_rest"),
        (v1 / F.col("n")).alias("_a"), (v2 / F.col("rn")).alias("_b"),
    )
    a, b = F.col("_a"), F.col("_b")
    t = F.try_divide(F.col("mean_group") - F.col("mean_rest"), F.sqrt(a + b))
    df = F.try_divide((a + b) * (a + b), a * a / (F.col("n") - 1) + b * b / (F.col("rn") - 1))
    fold = F.log2((F.expm1("mean_group") + 1e-9) / (F.expm1("mean_rest") + 1e-9))
    return parts.select(
        "gene", group, F.coalesce(t, F.lit(0.0)).alias("score"), F.coalesce(df, F.lit(1.0)).alias("df"),
        fold.alias("logfc"),
    )


def welch_tests(log_x: DataFrame, obs: DataFrame, group: str, genes: DataFrame | None = None) -> DataFrame:
    """As :func:`welch`, with two-sided and Benjamini-Hochberg adjusted p-values."""
    tested = welch(log_x, obs, group, genes).withColumn("p", student_p(F.col("score"), F.col("df")))
    return bh_adjust(tested, [group], "p")


def _rank_sums(counts: DataFrame, keys: list[str], sizes: DataFrame, side: str) -> DataFrame:
    """Rank sums of one side from folded counts.

    ``counts``: staged (keys, side, value, n) over non-zero values; ``sizes``: (keys,
    side, n1, n_all).  The zeros of all cells share the lowest ranks.
    """
    placed = value_positions(counts, keys, "value", "n", staged=True)
    rank = F.col("before") + (F.col("at") + 1) / 2
    sums = write_stage(
        placed.groupBy(*keys, side).agg(
            F.sum(F.col("n") * rank).alias("_r"), F.sum("n").alias("_mine"), F.max("total").alias("_nnz")
        ),
        "rank-sums",
    )
    seen = sums.groupBy(*keys).agg(F.max("_nnz").alias("_nnz"))
    sums = sums.drop("_nnz")
    full = sizes.join(seen, keys, "left").join(sums, [*keys, side], "left").fillna(0, ["_nnz", "_r", "_mine"])
    zeros = F.col("n_all") - F.col("_nnz")
    total = (F.col("n1") - F.col("_mine")) * (zeros + 1) / 2 + F.col("_r") + F.col("_mine") * zeros
    n1, n = F.col("n1"), F.col("n_all")
    score = (total - n1 * (n + 1) / 2) / F.sqrt(n1.cast("double") * (n - n1) * (n + 1) / 12)
    return full.select(*keys, side, F.coalesce(score, F.lit(0.0)).alias("score"))


def rank_sum(
    x: DataFrame, obs: DataFrame, group: str, reference: str | None = None, genes: DataFrame | None = None
) -> DataFrame:
    """Wilcoxon rank-sum score of each group against the rest, or against a named reference group.

    Average ranks for ties, no tie correction of the variance.  The matrix is
    folded to (gene, value, group) counts before any ranking.
    """
    labels = obs.where(F.col(group).isNotNull()).select("cell_id", group)
    folded = (
        x.where("value <> 0").join(labels, "cell_id").groupBy("gene", "value", group).agg(F.count("*").alias("n"))
    )
    folded = write_stage(folded, "folded")
    sizes = labels.groupBy(group).agg(F.count("*").alias("n1"))
    listed = (folded if genes is None else genes).select("gene").distinct()
    if reference is None:
        whole = sizes.select(F.collect_list(F.struct(group, "n1"))).scalar()
        n_all = sizes.select(F.sum("n1")).scalar()
        grid = listed.select("gene", F.explode(whole).alias("_g")).select("gene", "_g.*").withColumn("n_all", n_all)
        return _rank_sums(folded, ["gene"], grid, group)
    others = sizes.where(F.col(group) != reference)
    n_ref = sizes.where(F.col(group) == reference).select(F.max("n1")).scalar()
    names = others.select(F.collect_list(group)).scalar()
    own = folded.where(F.col(group) != reference).withColumn("contrast", F.col(group))
    base = folded.where(F.col(group) == reference).withColumn("contrast", F.explode(names))
    counts = own.unionByName(base)
    pairs = others.select(F.collect_list(F.struct(F.col(group), "n1"))).scalar()
    grid = listed.select("gene", F.explode(pairs).alias("_g")).select(
        "gene", F.col(f"_g.{group}").alias("contrast"), F.col(f"_g.{group}").alias(group), F.col("_g.n1").alias("n1")
    ).withColumn("n_all", F.col("n1") + n_ref)
    return _rank_sums(counts, ["gene", "contrast"], grid, group).drop("contrast")


def rank_sum_tests(x: DataFrame, obs: DataFrame, group: str, reference: str | None = None, genes=None) -> DataFrame:
    """As :func:`rank_sum`, with two-sided and adjusted p-values per group."""
    tested = rank_sum(x, obs, group, reference, genes).withColumn("p", normal_p(F.col("score")))
    return bh_adjust(tested, [group], "p")


def sorted_markers(markers: DataFrame, group: str) -> DataFrame:
    return markers.orderBy(F.asc(group), F.desc("logfc"))


def top_union(markers: DataFrame, group: str, n: int = 5) -> DataFrame:
    """The top ``n`` genes of every group by score, stacked in group order, first occurrence kept."""
    order = W.partitionBy(group).orderBy(F.desc(F.round("score", 6)), "gene")
    top = markers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return top.groupBy("gene").agg(F.min(F.struct(F.col(group), F.col("rank"))).alias("_p")).select(
        "gene", F.col(f"_p.{group}").alias(group), F.col("_p.rank").cast("long").alias("rank")
    )

"""Quality metrics of a sparse count matrix, with the implicit zeros counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.operators.ordering import quantiles
from cellweave.session import write_stage


def n_rows(df: DataFrame) -> Column:
    """The row count of ``df`` as a scalar subquery."""
    return df.select(F.count("*")).scalar()


def cell_metrics(x: DataFrame, obs: DataFrame) -> DataFrame:
    """obs with ``n_genes_by_counts`` and ``total_counts``; cells without counts get 0."""
    per_cell = x.groupBy("cell_id").agg(
        F.count_if(F.col("value") > 0).alias("n_genes_by_counts"), F.sum("value").alias("total_counts")
    )
    return obs.join(per_cell, "cell_id", "left").fillna({"n_genes_by_counts": 0, "total_counts": 0.0})


def mt_flag(name: str | Column, prefix: str = "mt-", any_case: bool = True) -> Column:
    """True for mitochondrial gene names, by default in any case."""
    column = F.col(name) if isinstance(name, str) else name
    return F.lower(column).startswith(prefix.lower()) if any_case else column.startswith(prefix)


def subset_share(x: DataFrame, obs: DataFrame, var: DataFrame, flag: str, label: str) -> DataFrame:
    """Per cell the total of the flagged genes and its percentage; null when the cell has no counts.

    Only the flagged genes are joined: a short list that Spark can broadcast.
    """
    flagged = x.join(var.where(F.col(flag)).select("gene", F.lit(True).alias("_flag")), "gene", "left")
    per_cell = flagged.groupBy("cell_id").agg(
        F.sum("value").alias("total_counts"),
        F.sum(F.when(F.col("_flag"), F.col("value")).otherwise(0.0)).alias(f"total_counts_{label}"),
    )
    full = obs.select("cell_id").join(per_cell, "cell_id", "left").fillna(0.0)
    share = F.try_divide(100 * F.col(f"total_counts_{label}"), F.col("total_counts"))
    return full.withColumn(f"pct_counts_{label}", share)


def gene_metrics(x: DataFrame, obs: DataFrame, var: DataFrame) -> DataFrame:
    """Per gene: cells with counts, mean over all cells, total and dropout percentage."""
    per_gene = x.groupBy("gene").agg(
        F.count_if(F.col("value") > 0).alias("n_cells_by_counts"), F.sum("value").alias("total_counts")
    )
    n = n_rows(obs)
    return (
        var.select("gene")
        .join(per_gene, "gene", "left")
        .fillna({"n_cells_by_counts": 0, "total_counts": 0.0})
        .withColumn("mean_counts", F.col("total_counts") / n)
        .withColumn("pct_dropout_by_counts", 100 * (1 - F.col("n_cells_by_counts") / n))
    )


def top_share(x: DataFrame, obs: DataFrame, tops: Sequence[int] = (50, 100, 200, 500)) -> DataFrame:
    """Per cell the percentage of counts in its largest genes, with the log1p totals.

    Only the ``max(tops)`` largest entries of a cell reach the window: Spark
    drops the others before the shuffle.
    """
    ranked = x.withColumn("_rank", F.row_number().over(W.partitionBy("cell_id").orderBy(F.desc("value"), "gene")))
    kept = ranked.where(F.col("_rank") <= max(tops))
    sums = kept.groupBy("cell_id").agg(
        *[F.sum(F.when(F.col("_rank") <= t, F.col("value"))).alias(f"_top{t}") for t in tops]
    )
    base = cell_metrics(x, obs.select("cell_id")).join(sums, "cell_id", "left")
    return base.select(
        "cell_id",
        "n_genes_by_counts",
        F.log1p("n_genes_by_counts").alias("log1p_n_genes_by_counts"),
        "total_counts",
        F.log1p("total_counts").alias("log1p_total_counts"),
        *[
            F.try_divide(100 * F.col(f"_top{t}"), F.col("total_counts")).alias(f"pct_counts_in_top_{t}_genes")
            for t in tops
        ],
    )


def sample_summary(metrics: DataFrame, sample: str = "sample", area: str = "area") -> DataFrame:
    """Per sample: number of cells, means and exact medians of counts, genes and area.

    The three columns are staged once: means and medians are two passes over them.
    """
    metrics = write_stage(metrics.select(sample, "total_counts", "n_genes_by_counts", area), "metrics")
    means = metrics.where(F.col(sample).isNotNull()).groupBy(sample).agg(
        F.count("*").alias("n_cells"),
        F.avg("total_counts").alias("mean_total_counts"),
        F.avg("n_genes_by_counts").alias("mean_genes"),
        F.avg(area).alias("mean_cell_area"),
    )
    medians = quantiles(metrics, [sample], ["total_counts", "n_genes_by_counts", area], [0.5]).select(
        sample,
        F.col("total_counts__q50").alias("median_total_counts"),
        F.col("n_genes_by_counts__q50").alias("median_genes"),
        F.col(f"{area}__q50").alias("median_cell_area"),
    )
    return means.join(medians, sample).orderBy(F.desc("n_cells"), sample)


def group_medians(metrics: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Exact medians of several columns per group, sorted by group; null groups dropped."""
    found = quantiles(metrics.where(F.col(group).isNotNull()), [group], list(columns), [0.5])
    return found.select(group, *[F.col(f"{c}__q50").alias(f"median_{c}") for c in columns]).orderBy(group)


def class_totals(x: DataFrame, obs: DataFrame, var: DataFrame, classes: dict[str, str], column: str) -> DataFrame:
    """Per cell one total per feature class, e.g. negative probes and system controls."""
    labelled = x.join(var.where(F.col(column).isin(list(classes.values()))).select("gene", column), "gene")
    per_cell = labelled.groupBy("cell_id").agg(
        *[F.sum(F.when(F.col(column) == c, F.col("value")).otherwise(0.0)).alias(out) for out, c in classes.items()]
    )
    return obs.select("cell_id").join(per_cell, "cell_id", "left").fillna(0.0)


def integer_profile(x: DataFrame, obs: DataFrame, eps: float = 1e-6) -> DataFrame:
    """One row that tells whether the matrix holds integers: fraction, extremes and row sums."""
    entries = x.agg(
        F.avg(F.when(F.abs(F.col("value") - F.round("value")) > eps, 1.0).otherwise(0.0)).alias("frac_non_integer"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )
    sums = cell_metrics(x, obs.select("cell_id"))
    ends = sums.agg(F.min("total_counts").alias("min_row_sum"), F.max("total_counts").alias("max_row_sum"))
    middle = quantiles(sums, [], ["total_counts"], [0.5]).select(F.col("total_counts__q50").alias("median_row_sum"))
    return one_row(entries, ends, middle).withColumn("integer_like", F.col("frac_non_integer") == 0)


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row aggregates side by side, the later ones as scalar subqueries."""
    out = parts[0]
    for part in parts[1:]:
        row = part.select(F.struct(*part.columns)).scalar()
        out = out.withColumn("_row", row).select("*", "_row.*").drop("_row")
    return out


def sparsity(x: DataFrame, obs: DataFrame, var: DataFrame) -> DataFrame:
    """nnz, shape and the share of absent entries."""
    return x.agg(F.count_if(F.col("value") != 0).alias("nnz")).select(
        "nnz", n_rows(obs).alias("n_obs"), n_rows(var).alias("n_vars")
    ).withColumn("sparsity", 1 - F.col("nnz") / (F.col("n_obs").cast("double") * F.col("n_vars")))


def expression_summary(x: DataFrame, obs: DataFrame) -> DataFrame:
    """Per gene: expressing cells of all cells, and the range of raw and log1p values with zeros."""
    n = n_rows(obs)
    seen = x.where("value > 0").groupBy("gene").agg(
        F.count("*").alias("n_expressing"), F.min("value").alias("_low"), F.max("value").alias("max_raw")
    )
    low = F.when(F.col("n_expressing") < n, 0.0).otherwise(F.col("_low"))
    return seen.select(
        "gene",
        "n_expressing",
        n.alias("n_cells"),
        low.alias("min_raw"),
        "max_raw",
        F.log1p(low).alias("min_log1p"),
        F.log1p("max_raw").alias("max_log1p"),
    )


def dense_median_mean(x: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """Median and mean over a cells-by-genes block, absent entries counted as 0."""
    block = x.join(genes.select("gene"), "gene", "left_semi").join(cells.select("cell_id"), "cell_id", "left_semi")
    size = n_rows(cells) * n_rows(genes)
    found = block.where("value <> 0")
    zeros = found.agg((size - F.count("*")).alias("zeros"))
    median = quantiles(found, [], ["value"], [0.5], zeros=zeros).select(F.col("value__q50").alias("median_value"))
    mean = found.agg((F.coalesce(F.sum("value"), F.lit(0.0)) / size).alias("mean_value"), size.alias("n_entries"))
    return one_row(median, mean)


def dot_stats(x: DataFrame, obs: DataFrame, group: str) -> DataFrame:
    """Per gene and group: mean and fraction expressing over all cells of the group, and the
    mean scaled per gene to (m - min) / (max - min) over the groups."""
    full = group_moments(x, obs, group)
    means = full.select(
        "gene",
        group,
        (F.col("s1") / F.col("n")).alias("mean_value"),
        (F.col("nz") / F.col("n")).alias("frac_expressing"),
    )
    ends = means.groupBy("gene").agg(F.min("mean_value").alias("_lo"), F.max("mean_value").alias("_hi"))
    scaled = F.coalesce(
        F.try_divide(F.col("mean_value") - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0)
    )
    return means.join(ends, "gene").withColumn("scaled_mean", scaled).drop("_lo", "_hi")


def group_moments(x: DataFrame, obs: DataFrame, group: str, genes: DataFrame | None = None) -> DataFrame:
    """Per gene and group: n cells, non-zero count ``nz``, sum ``s1`` and sum of squares ``s2``.

    Every gene of ``genes``, or else every gene seen in ``x``, gets a row for
    every group, also where the group has no counts of it.  The matrix is read once, folded to (gene, group) and
    staged; the groups travel as one small array.
    """
    labels = obs.where(F.col(group).isNotNull())
    sizes = labels.groupBy(group).agg(F.count("*").alias("n"))
    seen = (
        x.where("value <> 0")
        .join(labels.select("cell_id", group), "cell_id")
        .groupBy("gene", group)
        .agg(
            F.count_if(F.col("value") > 0).alias("nz"),
            F.sum("value").alias("s1"),
            F.sum(F.col("value") * F.col("value")).alias("s2"),
        )
    )
    seen = write_stage(seen, "moments")
    groups = sizes.select(F.collect_list(F.struct(group, "n"))).scalar()
    listed = seen.select("gene").distinct() if genes is None else genes.select("gene")
    grid = listed.select("gene", F.explode(groups).alias("_g")).select("gene", "_g.*")
    return grid.join(seen, ["gene", group], "left").fillna({"nz": 0, "s1": 0.0, "s2": 0.0})

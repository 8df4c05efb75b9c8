"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import write_stage

#: Edges up to which one task takes the steps, so that a small graph shuffles nothing.
SMALL = 1 << 17


def _held(df: DataFrame, small: bool) -> DataFrame:
    return df.coalesce(1) if small else df


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    both = _held(edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), small)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _held(moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v"), small).distinct()


def _stars(edges: DataFrame, small: bool) -> bool:
    """Every node ``u`` has one edge and is no other's ``v``."""
    roles = _held(edges.select(F.col("u").alias("node")).unionAll(_held(edges, small).select("v").distinct()), small)
    return roles.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges`` has two columns ``u`` and ``v`` of one orderable type.  Loops and
    repeated edges are allowed; an empty table gives an empty result.  Each
    round is written to the shared folder, which cuts lineage; rounds go on
    until the edges are stars around smallest nodes, which no step changes.
    Minima are combined before the shuffle, so a hub with a third of all edges
    costs one row per task.  A graph of at most ``SMALL`` edges stays in one task.
    """
    now = write_stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _stars(now, small := now.count() <= SMALL):
        now = write_stage(_small_star(_large_star(now, small), small), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

"""Order statistics that never put a whole group into one task.

A window over ``(key)`` sends one key's rows to one task.  Here the rows are
first cut into ranges of the ordered column (``Bucketizer`` over approximate
quantiles, so each range holds about the same share of all rows), windows run
within ``(key, range)``, and the ranges are tied together by their totals: at
most one row per key and range.  This is done at every size; only keys of at most
``WHOLE_KEY`` rows are placed whole by ``value_positions``.  Ordered columns are numeric; nulls come first and NaN last, as in an ascending Spark sort.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import NumericType

from cellweave.session import write_stage

RANGE = "_range"
#: Rows of a key up to which one window places them all.
WHOLE_KEY = 1 << 16


def range_count(df: DataFrame) -> int:
    """Ranges to cut an ordered column into: four per shuffle partition, 32 to 2048."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(32, min(2048, 4 * parts))


def _check_numeric(df: DataFrame, column: str) -> None:
    if not isinstance(df.schema[column].dataType, NumericType):
        raise TypeError(f"{column} must be numeric to be ordered by ranges, not {df.schema[column].dataType.simpleString()}")


def with_range(df: DataFrame, column: str) -> DataFrame:
    """Add ``_range``: the index of the equal-share range that holds ``column``.

    The cut points are a bounded list of numbers fixed on the driver, so the
    same row gets the same range whenever a task is run again.  Equal values
    share a range; nulls have range -1, NaN the last one.
    """
    _check_numeric(df, column)
    count = range_count(df)
    probs = [i / count for i in range(1, count)]
    found = df.select(F.col(column).cast("double").alias("_v")).approxQuantile("_v", probs, 0.25 / count)
    cuts = sorted({c for c in found if math.isfinite(c)}) or [0.0]
    work = df.withColumn("_v", F.col(column).cast("double"))
    bucketizer = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_v", outputCol=RANGE, handleInvalid="keep")
    return bucketizer.transform(work).withColumn(RANGE, F.when(F.col("_v").isNull(), -1.0).otherwise(F.col(RANGE))).drop("_v")


def _range_offsets(totals: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Per (key, range): the sum of ``column`` over the key's lower ranges, and over all."""
    window = W.partitionBy(*keys).orderBy(RANGE)
    return totals.select(
        *keys,
        RANGE,
        F.coalesce(F.sum(column).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_lower"),
        F.sum(column).over(W.partitionBy(*keys)).alias("total"),
    )


def value_positions(counts: DataFrame, keys: list[str], value: str, n: str, staged: bool = False) -> DataFrame:
    """Place every row ``(keys, value, n, ...)``, ``n`` copies of a value, on its key's sorted axis.

    Adds ``before`` (copies of smaller values in the key), ``at`` (copies of this
    value, over all its rows), ``total`` (copies in the key) and ``_range``.  The
    rows are staged once, unless they are ``staged`` already, so the source is read
    a single time; null values and empty counts are left out.
    """
    rows = counts.where(F.col(value).isNotNull() & (F.col(n) > 0))
    if not staged:
        rows = write_stage(rows, "positions")
    _check_numeric(rows, value)
    large = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > WHOLE_KEY)
    large = write_stage(large.select(*keys), "large-keys")
    if large.isEmpty():
        return _whole_keys(rows, keys, value, n)
    few, many = (rows.alias("p").join(large.alias("o"), _same(keys), how) for how in ("left_anti", "left_semi"))
    return _whole_keys(few, keys, value, n).unionByName(_by_ranges(many, keys, value, n))


def _whole_keys(rows: DataFrame, keys: list[str], value: str, n: str) -> DataFrame:
    """Positions of keys that one window each can place."""
    key = W.partitionBy(*keys)
    return _placed(rows, keys, value, n, key).withColumn("total", F.sum(n).over(key)).withColumn(RANGE, F.lit(0.0))


def _by_ranges(rows: DataFrame, keys: list[str], value: str, n: str) -> DataFrame:
    """Positions of keys of any size."""
    ranged = with_range(rows, value)
    offsets = _range_offsets(ranged.groupBy(*keys, RANGE).agg(F.sum(n).alias("_n")), keys, "_n")
    local = _placed(ranged, keys, value, n, W.partitionBy(*keys, RANGE))
    joined = local.alias("p").join(offsets.alias("o"), on=_same([*keys, RANGE]), how="inner")
    return joined.select("p.*", "o._lower", "o.total").withColumn("before", F.col("before") + F.col("_lower")).drop("_lower")


def _placed(rows: DataFrame, keys: list[str], value: str, n: str, part) -> DataFrame:
    """``before`` and ``at`` within one window partition; equal values share both."""
    same = part.orderBy(value).rangeBetween(W.currentRow, W.currentRow)
    upto = part.orderBy(value).rangeBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn("at", F.sum(n).over(same)).withColumn("before", F.sum(n).over(upto) - F.col("at"))


def _same(columns: list[str]) -> Column:
    """Null-safe equality of ``p`` and ``o`` on all columns, for keys that may be null."""
    return reduce(lambda a, b: a & b, [F.col(f"p.{c}").eqNullSafe(F.col(f"o.{c}")) for c in columns])


def quantiles(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    probs: list[float],
    zeros: DataFrame | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles of several numeric columns per key.

    Result columns are ``<column>__q<percent>``, e.g. ``area__q50``.  ``zeros``
    (``keys, zeros``) adds that many implicit zeros to each key of a
    single-column call; keys seen only there are kept.
    """
    long = df.unpivot([F.col(k) for k in keys], [F.col(c).cast("double").alias(c) for c in columns], "_metric", "_value")
    counts = long.groupBy(*keys, "_metric", "_value").agg(F.count("*").alias("_n"))
    if zeros is not None:
        if len(columns) != 1:
            raise ValueError("implicit zeros need a single column")
        block = zeros.select(
            *keys, F.lit(columns[0]).alias("_metric"), F.lit(0.0).alias("_value"), F.col("zeros").alias("_n")
        )
        counts = counts.unionByName(block)
    placed = value_positions(counts, [*keys, "_metric"], "_value", "_n")
    picks = []
    for column in columns:
        for prob in probs:
            place = F.lit(float(prob)) * (F.col("total") - 1)
            mine = F.col("_metric") == column
            for side, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
                inside = mine & (F.col("before") <= index) & (index < F.col("before") + F.col("at"))
                picks.append(F.max(F.when(inside, F.col("_value"))).alias(f"_{side}_{_name(column, prob)}"))
            picks.append(F.max(F.when(mine, place - F.floor(place))).alias(f"_part_{_name(column, prob)}"))
    found = placed.groupBy(*keys).agg(*picks)
    names = [_name(c, p) for c in columns for p in probs]
    return found.select(
        *keys,
        *[
            (F.col(f"_lo_{m}") + (F.col(f"_hi_{m}") - F.col(f"_lo_{m}")) * F.col(f"_part_{m}")).alias(m)
            for m in names
        ],
    )


def _name(column: str, prob: float) -> str:
    percent = f"{prob * 100:g}".replace(".", "_")
    return f"{column}__q{percent}"


def number_rows(df: DataFrame, keys: list[str], order: str, ties: list[str] | None = None, name: str = "row_no") -> DataFrame:
    """1-based row number per key along the numeric column ``order``.

    Like ``row_number()`` over the key, but a key that holds a third of all
    rows is numbered by many tasks.  ``order`` is a position: many rows of one
    value, or without one, would be numbered by one task.
    """
    staged = write_stage(df, "numbered")
    ranged = with_range(staged, order)
    totals = ranged.groupBy(*keys, RANGE).agg(F.count("*").alias("_n"))
    offsets = _range_offsets(totals, keys, "_n")
    local = W.partitionBy(*keys, RANGE).orderBy(order, *(ties or []))
    numbered = ranged.withColumn("_local", F.row_number().over(local))
    joined = numbered.alias("p").join(offsets.alias("o"), on=_same([*keys, RANGE]), how="inner")
    return joined.select("p.*", (F.col("p._local") + F.col("o._lower")).cast("long").alias(name)).drop("_local", RANGE)


def first_n(df: DataFrame, order: str, n: int) -> DataFrame:
    """Exactly the first ``n`` rows along a numeric column, or all when there are fewer.

    Nulls come first; which of several equal rows stay at the cut is open.  Whole
    ranges stay spread over all tasks; only the range with the cut is sorted.
    """
    ranged = with_range(write_stage(df, "first"), order)
    sizes = sorted((r[RANGE], r["_n"]) for r in ranged.groupBy(RANGE).agg(F.count("*").alias("_n")).collect())
    left, cut = n, None
    for place, size in sizes:
        if size > left:
            cut = place
            break
        left -= size
    if cut is None:
        return ranged.drop(RANGE)
    inside = ranged.where(F.col(RANGE) == cut).withColumn("_local", F.row_number().over(W.partitionBy(RANGE).orderBy(order)))
    return ranged.where(F.col(RANGE) < cut).unionByName(inside.where(F.col("_local") <= left).drop("_local")).drop(RANGE)


def bh_adjust(df: DataFrame, keys: list[str], p: str, name: str = "p_adj") -> DataFrame:
    """Benjamini-Hochberg adjusted p-values within each key.

    Works on distinct p-values: ``p * m / rank`` with ``rank`` the number of
    tests at most as large, then the running minimum from the largest p down.
    """
    counts = df.groupBy(*keys, p).agg(F.count("*").alias("_n"))
    placed = value_positions(counts, keys, p, "_n").withColumn(
        "_raw", F.col(p) * F.col("total") / (F.col("before") + F.col("at"))
    )
    from_top = W.partitionBy(*keys, RANGE).orderBy(F.desc(p)).rowsBetween(W.unboundedPreceding, 0)
    placed = placed.withColumn("_inside", F.min("_raw").over(from_top))
    above = (
        placed.groupBy(*keys, RANGE)
        .agg(F.min("_raw").alias("_low"))
        .select(
            *keys,
            RANGE,
            F.min("_low")
            .over(W.partitionBy(*keys).orderBy(F.desc(RANGE)).rowsBetween(W.unboundedPreceding, -1))
            .alias("_above"),
        )
    )
    adjusted = (
        placed.alias("p")
        .join(above.alias("o"), on=_same([*keys, RANGE]), how="inner")
        .select(
            *[F.col(f"p.{k}") for k in keys],
            F.col(f"p.{p}"),
            F.least(F.lit(1.0), F.col("p._inside"), F.col("o._above")).alias(name),
        )
    )
    return df.alias("p").join(adjusted.alias("o"), on=_same([*keys, p]), how="left").select("p.*", f"o.{name}")

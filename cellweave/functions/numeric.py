"""Small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: micrometres per pixel of the imaging panel.
UM_PER_PX = 0.120


def to_um(px: Column, um_per_px: float = UM_PER_PX) -> Column:
    return px * um_per_px


def flip_y(space: DataFrame, section: str, y: str = "y") -> DataFrame:
    """Add ``y_flipped`` = section maximum minus y."""
    top = space.groupBy(section).agg(F.max(y).alias("_top"))
    return space.join(top, section).withColumn("y_flipped", F.col("_top") - F.col(y)).drop("_top")


def arcsinh(column: Column, cofactor: float = 5.0) -> Column:
    return F.asinh(column / cofactor)

"""Delaunay edges of the points of each library, without a triangulation.

Two sites are joined when some circle through both holds no site inside.  The
centres of the circles through ``a`` and ``b`` lie on their bisector; a third
site leaves open one side of it, up to a bound that is a quotient of a dot and a
cross product.  So an edge is there when the largest lower bound does not pass
the smallest upper bound (they meet when four sites lie on one circle).

Only sites that touch the Voronoi cell of ``a`` matter.  A few near sites bound
that cell; what can still change it lies in the circles around the corners of
the bounded cell, and, where the cell is open, in half-planes.  Where these
regions are small, one radius search lists all sites in them.  The others, at
the rim of a library or of a large gap, look for the deepest site of each region
in a pyramid of grid cells, take it in, and go on until their regions are empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from cellweave.operators.neighbours import FINEST, Grid, fold_sites, nearest_sites, placed, within_radius
from cellweave.session import write_stage

#: Levels between two layers of the pyramid, and the sites of a cell that is not divided further.
STRIDE = 4
LEAF = 64
#: A region that reaches farther than so many times the known sites is searched in the pyramid.
WIDE = 4.0
#: Relative slack of regions, and of the bounds of an edge (four sites on one circle).
SLACK = 1e-9


def corners(x: np.ndarray, y: np.ndarray) -> list[tuple[float, float, float, float]]:
    """Regions (w, u, v, limit) that can change the Voronoi cell of the origin bounded by the sites (x, y).

    A site p lies in a region when w |p|^2 + u p.x + v p.y <= limit.  The inverted
    sites p / |p|^2 and the origin have a convex hull; its edges are the cell's
    corners, circles through the origin and two sites, and its edges at the
    origin are the cell's open directions, half-planes.
    """
    if not len(x):
        return []
    size = x * x + y * y
    q = sorted({*zip((x / size).tolist(), (y / size).tolist()), (0.0, 0.0)})

    def chain(points: list) -> list:
        out: list = []
        for p in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out

    hull = chain(q)[:-1] + chain(q[::-1])[:-1]
    regions = []
    for (ax, ay), (bx, by) in zip(hull, [*hull[1:], hull[0]]):
        if (ax, ay) == (0.0, 0.0) or (bx, by) == (0.0, 0.0):
            px, py = (bx, by) if (ax, ay) == (0.0, 0.0) else (-ax, -ay)  # along the hull
            norm = float(np.hypot(px, py))
            regions.append((0.0, -py / norm, px / norm, 0.0))
            if len(hull) == 2:
                regions.append((0.0, px / norm, py / norm, 0.0) if (ax, ay) == (0.0, 0.0) else (0.0, -px / norm, -py / norm, 0.0))
        else:
            cross = ax * by - ay * bx
            if cross == 0.0:  # sites on both sides of a line through the origin
                norm = float(np.hypot(bx - ax, by - ay))
                regions.append((0.0, -(by - ay) / norm, (bx - ax) / norm, 0.0))
            else:
                vx, vy = (by - ay) / (2 * cross), (ax - bx) / (2 * cross)
                regions.append((1.0, -2 * vx, -2 * vy, SLACK * (vx * vx + vy * vy)))
    return regions


_REGIONS = ArrayType(StructType([StructField(c, DoubleType()) for c in ("w", "u", "v", "limit")]))


@F.pandas_udf(_REGIONS)
def regions_of(dx: pd.Series, dy: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip("wuv", r), limit=r[3]) for r in corners(np.asarray(x, float), np.asarray(y, float))] for x, y in zip(dx, dy)], index=dx.index, dtype=object)


def open_between(ax: float, ay: float, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each site (x, y), whether a circle through it and (ax, ay) holds none of the other sites inside."""
    dot = (ax - x[None, :]) * (x[:, None] - x[None, :]) + (ay - y[None, :]) * (y[:, None] - y[None, :])
    cross = (x[:, None] - ax) * (y[None, :] - ay) - (y[:, None] - ay) * (x[None, :] - ax)
    other = ~np.eye(len(x), dtype=bool)
    with np.errstate(all="ignore"):
        bound = dot / cross
    low = np.where(other & (cross < 0), bound, -np.inf).max(axis=1, initial=-np.inf)
    high = np.where(other & (cross > 0), bound, np.inf).min(axis=1, initial=np.inf)
    with np.errstate(all="ignore"):
        fits = (low <= high) | (low - high <= SLACK * (1 + np.abs(low) + np.abs(high)))
    return fits & ~(other & (cross == 0) & (dot < 0)).any(axis=1)


@F.pandas_udf(ArrayType(IntegerType()))
def joined(x: pd.Series, y: pd.Series, xs: pd.Series, ys: pd.Series) -> pd.Series:
    """Places of the known sites that are joined with (x, y)."""
    found = [np.flatnonzero(open_between(a, b, np.asarray(p, float), np.asarray(q, float))).tolist() for a, b, p, q in zip(x, y, xs, ys)]
    return pd.Series(found, index=x.index, dtype=object)


def _least(w: Column, u: Column, low: Column, high: Column) -> Column:
    """The least of w t^2 + u t between two ends."""
    at = F.when(w > 0, F.greatest(low, F.least(high, -u / (2 * F.when(w > 0, w).otherwise(1.0))))).otherwise(F.when(u > 0, low).otherwise(high))
    return w * at * at + u * at


def _most(w: Column, u: Column, low: Column, high: Column) -> Column:
    return F.greatest(w * low * low + u * low, w * high * high + u * high)


class Pyramid:
    """Grid cells that hold sites, every ``STRIDE`` levels, down to cells of at most ``LEAF`` sites."""

    def __init__(self, sites: DataFrame, grid: Grid):
        framed = grid.framed(sites)
        cells, leaves, self.depth = None, None, 0
        key = ["library", "level", "cx", "cy"]
        for level in range(0, FINEST + 1, STRIDE):
            cx, cy = grid.cell(F.col("x"), F.col("y"), F.lit(level))
            at = framed.withColumn("level", F.lit(level)).withColumn("cx", cx).withColumn("cy", cy)
            counted = at.groupBy(*key, "_fx", "_fy", "_side").agg(F.count("*").alias("n"))
            counted = write_stage(counted.withColumn("leaf", (F.col("n") <= LEAF) | F.lit(level == FINEST)), "cells")
            cells = counted if cells is None else cells.unionByName(counted)
            inside = write_stage(at.join(counted.select(*key, "leaf"), key), "placed")
            own = inside.where("leaf").select(*key, "site", "x", "y")
            leaves = own if leaves is None else leaves.unionByName(own)
            framed, self.depth = inside.where("not leaf").drop("level", "cx", "cy", "leaf"), level
            if framed.isEmpty():
                break
        parent = [F.floor(F.col(c) / 2**STRIDE).alias(f"p{c}") for c in ("cx", "cy")]
        width = F.col("_side") / F.pow(F.lit(2.0), F.col("level"))
        edge = width * SLACK  # sites on a border may be dealt to either cell
        ends = [(F.col(f) + F.col(c) * width - edge).alias(lo) for f, c, lo in (("_fx", "cx", "x0"), ("_fy", "cy", "y0"))]
        ends += [(F.col(f) + (F.col(c) + 1) * width + edge).alias(hi) for f, c, hi in (("_fx", "cx", "x1"), ("_fy", "cy", "y1"))]
        self.cells = write_stage(cells.select(*key, "leaf", *parent, *ends), "pyramid")
        self.leaves = write_stage(leaves, "leaves")

    def deepest(self, asked: DataFrame) -> DataFrame:
        """(site, other, ox, oy): for each region of ``asked`` (site, number, library, x, y, w, u, v, limit, known) its deepest site that is not known."""
        region = ["site", "number"]
        x0, x1, y0, y1 = F.col("x0") - F.col("x"), F.col("x1") - F.col("x"), F.col("y0") - F.col("y"), F.col("y1") - F.col("y")
        w, u, v = F.col("w"), F.col("u"), F.col("v")
        least, most = _least(w, u, x0, x1) + _least(w, v, y0, y1), _most(w, u, x0, x1) + _most(w, v, y0, y1)
        queries, ends, at = write_stage(asked, "regions"), [], None
        for level in range(0, self.depth + 1, STRIDE):
            layer = self.cells.where(F.col("level") == level)
            if at is None:
                near = queries.join(layer.drop("level", "pcx", "pcy"), "library")
            else:
                open_ = at.where("not leaf").select(*queries.columns, F.col("cx").alias("pcx"), F.col("cy").alias("pcy"))
                near = open_.join(layer.drop("level"), ["library", "pcx", "pcy"])
            near = near.withColumn("least", least).where(F.col("least") <= F.col("limit") + F.abs("limit"))
            # a cell whose every site is inside the region promises one at least as deep as its worst place
            promise = F.when(most < -F.abs("limit"), most)
            best = near.select(*region, promise.alias("m")).groupBy(*region).agg(F.min("m").alias("promise"))
            at = near.join(best, region).where(F.col("promise").isNull() | (F.col("least") <= F.col("promise"))).drop("least", "promise")
            at = write_stage(at.withColumn("level", F.lit(level)), "layer")
            ends.append(at.where("leaf"))
            if level < self.depth and at.where("not leaf").isEmpty():
                break
        found = ends[0]
        for more in ends[1:]:
            found = found.unionByName(more, allowMissingColumns=True)
        sites = self.leaves.select("library", "level", "cx", "cy", F.col("site").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
        dx, dy = F.col("ox") - F.col("x"), F.col("oy") - F.col("y")
        depth = w * (dx * dx + dy * dy) + u * dx + v * dy
        hit = found.join(sites, ["library", "level", "cx", "cy"]).withColumn("depth", depth)
        inside = F.when(w > 0, F.col("depth") <= F.col("limit")).otherwise(F.col("depth") < F.col("limit"))
        new = hit.where(inside & (F.col("other") != F.col("site")) & ~F.array_contains("known", F.col("other")))
        order = F.struct("depth", dx * dx + dy * dy, "other")
        best = new.groupBy(*region).agg(F.min_by(F.struct("other", "ox", "oy"), order).alias("best"))
        return best.select("site", "best.*").distinct()


def _with_regions(known: DataFrame) -> DataFrame:
    """``known`` (library, site, x, y, near) with the regions that its near sites leave open."""
    shifted = F.transform("near", lambda c: c["x"] - F.col("x")), F.transform("near", lambda c: c["y"] - F.col("y"))
    return write_stage(known.withColumn("regions", regions_of(*shifted)), "known")


def _with_near(known: DataFrame, more: DataFrame) -> DataFrame:
    """``known`` with further near sites (site, other, ox, oy)."""
    grouped = more.groupBy("site").agg(F.collect_list(F.struct("other", F.col("ox").alias("x"), F.col("oy").alias("y"))).alias("_more"))
    joined_ = known.join(grouped, "site", "left").withColumn("near", F.when(F.col("_more").isNull(), F.col("near")).otherwise(F.concat("near", "_more")))
    return joined_.drop("_more")


def spatial_delaunay(space: DataFrame, k: int = 14) -> DataFrame:
    """Delaunay edges (library, src, dst, distance) with src < dst, per library.

    Sites on one empty circle are all joined with one another, so the edges do
    not depend on any order.  Cells at one place are represented by the smallest
    id; cells without finite coordinates have no edges (``unplaced`` lists
    them).  Collinear sites form a chain.  ``k`` changes the work, not the result.
    """
    coords = ["library", "x", "y"]
    space = placed(space)
    grid = Grid(space)
    sites = write_stage(fold_sites(space, coords, 0).select("site", *coords), "sites")
    pairs = nearest_sites(sites, grid, k)
    near = pairs.groupBy("site").agg(F.collect_list(F.struct("other", F.col("sx").alias("x"), F.col("sy").alias("y"))).alias("near"))
    reach = pairs.groupBy("site").agg(F.max("distance").alias("reach"))
    known = _with_regions(sites.join(near, "site").join(reach, "site"))
    # a circle through the site reaches as far as its diameter, |(u, v)|
    wide = F.aggregate("regions", F.lit(0.0), lambda m, r: F.greatest(m, F.when(r["w"] > 0, F.hypot(r["u"], r["v"])).otherwise(float("inf"))))
    known = write_stage(known.withColumn("radius", wide * (1 + SLACK)).withColumn("far", F.col("radius") > WIDE * F.col("reach")), "known")
    others = sites.select("library", F.col("site").alias("other"), F.col("x").alias("sx"), F.col("y").alias("sy"))
    dx, dy = F.col("sx") - F.col("x"), F.col("sy") - F.col("y")
    inside = F.exists("regions", lambda r: r["w"] * (dx * dx + dy * dy) + r["u"] * dx + r["v"] * dy <= r["limit"])
    asked = known.where("not far").select("library", "site", "x", "y", "radius", "regions", F.col("near.other").alias("ids"))
    found = within_radius(asked, others, grid).where((F.col("site") != F.col("other")) & inside & ~F.array_contains("ids", F.col("other")))
    columns = ["library", "site", "x", "y", "near"]
    done = _with_near(known.where("not far").select(*columns), found.select("site", "other", F.col("sx").alias("ox"), F.col("sy").alias("oy")))
    done = write_stage(done.select(*columns), "settled")
    rim = known.where("far").select(*columns, "regions")
    if not rim.isEmpty():
        pyramid = Pyramid(sites, grid)
        while True:
            asked = rim.select("site", "library", "x", "y", F.col("near.other").alias("known"), F.posexplode("regions").alias("number", "_r")).select("*", "_r.*").drop("_r")
            found = write_stage(pyramid.deepest(asked), "found")
            done = done.unionByName(rim.join(found.select("site").distinct(), "site", "left_anti").select(*columns))
            if found.isEmpty():
                break
            rim = _with_regions(_with_near(rim.join(found.select("site").distinct(), "site", "left_semi").drop("regions"), found).select(*columns))
    edges = done.withColumn("at", F.explode(joined("x", "y", "near.x", "near.y"))).withColumn("to", F.col("near")[F.col("at")])
    dx, dy = F.col("x") - F.col("to.x"), F.col("y") - F.col("to.y")
    edges = edges.select("library", F.col("site").alias("src"), F.col("to.other").alias("dst"), F.sqrt(dx * dx + dy * dy).alias("distance"))
    return edges.where("src < dst")

"""Gridding of point clouds into elevation models."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo


def finite(c: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))


def points(cloud: DataFrame, xyz: tuple[str, str, str] = ("x", "y", "z")) -> DataFrame:
    """The points all of whose coordinates are finite."""
    ok = F.lit(True)
    for c in xyz:
        ok = ok & finite(F.col(c))
    return cloud.where(ok)


def cell(x: Column, y: Column, step: float) -> tuple[Column, Column]:
    """Global lattice indices: columns to the east, rows to the south; every tile agrees on them."""
    return F.floor(x / step).cast("long"), F.floor(-y / step).cast("long")


def grid(cloud: DataFrame, step: float, values: list[str] = ["z"], keys: list[str] = []) -> DataFrame:
    """keys, cx, cy, n and the mean of each value column by cell.  Sums combine map-side; tiles do not matter."""
    cx, cy = cell(F.col("x"), F.col("y"), step)
    return points(cloud).groupBy(*keys, cx.alias("cx"), cy.alias("cy")).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(v) for v in values])


def grid_weighted(cloud: DataFrame, step: float, radius: int, sigma: float | None = None, values: list[str] = ["z"]) -> DataFrame:
    """cx, cy, n, values: every point spreads over the cells whose centre is within radius cells of its own cell.

    The weight is exp(-d^2 / (2 sigma^2)), d from the point to the cell's centre in ground units; 1 without sigma.
    """
    own = points(cloud).select("x", "y", *values, *[c.alias(n) for n, c in zip(("px", "py"), cell(F.col("x"), F.col("y"), step), strict=True)])
    r = int(math.floor(radius))
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-r, r + 1) for j in range(-r, r + 1) if i * i + j * j <= radius * radius])
    spread = own.withColumn("o", F.explode(offsets)).withColumn("cx", F.col("px") + F.col("o.i")).withColumn("cy", F.col("py") + F.col("o.j"))
    dx = F.col("x") - (F.col("cx") + 0.5e0) * step
    dy = F.col("y") + (F.col("cy") + 0.5e0) * step
    w = F.exp(-(dx * dx + dy * dy) / (2 * sigma * sigma)) if sigma else F.lit(1e0)
    spread = spread.withColumn("w", w)
    return spread.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"), *[F.try_divide(F.sum(F.col("w") * F.col(v)), F.sum("w")).alias(v) for v in values])


def bounds(cloud: DataFrame, step: float, keys: list[str] = []) -> DataFrame:
    """keys, xoff, yoff, xsize, ysize of the grid that holds the finite points; no row for an empty cloud."""
    found = points(cloud).groupBy(*keys).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    found = found.where("x0 IS NOT NULL").withColumn("xoff", F.floor(F.col("x0") / step) * step).withColumn("yoff", F.ceil(F.col("y1") / step) * step)
    xsize = 1 + F.floor((F.col("x1") - F.col("xoff")) / step)
    ysize = 1 - F.floor((F.col("y0") - F.col("yoff")) / step)
    return found.select(*keys, F.col("xoff").cast("double").alias("xoff"), F.col("yoff").cast("double").alias("yoff"), xsize.cast("long").alias("xsize"), ysize.cast("long").alias("ysize"))


def polygon_bounds(polygons: DataFrame, crs: int | str, step: float, keys: list[str], ring: str = "ring") -> DataFrame:
    """keys, x0, x1, y0, y1: the box of a ring (array of struct lon, lat) in a CRS, moved outward to multiples of step.

    A ring without points gives no row.
    """
    at = polygons.select(*keys, F.explode(ring).alias("p"))
    x, y, _ = geo.transform(F.col("p.lon"), F.col("p.lat"), F.lit(0e0), 4979, crs)
    found = at.select(*keys, x.alias("x"), y.alias("y")).groupBy(*keys).agg(*[f(c).alias(f"{c}{i}") for c in "xy" for i, f in enumerate((F.min, F.max))])
    (x0, x1), (y0, y1) = (geo.align(F.col(f"{c}0"), F.col(f"{c}1"), step) for c in "xy")
    return found.select(*keys, x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"))


def first_wins(rasters: DataFrame, order: str, value: str = "z", keys: list[str] = ["cx", "cy"]) -> DataFrame:
    """keys, value: of the rasters that have a value in a cell, that of the first in order."""
    return rasters.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias(value))


def merge_partial(old: DataFrame, new: DataFrame, values: list[str] = ["z"]) -> DataFrame:
    """Sums by cell (cx, cy, n, value sums) of two sets of points: the state of an incremental grid."""
    both = old.unionByName(new)
    return both.groupBy("cx", "cy").agg(F.sum("n").alias("n"), *[F.sum(v).alias(v) for v in values])


def partial(cloud: DataFrame, step: float, values: list[str] = ["z"]) -> DataFrame:
    cx, cy = cell(F.col("x"), F.col("y"), step)
    return points(cloud).groupBy(cx.alias("cx"), cy.alias("cy")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(v) for v in values])

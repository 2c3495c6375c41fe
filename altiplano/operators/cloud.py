"""Filters on gridded 3D points (keys, row, col, id, x, y, z)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .morphology import regions

XYZ = ("x", "y", "z")


def _near(r: float):
    def links(a: dict, b: dict):
        return sum((a[c] - b[c]) * (a[c] - b[c]) for c in XYZ) < r * r

    return links


def _pairs(left: DataFrame, right: DataFrame, window: int, r: float, keys: list[str]) -> DataFrame:
    """Pairs in the pixel window and closer than r: an equi-join on buckets of the window's size.

    The right side is copied to the nine buckets around its own, so every pair meets in the left one's bucket, once.
    """
    size = 2 * window + 1
    b = lambda c: F.floor(F.col(c) / size).cast("long")
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    own = left.withColumn("_bi", b("row")).withColumn("_bj", b("col"))
    other = right.select(*keys, *[F.col(c).alias(f"o_{c}") for c in ("row", "col", *XYZ)], b("row").alias("_i"), b("col").alias("_j"), around.alias("o")).withColumn("_bi", F.col("_i") + F.col("o.i")).withColumn("_bj", F.col("_j") + F.col("o.j"))
    close = _near(r)({c: F.col(c) for c in XYZ}, {c: F.col(f"o_{c}") for c in XYZ})
    return own.join(other, [*keys, "_bi", "_bj"]).where((F.abs(F.col("row") - F.col("o_row")) <= window) & (F.abs(F.col("col") - F.col("o_col")) <= window) & close)


def known(points: DataFrame) -> DataFrame:
    return points.where(" AND ".join(f"{c} IS NOT NULL" for c in XYZ))


def count_neighbors(points: DataFrame, r: float, window: int, keys: list[str] = []) -> DataFrame:
    """points with `neighbors`: those closer than r within the pixel window, itself included; 0 without coordinates."""
    some = known(points)
    n = _pairs(some.select(*keys, "row", "col", "id", *XYZ), some, window, r, keys).groupBy(*keys, "id").agg(F.count(F.lit(1)).alias("neighbors"))
    return points.join(n, [*keys, "id"], "left").select(*points.columns, F.coalesce("neighbors", F.lit(0).cast("long")).alias("neighbors"))


def remove_isolated(points: DataFrame, r: float, window: int, least: int, reach: int = 1, block: int = 256, keys: list[str] = []) -> DataFrame:
    """points with `kept`: those with enough neighbours, and those that a chain of close points joins to one.

    A chain steps between grid neighbours (a square of the reach) closer than r.  Rejected points that are connected
    among themselves are saved together, so one labelling of the rejected ones and one look for an accepted
    neighbour replace the repeated scan.
    """
    counted = count_neighbors(points, r, window, keys).withColumn("_ok", F.col("neighbors") >= least)
    good = known(counted).where("_ok")
    bad = known(counted).where(~F.col("_ok")).select(*keys, "row", "col", "id", *XYZ)
    parts = regions(bad, block, _near(r), keys, reach, list(XYZ))
    touching = _pairs(parts, good, reach, r, keys).select(*keys, "region").distinct()
    saved = parts.join(touching, [*keys, "region"], "left_semi").select(*keys, "id", F.lit(True).alias("_saved"))
    out = counted.join(saved, [*keys, "id"], "left")
    return out.select(*points.columns, "neighbors", (F.col("_ok") | F.coalesce("_saved", F.lit(False))).alias("kept"))


def filter_cloud(points: DataFrame, r: float | None, n: int | None, gsd: float, keys: list[str] = []) -> DataFrame:
    """points with missing coordinates where isolated; only with both r and n.  The window is r in pixels, rounded up."""
    if not r or not n:
        return points
    out = remove_isolated(points, r, math.ceil(r / gsd), n, 1, keys=keys)
    return out.select(*[F.when(F.col("kept"), F.col(c)).alias(c) if c in XYZ else F.col(c) for c in points.columns])


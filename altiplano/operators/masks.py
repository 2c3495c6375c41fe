"""Masks as boolean columns: polygons, borders, rasters, and erosion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_polygon(x: Column, y: Column, polygon: list[tuple[float, float]]) -> Column:
    """Even-odd rule; the polygon is a literal ring (its closing point may be left out)."""
    ring = [*polygon]
    if ring and ring[0] == ring[-1]:
        ring.pop()
    out = F.lit(False)
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], *ring[:1]], strict=True):
        if y1 == y2:
            continue
        crosses = ((y < y1) != (y < y2)) & (x < (y - y1) * ((x2 - x1) / (y2 - y1)) + x1)
        out = out != crosses
    return out


def in_polygon_array(x: Column, y: Column, ring: Column) -> Column:
    """The same for a column of array<struct<x, y>>, so that polygons can be rows of a table."""
    n = F.size(ring)

    def step(inside: Column, i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        t = F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"]) + a["x"]
        return inside != F.coalesce(((y < a["y"]) != (y < b["y"])) & (x < t), F.lit(False))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(False), step)


def inside_border(row: Column, col: Column, height: Column | int, width: Column | int, margin: int) -> Column:
    """Whether a pixel is at least `margin` from the image's edge; a margin of 0 masks nothing."""
    return (row >= margin) & (row < F.lit(height) - margin) & (col >= margin) & (col < F.lit(width) - margin)


def validity(pixels: DataFrame, height: int, width: int, roi: list | None = None, clouds: list | None = None, raster: str | None = None, margin: int = 10) -> DataFrame:
    """pixels with `ok`: inside the roi polygons, outside the cloud polygons, accepted by the raster, off the border."""
    x, y = F.col("col").cast("double"), F.col("row").cast("double")
    ok = inside_border(F.col("row"), F.col("col"), height, width, margin)
    if roi:
        hit = F.lit(False)
        for ring in roi:
            hit = hit | in_polygon(x, y, ring)
        ok = ok & hit
    for ring in clouds or []:
        ok = ok & ~in_polygon(x, y, ring)
    if raster:
        ok = ok & F.coalesce(F.col(raster) != 0, F.lit(False))
    return pixels.withColumn("ok", ok)


def disk(radius: float) -> list[tuple[int, int]]:
    n = int(radius)
    return [(i, j) for i in range(-n, n + 1) for j in range(-n, n + 1) if i * i + j * j <= radius * radius]


def erode(pixels: DataFrame, radius: float, keys: list[str] = [], ok: str = "ok") -> DataFrame:
    """keys, row, col, ok: accepted pixels all of whose disk is accepted; only for a radius of 2 or more.

    Rejected pixels are spread over the disk and taken away, so what is shuffled is the rejected ones' disks (fewer,
    in a mask that is mostly valid) and not all pixels'.  Outside the image nothing is rejected.
    """
    if radius < 2:
        return pixels.select(*keys, "row", "col", ok)
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in disk(radius)])
    bad = pixels.where(~F.col(ok)).select(*keys, "row", "col", F.explode(offsets).alias("o")).select(*keys, (F.col("row") + F.col("o.i")).alias("row"), (F.col("col") + F.col("o.j")).alias("col")).distinct()
    out = pixels.join(bad.withColumn("hit", F.lit(True)), [*keys, "row", "col"], "left")
    return out.select(*keys, "row", "col", (F.col(ok) & F.col("hit").isNull()).alias(ok))

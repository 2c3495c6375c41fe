"""Tiles of regions of interest, their neighbours, and predicates on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tile_length(length: Column, size: int) -> Column:
    """Length of the tiles that cut `length` into round(length / size) even parts (half to even), at least one."""
    first = F.least(length, F.lit(size))
    return F.ceil(length / F.bround(length / first)).cast("int")


def tile_grid(rois: DataFrame, size: int, keys: list[str] = ["roi_id"]) -> DataFrame:
    """keys, ix, iy, x, y, w, h: the tiles of every roi (x, y, w, h), row by row; the last ones are cut short."""
    sized = rois.withColumn("tw", tile_length(F.col("w"), size)).withColumn("th", tile_length(F.col("h"), size))
    steps = lambda length, step: F.sequence(F.lit(0), F.ceil(F.col(length) / F.col(step)).cast("int") - 1)
    cells = sized.withColumn("iy", F.explode(steps("h", "th"))).withColumn("ix", F.explode(steps("w", "tw")))
    x, y = F.col("x") + F.col("ix") * F.col("tw"), F.col("y") + F.col("iy") * F.col("th")
    return cells.select(*keys, "ix", "iy", x.alias("x"), y.alias("y"), F.least(F.col("tw"), F.col("x") + F.col("w") - x).alias("w"), F.least(F.col("th"), F.col("y") + F.col("h") - y).alias("h"))


def neighbors(tiles: DataFrame, keys: list[str] = ["roi_id"]) -> DataFrame:
    """keys, ix, iy, nx, ny: every tile with its up to nine neighbours, itself among them; an equi-join on the index.

    Both sides are shuffled: the tiles of a region are rows that no estimate by the size of its file counts, and a
    broadcast would gather them at the driver.
    """
    around = F.explode(F.flatten(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda j: F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.struct(i.alias("i"), j.alias("j"))))))
    asked = tiles.select(*keys, "ix", "iy", around.alias("o")).select(*keys, "ix", "iy", (F.col("ix") + F.col("o.i")).alias("nx"), (F.col("iy") + F.col("o.j")).alias("ny"))
    there = tiles.select(*keys, F.col("ix").alias("nx"), F.col("iy").alias("ny"))
    return asked.join(there.hint("merge"), [*keys, "nx", "ny"], "left_semi")


def tile_dir(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.format_string("tiles/row_%07d_height_%d/col_%07d_width_%d", y, h, x, w)


def rectangles_intersect(a: Column, b: Column) -> Column:
    """Whether closed rectangles (structs x, y, w, h) share a point; touching counts."""
    return (a["x"] <= b["x"] + b["w"]) & (b["x"] <= a["x"] + a["w"]) & (a["y"] <= b["y"] + b["h"]) & (b["y"] <= a["y"] + a["h"])


def all_nodata(pixels: DataFrame, keys: list[str], nodata: float | None = None, v: str = "v") -> DataFrame:
    """keys, all_nodata: every pixel 0, or every pixel nodata (a null is nodata)."""
    zero = F.bool_and(F.coalesce(F.col(v) == 0, F.lit(False)))
    same = F.bool_and(F.coalesce(F.col(v) == F.lit(nodata).cast("double"), F.col(v).isNull()))
    return pixels.groupBy(*keys).agg((zero | same).alias("all_nodata"))


def footprint_overlaps(tiles: DataFrame, footprints: DataFrame, keys: list[str]) -> DataFrame:
    """Tiles (x, y, w, h) that touch a footprint (x, y, w, h): a semi-join on grid buckets of the mean tile size.

    A rectangle is in every bucket that it touches, so the join is an equi-join and no pair is looked at across the
    whole table; footprints spread over many buckets are few.
    """
    step = tiles.agg(F.greatest(F.avg("w"), F.avg("h"), F.lit(1.0))).first()[0] or 1.0

    def cells(df: DataFrame, name: str) -> DataFrame:
        over = lambda p, n: F.sequence(F.floor(F.col(p) / step), F.floor((F.col(p) + F.col(n)) / step))
        return df.withColumn(name, F.struct("x", "y", "w", "h")).withColumn("bx", F.explode(over("x", "w"))).withColumn("by", F.explode(over("y", "h")))

    met = cells(tiles, "a").join(cells(footprints.select("x", "y", "w", "h"), "b").select("b", "bx", "by"), ["bx", "by"])
    return met.where(rectangles_intersect(F.col("a"), F.col("b"))).select(*keys).distinct()


def useful(tiles: DataFrame, pixels: DataFrame, keys: list[str], footprints: DataFrame, mask: DataFrame, nodata: float | None = None) -> DataFrame:
    """tiles with `useful`: not all nodata, touching a secondary footprint, and with an accepted pixel in the mask.

    pixels: keys, v.  mask: keys, ok.  A tile without pixels is not useful.
    """
    empty = all_nodata(pixels, keys, nodata)
    seen = mask.groupBy(*keys).agg(F.bool_or("ok").alias("any_ok"))
    near = footprint_overlaps(tiles, footprints, keys).withColumn("near", F.lit(True))
    out = tiles.join(empty, keys, "left").join(seen, keys, "left").join(near, keys, "left")
    ok = ~F.coalesce("all_nodata", F.lit(True)) & F.coalesce("any_ok", F.lit(False)) & F.coalesce("near", F.lit(False))
    return out.select(*tiles.columns, ok.alias("useful"))


def keep_useful(pairs: DataFrame, tiles: DataFrame, keys: list[str] = ["roi_id"]) -> DataFrame:
    """Neighbour pairs without the ends that are not useful."""
    good = tiles.where("useful")
    own = pairs.join(good.select(*keys, "ix", "iy"), [*keys, "ix", "iy"], "left_semi")
    return own.join(good.select(*keys, F.col("ix").alias("nx"), F.col("iy").alias("ny")), [*keys, "nx", "ny"], "left_semi")


def bounding_box(points: DataFrame, keys: list[str] = [], x: str = "x", y: str = "y") -> DataFrame:
    """keys, x, y, w, h of the points."""
    return points.groupBy(*keys).agg(F.min(x).alias("x"), F.min(y).alias("y"), (F.max(x) - F.min(x)).alias("w"), (F.max(y) - F.min(y)).alias("h"))


def crop(pixels: DataFrame, x: int, y: int, w: int, h: int, fill: float) -> DataFrame:
    """(row, col, v) of the window, from its own origin; pixels outside the image (or null) are `fill`."""
    spark = pixels.sparkSession
    grid = spark.range(w * h).select((F.col("id") / w).cast("int").alias("row"), (F.col("id") % w).cast("int").alias("col"))
    own = pixels.where(F.col("col").between(x, x + w - 1) & F.col("row").between(y, y + h - 1)).select((F.col("row") - y).alias("row"), (F.col("col") - x).alias("col"), "v")
    return grid.join(own, ["row", "col"], "left").select("row", "col", F.coalesce("v", F.lit(float(fill))).alias("v"))


def extent(tiles: DataFrame) -> DataFrame:
    """x0, y0, x1, y1 over all tiles (x, y, w, h)."""
    return tiles.agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max(F.col("x") + F.col("w")).alias("x1"), F.max(F.col("y") + F.col("h")).alias("y1"))


def mosaic(pixels: DataFrame, tiles: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(row, col, v) of tile pixels in the frame of the whole extent; of overlapping ones the first tile's with a value.

    tiles: keys, x, y and `order`.  Tiles without pixels are holes.
    """
    # two numbers, whatever the input
    base = F.broadcast(tiles.agg(F.min("x").alias("x0"), F.min("y").alias("y0")))
    placed = pixels.where("v IS NOT NULL").join(tiles.select(*keys, "x", "y", order).distinct(), keys).crossJoin(base)
    at = placed.select((F.col("row") + F.col("y") - F.col("y0")).alias("row"), (F.col("col") + F.col("x") - F.col("x0")).alias("col"), order, "v")
    return at.groupBy("row", "col").agg(F.min_by("v", order).alias("v"))


def tile_status(tiles: DataFrame, products: DataFrame, keys: list[str]) -> DataFrame:
    """tiles with status (ok / no dsm) and the number of cells of the product (keys, n)."""
    out = tiles.join(products, keys, "left")
    return out.select(*tiles.columns, F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.when(F.coalesce("n", F.lit(0)) > 0, "ok").otherwise("no dsm").alias("status"))

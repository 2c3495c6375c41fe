"""Pixels of match plots, and tile maps as SVG and KML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_pixels(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, x, y: the pixels of lines between whole points (x1, y1, x2, y2), one for each step along the longer axis.

    The other coordinate is rounded, half to even; a line of one point is that point.
    """
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    n = F.greatest(F.abs(dx), F.abs(dy))
    at = lines.select(*keys, "x1", "y1", dx.alias("dx"), dy.alias("dy"), n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long"))).alias("i"))
    along = lambda start, d: F.bround(F.col(start) + F.when(F.col("n") > 0, F.col("i") * F.col(d) / F.col("n")).otherwise(0.0)).cast("long")
    return at.select(*keys, along("x1", "dx").alias("x"), along("y1", "dy").alias("y"))


def plot_matches(matches: DataFrame, keys: list[str], width: int) -> DataFrame:
    """keys, x, y: the lines of matches over two images side by side, the second moved right by the first's width."""
    whole = lambda c: F.floor(c).cast("long")
    return line_pixels(matches.select(*keys, whole("x1").alias("x1"), whole("y1").alias("y1"), (whole("x2") + width).alias("x2"), whole("y2").alias("y2")), keys)


def _box(x: Column, y: Column, w: Column, h: Column, between: str) -> Column:
    corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    return F.concat_ws(", " if between == " " else " ", *[F.concat_ws(between, *[c.cast("string") for c in p]) for p in corners])


def svg_tile(tile: Column) -> Column:
    """One tile (struct x, y, w, h, dir): its outline, its picture, and its name with a link to its folder."""
    x, y, w, h, folder = (tile[k] for k in ("x", "y", "w", "h", "dir"))
    return F.concat(
        F.lit('<polygon style="fill:white;stroke:black;stroke-width:2" points="'), _box(x, y, w, h, " "), F.lit('"/>'),
        F.format_string('<image href="./%s/dsm.tif.png" x="%d" y="%d" width="%d" height="%d"/>', folder, x, y, w, h),
        F.format_string('<a href="./%s/"><text x="%d" y="%d" text-anchor="middle">%s</text></a>', folder, x + F.floor(w / 2), y + F.floor(h / 2), folder),
    )


def svg_map(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """keys, svg: the map of each region's tiles (x, y, w, h, dir), in order of y and x.  One region's tiles, some
    thousands of short texts, are put together in one row."""
    parts = tiles.groupBy(*keys).agg(F.min("x").alias("x"), F.min("y").alias("y"), F.max(F.col("x") + F.col("w")).alias("x2"), F.max(F.col("y") + F.col("h")).alias("y2"), F.array_sort(F.collect_list(F.struct("y", "x", "w", "h", "dir"))).alias("t"))
    head = F.format_string('<svg xmlns="http://www.w3.org/2000/svg" version="1.1" width="1000px" height="1000px" viewBox="%d %d %d %d">', F.col("x"), F.col("y"), F.col("x2") - F.col("x"), F.col("y2") - F.col("y"))
    return parts.select(*keys, F.concat(head, F.array_join(F.transform("t", svg_tile), ""), F.lit("</svg>")).alias("svg"))


def kml_placemark(name: Column, status: Column, ring: Column) -> Column:
    """A tile's outline (array of struct lon, lat) with its status; a failed one has the style of errors."""
    place = lambda p: F.format_string("%.7f,%.7f,0", p["lon"], p["lat"])
    closed = F.concat(ring, F.slice(ring, 1, 1))
    style = F.when(status == "ok", "#ok").otherwise("#error")
    return F.concat(F.lit("<Placemark><name>"), name, F.lit("</name><description>"), status, F.lit("</description><styleUrl>"), style, F.lit("</styleUrl><Polygon><outerBoundaryIs><LinearRing><coordinates>"), F.array_join(F.transform(closed, place), " "), F.lit("</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>"))

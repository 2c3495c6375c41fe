"""Moving windows over rasters (keys, row, col, v), connected regions, and their cleaning."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..stage import components, least_names, prepare, staged


def window_extremum(pixels: DataFrame, radius: int, how: str, keys: list[str] = [], v: str = "v") -> DataFrame:
    """pixels with v replaced by the least or largest value of the (2 radius + 1) square; nulls are ignored.

    Separable: along rows, then along columns, each a range frame over the index, so gaps are no matter.
    Mirrored borders change nothing for extrema.
    """
    f = {"min": F.min, "max": F.max}[how]
    along = Window.partitionBy(*keys, "row").orderBy("col").rangeBetween(-radius, radius)
    across = Window.partitionBy(*keys, "col").orderBy("row").rangeBetween(-radius, radius)
    return pixels.withColumn(v, f(v).over(along)).withColumn(v, f(v).over(across))


def _mirrored(pixels: DataFrame, radius: int, height: int, width: int) -> DataFrame:
    """pixels and the copies that half-sample mirroring puts outside, up to radius away."""

    def places(i: Column, n: int) -> Column:
        low = F.when(i < radius, F.array(-1 - i)).otherwise(F.array().cast("array<int>"))
        high = F.when(i >= n - radius, F.array(2 * n - 1 - i)).otherwise(F.array().cast("array<int>"))
        return F.concat(F.array(i), low, high)

    row, col = F.col("row").cast("int"), F.col("col").cast("int")
    return pixels.withColumn("row", F.explode(places(row, height))).withColumn("col", F.explode(places(col, width)))


#: Structuring elements by name: the offsets (row, col) of a radius that they hold.
ELEMENTS = {
    "square": lambda i, j, r: True,
    "disk": lambda i, j, r: i * i + j * j <= r * r,
    "cross": lambda i, j, r: i == 0 or j == 0,
}


def window_statistic(pixels: DataFrame, radius: int, how: str, height: int, width: int, keys: list[str] = [], v: str = "v", element: str = "square", seed: int = 0) -> DataFrame:
    """keys, row, col, v of the min, max, median, average, random or rank over the structuring element with mirrored
    borders; nulls are ignored, and a window of nulls gives null.

    rank: how many values of the window are below the centre's; null for a null centre.  random: the value whose place
    has the least hash under the seed, the same at every run.  Every pixel is sent to the windows that it is in, so the
    extra rows are the element's size times the pixels'.
    """
    if how not in ("min", "max", "median", "average", "random", "rank"):
        raise ValueError(f"unknown statistic {how!r}")
    r = range(-radius, radius + 1)
    held = [(i, j) for i in r for j in r if ELEMENTS[element](i, j, radius)]
    o = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in held]))
    spread = _mirrored(pixels.select(*keys, "row", "col", F.col(v).alias("u")), radius, height, width).withColumn("_o", o)
    # a pixel is at an offset of the window that lies the other way
    spread = spread.withColumn("_at", F.xxhash64(F.lit(seed), "row", "col", "_o")).withColumn("row", F.col("row") - F.col("_o.i")).withColumn("col", F.col("col") - F.col("_o.j"))
    spread = spread.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))
    if how == "rank":
        both = spread.join(pixels.select(*keys, "row", "col", F.col(v).alias("c")), [*keys, "row", "col"])
        return both.groupBy(*keys, "row", "col").agg(F.when(F.first("c").isNotNull(), F.count_if(F.col("u") < F.col("c"))).cast("double").alias(v))
    value = {"min": F.min("u"), "max": F.max("u"), "median": F.median("u"), "average": F.avg("u"), "random": F.min_by("u", F.when(F.col("u").isNotNull(), F.col("_at")))}[how]
    return spread.groupBy(*keys, "row", "col").agg(value.alias(v))


def local_range_outliers(pixels: DataFrame, radius: int = 2, limit: float = 5.0, keys: list[str] = [], v: str = "v") -> DataFrame:
    """pixels without the values whose window has largest minus least above the limit."""
    w1 = Window.partitionBy(*keys, "row").orderBy("col").rangeBetween(-radius, radius)
    w2 = Window.partitionBy(*keys, "col").orderBy("row").rangeBetween(-radius, radius)
    both = pixels.withColumn("_lo", F.min(v).over(w1)).withColumn("_hi", F.max(v).over(w1)).withColumn("_lo", F.min("_lo").over(w2)).withColumn("_hi", F.max("_hi").over(w2))
    return both.withColumn(v, F.when(F.col("_hi") - F.col("_lo") <= limit, F.col(v))).drop("_lo", "_hi")


def label_pixels(row: np.ndarray, col: np.ndarray, name: np.ndarray, reach: int, near) -> np.ndarray:
    """The least name of each pixel's region within a block; pixels at most `reach` apart link where near(i, j).

    near takes arrays of places.  A block is a small rectangle, so neighbours are found in a padded grid of places.
    """
    if not len(row):
        return np.empty(0, np.int64)
    pad = max(reach, 1)
    r, c = (x.astype(np.int64) - x.min() + pad for x in (row, col))
    grid = np.full((int(r.max()) + 1 + pad, int(c.max()) + 1 + pad), -1, np.int64)
    grid[r, c] = np.arange(len(row))
    a, b = [], []
    for i, j in _steps(reach):
        other = grid[r + i, c + j]
        one = np.flatnonzero(other >= 0)
        ok = near(one, other[one])
        a.append(one[ok])
        b.append(other[one][ok])
    root = least_names(np.concatenate(a), np.concatenate(b), len(row))
    least = np.full(len(row), np.iinfo(np.int64).max)
    np.minimum.at(least, root, name)
    return least[root]


def _steps(reach: int) -> list[tuple[int, int]]:
    """Half of the neighbours of a pixel: reach 0 the right and the lower one, else of the square of that reach."""
    return [(a, b) for a in range(reach + 1) for b in range(-reach, reach + 1) if (a, b) > (0, 0)] if reach else [(0, 1), (1, 0)]


def regions(pixels: DataFrame, block: int, links, keys: list[str] = [], reach: int = 0, values: list[str] = ["v"]) -> DataFrame:
    """pixels (row, col, id, values) with `region`, the least id of those connected.

    links(left, right): whether two pixels with values connect, written for numpy arrays and columns alike; reach 0:
    the four neighbours, else the square of that reach.  Blocks of `block` pixels are labelled each in one task; pairs
    across block edges link the labels, and only those go through connected components.
    """
    prepare(pixels.sparkSession)
    cut = pixels.withColumn("_br", F.floor(F.col("row") / block)).withColumn("_bc", F.floor(F.col("col") / block))
    types, cols = dict(pixels.dtypes), pixels.columns
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in cols], "region long"])

    def label(part: pd.DataFrame) -> pd.DataFrame:
        v = {c: part[c].to_numpy() for c in values}
        near = lambda i, j: links({c: x[i] for c, x in v.items()}, {c: x[j] for c, x in v.items()})
        got = label_pixels(part["row"].to_numpy(), part["col"].to_numpy(), part["id"].to_numpy(), reach, near)
        return part[cols].assign(region=got)

    own = staged(cut.groupBy(*keys, "_br", "_bc").applyInPandas(label, schema), "regions")
    edge = max(reach, 1)
    inside = lambda c: F.col(c) % block
    rim = own.where((inside("row") < edge) | (inside("row") >= block - edge) | (inside("col") < edge) | (inside("col") >= block - edge))
    o = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _steps(reach)]))
    left = rim.select(*keys, F.col("region").alias("ra"), *[F.col(c).alias(f"a_{c}") for c in values], "row", "col", o.alias("o"))
    left = left.withColumn("row", (F.col("row") + F.col("o.a")).cast(types["row"])).withColumn("col", (F.col("col") + F.col("o.b")).cast(types["col"]))
    right = rim.select(*keys, "row", "col", F.col("region").alias("rb"), *[F.col(c).alias(f"b_{c}") for c in values])
    met = left.join(right, [*keys, "row", "col"]).where(F.col("ra") != F.col("rb"))
    met = met.where(links({c: F.col(f"a_{c}") for c in values}, {c: F.col(f"b_{c}") for c in values}))
    roots = components(met.select(F.col("ra").alias("a"), F.col("rb").alias("b")), tag="regions-cc").select(F.col("node").alias("region"), F.col("root"))
    return own.join(roots, "region", "left").withColumn("region", F.coalesce("root", "region")).drop("root")


def close_values(tolerance: float, v: str = "v"):
    return lambda a, b: (F.abs if isinstance(a[v], Column) else np.abs)(a[v] - b[v]) <= tolerance


def small_components(pixels: DataFrame, least: int, tolerance: float, block: int = 256, keys: list[str] = [], v: str = "v") -> DataFrame:
    """pixels (row, col, id, v) with v null where its region (four neighbours, values within the tolerance) is small."""
    found = regions(pixels.where(F.col(v).isNotNull()), block, close_values(tolerance, v), keys, 0, [v])
    sizes = found.groupBy(*keys, "region").agg(F.count(F.lit(1)).alias("_n"))
    # a region of many pixels is one row on the right; AQE splits its pixels on the left
    good = found.join(sizes, [*keys, "region"]).where(F.col("_n") >= least).select(*keys, "row", "col", F.col(v).alias("_v"))
    return pixels.join(good, [*keys, "row", "col"], "left").select(*[c for c in pixels.columns if c != v], F.col("_v").alias(v))


def clean(pixels: DataFrame, limit: float = 5.0, least: int = 200, radius: int = 2, block: int = 256, keys: list[str] = []) -> DataFrame:
    """Local range outliers out, then small regions."""
    return small_components(local_range_outliers(pixels, radius, limit, keys), least, limit, block, keys)


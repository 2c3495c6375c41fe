"""Fusion of several height maps of the same pixels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import quantile


def _whole(f: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
    """A reducer that is missing where any input is."""
    return lambda z, n: F.when(F.count(z) == n, f(z))


def _some(f: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
    return lambda z, n: f(z)


#: Reducers by name; the nan forms leave missing values out, the others are missing with any of them.
REDUCERS: dict[str, Callable[[Column, Column], Column]] = {
    "min": _whole(F.min), "max": _whole(F.max), "mean": _whole(F.avg), "median": _whole(F.median),
    "nanmin": _some(F.min), "nanmax": _some(F.max), "nanmean": _some(F.avg), "nanmedian": _some(F.median),
}


def average_if_close(z: Column, threshold: float) -> Column:
    """Median of what is there where it lies within the threshold, else missing."""
    return F.when(F.max(z) - F.min(z) <= threshold, F.median(z))


def local_means(heights: DataFrame, n_pairs: int, keys: list[str] = ["tile_id"], pixel: list[str] = ["pixel"]) -> DataFrame:
    """keys, pair, mean: mean height by pair over the pixels that every pair has.

    One aggregation by pixel decides, and the heights ride along in it, so they are shuffled once.
    """
    both = heights.where("z IS NOT NULL").groupBy(*keys, *pixel).agg(F.collect_list(F.struct("pair", "z")).alias("s")).where(F.size("s") == n_pairs)
    return both.select(*keys, F.explode("s").alias("s")).groupBy(*keys, F.col("s.pair").alias("pair")).agg(F.avg("s.z").alias("mean"))


def global_means(means: DataFrame) -> DataFrame:
    """pair, mean: the plain mean of the tiles' means."""
    return means.groupBy("pair").agg(F.avg("mean").alias("mean"))


def fuse(heights: DataFrame, offsets: DataFrame, n_pairs: int, operator: str = "average_if_close", threshold: float = 3.0, keys: list[str] = ["tile_id", "pixel"]) -> DataFrame:
    """keys, z: heights less their pair's offset, reduced by pixel, plus the mean offset.

    offsets: pair, mean; one row for each pair, so it goes by broadcast.
    """
    if operator != "average_if_close" and operator not in REDUCERS:
        raise ValueError(f"unknown fusion operator {operator!r}")
    level = offsets.agg(F.avg("mean").alias("level"))
    shifted = heights.join(F.broadcast(offsets.select("pair", "mean")), "pair").withColumn("s", F.col("z") - F.col("mean"))
    z = average_if_close(F.col("s"), threshold) if operator == "average_if_close" else REDUCERS[operator](F.col("s"), F.lit(n_pairs))
    return shifted.groupBy(*keys).agg(z.alias("z")).crossJoin(F.broadcast(level)).select(*keys, (F.col("z") + F.col("level")).alias("z"))


def _with(pixels: DataFrame, cut: DataFrame, keys: list[str]) -> DataFrame:
    """pixels beside their image's row of cuts, one small row an image."""
    if keys:
        return pixels.join(F.broadcast(cut), keys, "left")
    return pixels.join(F.broadcast(cut), F.lit(True), "left")


def edge_weight(x: Column) -> Column:
    """How little an 8-bit edge response x counts: its distance to 255, squared, and at least a tenth."""
    t = (255e0 - x) / 255e0
    return F.greatest(t * t, F.lit(0.1))


def stretch_8bit(pixels: DataFrame, percent: float = 1.0, v: str = "v", keys: list[str] = []) -> DataFrame:
    """pixels with `byte`: clipped to the percentiles `percent` and 100 - percent of their image (keys) and scaled to
    0..255, half to even.

    A flat image has no scale and gives null, as does a missing value.
    """
    low, high = (quantile(pixels, v, keys, p, name) for p, name in ((percent / 100, "_low"), (1 - percent / 100, "_high")))
    cut = low.join(high, keys) if keys else low.crossJoin(F.broadcast(high))
    t = F.try_divide(F.least(F.greatest(F.col(v), F.col("_low")), F.col("_high")) - F.col("_low"), F.col("_high") - F.col("_low"))
    return _with(pixels, cut, keys).withColumn("byte", F.when(F.col(v).isNotNull(), F.bround(255e0 * t)).cast("int")).drop("_low", "_high")


def reject_low(pixels: DataFrame, share: float = 0.1, v: str = "v", keys: list[str] = []) -> DataFrame:
    """pixels with `accepted`: 0 below the quantile of v in their image (keys), else 255."""
    cut = quantile(pixels, v, keys, share, "_q")
    return _with(pixels, cut, keys).withColumn("accepted", F.when(F.col(v) < F.col("_q"), 0).otherwise(255)).drop("_q")

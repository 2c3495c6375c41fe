"""Altitude ranges, elevation tables, ground control points and virtual matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rpc as R


def linspace(low: Column, high: Column, n: int) -> Column:
    """Array of n values from low to high, both included."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: low + (high - low) * (i.cast("double") / max(1, n - 1)))


def dem_range(boxes: DataFrame, dem: DataFrame, keys: list[str], step: float, fallback: tuple[str, str] | None = None, nodata: float = -32768) -> DataFrame:
    """boxes with dem_min, dem_max over the elevation points inside (lon0 lon1 lat0 lat1), else the fallback columns.

    dem: lon, lat, z.  Both sides meet by lattice cell of `step` degrees, an equi-join, and the box test follows.
    """
    over = lambda a, b: F.sequence(F.floor(F.col(a) / step), F.floor(F.col(b) / step))
    cells = boxes.withColumn("_i", F.explode(over("lon0", "lon1"))).withColumn("_j", F.explode(over("lat0", "lat1")))
    points = dem.where((F.col("z") != nodata) & F.col("z").isNotNull()).withColumn("_i", F.floor(F.col("lon") / step)).withColumn("_j", F.floor(F.col("lat") / step))
    inside = F.col("lon").between(F.col("lon0"), F.col("lon1")) & F.col("lat").between(F.col("lat0"), F.col("lat1"))
    found = cells.join(points, ["_i", "_j"]).where(inside).groupBy(*keys).agg(F.min("z").alias("_lo"), F.max("z").alias("_hi"))
    lo, hi = (F.col(c) for c in fallback) if fallback else (F.lit(None), F.lit(None))
    return boxes.join(found, keys, "left").select(*boxes.columns, F.coalesce("_lo", lo).alias("dem_min"), F.coalesce("_hi", hi).alias("dem_max"))


def altitude_range(exogenous: tuple[Column, Column], srtm: tuple[Column, Column], coarse: tuple[Column, Column], low_margin: float, high_margin: float) -> tuple[Column, Column]:
    """By precedence exogenous, SRTM, coarse; margins are added to the first two only."""
    pick = lambda i, margin: F.coalesce(exogenous[i] + margin, srtm[i] + margin, coarse[i])
    return pick(0, low_margin), pick(1, high_margin)


def sample_dem(points: DataFrame, dem: DataFrame, step: float) -> DataFrame:
    """points (lon, lat, ...) with dem_z of the elevation table's pixel (i, j, z) that they fall on."""
    at = points.withColumn("i", F.floor(F.col("lon") / step).cast("long")).withColumn("j", F.floor(F.col("lat") / step).cast("long"))
    return at.join(dem.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("z").alias("dem_z")), ["i", "j"], "left").drop("i", "j")


def geoid_to_ellipsoid(points: DataFrame, geoid: DataFrame, step: float) -> DataFrame:
    """points (lon, lat, z) with z above the ellipsoid, by bilinear interpolation in a geoid table (i, j, n).

    geoid: undulation n at lon = i * step, lat = j * step.  A point without its four corners gets null, never zero.
    """
    fi, fj = F.col("lon") / step, F.col("lat") / step
    corners = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
    keyed = points.withColumn("_id", F.monotonically_increasing_id())
    spread = keyed.select("_id", "lon", "lat", F.explode(corners).alias("c")).select("_id", (F.floor(fi).cast("long") + F.col("c.a")).alias("i"), (F.floor(fj).cast("long") + F.col("c.b")).alias("j"), F.when(F.col("c.a") == 1, fi - F.floor(fi)).otherwise(1 - (fi - F.floor(fi))).alias("wa"), F.when(F.col("c.b") == 1, fj - F.floor(fj)).otherwise(1 - (fj - F.floor(fj))).alias("wb"))
    n = spread.join(geoid.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "n"), ["i", "j"]).groupBy("_id").agg(F.when(F.count("n") == 4, F.sum(F.col("wa") * F.col("wb") * F.col("n"))).alias("_n"))
    return keyed.join(n, "_id", "left").withColumn("z", F.col("z") + F.col("_n")).drop("_id", "_n")


def corners(x: Column, y: Column, w: Column, h: Column, low: Column, high: Column) -> Column:
    """The eight (x, y, alt) of a region between two heights."""
    return F.array(*[F.struct((x + dx * w).alias("x"), (y + dy * h).alias("y"), z.alias("alt")) for dx in (0e0, 1e0) for dy in (0e0, 1e0) for z in (low, high)])


def geodesic_box(regions: DataFrame, keys: list[str], camera: str = "rpc", factor: float = 1.0) -> DataFrame:
    """keys, lon0, lon1, lat0, lat1 of regions (x, y, w, h and a camera) at their coarse heights."""
    low, high = R.coarse_altitudes(F.col(camera), factor)
    at = regions.select(*keys, camera, F.explode(corners(*[F.col(c) for c in "xywh"], low, high)).alias("c"))
    lon, lat = R.localize(F.col(camera), F.col("c.x"), F.col("c.y"), F.col("c.alt"))
    return at.select(*keys, lon.alias("lon"), lat.alias("lat")).groupBy(*keys).agg(F.min("lon").alias("lon0"), F.max("lon").alias("lon1"), F.min("lat").alias("lat0"), F.max("lat").alias("lat1"))


def corresponding_region(regions: DataFrame, keys: list[str], low: Column, high: Column, a: str = "rpc_a", b: str = "rpc_b") -> DataFrame:
    """keys, x, y, w, h: box in image b of a region of image a between two heights, rounded half to even."""
    at = regions.select(*keys, a, b, F.explode(corners(*[F.col(c) for c in "xywh"], low, high)).alias("c"))
    u, v = R.transfer(F.col(a), F.col(b), F.col("c.x"), F.col("c.y"), F.col("c.alt"))
    box = at.select(*keys, u.alias("u"), v.alias("v")).groupBy(*keys).agg(F.min("u").alias("u0"), F.max("u").alias("u1"), F.min("v").alias("v0"), F.max("v").alias("v1"))
    r = lambda c: F.bround(c).cast("long")
    return box.select(*keys, r(F.col("u0")).alias("x"), r(F.col("v0")).alias("y"), r(F.col("u1") - F.col("u0")).alias("w"), r(F.col("v1") - F.col("v0")).alias("h"))


def altitude_to_disparity_range(regions: DataFrame, keys: list[str], low: Column, high: Column, a: str = "rpc_a", b: str = "rpc_b") -> DataFrame:
    """keys, disp_min, disp_max over the corners of a region (with h1, h2 and pointing) between two heights."""
    at = regions.select(*keys, a, b, "h1", "h2", "pointing", F.explode(corners(*[F.col(c) for c in "xywh"], low, high)).alias("c"))
    d = R.altitude_to_disparity(F.col(a), F.col(b), F.col("c.x"), F.col("c.y"), F.col("c.alt"), F.col("h1"), F.col("h2"), F.col("pointing"))
    return at.select(*keys, d.alias("d")).groupBy(*keys).agg(F.min("d").alias("disp_min"), F.max("d").alias("disp_max"))


def mesh(regions: DataFrame, keys: list[str], n: int, low: Column, high: Column, keep: list[str] = []) -> DataFrame:
    """keys, keep, col, row, alt: n x n x n points of each region, inset by 1/(2n) in the plane, heights inclusive."""
    inset = lambda p, s: linspace(p + s / (2e0 * n), p + s - s / (2e0 * n), n)
    x, y, w, h = (F.col(c).cast("double") for c in "xywh")
    out = regions.withColumns({"_lo": low, "_hi": high}).withColumn("alt", F.explode(linspace(F.col("_lo"), F.col("_hi"), n)))
    return out.withColumn("row", F.explode(inset(y, h))).withColumn("col", F.explode(inset(x, w))).select(*keys, *keep, "col", "row", "alt")


def ground_control_points(regions: DataFrame, keys: list[str], n: int, low: Column, high: Column, camera: str = "rpc") -> DataFrame:
    points = mesh(regions, keys, n, low, high, [camera])
    lon, lat = R.localize(F.col(camera), F.col("col"), F.col("row"), F.col("alt"))
    return points.select(*keys, lon.alias("lon"), lat.alias("lat"), "alt")


def virtual_matches(regions: DataFrame, keys: list[str], n: int, low: Column, high: Column, a: str = "rpc_a", b: str = "rpc_b") -> DataFrame:
    """keys, x1, y1, x2, y2: both images' projections of the region's ground control points."""
    points = mesh(regions, keys, n, low, high, [a, b])
    lon, lat = R.localize(F.col(a), F.col("col"), F.col("row"), F.col("alt"))
    at = points.select(*keys, a, b, lon.alias("lon"), lat.alias("lat"), "alt")
    (x1, y1), (x2, y2) = (R.project(F.col(c), F.col("lon"), F.col("lat"), F.col("alt")) for c in (a, b))
    return at.select(*keys, x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def polygon_box(polygons: DataFrame, keys: list[str], alt: Column, camera: str = "rpc", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """keys, x, y, w, h: image box of polygon vertices (lon, lat) at a height; floor of the origin, ceiling of the size."""
    u, v = R.project(F.col(camera), F.col(lon), F.col(lat), alt)
    box = polygons.select(*keys, u.alias("u"), v.alias("v")).groupBy(*keys).agg(F.min("u").alias("u0"), F.max("u").alias("u1"), F.min("v").alias("v0"), F.max("v").alias("v1"))
    return box.select(*keys, F.floor("u0").alias("x"), F.floor("v0").alias("y"), F.ceil(F.col("u1") - F.col("u0")).alias("w"), F.ceil(F.col("v1") - F.col("v0")).alias("h"))


def ground_sampling_distance(rpc: Column, z: float = 0.0) -> Column:
    """Distance on the ground between neighbouring columns at the image's centre."""
    from ..functions.geo import lonlat_to_geocentric

    def place(d: int) -> Column:
        lon, lat = R.localize(rpc, rpc["col_offset"] + d, rpc["row_offset"], F.lit(float(z)))
        return R.bind(lambda s: F.array(*lonlat_to_geocentric(s["lon"], s["lat"], F.lit(float(z)))), lon=lon, lat=lat)

    def distance(s: Column) -> Column:
        return F.sqrt(sum(((s["p"][i] - s["q"][i]) * (s["p"][i] - s["q"][i]) for i in range(3)), F.lit(0e0)))

    return R.bind(distance, p=place(0), q=place(1))

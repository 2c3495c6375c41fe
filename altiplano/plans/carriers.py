"""Encodings of the star-schema tables as rasters, clouds, matches and points, for the registered queries.

Each is given twice: as a DataFrame and as the SQL of the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, row, col, v: 100 columns, missing where the event is an error."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.expr("CAST(event_id DIV 100 AS INT)").alias("row"), (F.col("event_id") % 100).cast("int").alias("col"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("v"),
    )


RASTER = "raster AS (SELECT event_id AS id, CAST(event_id // 100 AS INT) AS row, CAST(event_id % 100 AS INT) AS col, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)"


def tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raster with the tile (ty, tx) of 25 x 25 that a pixel is in."""
    return raster(spark, sf_dir).withColumn("ty", F.expr("CAST(row DIV 25 AS INT)")).withColumn("tx", F.expr("CAST(col DIV 25 AS INT)"))


TILED = RASTER + ", tiled AS (SELECT *, CAST(row // 25 AS INT) AS ty, CAST(col // 25 AS INT) AS tx FROM raster)"


def heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile_id, pixel, pair, z: three height maps, in tiles of 50 pixels."""
    return table(spark, sf_dir, "events").select(
        F.expr("event_id DIV 150").alias("tile_id"), F.expr("event_id DIV 3").alias("pixel"), (F.col("event_id") % 3).cast("int").alias("pair"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("z"),
    )


HEIGHTS = "heights AS (SELECT event_id // 150 AS tile_id, event_id // 3 AS pixel, CAST(event_id % 3 AS INT) AS pair, CASE WHEN event_type <> 'error' THEN value END AS z FROM events)"


def cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x, y, z, red, green, tile of the line items; z is missing for a return flag of R with full discount."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("x"), F.col("l_partkey").cast("double").alias("y"), F.when(F.col("l_discount") < 0.095, F.col("l_quantity")).alias("z"),
        (F.col("l_tax") * 1000e0).alias("red"), (F.col("l_discount") * 1000e0).alias("green"), (F.col("l_suppkey") % 16).cast("int").alias("tile"),
    )


CLOUD = "cloud AS (SELECT l_extendedprice AS x, CAST(l_partkey AS DOUBLE) AS y, CASE WHEN l_discount < 0.095 THEN l_quantity END AS z, l_tax * 1000e0 AS red, l_discount * 1000e0 AS green, CAST(l_suppkey % 16 AS INT) AS tile FROM lineitem)"


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile, match_id, x1, y1, x2, y2 of the orders: a linear map with small residuals."""
    x1, y1, k = F.col("o_custkey").cast("double"), F.col("o_totalprice") / 1000e0, F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("tile"), k.alias("match_id"), x1.alias("x1"), y1.alias("y1"),
        (0.9e0 * x1 + 0.1e0 * y1 + (k % 7).cast("double") / 10e0).alias("x2"), (-0.1e0 * x1 + 0.9e0 * y1 + (k % 5).cast("double") / 10e0 + 3e0).alias("y2"),
    )


MATCHES = "matches AS (SELECT tile, match_id, x1, y1, 0.9e0 * x1 + 0.1e0 * y1 + CAST(match_id % 7 AS DOUBLE) / 10e0 AS x2, -0.1e0 * x1 + 0.9e0 * y1 + CAST(match_id % 5 AS DOUBLE) / 10e0 + 3e0 AS y2 FROM (SELECT o_orderstatus AS tile, o_orderkey AS match_id, CAST(o_custkey AS DOUBLE) AS x1, o_totalprice / 1000e0 AS y1 FROM orders))"

#: A fundamental matrix a, b, c, d, e and two similarities, as numbers, for the queries on matches.
FUNDAMENTAL = (0.1, -0.7, 0.12, 0.69, -2.5)
H1 = (0.99, 0.05, -3.0, -0.05, 0.99, 12.0, 0.0, 0.0, 1.0)
H2 = (1.01, -0.04, 7.0, 0.04, 1.01, -5.0, 0.00001, 0.0, 1.0)


def fundamental():
    return F.struct(*[F.lit(v).alias(k) for k, v in zip("abcde", FUNDAMENTAL, strict=True)])


def rectified_sql(h1=H1, h2=H2) -> str:
    """SQL of matches with u1, v1, u2, v2."""

    def image(h, x, y, i):
        return f"(({h[3 * i]}e0 * {x} + {h[3 * i + 1]}e0 * {y} + {h[3 * i + 2]}e0) / ({h[6]:f}e0 * {x} + {h[7]}e0 * {y} + {h[8]}e0))"

    return f"rectified AS (SELECT *, {image(h1, 'x1', 'y1', 0)} AS u1, {image(h1, 'x1', 'y1', 1)} AS v1, {image(h2, 'x2', 'y2', 0)} AS u2, {image(h2, 'x2', 'y2', 1)} AS v2 FROM matches)"


def ground(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pid, lon, lat, alt of the customers: around a city in the south."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("pid"), (55e0 + (k % 360).cast("double") / 97e0).alias("lon"), (-21e0 + (k % 83).cast("double") / 41e0).alias("lat"), F.col("c_acctbal").alias("alt"))


GROUND = "ground AS (SELECT c_custkey AS pid, 55e0 + CAST(c_custkey % 360 AS DOUBLE) / 97e0 AS lon, -21e0 + CAST(c_custkey % 83 AS DOUBLE) / 41e0 AS lat, c_acctbal AS alt FROM customer)"


def keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile, side, kp_id, desc of the embeddings."""
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("tile"), (F.col("vec_id") % 2).cast("int").alias("side"), F.col("vec_id").alias("kp_id"), F.col("embedding").alias("desc"))


def rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rid, x, y, w, h of the parts."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("rid"), (k * 37 % 5000).cast("int").alias("x"), (k * 91 % 3000).cast("int").alias("y"), (20 + F.col("p_size")).cast("int").alias("w"), (10 + k % 40).cast("int").alias("h"))


RECTANGLES = "rectangles AS (SELECT p_partkey AS rid, CAST(p_partkey * 37 % 5000 AS INT) AS x, CAST(p_partkey * 91 % 3000 AS INT) AS y, CAST(20 + p_size AS INT) AS w, CAST(10 + p_partkey % 40 AS INT) AS h FROM part)"


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fid, x, y, w, h of the suppliers."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("fid"), (k * 53 % 5000).cast("int").alias("x"), (k * 29 % 3000).cast("int").alias("y"), (30 + k % 50).cast("int").alias("w"), (30 + k % 60).cast("int").alias("h"))


FOOTPRINTS = "footprints AS (SELECT s_suppkey AS fid, CAST(s_suppkey * 53 % 5000 AS INT) AS x, CAST(s_suppkey * 29 % 3000 AS INT) AS y, CAST(30 + s_suppkey % 50 AS INT) AS w, CAST(30 + s_suppkey % 60 AS INT) AS h FROM supplier)"

#: Two cameras: offsets, scales, and the coefficients that are not zero, for the queries and the tests.
CAMERA_NUMBERS = {"col_offset": 5000.0, "col_scale": 5000.0, "row_offset": 4000.0, "row_scale": 4000.0, "lon_offset": 56.8, "lon_scale": 2.0, "lat_offset": -20.0, "lat_scale": 1.2, "alt_offset": 1000.0, "alt_scale": 9000.0}


def _coefficients(terms: dict[int, float]) -> list[float]:
    return [terms.get(i, 0.0) for i in range(20)]


def camera(tilt: float) -> dict:
    """A camera with a viewing tilt; localization is the exact inverse of its linear part."""
    return CAMERA_NUMBERS | {
        "col_num": _coefficients({1: 1.0, 3: tilt}), "col_den": _coefficients({0: 1.0}), "row_num": _coefficients({2: -1.0, 3: tilt / 2}), "row_den": _coefficients({0: 1.0}),
        "lon_num": _coefficients({1: 1.0, 3: -tilt}), "lon_den": _coefficients({0: 1.0}), "lat_num": _coefficients({2: -1.0, 3: tilt / 2}), "lat_den": _coefficients({0: 1.0}),
    }


def curved_camera(tilt: float) -> dict:
    """The same with small second and third order terms and a denominator."""
    more = {4: 0.001, 7: -0.002, 11: 0.0005, 15: 0.0003, 10: 0.0002}
    out = camera(tilt)
    for k in ("col_num", "row_num", "lon_num", "lat_num"):
        out[k] = [v + more.get(i, 0.0) for i, v in enumerate(out[k])]
    for k in ("col_den", "row_den", "lon_den", "lat_den"):
        out[k] = _coefficients({0: 1.0, 1: 0.001, 3: -0.0015})
    return out


def rpc(values: dict):
    """The camera as a literal struct column."""
    return F.struct(*[(F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v)).alias(k) for k, v in values.items()])


def cubic_sql(coef: list[float], x: str, y: str, z: str) -> str:
    from ..functions.rpc import MONOMIALS

    out = f"({coef[0]!r}e0" if "e" not in repr(coef[0]) else f"({coef[0]!r}"
    for c, powers in zip(coef[1:], MONOMIALS[1:], strict=True):
        number = repr(c) if "e" in repr(c) else f"{c!r}e0"
        out += " + " + " * ".join([number, *[v for v, p in zip((x, y, z), powers, strict=True) for _ in range(p)]])
    return out + ")"


def ratio_sql(cam: dict, k: str, x: str, y: str, z: str) -> str:
    """SQL of one coordinate of projection (k col or row) or localization (k lon or lat)."""
    inner = ("lon", "lat", "alt") if k in ("col", "row") else ("col", "row", "alt")
    n = [f"(({v} - {cam[f'{a}_offset']!r}e0) / {cam[f'{a}_scale']!r}e0)" for a, v in zip(inner, (x, y, z), strict=True)]
    return f"({cubic_sql(cam[f'{k}_num'], *n)} / {cubic_sql(cam[f'{k}_den'], *n)} * {cam[f'{k}_scale']!r}e0 + {cam[f'{k}_offset']!r}e0)"

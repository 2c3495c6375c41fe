"""The registered queries of the library, each an operator over a carrier, and the SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, planar
from ..functions import rpc as R
from ..kernels import triangulate
from ..operators import altitude, cloud, drawing, dsm, estimation, fusion, masks, matching, morphology, tiling
from ..sources import geojson, rpcfile
from . import carriers as c

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r(col, n: int = 6):
    """Rounded as the SQL does it, by way of a whole number; rounding the decimal digits differs in large values."""
    one = F.lit(float(10**n))
    return F.round((F.col(col) if isinstance(col, str) else col) * one, 0) / one


# --- elevation models ---


@query(f"WITH {c.CLOUD} SELECT CAST(floor(x / 500e0) AS BIGINT) AS cx, CAST(floor(-y / 50e0) AS BIGINT) AS cy, count(*) AS n, round(avg(z), 6) AS z, round(avg(red), 6) AS red, round(avg(green), 6) AS green FROM cloud WHERE z IS NOT NULL GROUP BY 1, 2")
def dsm_cell_mean(spark, sf):
    at = c.cloud(spark, sf).withColumn("x", F.col("x") / 10e0)
    return dsm.grid(at, 50.0, ["z", "red", "green"]).select("cx", "cy", "n", *[r(v).alias(v) for v in ("z", "red", "green")])


@query(f"""WITH {c.CLOUD}, p AS (SELECT x / 10e0 AS x, y, z FROM cloud WHERE z IS NOT NULL), o AS (SELECT i, j FROM (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j) WHERE i * i + j * j <= 1),
s AS (SELECT x, y, z, CAST(floor(x / 50e0) AS BIGINT) + i AS cx, CAST(floor(-y / 50e0) AS BIGINT) + j AS cy FROM p, o),
w AS (SELECT *, exp(-((x - (cx + 0.5e0) * 50e0) * (x - (cx + 0.5e0) * 50e0) + (y + (cy + 0.5e0) * 50e0) * (y + (cy + 0.5e0) * 50e0)) / (2e0 * 30e0 * 30e0)) AS w FROM s)
SELECT cx, cy, count(*) AS n, round(sum(w * z) / sum(w), 6) AS z FROM w GROUP BY cx, cy""")
def dsm_gaussian_radius(spark, sf):
    at = c.cloud(spark, sf).withColumn("x", F.col("x") / 10e0)
    return dsm.grid_weighted(at, 50.0, 1, 30.0).select("cx", "cy", "n", r("z").alias("z"))


@query(f"WITH {c.CLOUD}, b AS (SELECT tile, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM cloud WHERE z IS NOT NULL GROUP BY tile) SELECT tile, floor(x0 / 4e0) * 4e0 AS xoff, ceil(y1 / 4e0) * 4e0 AS yoff, CAST(1 + floor((x1 - floor(x0 / 4e0) * 4e0) / 4e0) AS BIGINT) AS xsize, CAST(1 - floor((y0 - ceil(y1 / 4e0) * 4e0) / 4e0) AS BIGINT) AS ysize FROM b")
def dsm_bounds_aligned(spark, sf):
    return dsm.bounds(c.cloud(spark, sf), 4.0, ["tile"])


@query(f"WITH {c.CLOUD}, t AS (SELECT tile, CAST(floor(x / 1000e0) AS BIGINT) AS cx, CAST(floor(-y / 100e0) AS BIGINT) AS cy, avg(z) AS z FROM cloud WHERE z IS NOT NULL GROUP BY 1, 2, 3) SELECT cx, cy, round(arg_min(z, tile), 6) AS z FROM t GROUP BY cx, cy")
def mosaic_first_wins(spark, sf):
    tiles = dsm.grid(c.cloud(spark, sf).withColumn("x", F.col("x") / 10e0), 100.0, ["z"], ["tile"])
    return dsm.first_wins(tiles, "tile").select("cx", "cy", r("z").alias("z"))


@query(f"WITH {c.RECTANGLES} SELECT min(x) AS x0, min(y) AS y0, max(x + w) AS x1, max(y + h) AS y1 FROM rectangles")
def mosaic_extent(spark, sf):
    return tiling.extent(c.rectangles(spark, sf))


@query(f"WITH {c.TILED}, p AS (SELECT row % 25 + ty * 20 AS row, col % 25 + tx * 20 AS col, ty * 1000 + tx AS o, v FROM tiled WHERE v IS NOT NULL) SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, arg_min(v, o) AS v FROM p GROUP BY row, col")
def mosaic_pixels(spark, sf):
    t = c.tiled(spark, sf)
    tiles = t.select("ty", "tx", (F.col("tx") * 20).alias("x"), (F.col("ty") * 20).alias("y"), (F.col("ty") * 1000 + F.col("tx")).alias("order")).distinct()
    local = t.select("ty", "tx", (F.col("row") % 25).alias("row"), (F.col("col") % 25).alias("col"), "v")
    return tiling.mosaic(local, tiles, ["ty", "tx"], "order")


@query(f"""WITH {c.TILED}, t AS (SELECT DISTINCT ty, tx FROM tiled), nb AS (SELECT a.ty, a.tx, b.ty AS ny, b.tx AS nx FROM t a JOIN t b ON abs(a.ty - b.ty) <= 1 AND abs(a.tx - b.tx) <= 1)
SELECT nb.ty, nb.tx, count(v) AS n, round(avg(v), 9) AS z FROM nb JOIN tiled p ON p.ty = ny AND p.tx = nx GROUP BY nb.ty, nb.tx""")
def cloud_union_neighbors(spark, sf):
    t = c.tiled(spark, sf).withColumn("roi_id", F.lit(0))
    tiles = t.select("roi_id", F.col("ty").alias("iy"), F.col("tx").alias("ix")).distinct()
    pairs = tiling.neighbors(tiles)
    pixels = t.select(F.col("ty").alias("ny"), F.col("tx").alias("nx"), "v")
    return pairs.join(pixels, ["ny", "nx"]).groupBy(F.col("iy").alias("ty"), F.col("ix").alias("tx")).agg(F.count("v").alias("n"), r(F.avg("v"), 9).alias("z"))


# --- tiles and masks ---


def _rois(spark, sf):
    return c.rectangles(spark, sf).select(F.col("rid").alias("roi_id"), "x", "y", (F.col("w") * 13).alias("w"), (F.col("h") * 17).alias("h"))


_ROIS = f"""{c.RECTANGLES}, rois AS (SELECT rid, x, y, w * 13 AS w, h * 17 AS h FROM rectangles), s AS (SELECT *, CAST(ceil(w / round_even(w / least(w, 200)::DOUBLE, 0)) AS INT) AS tw, CAST(ceil(h / round_even(h / least(h, 200)::DOUBLE, 0)) AS INT) AS th FROM rois),
iy AS (SELECT *, unnest(range(0, CAST(ceil(h / th::DOUBLE) AS BIGINT))) AS iy FROM s), tiles AS (SELECT *, unnest(range(0, CAST(ceil(w / tw::DOUBLE) AS BIGINT))) AS ix FROM iy)"""


@query(f"WITH {_ROIS} SELECT rid AS roi_id, CAST(ix AS INT) AS ix, CAST(iy AS INT) AS iy, CAST(x + ix * tw AS INT) AS x, CAST(y + iy * th AS INT) AS y, CAST(least(tw, w - ix * tw) AS INT) AS w, CAST(least(th, h - iy * th) AS INT) AS h, format('tiles/row_{{:07d}}_height_{{:d}}/col_{{:07d}}_width_{{:d}}', y + iy * th, least(th, h - iy * th), x + ix * tw, least(tw, w - ix * tw)) AS dir FROM tiles")
def tile_grid(spark, sf):
    out = tiling.tile_grid(_rois(spark, sf), 200)
    return out.withColumn("dir", tiling.tile_dir(*[F.col(k) for k in "xywh"]))


@query(f"WITH {_ROIS} SELECT a.rid AS roi_id, CAST(a.ix AS INT) AS ix, CAST(a.iy AS INT) AS iy, count(*) AS n FROM tiles a JOIN tiles b ON a.rid = b.rid AND abs(a.ix - b.ix) <= 1 AND abs(a.iy - b.iy) <= 1 GROUP BY 1, 2, 3")
def tile_neighbors(spark, sf):
    return tiling.neighbors(tiling.tile_grid(_rois(spark, sf), 200)).groupBy("roi_id", "ix", "iy").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {c.TILED} SELECT ty, tx, coalesce(bool_and(coalesce(v = 0, false)), false) OR bool_and(v IS NULL OR v = 50e0) AS all_nodata FROM (SELECT ty, tx // 2 AS tx, CASE WHEN (ty + tx // 2) % 2 = 0 THEN NULL ELSE v END AS v FROM tiled) GROUP BY ty, tx")
def tile_nodata(spark, sf):
    t = c.tiled(spark, sf).withColumn("tx", F.expr("CAST(tx DIV 2 AS INT)")).withColumn("v", F.when((F.col("ty") + F.col("tx")) % 2 != 0, F.col("v")))
    return tiling.all_nodata(t, ["ty", "tx"], 50.0)


@query(f"""WITH {c.TILED}, {c.FOOTPRINTS}, t AS (SELECT ty, tx, tx * 125 AS x, ty * 125 AS y, 25 AS w, 25 AS h, bool_or(v > 200) AS ok, bool_and(v IS NULL) AS e FROM tiled GROUP BY ty, tx)
SELECT ty, tx, CAST(x AS INT) AS x, CAST(y AS INT) AS y, w, h, NOT e AND coalesce(ok, false) AND EXISTS (SELECT 1 FROM footprints f WHERE f.x <= t.x + t.w AND t.x <= f.x + f.w AND f.y <= t.y + t.h AND t.y <= f.y + f.h) AS useful FROM t""")
def tile_useful(spark, sf):
    p = c.tiled(spark, sf)
    tiles = p.select("ty", "tx").distinct().select("ty", "tx", (F.col("tx") * 125).alias("x"), (F.col("ty") * 125).alias("y"), F.lit(25).alias("w"), F.lit(25).alias("h"))
    mask = p.select("ty", "tx", (F.col("v") > 200).alias("ok"))
    return tiling.useful(tiles, p, ["ty", "tx"], c.footprints(spark, sf), mask)


@query(f"WITH {c.RECTANGLES}, {c.FOOTPRINTS} SELECT rid, count(*) AS n FROM rectangles a JOIN footprints b ON a.x <= b.x + b.w AND b.x <= a.x + a.w AND a.y <= b.y + b.h AND b.y <= a.y + a.h GROUP BY rid")
def rect_intersect(spark, sf):
    """The pairs behind the semi-join, by the same buckets; a pair is counted in the bucket of its overlap's corner."""
    step = 128

    def cells(df, names, tag):
        over = lambda p, n: F.sequence(F.floor(F.col(p) / step), F.floor((F.col(p) + F.col(n)) / step))
        return df.select(*names, F.struct("x", "y", "w", "h").alias(tag), F.explode(over("x", "w")).alias("bx"), "y", "h").select(*names, tag, "bx", F.explode(over("y", "h")).alias("by"))

    met = cells(c.rectangles(spark, sf), ["rid"], "a").join(cells(c.footprints(spark, sf), ["fid"], "b"), ["bx", "by"])
    corner = lambda k: F.floor(F.greatest(F.col(f"a.{k}"), F.col(f"b.{k}")) / step)
    own = (F.col("bx") == corner("x")) & (F.col("by") == corner("y"))
    return met.where(tiling.rectangles_intersect(F.col("a"), F.col("b")) & own).groupBy("rid").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {c.RASTER}, g AS (SELECT CAST(i AS INT) AS row, CAST(j AS INT) AS col FROM range(40) a(i), range(60) b(j)) SELECT g.row, g.col, coalesce(v, -1e0) AS v FROM g LEFT JOIN raster p ON p.row = g.row - 10 AND p.col = g.col + 70")
def crop_fill(spark, sf):
    return tiling.crop(c.raster(spark, sf), 70, -10, 60, 40, -1.0)


@query(f"""WITH {c.RASTER}, m AS (SELECT row, col, coalesce(v < 150, true) AS ok FROM raster), o AS (SELECT i, j FROM (SELECT unnest([-2, -1, 0, 1, 2]) AS i), (SELECT unnest([-2, -1, 0, 1, 2]) AS j) WHERE i * i + j * j <= 4),
bad AS (SELECT DISTINCT row + i AS row, col + j AS col FROM m, o WHERE NOT ok) SELECT m.row, m.col, m.ok AND bad.row IS NULL AS ok FROM m LEFT JOIN bad ON bad.row = m.row AND bad.col = m.col""")
def mask_erosion(spark, sf):
    m = c.raster(spark, sf).select("row", "col", F.coalesce(F.col("v") < 150, F.lit(True)).alias("ok"))
    return masks.erode(m, 2)


@query(f"WITH {c.RASTER}, s AS (SELECT max(row) + 1 AS h FROM raster) SELECT id, row >= 7 AND row < h - 7 AND col >= 7 AND col < 100 - 7 AS ok FROM raster, s")
def border_mask(spark, sf):
    p = c.raster(spark, sf)
    return p.select("id", masks.inside_border(F.col("row"), F.col("col"), _height(p), 100, 7).alias("ok"))


POLYGON = [(55.2, -20.9), (57.9, -20.5), (58.2, -19.3), (56.6, -19.9), (55.9, -19.1)]


def _polygon_sql(x, y, ring):
    parts = []
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
        parts.append(f"CASE WHEN (({y} < {y1}e0) <> ({y} < {y2}e0)) AND {x} < ({y} - {y1}e0) * {(x2 - x1) / (y2 - y1)!r}e0 + {x1}e0 THEN 1 ELSE 0 END")
    return f"(({' + '.join(parts)}) % 2 = 1)"


@query(f"WITH {c.GROUND} SELECT pid, {_polygon_sql('lon', 'lat', POLYGON).replace('- -', '+ ')} AS inside FROM ground")
def point_in_polygon(spark, sf):
    return c.ground(spark, sf).select("pid", masks.in_polygon(F.col("lon"), F.col("lat"), POLYGON).alias("inside"))


# --- planar geometry and estimation ---

_XY = ("x1", "y1", "x2", "y2")


@query(f"WITH {c.MATCHES}, {c.rectified_sql()} SELECT match_id, round(u1, 8) AS u1, round(v1, 8) AS v1, round(u2, 6) AS u2, round(v2, 6) AS v2 FROM rectified")
def apply_homography(spark, sf):
    out = estimation.rectified(c.matches(spark, sf), planar.matrix(*c.H1), planar.matrix(*c.H2))
    return out.select("match_id", *[r(k, n).alias(k) for k, n in (("u1", 8), ("v1", 8), ("u2", 6), ("v2", 6))])


@query(f"WITH {c.MATCHES} SELECT match_id, round(x2, 8) AS x, round(y2, 8) AS y FROM matches")
def invert_homography(spark, sf):
    """There and back again: the inverse of a homography undoes it."""
    h = planar.matrix(*c.H2)
    u, v = planar.apply_homography(h, F.col("x2"), F.col("y2"))
    x, y = planar.apply_homography(planar.invert(h), u, v)
    return c.matches(spark, sf).select("match_id", r(x, 8).alias("x"), r(y, 8).alias("y"))


@query(f"WITH {c.MATCHES} SELECT match_id, CASE WHEN match_id % 11 = 0 OR sqrt(0.3e0 * 0.3e0 * (match_id % 3) * (match_id % 3) + 0.4e0 * 0.4e0 * (match_id % 3) * (match_id % 3)) = 0 THEN 1.7976931348623157e308 ELSE round(abs(0.3e0 * (match_id % 3) * x1 + 0.4e0 * (match_id % 3) * y1 - 5e0) / (0.5e0 * (match_id % 3)), 6) END AS d FROM matches")
def point_line_distance(spark, sf):
    k = (F.col("match_id") % 3).cast("double")
    w = F.when(F.col("match_id") % 11 == 0, 0e0).otherwise(1e0)
    d = planar.point_line_distance(F.col("x1"), F.col("y1"), w, 0.3 * k, 0.4 * k, F.lit(-5e0))
    return c.matches(spark, sf).select("match_id", F.when(d >= planar.MAX, d).otherwise(r(d)).alias("d"))


_F = dict(zip("abcde", c.FUNDAMENTAL, strict=True))
_RES = f"({_F['a']}e0 * x2 + {_F['b']}e0 * y2 + {_F['c']}e0 * x1 + {_F['d']}e0 * y1 + {_F['e']}e0)"


@query(f"WITH {c.MATCHES} SELECT match_id FROM matches WHERE greatest(abs{_RES} / sqrt({_F['c']}e0 * {_F['c']}e0 + {_F['d']}e0 * {_F['d']}e0), abs{_RES} / sqrt({_F['a']}e0 * {_F['a']}e0 + {_F['b']}e0 * {_F['b']}e0)) < 40e0")
def epipolar_filter(spark, sf):
    return matching.epipolar_filter(c.matches(spark, sf).withColumn("f", c.fundamental()), 40.0).select("match_id")


@query(f"WITH {c.MATCHES}, t AS (SELECT match_id, {_RES} / ({_F['a']}e0 * {_F['a']}e0 + {_F['b']}e0 * {_F['b']}e0) AS s, {_RES} / ({_F['c']}e0 * {_F['c']}e0 + {_F['d']}e0 * {_F['d']}e0) AS q FROM matches) SELECT match_id, round(s * {_F['a']}e0, 8) AS sx, round(s * ({_F['b']}e0), 8) AS sy, round(q * {_F['c']}e0, 8) AS rx, round(q * {_F['d']}e0, 8) AS ry FROM t")
def epipolar_error_vectors(spark, sf):
    at = [F.col(k) for k in _XY]
    (sx, sy), (rx, ry) = (planar.error_vector(c.fundamental(), *at, side) for side in ("sec", "ref"))
    return c.matches(spark, sf).select("match_id", r(sx, 8).alias("sx"), r(sy, 8).alias("sy"), r(rx, 8).alias("rx"), r(ry, 8).alias("ry"))


_MOMENTS = ", ".join(f"round(sum(({a} - m_{a}) * ({b} - m_{b})) / count(*), 3) AS m_{a}_{b}" for a, b in estimation.PAIRS)


@query(f"WITH {c.MATCHES}, m AS (SELECT tile, avg(x1) AS m_x1, avg(y1) AS m_y1, avg(x2) AS m_x2, avg(y2) AS m_y2 FROM matches GROUP BY tile) SELECT tile, count(*) AS n, {_MOMENTS} FROM matches JOIN m USING (tile) GROUP BY tile")
def affine_moments(spark, sf):
    out = estimation.moments(c.matches(spark, sf), ["tile"])
    return out.select("tile", "n", *[r(F.col(f"m_{a}_{b}") / F.col("n"), 3).alias(f"m_{a}_{b}") for a, b in estimation.PAIRS])


@query()
def affine_fundamental(spark, sf):
    """F by tile and the rectifying similarities; the 4x4 eigenvectors have no SQL."""
    found = estimation.affine_fundamental(c.matches(spark, sf), ["tile"])
    one, two = planar.rectifying_similarities(F.col("f"))
    return found.select("tile", "n", "f", one.alias("h1"), two.alias("h2"))


@query(f"WITH {c.MATCHES} SELECT tile, round(avg(x2 - x1), 6) AS tx, round(avg(y2 - y1), 6) AS ty FROM matches GROUP BY tile")
def mean_translation(spark, sf):
    return estimation.mean_translation(c.matches(spark, sf), ["tile"]).select("tile", r("tx").alias("tx"), r("ty").alias("ty"))


@query(f"WITH {c.MATCHES} SELECT tile, round(avg(x2), 6) AS cx, round(avg(y2), 6) AS cy FROM matches GROUP BY tile")
def match_center(spark, sf):
    return estimation.match_center(c.matches(spark, sf), ["tile"]).select("tile", r("cx").alias("cx"), r("cy").alias("cy"))


@query(f"WITH {c.MATCHES}, t AS (SELECT tile, {_RES} / ({_F['a']}e0 * {_F['a']}e0 + {_F['b']}e0 * {_F['b']}e0) AS s FROM matches) SELECT tile, round(-list_sort(list(s * {_F['a']}e0))[count(*) // 2 + 1], 6) AS tx, round(-list_sort(list(s * ({_F['b']}e0)))[count(*) // 2 + 1], 6) AS ty FROM t GROUP BY tile")
def pointing_upper_median(spark, sf):
    out = estimation.local_pointing(c.matches(spark, sf).withColumn("f", c.fundamental()), ["tile"])
    return out.select("tile", r(planar.m(F.col("a"), 0, 2)).alias("tx"), r(planar.m(F.col("a"), 1, 2)).alias("ty"))


@query(f"""WITH {c.MATCHES}, t AS (SELECT match_id % 13 AS pair, match_id // 13 % (1 + match_id % 13 % 2) AS k, avg(x2) AS cx, avg(y2) AS cy, avg(x2 - x1) AS dx, avg(y2 - y1) AS dy FROM matches GROUP BY 1, 2)
SELECT pair, round(avg(-dx), 6) AS tx, round(avg(-dy), 6) AS ty FROM t GROUP BY pair""")
def pointing_global_few(spark, sf):
    """Pairs of one tile (even) and of two (odd): that correction, and the mean translation of the corrected centres."""
    m = c.matches(spark, sf).withColumn("pair", F.col("match_id") % 13).withColumn("k", F.expr("match_id DIV 13 % (1 + match_id % 13 % 2)"))
    out = estimation.global_pointing(_mean_corrections(m, ["pair", "k"]))
    return out.select("pair", r(planar.m(F.col("a"), 0, 2)).alias("tx"), r(planar.m(F.col("a"), 1, 2)).alias("ty"))


def _mean_corrections(m, keys):
    """keys, a, cx, cy: a tile's mean displacement undone, and its centre in the second image."""
    d = lambda k: F.avg(F.col(f"{k}2") - F.col(f"{k}1"))
    return m.groupBy(*keys).agg(F.avg("x2").alias("cx"), F.avg("y2").alias("cy"), planar.translation(-d("x"), -d("y")).alias("a"))


@query()
def pointing_global_all(spark, sf):
    """All matches, a tile a status and a quarter of the ids: the affine map of a pair's corrected centres."""
    m = c.matches(spark, sf).withColumn("pair", F.col("match_id") % 13).withColumn("k", F.expr("match_id DIV 13 % 4"))
    out = estimation.global_pointing(_mean_corrections(m, ["pair", "tile", "k"]))
    return out.select("pair", *[r(planar.m(F.col("a"), i, j)).alias(f"a{i}{j}") for i in range(2) for j in range(3)])


def _rect(spark, sf):
    return estimation.rectified(c.matches(spark, sf), planar.matrix(*c.H1), planar.matrix(*c.H2))


_RECT = f"{c.MATCHES}, {c.rectified_sql()}"


@query(f"""WITH {_RECT}, m AS (SELECT tile, avg(u1) AS mt, avg(u2) AS mu, avg(v2) AS mv FROM rectified GROUP BY tile),
s AS (SELECT tile, any_value(mt) AS mt, any_value(mu) AS mu, any_value(mv) AS mv, sum((u2 - mu) * (u2 - mu)) AS uu, sum((u2 - mu) * (v2 - mv)) AS uv, sum((v2 - mv) * (v2 - mv)) AS vv, sum((u1 - mt) * (u2 - mu)) AS tu, sum((u1 - mt) * (v2 - mv)) AS tv FROM rectified JOIN m USING (tile) GROUP BY tile),
k AS (SELECT *, (tu * vv - tv * uv) / (uu * vv - uv * uv) AS a, (tv * uu - tu * uv) / (uu * vv - uv * uv) AS b FROM s) SELECT tile, round(a, 6) AS a, round(b, 6) AS b, round(mt - a * mu - b * mv, 4) AS c FROM k""")
def register_shear(spark, sf):
    return estimation.shear(_rect(spark, sf), ["tile"]).select("tile", r("a").alias("a"), r("b").alias("b"), r("c", 4).alias("c"))


@query(f"WITH {_RECT} SELECT tile, round(avg(u2 - u1), 6) AS center, round(min(u2 - u1), 6) AS positive, round(max(u2 - u1), 6) AS negative FROM rectified GROUP BY tile")
def register_translation(spark, sf):
    at = _rect(spark, sf)
    out = None
    for flag in ("center", "positive", "negative"):
        one = estimation.horizontal_translation(at, ["tile"], flag).select("tile", r("t").alias(flag))
        out = one if out is None else out.join(one, "tile")
    return out


@query(f"""WITH {_RECT}, m AS (SELECT tile, floor(min(u2 - u1)) AS lo, ceil(max(u2 - u1)) AS hi, count(*) AS n FROM rectified GROUP BY tile), w AS (SELECT tile, n, lo - (hi - lo) * 0.2e0 AS lo, hi FROM m), d AS (SELECT tile, n, lo, hi + (hi - lo) * 0.2e0 AS hi FROM w)
SELECT tile, n, round(lo, 6) AS disp_min, round(hi, 6) AS disp_max, round(least(lo, -20e0, -3e0), 6) AS wide_min, round(greatest(hi, 15e0, 3e0), 6) AS wide_max FROM d""")
def disparity_range(spark, sf):
    found = estimation.match_disparities(_rect(spark, sf), ["tile"])
    lo, hi = estimation.disparity_range("wider_sift_exogenous", (F.col("disp_min"), F.col("disp_max"), F.col("n")), (F.lit(-20e0), F.lit(15e0)))
    return found.select("tile", "n", r("disp_min").alias("disp_min"), r("disp_max").alias("disp_max"), r(lo).alias("wide_min"), r(hi).alias("wide_max"))


@query(f"""WITH {c.MATCHES}, m AS (SELECT *, CAST(floor(x1 / 500e0) AS INT) AS mx, CAST(floor(y1 / 100e0) AS INT) AS my FROM matches), b AS (SELECT min(mx) AS x0, max(mx) AS x1, min(my) AS y0, max(my) AS y1 FROM m),
t AS (SELECT ix, iy, ix * 500 AS x, iy * 100 AS y, 500 AS w, 100 AS h FROM (SELECT CAST(unnest(range(x0, x1 + 1)) AS INT) AS ix FROM b), (SELECT CAST(unnest(range(y0, y1 + 1)) AS INT) AS iy FROM b)),
o AS (SELECT i, j FROM (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j)), near AS (SELECT m.*, mx + i AS nx, my + j AS ny FROM m, o)
SELECT t.ix, t.iy, count(*) AS n, round(avg(x1), 6) AS mx1 FROM t JOIN near ON nx = ix AND ny = iy
WHERE (mx = ix AND my = iy) OR sqrt(((x1 - x - w / 2e0) / w) * ((x1 - x - w / 2e0) / w) + ((y1 - y - h / 2e0) / h) * ((y1 - y - h / 2e0) / h)) < 0.75e0 GROUP BY t.ix, t.iy""")
def neighbor_matches_ellipse(spark, sf):
    """The tile grid is that of the matches' extent."""
    m = c.matches(spark, sf).withColumns({"roi_id": F.lit(0), "ix": F.floor(F.col("x1") / 500e0).cast("int"), "iy": F.floor(F.col("y1") / 100e0).cast("int")})
    over = lambda k: F.explode(F.sequence(F.col(f"{k}0"), F.col(f"{k}1"))).alias(f"i{k}")
    box = m.agg(F.min("ix").alias("x0"), F.max("ix").alias("x1"), F.min("iy").alias("y0"), F.max("iy").alias("y1"))
    grid = box.select(F.lit(0).alias("roi_id"), over("x"), "y0", "y1").select("roi_id", "ix", over("y"))
    tiles = grid.withColumns({"x": F.col("ix") * 500, "y": F.col("iy") * 100, "w": F.lit(500), "h": F.lit(100)})
    out = matching.with_neighbors(m, tiles, tiling.neighbors(tiles))
    return out.groupBy("ix", "iy").agg(F.count(F.lit(1)).alias("n"), r(F.avg("x1")).alias("mx1"))


@query(f"WITH {c.MATCHES} SELECT tile, count(*) AS n FROM (SELECT DISTINCT tile, floor(x1 / 50e0) AS x1, floor(y1 / 50e0) AS y1, floor(x2 / 50e0) AS x2, floor(y2 / 50e0) AS y2 FROM matches) GROUP BY tile")
def distinct_matches(spark, sf):
    m = c.matches(spark, sf).select("tile", *[F.floor(F.col(k) / 50e0).alias(k) for k in _XY])
    return matching.distinct(m, ["tile"]).groupBy("tile").agg(F.count(F.lit(1)).alias("n"))


# --- cameras and geodesy ---

_CAM, _CURVED = c.camera(0.3), c.curved_camera(0.2)


@query(f"WITH {c.GROUND} SELECT pid, round({c.ratio_sql(_CURVED, 'col', 'lon', 'lat', 'alt')}, 5) AS col, round({c.ratio_sql(_CURVED, 'row', 'lon', 'lat', 'alt')}, 5) AS row FROM ground")
def rpc_projection(spark, sf):
    col, row = R.project(c.rpc(_CURVED), F.col("lon"), F.col("lat"), F.col("alt"))
    return c.ground(spark, sf).select("pid", r(col, 5).alias("col"), r(row, 5).alias("row"))


_COEF = [round(0.1 * ((7 * i) % 11) - 0.4, 1) for i in range(20)]


@query(f"WITH {c.GROUND} SELECT pid, round({c.cubic_sql(_COEF, '((lon - 56e0) / 3e0)', '((lat + 20e0) / 2e0)', '(alt / 9000e0)')}, 6) AS p FROM ground")
def rpc_polynomial(spark, sf):
    p = R.polynomial(F.array(*[F.lit(v) for v in _COEF]), (F.col("lon") - 56e0) / 3e0, (F.col("lat") + 20e0) / 2e0, F.col("alt") / 9000e0)
    return c.ground(spark, sf).select("pid", r(p).alias("p"))


@query(f"WITH {c.MATCHES} SELECT match_id, round({c.ratio_sql(_CURVED, 'lon', 'x1', 'y1', '500e0')}, 8) AS lon, round({c.ratio_sql(_CURVED, 'lat', 'x1', 'y1', '500e0')}, 8) AS lat FROM matches")
def rpc_localization(spark, sf):
    lon, lat = R.localize(c.rpc(_CURVED), F.col("x1"), F.col("y1"), F.lit(500e0))
    return c.matches(spark, sf).select("match_id", r(lon, 8).alias("lon"), r(lat, 8).alias("lat"))


def _regions(spark, sf):
    return c.rectangles(spark, sf).withColumns({"rpc": c.rpc(_CAM), "rpc_a": c.rpc(_CAM), "rpc_b": c.rpc(_CURVED)})


_MESH = f"{c.RECTANGLES}, g AS (SELECT rid, x + w / 6e0 + i * (w - w / 3e0) / 2e0 AS col, y + h / 6e0 + j * (h - h / 3e0) / 2e0 AS row, k * 400e0 AS alt FROM rectangles, range(3) a(i), range(3) b(j), range(3) d(k))"


@query(f"WITH {_MESH}, p AS (SELECT rid, alt, {c.ratio_sql(_CAM, 'lon', 'col', 'row', 'alt')} AS lon, {c.ratio_sql(_CAM, 'lat', 'col', 'row', 'alt')} AS lat FROM g) SELECT rid, count(*) AS n, round(avg(lon), 7) AS lon, round(avg(lat), 7) AS lat, round(max(alt), 3) AS alt FROM p GROUP BY rid")
def gcp_mesh(spark, sf):
    points = altitude.ground_control_points(_regions(spark, sf), ["rid"], 3, F.lit(0e0), F.lit(800e0))
    return points.groupBy("rid").agg(F.count(F.lit(1)).alias("n"), r(F.avg("lon"), 7).alias("lon"), r(F.avg("lat"), 7).alias("lat"), r(F.max("alt"), 3).alias("alt"))


@query(f"""WITH {_MESH}, p AS (SELECT rid, alt, {c.ratio_sql(_CAM, 'lon', 'col', 'row', 'alt')} AS lon, {c.ratio_sql(_CAM, 'lat', 'col', 'row', 'alt')} AS lat FROM g),
m AS (SELECT rid, {c.ratio_sql(_CAM, 'col', 'lon', 'lat', 'alt')} AS x1, {c.ratio_sql(_CAM, 'row', 'lon', 'lat', 'alt')} AS y1, {c.ratio_sql(_CURVED, 'col', 'lon', 'lat', 'alt')} AS x2, {c.ratio_sql(_CURVED, 'row', 'lon', 'lat', 'alt')} AS y2 FROM p)
SELECT rid, round(avg(x1), 4) AS x1, round(avg(y1), 4) AS y1, round(avg(x2), 4) AS x2, round(min(y2), 4) AS y2 FROM m GROUP BY rid""")
def virtual_matches(spark, sf):
    m = altitude.virtual_matches(_regions(spark, sf), ["rid"], 3, F.lit(0e0), F.lit(800e0))
    return m.groupBy("rid").agg(*[r(F.avg(k), 4).alias(k) for k in ("x1", "y1", "x2")], r(F.min("y2"), 4).alias("y2"))


@query(f"WITH {c.GROUND} SELECT pid, round(CASE WHEN pid % 3 = 0 THEN alt - 10e0 WHEN pid % 3 = 1 THEN alt + 1e0 - 10e0 ELSE -8000e0 END, 6) AS low, round(CASE WHEN pid % 3 = 0 THEN alt + 60e0 + 100e0 WHEN pid % 3 = 1 THEN alt + 50e0 + 100e0 ELSE 10000e0 END, 6) AS high FROM ground")
def altitude_range(spark, sf):
    k, z = F.col("pid") % 3, F.col("alt")
    low, high = altitude.altitude_range((F.when(k == 0, z), F.when(k == 0, z + 60e0)), (F.when(k == 1, z + 1e0), F.when(k == 1, z + 50e0)), R.coarse_altitudes(c.rpc(_CAM)), -10.0, 100.0)
    return c.ground(spark, sf).select("pid", r(low).alias("low"), r(high).alias("high"))


@query(f"""WITH {c.RASTER}, {c.RECTANGLES}, b AS (SELECT rid, x / 40e0 AS lon0, (x + w) / 40e0 AS lon1, y / 40e0 AS lat0, (y + h) / 40e0 AS lat1 FROM rectangles)
SELECT rid, coalesce(min(v), -500e0) AS dem_min, coalesce(max(v), 9000e0) AS dem_max FROM b LEFT JOIN raster p ON p.v IS NOT NULL AND p.col BETWEEN lon0 AND lon1 AND p.row BETWEEN lat0 AND lat1 GROUP BY rid""")
def dem_window_minmax(spark, sf):
    dem = c.raster(spark, sf).select(F.col("col").cast("double").alias("lon"), F.col("row").cast("double").alias("lat"), F.col("v").alias("z"))
    boxes = c.rectangles(spark, sf).select("rid", (F.col("x") / 40e0).alias("lon0"), ((F.col("x") + F.col("w")) / 40e0).alias("lon1"), (F.col("y") / 40e0).alias("lat0"), ((F.col("y") + F.col("h")) / 40e0).alias("lat1"), F.lit(-500e0).alias("lo"), F.lit(9000e0).alias("hi"))
    return altitude.dem_range(boxes, dem, ["rid"], 2.0, ("lo", "hi")).select("rid", "dem_min", "dem_max")


@query(f"WITH {c.GROUND}, p AS (SELECT pid, lon * 3e0 - 180e0 AS lon, lat + 20e0 AS lat FROM ground) SELECT pid, CAST(floor((lon + 180e0) / 6e0) AS INT) + 1 AS zone, CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + CAST(floor((lon + 180e0) / 6e0) AS INT) + 1 AS epsg FROM p")
def utm_zone_epsg(spark, sf):
    lon, lat = F.col("lon") * 3e0 - 180e0, F.col("lat") + 20e0
    return c.ground(spark, sf).select("pid", geo.utm_zone(lon).alias("zone"), geo.epsg_of_zone(geo.utm_zone_name(lon, lat)).alias("epsg"))


_RADIUS, _ALPHA, _, _ = geo._series()
_N = geo._third()
_K = 2 * _N**0.5 / (1 + _N)
_UTM = f"""WITH {c.GROUND}, z AS (SELECT *, CAST(floor((lon + 180e0) / 6e0) AS INT) + 1 AS zone FROM ground), a AS (SELECT pid, radians(lat) AS phi, radians(lon - (zone * 6e0 - 183e0)) AS lam FROM z),
s AS (SELECT pid, lam, ln((1 + sin(phi)) / (1 - sin(phi))) / 2 - {_K!r} * (ln((1 + {_K!r} * sin(phi)) / (1 - {_K!r} * sin(phi))) / 2) AS q FROM a),
t AS (SELECT pid, lam, (exp(q) - exp(-q)) / 2 AS t FROM s), u AS (SELECT pid, atan2(t, cos(lam)) AS xi, ln((1 + sin(lam) / sqrt(1 + t * t)) / (1 - sin(lam) / sqrt(1 + t * t))) / 2 AS eta FROM t)
SELECT pid, round(500000e0 + 0.9996e0 * {_RADIUS!r} * (eta + {' + '.join(f'{a!r} * cos({2 * j} * xi) * (exp({2 * j} * eta) - exp(-{2 * j} * eta)) / 2' for j, a in enumerate(_ALPHA, 1))}), 3) AS east,
  round(10000000e0 + 0.9996e0 * {_RADIUS!r} * (xi + {' + '.join(f'{a!r} * sin({2 * j} * xi) * (exp({2 * j} * eta) + exp(-{2 * j} * eta)) / 2' for j, a in enumerate(_ALPHA, 1))}), 3) AS north FROM u"""


@query(_UTM)
def lonlat_to_utm(spark, sf):
    east, north = geo.lonlat_to_utm(F.col("lon"), F.col("lat"), geo.utm_zone(F.col("lon")), F.col("lat") >= 0)
    return c.ground(spark, sf).select("pid", r(east, 3).alias("east"), r(north, 3).alias("north"))


@query(f"SELECT pid // 40 AS poly, floor(min(east) / 25e0) * 25e0 AS x0, ceil(max(east) / 25e0) * 25e0 AS x1, floor(min(north) / 25e0) * 25e0 AS y0, ceil(max(north) / 25e0) * 25e0 AS y1 FROM ({_UTM.replace('lon + 180e0', '57e0 + 180e0').replace('(zone * 6e0 - 183e0)', '57e0')}) GROUP BY 1")
def polygon_bounds(spark, sf):
    """Rings of forty points, in one zone."""
    rings = c.ground(spark, sf).groupBy(F.expr("pid DIV 40").alias("poly")).agg(F.collect_list(F.struct("lon", "lat")).alias("ring"))
    out = dsm.polygon_bounds(rings, 32740, 25.0, ["poly"])
    return out.select("poly", *[F.col(k).cast("double").alias(k) for k in ("x0", "x1", "y0", "y1")])


_E2 = geo.FLATTENING * (2 - geo.FLATTENING)


@query(f"WITH {c.GROUND}, n AS (SELECT *, {geo.SEMI_MAJOR!r} / sqrt(1 - {_E2!r} * sin(radians(lat)) * sin(radians(lat))) AS n FROM ground) SELECT pid, round((n + alt) * cos(radians(lat)) * cos(radians(lon)), 3) AS x, round((n + alt) * cos(radians(lat)) * sin(radians(lon)), 3) AS y, round((n * (1 - {_E2!r}) + alt) * sin(radians(lat)), 3) AS z FROM n")
def lonlat_to_ecef(spark, sf):
    x, y, z = geo.lonlat_to_geocentric(F.col("lon"), F.col("lat"), F.col("alt"))
    return c.ground(spark, sf).select("pid", r(x, 3).alias("x"), r(y, 3).alias("y"), r(z, 3).alias("z"))


@query(f"WITH {c.GROUND} SELECT pid, round(lon, 6) AS lon, round(lat, 6) AS lat, round(alt, 3) AS alt FROM ground")
def crs_round_trip(spark, sf):
    """Longitude and latitude to UTM and to geocentric coordinates and back."""
    zone, north = geo.utm_zone(F.col("lon")), F.col("lat") >= 0
    lon, lat = geo.utm_to_lonlat(*geo.lonlat_to_utm(F.col("lon"), F.col("lat"), zone, north), zone, north)
    _, _, alt = geo.geocentric_to_lonlat(*geo.lonlat_to_geocentric(F.col("lon"), F.col("lat"), F.col("alt")))
    return c.ground(spark, sf).select("pid", r(lon, 6).alias("lon"), r(lat, 6).alias("lat"), r(alt, 3).alias("alt"))


_CAMERAS = (_CAM, _CURVED, c.camera(-0.25))


def _gsd_sql(cam):
    def ecef(col):
        lon, lat = c.ratio_sql(cam, "lon", col, f"{cam['row_offset']!r}e0", "0e0"), c.ratio_sql(cam, "lat", col, f"{cam['row_offset']!r}e0", "0e0")
        n = f"({geo.SEMI_MAJOR!r} / sqrt(1 - {_E2!r} * sin(radians({lat})) * sin(radians({lat}))))"
        return f"{n} * cos(radians({lat})) * cos(radians({lon}))", f"{n} * cos(radians({lat})) * sin(radians({lon}))", f"{n} * (1 - {_E2!r}) * sin(radians({lat}))"

    one, two = ecef(f"{cam['col_offset']!r}e0"), ecef(f"{cam['col_offset'] + 1!r}e0")
    return " + ".join(f"(({a}) - ({b})) * (({a}) - ({b}))" for a, b in zip(one, two, strict=True))


@query("SELECT r_regionkey, round(sqrt(CASE r_regionkey % 3 " + " ".join(f"WHEN {i} THEN {_gsd_sql(cam)}" for i, cam in enumerate(_CAMERAS)) + " END), 3) AS gsd FROM region")
def gsd(spark, sf):
    at = F.col("r_regionkey") % 3
    cam = F.coalesce(*[F.when(at == i, c.rpc(cam)) for i, cam in enumerate(_CAMERAS)])
    found = R.bind(lambda s: altitude.ground_sampling_distance(s["rpc"]), rpc=cam)
    return c.table(spark, sf, "region").select("r_regionkey", r(found, 3).alias("gsd"))


_CORNERS = "c AS (SELECT rid, x + i * w::DOUBLE AS x, y + j * h::DOUBLE AS y, k * 800e0 AS alt FROM rectangles, range(2) a(i), range(2) b(j), range(2) d(k))"


@query(f"""WITH {c.RECTANGLES}, {_CORNERS}, g AS (SELECT rid, alt, {c.ratio_sql(_CAM, 'lon', 'x', 'y', 'alt')} AS lon, {c.ratio_sql(_CAM, 'lat', 'x', 'y', 'alt')} AS lat FROM c), p AS (SELECT rid, {c.ratio_sql(_CURVED, 'col', 'lon', 'lat', 'alt')} AS u, {c.ratio_sql(_CURVED, 'row', 'lon', 'lat', 'alt')} AS v FROM g)
SELECT rid, CAST(round_even(min(u), 0) AS BIGINT) AS x, CAST(round_even(min(v), 0) AS BIGINT) AS y, CAST(round_even(max(u) - min(u), 0) AS BIGINT) AS w, CAST(round_even(max(v) - min(v), 0) AS BIGINT) AS h FROM p GROUP BY rid""")
def corresponding_roi(spark, sf):
    return altitude.corresponding_region(_regions(spark, sf), ["rid"], F.lit(0e0), F.lit(800e0))


@query(f"""WITH {c.RECTANGLES}, c AS (SELECT rid, x + i * w::DOUBLE AS x, y + j * h::DOUBLE AS y, 1000e0 + k * 9000e0 AS alt FROM rectangles, range(2) a(i), range(2) b(j), (SELECT unnest([-1, 1]) AS k)), g AS (SELECT rid, {c.ratio_sql(_CAM, 'lon', 'x', 'y', 'alt')} AS lon, {c.ratio_sql(_CAM, 'lat', 'x', 'y', 'alt')} AS lat FROM c)
SELECT rid, round(min(lon), 7) AS lon0, round(max(lon), 7) AS lon1, round(min(lat), 7) AS lat0, round(max(lat), 7) AS lat1 FROM g GROUP BY rid""")
def geodesic_box(spark, sf):
    out = altitude.geodesic_box(_regions(spark, sf), ["rid"])
    return out.select("rid", *[r(k, 7).alias(k) for k in ("lon0", "lon1", "lat0", "lat1")])


# --- matching ---

_DESC = "k AS (SELECT label AS tile, vec_id % 2 AS side, vec_id AS id, embedding AS e FROM embeddings), d AS (SELECT a.tile, a.id AS kp1, b.id AS kp2, round(list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))), 9) AS d FROM k a JOIN k b ON a.tile = b.tile AND a.side = 0 AND b.side = 1), n AS (SELECT *, row_number() OVER (PARTITION BY kp1 ORDER BY d, kp2) AS r, lead(d) OVER (PARTITION BY kp1 ORDER BY d, kp2) AS d2 FROM d)"


def _sides(spark, sf):
    k = c.keypoints(spark, sf)
    return k.where("side = 0"), k.where("side = 1")


@query(f"WITH {_DESC} SELECT tile, kp1, kp2, round(sqrt(d), 6) AS d1 FROM n WHERE r = 1 AND sqrt(d) < 0.93e0 * sqrt(d2)")
def knn_ratio_match(spark, sf):
    return matching.match(*_sides(spark, sf), ["tile"], 0.93).select("tile", "kp1", "kp2", r("d1").alias("d1"))


@query(f"WITH {_DESC} SELECT tile, kp1, kp2, round(sqrt(d), 6) AS d1 FROM n WHERE r = 1 AND sqrt(d) < 1.15e0")
def knn_absolute_match(spark, sf):
    return matching.match(*_sides(spark, sf), ["tile"], 1.15, relative=False).select("tile", "kp1", "kp2", r("d1").alias("d1"))


@query("SELECT label AS tile, vec_id AS kp_id FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) WHERE r <= 7")
def topk_keypoints(spark, sf):
    return matching.first_keypoints(c.keypoints(spark, sf), 7, ["tile"]).select("tile", "kp_id")


# --- heights ---

_WHOLE = f"{c.HEIGHTS}, whole AS (SELECT tile_id, pixel FROM heights WHERE z IS NOT NULL GROUP BY tile_id, pixel HAVING count(*) = 3), local AS (SELECT tile_id, pair, avg(z) AS mean FROM heights JOIN whole USING (tile_id, pixel) GROUP BY tile_id, pair), overall AS (SELECT pair, avg(mean) AS mean FROM local GROUP BY pair)"


@query(f"WITH {_WHOLE} SELECT tile_id, pair, round(mean, 9) AS mean FROM local")
def local_mean_heights(spark, sf):
    return fusion.local_means(c.heights(spark, sf), 3).select("tile_id", "pair", r("mean", 9).alias("mean"))


@query(f"WITH {_WHOLE} SELECT pair, round(mean, 9) AS mean FROM overall")
def global_mean_heights(spark, sf):
    return fusion.global_means(fusion.local_means(c.heights(spark, sf), 3)).select("pair", r("mean", 9).alias("mean"))


_FUSED = f"{_WHOLE}, s AS (SELECT h.pixel, z - mean AS s FROM heights h JOIN overall o USING (pair)), level AS (SELECT avg(mean) AS level FROM overall)"


@query(f"WITH {_FUSED} SELECT pixel, round(CASE WHEN max(s) - min(s) <= 30e0 THEN median(s) END + (SELECT level FROM level), 6) AS z FROM s GROUP BY pixel")
def fuse_average_if_close(spark, sf):
    h = c.heights(spark, sf)
    return fusion.fuse(h, fusion.global_means(fusion.local_means(h, 3)), 3, "average_if_close", 30.0, ["pixel"]).select("pixel", r("z").alias("z"))


@query(f"WITH {_FUSED} SELECT pixel, " + ", ".join(f"round({f} + (SELECT level FROM level), 6) AS {n}" for n, f in [(n, f"CASE WHEN count(s) = 3 THEN {g}(s) END") for n, g in (("min", "min"), ("max", "max"), ("mean", "avg"), ("median", "median"))] + [(f"nan{n}", f"{g}(s)") for n, g in (("min", "min"), ("max", "max"), ("mean", "avg"), ("median", "median"))]) + " FROM s GROUP BY pixel")
def fuse_reducers(spark, sf):
    h = c.heights(spark, sf)
    means = fusion.global_means(fusion.local_means(h, 3))
    shifted = h.join(F.broadcast(means), "pair").withColumn("s", F.col("z") - F.col("mean"))
    level = means.agg(F.avg("mean").alias("level"))
    out = shifted.groupBy("pixel").agg(*[f(F.col("s"), F.lit(3)).alias(n) for n, f in fusion.REDUCERS.items()])
    return out.crossJoin(F.broadcast(level)).select("pixel", *[r(F.col(n) + F.col("level")).alias(n) for n in fusion.REDUCERS])


@query(f"WITH {c.RASTER}, q AS (SELECT quantile_cont(v, 0.01) AS a, quantile_cont(v, 0.99) AS b FROM raster) SELECT id, CASE WHEN v IS NOT NULL THEN CAST(round_even(255e0 * ((least(greatest(v, a), b) - a) / (b - a)), 0) AS INT) END AS byte FROM raster, q")
def stretch_8bit(spark, sf):
    return fusion.stretch_8bit(c.raster(spark, sf)).select("id", "byte")


@query(f"WITH {c.RASTER}, q AS (SELECT quantile_cont(v, 0.1) AS q FROM raster) SELECT id, CASE WHEN v < q THEN 0 ELSE 255 END AS accepted FROM raster, q")
def low_quantile_reject(spark, sf):
    return fusion.reject_low(c.raster(spark, sf)).select("id", "accepted")


# --- filters on rasters and clouds ---


def _grid_points(spark, sf):
    return c.raster(spark, sf).select("id", "row", "col", F.when(F.col("v").isNotNull(), F.col("col").cast("double")).alias("x"), F.when(F.col("v").isNotNull(), F.col("row").cast("double")).alias("y"), (F.col("v") / 10e0).alias("z"))


_GRID = f"{c.RASTER}, p AS (SELECT id, row, col, col::DOUBLE AS x, row::DOUBLE AS y, v / 10e0 AS z FROM raster WHERE v IS NOT NULL)"
_CLOSE = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) < {}"


@query(f"WITH {_GRID} SELECT r.id, count(b.id) AS neighbors FROM raster r LEFT JOIN p a ON a.id = r.id LEFT JOIN p b ON b.row BETWEEN a.row - 2 AND a.row + 2 AND b.col BETWEEN a.col - 2 AND a.col + 2 AND {_CLOSE.format('6.25e0')} GROUP BY r.id")
def neighbor_count_3d(spark, sf):
    return cloud.count_neighbors(_grid_points(spark, sf), 2.5, 2).select("id", "neighbors")


@query(f"""WITH RECURSIVE {_GRID}, n AS (SELECT a.id, count(*) AS n FROM p a JOIN p b ON b.row BETWEEN a.row - 2 AND a.row + 2 AND b.col BETWEEN a.col - 2 AND a.col + 2 AND {_CLOSE.format('6.25e0')} GROUP BY a.id),
e AS MATERIALIZED (SELECT a.id AS x, b.id AS y FROM p a JOIN p b ON b.row BETWEEN a.row - 1 AND a.row + 1 AND b.col BETWEEN a.col - 1 AND a.col + 1 AND a.id <> b.id AND {_CLOSE.format('6.25e0')}),
ok AS (SELECT id FROM n WHERE n >= 9 UNION SELECT e.y FROM ok JOIN e ON e.x = ok.id) SELECT r.id, coalesce(n, 0) AS neighbors, r.id IN (SELECT id FROM ok) AS kept FROM raster r LEFT JOIN n ON n.id = r.id""")
def remove_isolated(spark, sf):
    return cloud.remove_isolated(_grid_points(spark, sf), 2.5, 2, 9).select("id", "neighbors", "kept")


@query(f"WITH {c.RASTER} SELECT a.id, min(b.v) AS lo, max(b.v) AS hi FROM raster a JOIN raster b ON b.row BETWEEN a.row - 2 AND a.row + 2 AND b.col BETWEEN a.col - 2 AND a.col + 2 GROUP BY a.id")
def morpho_minmax(spark, sf):
    p = c.raster(spark, sf).select("id", "row", "col", "v")
    lo, hi = (morphology.window_extremum(p, 2, how) for how in ("min", "max"))
    return lo.select("id", F.col("v").alias("lo")).join(hi.select("id", F.col("v").alias("hi")), "id")


def _window(agg, extra=""):
    reflect = lambda k, n: f"CASE WHEN a.{k} + {n} < 0 THEN -1 - (a.{k} + {n}) WHEN a.{k} + {n} > m{k} THEN 2 * m{k} + 1 - (a.{k} + {n}) ELSE a.{k} + {n} END"
    return f"WITH {c.RASTER}, o AS (SELECT i, j FROM (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j)), s AS (SELECT max(row) AS mrow, max(col) AS mcol FROM raster), t AS (SELECT a.row, a.col, a.v AS c, {reflect('row', 'i')} AS r2, {reflect('col', 'j')} AS c2 FROM raster a, o, s) SELECT t.row, t.col, {agg} AS v FROM t JOIN raster b ON b.row = r2 AND b.col = c2 GROUP BY t.row, t.col{extra}"


def _height(p):
    return p.agg(F.max("row")).first()[0] + 1


@query(_window("median(b.v)"))
def morpho_median(spark, sf):
    p = c.raster(spark, sf)
    return morphology.window_statistic(p, 1, "median", _height(p), 100)


@query(_window("CASE WHEN any_value(c) IS NOT NULL THEN count(*) FILTER (b.v < c)::DOUBLE END"))
def morpho_rank(spark, sf):
    p = c.raster(spark, sf)
    return morphology.window_statistic(p, 1, "rank", _height(p), 100)


@query(_window("round(avg(b.v), 9)"))
def morpho_average(spark, sf):
    p = c.raster(spark, sf)
    return morphology.window_statistic(p, 1, "average", _height(p), 100).withColumn("v", r("v", 9))


@query(_window("max(b.v)").replace("(SELECT unnest([-1, 0, 1]) AS j))", "(SELECT unnest([-1, 0, 1]) AS j) WHERE i = 0 OR j = 0)"))
def morpho_max_cross(spark, sf):
    p = c.raster(spark, sf)
    return morphology.window_statistic(p, 1, "max", _height(p), 100, element="cross")


@query(f"WITH {c.RASTER}, w AS (SELECT a.id, any_value(a.v) AS v, max(b.v) - min(b.v) AS d FROM raster a JOIN raster b ON b.row BETWEEN a.row - 1 AND a.row + 1 AND b.col BETWEEN a.col - 1 AND a.col + 1 GROUP BY a.id) SELECT id, CASE WHEN d <= 150 THEN v END AS v FROM w")
def local_range_outliers(spark, sf):
    return morphology.local_range_outliers(c.raster(spark, sf), 1, 150.0).select("id", "v")


@query(f"""WITH RECURSIVE {c.RASTER}, e AS MATERIALIZED (SELECT a.id AS x, a.id + o AS y FROM raster a, (SELECT unnest([-100, -1, 1, 100]) AS o) JOIN raster b ON b.id = a.id + o WHERE abs(a.row - b.row) + abs(a.col - b.col) = 1 AND abs(a.v - b.v) <= 20e0),
cc(id, root) USING KEY (id) AS (SELECT id, id AS root FROM raster WHERE v IS NOT NULL UNION SELECT e.y, min(own.root) FROM cc own JOIN e ON e.x = own.id JOIN recurring.cc old ON old.id = e.y WHERE own.root < old.root GROUP BY e.y),
n AS (SELECT root, count(*) AS n FROM cc GROUP BY root) SELECT r.id, CASE WHEN n >= 8 THEN v END AS v FROM raster r LEFT JOIN cc ON cc.id = r.id LEFT JOIN n USING (root)""")
def small_components(spark, sf):
    return morphology.small_components(c.raster(spark, sf), 8, 20.0).select("id", "v")


@query(f"WITH {c.RASTER} SELECT a.id, a.v IS NOT NULL AND b.v IS NOT NULL AS ok FROM raster a LEFT JOIN raster b ON b.row = a.row AND b.col = a.col + CAST(floor(a.v / 50e0) AS INT) - 2")
def rejection_mask(spark, sf):
    """Disparity, reference and the second image at column + disparity are all there (whole disparities)."""
    p = c.raster(spark, sf).withColumn("at", (F.col("col") + F.floor(F.col("v") / 50e0) - 2).cast("int"))
    there = p.where("v IS NOT NULL").select("row", F.col("col").alias("at"), F.lit(True).alias("hit"))
    return p.join(there, ["row", "at"], "left").select("id", (F.col("v").isNotNull() & F.coalesce("hit", F.lit(False))).alias("ok"))


@query(f"WITH {c.RASTER} SELECT id, greatest(((255e0 - least(greatest(v, 0), 255)) / 255e0) * ((255e0 - least(greatest(v, 0), 255)) / 255e0), 0.1e0) AS w FROM raster")
def edge_weights(spark, sf):
    return c.raster(spark, sf).select("id", fusion.edge_weight(F.least(F.greatest(F.col("v"), F.lit(0.0)), F.lit(255.0))).alias("w"))


# --- triangulation ---

_OTHER = c.camera(-0.25)


def _seen_twice(spark, sf):
    """Ground points with their images by two cameras."""
    g = c.ground(spark, sf)
    (x1, y1), (x2, y2) = (R.project(c.rpc(cam), F.col("lon"), F.col("lat"), F.col("alt")) for cam in (_CAM, _OTHER))
    return g.select("pid", "alt", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


@query(f"WITH {c.GROUND} SELECT pid, round(lon, 6) AS lon, round(lat, 6) AS lat, round(alt, 2) AS alt, round(0e0, 3) AS err FROM ground")
def triangulated_heights(spark, sf):
    """Points seen by two cameras, triangulated: they come back where they are, with no error left."""
    a, b = (triangulate.Camera.of(cam) for cam in (_CAM, _OTHER))
    out = triangulate.triangulate(_seen_twice(spark, sf), a, b, ["pid"])
    return out.select("pid", r("lon").alias("lon"), r("lat").alias("lat"), r("alt", 2).alias("alt"), F.abs(r("err", 3)).alias("err"))


@query(f"WITH {c.GROUND} SELECT pid, round(lon, 6) AS lon, round(lat, 6) AS lat FROM ground")
def iterated_localization(spark, sf):
    """Image points localized at their heights by a camera without direct coefficients: back where they were."""
    curved = triangulate.Camera.of({k: v for k, v in _CURVED.items() if k not in triangulate.DIRECT})
    col, row = R.project(c.rpc(_CURVED), F.col("lon"), F.col("lat"), F.col("alt"))
    seen = c.ground(spark, sf).select("pid", col.alias("u"), row.alias("v"), "alt")
    out = triangulate.localize(seen, curved, ["pid"], "u", "v", "alt")
    return out.select("pid", r("lon").alias("lon"), r("lat").alias("lat"))


@query(f"""WITH {c.RECTANGLES}, h AS (SELECT rid, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, i, 800e0 * (i / 20e0) * (i / 20e0) AS alt FROM rectangles, range(21) a(i)), g AS (SELECT rid, i, alt, {c.ratio_sql(_CAM, 'lon', 'x', 'y', 'alt')} AS lon, {c.ratio_sql(_CAM, 'lat', 'x', 'y', 'alt')} AS lat FROM h)
SELECT rid, CAST(i AS INT) AS i, round({c.ratio_sql(_CURVED, 'col', 'lon', 'lat', 'alt')}, 4) AS u, round({c.ratio_sql(_CURVED, 'row', 'lon', 'lat', 'alt')}, 4) AS v FROM g""")
def epipolar_curves(spark, sf):
    """Where the ray of a point is in another image, at 21 heights."""
    at = c.rectangles(spark, sf).select("rid", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.posexplode(R.altitudes_of_curve(F.lit(0e0), F.lit(800e0))).alias("i", "alt"))
    u, v = R.transfer(c.rpc(_CAM), c.rpc(_CURVED), F.col("x"), F.col("y"), F.col("alt"))
    return at.select("rid", "i", r(u, 4).alias("u"), r(v, 4).alias("v"))


# --- drawing ---


@query(f"""WITH {c.MATCHES}, l AS (SELECT match_id, CAST(floor(x1) AS BIGINT) % 90 AS x1, CAST(floor(y1) AS BIGINT) % 90 AS y1, CAST(floor(x2) AS BIGINT) % 90 + 100 AS x2, CAST(floor(y2) AS BIGINT) % 90 AS y2 FROM matches),
n AS (SELECT *, greatest(abs(x2 - x1), abs(y2 - y1)) AS n FROM l), i AS (SELECT *, unnest(range(n + 1)) AS i FROM n)
SELECT match_id, count(*) AS n, CAST(sum(CAST(round_even(x1 + i * (x2 - x1)::DOUBLE / n, 0) AS BIGINT)) AS BIGINT) AS sx, CAST(sum(CAST(round_even(y1 + i * (y2 - y1)::DOUBLE / n, 0) AS BIGINT)) AS BIGINT) AS sy FROM i GROUP BY match_id""")
def match_lines(spark, sf):
    crop = lambda k: F.floor(F.col(k)).cast("long") % 90
    m = c.matches(spark, sf).select("match_id", *[crop(k).alias(k) for k in _XY])
    return drawing.plot_matches(m, ["match_id"], 100).groupBy("match_id").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))


_DIR = "format('tiles/row_{:07d}_height_{:d}/col_{:07d}_width_{:d}', y, h, x, w)"


@query(f"""WITH {_ROIS}, t AS (SELECT rid, CAST(x + ix * tw AS INT) AS x, CAST(y + iy * th AS INT) AS y, CAST(least(tw, w - ix * tw) AS INT) AS w, CAST(least(th, h - iy * th) AS INT) AS h FROM tiles), d AS (SELECT *, {_DIR} AS dir FROM t)
SELECT rid AS roi_id, '<svg xmlns="http://www.w3.org/2000/svg" version="1.1" width="1000px" height="1000px" viewBox="' || min(x) || ' ' || min(y) || ' ' || (max(x + w) - min(x)) || ' ' || (max(y + h) - min(y)) || '">'
  || string_agg('<polygon style="fill:white;stroke:black;stroke-width:2" points="' || x || ' ' || y || ', ' || (x + w) || ' ' || y || ', ' || (x + w) || ' ' || (y + h) || ', ' || x || ' ' || (y + h) || '"/><image href="./' || dir || '/dsm.tif.png" x="' || x || '" y="' || y || '" width="' || w || '" height="' || h || '"/><a href="./' || dir || '/"><text x="' || (x + w // 2) || '" y="' || (y + h // 2) || '" text-anchor="middle">' || dir || '</text></a>', '' ORDER BY y, x) || '</svg>' AS svg
FROM d GROUP BY rid""")
def tile_map_svg(spark, sf):
    tiles = tiling.tile_grid(_rois(spark, sf), 200)
    return drawing.svg_map(tiles.withColumn("dir", tiling.tile_dir(*[F.col(k) for k in "xywh"])), ["roi_id"])


@query(f"""WITH {c.GROUND}, q AS (SELECT pid, CASE WHEN pid % 3 = 0 THEN 'no dsm' ELSE 'ok' END AS status, printf('%.7f,%.7f,0', round(lon, 5), round(lat, 5)) AS a, printf('%.7f,%.7f,0', round(lon, 5) + 0.25e0, round(lat, 5)) AS b, printf('%.7f,%.7f,0', round(lon, 5) + 0.25e0, round(lat, 5) + 0.5e0) AS c FROM ground)
SELECT pid, '<Placemark><name>tile ' || pid || '</name><description>' || status || '</description><styleUrl>' || CASE WHEN status = 'ok' THEN '#ok' ELSE '#error' END || '</styleUrl><Polygon><outerBoundaryIs><LinearRing><coordinates>' || a || ' ' || b || ' ' || c || ' ' || a || '</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>' AS kml FROM q""")
def tile_map_kml(spark, sf):
    lon, lat = r("lon", 5), r("lat", 5)
    ring = F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in ((lon, lat), (lon + 0.25, lat), (lon + 0.25, lat + 0.5))])
    status = F.when(F.col("pid") % 3 == 0, "no dsm").otherwise("ok")
    return c.ground(spark, sf).select("pid", drawing.kml_placemark(F.concat(F.lit("tile "), F.col("pid").cast("string")), status, ring).alias("kml"))


# --- text sources, status ---


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'row_offset' WHEN 1 THEN 'col_num' WHEN 2 THEN 'row_den' ELSE NULL END AS name, CASE event_id % 4 WHEN 0 THEN -1 WHEN 1 THEN least(event_id % 25, 19) WHEN 2 THEN least(greatest(event_id % 22 - 1, 0), 19) ELSE NULL END AS slot, value * 100 AS number FROM events".replace("least(event_id % 25, 19)", "CAST(least(event_id % 25, 19) AS INT)").replace("least(greatest(event_id % 22 - 1, 0), 19)", "CAST(least(greatest(event_id % 22 - 1, 0), 19) AS INT)").replace("value * 100", "round(value, 2)"))
def parse_rpc_tags(spark, sf):
    """Lines such as `SAMP_NUM_COEFF_3: 12.5` parsed into array, place and number."""
    k = F.col("event_id")
    tag = F.when(k % 4 == 0, "LINE_OFF").when(k % 4 == 1, F.concat(F.lit("SAMP_NUM_COEFF_"), (k % 25 + 1).cast("string"))).when(k % 4 == 2, F.concat(F.lit("LINE_DEN_COEFF_"), (k % 22).cast("string"))).otherwise("COMMENT")
    lines = c.table(spark, sf, "events").select("event_id", F.concat(tag, F.lit(": "), F.col("value").cast("string"), F.lit(" pixels")).alias("value"))
    out = rpcfile.tag_lines(lines, "value", ["event_id"]).withColumn("s", rpcfile.tag_slot(F.col("tag")))
    return out.select("event_id", "s.name", "s.slot", r("number", 2).alias("number"))


@query(f"WITH {c.GROUND} SELECT pid, 3 AS n, round(lon, 6) AS lon, round(lat, 6) AS lat FROM ground")
def parse_geojson(spark, sf):
    ring = F.format_string("[[[%.9f, %.9f], [1.5, 2.5], [3, 4]], [[9, 9]]]", F.col("lon"), F.col("lat"))
    geometry = F.concat(F.lit('{"type": "Polygon", "coordinates": '), ring, F.lit("}"))
    feature = F.concat(F.lit('{"type": "Feature", "properties": {}, "geometry": '), geometry, F.lit("}"))
    text = F.when(F.col("pid") % 3 == 0, geometry).when(F.col("pid") % 3 == 1, feature).otherwise(F.concat(F.lit('{"type": "FeatureCollection", "features": ['), feature, F.lit("]}")))
    got = c.ground(spark, sf).select("pid", geojson.ring(text).alias("ring"))
    return got.select("pid", F.size("ring").alias("n"), r(F.col("ring")[0]["lon"]).alias("lon"), r(F.col("ring")[0]["lat"]).alias("lat"))


@query(f"WITH {c.TILED} SELECT ty, tx, count(v) FILTER (v > 250) AS n, CASE WHEN count(v) FILTER (v > 250) > 0 THEN 'ok' ELSE 'no dsm' END AS status FROM tiled GROUP BY ty, tx")
def tile_status(spark, sf):
    t = c.tiled(spark, sf)
    products = t.where("v > 250").groupBy("ty", "tx").agg(F.count(F.lit(1)).alias("n"))
    return tiling.tile_status(t.select("ty", "tx").distinct(), products, ["ty", "tx"])

"""Edge cases of the DataFrame operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from altiplano import stage
from altiplano.functions import geo, planar
from altiplano.functions import rpc as R
from altiplano.operators import altitude, cloud, dsm, estimation, fusion, masks, matching, morphology, tiling
from altiplano.plans import carriers


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_tiles_of_seven_hundred(spark):
    rois = spark.createDataFrame([(0, 0, 0, 700, 700), (1, 5, 7, 100, 100)], "roi_id int, x int, y int, w int, h int")
    tiles = tiling.tile_grid(rois, 300)
    assert rows(tiles.where("roi_id = 0"), "x", "y", "w", "h") == [(0, 0, 350, 350), (0, 350, 350, 350), (350, 0, 350, 350), (350, 350, 350, 350)]
    assert rows(tiles.where("roi_id = 1"), "x", "y", "w", "h") == [(5, 7, 100, 100)]
    nine = tiling.tile_grid(spark.createDataFrame([(0, 0, 0, 900, 900)], "roi_id int, x int, y int, w int, h int"), 300)
    n = {(r.ix, r.iy): r.n for r in tiling.neighbors(nine).groupBy("ix", "iy").agg(F.count("*").alias("n")).collect()}
    assert n[(0, 0)] == 4 and n[(1, 0)] == 6 and n[(1, 1)] == 9
    some = nine.withColumn("useful", F.col("ix") != 1)
    assert tiling.keep_useful(tiling.neighbors(nine), some).where("ix = 1 OR nx = 1").count() == 0
    assert tiling.keep_useful(tiling.neighbors(nine), some).where("ix = 0 AND iy = 1").count() == 3


def test_touching_rectangles(spark):
    s = lambda *v: F.struct(*[F.lit(x).alias(k) for x, k in zip(v, "xywh", strict=True)])
    r = one(spark, tiling.rectangles_intersect(s(0, 0, 5, 5), s(5, 5, 1, 1)).alias("a"), tiling.rectangles_intersect(s(0, 0, 5, 5), s(6, 0, 1, 1)).alias("b"))
    assert r.a and not r.b


def test_planar(spark):
    d = lambda p, line: planar.point_line_distance(*[F.lit(float(v)) for v in (*p, *line)])
    r = one(spark, d((1, 1, 1), (0, 1, 0)).alias("a"), d((-1, -1, -1), (0, 1, 0)).alias("b"), d((1, 1, 1), (3, 2, -1)).alias("c"), d((1, 1, 0), (3, 2, -1)).alias("d"), d((1, 1, 1), (0, 0, 2.3)).alias("e"))
    assert (r.a, r.b) == (1, 1) and abs(r.c - 4 / math.sqrt(13)) < 1e-12 and r.d == r.e == planar.MAX
    h = planar.matrix(*carriers.H2)
    r = one(spark, planar.multiply(h, planar.invert(h)).alias("i"), planar.invert(planar.matrix(*[1] * 9)).alias("n"), planar.angle(F.lit(-1e0), F.lit(-0e0)).alias("t"))
    assert np.allclose(np.reshape(r.i, (3, 3)), np.eye(3)) and r.n is None and abs(r.t - math.pi) < 1e-12
    p1, p2 = np.hstack([np.eye(3), np.zeros((3, 1))]), np.hstack([np.eye(3), np.array([[1.0], [0.2], [0.1]])])
    f = np.array(planar.fundamental_of_cameras(p1.tolist(), p2.tolist()))
    x = np.array([0.3, -0.2, 2.0])
    assert abs((p2 @ [*x, 1]) @ f @ (p1 @ [*x, 1])) < 1e-9 and np.abs(f).max() > 0.1


@pytest.mark.parametrize("move", [np.array([[1, 0, 3], [0, 1, -2]]), np.array([[0.8, -0.6, 1], [0.6, 0.8, 2]]), np.array([[1.6, -1.2, 0], [1.2, 1.6, 5]]), np.array([[1.1, 0.3, 4], [-0.2, 0.7, 1]])])
def test_affine_recovery(spark, move):
    pts = [(float(x), float(y), *map(float, move @ [x, y, 1])) for x, y in ((0, 0), (1, 0), (0, 1), (1, 1))]
    df = spark.createDataFrame(pts, "x1 double, y1 double, x2 double, y2 double").withColumn("k", F.lit(1))
    got = estimation.affine_transformation(df, ["k"]).first()["a"]
    assert np.allclose(np.reshape(got, (3, 3))[:2], move, atol=1e-9)
    few = estimation.affine_transformation(df.limit(2), ["k"]).first()["a"]
    assert np.allclose(few, np.eye(3).ravel())


def test_fundamental_and_rectification(spark):
    r = np.random.default_rng(1)
    f = np.array([0.1, -0.7, 0.12, 0.69, -20.0])
    x1, y1, x2 = r.uniform(0, 500, 200), r.uniform(0, 500, 200), r.uniform(0, 500, 200)
    y2 = -(f[0] * x2 + f[2] * x1 + f[3] * y1 + f[4]) / f[1]
    df = spark.createDataFrame([tuple(map(float, v)) for v in zip(x1, y1, x2, y2, strict=True)], "x1 double, y1 double, x2 double, y2 double").withColumn("k", F.lit(1))
    got = estimation.affine_fundamental(df, ["k"])
    v = np.array(list(got.first()["f"]))
    assert np.allclose(v / np.linalg.norm(v[:4]), f / np.linalg.norm(f[:4]), atol=1e-8)
    h1, h2 = estimation.rectifying_homographies(F.col("f"), *[F.lit(float(q)) for q in (100, 100, 200, 200)])
    both = estimation.rectified(df.crossJoin(got.select("f")).withColumns({"h1": h1, "h2": h2}), F.col("h1"), F.col("h2"))
    assert both.agg(F.max(F.abs(F.col("v1") - F.col("v2")))).first()[0] < 1e-6
    assert estimation.affine_fundamental(df.limit(3), ["k"]).first()["f"] is None
    assert matching.epipolar_filter(df.crossJoin(got.select("f")), 0.5).count() == 200


def test_global_pointing_by_number_of_tiles(spark):
    a = planar.translation(2, -1)
    local = spark.createDataFrame([(0, 1.0, 1.0), (1, 1.0, 1.0), (1, 5.0, 2.0), (2, 0.0, 0.0), (2, 100.0, 0.0), (2, 0.0, 100.0), (2, 70.0, 80.0)], "pair int, cx double, cy double").withColumn("a", F.when(F.col("pair") >= 0, a))
    local = local.unionByName(spark.createDataFrame([(3, None, None)], "pair int, cx double, cy double").withColumn("a", F.lit(None).cast("array<double>")))
    got = {r.pair: r.a for r in estimation.global_pointing(local).collect()}
    for k in (0, 1, 2):
        assert np.allclose(got[k], [1, 0, 2, 0, 1, -1, 0, 0, 1], atol=1e-9)
    assert np.allclose(got[3], np.eye(3).ravel())
    tiles = spark.createDataFrame([(1, 0), (2, 0)], "tile_id int, pair int")
    own = spark.createDataFrame([(1, 0)], "tile_id int, pair int").withColumn("a", planar.translation(9, 9))
    back = {r.tile_id: r.a[2] for r in estimation.pointing_with_fallback(tiles, own, estimation.global_pointing(local), ["tile_id", "pair"]).collect()}
    assert back == {1: 9.0, 2: 2.0}


def test_disparity_ranges(spark):
    lit = lambda *v: tuple(F.lit(x).cast("double") for x in v)
    pick = lambda m, n=5, x=(None, None), **k: estimation.disparity_range(m, (*lit(-7, 9), F.lit(n)), lit(*x), **k)
    cases = {"a": pick("sift"), "b": pick("sift", 1), "c": pick("wider_sift_exogenous", 5, (-20, 4)), "d": pick("wider_sift_exogenous", 0, (-20, 1)), "e": pick("exogenous"), "f": pick("fixed_pixel_range", fixed=(-1, 8))}
    r = one(spark, *[F.array(*v).alias(k) for k, v in cases.items()])
    assert r.asDict() == {"a": [-7, 9], "b": [-3, 3], "c": [-20, 9], "d": [-20, 3], "e": [-3, 3], "f": [-3, 8]}
    with pytest.raises(ValueError):
        estimation.disparity_range("other", (*lit(0, 0), F.lit(1)), lit(0, 0))
    assert one(spark, F.array(*estimation.limited_range(*lit(-100, 100, 50))).alias("r")).r == [-25, 25]
    with pytest.raises(Exception, match="too large"):
        one(spark, estimation.limited_range(*lit(-100, 100, 500), 10)[0].alias("r"))


def test_cameras(spark):
    cam = carriers.rpc(carriers.camera(0.3))
    df = spark.range(50).select((56 + F.col("id") / 60.0).alias("lon"), (-20.5 + F.col("id") / 90.0).alias("lat"), (F.col("id") * 20e0).alias("alt"))
    col, row = R.project(cam, F.col("lon"), F.col("lat"), F.col("alt"))
    df = df.withColumns({"col": col, "row": row})
    lon, lat = R.localize(cam, F.col("col"), F.col("row"), F.col("alt"))
    assert df.select(F.max(F.abs(lon - F.col("lon")) + F.abs(lat - F.col("lat")))).first()[0] < 1e-9
    x = [F.lit(v) for v in (0.3, -0.2, 0.5)]
    coef = F.array(*[F.lit(0.1 * i - 0.7) for i in range(20)])
    h = 1e-6
    r = one(spark, F.array(*R.gradient(coef, *x)).alias("g"), *[F.array(R.polynomial(coef, *[v + (h if i == k else 0.0) for i, v in enumerate(x)]), R.polynomial(coef, *[v - (h if i == k else 0.0) for i, v in enumerate(x)])).alias(f"d{k}") for k in range(3)])
    assert np.allclose(r.g, [(r[f"d{k}"][0] - r[f"d{k}"][1]) / (2 * h) for k in range(3)], atol=1e-6)
    r = one(spark, F.array(*R.in_basis(*[F.lit(float(v)) for v in (2, 0, 1, 1, 5, 3)])).alias("b"), R.altitudes_of_curve(F.lit(0e0), F.lit(100e0)).alias("c"), R.zoomed(cam, 0.5)["col_offset"].alias("z"))
    assert r.b == [1, 3] and len(r.c) == 21 and r.c[10] == 25 and r.z == 2500


def test_geodesy(spark):
    r = one(spark, geo.utm_zone_name(F.lit(55.65), F.lit(-21.23)).alias("z"), geo.utm_zone(F.lit(180e0)).alias("q"), geo.epsg_of_zone(F.lit("40S")).alias("e"), F.array(*geo.lonlat_to_utm(F.lit(57e0), F.lit(0e0), F.lit(40), F.lit(True))).alias("u"), F.array(*geo.lonlat_to_geocentric(F.lit(0e0), F.lit(90e0), F.lit(0e0))).alias("p"), F.array(*geo.align(F.lit(3e0), F.lit(9e0), 4)).alias("a"))
    assert r.z == "40S" and r.q == 61 and r.e == 32740 and np.allclose(r.u, [500000, 0], atol=1e-6) and abs(r.p[2] - 6356752.314245) < 1e-5 and r.a == [0, 12]
    with pytest.raises(Exception, match="hemisphere"):
        one(spark, geo.epsg_of_zone(F.lit("40X")).alias("e"))
    for bad in ("epsg:2154", 32661, "utm"):
        with pytest.raises(ValueError):
            geo.crs(bad)
    x, y, z = geo.transform(*[F.lit(v) for v in (55.65, -21.23, 100.0)], 4979, "EPSG:32740")
    back = geo.transform(*geo.transform(x, y, z, 32740, 4978), 4978, 4326)
    assert np.allclose(one(spark, F.array(*back).alias("v")).v, [55.65, -21.23, 100], atol=1e-7)
    with pytest.raises(ValueError):
        geo.transform(x, y, z, 4979, "32740+5773")


def test_masks(spark):
    px = spark.range(400).select((F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col"))
    square = [(4.5, 4.5), (14.5, 4.5), (14.5, 14.5), (4.5, 14.5), (4.5, 4.5)]
    hole = [(7.5, 7.5), (9.5, 7.5), (9.5, 9.5), (7.5, 9.5)]
    ok = masks.validity(px, 20, 20, [square], [hole], margin=0)
    assert ok.where("ok").count() == 96
    assert masks.validity(px, 20, 20, margin=0).where("ok").count() == 400
    assert masks.validity(px, 20, 20, margin=3).where("ok").count() == 14 * 14
    assert masks.erode(ok, 1.5).where("ok").count() == 96
    assert masks.erode(masks.validity(px, 20, 20, [square], margin=0), 2).where("ok").count() == 36
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in square])
    inside = px.select(masks.in_polygon(F.col("col"), F.col("row"), square).alias("a"), masks.in_polygon_array(F.col("col").cast("double"), F.col("row").cast("double"), ring).alias("b"))
    assert inside.where("a <> b").count() == 0 and inside.where("a").count() == 100


def test_grid_is_the_same_tile_by_tile(spark):
    df = spark.range(2000).select((F.col("id") % 37 * 1.7).alias("x"), (F.col("id") % 53 * 1.3 - 20).alias("y"), F.sin("id").alias("z"), (F.col("id") % 3).alias("tile"))
    df = df.unionByName(spark.createDataFrame([(1.0, 1.0, None, 0), (float("nan"), 1.0, 1.0, 0), (1.0, float("inf"), 1.0, 0)], "x double, y double, z double, tile long"))
    whole = {(r.cx, r.cy): (r.n, round(r.z, 9)) for r in dsm.grid(df, 5.0).collect()}
    state = None
    for t in range(3):
        part = dsm.partial(df.where(F.col("tile") == t), 5.0)
        state = part if state is None else dsm.merge_partial(state, part)
    assert whole == {(r.cx, r.cy): (r.n, round(r.z / r.n, 9)) for r in state.collect()}
    assert sum(n for n, _ in whole.values()) == 2000
    assert dsm.bounds(df.where("z IS NULL"), 1.0).count() == 0
    same = {(r.cx, r.cy): (r.n, round(r.z, 9)) for r in dsm.grid_weighted(df, 5.0, 0).collect()}
    assert same == whole


def test_fusion_rejects_unknown(spark):
    h = spark.createDataFrame([(1, 0, 1.0), (1, 1, 9.0), (2, 0, 1.0), (2, 1, None)], "pixel int, pair int, z double")
    off = spark.createDataFrame([(0, 0.0), (1, 2.0)], "pair int, mean double")
    with pytest.raises(ValueError):
        fusion.fuse(h, off, 2, "mode")
    assert rows(fusion.fuse(h, off, 2, "mean", keys=["pixel"]).where("pixel = 1"), "z") == [(5.0,)]
    assert fusion.fuse(h, off, 2, "mean", keys=["pixel"]).where("pixel = 2").first().z is None
    assert fusion.fuse(h, off, 2, "average_if_close", 3.0, ["pixel"]).where("pixel = 1").first().z is None
    flat = spark.createDataFrame([(1, 2.0), (2, 2.0)], "id int, v double")
    assert {r.byte for r in fusion.stretch_8bit(flat).collect()} == {None}


def test_isolated_points_and_chains(spark):
    pts = [(0, i, j, float(j), float(i), 0.0) for i in range(5) for j in range(5)]
    pts += [(0, 2, j, float(j), 2.0, 0.0) for j in range(5, 30)]  # a chain that crosses block edges
    pts += [(0, 20, 20, 20.0, 20.0, 0.0), (0, 25, 3, 3.0, 25.0, 0.0), (0, 25, 4, 4.0, 25.0, 0.0)]
    df = spark.createDataFrame([(n, *p[1:]) for n, p in enumerate(pts)], "id long, row int, col int, x double, y double, z double")
    df = df.unionByName(spark.createDataFrame([(999, 9, 9, None, None, None)], df.schema))
    out = {r.id: r.kept for r in cloud.remove_isolated(df, 1.5, 2, 6, block=8).collect()}
    assert all(out[i] for i in range(50)) and not any(out[i] for i in (50, 51, 52, 999))
    gone = cloud.filter_cloud(df, 1.5, 6, 1.0)
    assert gone.where("x IS NULL").count() == 4 and cloud.filter_cloud(df, None, 6, 1.0) is df


def test_regions_across_blocks(spark):
    r = np.random.default_rng(2)
    im = r.integers(0, 3, (30, 40)).astype(float)
    im[r.random((30, 40)) < 0.2] = np.nan
    px = [(int(i * 40 + j), int(i), int(j), None if np.isnan(im[i, j]) else float(im[i, j])) for i in range(30) for j in range(40)]
    df = spark.createDataFrame(px, "id long, row int, col int, v double")
    label = np.full(im.shape, -1)
    for i in range(30):
        for j in range(40):
            if label[i, j] < 0 and np.isfinite(im[i, j]):
                todo, label[i, j] = [(i, j)], i * 40 + j
                while todo:
                    a, b = todo.pop()
                    for c, d in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                        if 0 <= c < 30 and 0 <= d < 40 and label[c, d] < 0 and abs(im[c, d] - im[a, b]) <= 0:
                            label[c, d] = label[i, j]
                            todo.append((c, d))
    n = np.bincount(label[label >= 0], minlength=1200)
    want = {int(i * 40 + j): (float(im[i, j]) if label[i, j] >= 0 and n[label[i, j]] >= 5 else None) for i in range(30) for j in range(40)}
    assert {x.id: x.v for x in morphology.small_components(df, 5, 0.0, block=7).collect()} == want
    out = morphology.clean(df, 1.5, 3, 1, block=16)
    assert out.count() == 1200


def test_altitude_operators(spark):
    cam = carriers.rpc(carriers.camera(0.3))
    reg = spark.createDataFrame([(1, 4000, 3000, 500, 400)], "rid int, x int, y int, w int, h int").withColumns({"rpc": cam, "rpc_a": cam, "rpc_b": cam, "h1": planar.translation(0, 0), "h2": planar.translation(5, 0), "pointing": planar.translation(2, 0)})
    d = altitude.altitude_to_disparity_range(reg, ["rid"], F.lit(0e0), F.lit(100e0)).first()
    assert abs(d.disp_min - 3) < 1e-6 and abs(d.disp_max - 3) < 1e-6
    same = altitude.corresponding_region(reg, ["rid"], F.lit(0e0), F.lit(100e0)).first()
    assert (same.x, same.y, same.w, same.h) == (4000, 3000, 500, 400)
    poly = altitude.ground_control_points(reg, ["rid"], 2, F.lit(50e0), F.lit(50e0)).withColumn("rpc", cam)
    box = altitude.polygon_box(poly, ["rid"], F.lit(50e0)).first()
    assert abs(box.x - 4125) <= 1 and abs(box.w - 250) <= 1
    dem = spark.createDataFrame([(i, j, float(i + j)) for i in range(5) for j in range(5)], "i int, j int, z double")
    pts = spark.createDataFrame([(1, 1.5, 2.5, 10.0), (2, 9.0, 9.0, 1.0)], "p int, lon double, lat double, z double")
    assert rows(altitude.sample_dem(pts, dem, 1.0), "p", "dem_z")[0] == (1, 3.0)
    up = {r.p: r.z for r in altitude.geoid_to_ellipsoid(pts, dem.withColumnRenamed("z", "n"), 1.0).collect()}
    assert up == {1: 14.0, 2: None}


def test_join_hot_and_components(spark):
    left = spark.range(5000).select((F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 50)).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("n")).where("k % 2 = 0")
    got = stage.join_hot(left, right, ["k"], "n", 5000, 20)
    assert got.count() == left.where("k % 2 = 0").count()
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5)], "a long, b long")
    assert rows(stage.components(edges), "node", "root") == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)]
    assert stage.components(edges.limit(0)).count() == 0
    desc = spark.createDataFrame([([1.0, 2.0], 1.5, 2.5, 1.0, 0.5)], "d array<double>, x double, y double, s double, o double")
    assert desc.select(matching.describe(*[F.col(c) for c in ("d", "x", "y", "s", "o")]).alias("t")).first().t.endswith("0.500000 1 2")


def test_neighbors_are_not_gathered_at_the_driver(spark, tmp_path):
    """A file of few regions holds many tiles; the file's size must not make them a broadcast."""
    spark.range(3).select("id", F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(600).alias("w"), F.lit(400).alias("h")).withColumnRenamed("id", "roi_id").write.parquet(str(tmp_path / "rois"))
    pairs = tiling.neighbors(tiling.tile_grid(spark.read.parquet(str(tmp_path / "rois")), 200))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert pairs.groupBy("ix", "iy").count().collect() and pairs.count() == 3 * 28


def test_components_of_few_edges_in_one_round(spark, monkeypatch):
    """A chain found by many tasks: one more task settles it; larger graphs contract, with the same result."""
    edges = spark.range(2000).select("id", (F.col("id") + 1).alias("b")).withColumnRenamed("id", "a").repartition(40)
    write, n = stage.staged, []
    monkeypatch.setattr(stage, "staged", lambda df, tag: n.append(tag) or write(df, tag))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        one = rows(stage.components(edges), "node", "root")
        assert one == [(i, 0) for i in range(2001)] and len(n) == 2
        monkeypatch.setattr(stage, "FEW_EDGES", 0)
        assert rows(stage.components(edges), "node", "root") == one and len(n) > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    few = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5)], "a long, b long")
    assert rows(stage.components(few), "node", "root") == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)]
    assert stage.components(few.limit(0)).count() == 0


def test_order_statistics_by_key(spark, monkeypatch):
    from altiplano.operators import quantiles

    r = np.random.default_rng(4)
    rows = [(int(k), float(v)) for k, n in ((1, 1), (2, 2), (3, 7), (4, 3000)) for v in np.round(r.normal(size=n), 2 if k == 4 else 6) for _ in range(1) for k in [k]] + [(5, None)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(4)
    for small in (50_000, 10):
        monkeypatch.setattr(quantiles, "SMALL", small)
        got = {x.k: x.q for x in quantiles.upper_median(df, "v", ["k"]).collect()}
        own = lambda k: sorted(v for q, v in rows if q == k and v is not None)
        if small > 10:
            assert got == {k: own(k)[len(own(k)) // 2] for k in (1, 2, 3, 4)}
        assert got[4] == own(4)[1500]
        for share in (0.0, 0.01, 0.25, 0.99, 1.0):
            got = {x.k: x.q for x in quantiles.quantile(df, "v", ["k"], share).collect()}
            assert abs(got[4] - np.quantile(own(4), share)) < 1e-9
    one = quantiles.quantile(df.where("k = 3"), "v", [], 0.5).first()
    assert abs(one.q - np.quantile(own(3), 0.5)) < 1e-12


def test_matches_over_parts_equal_plain_search(spark, monkeypatch):
    from altiplano.operators import matching

    r = np.random.default_rng(6)
    a, b = (np.round(r.normal(size=(n, 8)), 1) for n in (60, 75))
    b[:20] = a[:20]
    frame = lambda x, first: spark.createDataFrame([(i % 2, first + i, v.tolist()) for i, v in enumerate(x)], "tile int, kp_id long, desc array<float>")
    want = []
    for i, u in enumerate(a):
        d = sorted((round(float(((np.float32(u).astype(float) - np.float32(v).astype(float)) ** 2).sum()), 9), 1000 + j) for j, v in enumerate(b) if j % 2 == i % 2)
        if np.sqrt(d[0][0]) < 0.8 * np.sqrt(d[1][0]):
            want.append((i % 2, i, d[0][1], round(float(np.sqrt(d[0][0])), 9)))
    for part in (4000, 7):
        monkeypatch.setattr(matching, "PART", part)
        got = matching.match(frame(a, 0), frame(b, 1000), ["tile"], 0.8).collect()
        assert sorted((x.tile, x.kp1, x.kp2, round(x.d1, 9)) for x in got) == sorted(want)


def test_random_window_value_is_one_of_the_window(spark):
    rows = [(i, j, float(10 * i + j) if (i, j) != (2, 2) else None) for i in range(6) for j in range(6)]
    df = spark.createDataFrame(rows, "row int, col int, v double")
    v = {(i, j): x for i, j, x in rows}
    one, two = ({(x.row, x.col): x.v for x in morphology.window_statistic(df, 1, "random", 6, 6, seed=3).collect()} for _ in range(2))
    assert one == two and len(one) == 36
    at = lambda i: min(max(i, -1 - i), 11 - i)
    for (i, j), x in one.items():
        assert x in {v[at(i + a), at(j + b)] for a in (-1, 0, 1) for b in (-1, 0, 1)} - {None}

"""Kernels against analytic scenes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from altiplano.kernels import images, tiles
from altiplano.kernels.triangulate import DIRECT, Camera, fit_camera, height_map_points, heights, triangulate
from altiplano.plans import carriers


def texture(h, w, seed=0):
    r = np.random.default_rng(seed)
    return images.blur(r.normal(size=(h, w)), 1.2) * 100


def test_localization_by_iteration():
    full = Camera.of(carriers.curved_camera(0.2))
    cam = Camera(full.values | {k: None for k in DIRECT})
    lon, lat, alt = np.linspace(55.5, 58, 40), np.linspace(-20.9, -19.2, 40), np.linspace(0, 3000, 40)
    back = cam.localize(*cam.project(lon, lat, alt), alt)
    assert np.abs(back[0] - lon).max() < 1e-9 and np.abs(back[1] - lat).max() < 1e-9
    assert np.isnan(cam.localize(np.array([1e9]), np.array([1e9]), np.array([0.0]), most=2)[0]).all()


def test_height_of_matches(spark):
    a, b = Camera.of(carriers.camera(0.3)), Camera.of(carriers.camera(-0.25))
    lon, lat, alt = np.linspace(55.5, 58, 60), np.linspace(-20.9, -19.2, 60), np.linspace(-50, 3000, 60)
    m = [*a.project(lon, lat, alt), *b.project(lon, lat, alt)]
    h, err = heights(a, b, *m)
    assert np.abs(h - alt).max() < 1e-4 and err.max() < 1e-6
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(zip(*m, strict=True))], "id int, x1 double, y1 double, x2 double, y2 double")
    got = triangulate(df, a, b, ["id"]).orderBy("id").toPandas()
    assert np.abs(got["alt"] - alt).max() < 1e-4 and np.abs(got["lon"] - lon).max() < 1e-8
    z = spark.createDataFrame([(1, 2, 3, 100.0), (1, 2, 4, None)], "t int, row int, col int, z double")
    p = height_map_points(z, a, 10, 20, ["t"]).collect()
    assert len(p) == 1 and abs(p[0]["lon"] - a.localize(13, 22, 100.0)[0]) < 1e-12


def test_fit_camera():
    cam = Camera.of(fit_camera(lambda lon, lat, alt: (1000 * (lon - 5) + 0.3 * alt, -900 * (lat - 45) + 0.1 * alt), (5, 6), (45, 46), (0, 500)))
    col, row = cam.project(np.array([5.3]), np.array([45.7]), np.array([120.0]))
    assert abs(col[0] - 336) < 1e-6 and abs(row[0] + 618) < 1e-6


@pytest.mark.parametrize("algorithm", sorted(images.MATCHERS))
def test_dense_matching_of_a_step(algorithm):
    ref = texture(60, 90)
    truth = np.full((60, 90), 4.0)
    truth[:, 45:] = 7.0
    x, y = np.meshgrid(np.arange(90.0), np.arange(60.0))
    sec = np.full((60, 90), np.nan)
    for d in (4, 7):
        sel = truth == d
        sec[y[sel].astype(int), np.clip(x[sel] + d, 0, 89).astype(int)] = ref[sel]
    disparity, mask, confidence = images.match_dense(ref, sec, 0, 12, algorithm)
    inside = mask & (np.abs(x - 45) > 8) & (x < 78) & (x > 4)
    assert inside.sum() > 2000 and np.median(np.abs(disparity - truth)[inside]) < 0.25
    assert confidence.shape == ref.shape


def test_dense_matching_limits():
    from altiplano.operators.estimation import DisparityRangeTooLarge

    im = texture(20, 30)
    with pytest.raises(DisparityRangeTooLarge):
        images.match_dense(im, im, -100, 100, "mgm", 10)
    with pytest.raises(ValueError):
        images.match_dense(im, im, 0, 1, "nothing")
    assert images.limited(-100, 100, 50) == (-25, 25)


def test_warp_and_back():
    im = texture(40, 50)
    assert np.allclose(images.warp(im, np.eye(3), 50, 40), im)
    shift = images.warp(im, [1, 0, 3, 0, 1, -2, 0, 0, 1], 50, 40)
    assert np.allclose(shift[:38, 3:], im[2:, :47]) and np.isnan(shift[:, :3]).all()
    holed = im.copy()
    holed[10, 10] = np.nan
    grid = images.height_to_grid(holed, np.eye(3), 50, 40)
    assert np.isnan(grid[9:12, 9:12]).all() and np.isfinite(grid).sum() == 2000 - 9


def test_speckles_and_erosion():
    im = np.full((20, 20), np.nan)
    im[2:12, 2:12], im[15, 15] = 1.0, 5.0
    out = images.drop_speckles(im, 5)
    assert np.isfinite(out).sum() == 100
    mask = np.ones((9, 9), bool)
    mask[4, 4] = False
    assert images.erode(mask, 2).sum() == 81 - 13 and images.erode(mask, 1).sum() == 80


def test_keypoints_match_under_a_shift(spark):
    im = texture(220, 220, 3)
    a, b = images.keypoints(im[:200, :200]), images.keypoints(im[7:207, 5:205], origin=(100.0, 0.0))
    assert len(a) > 20 and a.shape[1] == 132 and len(images.keypoints(im, most=5)) == 5
    rows = lambda k, side: [(1, i, [float(v) for v in r[4:]], float(r[0]), float(r[1]), side) for i, r in enumerate(k)]
    df = spark.createDataFrame(rows(a, 0) + rows(b, 1), "tile int, kp_id long, desc array<float>, x double, y double, side int")
    from altiplano.operators import matching

    found = matching.match(df.where("side = 0"), df.where("side = 1"), ["tile"], 0.6).collect()
    good = sum(abs(a[m.kp1][0] - 5 - (b[m.kp2][0] - 100)) < 1 and abs(a[m.kp1][1] - 7 - b[m.kp2][1]) < 1 for m in found)
    assert len(found) > 8 and good > 0.8 * len(found)


def test_ransac(spark):
    r = np.random.default_rng(4)
    m = r.uniform(0, 300, (120, 4))
    f = np.array([0.1, -0.7, 0.12, 0.69, -20.0])
    m[:, 3] = -(f[0] * m[:, 2] + f[2] * m[:, 0] + f[3] * m[:, 1] + f[4]) / f[1]
    m[:30, 3] += r.uniform(20, 80, 30)
    keep = images.ransac_fundamental(m, 1)
    assert keep[30:].mean() > 0.95 and keep[:30].mean() < 0.1
    df = spark.createDataFrame([(1, *map(float, v)) for v in m], "tile int, x1 double, y1 double, x2 double, y2 double")
    one, two = (sorted(map(tuple, tiles.ransac(df, ["tile"]).collect())) for _ in range(2))
    assert one == two and len(one) >= 85
    assert tiles.ransac(df.limit(5), ["tile"]).count() == 5


def test_tile_tables(spark):
    im = texture(30, 20)
    im[3, 4] = np.nan
    df = spark.createDataFrame([(7, *tiles.pack(im), [1.0, 0.0, 2.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0], 0.0, 0.0)], "tile int, h int, w int, data binary, m array<double>, x0 double, y0 double")
    px = tiles.to_pixels(df, ["tile"])
    assert px.count() == 599
    back = tiles.to_tiles(px, ["tile"], 30, 20).first()
    assert np.array_equal(tiles.unpack(back["h"], back["w"], back["data"]), im, equal_nan=True)
    warped = tiles.warp(df, ["tile"], 20, 30).first()
    assert np.allclose(tiles.unpack(30, 20, warped["data"])[5, 5], im[5, 3])
    assert tiles.detect(df, ["tile"]).columns[0] == "tile"
    ref = texture(40, 60)
    pair = spark.createDataFrame([(1, *tiles.pack(ref), tiles.pack(np.roll(ref, 3, 1))[2], -5.0, 5.0), (2, *tiles.pack(ref), tiles.pack(ref)[2], -500.0, 500.0)], "tile int, h int, w int, ref binary, sec binary, disp_min double, disp_max double")
    out = tiles.dense_match(pair, ["tile"], limit=20)
    assert abs(out.where("tile = 1").agg(F.median("d")).first()[0] - 3) < 0.2
    assert out.where("tile = 2").first()["status"] != "ok"
    with pytest.raises(ValueError):
        tiles.dense_match(pair, ["tile"], "nothing")
    assert tiles.match_with_retry(lambda t: df.limit(0)) is None

"""The whole pipeline on synthetic scenes, and the streaming grid."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from altiplano import config
from altiplano.functions import geo
from altiplano.kernels import images
from altiplano.kernels.triangulate import Camera, fit_camera
from altiplano.operators import dsm
from altiplano.plans.pipeline import Run, Scene
from altiplano.streaming.grid import GrowingGrid

LON, LAT, STEP = 55.6, -21.2, 1e-5


def camera(tilt):
    return Camera.of(fit_camera(lambda lon, lat, alt: ((lon - LON) / STEP + tilt * alt, (LAT - lat) / STEP), (LON, LON + 200 * STEP), (LAT - 200 * STEP, LAT), (-30, 60)))


def scene(tilts, height):
    """Orthographic views of a textured plane with a raised square; the second image is the first, shifted by height."""
    r = np.random.default_rng(1)
    ground = images.blur(r.normal(size=(200, 200)), 1.2) * 100
    z = np.zeros((200, 200))
    z[70:130, 70:130] = height
    ims = []
    x, y = np.meshgrid(np.arange(200.0), np.arange(200.0))
    for t in tilts:
        im = images.warp(ground, np.eye(3), 200, 200)
        out = np.full((200, 200), np.nan)
        for level in (0.0, height):  # the raised part last, as it hides the ground
            sample = images.sample(im, x - t * level, y)
            where = images.sample(z, x - t * level, y, 0) == level
            out = np.where(where, sample, out)
        ims.append(np.where(np.isfinite(out), out, 0.0))
    return Scene(ims, [camera(t) for t in tilts], config.Roi(20, 20, 160, 160))


def cfg(tmp_path, n, **more):
    return config.build({"images": [{"img": f"{i}.tif"} for i in range(n)], "roi": {"x": 20, "y": 20, "w": 160, "h": 160}, "out_dir": str(tmp_path), "tile_size": 80, "horizontal_margin": 20, "vertical_margin": 5, "alt_min": -10, "alt_max": 30, "dsm_resolution": 5, **more})


def check(df, height):
    x, y = geo.transform(F.lit(LON + 100 * STEP), F.lit(LAT - 100 * STEP), F.lit(0e0), 4979, 32740)[:2]
    centre = df.sparkSession.range(1).select(x.alias("x"), y.alias("y")).first()
    near = df.withColumn("d", F.greatest(F.abs(F.col("cx") * 5 - centre.x), F.abs(-F.col("cy") * 5 - centre.y)))
    top = near.where("d < 20").agg(F.median("z")).first()[0]
    flat = near.where("d > 45").agg(F.median("z")).first()[0]
    assert abs(top - height) < 0.8 and abs(flat) < 0.8


def test_two_views_and_restart(spark, tmp_path):
    run = Run(spark, cfg(tmp_path, 2, **{"3d_filtering_r": 5, "3d_filtering_n": 10}), scene((0.0, 0.5), 12.0), 32740)
    out = run.run()
    check(out, 12.0)
    before = sorted(map(tuple, out.collect()))
    assert sorted(map(tuple, run.run(start_from=6).collect())) == before
    assert run.table("disparity").where("status = 'ok'").count() > 15000
    whole = {(r.cx, r.cy): r.n for r in dsm.grid(run.table("cloud"), 5.0).collect()}
    assert whole == {(a, b): n for a, b, n, _ in before}
    from altiplano.sources import ply
    from altiplano.sources.images import Tiff

    files = list((tmp_path / "ply").glob("*.ply"))
    assert files and f"projection: CRS {run.crs}" in ply.comments(str(files[0]))
    assert spark.read.format("ply").load(str(tmp_path / "ply")).count() == run.table("cloud").where("z IS NOT NULL").count()
    cells = sum(int(np.isfinite(Tiff(f.read_bytes()).read()[0]).sum()) for f in (tmp_path / "dsm_tif").glob("*.tif"))
    assert cells == len(before) and abs(run.sampling_distance() - 1.04) < 0.05


def test_three_views(spark, tmp_path):
    check(Run(spark, cfg(tmp_path, 3, tile_size=160), scene((0.0, 0.5, -0.5), 12.0), 32740).run(), 12.0)


def test_pointing_error_is_found_and_undone(spark, tmp_path):
    s = scene((0.0, 0.5), 12.0)
    s.images[1] = np.roll(s.images[1], 2, axis=0)  # the second camera looks two rows off
    run = Run(spark, cfg(tmp_path, 2, tile_size=160), s, 32740)
    out = run.run()
    assert run.table("matches").count() > 40
    a = np.reshape(run.corrections()[1], (3, 3))
    assert np.abs(a @ [100, 102, 1] - [100, 100, 1]).max() < 0.5
    check(out, 12.0)


def test_failed_tiles_are_rows_unless_strict(spark, tmp_path):
    from altiplano.plans.pipeline import StageFailed

    run = Run(spark, cfg(tmp_path, 2, max_disp_range=1, tile_size=160), scene((0.0, 0.5), 12.0), 32740)
    for step in (run.plan, run.matches, run.pointing, run.rectification):
        step()
    assert {r.status != "ok" for r in run.disparity().collect()} == {True}
    run.strict = True
    with pytest.raises(StageFailed):
        run.disparity()


def test_masks_and_region_are_applied(spark, tmp_path):
    from altiplano.plans import pipeline
    from altiplano.sources.images import write_image

    s = scene((0.0, 0.5), 12.0)
    for i, im in enumerate(s.images):
        write_image(str(tmp_path / f"{i}.tif"), im.astype(np.float32))
    wat = np.ones((200, 200), np.uint8)
    wat[:, 120:] = 0
    write_image(str(tmp_path / "wat.tif"), wat)
    ring = [[LON + x * STEP, LAT - y * STEP] for x, y in ((0, 0), (180, 0), (180, 100), (0, 100), (0, 0))]
    view = lambda i, **more: {"img": str(tmp_path / f"{i}.tif"), "rpc": {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in s.cameras[i].values.items()}, **more}
    user = {"images": [view(0, wat=str(tmp_path / "wat.tif")), view(1)], "roi_geojson": {"type": "Polygon", "coordinates": [ring]}, "out_dir": str(tmp_path / "out"), "tile_size": 60, "horizontal_margin": 20, "vertical_margin": 5, "alt_min": -10, "alt_max": 30}
    c = config.build(user)
    one = pipeline.load(spark, c)
    assert abs(one.roi.x) <= 1 and abs(one.roi.y) <= 1 and abs(one.roi.w - 180) <= 2 and abs(one.roi.h - 100) <= 2
    run = Run(spark, c, one, 32740)
    run.run()
    assert run.table("tiles").where("x > 100").count() == 0 and run.table("tiles").count() > 0
    at = run.table("points").agg(F.min("row"), F.min("col"), F.max("col"), F.count("*")).first()
    assert at[0] >= 10 and at[1] >= 10 and at[2] < 120 and at[3] > 3000
    with pytest.raises(config.ConfigError):
        Run(spark, config.build({**user, "use_srtm": True}), one, 32740)


def test_cameras_and_polygons(spark, tmp_path):
    from altiplano.plans import pipeline
    from altiplano.sources import gml

    cam = camera(0.3).values
    tags = {"LINE_OFF": "row_offset", "SAMP_OFF": "col_offset", "LAT_OFF": "lat_offset", "LONG_OFF": "lon_offset", "HEIGHT_OFF": "alt_offset", "LINE_SCALE": "row_scale", "SAMP_SCALE": "col_scale", "LAT_SCALE": "lat_scale", "LONG_SCALE": "lon_scale", "HEIGHT_SCALE": "alt_scale"}
    lines = [f"{k}: {float(cam[v])!r} pixels" for k, v in tags.items()]
    for stem, name in (("LINE_NUM", "row_num"), ("LINE_DEN", "row_den"), ("SAMP_NUM", "col_num"), ("SAMP_DEN", "col_den")):
        lines += [f"{stem}_COEFF_{i + 1}: {float(x)!r}" for i, x in enumerate(cam[name])]
    (tmp_path / "rpc.txt").write_text("\n".join(lines))
    got = pipeline.camera_of(spark, str(tmp_path / "rpc.txt"), None)
    at = np.array([LON + 50 * STEP]), np.array([LAT - 70 * STEP]), np.array([7.0])
    assert np.allclose(got.project(*at), camera(0.3).project(*at))

    class Tagged:
        camera = staticmethod(lambda: None)

    with pytest.raises(config.ConfigError):
        pipeline.camera_of(spark, None, Tagged)
    text = '<gml:Polygon><gml:posList srsDimension="2">2 1 8 1 8 6 2 6 2 1</gml:posList></gml:Polygon><gml:coordinates>4,2 6,2 6,4 4,4</gml:coordinates><x>1 2</x>'
    rings = spark.createDataFrame([(text,), ("none",)], "t string").select(gml.rings(F.col("t")).alias("r")).collect()
    assert [len(r) for r in rings[0].r] == [5, 4] and rings[1].r == []
    inside = images.inside_rings([[(p.x, p.y) for p in ring] for ring in rings[0].r], 8, 10)
    want = np.zeros((8, 10), bool)
    want[1:6, 2:8] = True
    want[2:4, 4:6] = False
    assert (inside == want).all()


def test_growing_grid(spark, tmp_path):
    points = spark.range(3000).select((F.col("id") % 61 * 1.1).alias("x"), (F.col("id") % 47 * 0.9).alias("y"), F.cos("id").alias("z"))
    points.repartition(6).write.parquet(str(tmp_path / "in"))
    grid = GrowingGrid(str(tmp_path / "grid"), 4.0)
    stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    grid.start(stream).awaitTermination()
    grid.start(stream).awaitTermination()  # a restart goes on, and counts nothing again
    want = {(r.cx, r.cy): (r.n, round(r.z, 9)) for r in dsm.grid(points, 4.0).collect()}
    assert {(r.cx, r.cy): (r.n, round(r.z, 9)) for r in grid.read(spark).collect()} == want
    grid.add(points.limit(0), 0)  # a batch that runs again replaces itself
    assert sum(r.n for r in grid.read(spark).collect()) < 3000

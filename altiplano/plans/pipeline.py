"""From rectified or raw stereo pairs to clouds and one elevation model, as staged tables.

Stages: plan tiles; match keypoints and correct the pointing (a barrier by pair); rectify; match densely; triangulate
(two views) or fuse heights (more, with the means' barrier); filter; grid.  Every stage's table is written, so a run
can start from any of them; a tile that fails is a row with a status, unless strict.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import os
import shutil
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import geo, planar
from ..kernels import images, tiles, triangulate
from ..operators import cloud, dsm, estimation, masks, matching, morphology
from ..operators.tiling import neighbors, tile_grid
from ..sources import geojson, gml, ply, rpcfile
from ..sources.images import Tiff, write_image
from ..stage import mark, release

STEPS = ("plan", "matches", "pointing", "rectification", "disparity", "points", "cloud", "dsm", "products")


#: Parameters that no stage reads: another value than the default is refused, not passed over.
UNSUPPORTED = ("rectification_method", "use_srtm", "exogenous_dem", "out_geoid", "stereo_speckle_filter", "census_ncc_win", "mgm_nb_directions", "mgm_leftright_threshold", "mgm_leftright_control", "mgm_mindiff_control")


def supported(cfg: C.Config) -> None:
    default = {f.name: f.default for f in dataclasses.fields(C.Config)}
    for k in UNSUPPORTED:
        if getattr(cfg, k) != default[k]:
            raise C.ConfigError(f"{k} is not supported")
    for v in cfg.images:
        if v.clr:
            raise C.ConfigError("clr of an image is not supported")
    if cfg.disp_range_method == "fixed_pixel_range" and (cfg.disp_min is None or cfg.disp_max is None):
        raise C.ConfigError("fixed_pixel_range needs disp_min and disp_max")
    if cfg.disp_range_method == "fixed_altitude_range" and (cfg.alt_min is None or cfg.alt_max is None):
        raise C.ConfigError("fixed_altitude_range needs alt_min and alt_max")


class StageFailed(RuntimeError):
    """A tile failed in a strict run."""


@dataclass
class Scene:
    """Images in memory by number (the reference first), their cameras, and the region."""

    images: list[np.ndarray]
    cameras: list[triangulate.Camera]
    roi: C.Roi
    wat: np.ndarray | None = None  # of the reference: 0 where water is
    inside: list | None = None  # rings of its domain, and of its clouds
    clouds: list | None = None


def camera_of(spark: SparkSession, rpc: dict | str | None, image: Tiff) -> triangulate.Camera:
    """From a dict, a file (JSON, text tags, or one of the XML layouts), or the image's own tags."""
    if rpc is None:
        rpc = image.camera()
        if rpc is None:
            raise C.ConfigError("an image without rpc has no camera in its tags")
    if isinstance(rpc, str):
        files = rpcfile.read_files(spark, rpc)
        kind, content = files.select("kind", "content").first()
        if kind is None:
            try:
                rpc = json.loads(content)
            except ValueError as e:
                raise C.ConfigError(f"no camera in {rpc}") from e
        else:
            parse = {"text": rpcfile.parse_text, "worldview": rpcfile.parse_worldview, "pleiades": rpcfile.parse_pleiades}[kind]
            rpc = parse(files).first()["rpc"].asDict()
    missing = [k for k in (*triangulate.ARRAYS, "col_offset", "row_offset", "alt_offset") if rpc.get(k) is None]
    if missing:
        raise C.ConfigError(f"the camera has no {missing[0]}")
    # projection-only files say nothing of the scales of the direct model that they lack
    return triangulate.Camera.of(rpc)


def load(spark: SparkSession, cfg: C.Config) -> Scene:
    """Images by Spark's reader, their cameras, and the reference's masks (a raster of water, polygons of the others)."""
    read = lambda path: Tiff(bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]))
    polygons = lambda path: [[(p["x"], p["y"]) for p in ring] for ring in spark.read.text(path, wholetext=True).select(gml.rings(F.col("value"))).first()[0]] if path else None
    ims, cams = [], []
    for v in cfg.images:
        image = read(v.img)
        ims.append(image.read()[0])
        cams.append(camera_of(spark, v.rpc, image))
    ref = cfg.images[0]
    wat = read(ref.wat).read()[0] if ref.wat else None
    roi = cfg.roi
    if roi is None and not cfg.full_img and cfg.roi_geojson:
        roi = polygon_roi(spark, cfg.roi_geojson, cams[0])
    return Scene(ims, cams, roi or C.Roi(0, 0, ims[0].shape[1], ims[0].shape[0]), wat, polygons(ref.roi), polygons(ref.cld))


def polygon_roi(spark: SparkSession, polygon: str | dict, camera: triangulate.Camera) -> C.Roi:
    """The image box of a GeoJSON polygon (a path or a dict) at the camera's mean height."""
    text = spark.createDataFrame([(json.dumps(polygon),)], "value string") if isinstance(polygon, dict) else spark.read.text(polygon, wholetext=True)
    ring = text.select(geojson.ring(F.col("value"))).first()[0]
    if not ring:
        raise C.ConfigError("roi_geojson holds no polygon")
    u, v = camera.project(*np.array([(p["lon"], p["lat"]) for p in ring], float).T, camera["alt_offset"])
    return C.Roi.of({"x": u.min(), "y": v.min(), "w": u.max() - u.min(), "h": v.max() - v.min()})


def virtual_matches(a: triangulate.Camera, b: triangulate.Camera, box: tuple[float, float, float, float], n: int, low: float, high: float) -> np.ndarray:
    """(n^3, 4) projections of a mesh of ground points."""
    x, y, w, h = box
    xs, ys = x + w * (np.arange(n) + 0.5) / n, y + h * (np.arange(n) + 0.5) / n
    z, r, c = (g.ravel() for g in np.meshgrid(np.linspace(low, high, n), ys, xs, indexing="ij"))
    lon, lat = a.localize(c, r, z)
    return np.column_stack([*a.project(lon, lat, z), *b.project(lon, lat, z)])


def rectify(f: np.ndarray, box: tuple[float, float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """The two rectifying similarities of (a, b, c, d, e), with the box's image at the origin."""
    one, two = (np.reshape(h, (3, 3)) for h in planar.levelling(*f, np.hypot, np.sqrt))
    x, y, w, h = box
    corners = one @ np.array([[x, x + w, x + w, x], [y, y, y + h, y + h], [1, 1, 1, 1]])
    move = np.array([[1, 0, -corners[0].min()], [0, 1, -corners[1].min()], [0, 0, 1]])
    return move @ one, move @ two


class Run:
    """A run over a scene; tables go to out_dir/<step>/pair=<n> as Parquet."""

    def __init__(self, spark: SparkSession, cfg: C.Config, scene: Scene, out_crs: int | str | None = None, strict: bool = False):
        supported(cfg)
        self.spark, self.cfg, self.scene, self.strict = spark, cfg, scene, strict
        self.crs = out_crs or cfg.out_crs or self._local_utm()

    def _local_utm(self) -> str:
        r, cam = self.scene.roi, self.scene.cameras[0]
        lon, lat = cam.localize(r.x + r.w / 2, r.y + r.h / 2, cam["alt_offset"])
        return f"epsg:{(32600 if lat >= 0 else 32700) + int((float(lon) + 180) // 6) + 1}"

    def table(self, step: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.cfg.out_dir, step))

    def save(self, step: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(os.path.join(self.cfg.out_dir, step))
        return self.table(step)

    def plan(self) -> DataFrame:
        r = self.scene.roi
        roi = self.spark.createDataFrame([(0, r.x, r.y, r.w, r.h)], "roi_id int, x int, y int, w int, h int")
        grid = tile_grid(roi, self.cfg.tile_size).withColumn("tile_id", (F.col("iy") * 100000 + F.col("ix")).cast("long"))
        valid, out = self.valid(), []
        for t in grid.collect():  # small rows
            if valid[max(0, t["y"]) : max(0, t["y"] + t["h"]), max(0, t["x"]) : max(0, t["x"] + t["w"])].any():
                out.append(t)
        if not out:
            raise C.ConfigError("the region is totally masked")
        return self.save("tiles", self.spark.createDataFrame(out, grid.schema))

    def valid(self) -> np.ndarray:
        """Pixels of the reference off its border, in its domain, and out of its clouds and water (0 in the wat raster)."""
        h, w = self.scene.images[0].shape[:2]
        m = self.cfg.border_margin
        ok = np.zeros((h, w), bool)
        ok[m : max(m, h - m), m : max(m, w - m)] = True
        if self.scene.inside is not None:
            ok &= images.inside_rings(self.scene.inside, h, w)
        if self.scene.clouds is not None:
            ok &= ~images.inside_rings(self.scene.clouds, h, w)
        if self.scene.wat is not None:
            wat = np.zeros((h, w), bool)
            part = self.scene.wat[:h, :w] if self.scene.wat.ndim == 2 else self.scene.wat[:h, :w, 0]
            wat[: part.shape[0], : part.shape[1]] = part != 0
            ok &= wat
        return ok

    def altitudes(self) -> tuple[float, float]:
        cam, k = self.scene.cameras[0], self.cfg.rpc_alt_range_scale_factor
        low = self.cfg.alt_min if self.cfg.alt_min is not None else cam["alt_offset"] - k * cam["alt_scale"]
        high = self.cfg.alt_max if self.cfg.alt_max is not None else cam["alt_offset"] + k * cam["alt_scale"]
        return low, high

    def _boxes(self) -> dict[int, tuple[int, int, int, int]]:
        """The plan's tiles, small rows, on the driver."""
        return {r["tile_id"]: (r["x"], r["y"], r["w"], r["h"]) for r in self.table("tiles").collect()}

    def matches(self) -> DataFrame:
        """tile_id, pair, x1, y1, x2, y2: keypoints of a tile matched to those of the region that it is seen in.

        The second threshold is tried where the first gives ten matches or fewer; a tile with no more has none.
        """
        boxes, (low, high) = self._boxes(), self.altitudes()
        shared, cams, c = self.spark.sparkContext.broadcast(self.scene.images), self.scene.cameras, self.cfg
        tiles.prepare(self.spark)

        def found(box, pair):
            import numpy as np

            x, y, w, h = box
            virtual = virtual_matches(cams[0], cams[pair], box, c.n_gcp_per_axis, low, high)
            f = images.affine_fundamental(virtual)
            m = int(np.ceil(c.max_pointing_error))
            x0, y0 = (max(0, int(np.floor(v.min())) - m) for v in virtual[:, 2:].T)
            x1, y1 = (int(np.ceil(v.max())) + m + 1 for v in virtual[:, 2:].T)
            for threshold in (0.0133, 0.0133 / 2):
                a = images.keypoints(shared.value[0][max(0, y) : y + h, max(0, x) : x + w], threshold, origin=(max(0, x), max(0, y)))
                b = images.keypoints(shared.value[pair][y0:y1, x0:x1], threshold, origin=(x0, y0))
                if len(a) and len(b) > 1:
                    near, d = matching.nearest_two(a[:, 4:], b[:, 4:], (a[:, :2].T, b[:, :2].T), c.max_pointing_error, f)
                    one, two = np.sqrt(d).T
                    # as matching.match(): a lone candidate has no second and is no match
                    ok = np.isfinite(two) & (one < c.sift_match_thresh * two) if c.relative_sift_match_thresh else one < c.sift_match_thresh
                    m4 = np.column_stack([a[ok, :2], b[near[ok, 0].astype(int), :2]])
                    m4 = m4[images.ransac_fundamental(m4, x * 7919 + y * 104729 + pair)]
                    if len(m4) > 10:
                        return m4
            return np.empty((0, 4))

        def run(batches):
            import pandas as pd

            for part in batches:
                for t in part.itertuples():
                    m = found(boxes[t.tile_id], t.pair)
                    yield pd.DataFrame({"tile_id": t.tile_id, "pair": t.pair, "x1": m[:, 0], "y1": m[:, 1], "x2": m[:, 2], "y2": m[:, 3]})

        jobs = self.table("tiles").select("tile_id").crossJoin(self.spark.range(1, len(self.scene.cameras)).select(F.col("id").cast("int").alias("pair")))
        return self.save("matches", jobs.repartition("tile_id", "pair").mapInPandas(run, "tile_id long, pair int, x1 double, y1 double, x2 double, y2 double"))

    def pointing(self) -> DataFrame:
        """pair, a: the correction of each pair over all tiles (the barrier); the identity where no tile has any."""
        low, high = self.altitudes()
        rows = []
        for tile, box in self._boxes().items():
            for pair in range(1, len(self.scene.cameras)):
                f = images.affine_fundamental(virtual_matches(self.scene.cameras[0], self.scene.cameras[pair], box, self.cfg.n_gcp_per_axis, low, high))
                rows.append((tile, pair, *map(float, f)))
        f = self.spark.createDataFrame(rows, "tile_id long, pair int, a double, b double, c double, d double, e double").select("tile_id", "pair", F.struct(*"abcde").alias("f"))
        keys = ["tile_id", "pair"]
        m = self.table("matches").join(F.broadcast(f), keys)
        return self.save("pointing", estimation.global_pointing(estimation.corrections(f, m, keys)))

    def corrections(self) -> dict[int, list[float]]:
        """The pointing by pair: one small row each."""
        return {r["pair"]: list(r["a"]) for r in self.table("pointing").collect()}

    def rectification(self) -> DataFrame:
        """tile_id, pair, h1, h2, disp_min, disp_max, width, height: one small row for each tile and pair.

        The homographies come from the cameras' virtual matches, the range by the method: that of the altitudes
        (exogenous, fixed_altitude_range), that of the tile's and its neighbours' matches (sift), the wider of both
        (the default), or the given one.
        """
        pointing = self.corrections()
        rows, low_high = [], self.altitudes()
        a = self.scene.cameras[0]
        for tile, box in self._boxes().items():
            for pair in range(1, len(self.scene.cameras)):
                m = virtual_matches(a, self.scene.cameras[pair], box, self.cfg.n_gcp_per_axis, *low_high)
                undo = np.linalg.inv(np.reshape(pointing.get(pair, np.eye(3)), (3, 3)))
                m[:, 2:] = (np.column_stack([m[:, 2:], np.ones(len(m))]) @ undo.T)[:, :2]
                if len(m) < 4:
                    raise estimation.NotEnoughMatches(f"{len(m)} matches")
                f = images.affine_fundamental(m)
                h1, h2 = rectify(f, box)
                apply = lambda h, p: (np.column_stack([p, np.ones(len(p))]) @ h.T)[:, :2]
                if self.cfg.register_with_shear:
                    level = virtual_matches(a, self.scene.cameras[pair], box, 4, sum(low_high) / 2, sum(low_high) / 2)
                    level[:, 2:] = (np.column_stack([level[:, 2:], np.ones(len(level))]) @ undo.T)[:, :2]
                    u1, u2 = apply(h1, level[:, :2]), apply(h2, level[:, 2:])
                    p, q, c = np.linalg.lstsq(np.column_stack([u2, np.ones(len(u2))]), u1[:, 0], rcond=None)[0]
                    h2 = np.array([[p, q, c], [0, 1, 0], [0, 0, 1]]) @ h2
                d = apply(h2, m[:, 2:])[:, 0] - apply(h1, m[:, :2])[:, 0]
                h2 = np.array([[1, 0, -d.mean()], [0, 1, 0], [0, 0, 1]]) @ h2
                d = d - d.mean()
                lo, hi = np.floor(d.min()), np.ceil(d.max())
                lo = lo - (hi - lo) * self.cfg.disp_range_extra_margin
                hi = hi + (hi - lo) * self.cfg.disp_range_extra_margin
                x, y, w, h = box
                size = (h1 @ np.array([[x, x + w, x + w, x], [y, y, y + h, y + h], [1, 1, 1, 1]])).max(1)
                rows.append((tile, pair, h1.ravel().tolist(), h2.ravel().tolist(), float(lo), float(hi), float(size[0]), float(size[1]), *map(float, f)))
        keys = ["tile_id", "pair"]
        plan = self.spark.createDataFrame(rows, "tile_id long, pair int, h1 array<double>, h2 array<double>, lo double, hi double, w double, h double, a double, b double, c double, d double, e double")
        plan = plan.select(*keys, "h1", "h2", "lo", "hi", "w", "h", F.struct(*"abcde").alias("f"))
        near = estimation.rectified(self.neighbor_matches().join(F.broadcast(plan), keys), F.col("h1"), F.col("h2"))
        found = estimation.match_disparities(matching.epipolar_filter(near, max(self.cfg.epipolar_thresh, self.cfg.max_pointing_error)), keys, self.cfg.disp_range_extra_margin)
        own = (F.col("lo"), F.col("hi"))
        lo, hi = estimation.disparity_range(self.cfg.disp_range_method, (F.col("disp_min"), F.col("disp_max"), F.coalesce("n", F.lit(0))), own, (self.cfg.disp_min or 0, self.cfg.disp_max or 0), own)
        ranged = plan.join(found, keys, "left").select(*keys, "h1", "h2", "w", "h", lo.alias("disp_min"), hi.alias("disp_max"))
        margin = F.ceil(F.greatest(F.lit(float(self.cfg.horizontal_margin)), F.abs("disp_min"), F.abs("disp_max"))).cast("int")
        move = planar.translation(margin, self.cfg.vertical_margin)
        out = ranged.select(*keys, planar.multiply(move, F.col("h1")).alias("h1"), planar.multiply(move, F.col("h2")).alias("h2"), "disp_min", "disp_max", (F.ceil("w").cast("int") + 2 * margin).alias("width"), (F.ceil("h").cast("int") + 2 * self.cfg.vertical_margin).alias("height"))
        return self.save("rectification", out)

    def neighbor_matches(self) -> DataFrame:
        """tile_id, pair, x1, y1, x2, y2: a tile's matches and those of its neighbours near it, each once."""
        pairs = self.spark.range(1, len(self.scene.cameras)).select(F.col("id").cast("int").alias("pair"))
        plan = self.table("tiles").crossJoin(F.broadcast(pairs))
        own = self.table("matches").join(plan.select("roi_id", "ix", "iy", "tile_id", "pair"), ["tile_id", "pair"]).drop("tile_id")
        keys = ["roi_id", "pair"]
        near = matching.distinct(matching.with_neighbors(own, plan, neighbors(plan, keys), keys), [*keys, "ix", "iy"])
        return near.join(plan.select(*keys, "ix", "iy", "tile_id"), [*keys, "ix", "iy"]).select("tile_id", "pair", "x1", "y1", "x2", "y2")

    def disparity(self) -> DataFrame:
        """tile_id, pair, row, col, d, confidence, status: warp both images and match, one task a tile and pair."""
        shared = self.spark.sparkContext.broadcast(self.scene.images)
        limit, algorithm = self.cfg.max_disp_range, self.cfg.matching_algorithm
        if algorithm not in images.MATCHERS:
            raise ValueError(f"unknown matching algorithm {algorithm!r}")
        multiplier = self.cfg.stereo_regularity_multiplier
        disk = masks.disk(int(self.cfg.msk_erosion)) if self.cfg.msk_erosion >= 2 else []

        def eroded(mask):
            h, w = mask.shape
            out = mask.copy()
            for i, j in disk:  # outside nothing is rejected
                to, of = ((slice(max(0, -i), h - max(0, i)), slice(max(0, -j), w - max(0, j))), (slice(max(0, i), h - max(0, -i)), slice(max(0, j), w - max(0, -j))))
                out[to] &= mask[of]
            return out

        def run(batches):
            import pandas as pd

            for part in batches:
                for t in part.itertuples():
                    ref = images.warp(shared.value[0], t.h1, t.width, t.height)
                    sec = images.warp(shared.value[t.pair], t.h2, t.width, t.height)
                    try:
                        d, mask, conf = images.match_dense(ref, sec, t.disp_min, t.disp_max, algorithm, limit, multiplier)
                    except ValueError as e:
                        yield pd.DataFrame([{"tile_id": t.tile_id, "pair": t.pair, "row": None, "col": None, "d": None, "confidence": None, "status": str(e)}])
                        continue
                    row, col = np.nonzero(eroded(mask))
                    yield pd.DataFrame({"tile_id": t.tile_id, "pair": t.pair, "row": row, "col": col, "d": d[row, col], "confidence": conf[row, col].astype(float), "status": "ok"})

        tiles.prepare(self.spark)
        jobs = self.table("rectification").repartition("tile_id", "pair")
        out = self.save("disparity", jobs.mapInPandas(run, "tile_id long, pair int, row int, col int, d double, confidence double, status string"))
        if self.strict and not out.where("status <> 'ok'").isEmpty():
            raise StageFailed(out.where("status <> 'ok'").first()["status"])
        return out

    def points(self) -> DataFrame:
        """tile_id, pair, row, col, lon, lat, alt, err: every accepted disparity pixel triangulated, by Arrow batch."""
        plan = {(r["tile_id"], r["pair"]): r for r in self.table("rectification").collect()}
        boxes = {t: (x, y, x + w - 1, y + h - 1) for t, (x, y, w, h) in self._boxes().items()}
        cams, pointing = self.scene.cameras, self.corrections()
        valid = self.spark.sparkContext.broadcast(self.valid())

        def run(batches):
            seen = valid.value
            for part in batches:
                for (tile, pair), g in part.groupby(["tile_id", "pair"]):
                    p = plan[(tile, pair)]
                    back1 = np.linalg.inv(np.reshape(p["h1"], (3, 3)))
                    undo = np.linalg.inv(np.reshape(pointing.get(pair, np.eye(3)), (3, 3)))
                    back2 = np.linalg.inv(np.reshape(p["h2"], (3, 3)) @ undo)
                    col, row, d = (g[c].to_numpy(float) for c in ("col", "row", "d"))
                    one = np.column_stack([col, row, np.ones(len(g))]) @ back1.T
                    two = np.column_stack([col + d, row, np.ones(len(g))]) @ back2.T
                    x1, y1, x2, y2 = one[:, 0] / one[:, 2], one[:, 1] / one[:, 2], two[:, 0] / two[:, 2], two[:, 1] / two[:, 2]
                    b = boxes[tile]
                    away = lambda v: np.sign(v) * np.floor(np.abs(v) + 0.5)
                    ok = (away(x1) >= b[0]) & (away(x1) <= b[2]) & (away(y1) >= b[1]) & (away(y1) <= b[3])
                    ok &= (away(x1) >= 0) & (away(x1) < seen.shape[1]) & (away(y1) >= 0) & (away(y1) < seen.shape[0])
                    ok[ok] = seen[away(y1[ok]).astype(int), away(x1[ok]).astype(int)]
                    if not ok.any():
                        continue
                    h, err = triangulate.heights(cams[0], cams[pair], x1[ok], y1[ok], x2[ok], y2[ok])
                    lon, lat = cams[0].localize(x1[ok], y1[ok], h)
                    yield g.loc[ok, ["tile_id", "pair"]].assign(row=away(y1[ok]).astype(int), col=away(x1[ok]).astype(int), lon=lon, lat=lat, alt=h, err=err)

        found = self.table("disparity").where("status = 'ok'").select("tile_id", "pair", "row", "col", "d")
        return self.save("points", found.mapInPandas(run, "tile_id long, pair int, row int, col int, lon double, lat double, alt double, err double"))

    def cloud(self) -> DataFrame:
        """row, col, id, x, y, z in the output CRS: the points of two views, or the fused heights of more."""
        from ..operators import fusion

        points = self.table("points").where("NOT isnan(alt)")
        if len(self.scene.images) > 2:
            n = len(self.scene.images) - 1
            heights = points.groupBy("tile_id", "row", "col", "pair").agg(F.avg("alt").alias("z"))
            means = fusion.global_means(fusion.local_means(heights, n, ["tile_id"], ["row", "col"]))
            if means.isEmpty():
                means = heights.groupBy("pair").agg(F.lit(0e0).alias("mean"))
            fused = fusion.fuse(heights, means, n, self.cfg.fusion_operator, self.cfg.fusion_thresh, ["tile_id", "row", "col"])
            if self.cfg.cargarse_basura:
                width = int(self.scene.images[0].shape[1])
                whole = fused.withColumn("id", F.col("row").cast("long") * width + F.col("col"))
                fused = morphology.clean(whole.withColumnRenamed("z", "v"), keys=["tile_id"]).withColumnRenamed("v", "z").where("z IS NOT NULL").drop("id")
            at = triangulate.height_map_points(fused, self.scene.cameras[0], 0, 0, ["tile_id"])
        else:
            at = points.groupBy("tile_id", "row", "col").agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.avg("alt").alias("alt"))
        x, y, z = geo.transform(F.col("lon"), F.col("lat"), F.col("alt"), 4979, self.crs)
        width = int(self.scene.images[0].shape[1])
        out = at.select("tile_id", "row", "col", (F.col("row").cast("long") * width + F.col("col")).alias("id"), x.alias("x"), y.alias("y"), z.alias("z"))
        return self.save("cloud", cloud.filter_cloud(out, self.cfg.filter_3d_r, self.cfg.filter_3d_n, self.sampling_distance()))

    def sampling_distance(self) -> float:
        """Metres between two columns of the reference, at its camera's centre and height 0."""
        cam = self.scene.cameras[0]
        lon, lat = cam.localize(np.array([0, 1]) + cam["col_offset"], cam["row_offset"], 0.0)
        at = self.spark.createDataFrame([(float(x), float(y)) for x, y in zip(lon, lat, strict=True)], "lon double, lat double")
        x, y, z = geo.lonlat_to_geocentric(F.col("lon"), F.col("lat"), F.lit(0e0))
        one, two = at.coalesce(1).select(x.alias("x"), y.alias("y"), z.alias("z")).collect()
        return float(np.linalg.norm(np.subtract(one, two)))

    def products(self, block: int = 2048) -> None:
        """The cloud as PLY files (with the CRS in a comment) and the model as tiles of TIFF, named by their first cell.

        A task writes the blocks that it has, each under a hidden name that is then changed, so a lost attempt leaves
        no half file; out_dir is a folder that all executors see.
        """
        ply.register(self.spark)
        self.table("cloud").where("z IS NOT NULL").select("x", "y", "z").write.format("ply").mode("overwrite").option("comments", f"created by altiplano|projection: CRS {self.crs}").option("path", os.path.join(self.cfg.out_dir, "ply")).save()
        out = os.path.join(os.path.abspath(self.cfg.out_dir), "dsm_tif")
        shutil.rmtree(out, ignore_errors=True)
        os.makedirs(out)
        tiles.prepare(self.spark)
        counted = "n" if "n" in self.table("dsm").columns else "z"

        def write(part):
            import pandas as pd

            bx, by = int(part["bx"].iloc[0]), int(part["by"].iloc[0])
            im = np.full((2, block, block), np.nan, np.float32)
            i, j = part["cy"].to_numpy() - by * block, part["cx"].to_numpy() - bx * block
            im[0, i, j], im[1, i, j] = part["z"], part["n"]
            name = os.path.join(out, f"dsm_{bx * block}_{by * block}.tif")
            hidden = os.path.join(out, f".{os.getpid()}-{os.path.basename(name)}")
            write_image(hidden, im)
            os.replace(hidden, name)
            return pd.DataFrame({"bx": [bx], "by": [by], "cells": [len(part)]})

        at = self.table("dsm").select("cx", "cy", "z", F.col(counted).cast("double").alias("n"), F.floor(F.col("cx") / block).alias("bx"), F.floor(F.col("cy") / block).alias("by"))
        self.save("products", at.groupBy("bx", "by").applyInPandas(write, "bx long, by long, cells long"))

    def dsm(self) -> DataFrame:
        step = float(self.cfg.dsm_resolution)
        if self.cfg.dsm_radius:
            return self.save("dsm", dsm.grid_weighted(self.table("cloud"), step, int(self.cfg.dsm_radius), self.cfg.dsm_sigma))
        return self.save("dsm", dsm.grid(self.table("cloud"), step))

    def run(self, start_from: int = 0) -> DataFrame:
        """All stages from a number on; earlier ones are read from their tables."""
        before = mark(self.spark)
        os.makedirs(self.cfg.out_dir, exist_ok=True)
        with open(os.path.join(self.cfg.out_dir, "config.json"), "w") as f:
            f.write(self.cfg.to_json())
        for k, step in enumerate([getattr(self, name) for name in STEPS]):
            if k >= start_from:
                step()
        release(self.spark, before)  # every stage's own table is written
        return self.table("dsm")


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Elevation model of a stereo scene.")
    parser.add_argument("config")
    parser.add_argument("--start-from", type=int, default=0)
    got = parser.parse_args(args)
    cfg = C.read(got.config)
    spark = SparkSession.builder.appName("altiplano").getOrCreate()
    os.makedirs(cfg.out_dir, exist_ok=True)
    if os.path.abspath(os.path.dirname(got.config)) != os.path.abspath(cfg.out_dir):
        shutil.copy(got.config, os.path.join(cfg.out_dir, "config.original.json"))
    Run(spark, cfg, load(spark, cfg)).run(got.start_from)


if __name__ == "__main__":
    main()

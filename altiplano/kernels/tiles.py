"""Kernels over tables of raster tiles: a blob row is keys, h, w and the float64 bytes of a tile."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stage import prepare
from . import images

BLOB = "h int, w int, data binary"


def pack(im: np.ndarray) -> tuple[int, int, bytes]:
    return im.shape[0], im.shape[1], np.ascontiguousarray(im, "<f8").tobytes()


def unpack(h: int, w: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(h, w)


def _schema(df: DataFrame, keys: list[str], rest: str) -> str:
    types = dict(df.dtypes)
    return ", ".join([*[f"`{k}` {types[k]}" for k in keys], rest])


def to_pixels(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """keys, row, col, v of blob rows, missing ones left out."""
    prepare(tiles.sparkSession)

    def run(batches):
        for part in batches:
            for _, t in part.iterrows():
                im = unpack(t["h"], t["w"], t["data"])
                row, col = np.nonzero(np.isfinite(im))
                yield pd.DataFrame({**{k: [t[k]] * len(row) for k in keys}, "row": row, "col": col, "v": im[row, col]})

    return tiles.select(*keys, "h", "w", "data").mapInPandas(run, _schema(tiles, keys, "row int, col int, v double"))


def to_tiles(pixels: DataFrame, keys: list[str], height: int, width: int) -> DataFrame:
    """Blob rows of pixels (keys, row, col, v); what is not there is NaN.  One tile is put together in one task."""
    prepare(pixels.sparkSession)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        im = np.full((height, width), np.nan)
        im[part["row"], part["col"]] = part["v"]
        h, w, data = pack(im)
        return pd.DataFrame({**{k: [part[k].iloc[0]] for k in keys}, "h": [h], "w": [w], "data": [data]})

    return pixels.select(*keys, "row", "col", "v").groupBy(*keys).applyInPandas(run, _schema(pixels, keys, BLOB))


def warp(tiles: DataFrame, keys: list[str], width: int, height: int) -> DataFrame:
    """Blob rows resampled by their homography (array m)."""
    prepare(tiles.sparkSession)

    def run(batches):
        for part in batches:
            out = [pack(images.warp(unpack(t["h"], t["w"], t["data"]), t["m"], width, height)) for _, t in part.iterrows()]
            yield part[keys].assign(h=[x[0] for x in out], w=[x[1] for x in out], data=[x[2] for x in out])

    return tiles.select(*keys, "h", "w", "data", "m").mapInPandas(run, _schema(tiles, keys, BLOB))


def dense_match(pairs: DataFrame, keys: list[str], algorithm: str = "mgm", limit: float | None = None, erosion: float = 0.0) -> DataFrame:
    """keys, row, col, d, confidence of accepted pixels, and a status row (row null) for a tile that failed.

    pairs: keys, h, w, ref, sec (blobs), disp_min, disp_max.  One tile is one call; a cost volume is
    h * w * (range + 1) floats, which the tile size bounds.
    """
    if algorithm not in images.MATCHERS:
        raise ValueError(f"unknown matching algorithm {algorithm!r}")
    prepare(pairs.sparkSession)
    schema = _schema(pairs, keys, "row int, col int, d double, confidence double, status string")

    def run(batches):
        for part in batches:
            for _, t in part.iterrows():
                own = {k: t[k] for k in keys}
                try:
                    disparity, mask, confidence = images.match_dense(unpack(t["h"], t["w"], t["ref"]), unpack(t["h"], t["w"], t["sec"]), t["disp_min"], t["disp_max"], algorithm, limit)
                except ValueError as e:
                    yield pd.DataFrame([{**own, "row": None, "col": None, "d": None, "confidence": None, "status": str(e)}])
                    continue
                row, col = np.nonzero(images.erode(mask, erosion))
                yield pd.DataFrame({**{k: [v] * len(row) for k, v in own.items()}, "row": row, "col": col, "d": disparity[row, col], "confidence": confidence[row, col].astype(float), "status": "ok"})

    # the kernel is heavy, so every tile is dealt out on its own
    return pairs.repartition(*keys).mapInPandas(run, schema)


def detect(tiles: DataFrame, keys: list[str], threshold: float = 0.0133, most: int | None = None) -> DataFrame:
    """keys, kp_id, x, y, scale, ori, desc of blob rows with an origin (x0, y0)."""
    prepare(tiles.sparkSession)

    def run(batches):
        for part in batches:
            for _, t in part.iterrows():
                k = images.keypoints(unpack(t["h"], t["w"], t["data"]), threshold, most=most, origin=(t["x0"], t["y0"]))
                yield pd.DataFrame({**{c: [t[c]] * len(k) for c in keys}, "kp_id": np.arange(len(k)), "x": k[:, 0], "y": k[:, 1], "scale": k[:, 2], "ori": k[:, 3], "desc": list(k[:, 4:].astype(np.float32))})

    return tiles.select(*keys, "h", "w", "data", "x0", "y0").mapInPandas(run, _schema(tiles, keys, "kp_id long, x double, y double, scale double, ori double, desc array<float>"))


def ransac(matches: DataFrame, keys: list[str], trials: int = 1000, limit: float = 0.3) -> DataFrame:
    """The matches that agree on an affine fundamental matrix, by key; the seed is a hash of the key."""
    prepare(matches.sparkSession)
    seeded = matches.withColumn("_seed", F.pmod(F.xxhash64(*keys), F.lit(2**31)))
    cols = matches.columns

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["x1", "y1", "x2", "y2"]).reset_index(drop=True)
        return part[images.ransac_fundamental(part[["x1", "y1", "x2", "y2"]].to_numpy(float), int(part["_seed"].iloc[0]), trials, limit)][cols]

    return seeded.groupBy(*keys).applyInPandas(run, matches.schema)


def match_with_retry(detect_at, thresholds: tuple[float, ...] = (0.0133, 0.00665), least: int = 10) -> DataFrame | None:
    """Matches of the first threshold that gives more than `least`, else none, even if there were a few."""
    for t in thresholds:
        found = detect_at(t)
        if found.limit(least + 1).count() > least:
            return found
    return None

"""Localization by iteration and triangulation, vectorised over batches of points."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rpc import MONOMIALS
from ..stage import prepare

ARRAYS = ("col_num", "col_den", "row_num", "row_den")
DIRECT = ("lon_num", "lon_den", "lat_num", "lat_den")
NUMBERS = tuple(f"{a}_{b}" for a in ("col", "row", "lon", "lat", "alt") for b in ("offset", "scale"))


@dataclass(frozen=True)
class Camera:
    """A rational-polynomial camera in numpy; direct coefficients may be missing."""

    values: dict

    @classmethod
    def of(cls, row) -> Camera:
        get = row.get if hasattr(row, "get") else lambda k: row[k] if k in row else None
        out = {k: np.asarray(get(k), float) for k in ARRAYS} | {k: float(get(k)) for k in NUMBERS}
        return cls(out | {k: np.asarray(get(k), float) if get(k) is not None else None for k in DIRECT})

    def __getitem__(self, k: str):
        return self.values[k]

    @staticmethod
    def cubic(coef: np.ndarray, x, y, z) -> np.ndarray:
        return sum(c * x**i * y**j * z**k for c, (i, j, k) in zip(coef, MONOMIALS, strict=True))

    def project(self, lon, lat, alt) -> tuple[np.ndarray, np.ndarray]:
        x, y, z = ((v - self[f"{k}_offset"]) / self[f"{k}_scale"] for k, v in (("lon", lon), ("lat", lat), ("alt", alt)))
        col, row = (self.cubic(self[f"{k}_num"], x, y, z) / self.cubic(self[f"{k}_den"], x, y, z) for k in ("col", "row"))
        return col * self["col_scale"] + self["col_offset"], row * self["row_scale"] + self["row_offset"]

    def localize(self, col, row, alt, most: int = 20) -> tuple[np.ndarray, np.ndarray]:
        """By the direct coefficients, else by Newton's steps on a secant basis; NaN where they don't settle."""
        col, row, alt = np.broadcast_arrays(*[np.asarray(v, float) for v in (col, row, alt)])
        if self["lon_num"] is not None and np.isfinite(self["lon_num"][0]):
            x, y, z = ((v - self[f"{k}_offset"]) / self[f"{k}_scale"] for k, v in (("col", col), ("row", row), ("alt", alt)))
            lon, lat = (self.cubic(self[f"{k}_num"], x, y, z) / self.cubic(self[f"{k}_den"], x, y, z) for k in ("lon", "lat"))
            return lon * self["lon_scale"] + self["lon_offset"], lat * self["lat_scale"] + self["lat_offset"]
        u, v = np.zeros(col.shape), np.zeros(col.shape)  # normalised longitude and latitude
        step, done = 1e-4, np.zeros(col.shape, bool)
        back = lambda a, b: self.project(a * self["lon_scale"] + self["lon_offset"], b * self["lat_scale"] + self["lat_offset"], alt)
        for _ in range(most):
            c0, r0 = back(u, v)
            dx, dy = (col - c0) / self["col_scale"], (row - r0) / self["row_scale"]
            done = dx * dx + dy * dy <= 1e-24
            if done.all():
                break
            cu, ru = back(u + step, v)
            cv, rv = back(u, v + step)
            a, b, c, d = (cu - c0) / step, (cv - c0) / step, (ru - r0) / step, (rv - r0) / step
            det = a * d - b * c
            ex, ey = col - c0, row - r0
            with np.errstate(all="ignore"):
                u, v = np.where(done, u, u + (ex * d - ey * b) / det), np.where(done, v, v + (ey * a - ex * c) / det)
        lon, lat = u * self["lon_scale"] + self["lon_offset"], v * self["lat_scale"] + self["lat_offset"]
        return np.where(done, lon, np.nan), np.where(done, lat, np.nan)

    def transfer(self, other: Camera, x, y, alt) -> tuple[np.ndarray, np.ndarray]:
        return other.project(*self.localize(x, y, alt), alt)


def heights(a: Camera, b: Camera, xa, ya, xb, yb, most: int = 100, stop: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Height at which the point of a falls nearest to that of b on its epipolar curve, and the distance left there.

    A metre up the ray moves the transferred point by a vector; the wanted displacement's coordinate on it is the next
    step.  Points that have settled leave the iteration.
    """
    xa, ya, xb, yb = (np.asarray(v, float) for v in (xa, ya, xb, yb))
    h, err, live = np.zeros(len(xa)), np.full(len(xa), np.nan), np.arange(len(xa))
    for _ in range(most):
        if not len(live):
            break
        x, y, now = xa[live], ya[live], h[live]
        p, q = np.array(a.transfer(b, x, y, now)), np.array(a.transfer(b, x, y, now + 1))
        d, want = q - p, np.array([xb[live], yb[live]]) - p
        with np.errstate(all="ignore"):
            t = (d * want).sum(0) / (d * d).sum(0)
        err[live] = np.hypot(*(want - t * d))
        h[live] = now + t
        live = live[np.abs(t) >= stop]
    return h, err


def triangulate(matches: DataFrame, a: Camera, b: Camera, keep: list[str]) -> DataFrame:
    """keep, lon, lat, alt, err of matches (x1, y1, x2, y2); by Arrow batch, no shuffle."""
    prepare(matches.sparkSession)
    types = dict(matches.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keep], "lon double", "lat double", "alt double", "err double"])

    def run(batches):
        for part in batches:
            h, err = heights(a, b, *[part[c].to_numpy(float) for c in ("x1", "y1", "x2", "y2")])
            lon, lat = a.localize(part["x1"].to_numpy(float), part["y1"].to_numpy(float), h)
            yield part[keep].assign(lon=lon, lat=lat, alt=h, err=err)

    out = matches.select(*dict.fromkeys([*keep, "x1", "y1", "x2", "y2"])).mapInPandas(run, schema)
    return out.select(*keep, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("lon", "lat", "alt", "err")])


def disparity_points(pixels: DataFrame, a: Camera, b: Camera, h1: list[float], h2: list[float], pointing: list[float], box: tuple[float, float, float, float], keep: list[str]) -> DataFrame:
    """keep, row, col, lon, lat, alt, err of the disparity pixels (row, col, d) that are in the box of image a.

    The rectifying maps are undone by column expressions: p is the pixel under h1's inverse, q that of (col + d, row)
    under the inverse of h2 times the pointing's inverse.  p is kept if, rounded half away from zero, it is inside the
    inclusive box (x0, y0, x1, y1).
    """
    inv1 = np.linalg.inv(np.reshape(h1, (3, 3))).ravel()
    inv2 = np.linalg.inv(np.reshape(h2, (3, 3)) @ np.linalg.inv(np.reshape(pointing, (3, 3)))).ravel()
    from ..functions.planar import apply_homography, matrix

    x1, y1 = apply_homography(matrix(*inv1), F.col("col").cast("double"), F.col("row").cast("double"))
    x2, y2 = apply_homography(matrix(*inv2), F.col("col") + F.col("d"), F.col("row").cast("double"))
    at = pixels.where("d IS NOT NULL").withColumns({"x1": x1, "y1": y1, "x2": x2, "y2": y2})
    inside = F.round("x1").between(box[0], box[2]) & F.round("y1").between(box[1], box[3])
    return triangulate(at.where(inside), a, b, [*keep, "row", "col"])


def localize(points: DataFrame, a: Camera, keep: list[str], col: str = "col", row: str = "row", alt: str = "alt") -> DataFrame:
    """keep, lon, lat, alt of image points at heights: by the direct coefficients, else by iteration (null where it does
    not settle); by Arrow batch, no shuffle."""
    prepare(points.sparkSession)
    types = dict(points.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keep], "lon double", "lat double", "alt double"])

    def run(batches):
        for part in batches:
            z = part[alt].to_numpy(float)
            lon, lat = a.localize(part[col].to_numpy(float), part[row].to_numpy(float), z)
            yield part[keep].assign(lon=lon, lat=lat, alt=z)

    out = points.select(*dict.fromkeys([*keep, col, row, alt])).mapInPandas(run, schema)
    return out.select(*keep, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("lon", "lat", "alt")])


def height_map_points(pixels: DataFrame, a: Camera, x0: float, y0: float, keep: list[str]) -> DataFrame:
    """keep, row, col, lon, lat, alt of height map pixels (row, col, z) with the map's origin in the full image."""
    at = pixels.where("z IS NOT NULL").select(*keep, "row", "col", "z", (F.col("col") + x0).alias("_x"), (F.col("row") + y0).alias("_y"))
    return localize(at, a, [*keep, "row", "col"], "_x", "_y", "z")


def fit_camera(project, lon: tuple[float, float], lat: tuple[float, float], alt: tuple[float, float], n: int = 12) -> dict:
    """Coefficients of a camera whose columns and rows are project(lon, lat, alt), by least squares on a grid.

    The denominators are 1: good for affine and mildly curved cameras, as synthetic scenes need.
    """
    grid = np.meshgrid(*[np.linspace(*r, n) for r in (lon, lat, alt)], indexing="ij")
    values = dict(zip(("lon", "lat", "alt"), [g.ravel() for g in grid], strict=True))
    col, row = project(values["lon"], values["lat"], values["alt"])
    out = {}
    for k, v in (*values.items(), ("col", col), ("row", row)):
        out[f"{k}_offset"], out[f"{k}_scale"] = float((v.max() + v.min()) / 2), float((v.max() - v.min()) / 2) or 1.0
    norm = {k: (v - out[f"{k}_offset"]) / out[f"{k}_scale"] for k, v in (*values.items(), ("col", col), ("row", row))}
    terms = np.column_stack([norm["lon"] ** i * norm["lat"] ** j * norm["alt"] ** k for i, j, k in MONOMIALS])
    for k in ("col", "row"):
        out[f"{k}_num"] = np.linalg.lstsq(terms, norm[k], rcond=None)[0].tolist()
        out[f"{k}_den"] = [1.0] + [0.0] * 19
    back = np.column_stack([norm["col"] ** i * norm["row"] ** j * norm["alt"] ** k for i, j, k in MONOMIALS])
    for k in ("lon", "lat"):
        out[f"{k}_num"] = np.linalg.lstsq(back, norm[k], rcond=None)[0].tolist()
        out[f"{k}_den"] = [1.0] + [0.0] * 19
    return out


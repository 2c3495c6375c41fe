"""Matching of keypoints, and filters on matches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.planar import epipolar_distances


def squared_distance(a: Column, b: Column) -> Column:
    """In double, rounded to nine places, so that ties are ties."""
    return F.round(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0e0), lambda s, x: s + x), 9)


#: Keypoints of a side that meet in one task; larger keys are dealt out as pairs of parts.
PART = 4000


def nearest_two(a: np.ndarray, b: np.ndarray, xy: tuple, gate: float | None, f: tuple | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and rounded squared distances of the two nearest of b (sorted by id) for each of a; inf where there is none.

    A matrix product gives approximate distances; what lies within its error of the second nearest is then computed
    exactly, so that ties go by id.
    """
    near, far = np.zeros((len(a), 2), np.int64), np.full((len(a), 2), np.inf)
    for at in range(0, len(a), 256):
        part = a[at : at + 256]
        rough = np.maximum((part**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * part @ b.T, 0)
        if gate is not None and f is not None:
            (xa, ya), (xb, yb) = (xy[0][0][at : at + 256], xy[0][1][at : at + 256]), xy[1]
            r = np.abs(f[0] * xb[None] + f[1] * yb[None] + f[2] * xa[:, None] + f[3] * ya[:, None] + f[4])
            rough[np.maximum(r / np.hypot(f[0], f[1]), r / np.hypot(f[2], f[3])) > gate] = np.inf
        second = np.partition(rough, 1, axis=1)[:, 1] if rough.shape[1] > 1 else rough[:, 0]
        error = 1e-8 + 1e-12 * ((part**2).sum(1) + (b**2).sum(1).max())
        i, j = np.nonzero((rough <= (second + error)[:, None]) & np.isfinite(rough))
        exact = np.round(((part[i] - b[j]) ** 2).sum(1), 9)
        order = np.lexsort((j, exact, i))
        i, j, exact = i[order], j[order], exact[order]
        first = np.searchsorted(i, np.arange(len(part)))
        for k in (0, 1):
            ok = np.flatnonzero((first + k < len(i)) & (i[np.minimum(first + k, max(len(i) - 1, 0))] == np.arange(len(part)))) if len(i) else np.empty(0, int)
            near[at + ok, k], far[at + ok, k] = j[first[ok] + k], exact[first[ok] + k]
    return near, far


def match(first: DataFrame, second: DataFrame, keys: list[str], threshold: float = 0.6, relative: bool = True, gate: float | None = None, f: tuple | None = None) -> DataFrame:
    """keys, kp1, kp2, d1: nearest neighbours of descriptors within each key's two sides.

    first, second: keys, kp_id, desc and, for the epipolar gate (largest distance of a match to its lines, under the
    five entries f), x and y.  relative: the distance is under `threshold` times the second nearest's; a lone
    candidate has none and is not matched.  Else: the distance is under `threshold`.  Both sides of a key are cut into
    parts by a hash, of about PART keypoints; pairs of parts meet in a task, which gives the two nearest of each
    keypoint, and the nearest of these are the key's.
    """

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({k: [] for k in [*keys, "kp1", "d", "kp2"]})
        b = b.sort_values("kp_id", kind="stable")
        left, right = (np.stack(x["desc"].to_numpy()).astype(np.float64) for x in (a, b))
        xy = tuple((x["x"].to_numpy(), x["y"].to_numpy()) for x in (a, b)) if gate is not None else None
        near, d = nearest_two(left, right, xy, gate, f)
        i, k = np.nonzero(np.isfinite(d))
        return a[keys].iloc[i].assign(kp1=a["kp_id"].to_numpy()[i], d=d[i, k], kp2=b["kp_id"].to_numpy()[near[i, k]])

    types = dict(first.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "kp1 long", "d double", "kp2 long"])
    cols = [*keys, "kp_id", "desc", *(["x", "y"] if gate is not None else [])]
    # fresh attributes, as both sides may come from one table
    left, right = (df.select(*[F.col(k).alias(k) for k in cols]) for df in (first, second.select([F.col(k).alias(f"_{k}") for k in cols]).toDF(*cols)))
    parts = [df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(PART)).cast("int").alias(n)) for df, n in ((left, "_n1"), (right, "_n2"))]
    counts = parts[0].join(parts[1], keys) if keys else parts[0].crossJoin(F.broadcast(parts[1]))
    held = (lambda df: df.join(counts, keys)) if keys else (lambda df: df.crossJoin(F.broadcast(counts)))
    own = lambda n: F.pmod(F.xxhash64("kp_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = held(left).withColumn("_i", own("_n1")).withColumn("_j", every("_n2")).drop("_n1", "_n2")
    right = held(right).withColumn("_j", own("_n2")).withColumn("_i", every("_n1")).drop("_n1", "_n2")
    met = left.groupBy(*keys, "_i", "_j").cogroup(right.groupBy(*keys, "_i", "_j")).applyInPandas(run, schema)
    two = F.slice(F.array_sort(F.collect_list(F.struct("d", "kp2"))), 1, 2)
    best = met.groupBy(*keys, "kp1").agg(two.alias("two")).select(*keys, "kp1", F.col("two")[0]["kp2"].alias("kp2"), F.sqrt(F.col("two")[0]["d"]).alias("d1"), F.sqrt(F.get("two", F.lit(1))["d"]).alias("d2"))
    ok = (F.col("d1") < threshold * F.col("d2")) if relative else (F.col("d1") < threshold)
    return best.where(ok).select(*keys, "kp1", "kp2", "d1")


def epipolar_filter(matches: DataFrame, threshold: float, f: str = "f") -> DataFrame:
    """Matches whose larger distance to their epipolar lines is strictly under the threshold."""
    return matches.where(F.greatest(*epipolar_distances(F.col(f), *[F.col(c) for c in ("x1", "y1", "x2", "y2")])) < threshold)


def first_keypoints(keypoints: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """The first n keypoints of each key, in order of detection."""
    w = Window.partitionBy(*keys).orderBy("kp_id")
    return keypoints.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def with_neighbors(matches: DataFrame, tiles: DataFrame, pairs: DataFrame, keys: list[str] = ["roi_id"]) -> DataFrame:
    """A tile's matches and its neighbours', these inside the ellipse of semi-axes 3/4 of its width and height.

    matches: keys, ix, iy, x1, y1, x2, y2.  tiles: keys, ix, iy, x, y, w, h.  pairs: keys, ix, iy, nx, ny.
    """
    there = pairs.join(matches.withColumnRenamed("ix", "nx").withColumnRenamed("iy", "ny"), [*keys, "nx", "ny"]).join(tiles.select(*keys, "ix", "iy", "x", "y", "w", "h"), [*keys, "ix", "iy"])
    dx = (F.col("x1") - F.col("x") - F.col("w") / 2e0) / F.col("w")
    dy = (F.col("y1") - F.col("y") - F.col("h") / 2e0) / F.col("h")
    own = (F.col("nx") == F.col("ix")) & (F.col("ny") == F.col("iy"))
    return there.where(own | (F.hypot(dx, dy) < 0.75)).select(*keys, "ix", "iy", "x1", "y1", "x2", "y2")


def distinct(matches: DataFrame, keys: list[str] = []) -> DataFrame:
    return matches.dropDuplicates([*keys, "x1", "y1", "x2", "y2"])


def describe(desc: Column, x: Column, y: Column, scale: Column, ori: Column) -> Column:
    """A keypoint as one line of text."""
    head = F.format_string("%f %f %f %f", x, y, scale, ori)
    return F.concat(head, F.lit(" "), F.array_join(F.transform(desc, lambda d: F.format_string("%d", d.cast("int"))), " "))

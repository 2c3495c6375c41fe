"""Estimation from matches by sufficient statistics: means and centred moments, then tiny closed forms or solves."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import planar
from ..functions.rpc import bind
from .quantiles import upper_median

#: Order of the variables in the moments.
VARIABLES = ("x2", "y2", "x1", "y1")
PAIRS = [(a, b) for i, a in enumerate(VARIABLES) for b in VARIABLES[i:]]


class NotEnoughMatches(ValueError):
    """Fewer than four matches to rectify with."""


class DisparityRangeTooLarge(ValueError):
    """The disparity range exceeds its limit."""


def moments(matches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, mean_v for every variable, and m_a_b: sums of products of centred variables, by two passes.

    The means go back to the matches by a join on the key (raw moments would cancel at image coordinates).
    """
    means = matches.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"mean_{v}") for v in VARIABLES])
    centred = matches.join(means, keys) if keys else matches.crossJoin(F.broadcast(means))
    d = lambda v: F.col(v) - F.col(f"mean_{v}")
    held = ["n", *[f"mean_{v}" for v in VARIABLES]]
    return centred.groupBy(*keys).agg(*[F.first(c).alias(c) for c in held], *[F.sum(d(a) * d(b)).alias(f"m_{a}_{b}") for a, b in PAIRS])


def _scatter(stats: pd.DataFrame) -> np.ndarray:
    out = np.empty((len(stats), 4, 4))
    for a, b in PAIRS:
        i, j = VARIABLES.index(a), VARIABLES.index(b)
        out[:, i, j] = out[:, j, i] = stats[f"m_{a}_{b}"]
    return out


def affine_fundamental(matches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, f: the affine fundamental matrix (struct a..e) as the smallest eigenvector of the 4x4 scatter.

    Its sign: the first of the c, d entries that is not zero is positive.  Fewer than four matches: null.
    """

    def solve(batches):
        for stats in batches:
            _, vectors = np.linalg.eigh(_scatter(stats.fillna(0.0)))
            v = vectors[:, :, 0]
            lead = np.where(np.abs(v[:, 2]) > 1e-12, v[:, 2], v[:, 3])
            v = v * np.where(lead < 0, -1.0, 1.0)[:, None]
            e = -(v * stats[[f"mean_{x}" for x in VARIABLES]].to_numpy()).sum(1)
            few = (stats["n"] < 4).to_numpy()
            out = stats[[*keys, "n"]].copy()
            for name, col in zip("abcde", [*v.T, e], strict=True):
                out[name] = np.where(few, np.nan, col)
            yield out

    stats = moments(matches, keys)
    types = dict(matches.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "n long", *[f"{c} double" for c in "abcde"]])
    found = stats.mapInPandas(solve, schema)
    return found.select(*keys, "n", F.when(F.col("n") >= 4, F.struct(*"abcde")).alias("f"))


def affine_transformation(points: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a: the affine map (array of 9) of (x1, y1) to (x2, y2), by the two largest singular vectors; identity
    for fewer than three points."""

    def solve(batches):
        for stats in batches:
            order = [2, 3, 0, 1]  # (x1, y1, x2, y2)
            s = _scatter(stats.fillna(0.0))[:, order][:, :, order]
            _, vectors = np.linalg.eigh(s)
            out = []
            for v, row in zip(vectors, stats.itertuples(), strict=True):
                if row.n < 3 or abs(np.linalg.det(v[:2, 2:])) < 1e-300:
                    out.append(np.eye(3).ravel().tolist())
                    continue
                h = v[2:, 2:] @ np.linalg.inv(v[:2, 2:])
                t = np.array([row.mean_x2, row.mean_y2]) - h @ [row.mean_x1, row.mean_y1]
                out.append([h[0, 0], h[0, 1], t[0], h[1, 0], h[1, 1], t[1], 0.0, 0.0, 1.0])
            yield stats[keys].assign(a=out)

    types = dict(points.dtypes)
    return moments(points, keys).mapInPandas(solve, ", ".join([*[f"`{k}` {types[k]}" for k in keys], "a array<double>"]))


def mean_translation(points: DataFrame, keys: list[str]) -> DataFrame:
    """keys, tx, ty: mean displacement from (x1, y1) to (x2, y2)."""
    return points.groupBy(*keys).agg(F.avg(F.col("x2") - F.col("x1")).alias("tx"), F.avg(F.col("y2") - F.col("y1")).alias("ty"))


def match_center(matches: DataFrame, keys: list[str]) -> DataFrame:
    return matches.groupBy(*keys).agg(F.avg("x2").alias("cx"), F.avg("y2").alias("cy"))


def local_pointing(matches: DataFrame, keys: list[str], f: str = "f") -> DataFrame:
    """keys, a: the translation (array of 9) that undoes the upper median error vector in the second image.

    No matches, no row; no key's errors are gathered in one place.
    """
    ex, ey = planar.error_vector(F.col(f), *[F.col(c) for c in ("x1", "y1", "x2", "y2")], "sec")
    errors = matches.select(*keys, ex.alias("_ex"), ey.alias("_ey"))
    x, y = upper_median(errors, "_ex", keys, "ex"), upper_median(errors, "_ey", keys, "ey")
    found = x.join(y, keys) if keys else x.crossJoin(F.broadcast(y))
    return found.select(*keys, planar.translation(-F.col("ex"), -F.col("ey")).alias("a"))


def corrections(tiles: DataFrame, matches: DataFrame, keys: list[str], f: str = "f") -> DataFrame:
    """keys, a, cx, cy for every row of tiles: its correction and its matches' centre; all null without matches."""
    return tiles.select(*keys).join(local_pointing(matches, keys, f), keys, "left").join(match_center(matches, keys), keys, "left")


def global_pointing(local: DataFrame, keys: list[str] = ["pair"]) -> DataFrame:
    """keys, a: from the tiles' corrections (keys, a, cx, cy): none the identity, one that, two their mean translation,
    three or more the affine map from the centres to the corrected centres."""
    u, v = planar.apply_homography(F.col("a"), F.col("cx"), F.col("cy"))
    ok = local.where(F.col("a").isNotNull() & (F.size("a") == 9) & F.col("cx").isNotNull() & F.col("cy").isNotNull())
    moved = ok.select(*keys, F.col("a").alias("own"), F.col("cx").alias("x1"), F.col("cy").alias("y1"), u.alias("x2"), v.alias("y2"))
    few = moved.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("own").alias("own"), F.avg(F.col("x2") - F.col("x1")).alias("tx"), F.avg(F.col("y2") - F.col("y1")).alias("ty"))
    every = local.select(*keys).distinct().join(few, keys, "left").join(affine_transformation(moved, keys), keys, "left")
    a = F.when(F.col("n") >= 3, F.col("a")).when(F.col("n") == 2, planar.translation(F.col("tx"), F.col("ty"))).when(F.col("n") == 1, F.col("own")).otherwise(planar.translation(0, 0))
    return every.select(*keys, a.alias("a"))


def pointing_with_fallback(tiles: DataFrame, local: DataFrame, overall: DataFrame, keys: list[str], pair: list[str] = ["pair"]) -> DataFrame:
    """tiles with a: the tile's own correction, else its pair's."""
    own, all_ = local.select(*keys, F.col("a").alias("_own")), overall.select(*pair, F.col("a").alias("_all"))
    return tiles.join(own, keys, "left").join(F.broadcast(all_), pair, "left").select(*tiles.columns, F.coalesce("_own", "_all").alias("a"))


def rectified(matches: DataFrame, h1: Column, h2: Column) -> DataFrame:
    """matches with u1, v1, u2, v2 under the homographies."""
    u1, v1 = planar.apply_homography(h1, F.col("x1"), F.col("y1"))
    u2, v2 = planar.apply_homography(h2, F.col("x2"), F.col("y2"))
    return matches.withColumns({"u1": u1, "v1": v1, "u2": u2, "v2": v2})


def rectifying_homographies(f: Column, x: Column, y: Column, w: Column, h: Column) -> tuple[Column, Column]:
    """The similarities of f, moved so that the region's box in the first rectified image begins at the origin."""
    def origin(s: Column) -> Column:
        corners = [planar.apply_homography(s["one"], s["x"] + dx * s["w"], s["y"] + dy * s["h"]) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1))]
        return F.struct(s["one"].alias("one"), s["two"].alias("two"), planar.translation(-F.least(*[c[0] for c in corners]), -F.least(*[c[1] for c in corners])).alias("move"))

    one, two = planar.rectifying_similarities(f)
    at = bind(origin, one=one, two=two, x=x, y=y, w=w, h=h)
    out = bind(lambda s: F.array(*[planar.multiply(s["s"]["move"], s["s"][k]) for k in ("one", "two")]), s=at)
    return out[0], out[1]


def shear(matches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a, b, c: least squares of u1 on (u2, v2, 1), from rectified matches, by centred normal equations."""
    means = matches.groupBy(*keys).agg(*[F.avg(v).alias(f"m_{v}") for v in ("u1", "u2", "v2")])
    both = matches.join(means, keys) if keys else matches.crossJoin(F.broadcast(means))
    d = lambda v: F.col(v) - F.col(f"m_{v}")
    sums = both.groupBy(*keys).agg(
        *[F.first(f"m_{v}").alias(f"m_{v}") for v in ("u1", "u2", "v2")],
        F.sum(d("u2") * d("u2")).alias("uu"), F.sum(d("u2") * d("v2")).alias("uv"), F.sum(d("v2") * d("v2")).alias("vv"), F.sum(d("u1") * d("u2")).alias("tu"), F.sum(d("u1") * d("v2")).alias("tv"),
    )
    det = F.nullif(F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv"), F.lit(0e0))
    a, b = (F.col("tu") * F.col("vv") - F.col("tv") * F.col("uv")) / det, (F.col("tv") * F.col("uu") - F.col("tu") * F.col("uv")) / det
    return sums.select(*keys, a.alias("a"), b.alias("b"), (F.col("m_u1") - a * F.col("m_u2") - b * F.col("m_v2")).alias("c"))


def horizontal_translation(matches: DataFrame, keys: list[str], flag: str = "center") -> DataFrame:
    """keys, t: what the second rectified image moves left by: mean, least or largest disparity."""
    if flag not in ("center", "positive", "negative"):
        raise ValueError("flag is center, positive or negative")
    d = F.col("u2") - F.col("u1")
    return matches.groupBy(*keys).agg({"center": F.avg, "positive": F.min, "negative": F.max}[flag](d).alias("t"))


def match_disparities(matches: DataFrame, keys: list[str], margin: float = 0.2) -> DataFrame:
    """keys, disp_min, disp_max, n: floor and ceiling of the disparities, widened; the upper bound's widening uses the
    lower bound already widened."""
    d = F.col("u2") - F.col("u1")
    found = matches.groupBy(*keys).agg(F.floor(F.min(d)).cast("double").alias("lo"), F.ceil(F.max(d)).cast("double").alias("hi"), F.count(F.lit(1)).alias("n"))
    low = F.col("lo") - (F.col("hi") - F.col("lo")) * margin
    return found.select(*keys, low.alias("disp_min"), (F.col("hi") + (F.col("hi") - low) * margin).alias("disp_max"), "n")


def disparity_range(method: str, matched: tuple[Column, Column, Column], exogenous: tuple[Column, Column], fixed: tuple[float, float] | None = None, altitude: tuple[Column, Column] | None = None) -> tuple[Column, Column]:
    """The range by a method (fixed_pixel_range, fixed_altitude_range, exogenous, sift, wider_sift_exogenous).

    matched: least, largest, number of matches (fewer than two count as none).  Without any: -3..3; always as wide as that.
    """
    lo, hi, n = matched
    ok = n >= 2
    s, x = (F.when(ok, lo), F.when(ok, hi)), exogenous
    if method == "fixed_pixel_range":
        out = (F.lit(float(fixed[0])), F.lit(float(fixed[1])))
    elif method == "fixed_altitude_range":
        out = altitude
    elif method == "exogenous":
        out = x
    elif method == "sift":
        out = s
    elif method == "wider_sift_exogenous":
        out = (F.least(s[0], x[0]), F.greatest(s[1], x[1]))
    else:
        raise ValueError(f"unknown disparity range method {method!r}")
    return F.least(F.coalesce(out[0], F.lit(-3e0)), F.lit(-3e0)), F.greatest(F.coalesce(out[1], F.lit(3e0)), F.lit(3e0))


def limited_range(lo: Column, hi: Column, width: Column, limit: float | None = None) -> tuple[Column, Column]:
    """The range clamped to the image's width about its centre, floor and ceiling; raises beyond the limit."""
    centre, half = (lo + hi) / 2e0, width / 2e0
    over = (hi - lo) > width
    a = F.floor(F.when(over, centre - half).otherwise(lo)).cast("double")
    b = F.ceil(F.when(over, centre + half).otherwise(hi)).cast("double")
    if limit is not None:
        bad = (b - a) > limit
        a = F.when(bad, F.raise_error(F.lit("disparity range too large")).cast("double")).otherwise(a)
    return a, b

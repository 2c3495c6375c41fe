"""Rational-polynomial cameras as column expressions.  Arguments should be columns, or be bound (see bind).

A camera is a struct of arrays of 20 (col_num col_den row_num row_den, and where known lon_num lon_den lat_num lat_den)
and of offsets and scales (col row lon lat alt).  The cubic's monomials take the first normalised argument as l, the
second as c and the height as a.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed order of the monomials: powers of (l, c, a).
MONOMIALS = ((0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (1, 1, 0), (1, 0, 1), (0, 1, 1), (2, 0, 0), (0, 2, 0), (0, 0, 2), (1, 1, 1), (3, 0, 0), (1, 2, 0), (1, 0, 2), (2, 1, 0), (0, 3, 0), (0, 1, 2), (2, 0, 1), (0, 2, 1), (0, 0, 3))


def polynomial(coef: Column, x: Column, y: Column, z: Column) -> Column:
    """The 20-term cubic, unrolled so that it stays in generated code."""
    out = coef[0]
    for i, powers in enumerate(MONOMIALS[1:], 1):
        term = coef[i]
        for v, p in zip((x, y, z), powers, strict=True):
            for _ in range(p):
                term = term * v
        out = out + term
    return out


def gradient(coef: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Partial derivatives of the cubic."""
    out = []
    for axis in range(3):
        total = F.lit(0e0)
        for i, powers in enumerate(MONOMIALS):
            if powers[axis]:
                term = coef[i] * float(powers[axis])
                for k, (v, p) in enumerate(zip((x, y, z), powers, strict=True)):
                    for _ in range(p - (k == axis)):
                        term = term * v
                total = total + term
        out.append(total)
    return tuple(out)


def bind(body, **values: Column) -> Column:
    """body(s) with a struct s of the values, each evaluated once: a cubic names its arguments some sixty times, so an
    expression put in their place would be copied as often."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body)[0]


def project(rpc: Column, lon: Column, lat: Column, alt: Column) -> tuple[Column, Column]:
    """(col, row) of a ground point."""
    x, y, z = (lon - rpc["lon_offset"]) / rpc["lon_scale"], (lat - rpc["lat_offset"]) / rpc["lat_scale"], (alt - rpc["alt_offset"]) / rpc["alt_scale"]
    ratio = lambda k: F.try_divide(polynomial(rpc[f"{k}_num"], x, y, z), polynomial(rpc[f"{k}_den"], x, y, z))
    return ratio("col") * rpc["col_scale"] + rpc["col_offset"], ratio("row") * rpc["row_scale"] + rpc["row_offset"]


def localize(rpc: Column, col: Column, row: Column, alt: Column) -> tuple[Column, Column]:
    """(lon, lat) of an image point at a height, by the direct coefficients; null without them (see kernels.localize)."""
    x, y, z = (col - rpc["col_offset"]) / rpc["col_scale"], (row - rpc["row_offset"]) / rpc["row_scale"], (alt - rpc["alt_offset"]) / rpc["alt_scale"]
    ratio = lambda k: F.try_divide(polynomial(rpc[f"{k}_num"], x, y, z), polynomial(rpc[f"{k}_den"], x, y, z))
    return ratio("lon") * rpc["lon_scale"] + rpc["lon_offset"], ratio("lat") * rpc["lat_scale"] + rpc["lat_offset"]


def transfer(a: Column, b: Column, x: Column, y: Column, alt: Column) -> tuple[Column, Column]:
    """Where a point of image a at a height is in image b."""
    lon, lat = localize(a, x, y, alt)

    def there(s: Column) -> Column:
        u, v = project(b, s["lon"], s["lat"], s["alt"])
        return F.struct(u.alias("u"), v.alias("v"))

    out = bind(there, lon=lon, lat=lat, alt=alt)
    return out["u"], out["v"]


def coarse_altitudes(rpc: Column, factor: float = 1.0) -> tuple[Column, Column]:
    return rpc["alt_offset"] - factor * rpc["alt_scale"], rpc["alt_offset"] + factor * rpc["alt_scale"]


def in_basis(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> tuple[Column, Column]:
    """Coordinates of p in the basis (a, b); null where they are collinear."""
    d = F.nullif(ax * by - ay * bx, F.lit(0e0))
    return (px * by - py * bx) / d, (ax * py - ay * px) / d


def altitude_to_disparity(a: Column, b: Column, x: Column, y: Column, alt: Column, h1: Column, h2: Column, pointing: Column) -> Column:
    """x2 - x1 in rectified space of image point (x, y) at a height: transfer, undo the pointing, apply both."""
    from .planar import apply_homography, invert

    def undone(s: Column) -> Column:
        u, v = apply_homography(s["back"], s["u"], s["v"])
        return bind(lambda t: apply_homography(h2, t["u"], t["v"])[0], u=u, v=v)

    u, v = transfer(a, b, x, y, alt)
    return bind(undone, u=u, v=v, back=invert(pointing)) - apply_homography(h1, x, y)[0]


def zoomed(rpc: Column, factor: float) -> Column:
    """The camera of the image scaled by factor."""
    out = rpc
    for k in ("col_offset", "row_offset", "col_scale", "row_scale"):
        out = out.withField(k, rpc[k] * factor)
    return out


def altitudes_of_curve(low: Column, high: Column, n: int = 21) -> Column:
    """Array of n heights from low to high with quadratic spacing, to draw an epipolar curve."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: low + (high - low) * F.pow(i.cast("double") / (n - 1), F.lit(2)))

"""Planar geometry as column expressions.  A 3x3 transform is an array<double> of 9, row by row."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX = sys.float_info.max


def m(h: Column, i: int, j: int) -> Column:
    return h[3 * i + j]


def matrix(*rows) -> Column:
    """array<double> of nine numbers or columns."""
    return F.array(*[(x if isinstance(x, Column) else F.lit(float(x))).cast("double") for x in rows])


def translation(tx, ty) -> Column:
    return matrix(1, 0, tx, 0, 1, ty, 0, 0, 1)


def multiply(a: Column, b: Column) -> Column:
    return F.array(*[m(a, i, 0) * m(b, 0, j) + m(a, i, 1) * m(b, 1, j) + m(a, i, 2) * m(b, 2, j) for i in range(3) for j in range(3)])


def determinant(h: Column) -> Column:
    return (
        m(h, 0, 0) * (m(h, 1, 1) * m(h, 2, 2) - m(h, 1, 2) * m(h, 2, 1))
        - m(h, 0, 1) * (m(h, 1, 0) * m(h, 2, 2) - m(h, 1, 2) * m(h, 2, 0))
        + m(h, 0, 2) * (m(h, 1, 0) * m(h, 2, 1) - m(h, 1, 1) * m(h, 2, 0))
    )


def invert(h: Column) -> Column:
    """Adjugate over determinant; null where it is singular."""
    d = F.nullif(determinant(h), F.lit(0e0))

    def cofactor(i: int, j: int) -> Column:
        r, c = [k for k in range(3) if k != i], [k for k in range(3) if k != j]
        minor = m(h, r[0], c[0]) * m(h, r[1], c[1]) - m(h, r[0], c[1]) * m(h, r[1], c[0])
        return minor if (i + j) % 2 == 0 else -minor

    return F.when(d.isNotNull(), F.array(*[cofactor(j, i) / d for i in range(3) for j in range(3)]))


def apply_homography(h: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Image of the point, by homogeneous division; null at infinity."""
    w = F.nullif(m(h, 2, 0) * x + m(h, 2, 1) * y + m(h, 2, 2), F.lit(0e0))
    return (m(h, 0, 0) * x + m(h, 0, 1) * y + m(h, 0, 2)) / w, (m(h, 1, 0) * x + m(h, 1, 1) * y + m(h, 1, 2)) / w


def angle(cos: Column, sin: Column) -> Column:
    """Angle in (-pi, pi]."""
    a = F.atan2(sin, cos)
    return F.when(a <= -3.141592653589793, F.lit(3.141592653589793)).otherwise(a)


def point_line_distance(x: Column, y: Column, w: Column, a: Column, b: Column, c: Column) -> Column:
    """Distance of a homogeneous point to a line; the largest double for an ideal point and the line at infinity."""
    n = F.hypot(a, b)
    return F.when((w == 0) | (n == 0), F.lit(MAX)).otherwise(F.abs(a * x + b * y + c * w) / F.nullif(F.abs(w) * n, F.lit(0e0)))


#: An affine fundamental matrix has five entries that are not zero: F02, F12, F20, F21, F22 as a, b, c, d, e.
def epipolar_residual(f: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return f["a"] * x2 + f["b"] * y2 + f["c"] * x1 + f["d"] * y1 + f["e"]


def epipolar_distances(f: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> tuple[Column, Column]:
    """Distance in the first and in the second image of a match to its epipolar line."""
    r = F.abs(epipolar_residual(f, x1, y1, x2, y2))
    return r / F.hypot(f["c"], f["d"]), r / F.hypot(f["a"], f["b"])


def error_vector(f: Column, x1: Column, y1: Column, x2: Column, y2: Column, side: str = "sec") -> tuple[Column, Column]:
    """From the projection on the epipolar line to the point, in the second ("sec") or first ("ref") image."""
    if side not in ("ref", "sec"):
        raise ValueError("side is ref or sec")
    u, v = (f["a"], f["b"]) if side == "sec" else (f["c"], f["d"])
    t = epipolar_residual(f, x1, y1, x2, y2) / (u * u + v * v)
    return t * u, t * v


def levelling(a, b, c, d, e, hypot, sqrt) -> tuple[list, list]:
    """The entries of the two similarities that level epipolar lines, for numbers or columns alike.

    A line of the first image has the normal (c, d), its partner in the second (a, b).  Turning either normal onto the
    vertical axis levels the lines; their scales share the ratio of the normals' lengths, so that the images keep their
    mean scale, and the constant e is halved between them, which brings partners to one height.
    """
    first, second = hypot(c, d), hypot(a, b)
    scale, lift = sqrt(first / second), e / (2 * sqrt(first * second))

    def turned(nx, ny, size, up) -> list:
        return [size * ny, -(size * nx), 0, size * nx, size * ny, up, 0, 0, 1]

    return turned(c / first, d / first, scale, lift), turned(-a / second, -b / second, 1 / scale, -lift)


def rectifying_similarities(f: Column) -> tuple[Column, Column]:
    """The two similarities that make epipolar lines horizontal and at equal height."""
    one, two = levelling(*[f[k] for k in "abcde"], F.hypot, F.sqrt)
    return matrix(*one), matrix(*two)


def fundamental_of_cameras(p1: list[list[float]], p2: list[list[float]]) -> list[list[float]]:
    """F of two 3x4 cameras: entry (j, i) is the signed 4x4 determinant of p1 without row i over p2 without row j."""
    import numpy as np

    one, two = np.asarray(p1, float), np.asarray(p2, float)
    out = np.empty((3, 3))
    for i in range(3):
        for j in range(3):
            rows = np.vstack([np.roll(one, -i, axis=0)[1:], np.roll(two, -j, axis=0)[1:]])
            out[j, i] = np.linalg.det(rows)
    return out.tolist()

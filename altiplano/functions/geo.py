"""Geodesy as column expressions: WGS 84 longitude and latitude in degrees, UTM, and geocentric coordinates."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rpc import bind

#: Fixed values of WGS 84 and of UTM.
SEMI_MAJOR, FLATTENING, SCALE, FALSE_EAST, FALSE_NORTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0


@dataclass(frozen=True)
class Crs:
    """kind: geographic, geocentric or utm.  vertical: an EPSG code of heights above a geoid, or None."""

    kind: str
    epsg: int
    zone: int = 0
    north: bool = True
    vertical: int | None = None


def crs(name: int | str) -> Crs:
    """EPSG 4326, 4979, 4978, 326zz, 327zz, as number or text (epsg:4326, EPSG:32740+5773); others raise."""
    found = re.fullmatch(r"(?:epsg:)?(\d+)(?:\+(\d+))?", str(name).strip(), re.I)
    if not found:
        raise ValueError(f"unsupported CRS {name!r}")
    code, vertical = int(found[1]), int(found[2]) if found[2] else None
    if code in (4326, 4979):
        return Crs("geographic", code, vertical=vertical)
    if code == 4978:
        return Crs("geocentric", code, vertical=vertical)
    if code // 100 in (326, 327) and 1 <= code % 100 <= 60:
        return Crs("utm", code, code % 100, code // 100 == 326, vertical)
    raise ValueError(f"unsupported CRS {name!r}")


def utm_zone(lon: Column) -> Column:
    """Zone number; no exceptions for Norway and Svalbard, and longitude 180 is in zone 61."""
    return (F.floor((lon + 180e0) / 6e0) + 1).cast("int")


def utm_zone_name(lon: Column, lat: Column) -> Column:
    return F.concat(utm_zone(lon).cast("string"), F.when(lat >= 0, "N").otherwise("S"))


def epsg_of_zone(zone_name: Column) -> Column:
    """EPSG code of a zone name such as 40S; raises for another hemisphere letter."""
    number, side = F.regexp_extract(zone_name, r"^(\d+)", 1).cast("int"), F.upper(F.substring(zone_name, -1, 1))
    return F.when(side == "N", number + 32600).when(side == "S", number + 32700).otherwise(F.raise_error(F.concat(F.lit("unknown hemisphere in zone "), zone_name)).cast("int"))


def central_meridian(zone: Column) -> Column:
    return zone * 6e0 - 183e0


def _third() -> float:
    return FLATTENING / (2 - FLATTENING)


def _series() -> tuple[float, list[float], list[float], list[float]]:
    """Rectifying radius, and the forward, inverse and latitude coefficients of the Krueger series to the third order."""
    n = _third()
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    return radius, alpha, beta, delta


def _atanh(x: Column) -> Column:
    return F.log((1 + x) / (1 - x)) / 2


def lonlat_to_utm(lon: Column, lat: Column, zone: Column, north: Column) -> tuple[Column, Column]:
    """Easting and northing in a zone."""
    radius, alpha, _, _ = _series()
    k = 2 * _third() ** 0.5 / (1 + _third())
    phi, lam = F.radians(lat), F.radians(lon - central_meridian(zone))
    s = F.sin(phi)
    t = F.sinh(_atanh(s) - k * _atanh(k * s))
    xi, eta = F.atan2(t, F.cos(lam)), _atanh(F.sin(lam) / F.sqrt(1 + t * t))
    e, nn = eta, xi
    for j, a in enumerate(alpha, 1):
        e = e + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        nn = nn + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_EAST + SCALE * radius * e, F.when(north, F.lit(0e0)).otherwise(F.lit(FALSE_NORTH)) + SCALE * radius * nn


def utm_to_lonlat(east: Column, north_m: Column, zone: Column, north: Column) -> tuple[Column, Column]:
    radius, _, beta, delta = _series()
    xi0 = (north_m - F.when(north, F.lit(0e0)).otherwise(F.lit(FALSE_NORTH))) / (SCALE * radius)
    eta0 = (east - FALSE_EAST) / (SCALE * radius)
    xi, eta = xi0, eta0
    for j, b in enumerate(beta, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, d in enumerate(delta, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return central_meridian(zone) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(phi)


def lonlat_to_geocentric(lon: Column, lat: Column, alt: Column) -> tuple[Column, Column, Column]:
    e2 = FLATTENING * (2 - FLATTENING)
    lam, phi = F.radians(lon), F.radians(lat)
    n = SEMI_MAJOR / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))
    return (n + alt) * F.cos(phi) * F.cos(lam), (n + alt) * F.cos(phi) * F.sin(lam), (n * (1 - e2) + alt) * F.sin(phi)


def geocentric_to_lonlat(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Longitude, latitude, height by Bowring's formula (below a micrometre near the ground)."""
    e2, b = FLATTENING * (2 - FLATTENING), SEMI_MAJOR * (1 - FLATTENING)
    p = F.hypot(x, y)
    theta = F.atan2(z * SEMI_MAJOR, p * b)
    phi = F.atan2(z + e2 / (1 - e2) * b * F.pow(F.sin(theta), F.lit(3)), p - e2 * SEMI_MAJOR * F.pow(F.cos(theta), F.lit(3)))
    n = SEMI_MAJOR / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))
    return F.degrees(F.atan2(y, x)), F.degrees(phi), p * F.cos(phi) + z * F.sin(phi) - n * (1 - e2 * F.sin(phi) * F.sin(phi))


def transform(x: Column, y: Column, z: Column, source: int | str, target: int | str) -> tuple[Column, Column, Column]:
    """(x, y, z) between two supported CRSs, x first always; a change of the vertical datum raises (no geoid grid here)."""
    a, b = crs(source), crs(target)
    if a.vertical != b.vertical:
        raise ValueError("heights above a geoid need a user-supplied grid: see operators.altitude.geoid_to_ellipsoid")
    def back(s: Column) -> Column:
        if a.kind == "utm":
            out = (*utm_to_lonlat(s["x"], s["y"], F.lit(a.zone), F.lit(a.north)), s["z"])
        elif a.kind == "geocentric":
            out = geocentric_to_lonlat(s["x"], s["y"], s["z"])
        else:
            out = s["x"], s["y"], s["z"]
        return F.struct(*[v.cast("double").alias(k) for k, v in zip(("lon", "lat", "alt"), out, strict=True)])

    def forth(lon: Column, lat: Column, alt: Column) -> tuple[Column, Column, Column]:
        if b.kind == "utm":
            return (*lonlat_to_utm(lon, lat, F.lit(b.zone), F.lit(b.north)), alt)
        return lonlat_to_geocentric(lon, lat, alt) if b.kind == "geocentric" else (lon, lat, alt)

    if a.kind == "geographic":  # one step, which stays in generated code
        return forth(x, y, z)
    # two steps: what lies between them, and what came in, is evaluated once
    degrees = bind(back, x=x, y=y, z=z)
    out = bind(lambda s: F.array(*forth(s["at"]["lon"], s["at"]["lat"], s["at"]["alt"])), at=degrees)
    return out[0], out[1], out[2]


def align(low: Column, high: Column, step: float) -> tuple[Column, Column]:
    """Bounds moved outward to multiples of step."""
    return F.floor(low / step) * step, F.ceil(high / step) * step

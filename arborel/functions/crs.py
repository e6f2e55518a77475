"""Map projections as Column expressions: transverse Mercator after Krüger's series (UTM, British grid), and web Mercator."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TransverseMercator:
    a: float
    inverse_flattening: float
    lon0: float
    lat0: float
    scale: float
    east: float
    north: float


def utm(zone: int, south: bool = False) -> TransverseMercator:
    return TransverseMercator(6378137.0, 298.257223563, zone * 6.0 - 183.0, 0.0, 0.9996, 500000.0, 10000000.0 if south else 0.0)


# The British National Grid on the Airy 1830 ellipsoid, and the seven parameters from WGS84 to OSGB36.
BRITISH = TransverseMercator(6377563.396, 299.3249646, -2.0, 49.0, 0.9996012717, 400000.0, -100000.0)
HELMERT = (-446.448, 125.157, -542.060, 20.4894e-6, -0.1502, -0.2470, -0.8421)


def projection(epsg: str | int) -> TransverseMercator | str:
    """What an EPSG code stands for: UTM (326zz, 327zz), 27700, ``mercator`` (3857) or ``degrees`` (4326)."""
    m = re.fullmatch(r"(?:epsg:)?(\d+)", str(epsg).strip().lower())
    code = int(m[1]) if m else -1
    if code == 4326:
        return "degrees"
    if code == 3857:
        return "mercator"
    if code == 27700:
        return BRITISH
    if code // 100 in (326, 327) and 1 <= code % 100 <= 60:
        return utm(code % 100, code // 100 == 327)
    raise ValueError(f"Invalid CRS '{epsg}': known are EPSG:4326, 3857, 27700, 32601-32660 and 32701-32760")


def _series(p: TransverseMercator) -> tuple[float, list[float], list[float], float, float]:
    """Rectifying radius, forward and backward coefficients, eccentricity, third flattening; to the fourth order."""
    f = 1 / p.inverse_flattening
    n = f / (2 - f)
    radius = p.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    backward = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    return radius, forward, backward, math.sqrt(f * (2 - f)), n


def _origin_north(p: TransverseMercator) -> float:
    radius, forward, _, e, _ = _series(p)
    phi = math.radians(p.lat0)
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi = math.atan(t)
    return p.scale * radius * (xi + sum(c * math.sin(2 * (k + 1) * xi) for k, c in enumerate(forward)))


def forward(lon: Column, lat: Column, p: TransverseMercator) -> tuple[Column, Column]:
    """Easting and northing in metres of degrees on the projection's own ellipsoid."""
    radius, coefficients, _, e, _ = _series(p)

    def sphere(q: Column) -> Column:
        return F.struct(q["lam"].alias("lam"), F.sinh(F.atanh(q["s"]) - e * F.atanh(e * q["s"])).alias("t"))

    def plane(q: Column) -> Column:
        return F.struct(F.atan2(q["t"], F.cos(q["lam"])).alias("xi"), F.atanh(F.sin(q["lam"]) / F.sqrt(1 + q["t"] * q["t"])).alias("eta"))

    def series(q: Column) -> Column:
        north, east = q["xi"], q["eta"]
        for k, c in enumerate(coefficients):
            m = 2 * (k + 1)
            north = north + c * F.sin(m * q["xi"]) * F.cosh(m * q["eta"])
            east = east + c * F.cos(m * q["xi"]) * F.sinh(m * q["eta"])
        return F.struct((p.east + p.scale * radius * east).alias("x"), (p.north - _origin_north(p) + p.scale * radius * north).alias("y"))

    at = _let(_let(_let(F.struct(F.radians(lon - p.lon0).alias("lam"), F.sin(F.radians(lat)).alias("s")), sphere), plane), series)
    return at["x"], at["y"]


def inverse(east: Column, north: Column, p: TransverseMercator) -> tuple[Column, Column]:
    """Longitude and latitude in degrees on the projection's own ellipsoid."""
    radius, _, coefficients, e, _ = _series(p)

    def plane(q: Column) -> Column:
        xi, eta = q["xi"], q["eta"]
        for k, c in enumerate(coefficients):
            m = 2 * (k + 1)
            xi = xi - c * F.sin(m * q["xi"]) * F.cosh(m * q["eta"])
            eta = eta - c * F.cos(m * q["xi"]) * F.sinh(m * q["eta"])
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def sphere(q: Column) -> Column:
        chi = F.sin(q["xi"]) / F.cosh(q["eta"])
        return F.struct(F.atan2(F.sinh(q["eta"]), F.cos(q["xi"])).alias("lam"), F.atanh(chi).alias("psi"), chi.alias("s"))

    # conformal to geographic latitude, by fixed-point steps that gain over two digits each
    def step(q: Column) -> Column:
        return F.struct(q["lam"].alias("lam"), q["psi"].alias("psi"), F.tanh(q["psi"] + e * F.atanh(e * q["s"])).alias("s"))

    scale = p.scale * radius
    at = _let(_let(F.struct(((north - p.north + _origin_north(p)) / scale).alias("xi"), ((east - p.east) / scale).alias("eta")), plane), sphere)
    for _ in range(6):
        at = _let(at, step)
    there = _let(at, lambda q: F.struct((p.lon0 + F.degrees(q["lam"])).alias("lon"), F.degrees(F.asin(q["s"])).alias("lat")))
    return there["lon"], there["lat"]


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    a = 6378137.0
    return F.radians(lon) * a, a * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))


def web_mercator_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    a = 6378137.0
    return F.degrees(x / a), F.degrees(2 * F.atan(F.exp(y / a)) - math.pi / 2)


def project(lon: Column, lat: Column, epsg: str | int) -> tuple[Column, Column]:
    """WGS84 degrees to the coordinates of an EPSG code; the British grid to a few metres, by seven parameters."""
    p = projection(epsg)
    if p == "degrees":
        return lon, lat
    if p == "mercator":
        return web_mercator(lon, lat)
    if p is BRITISH:
        lon, lat = _to_osgb36(lon, lat)
    return forward(lon, lat, p)


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once."""
    return F.transform(F.array(value), fn)[0]


def _to_osgb36(lon: Column, lat: Column) -> tuple[Column, Column]:
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    tx, ty, tz, s, *turns = HELMERT
    rx, ry, rz = (math.radians(r / 3600) for r in turns)
    g = 1 / BRITISH.inverse_flattening
    g2 = g * (2 - g)

    def space(p: Column) -> Column:
        nu = a / F.sqrt(1 - e2 * F.pow(F.sin(p["phi"]), 2))
        return F.struct((nu * F.cos(p["phi"]) * F.cos(p["lam"])).alias("x"), (nu * F.cos(p["phi"]) * F.sin(p["lam"])).alias("y"), (nu * (1 - e2) * F.sin(p["phi"])).alias("z"))

    def moved(p: Column) -> Column:
        x, y, z = p["x"], p["y"], p["z"]
        return F.struct((tx + (1 + s) * x - rz * y + ry * z).alias("x"), (ty + rz * x + (1 + s) * y - rx * z).alias("y"), (tz - ry * x + rx * y + (1 + s) * z).alias("z"))

    def start(p: Column) -> Column:
        r = F.sqrt(p["x"] * p["x"] + p["y"] * p["y"])
        return F.struct(p["z"].alias("z"), r.alias("r"), F.atan2(p["y"], p["x"]).alias("lam"), F.atan2(p["z"], r * (1 - g2)).alias("phi"))

    def step(p: Column) -> Column:
        nu = BRITISH.a / F.sqrt(1 - g2 * F.pow(F.sin(p["phi"]), 2))
        return F.struct(p["z"].alias("z"), p["r"].alias("r"), p["lam"].alias("lam"), F.atan2(p["z"] + g2 * nu * F.sin(p["phi"]), p["r"]).alias("phi"))

    at = _let(_let(_let(F.struct(F.radians(lon).alias("lam"), F.radians(lat).alias("phi")), space), moved), start)
    for _ in range(4):
        at = _let(at, step)
    there = _let(at, lambda p: F.struct(F.degrees(p["lam"]).alias("lon"), F.degrees(p["phi"]).alias("lat")))
    return there["lon"], there["lat"]


def unproject(x: Column, y: Column, epsg: str | int) -> tuple[Column, Column]:
    """Coordinates of an EPSG code to WGS84 degrees."""
    p = projection(epsg)
    if p == "degrees":
        return x, y
    if p == "mercator":
        return web_mercator_inverse(x, y)
    lon, lat = inverse(x, y, p)
    if p is not BRITISH:
        return lon, lat

    # the datum shift changes slowly: taking it at the shifted place once more leaves centimetres
    def back(q: Column) -> Column:
        shifted = _to_osgb36(q["near_lon"], q["near_lat"])
        return F.struct(q["lon"].alias("lon"), q["lat"].alias("lat"), (q["near_lon"] + q["lon"] - shifted[0]).alias("near_lon"), (q["near_lat"] + q["lat"] - shifted[1]).alias("near_lat"))

    at = _let(_let(F.struct(lon.alias("lon"), lat.alias("lat")), lambda q: F.struct(q["lon"].alias("lon"), q["lat"].alias("lat"), q["lon"].alias("near_lon"), q["lat"].alias("near_lat"))), back)
    at = _let(at, back)
    return at["near_lon"], at["near_lat"]

"""rHEALPix cells on the WGS84 ellipsoid with three by three subcells, after the published projection.

Latitudes become authalic, the sphere is projected to six squares (N, O, P, Q, R, S; both polar
squares above and below O), and every square is parted into nine, numbered by rows from its
upper left. All of it is Column expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84, and the squares' names from north over the four of the equator to south.
FLATTENING = 1 / 298.257223563
FACES = "NOPQRS"
SIDES = 3

_E = math.sqrt(FLATTENING * (2 - FLATTENING))


def _q(s: Column) -> Column:
    return (1 - _E**2) * (s / (1 - _E**2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_QP = (1 - _E**2) * (1 / (1 - _E**2) - math.log((1 - _E) / (1 + _E)) / (2 * _E))


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once; expressions that repeat it would grow with every step."""
    return F.transform(F.array(value), fn)[0]


def place(lon: Column, lat: Column) -> Column:
    """struct(f, u, v): number of the square, and place in it from its upper left corner, each from 0 to 1."""
    lam = F.radians(lon - 360.0 * F.floor((lon + 180.0) / 360.0))
    sine = _let(F.sin(F.radians(lat)), lambda s: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _q(s) / _QP)))

    def spread(p: Column) -> Column:
        quarter = F.least(F.lit(3), F.floor((p["lam"] + math.pi) / (math.pi / 2)).cast("int"))
        return F.struct(p["lam"].alias("lam"), p["s"].alias("s"), quarter.alias("q"), F.sqrt(F.greatest(F.lit(0.0), 3 * (1 - F.abs(p["s"])))).alias("sigma"))

    def turned(p: Column) -> Column:
        # caps: a triangle's place from its tip, turned by its quarter around the square's middle
        dx = (p["lam"] - (-3 * math.pi / 4 + p["q"] * (math.pi / 2))) * p["sigma"]
        dy = -F.signum(p["s"]) * math.pi / 4 * p["sigma"]
        turn = F.when(p["s"] > 0, p["q"]).otherwise((4 - p["q"]) % 4)
        return F.struct(*(p[k].alias(k) for k in ("lam", "s", "q")), dx.alias("dx"), dy.alias("dy"), turn.alias("turn"))

    def found(p: Column) -> Column:
        equal = F.abs(p["s"]) <= 2 / 3
        turn, dx, dy = p["turn"], p["dx"], p["dy"]
        x = F.when(turn == 0, dx).when(turn == 1, -dy).when(turn == 2, -dx).otherwise(dy)
        y = F.when(turn == 0, dy).when(turn == 1, dx).when(turn == 2, -dy).otherwise(-dx)
        # equator: squares of a quarter turn; v from the top
        u = F.when(equal, (p["lam"] + math.pi) / (math.pi / 2) - p["q"]).otherwise(x / (math.pi / 2) + 0.5)
        v = F.when(equal, (F.lit(math.pi / 4) - p["s"] * (3 * math.pi / 8)) / (math.pi / 2)).otherwise(0.5 - y / (math.pi / 2))
        return F.struct(F.when(equal, p["q"] + 1).when(p["s"] > 0, 0).otherwise(5).alias("f"), u.alias("u"), v.alias("v"))

    return _let(_let(_let(F.struct(lam.alias("lam"), sine.alias("s")), spread), turned), found)


def index(lon: Column, lat: Column, resolution: int) -> Column:
    """struct(f, i, j): square, column and row of the cell that holds a point."""
    n = SIDES**resolution
    whole = lambda w: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor(w * n))).cast("long")
    return _let(place(lon, lat), lambda p: F.struct(p["f"].alias("f"), whole(p["u"]).alias("i"), whole(p["v"]).alias("j")))


def name(at: Column, resolution: int) -> Column:
    """A cell's name by its index."""

    def spelt(q: Column) -> Column:
        out = [F.substring(F.lit(FACES), (q["f"] + 1).cast("int"), F.lit(1))]
        for k in range(resolution):
            step = SIDES ** (resolution - 1 - k)
            digit = F.floor(q["j"] / F.lit(step)) % SIDES * SIDES + F.floor(q["i"] / F.lit(step)) % SIDES
            out.append(digit.cast("string"))
        return F.concat(*out)

    return _let(at, spelt)


def cell(lon: Column, lat: Column, resolution: int) -> Column:
    return name(index(lon, lat, resolution), resolution)


def _corner(face: Column, u: Column, v: Column) -> Column:
    """struct(x, y): longitude and latitude of a place in a square."""

    def spread(p: Column) -> Column:
        x, y, f = p["x"], p["y"], p["f"]
        # which triangle of a polar square: by the side of both diagonals
        north = F.when((y <= x) & (y <= -x), 0).when((x >= y) & (x >= -y), 1).when(y >= F.abs(x), 2).otherwise(3)
        south = F.when((y >= x) & (y >= -x), 0).when((x >= y) & (x >= -y), 1).when(y <= -F.abs(x), 2).otherwise(3)
        return F.struct(f.alias("f"), x.alias("x"), y.alias("y"), p["u"].alias("u"), F.when(f == 0, north).otherwise(south).alias("turn"))

    def back(p: Column) -> Column:
        turn = F.when(p["f"] == 0, p["turn"]).otherwise((4 - p["turn"]) % 4)
        dx = F.when(turn == 0, p["x"]).when(turn == 1, p["y"]).when(turn == 2, -p["x"]).otherwise(-p["y"])
        dy = F.when(turn == 0, p["y"]).when(turn == 1, -p["x"]).when(turn == 2, -p["y"]).otherwise(p["x"])
        return F.struct(*(p[k].alias(k) for k in ("f", "y", "u", "turn")), dx.alias("dx"), (F.abs(dy) / (math.pi / 4)).alias("sigma"))

    def sphere(p: Column) -> Column:
        equal = (p["f"] >= 1) & (p["f"] <= 4)
        lam = F.when(equal, (p["f"] - 1 + p["u"]) * (math.pi / 2) - math.pi).otherwise(-3 * math.pi / 4 + p["turn"] * (math.pi / 2) + F.coalesce(F.try_divide(p["dx"], p["sigma"]), F.lit(0.0)))
        cap = 1 - p["sigma"] * p["sigma"] / 3
        s = F.when(equal, p["y"] / (3 * math.pi / 8)).when(p["f"] == 0, cap).otherwise(-cap)
        return F.struct(lam.alias("lam"), F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s))).alias("beta"))

    def degrees(p: Column) -> Column:
        # authalic to geographic latitude, by the published series
        e2, b = _E**2, p["beta"]
        phi = b + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * b) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * b) + (761 * e2**3 / 45360) * F.sin(6 * b)
        return F.struct(F.degrees(p["lam"]).alias("x"), F.degrees(phi).alias("y"))

    at = F.struct(face.alias("f"), u.alias("u"), ((u - 0.5) * (math.pi / 2)).alias("x"), ((0.5 - v) * (math.pi / 2)).alias("y"))
    return _let(_let(_let(_let(at, spread), back), sphere), degrees)


def outline(at: Column, resolution: int) -> Column:
    """The corners of a cell, given by its index, as a closed ring of degrees."""
    n = float(SIDES**resolution)
    corners = lambda q: F.array(*(_corner(q["f"], (q["i"] + a) / n, (q["j"] + b) / n) for a, b in ((0, 1), (1, 1), (1, 0), (0, 0), (0, 1))))
    return _let(at, corners)


def width(resolution: int) -> float:
    """Degrees that a cell is wide at least, where it is narrowest: a bound for the step of samples."""
    return 90.0 / SIDES**resolution * 0.66

"""S2 cells as Column expressions, after the published formulas: cube faces, quadratic projection, Hilbert curve."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = 30
# Quadrant on the Hilbert curve by orientation and (i, j), and how a quadrant changes the orientation.
QUADRANT = ((0, 1, 3, 2), (0, 3, 1, 2), (2, 3, 1, 0), (2, 1, 3, 0))
TURN = (1, 0, 0, 3)


def _st(u: Column) -> Column:
    """Quadratic projection from the cube to the unit square."""
    return F.when(u >= 0, F.sqrt(F.abs(1 + 3 * u)) / 2).otherwise(1 - F.sqrt(F.abs(1 - 3 * u)) / 2)


def _on_face(lon: Column, lat: Column) -> Column:
    """struct(f, i, j): the face and the leaf cell's column and row on it."""
    phi, theta = F.radians(lat), F.radians(lon)
    x, y, z = F.cos(phi) * F.cos(theta), F.cos(phi) * F.sin(theta), F.sin(phi)
    p = F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    ax, ay, az = F.abs(x), F.abs(y), F.abs(z)
    face = F.when((ax > ay) & (ax > az), F.when(x >= 0, 0).otherwise(3)).when(ay > az, F.when(y >= 0, 1).otherwise(4)).otherwise(F.when(z >= 0, 2).otherwise(5))

    def on(q: Column) -> Column:
        x, y, z, f = q["p"]["x"], q["p"]["y"], q["p"]["z"], q["f"]
        u = F.when(f == 0, F.try_divide(y, x)).when(f == 1, F.try_divide(-x, y)).when(f == 2, F.try_divide(-x, z)).when(f == 3, F.try_divide(z, x)).when(f == 4, F.try_divide(z, y)).otherwise(F.try_divide(-y, z))
        v = F.when(f == 0, F.try_divide(z, x)).when(f == 1, F.try_divide(z, y)).when(f == 2, F.try_divide(-y, z)).when(f == 3, F.try_divide(y, x)).when(f == 4, F.try_divide(-x, y)).otherwise(F.try_divide(-x, z))
        return F.struct(f.cast("long").alias("f"), u.alias("u"), v.alias("v"))

    def cell(q: Column) -> Column:
        whole = lambda s: F.greatest(F.lit(0), F.least(F.lit(2**LEVELS - 1), F.floor(s * 2**LEVELS))).cast("long")
        return F.struct(q["f"].alias("f"), whole(_st(q["u"])).alias("i"), whole(_st(q["v"])).alias("j"))

    return F.transform(F.transform(F.array(F.struct(p.alias("p"), face.alias("f"))), on), cell)[0]


def leaf(lon: Column, lat: Column) -> Column:
    """The leaf cell's id as a (signed) long."""
    return F.transform(F.array(_on_face(lon, lat)), _walk)[0]


def index(lon: Column, lat: Column, level: int) -> Column:
    """struct(f, i, j): face, and column and row of the cell of ``level`` that holds a point."""
    at = _on_face(lon, lat)
    return F.transform(F.array(at), lambda q: F.struct(q["f"].alias("f"), F.shiftright(q["i"], LEVELS - level).alias("i"), F.shiftright(q["j"], LEVELS - level).alias("j")))[0]


def name(at: Column, level: int) -> Column:
    """The id of a cell by its index, as 16 hexadecimal digits."""
    middle = lambda v: F.shiftleft(v, LEVELS - level) + (1 << LEVELS - level) // 2
    id_ = F.transform(F.array(F.struct(at["f"].alias("f"), middle(at["i"]).alias("i"), middle(at["j"]).alias("j"))), _walk)[0]
    return _named(id_, level)


def _uv(s: Column) -> Column:
    return F.when(s >= 0.5, (4 * s * s - 1) / 3).otherwise((1 - 4 * (1 - s) * (1 - s)) / 3)


def outline(at: Column, level: int) -> Column:
    """The cell's corners as a closed ring of degrees."""
    n = float(1 << level)

    def corner(q: Column, a: int, b: int) -> Column:
        uv = F.struct(q["f"].alias("f"), _uv((q["i"] + a) / n).alias("u"), _uv((q["j"] + b) / n).alias("v"))
        return F.transform(F.transform(F.array(uv), xyz), degrees)[0]

    def xyz(p: Column) -> Column:
        u, v, f = p["u"], p["v"], p["f"]
        one = F.lit(1.0)
        x = F.when(f == 0, one).when(f == 1, -u).when(f == 2, -u).when(f == 3, -one).when(f == 4, v).otherwise(v)
        y = F.when(f == 0, u).when(f == 1, one).when(f == 2, -v).when(f == 3, -v).when(f == 4, -one).otherwise(u)
        z = F.when(f == 0, v).when(f == 1, v).when(f == 2, one).when(f == 3, -u).when(f == 4, -u).otherwise(-one)
        return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))

    def degrees(p: Column) -> Column:
        return F.struct(F.degrees(F.atan2(p["y"], p["x"])).alias("x"), F.degrees(F.atan2(p["z"], F.sqrt(p["x"] * p["x"] + p["y"] * p["y"]))).alias("y"))

    ring = lambda q: F.array(*(corner(q, a, b) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))))
    return F.transform(F.array(at), ring)[0]


def width(level: int) -> float:
    """Degrees that a cell is wide at least."""
    return 54.0 / (1 << level)


def _walk(q: Column) -> Column:
    quadrant = F.array(*(F.lit(v) for row in QUADRANT for v in row))
    turn = F.array(*(F.lit(v) for v in TURN))

    def step(s: Column, k: Column) -> Column:
        bit = lambda v: F.call_function("getbit", v, (F.lit(LEVELS - 1) - k).cast("int")).cast("int")
        ij = (2 * bit(q["i"]) + bit(q["j"])).cast("int")
        at = F.element_at(quadrant, (s["o"] * 4 + ij + 1).cast("int"))
        return F.struct((s["id"] * 4 + at).cast("long").alias("id"), s["o"].bitwiseXOR(F.element_at(turn, (at + 1).cast("int"))).cast("int").alias("o"))

    begin = F.struct(F.lit(0).cast("long").alias("id"), q["f"].bitwiseAND(F.lit(1).cast("long")).cast("int").alias("o"))
    walked = F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), begin, step, lambda s: s["id"])
    # three bits of the face, sixty of the curve and a closing one
    low = F.shiftleft(walked, 1).bitwiseOR(F.lit(1).cast("long"))
    return F.shiftleft(q["f"], 61).bitwiseOR(low)


def cell(lon: Column, lat: Column, level: int) -> Column:
    """The id of the cell of ``level`` that holds a point, as 16 hexadecimal digits."""
    if not 0 <= level <= LEVELS:
        raise ValueError("level must be from 0 to 30")
    return _named(leaf(lon, lat), level)


def _named(id_: Column, level: int) -> Column:
    end = 1 << 2 * (LEVELS - level)
    if level < LEVELS:
        id_ = id_.bitwiseAND(F.lit(-end)).bitwiseOR(F.lit(end))  # all bits down to the closing one
    return F.lower(F.lpad(F.hex(id_), 16, "0"))

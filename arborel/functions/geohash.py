"""Geohash cells as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The digits of the published encoding, in order.
DIGITS = "0123456789bcdefghjkmnpqrstuvwxyz"


def bits(precision: int) -> tuple[int, int]:
    """Bits of longitude and latitude; longitude comes first and takes the odd one."""
    return (5 * precision + 1) // 2, 5 * precision // 2


def cell_size(precision: int) -> tuple[float, float]:
    """Width and height of a cell in degrees."""
    lon, lat = bits(precision)
    return 360.0 / 2**lon, 180.0 / 2**lat


def lattice(lon: Column, lat: Column, precision: int) -> tuple[Column, Column]:
    """Column and row of the cell that holds a point; points on the upper end belong to the last cell."""
    nx, ny = bits(precision)
    w, h = cell_size(precision)
    clamp = lambda v, n: F.greatest(F.lit(0), F.least(F.floor(v), F.lit(2**n - 1))).cast("long")
    return clamp((lon + 180.0) / w, nx), clamp((lat + 90.0) / h, ny)


def from_lattice(i: Column, j: Column, precision: int) -> Column:
    """The cell's name."""
    nx, ny = bits(precision)
    out = []
    for c in range(precision):
        value = None
        for k in range(5):
            n = 5 * c + k
            source, place = (i, nx - 1 - n // 2) if n % 2 == 0 else (j, ny - 1 - n // 2)
            bit = F.shiftleft(F.shiftright(source, place).bitwiseAND(F.lit(1)), 4 - k)
            value = bit if value is None else value + bit
        out.append(F.substring(F.lit(DIGITS), (value + 1).cast("int"), F.lit(1)))
    return F.concat(*out)


def encode(lon: Column, lat: Column, precision: int) -> Column:
    """Geohash of a point, as long as ``precision``."""
    return from_lattice(*lattice(lon, lat, precision), precision)


def covering(x0: Column, y0: Column, x1: Column, y1: Column, precision: int) -> Column:
    """All cells that a box of degrees touches: array of struct(cell, x0, y0, x1, y1)."""
    w, h = cell_size(precision)
    i0, j0 = lattice(x0, y0, precision)
    i1, j1 = lattice(x1, y1, precision)

    def cell(i: Column, j: Column) -> Column:
        left, low = i * F.lit(w) - 180.0, j * F.lit(h) - 90.0
        return F.struct(from_lattice(i, j, precision).alias("cell"), left.alias("x0"), low.alias("y0"), (left + w).alias("x1"), (low + h).alias("y1"))

    return F.flatten(F.transform(F.sequence(i0, i1), lambda i: F.transform(F.sequence(j0, j1), lambda j: cell(i, j))))

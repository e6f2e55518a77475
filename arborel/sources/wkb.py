"""Well-known binary to and from geometry columns, as Arrow functions."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
_RING = T.ArrayType(_POINT)
SHAPE = T.StructType([T.StructField("kind", T.StringType()), T.StructField("parts", T.ArrayType(T.ArrayType(_RING))), T.StructField("paths", T.ArrayType(_RING)), T.StructField("points", _RING)])

# Type numbers of the format.
KINDS = {1: "point", 2: "line", 3: "polygon", 4: "multipoint", 5: "multiline", 6: "multipolygon", 7: "collection"}


class _Reader:
    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def take(self, form: str):
        out = struct.unpack_from(form, self.data, self.at)
        self.at += struct.calcsize(form)
        return out

    def shape(self, out: dict) -> str:
        order = "<" if self.data[self.at] == 1 else ">"
        self.at += 1
        (code,) = self.take(order + "I")
        extra = bin(code >> 30).count("1")  # flags of the extended format: Z and M
        if code & 0x20000000:
            self.at += 4  # an SRID
        code &= 0x0FFFFFFF
        extra += (0, 1, 1, 2)[min(code // 1000, 3)]  # the ISO numbers of Z, M and ZM
        kind = code % 1000
        if kind not in KINDS:
            raise ValueError(f"unknown geometry type {code}")
        size = 2 + extra

        def points(n: int) -> list[dict]:
            values = self.take(f"{order}{n * size}d")
            return [{"x": values[i], "y": values[i + 1]} for i in range(0, n * size, size)]

        if kind == 1:
            (p,) = points(1)
            if p["x"] == p["x"]:
                out["points"].append(p)
        elif kind == 2:
            out["paths"].append(points(self.take(order + "I")[0]))
        elif kind == 3:
            rings = [points(self.take(order + "I")[0]) for _ in range(self.take(order + "I")[0])]
            if rings:
                out["parts"].append(rings)
        else:
            for _ in range(self.take(order + "I")[0]):
                self.shape(out)
        return KINDS[kind]


def decode(data: bytes | None) -> dict | None:
    """A geometry's kind, polygon parts, lines and points; None for null, empty and broken input."""
    if not data:
        return None
    out: dict = {"parts": [], "paths": [], "points": []}
    try:
        kind = _Reader(bytes(data)).shape(out)
    except (struct.error, IndexError, ValueError):
        return None
    return {"kind": kind, **out}


def package_body(data: bytes | None) -> bytes | None:
    """The geometry of a GeoPackage blob, after its header."""
    if not data or bytes(data[:2]) != b"GP":
        return None
    envelope = (0, 32, 48, 48, 64)[min((data[3] >> 1) & 7, 4)]
    return bytes(data[8 + envelope :])


@F.pandas_udf(SHAPE)
def shape_of(wkb: pd.Series) -> pd.DataFrame:
    none = {"kind": None, "parts": None, "paths": None, "points": None}
    return pd.DataFrame([decode(w) or none for w in wkb], columns=["kind", "parts", "paths", "points"])


def encode_parts(parts) -> bytes | None:
    if parts is None or not len(parts):
        return None

    def polygon(rings) -> bytes:
        out = struct.pack("<BII", 1, 3, len(rings))
        for r in rings:
            out += struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in r)
        return out

    bodies = [polygon(p) for p in parts]
    return bodies[0] if len(bodies) == 1 else struct.pack("<BII", 1, 6, len(bodies)) + b"".join(bodies)


@F.pandas_udf(T.BinaryType())
def parts_to_wkb(parts: pd.Series) -> pd.Series:
    return parts.map(encode_parts)

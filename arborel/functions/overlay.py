"""Polygon overlay that Column expressions cannot express, as Arrow functions over numpy kernels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborel.functions.geometry import or_box

_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def _ring(points) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in points], float)


def _clip(poly: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The part of a convex polygon on the left of the line a-b."""
    if not len(poly):
        return poly
    side = (b[0] - a[0]) * (poly[:, 1] - a[1]) - (b[1] - a[1]) * (poly[:, 0] - a[0])
    after, next_side = np.roll(poly, -1, 0), np.roll(side, -1)
    out = []
    for p, q, s, t in zip(poly, after, side, next_side):
        if s >= 0:
            out.append(p)
        if (s > 0 and t < 0) or (s < 0 and t > 0):
            out.append(p + (q - p) * (s / (s - t)))
    return np.array(out)


def _area(poly: np.ndarray) -> float:
    if len(poly) < 3:
        return 0.0
    x, y = poly[:, 0] - poly[0, 0], poly[:, 1] - poly[0, 1]
    return float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2


def _triangles(parts, origin: np.ndarray) -> list[tuple[float, np.ndarray]]:
    """Signed triangles, fanned from each ring's first point; shells count positive, holes negative."""
    out = []
    for part in parts:
        for k, ring in enumerate(part):
            points = _ring(ring)[:-1] - origin
            sign = (1.0 if _area(points) >= 0 else -1.0) * (1.0 if k == 0 else -1.0)
            for i in range(1, len(points) - 1):
                triangle = points[[0, i, i + 1]]
                a = _area(triangle)
                if a:
                    out.append((sign * np.sign(a), triangle if a > 0 else triangle[::-1]))
    return out


def intersection_area(a, b) -> float:
    """Area that two polygons share, with holes, in general position: the signed sum over pairs of fan triangles."""
    if a is None or b is None or not len(a) or not len(b):
        return 0.0
    origin = np.array([a[0][0][0]["x"], a[0][0][0]["y"]])
    total = 0.0
    others = _triangles(b, origin)
    for s, p in _triangles(a, origin):
        lo, hi = p.min(0), p.max(0)
        for t, q in others:
            if (q.max(0) <= lo).any() or (q.min(0) >= hi).any():
                continue
            part = p
            for i in range(3):
                part = _clip(part, q[i], q[(i + 1) % 3])
            total += s * t * _area(part)
    return max(total, 0.0)


@F.arrow_udf(T.DoubleType())
def overlap_area(a: pa.Array, b: pa.Array) -> pa.Array:
    """Area that two polygons share; 0 where one is null."""
    out = np.zeros(len(a))
    at = np.flatnonzero(pc.and_(a.is_valid(), b.is_valid()).to_numpy(zero_copy_only=False))
    for i, p, q in zip(at.tolist(), a.take(pa.array(at)).to_pylist(), b.take(pa.array(at)).to_pylist()):
        out[i] = intersection_area(p, q)
    return pa.array(out)


def box_overlap(a: tuple[str, str, str, str], b: tuple[str, str, str, str]) -> Column:
    """The area that two boxes share."""
    side = lambda k: f"greatest(least({a[k + 2]}, {b[k + 2]}) - greatest({a[k]}, {b[k]}), 0D)"
    return F.expr(f"{side(0)} * {side(1)}")


def shared_area(a: str, b: str, a_flag: str, b_flag: str, a_box: tuple[str, str, str, str], b_box: tuple[str, str, str, str]) -> Column:
    """``overlap_area``; where both are rectangles (flags of ``geometry.is_box``) in closed form, without a trip to Python for their points.
    Rectangles' polygons may be null."""
    both = F.col(a_flag) & F.col(b_flag)
    return F.when(both, box_overlap(a_box, b_box)).otherwise(overlap_area(F.when(~both, F.expr(or_box(a, a_box))), F.when(~both, F.expr(or_box(b, b_box)))))


def surface_point(parts) -> dict | None:
    """A point inside: the centroid where that is inside, else the middle of the widest piece of a line through the middle."""
    if parts is None or not len(parts):
        return None
    rings = [_ring(r) for part in parts for r in part]
    total, moment = 0.0, np.zeros(2)
    o = rings[0][0]
    at = 0
    for part in parts:
        for k in range(len(part)):
            r = rings[at] - o
            at += 1
            c = r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1]
            sign = np.sign(c.sum()) * (1 if k == 0 else -1)
            total += sign * c.sum()
            moment += sign * ((r[:-1] + r[1:]) * c[:, None]).sum(0)

    def cuts(y: float) -> np.ndarray:
        xs = []
        for r in rings:
            p, q = r[:-1], r[1:]
            cross = (p[:, 1] > y) != (q[:, 1] > y)
            p, q = p[cross], q[cross]
            xs.append(p[:, 0] + (y - p[:, 1]) / (q[:, 1] - p[:, 1]) * (q[:, 0] - p[:, 0]))
        return np.sort(np.concatenate(xs))

    if total:
        c = o + moment / (3 * total)
        xs = cuts(float(c[1]))
        if np.searchsorted(xs, c[0]) % 2:
            return {"x": float(c[0]), "y": float(c[1])}
    ys = np.unique(np.concatenate([r[:, 1] for r in rings]))
    if len(ys) < 2:
        return {"x": float(rings[0][0, 0]), "y": float(rings[0][0, 1])}
    lines = (ys[:-1] + ys[1:]) / 2
    for y in lines[np.argsort(np.abs(lines - (ys[0] + ys[-1]) / 2), kind="stable")].tolist():
        xs = cuts(y)
        if len(xs):
            widest = int(np.argmax(xs[1::2] - xs[0::2]))
            return {"x": float(xs[2 * widest] + xs[2 * widest + 1]) / 2, "y": y}
    return {"x": float(rings[0][0, 0]), "y": float(rings[0][0, 1])}


@F.arrow_udf(_POINT)
def point_on_surface(parts: pa.Array) -> pa.Array:
    found = [surface_point(p) or {"x": None, "y": None} for p in parts.to_pylist()]
    return pa.array(found, pa.struct([("x", pa.float64()), ("y", pa.float64())]))


def _is_convex(p: np.ndarray) -> bool:
    """Whether an open ring turns one way, and once around."""
    d = np.roll(p, -1, 0) - p
    turn = d[:, 0] * np.roll(d[:, 1], -1) - d[:, 1] * np.roll(d[:, 0], -1)
    angles = np.arctan2(d[:, 1], d[:, 0])
    around = (np.diff(angles, append=angles[0]) + np.pi) % (2 * np.pi) - np.pi
    return bool((turn >= 0).all() and abs(around.sum()) < 2 * np.pi + 1e-6)


def _clean(points: np.ndarray, left: bool) -> np.ndarray:
    """An open ring without repeated points that turns left, or right."""
    p = points[:-1] if (points[0] == points[-1]).all() else points
    p = p[(p != np.roll(p, 1, 0)).any(1)]
    return p if len(p) < 3 or (_area(p) > 0) == left else p[::-1]


def _offset(p: np.ndarray, radius: float, quad_segs: int) -> np.ndarray:
    """The curve ``radius`` to the right of an open ring: arcs at corners to the left, at others a way through the corner.

    It may cross itself; what it winds around more than zero times is the ring's inside grown.
    """
    d = np.roll(p, -1, 0) - p
    angle = np.arctan2(-d[:, 0], d[:, 1])  # normal of each edge, to its right
    out = []
    for i in range(len(p)):
        before, now = angle[i - 1], angle[i]
        turn = (now - before) % (2 * np.pi)
        if turn > np.pi + 1e-9:
            out += [p[i] + radius * np.array([np.cos(before), np.sin(before)]), p[i], p[i] + radius * np.array([np.cos(now), np.sin(now)])]
            continue
        steps = max(1, int(np.ceil(turn / (np.pi / 2 / quad_segs) - 1e-9)))
        for a in before + turn * np.arange(steps + 1) / steps:
            out.append(p[i] + radius * np.array([np.cos(a), np.sin(a)]))
    return np.array(out)


def buffer_ring(points: np.ndarray, radius: float, quad_segs: int) -> np.ndarray:
    """Outline of a convex ring (closed, any direction) grown by ``radius``, corners cut into quad_segs steps a quarter."""
    out = _offset(_clean(points, True), radius, quad_segs)
    return np.concatenate([out, out[:1]])


def wound_pieces(rings: list[np.ndarray]) -> list[np.ndarray]:
    """What open rings wind around more than zero times, as trapezoids between the heights of their corners and crossings."""
    a = np.concatenate(rings)
    b = np.concatenate([np.roll(r, -1, 0) for r in rings])
    flat = a[:, 1] == b[:, 1]
    a, b = a[~flat], b[~flat]
    heights = [a[:, 1], b[:, 1]]
    d = b - a
    for i in range(len(a)):
        # where later edges cross this one
        o, e = a[i + 1 :] - a[i], d[i + 1 :]
        det = d[i, 0] * e[:, 1] - d[i, 1] * e[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (o[:, 0] * e[:, 1] - o[:, 1] * e[:, 0]) / det
            u = (o[:, 0] * d[i, 1] - o[:, 1] * d[i, 0]) / det
        met = (det != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        heights.append(a[i, 1] + t[met] * d[i, 1])
    ys = np.unique(np.concatenate(heights))
    low, high = np.minimum(a[:, 1], b[:, 1]), np.maximum(a[:, 1], b[:, 1])
    slope = d[:, 0] / d[:, 1]
    way = np.where(d[:, 1] > 0, -1, 1)  # a ring that turns left goes down on its left side
    out = []
    for y0, y1 in zip(ys[:-1].tolist(), ys[1:].tolist()):
        middle = (y0 + y1) / 2
        here = np.flatnonzero((low < middle) & (high > middle))
        at = a[here, 0] + (middle - a[here, 1]) * slope[here]
        here = here[np.argsort(at, kind="stable")]
        wound = np.cumsum(way[here])
        left = None
        for edge, w in zip(here.tolist(), wound.tolist()):
            if w > 0 and left is None:
                left = edge
            elif w <= 0 and left is not None:
                x = [[a[e, 0] + (y - a[e, 1]) * slope[e] for y in (y0, y1)] for e in (left, edge)]
                out.append(np.array([(x[0][0], y0), (x[1][0], y0), (x[1][1], y1), (x[0][1], y1)]))
                left = None
    return out


def grown_rings(parts, radius: float, quad_segs: int) -> list[list[np.ndarray]] | None:
    """All parts of a polygon, with their holes, grown by ``radius``, as closed shells: one outline where the polygon is one
    convex ring, else pieces that do not overlap. Rings without area grow as the points they have."""
    if parts is None or not len(parts):
        return None
    rings = [_clean(_ring(r), k == 0) for part in parts for k, r in enumerate(part)]
    if len(rings) == 1 and len(rings[0]) > 2 and _is_convex(rings[0]):
        shells = [_offset(rings[0], radius, quad_segs)]
    else:
        origin = rings[0][0] if len(rings[0]) else np.zeros(2)
        curves = [_offset(r - origin, radius, quad_segs) for r in rings if len(r) > 2]
        shells = [p + origin for p in wound_pieces(curves)] if curves else []
    return [np.concatenate([s, s[:1]]) for s in shells]


def round_buffer(radius: float, quad_segs: int = 8):
    """An Arrow function: each polygon grown by ``radius``."""

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.ArrayType(_POINT))))
    def grow(parts: pa.Array) -> pa.Array:
        grown = (grown_rings(p, radius, quad_segs) for p in parts.to_pylist())
        rows = [None if shells is None else [[[{"x": x, "y": y} for x, y in s.tolist()]] for s in shells] for shells in grown]
        point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
        return pa.array(rows, pa.list_(pa.list_(pa.list_(point))))

    return grow


def _corner_share(a0: np.ndarray, a1: np.ndarray, c0: np.ndarray, c1: np.ndarray, radius: float, quad_segs: int) -> np.ndarray:
    """Area that boxes [a0, a1] x [c0, c1] share with the quarter of a circle's polygon where x and y are positive."""
    a0, a1, c0, c1 = (np.clip(v, 0.0, radius) for v in (a0, a1, c0, c1))
    angles = np.pi / 2 * np.arange(quad_segs, -1, -1) / quad_segs
    xs, ys = radius * np.cos(angles), radius * np.sin(angles)
    out = np.zeros(len(a0))
    for x0, x1, y0, y1 in zip(xs[:-1], xs[1:], ys[:-1], ys[1:]):
        s, t = np.clip(a0, x0, x1), np.clip(a1, x0, x1)
        slope = (y1 - y0) / (x1 - x0)
        for floor, sign in ((c0, 1), (c1, -1)):
            # the falling edge above a floor: whole, or a triangle that ends where it goes below
            first, last = y0 + (s - x0) * slope - floor, y0 + (t - x0) * slope - floor
            drop = np.where(first > last, first - last, 1.0)
            height = np.where(last >= 0, (first + last) / 2, np.where(first > 0, first * first / (2 * drop), 0.0))
            out += sign * (t - s) * height
    return out


def grown_box_share(a: list[np.ndarray], b: list[np.ndarray], radius: float, quad_segs: int) -> np.ndarray:
    """``intersection_area`` of boxes a, grown as ``grown_rings`` does, and boxes b: a cross of boxes and four corners."""
    width = lambda k, lo, hi: np.maximum(np.minimum(b[k + 2], hi) - np.maximum(b[k], lo), 0.0)
    out = width(0, a[0], a[2]) * width(1, a[1] - radius, a[3] + radius)
    out += width(1, a[1], a[3]) * (width(0, a[0] - radius, a[0]) + width(0, a[2], a[2] + radius))
    past = [((a[k] - b[k + 2], a[k] - b[k]), (b[k] - a[k + 2], b[k + 2] - a[k + 2])) for k in (0, 1)]
    for x0, x1 in past[0]:
        for y0, y1 in past[1]:
            at = np.flatnonzero((x1 > 0) & (y1 > 0) & (np.maximum(x0, 0) ** 2 + np.maximum(y0, 0) ** 2 < radius**2))
            if len(at):
                out[at] += _corner_share(x0[at], x1[at], y0[at], y1[at], radius, quad_segs)
    return out


def box_share(radius: float, quad_segs: int = 8):
    """An Arrow function of two boxes' corners: the area of the second within the first grown by ``radius``."""

    @F.arrow_udf(T.DoubleType())
    def share(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array, u0: pa.Array, v0: pa.Array, u1: pa.Array, v1: pa.Array) -> pa.Array:
        a, b = ([c.to_numpy(zero_copy_only=False) for c in box] for box in ((x0, y0, x1, y1), (u0, v0, u1, v1)))
        return pa.array(grown_box_share(a, b, radius, quad_segs))

    return share

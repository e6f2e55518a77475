"""Dense joins of boxes with points, or with other boxes, done block by block in numpy.

Where a row has partners by the thousand, a row for each pair costs more than the test. Both sides are dealt to square
blocks, a point to one and a box to those it reaches, so a pair meets once; a block's task sees numbers only, tests
boxes against points tile by tile and returns one row for each box.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborel.operators.grid import BOX, POINT, with_cells

#: Metres that a block is wide, the tests of a tile, and the boxes that look for partners together.
BLOCK = 500.0
TILE = 1 << 17
HOMES = 64


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def groups(x: np.ndarray, y: np.ndarray, side: float) -> list[np.ndarray]:
    """Rows by the square of that side they lie in."""
    cx, cy = np.floor(x / side), np.floor(y / side)
    order = np.lexsort((cy, cx))
    cx, cy = cx[order], cy[order]
    return np.split(order, np.flatnonzero((cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])) + 1)


def near_counts(box: list[np.ndarray], x: np.ndarray, y: np.ndarray, radii: list[float]) -> np.ndarray:
    """How many of the points (x, y) are at most so far from each box: a row for each of ``radii``."""
    out, radius = np.zeros((len(radii), len(box[0])), np.int64), max(radii)
    if not len(box[0]) or not len(x):
        return out
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    for rows in groups((box[0] + box[2]) / 2, (box[1] + box[3]) / 2, max(radius, 25.0)):
        x0, y0, x1, y1 = (c[rows] for c in box)
        # a little more than the reach, whose last digit may round away
        reach = radius * (1 + 1e-9) + 1e-6
        some = slice(np.searchsorted(x, x0.min() - reach), np.searchsorted(x, x1.max() + reach, "right"))
        kept = (y[some] >= y0.min() - reach) & (y[some] <= y1.max() + reach)
        px, py = x[some][kept], y[some][kept]
        step = max(1, TILE // max(1, len(px)))
        for i in range(0, len(rows), step):
            s = slice(i, i + step)
            gap = np.maximum(x0[s, None] - px, px - x1[s, None])
            np.maximum(gap, 0.0, out=gap)
            gap *= gap
            up = np.maximum(y0[s, None] - py, py - y1[s, None])
            np.maximum(up, 0.0, out=up)
            up *= up
            gap += up
            for k, r in enumerate(radii):
                out[k, rows[s]] = np.count_nonzero(gap <= r * r, axis=1)
    return out


def points_near_boxes(boxes: DataFrame, points: DataFrame, key: str, radii: list[float]) -> DataFrame:
    """key and n_0, n_1 ..., the points (x, y) at most so far from the box: a row for each block where there are any, to be summed."""
    radius, names = max(radii), [f"n_{k}" for k in range(len(radii))]
    size = max(BLOCK, 5 * radius)

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        found = near_counts([_column(left, c) for c in BOX], _column(right, "x"), _column(right, "y"), radii)
        some = np.flatnonzero(found.any(0))
        return pa.table({key: left[key].take(pa.array(some)).combine_chunks()} | {n: pa.array(c[some]) for n, c in zip(names, found)})

    numbers = lambda names: [F.col(c).cast("double").alias(c) for c in names]
    a = with_cells(boxes.select(key, *numbers(BOX)), size, BOX, radius)
    b = with_cells(points.select(*numbers(POINT[:2])), size, POINT)
    kind = boxes.schema[key].dataType.simpleString()
    return a.groupBy("_cx", "_cy").cogroup(b.groupBy("_cx", "_cy")).applyInArrow(counted, ", ".join([f"`{key}` {kind}", *(f"{n} long" for n in names)]))


def least_gaps(a: list[np.ndarray], b: list[np.ndarray], reach: float) -> tuple[np.ndarray, np.ndarray]:
    """For each box of a the first of the nearest boxes of b and their squared distance, if it is within ``reach``; else -1."""
    at, least = np.full(len(a[0]), -1), np.full(len(a[0]), np.inf)
    if not len(at) or not len(b[0]):
        return at, least
    reach = reach * (1 + 1e-9) + 1e-6
    for rows in groups((a[0] + a[2]) / 2, (a[1] + a[3]) / 2, max(reach, 100.0)):
        x0, y0, x1, y1 = (c[rows] for c in a)
        some = np.flatnonzero((b[2] >= x0.min() - reach) & (b[0] <= x1.max() + reach) & (b[3] >= y0.min() - reach) & (b[1] <= y1.max() + reach))
        if not len(some):
            continue
        u0, v0, u1, v1 = (c[some] for c in b)
        step = max(1, TILE // len(some))
        for i in range(0, len(rows), step):
            s = slice(i, i + step)
            gap = np.maximum(np.maximum(x0[s, None] - u1, u0 - x1[s, None]), 0.0)
            up = np.maximum(np.maximum(y0[s, None] - v1, v0 - y1[s, None]), 0.0)
            gap = gap * gap + up * up
            first = gap.argmin(1)
            at[rows[s]], least[rows[s]] = some[first], gap[np.arange(len(first)), first]
    return at, least


def nearest_boxes(left: DataFrame, right: DataFrame, key: str, order: str, left_box: tuple, right_box: tuple, reach: float) -> DataFrame:
    """Per left box with any within ``reach``: key, ``order`` of the nearest right box (the least of those as near) and ``distance``."""
    size = max(BLOCK, 2 * reach)

    def found(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.sort_by(order)
        at, least = least_gaps([_column(a, c) for c in left_box], [_column(b, c) for c in right_box], reach)
        some = np.flatnonzero(at >= 0)
        return pa.table({key: a[key].take(pa.array(some)).combine_chunks(), "square": pa.array(least[some]), order: b[order].take(pa.array(at[some])).combine_chunks()})

    numbers = lambda names: [F.col(c).cast("double").alias(c) for c in names]
    a = with_cells(left.select(key, *numbers(left_box)), size, left_box, reach)
    b = with_cells(right.select(order, *numbers(right_box)), size, right_box)
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((left, key), (right, order))]
    met = a.groupBy("_cx", "_cy").cogroup(b.groupBy("_cx", "_cy")).applyInArrow(found, f"`{key}` {kinds[0]}, square double, `{order}` {kinds[1]}")
    best = met.groupBy(key).agg(F.min(F.struct("square", order)).alias("_best"))
    return best.select(key, F.col(f"_best.{order}").alias(order), F.sqrt("_best.square").alias("distance")).filter(F.col("distance") <= reach)


def shared_sums(a: list[np.ndarray], b: list[np.ndarray], cell: tuple[int, int], size: float) -> np.ndarray:
    """For each box of a the area that it shares with each box of b, summed; pairs that meet in several blocks count in the one
    that holds the lower left corner of their overlap."""
    out = np.zeros(len(a[0]))
    if not len(out) or not len(b[0]):
        return out
    x, y = (a[0] + a[2]) / 2, (a[1] + a[3]) / 2
    spread = max(np.ptp(x), 1.0) * max(np.ptp(y), 1.0)
    for rows in groups(x, y, max(np.sqrt(spread * HOMES / len(out)), 1.0)):
        x0, y0, x1, y1 = (c[rows] for c in a)
        some = np.flatnonzero((b[2] >= x0.min()) & (b[0] <= x1.max()) & (b[3] >= y0.min()) & (b[1] <= y1.max()))
        u0, v0, u1, v1 = (c[some] for c in b)
        step = max(1, TILE // max(1, len(some)))
        for i in range(0, len(rows), step):
            s = slice(i, i + step)
            left, low = np.maximum(x0[s, None], u0), np.maximum(y0[s, None], v0)
            wide, high = np.minimum(x1[s, None], u1) - left, np.minimum(y1[s, None], v1) - low
            r, c = np.nonzero((wide > 0) & (high > 0))
            here = (np.floor(left[r, c] / size) == cell[0]) & (np.floor(low[r, c] / size) == cell[1])
            r, c = r[here], c[here]
            out[rows[s]] += np.bincount(r, wide[r, c] * high[r, c], len(rows[s]))
    return out


def shared_areas(left: DataFrame, right: DataFrame, keys: list[str], left_box: tuple, right_box: tuple) -> DataFrame:
    """keys and _part, the area that a left box shares with right boxes: a row for each block where there is any, to be summed."""

    def shared(key: tuple[pa.Scalar, ...], a: pa.Table, b: pa.Table) -> pa.Table:
        sums = shared_sums([_column(a, c) for c in left_box], [_column(b, c) for c in right_box], (key[0].as_py(), key[1].as_py()), BLOCK)
        some = np.flatnonzero(sums)
        return pa.table({k: a[k].take(pa.array(some)).combine_chunks() for k in keys} | {"_part": pa.array(sums[some])})

    numbers = lambda names: [F.col(c).cast("double").alias(c) for c in names]
    a = with_cells(left.select(*keys, *numbers(left_box)), BLOCK, left_box)
    b = with_cells(right.select(*numbers(right_box)), BLOCK, right_box)
    kinds = [f"`{k}` {left.schema[k].dataType.simpleString()}" for k in keys]
    return a.groupBy("_cx", "_cy").cogroup(b.groupBy("_cx", "_cy")).applyInArrow(shared, ", ".join([*kinds, "_part double"]))

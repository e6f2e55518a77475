"""Spatial joins as equi-joins on grid cells.

Both sides are dealt to square cells by their bounding boxes; the join key is the cell, so
Catalyst plans a sort-merge (or, where a side is small, a broadcast) join that adaptive
execution can split where a cell is dense, never a nested loop. A pair that meets in several
cells is kept in the one that holds the lower left corner of the boxes' overlap, which needs no
distinct. The cheap box test is part of the join; exact predicates follow as filters.

A box that is null or has a null corner is in no cell and joins with nothing.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborel.operators.lineage import written

BOX = ("x0", "y0", "x1", "y1")
POINT = ("x", "y", "x", "y")


def _cell(x: str | Column, size: float) -> Column:
    return F.floor((F.expr(x) if isinstance(x, str) else x) / F.lit(float(size)))


def with_cells(df: DataFrame, size: float, box: tuple[str, str, str, str] = BOX, grow: float = 0.0) -> DataFrame:
    """Rows once for each cell (_cx, _cy) that their box, grown by ``grow``, touches."""
    x0, y0, x1, y1 = (F.col(c) for c in box)
    if box[0] == box[2] and box[1] == box[3] and grow == 0:
        return df.filter(x0.isNotNull() & y0.isNotNull()).withColumns({"_cx": _cell(x0, size), "_cy": _cell(y0, size)})
    whole = x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull()
    xs = F.sequence(_cell(x0 - grow, size), _cell(x1 + grow, size))
    ys = F.sequence(_cell(y0 - grow, size), _cell(y1 + grow, size))
    return df.filter(whole).withColumn("_cx", F.explode(xs)).withColumn("_cy", F.explode(ys))


def total_bounds(rows: DataFrame, box: tuple[str, str, str, str] = BOX) -> DataFrame:
    """One row: the box around all boxes, nulls where there are none."""
    return rows.agg(*(f(c).alias(n) for f, c, n in zip((F.min, F.min, F.max, F.max), box, BOX)))


def box_join(left: DataFrame, right: DataFrame, size: float, radius: float = 0.0, left_box: tuple = BOX, right_box: tuple = BOX, condition: Column | None = None) -> DataFrame:
    """Pairs whose boxes are at most ``radius`` apart, each once, with the columns of both sides.

    The sides' columns must have different names. The left side is dealt to more cells as the
    radius grows, so it should be the one with fewer or smaller rows. ``condition`` filters pairs further.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    a = with_cells(left, size, left_box, radius)
    b = with_cells(right, size, right_box).withColumnsRenamed({"_cx": "_dx", "_cy": "_dy"})
    l0, l1, l2, l3 = (F.col(c) for c in left_box)
    r0, r1, r2, r3 = (F.col(c) for c in right_box)
    # the lower left corner of the overlap of the grown left box and the right box
    once = (F.col("_cx") == _cell(F.greatest(l0 - radius, r0), size)) & (F.col("_cy") == _cell(F.greatest(l1 - radius, r1), size))
    gap = F.pow(F.greatest(l0 - r2, r0 - l2, F.lit(0.0)), 2) + F.pow(F.greatest(l1 - r3, r1 - l3, F.lit(0.0)), 2)
    near = gap <= radius * radius
    on = (F.col("_cx") == F.col("_dx")) & (F.col("_cy") == F.col("_dy")) & once & near
    # part of the join, so that the exact test comes after the cheap ones; a later filter would be put before them
    return a.join(b, on if condition is None else on & condition).drop("_cx", "_cy", "_dx", "_dy")


#: Rectangles in at most so many cells are few.
FEW = 10_000


def are_few(rows: DataFrame, size: float) -> bool:
    """Whether boxes whose ``parts`` are null (rectangles) lie in few cells, so that they may be sent to every task and the
    tables that they meet need no shuffle."""
    cells = with_cells(rows.select(*BOX, "parts"), size).limit(FEW + 1)
    count, odd = cells.agg(F.count(F.lit(1)), F.count("parts")).first()
    return count <= FEW and not odd


#: A right row is dealt to cells of which its box spans at most so many each way.
SPAN = 4
#: More doublings than any coordinates have room for; rows without a distance to anything end there.
ROUNDS = 40
#: The reach begins at so many halvings of the size at most.
LEAST = -8


def _start(count: int, bounds: list, size: float) -> int:
    """The level to begin at: the reach is about as wide as right rows are apart, so dense tables do not meet by the hundred."""
    if not count:
        return 0
    wide, high = bounds[2] - bounds[0], bounds[3] - bounds[1]
    apart = max(math.sqrt(wide * high / count), max(wide, high) / count)
    return max(LEAST, min(0, math.floor(math.log2(apart / size)))) if 0 < apart < math.inf else 0


def nearest(left: DataFrame, right: DataFrame, size: float, key: str, order: str, distance: Column, left_box: tuple = BOX, right_box: tuple = BOX, mark: tuple[str, str] | None = None, within: float | None = None, keep: list[str] | None = None, flags: tuple[str, str] | None = None) -> DataFrame:
    """Each left row's nearest right row: key, the right columns (``order`` and those that ``keep`` names, all if it is not given),
    ``distance``; ties go to the least ``order``.

    Rounds look in a reach that doubles, from ``size`` on, or less where right rows lie closer: a row whose best partner lies within
    the reach is done, and only the others go on to the next round, so dense regions end early and sparse ones cost rounds, not rows.
    Cells are as wide as the reach and ``size`` at least; a right row whose box spans many of them is dealt to wider cells of its own
    instead, so no row is in many cells, however large it is. A round takes the least distance first, a number that hash aggregation
    holds, and then the least order among the partners at that distance: pairs are neither sorted nor listed.
    ``flags`` names a column of each side that tells rectangles, for which ``distance`` is that of the boxes (and ``keep`` names none):
    those meet block by block in numpy, and only pairs with other forms are joined.
    Rows without any partner (an empty right side, or none ``within``) are left out. ``mark`` is not needed any more.
    """
    from arborel.operators.blocks import BLOCK, nearest_boxes

    rest = [c for c in right.columns if c != order] if keep is None else keep
    if within is not None:
        reach = box_join(left, right, size, within, left_box, right_box).withColumn("distance", distance).filter(F.col("distance") <= within)
        return _best(reach, key, order, rest)
    l0, l1, l2, l3 = (F.col(c) for c in left_box)
    r0, r1, r2, r3 = (F.col(c) for c in right_box)
    whole = lambda *corners: F.expr(" AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(`{c}`)" for c in corners))
    extent = F.greatest(r2 - r0, r3 - r1) / F.lit(size * SPAN)
    own = F.greatest(F.ceil(F.log2(F.greatest(extent, F.lit(1.0)))), F.lit(0)).cast("int")
    some = right.filter(whole(*right_box)).withColumn("_own", own)
    count, widest, *bounds = some.agg(F.count(F.lit(1)), F.max("_own"), F.min(r0), F.min(r1), F.max(r2), F.max(r3)).first()
    gap = F.pow(F.greatest(l0 - r2, r0 - l2, F.lit(0.0)), 2) + F.pow(F.greatest(l1 - r3, r1 - l3, F.lit(0.0)), 2)
    cell = lambda x, width: F.floor(x / width)

    # sides of pairs to join, and whether there may be any; boxes over many blocks are joined too
    small = lambda flag, c: (F.lit(False) if flag is None else F.col(flag)) & (F.greatest(F.col(c[2]) - F.col(c[0]), F.col(c[3]) - F.col(c[1])) <= SPAN * BLOCK)
    left_small, right_small = small(flags and flags[0], left_box), small(flags and flags[1], right_box)
    waiting = left.filter(whole(*left_box))
    if flags:
        waiting = written(waiting, "waiting")  # read more than once, and telling rectangles costs more than reading
    odd = [df.filter(~c).head(1) != [] for df, c in ((waiting, left_small), (some, right_small))] if flags else []
    joined = [(~left_small, F.lit(True)), (left_small, ~right_small)] if flags else [(F.lit(True), F.lit(True))]
    joined = [sides for sides, there in zip(joined, odd or [True]) if there]

    def met(rows: DataFrame, some: DataFrame, reach: Column, cells: int, condition: Column) -> DataFrame:
        """Pairs whose boxes are at most ``reach`` apart; one may meet in several cells, which a minimum does not mind."""
        width = F.pow(F.lit(2.0), F.col("_level")) * F.lit(float(size))
        a = rows.withColumn("_level", F.explode(F.sequence(F.lit(cells), F.lit(max(cells, widest)))))
        a = a.withColumn("_cx", F.explode(F.sequence(cell(l0 - reach, width), cell(l2 + reach, width)))).withColumn("_cy", F.explode(F.sequence(cell(l1 - reach, width), cell(l3 + reach, width))))
        b = some.withColumn("_right_level", F.greatest(F.col("_own"), F.lit(cells)))
        width = F.pow(F.lit(2.0), F.col("_right_level")) * F.lit(float(size))
        b = b.withColumn("_dx", F.explode(F.sequence(cell(r0, width), cell(r2, width)))).withColumn("_dy", F.explode(F.sequence(cell(r1, width), cell(r3, width)))).drop("_own")
        return a.join(b, (F.col("_level") == F.col("_right_level")) & (F.col("_cx") == F.col("_dx")) & (F.col("_cy") == F.col("_dy")) & (gap <= reach * reach) & condition)

    done, level = None, _start(count, bounds, size)
    last = level + ROUNDS
    while widest is not None and level < last:
        reach, cells = size * 2.0**level, max(level, 0)
        rounds = [nearest_boxes(waiting.filter(left_small), some.filter(right_small), key, order, left_box, right_box, reach)] if flags else []
        for a, b in ((waiting.filter(c), some.filter(d)) for c, d in joined):
            least = met(a, b, F.lit(reach), cells, F.lit(True)).groupBy(key).agg(F.min(distance).alias("_least")).filter(F.col("_least") <= reach)
            # boxes are no farther apart than what is in them, but for the last digits
            slack = F.col("_least") * (1 + 1e-9) + 1e-9
            rounds.append(_first(met(a.join(least, key), b, slack, cells, distance == F.col("_least")), key, order, rest, "_least"))
        found = rounds[0] if len(rounds) == 1 else _best(reduce(DataFrame.unionByName, rounds), key, order, rest)
        found = written(found, "nearest")
        done = found if done is None else done.unionByName(found)
        left_over = waiting.join(found.select(key), key, "left_anti")
        waiting, level = written(left_over, "waiting"), level + 1
        if not waiting.head(1):
            return done
    return done if done is not None else _best(box_join(left, right, size, size, left_box, right_box).withColumn("distance", distance), key, order, rest)


def _first(ties: DataFrame, key: str, order: str, rest: list[str], distance: str) -> DataFrame:
    """Of each key's rows at one ``distance`` that with the least ``order``."""
    if not rest:
        return ties.groupBy(key).agg(F.min(order).alias(order), F.min(distance).alias("distance"))
    first = ties.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_first"), F.min(distance).alias("distance"))
    return first.select(key, *(F.col(f"_first.{c}").alias(c) for c in (order, *rest)), "distance")


def _best(pairs: DataFrame, key: str, order: str, rest: list[str]) -> DataFrame:
    best = pairs.groupBy(key).agg(F.min(F.struct(F.col("distance"), F.col(order), *rest)).alias("_best"))
    return best.select(key, *(F.col(f"_best.{c}").alias(c) for c in (order, *rest)), F.col("_best.distance").alias("distance"))

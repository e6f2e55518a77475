"""Trees in unobstructed view of a building, in two and a half dimensions.

Someone looks from a building at a tree, from three heights (the ground, half way up, the top) at
three heights of the tree (the same). Other buildings and crowns stand in between as prisms.

An obstacle of height H that the way to the tree crosses between the fractions f and g of its length
hides, for an eye at height e, everything at the tree up to one height: e + (H - e) / f where it rises
above the eye, since its near side then hides most, and e + (H - e) / g where it does not, since the
view passes over its far side. So one number for each eye tells all lines to a tree apart: the
greatest of these heights over the obstacles of the way, its ``shade``. A line is clear if it ends
above the shade.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborel.functions import geometry
from arborel.operators import sightlines
from arborel.operators.blocks import BLOCK
from arborel.operators.grid import BOX, POINT, box_join, with_cells

# The heights looked from and at, as shares of the whole height, and the length at both ends of a way
# in metres that obstacles may touch.
SHARES = {"bottom": 0.0, "middle": 0.5, "top": 1.0}
MARGIN = 0.05


def usable_buildings(buildings: DataFrame) -> DataFrame:
    """Buildings with a positive height."""
    return buildings.filter(F.col("building_height") > 0)


def height_quality(buildings: DataFrame) -> DataFrame:
    """n_all and n_bad: buildings, and those whose height is missing or not positive."""
    good = F.coalesce(F.col("building_height") > 0, F.lit(False))
    return buildings.agg(F.count(F.lit(1)).alias("n_all"), F.count_if(~good).alias("n_bad"))


def sight_pairs(buildings: DataFrame, trees: DataFrame, buffer: float = 100.0, observer: str = "facade") -> DataFrame:
    """Building-tree pairs at most ``buffer`` apart: building_id, tree_id, the way from (eye_x, eye_y) to (aim_x, aim_y) with its
    length ``way``, and the heights of both, eye_top and aim_top."""
    if observer not in ("facade", "centroid"):
        raise ValueError("observer must be facade or centroid")
    near = geometry.bbox_distance2("x0", "y0", "x1", "y1", "x", "y") <= buffer * buffer
    exact = F.col("is_box") | (geometry.point_distance("parts", "x", "y") <= buffer)
    homes = buildings.select("building_id", F.col("building_height").cast("double").alias("eye_top"), *BOX, "parts", geometry.is_box("parts").alias("is_box"))
    if observer == "centroid":
        homes = homes.withColumn("middle", geometry.centroid("parts"))
    aims = trees.select("tree_id", F.col("tree_height").cast("double").alias("aim_top"), "x", "y")
    pairs = box_join(homes, aims, max(float(buffer), 25.0), float(buffer), BOX, POINT, near & exact)
    eye = F.col("middle") if observer == "centroid" else geometry.nearest_boundary_point("parts", "is_box", BOX, "x", "y")
    pairs = pairs.select("building_id", "tree_id", "eye_top", "aim_top", eye.alias("eye"), "x", "y")
    pairs = pairs.select("building_id", "tree_id", "eye_top", "aim_top", F.col("eye.x").alias("eye_x"), F.col("eye.y").alias("eye_y"), F.col("x").alias("aim_x"), F.col("y").alias("aim_y"))
    return pairs.withColumn("way", F.sqrt(F.pow(F.col("aim_x") - F.col("eye_x"), 2) + F.pow(F.col("aim_y") - F.col("eye_y"), 2)))


def obstacles(buildings: DataFrame, trees: DataFrame) -> DataFrame:
    """Buildings and crowns as one table: own_building or own_tree (the other is null), rise, box, polygon and whether it is its box."""

    def stood(df: DataFrame, building: Column, tree: Column, height: str) -> DataFrame:
        return df.select(building.alias("own_building"), tree.alias("own_tree"), F.col(height).cast("double").alias("rise"), *(F.col(c).alias(f"o_{c}") for c in BOX), F.col("parts").alias("o_parts"), geometry.is_own_box("parts", BOX).alias("o_is_box"))

    none = F.lit(None).cast("string")
    of_buildings = stood(buildings, F.col("building_id").cast("string"), none, "building_height")
    return of_buildings.unionByName(stood(trees, none, F.col("tree_id").cast("string"), "tree_height"))


def _beside_line(cx: Column, cy: Column, wide: Column, high: Column) -> Column:
    """Whether a box of that centre and size lies wholly on one side of the way's line."""
    dx, dy = F.col("aim_x") - F.col("eye_x"), F.col("aim_y") - F.col("eye_y")
    off = F.abs(dx * (cy - F.col("eye_y")) - dy * (cx - F.col("eye_x")))
    return off > (wide * F.abs(dy) + high * F.abs(dx)) / 2 * (1 + 1e-9) + 1e-9


def shades(pairs: DataFrame, things: DataFrame, size: float = 50.0) -> DataFrame:
    """Per pair with an obstacle on its way: shade_bottom, shade_middle and shade_top, the heights at the tree that are hidden
    from each eye. A pair's own building and tree are no obstacles; nothing stands on a way without length.

    Ways are dealt to the cells that they cross, obstacles to those they touch. A pair may meet an obstacle in several
    cells, which a maximum does not mind.
    """
    ways = pairs.filter("way > 0").withColumns({"w_x0": F.least("eye_x", "aim_x"), "w_y0": F.least("eye_y", "aim_y"), "w_x1": F.greatest("eye_x", "aim_x"), "w_y1": F.greatest("eye_y", "aim_y")})
    side = F.lit(float(size))
    ways = with_cells(ways, size, ("w_x0", "w_y0", "w_x1", "w_y1")).filter(~_beside_line((F.col("_cx") + 0.5) * side, (F.col("_cy") + 0.5) * side, side, side))
    stood = with_cells(things, size, tuple(f"o_{c}" for c in BOX)).withColumnsRenamed({"_cx": "_dx", "_cy": "_dy"})
    x0, y0, x1, y1 = (F.col(f"o_{c}") for c in BOX)
    foreign = ~F.coalesce(F.col("own_building") == F.col("building_id").cast("string"), F.lit(False)) & ~F.coalesce(F.col("own_tree") == F.col("tree_id").cast("string"), F.lit(False))
    meet = (F.col("w_x0") <= x1) & (F.col("w_x1") >= x0) & (F.col("w_y0") <= y1) & (F.col("w_y1") >= y0) & ~_beside_line((x0 + x1) / 2, (y0 + y1) / 2, x1 - x0, y1 - y0)
    met = ways.join(stood, (F.col("_cx") == F.col("_dx")) & (F.col("_cy") == F.col("_dy")) & meet & foreign)
    within = geometry.way_within("o_parts", "o_is_box", tuple(f"o_{c}" for c in BOX), ("eye_x", "eye_y"), ("aim_x", "aim_y"))
    met = met.select("building_id", "tree_id", "eye_top", "rise", "way", within.alias("within")).filter("within IS NOT NULL")
    met = met.withColumns({"near": F.greatest(F.col("within.lo"), MARGIN / F.col("way")), "far": F.least(F.col("within.hi"), 1 - MARGIN / F.col("way"))}).filter("near <= far")
    hidden = []
    for name, share in SHARES.items():
        over = F.col("rise") - F.col("eye_top") * share
        hidden.append(F.max(F.col("eye_top") * share + over / F.when(over >= 0, F.col("near")).otherwise(F.col("far"))).alias(f"shade_{name}"))
    return met.groupBy("building_id", "tree_id").agg(*hidden)


def blocked(pairs: DataFrame, hidden: DataFrame) -> DataFrame:
    """Per pair of ``shades``: blk_<from>_<to> for the nine lines, 1 where it ends in the shade."""
    rows = hidden.join(pairs.select("building_id", "tree_id", "aim_top"), ["building_id", "tree_id"])
    lines = [F.when(F.col("aim_top") * to <= F.col(f"shade_{name}"), 1).otherwise(0).alias(f"blk_{name}_{end}") for name in SHARES for end, to in SHARES.items()]
    return rows.select("building_id", "tree_id", *lines)


def visible_trees(observers: DataFrame, pairs: DataFrame, hidden: DataFrame) -> DataFrame:
    """Per observer: visible_trees_bottom, _middle, _top and visible_trees (from any of them), 0 without trees.

    A tree is visible from an eye if any of its heights is, so if its top is.
    """
    clear = {name: F.coalesce(F.col("aim_top") > F.col(f"shade_{name}"), F.lit(True)) for name in SHARES}
    rows = pairs.select("building_id", "tree_id", "aim_top").join(hidden, ["building_id", "tree_id"], "left")
    counted = [F.count_if(c).alias(f"visible_trees_{name}") for name, c in clear.items()]
    any_clear = clear["bottom"] | clear["middle"] | clear["top"]
    sums = rows.groupBy("building_id").agg(*counted, F.count_if(any_clear).alias("visible_trees"))
    return observers.select("building_id").join(sums, "building_id", "left").na.fill(0, [*(f"visible_trees_{name}" for name in SHARES), "visible_trees"])


#: What a row dealt to a block is, as a sum; and the rows that go back at once.
HOME, STANDS, AIM = 1, 2, 4
BATCH = 1 << 16
_LINES = [(name, end) for name in SHARES for end in SHARES]
ALL = (1 << len(_LINES)) - 1


def alike(w: sightlines.Ways) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ways with an obstacle, as runs of one tree and the same lines that end in the shade: tree, lines as bits, length; and all buildings."""
    rows = np.flatnonzero(w.shade[:, 0] > -np.inf)
    shade, aim, tree, home = w.shade[rows], w.aim[rows], w.tree[rows], w.home[rows]
    bits = np.zeros(len(rows), np.int64)
    for k, (_, end) in enumerate(_LINES):
        bits |= (aim * SHARES[end] <= shade[:, k // 3]).astype(np.int64) << k
    run = tree * (ALL + 1) + bits
    if (run[1:] < run[:-1]).any():
        order = np.argsort(run, kind="stable")
        run, home = run[order], home[order]
    first = np.flatnonzero(np.r_[len(run) > 0, run[1:] != run[:-1]])
    return run[first] // (ALL + 1), (run[first] % (ALL + 1)).astype(np.int16), np.diff(np.r_[first, len(run)]), home


def _in_turn(*sources: Iterator) -> Iterator:
    """One of each in turn, until all are at their end."""
    waiting = list(sources)
    while waiting:
        for source in list(waiting):
            try:
                yield next(source)
            except StopIteration:
                waiting.remove(source)


def _number(*names: str) -> Column:
    """Whether all are there and numbers."""
    return F.expr(" AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(`{c}`)" for c in names))


def _repeated(df: DataFrame, key: str) -> DataFrame:
    """Keys of several rows."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)


def _without(df: DataFrame, key: str, repeated: DataFrame | None, kept: Column, odd: int) -> tuple[DataFrame, DataFrame]:
    """Rows that blocks can take, and the others: those not ``kept`` or of a repeated or null key; ``odd`` are not kept or null."""
    if not odd and repeated is None:
        return df, df.limit(0)  # nothing has to be told a second time
    fine = kept & F.col(key).isNotNull()
    if repeated is None:
        return df.filter(fine), df.filter(~fine)
    return df.filter(fine).join(repeated, key, "left_anti"), df.filter(~fine).unionByName(df.filter(fine).join(repeated, key, "left_semi"))


def _split(looking: DataFrame, trees: DataFrame, stands: DataFrame | None, buffer: float, observer: str) -> tuple[DataFrame, DataFrame, float, list[tuple[DataFrame, DataFrame]]]:
    """Buildings and trees whose pairs blocks can take, the farthest that their ways reach, and the others as sides to join.
    ``stands`` are the buildings that, like all trees, are obstacles; None if there are none.

    Blocks take rectangles with a key of their own; among obstacles that are not all rectangles they take none.
    """
    wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    kept = F.coalesce(F.col("_box") & _number(*BOX, "building_height") & (wide <= max(float(buffer), 50.0)), F.lit(False))
    with_box = lambda df: df.withColumn("_box", geometry.is_own_box("parts", BOX))
    aimed = F.coalesce(_number("x", "y"), F.lit(False))
    # all that has to be known, in one job; keys of one hash are looked at again
    hashes = looking.select(F.lit(0).alias("side"), F.xxhash64("building_id").alias("hash")).unionByName(trees.select(F.lit(1).alias("side"), F.xxhash64("tree_id").alias("hash")))
    repeated = hashes.groupBy("side", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(*(F.coalesce(F.max(F.col("side") == k), F.lit(False)).alias(f"repeated_{k}") for k in (0, 1)))
    odd_homes = F.count_if(~kept | F.col("building_id").isNull()).alias("odd_homes")
    odd_aims = F.count_if(~aimed | F.col("tree_id").isNull()).alias("odd_aims")

    def odd_stands(top: str, name: str) -> Column:
        corners = F.expr(" AND ".join(f"{c} IS NOT NULL" for c in BOX))
        return F.count_if(corners & ~F.coalesce(F.col("_box") & _number(top, *BOX), F.lit(False))).alias(name)

    of_looking, of_aims = [odd_homes, F.max(F.when(kept, wide)).alias("widest")], [odd_aims]
    if stands is not None:
        of_aims.append(odd_stands("tree_height", "odd_crowns"))
        if stands is looking:
            of_looking.append(odd_stands("building_height", "odd_stands"))
    facts = with_box(looking).agg(*of_looking).crossJoin((trees if stands is None else with_box(trees)).agg(*of_aims)).crossJoin(repeated)
    if stands is not None and stands is not looking:
        facts = facts.crossJoin(with_box(stands).agg(odd_stands("building_height", "odd_stands")))
    known = facts.first().asDict()
    if known.get("odd_stands") or known.get("odd_crowns"):
        return looking.limit(0), trees, 0.0, [(looking, trees)]
    of_homes = _repeated(looking, "building_id") if known["repeated_0"] else None
    of_trees = _repeated(trees, "tree_id") if known["repeated_1"] else None
    homes, other_homes = _without(with_box(looking), "building_id", of_homes, kept, known["odd_homes"])
    homes, other_homes = homes.drop("_box"), other_homes.drop("_box")
    aims, other_aims = _without(trees, "tree_id", of_trees, aimed, known["odd_aims"])
    widest = known["widest"] or 0.0
    sides = [(other_homes, trees)] if known["odd_homes"] or of_homes is not None else []
    if known["odd_aims"] or of_trees is not None:
        sides.append((homes, other_aims))
    return homes, aims, float(buffer) + (0.75 * widest if observer == "centroid" else 0.0), sides


def _in_blocks(homes: DataFrame, aims: DataFrame, obstructing: tuple[DataFrame, DataFrame] | None, buffer: float, reach: float, observer: str, kind: str, digits: int = 6) -> DataFrame:
    """Pairs of rectangles and trees, done in numpy. By ``kind``: building_id, tree_id and

    * ``pairs``: ox, oy and sight_len, rounded to ``digits``;
    * ``lines``: no building_id, but ``buildings``, those of whose nine lines to the tree the same ones end in the shade (bits, in the
      order of ``blocked``), for pairs with an obstacle;
    * ``counts``: no tree_id, but for each block the trees seen from the bottom, the middle, the top and any.
    """
    size = max(BLOCK, 5 * float(buffer))
    key, tree_key = homes.schema["building_id"].dataType.simpleString(), aims.schema["tree_id"].dataType.simpleString()
    centre, shaded = observer == "centroid", obstructing is not None

    def rows(df: DataFrame, role: int, top: str, box: tuple[str, str, str, str] = BOX) -> DataFrame:
        ids = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (("building_id", key), ("tree_id", tree_key))]
        return df.select(F.lit(role).cast("byte").alias("role"), *ids, F.col(top).cast("double").alias("top"), *(F.col(c).cast("double").alias(n) for c, n in zip(box, BOX)))

    dealt = [with_cells(rows(homes, HOME, "building_height"), size, BOX, reach), with_cells(rows(aims, AIM, "tree_height", POINT), size, ("x0", "y0", "x0", "y0"))]
    if obstructing is not None:
        dealt += [with_cells(rows(df, STANDS, top), size, BOX, reach) for df, top in zip(obstructing, ("building_height", "tree_height"))]

    def seen(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        role = table["role"].to_numpy()
        some = {r: table.filter(pa.array(role == r)).combine_chunks() for r in (HOME, AIM, STANDS)}
        column = lambda r, c: some[r][c].to_numpy()
        box = lambda r: [column(r, c) for c in BOX]
        # the same code for the same building or tree; trees' codes follow buildings'
        known = [pc.unique(table[c]).drop_null() for c in ("building_id", "tree_id")]
        code = lambda r, k: pc.fill_null(pc.index_in(some[r][("building_id", "tree_id")[k]], known[k]), -1).to_numpy().astype(np.int64)
        codes = len(known[0])
        block = None
        if shaded:
            of_buildings, of_trees = code(STANDS, 0), code(STANDS, 1)
            u, v = key[0].as_py() * size, key[1].as_py() * size
            far = reach + 1.0
            block = sightlines.Block(np.where(of_trees >= 0, of_trees + codes, of_buildings), column(STANDS, "top"), box(STANDS), (u - far, v - far, u + size + far, v + size + far))
        looking = sightlines.Homes(code(HOME, 0), column(HOME, "top"), box(HOME))
        aimed = sightlines.Aims(column(AIM, "x0"), column(AIM, "y0"), column(AIM, "top"), code(AIM, 1) + codes, codes)
        if shaded and len(looking.top):
            block.cover(aimed, looking)
        found = sightlines.ways(looking, aimed, block, float(buffer), centre)
        ids = lambda r, c, at: some[r][c].combine_chunks().take(pa.array(at))

        def batch(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
            home, tree, *values = (np.concatenate(c) for c in zip(*parts))
            return pa.RecordBatch.from_arrays([ids(HOME, "building_id", home), ids(AIM, "tree_id", tree), *map(pa.array, values)], ["building_id", "tree_id", "ox", "oy", "sight_len"])

        def listed(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            tree, bits, counts, home = (np.concatenate(c) for c in zip(*parts))
            ends = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            return pa.RecordBatch.from_arrays([ids(AIM, "tree_id", tree), pa.array(bits), pa.ListArray.from_arrays(ends, ids(HOME, "building_id", home))], ["tree_id", "bits", "buildings"])

        if kind == "counts":
            sums = np.zeros((4, len(looking.top)), np.int64)
            for w in found:
                clear = ~(w.shade >= w.aim[:, None])
                rows = np.flatnonzero(clear.any(1))
                for k, c in enumerate((*clear[rows].T, slice(None))):
                    np.add.at(sums[k], w.home[rows][c], 1)
            at = np.flatnonzero(sums[3])
            yield pa.RecordBatch.from_arrays([ids(HOME, "building_id", at), *(pa.array(x[at]) for x in sums)], ["building_id", *(f"n_{name}" for name in (*SHARES, "any"))])
            return

        if kind == "pairs":
            parts, n = [], 0
            for w in found:
                parts.append([w.home, w.tree, *(np.copysign(np.floor(np.abs(c) * 10.0**digits + 0.5) / 10.0**digits, c) for c in (w.ex, w.ey, w.way))])
                n += len(w)
                if n >= BATCH:
                    yield batch(parts)
                    parts, n = [], 0
            if n:
                yield batch(parts)
            return
        lists, n = [], 0
        listing = ((t, np.full(len(t), ALL, np.int16), c, h) for t, c, h in sightlines.hidden_pairs(looking, aimed, float(buffer)))
        # in turn, so that the JVM takes in the many pairs of the one while the few of the other are looked at
        for part in _in_turn(listing, map(alike, found)):
            lists.append(part)
            n += len(part[3])
            if n >= BATCH:
                yield listed(lists)
                lists, n = [], 0
        if n:
            yield listed(lists)

    columns = {"pairs": f"building_id {key}, tree_id {tree_key}, ox double, oy double, sight_len double", "lines": f"tree_id {tree_key}, bits short, buildings array<{key}>", "counts": ", ".join([f"building_id {key}", *(f"n_{name} long" for name in (*SHARES, "any"))])}
    return reduce(DataFrame.unionByName, dealt).groupBy("_cx", "_cy").applyInArrow(seen, columns[kind])


def sight_lines(buildings: DataFrame, trees: DataFrame, buffer: float = 100.0, observer: str = "facade", digits: int = 6) -> DataFrame:
    """``sight_pairs`` as building_id, tree_id, the eye (ox, oy) and the length sight_len, rounded. Rectangles are done block by block;
    of a tree inside, the lower, right, upper and left side count in this order where several are as near."""
    homes, aims, reach, others = _split(buildings, trees, None, buffer, observer)
    out = [_in_blocks(homes, aims, None, buffer, reach, observer, "pairs", digits)]
    for a, b in others:
        out.append(sight_pairs(a, b, buffer, observer).select("building_id", "tree_id", F.round("eye_x", digits).alias("ox"), F.round("eye_y", digits).alias("oy"), F.round("way", digits).alias("sight_len")))
    return reduce(DataFrame.unionByName, out)


def blocked_lines(buildings: DataFrame, trees: DataFrame, buffer: float = 100.0, observer: str = "facade") -> DataFrame:
    """``blocked`` for all pairs of usable buildings and trees with an obstacle on their way; among rectangles block by block."""
    usable = usable_buildings(buildings)
    things = obstacles(usable, trees)
    homes, aims, reach, others = _split(usable, trees, usable, buffer, observer)
    bits = _in_blocks(homes, aims, (usable, trees), buffer, reach, observer, "lines")
    names = [f"blk_{name}_{end}" for name, end in _LINES]
    told = bits.select("tree_id", "buildings", *(F.shiftright("bits", k).bitwiseAND(F.lit(1)).cast("int").alias(c) for k, c in enumerate(names)))
    out = [told.select(F.explode("buildings").alias("building_id"), "tree_id", *names)]
    for a, b in others:
        pairs = sight_pairs(a, b, buffer, observer)
        out.append(blocked(pairs, shades(pairs, things, max(25.0, buffer / 2))))
    return reduce(DataFrame.unionByName, out)


def visibility(buildings: DataFrame, trees: DataFrame, buffer: float = 100.0, observer: str = "facade", observers: DataFrame | None = None) -> DataFrame:
    """All steps; ``observers`` are the buildings to look from, all usable ones if not given. Among rectangles block by block."""
    usable = usable_buildings(buildings)
    looking = usable if observers is None else usable_buildings(observers)
    things = obstacles(usable, trees)
    homes, aims, reach, others = _split(looking, trees, usable, buffer, observer)
    sums = _in_blocks(homes, aims, (usable, trees), buffer, reach, observer, "counts")
    names = {f"n_{name}": f"visible_trees_{name}" for name in SHARES} | {"n_any": "visible_trees"}
    sums = sums.select("building_id", *(F.col(n).alias(v) for n, v in names.items()))
    for a, b in others:
        pairs = sight_pairs(a, b, buffer, observer)
        sums = sums.unionByName(visible_trees(a.select("building_id").distinct(), pairs, shades(pairs, things, max(25.0, buffer / 2))))
    sums = sums.groupBy("building_id").agg(*(F.sum(v).alias(v) for v in names.values()))
    return looking.select("building_id").join(sums, "building_id", "left").na.fill(0, [*names.values()])

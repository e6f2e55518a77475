"""Trees near buildings (the 3 of the rule) and trees per unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborel.functions import geometry
from arborel.operators.blocks import points_near_boxes
from arborel.operators.grid import BOX, POINT, are_few, box_join


def tall_trees(trees: DataFrame, least_area: float = 10.0, least_height: float = 3.0) -> DataFrame:
    """Trees strictly larger and higher than the thresholds, with a place."""
    return trees.filter((F.col("tree_area") > least_area) & (F.col("tree_height") > least_height) & F.col("x").isNotNull() & F.col("y").isNotNull())


def _boxed(rows: DataFrame, *keys: str, prefix: str = "") -> DataFrame:
    """Keys, box and polygon, and whether the polygon is its box (null then), so that exact tests are done with the box test."""
    return rows.select(*keys, *(F.col(c).alias(prefix + c) for c in BOX), geometry.unless_box("parts").alias(f"{prefix}parts"), geometry.is_box("parts").alias(f"{prefix}is_box"))


def _sent(units: DataFrame, size: float) -> DataFrame:
    """Units, sent to every task if they are few."""
    return F.broadcast(units) if are_few(units, size) else units


def trees_near_buildings(buildings: DataFrame, trees: DataFrame, buffer: float = 100.0, keep_zero: bool = True, least_area: float = 10.0, least_height: float = 3.0) -> DataFrame:
    """Per building: tree_count_<buffer>m, the trees whose centroid (x, y) is at most ``buffer`` from the footprint.

    ``buildings`` has building_id, a box and parts. With ``keep_zero`` buildings without trees count 0,
    else they are left out. Rectangles are counted block by block, others pair by pair, and summed before the shuffle by building.
    """
    name = f"tree_count_{buffer:g}m"
    counts = tree_counts(buildings, trees, [buffer], least_area, least_height)
    if not keep_zero:
        return counts
    return buildings.select("building_id").join(counts, "building_id", "left").select("building_id", F.coalesce(name, F.lit(0)).alias(name))


def tree_counts(buildings: DataFrame, trees: DataFrame, buffers: list[float], least_area: float = 10.0, least_height: float = 3.0) -> DataFrame:
    """``trees_near_buildings`` for several buffers at once, with a column for each: buildings with a tree within the widest."""
    radii = [float(b) for b in buffers]
    widest, names = max(radii), [f"n_{k}" for k in range(len(radii))]
    near = geometry.bbox_distance2("x0", "y0", "x1", "y1", "x", "y") <= widest * widest
    apart = geometry.point_distance("parts", "x", "y")
    kept = tall_trees(trees, least_area, least_height).select("x", "y")
    boxed = _boxed(buildings, "building_id")
    pairs = box_join(boxed.filter("NOT is_box").drop("is_box"), kept, max(widest, 25.0), widest, BOX, POINT, near & (apart <= widest))
    odd = pairs.select("building_id", apart.alias("apart")).groupBy("building_id").agg(*(F.count_if(F.col("apart") <= r).alias(n) for n, r in zip(names, radii)))
    counts = points_near_boxes(boxed.filter("is_box"), kept, "building_id", radii).unionByName(odd)
    return counts.groupBy("building_id").agg(*(F.sum(n).alias(f"tree_count_{b:g}m") for n, b in zip(names, buffers)))


def trees_per_unit(units: DataFrame, trees: DataFrame, codes: list[str], size: float = 250.0, distinct: bool = True) -> DataFrame:
    """Per unit: tree_count, the trees whose whole geometry touches it; a tree on a border counts in every unit it touches.

    ``codes`` may name several rows of ``units`` as one unit; with ``distinct`` a tree counts once in it,
    else once for each row it touches.
    """
    touch = (F.col("t_is_box") & F.col("is_box")) | geometry.polygons_intersect(geometry.or_box("t_parts", tuple(f"t_{c}" for c in BOX)), geometry.or_box("parts", BOX))
    pairs = box_join(_boxed(trees, "tree_id", prefix="t_"), _sent(_boxed(units, *codes), size), size, 0.0, tuple(f"t_{c}" for c in BOX), BOX, touch)
    counted = F.count_distinct("tree_id") if distinct else F.count(F.lit(1))
    return pairs.groupBy(*codes).agg(counted.alias("tree_count"))


def overlay(buildings: DataFrame, units: DataFrame, codes: list[str], size: float = 250.0, point: Column | None = None) -> DataFrame:
    """Each building's unit: the one that holds its point (the centroid where no other is given); the least codes where several do."""
    at = point if point is not None else geometry.centroid("parts")
    points = buildings.select("building_id", at.alias("_at")).select("building_id", F.col("_at.x").alias("x"), F.col("_at.y").alias("y"))
    pairs = box_join(points, _sent(_boxed(units, *codes), size), size, 0.0, POINT, BOX, geometry.in_polygon("parts", "is_box", BOX, "x", "y"))
    return pairs.groupBy("building_id").agg(F.min(F.struct(*codes)).alias("_unit")).select("building_id", *(F.col(f"_unit.{c}").alias(c) for c in codes))


def near_units(features: DataFrame, units: DataFrame, key: str, radius: float = 0.0, size: float = 500.0) -> DataFrame:
    """Features that touch, or are at most ``radius`` from, any of ``units``; members stand for their union."""
    exact = (F.col("f_is_box") & F.col("is_box")) | (geometry.polygon_distance(geometry.or_box("f_parts", tuple(f"f_{c}" for c in BOX)), geometry.or_box("parts", BOX)) <= radius)
    pairs = box_join(_boxed(features, key, prefix="f_"), _boxed(units), size, radius, tuple(f"f_{c}" for c in BOX), BOX, exact)
    return features.join(pairs.select(key).distinct(), key, "left_semi")

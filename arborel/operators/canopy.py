"""Canopy cover of units and around buildings (the 30 of the rule), from polygons or rasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborel.functions import geometry
from arborel.functions.overlay import box_overlap, box_share, overlap_area, round_buffer, shared_area
from arborel.operators import chunks
from arborel.operators.blocks import shared_areas
from arborel.operators.grid import BOX, POINT, are_few, box_join

_TREE_BOX = tuple(f"t_{c}" for c in BOX)


def _trees(trees: DataFrame, *more: str) -> DataFrame:
    return trees.select(*more, *(F.col(c).alias(f"t_{c}") for c in BOX), geometry.unless_box("parts").alias("t_parts"), geometry.is_box("parts").alias("t_is_box"))


def _zones(zones: DataFrame, *keys: str) -> DataFrame:
    return zones.select(*keys, *BOX, geometry.unless_box("parts"), geometry.is_box("parts").alias("is_box"))


def _shared(zones: DataFrame, keys: list[str], crowns: DataFrame, size: float, few: bool = False) -> DataFrame:
    """keys and _part: areas of crowns in zones. Rectangles come summed block by block, or pair by pair with ``few`` zones; pairs with
    other forms one by one."""
    boxes, squares = zones.filter("is_box"), crowns.filter("t_is_box")
    if few:
        out = box_join(squares, F.broadcast(boxes), size, 0.0, _TREE_BOX, BOX).select(*keys, box_overlap(BOX, _TREE_BOX).alias("_part"))
    else:
        out = shared_areas(boxes, squares, keys, BOX, _TREE_BOX)
    odd = []
    if zones.agg(F.bool_and("is_box")).first()[0] is False:
        odd.append((zones.filter("NOT is_box"), crowns))
    if crowns.agg(F.bool_and("t_is_box")).first()[0] is False:
        odd.append((boxes, crowns.filter("NOT t_is_box")))
    for a, b in odd:
        pairs = box_join(a, b, size, 0.0, BOX, _TREE_BOX)
        out = out.unionByName(pairs.select(*keys, shared_area("parts", "t_parts", "is_box", "t_is_box", BOX, _TREE_BOX).alias("_part")))
    return out


def _grown(buildings: DataFrame, buffer: float, quad_segs: int) -> DataFrame:
    """Footprints, grown by ``buffer`` with round corners; all their parts and holes count."""
    rows = buildings.select("building_id", *BOX, "parts")
    if not buffer:
        return rows
    return rows.withColumn("parts", round_buffer(float(buffer), quad_segs)("parts")).withColumns({"x0": F.col("x0") - buffer, "y0": F.col("y0") - buffer, "x1": F.col("x1") + buffer, "y1": F.col("y1") + buffer})


def cover_of_units(units: DataFrame, trees: DataFrame, codes: list[str], stored_area: bool = True, size: float = 250.0) -> DataFrame:
    """Per unit: canopy_cover (percent, 3 decimals; 0 without trees) and total_pixels (its area, rounded).

    With ``stored_area`` a tree that touches a unit counts there with its whole tree_area, else with
    the area of its polygon inside the unit. Rows of equal codes are one unit.
    """
    areas = units.groupBy(*codes).agg(F.sum(geometry.area("parts")).alias("_area"))
    if stored_area:
        pairs = box_join(_trees(trees, "tree_id", "tree_area"), _zones(units, *codes), size, 0.0, _TREE_BOX, BOX)
        touched = pairs.filter((F.col("t_is_box") & F.col("is_box")) | geometry.polygons_intersect(geometry.or_box("t_parts", _TREE_BOX), geometry.or_box("parts", BOX))).select(*codes, "tree_id", "tree_area").distinct()
        sums = touched.groupBy(*codes).agg(F.sum("tree_area").alias("_canopy"))
    else:
        zones = _zones(units, *codes)
        sums = _shared(zones, codes, _trees(trees), size, are_few(zones, size)).groupBy(*codes).agg(F.sum("_part").alias("_canopy"))
    cover = F.round(F.try_divide(F.coalesce("_canopy", F.lit(0.0)) * 100, F.col("_area")), 3)
    return areas.join(sums, codes, "left").select(*codes, cover.alias("canopy_cover"), F.round("_area").cast("long").alias("total_pixels"))


def cover_near_buildings(buildings: DataFrame, trees: DataFrame, buffer: float = 100.0, quad_segs: int = 8, size: float = 100.0) -> DataFrame:
    """Per building: tree_pixels (canopy area within ``buffer`` of the footprint, 3 decimals), total_pixels, canopy_cover.

    The surroundings are the footprint grown by ``buffer``, with round corners of quad_segs steps a quarter;
    0 is the footprint itself. Buildings without trees have 0. A crown in the surroundings of a rectangle has a closed form if it is one too.
    """
    side = max(size, float(buffer))
    shared = shared_area("parts", "t_parts", "is_box", "t_is_box", BOX, _TREE_BOX)
    if buffer:
        square = F.coalesce(geometry.is_box("parts") & (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1")), F.lit(False))
        whole, crowns = buildings.select("building_id", *BOX, "parts", square.alias("_square")), _trees(trees)
        grown = _grown(whole.filter("NOT _square"), buffer, quad_segs)
        plain = whole.filter("_square").select("building_id", *BOX, "parts", *(F.col(c).alias(f"f_{c}") for c in BOX)).withColumns({c: F.col(c) + (-buffer if c[1] == "0" else buffer) for c in BOX})
        corners = [F.col(c) for c in (*(f"f_{c}" for c in BOX), *_TREE_BOX)]
        met = box_join(plain.drop("parts"), crowns.filter("t_is_box").drop("t_parts", "t_is_box"), side, 0.0, BOX, _TREE_BOX)
        parts = met.select("building_id", box_share(float(buffer), quad_segs)(*corners).alias("_part"))
        odd = box_join(plain, crowns.filter("NOT t_is_box"), side, 0.0, BOX, _TREE_BOX)
        parts = parts.unionByName(odd.select("building_id", overlap_area(round_buffer(float(buffer), quad_segs)("parts"), F.col("t_parts")).alias("_part")))
        areas = plain.select("building_id", geometry.convex_buffer_area("parts", float(buffer), quad_segs).alias("_area")).unionByName(grown.select("building_id", geometry.area("parts").alias("_area")))
        pairs = box_join(_zones(grown, "building_id"), crowns, side, 0.0, BOX, _TREE_BOX)
        parts = parts.unionByName(pairs.select("building_id", shared.alias("_part")))
    else:
        areas = buildings.select("building_id", geometry.area("parts").alias("_area"))
        parts = _shared(_zones(buildings, "building_id"), ["building_id"], _trees(trees), side)
    sums = parts.groupBy("building_id").agg(F.sum("_part").alias("_canopy"))
    rows = areas.join(sums, "building_id", "left")
    rows = rows.select("building_id", F.round(F.coalesce("_canopy", F.lit(0.0)), 3).alias("tree_pixels"), F.round("_area").alias("total_pixels"))
    return rows.withColumn("canopy_cover", F.round(F.try_divide(F.col("tree_pixels") * 100, F.col("total_pixels")), 3))


def binarised(pixels: DataFrame, low: float = 3.0, high: float = 60.0) -> DataFrame:
    """Pixels with ``canopy``: 1 where the value is within [low, high], 0 elsewhere, null where there is no data; or chunks of those."""
    if chunks.is_chunks(pixels):
        return chunks.binarised(pixels, low, high)
    return pixels.withColumn("canopy", F.when(F.col("value").isNull() | F.isnan("value"), None).when(F.col("value").between(low, high), 1).otherwise(0))


def merged_tiles(pixels: DataFrame) -> DataFrame:
    """One pixel for each place: where tiles overlap, the first tile with data (by tile_id) counts."""
    if chunks.is_chunks(pixels):
        return chunks.merged(pixels)
    rank = F.struct(F.col("value").isNull() | F.isnan("value"), F.col("tile_id"))
    return pixels.groupBy("x", "y").agg(F.min_by("value", rank).alias("value"), F.min_by("tile_id", rank).alias("tile_id"))


def zonal(zones: DataFrame, pixels: DataFrame, key: list[str], pixel_size: float, all_touched: bool = False, size: float = 250.0, condition: Column | None = None) -> DataFrame:
    """Per zone: canopy_pixels and total_pixels of the binarised pixels (x, y: centres), or chunks of pixels, in its polygons.

    A pixel is in a zone if its centre is, or with ``all_touched`` if any of its square is.
    Pixels without data are in neither count.
    """
    if chunks.is_chunks(pixels):
        return chunks.zonal(zones, pixels, key, all_touched)
    half = pixel_size / 2
    valid = pixels.filter("canopy IS NOT NULL").select("x", "y", "canopy")
    if all_touched:
        square = valid.select("canopy", *((F.col(c[0]) + s * half).alias(f"t_{c}") for c, s in zip(BOX, (-1, -1, 1, 1))))
        square = square.withColumn("t_parts", geometry.rect("t_x0", "t_y0", "t_x1", "t_y1"))
        pairs = box_join(_zones(zones, *key), square, size, 0.0, BOX, _TREE_BOX, F.col("is_box") | geometry.polygons_intersect(geometry.or_box("parts", BOX), "t_parts"))
    else:
        pairs = box_join(_zones(zones, *key), valid, size, 0.0, BOX, POINT, geometry.in_polygon("parts", "is_box", BOX, "x", "y"))
    return pairs.groupBy(*key).agg(F.sum("canopy").alias("canopy_pixels"), F.count("canopy").alias("total_pixels"))


def raster_cover_of_units(units: DataFrame, pixels: DataFrame, codes: list[str], pixel_size: float, all_touched: bool = False) -> DataFrame:
    """Per unit: canopy_cover (percent, 3 decimals; null without valid pixels) and total_pixels."""
    sums = zonal(units, pixels, codes, pixel_size, all_touched)
    rows = units.select(*codes).distinct().join(sums, codes, "left")
    total = F.coalesce("total_pixels", F.lit(0))
    return rows.select(*codes, F.round(F.try_divide(F.col("canopy_pixels") * F.lit(100.0), F.col("total_pixels").cast("double")), 3).alias("canopy_cover"), total.alias("total_pixels"))


def raster_cover_near_buildings(buildings: DataFrame, pixels: DataFrame, pixel_size: float, buffer: float = 0.0, all_touched: bool = True, quad_segs: int = 8) -> DataFrame:
    """Per building with valid pixels: tree_pixels, total_pixels, canopy_cover. Overlapping tiles count twice unless merged before."""
    grown = _grown(buildings, buffer, quad_segs)
    sums = zonal(grown, pixels, ["building_id"], pixel_size, all_touched)
    cover = F.round(F.try_divide(F.col("canopy_pixels") * F.lit(100.0), F.col("total_pixels").cast("double")), 3)
    return sums.filter("total_pixels > 0").select("building_id", F.coalesce("canopy_pixels", F.lit(0)).alias("tree_pixels"), "total_pixels", cover.alias("canopy_cover"))

"""The study area's relations, read by configuration and cached as Parquet with a mark of completeness."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import os
import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborel.config import Config, remote
from arborel.functions import crs, geometry
from arborel.functions.overlay import point_on_surface
from arborel.operators import canopy, cells, graph, parks, tiles, trees
from arborel.operators.grid import BOX, total_bounds
from arborel.sources import footprints, geotiff, osm, sinks, vector


@dataclass(frozen=True)
class Catalog:
    """Relations in canonical columns; each is lazy and covers all geographic codes."""

    units: DataFrame
    buildings: DataFrame
    overlay: DataFrame
    parks: DataFrame
    access: DataFrame
    nodes: DataFrame
    edges: DataFrame


def _export(c: Config, layer: str) -> tuple[str | None, str]:
    """The remote source that a layer names with the path of its export, or None and the layer's own path."""
    path = getattr(c.data, layer)
    source = remote(path)
    if source is None:
        return None, path
    if source not in c.exports:
        raise NotImplementedError(f"data.{layer}: {source} is a remote service; export it and name the export's path in exports.{source}")
    return source, c.exports[source]


def _layer(spark: SparkSession, c: Config, layer: str, table: str | None = None) -> DataFrame:
    return vector.read_vector(spark, getattr(c.data, layer), table, c.crs)


def _trimmed(rows: DataFrame, units: DataFrame, key: str, radius: float) -> DataFrame:
    """Features (with ``parts``) that touch the study area or lie at most ``radius`` from it."""
    return trees.near_units(rows.filter(F.size("parts") > 0).withColumns(geometry.bbox("parts")), units, key, radius)


def _degrees(units: DataFrame, c: Config) -> tuple[float, float, float, float]:
    """The study area's box in degrees, which prunes the files of published footprints."""
    corners = F.array(*(F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a in ("x0", "x1") for b in ("y0", "y1")))
    at = F.explode(F.transform(corners, lambda p: F.struct(*(v.alias(n) for v, n in zip(crs.unproject(p["x"], p["y"], c.crs), ("lon", "lat"))))))
    points = units.select(at.alias("p")).select("p.lon", "p.lat")
    return tuple(total_bounds(points, ("lon", "lat", "lon", "lat")).first())


def _units(spark: SparkSession, c: Config) -> DataFrame:
    rows = vector.polygons(_layer(spark, c, "census_boundaries"))
    return rows.select(*(F.col(g).cast("string").alias(g) for g in c.columns.geo_levels), "parts", *BOX, (geometry.area("parts") / 1e6).alias("area"))


def _buildings(spark: SparkSession, c: Config, units: DataFrame) -> DataFrame:
    source, path = _export(c, "buildings")
    if source == "osm":
        return _trimmed(osm.buildings(osm.elements(spark, path), c.crs, c.osm.building_types), units, "building_id", 0.0)
    if source is not None:
        box = _degrees(units, c)
        rows = footprints.overture_buildings(spark, path, box) if source == "overture" else footprints.open_buildings(spark, path, c.open_buildings.confidence_threshold, box)
        return _trimmed(vector.polygons(vector.reprojected(rows, 4326, c.crs, path)), units, "building_id", 0.0)
    rows = vector.renamed(_layer(spark, c, "buildings", c.columns.building_layer), {c.columns.building_id: "building_id", c.columns.building_height_col: "building_height"})
    return vector.polygons(vector.numeric(rows, "building_height"))


def _parks(spark: SparkSession, c: Config, units: DataFrame) -> DataFrame:
    source, path = _export(c, "parks_sites")
    if source == "osm":
        found = osm.parks(osm.elements(spark, path), c.crs, c.osm.park_tags, c.osm.exclude_private)
        return _trimmed(found, units, "park_id", float(c.osm.fetch_buffer)).select("park_id", "parts", *BOX)
    rows = vector.polygons(vector.renamed(_layer(spark, c, "parks_sites"), {c.columns.park_id: "park_id"}))
    return parks.public_parks(rows, c.columns.park_function_col, c.columns.park_function_value).select("park_id", "parts", *BOX)


def _access(spark: SparkSession, c: Config, sites: DataFrame, edges: DataFrame) -> DataFrame:
    source, path = _export(c, "parks_access")
    if source == "osm":
        rows = parks.access_points(sites, edges, osm.entrances(osm.elements(spark, path), c.crs))
    else:
        names = {c.columns.park_id: "access_id", c.columns.park_access_ref_col: "park_access_ref"}
        rows = vector.points(vector.renamed(_layer(spark, c, "parks_access"), names))
        rows = rows if remote(c.data.parks_sites) else parks.linked_access(rows, sites)
    # the order that breaks ties follows the id, which every run sees alike
    return rows.select("access_id", F.xxhash64("access_id").alias("rank"), "x", "y")


def _roads(spark: SparkSession, c: Config, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    source, path = _export(c, "roads")
    if source == "osm":
        nodes, edges = osm.roads(osm.elements(spark, path), c.crs, c.osm.network_type)
        # of what lies near the study area, the one network that hangs together: stubs at its rim would catch buildings
        edges = graph.largest_component(parks.streets_near_units(edges, units, float(c.osm.fetch_buffer)))
        return parks.nodes_of_streets(nodes, edges), edges
    names = {c.columns.road_edge_start: "u", c.columns.road_edge_end: "v", c.columns.road_edge_length: "w"}
    rows = vector.lines(vector.renamed(_layer(spark, c, "roads", c.columns.road_edge_layer), names))
    rows = rows.withColumn("edge_id", F.xxhash64("path"))
    ends = {"ax": F.col("path")[0]["x"], "ay": F.col("path")[0]["y"], "bx": F.element_at("path", -1)["x"], "by": F.element_at("path", -1)["y"]}
    w = F.col("w").cast("double") if "w" in rows.columns else geometry.line_length("path")
    if c.data.road_nodes and "u" in rows.columns:
        nodes = vector.points(vector.renamed(_layer(spark, c, "road_nodes", c.columns.road_node_layer), {c.columns.road_node_id: "node"}))
        number = lambda x: F.xxhash64(F.col(x).cast("string"))
        return nodes.select(number("node").alias("node"), "x", "y"), rows.select("edge_id", number("u").alias("u"), number("v").alias("v"), w.alias("w"), *(e.alias(k) for k, e in ends.items()))
    nodes, named = graph.derived_nodes(rows)
    return nodes, rows.select("edge_id", w.alias("w"), *(e.alias(k) for k, e in ends.items())).join(named, "edge_id")


def _key(c: Config) -> str:
    """Changes with every option that changes the tables."""
    return hashlib.sha256(json.dumps(dataclasses.asdict(c), sort_keys=True, default=str).encode()).hexdigest()[:12]


def load(spark: SparkSession, c: Config, dggs: str | None = None, resolution: int | None = None) -> Catalog:
    """The catalog; tables that an earlier run with the same configuration has completed are read again.

    With a grid, its cells take the place of the units; each has the codes of the unit that is its parent.
    """
    base = f"{c.output.base_dir.rstrip('/')}/database/{_key(c)}"

    def cached(name: str, make) -> DataFrame:
        path = f"{base}/{name}.parquet"
        if not sinks.is_complete(spark, path):
            sinks.marked_table(make(), path)
        return spark.read.parquet(path)

    units = cached("boundaries", lambda: _units(spark, c))
    buildings = cached("buildings", lambda: _buildings(spark, c, units))
    overlay = cached("overlay", lambda: trees.overlay(buildings, units, list(c.columns.geo_levels), point=point_on_surface("parts")))
    sites = cached("parks", lambda: _parks(spark, c, units))
    roads: list = []

    def road(i: int) -> DataFrame:
        if not roads:
            roads.extend(_roads(spark, c, area))
        return roads[i]

    area = units
    nodes, edges = cached("road_nodes", lambda: road(0)), cached("road_edges", lambda: road(1))
    access = cached("access", lambda: _access(spark, c, sites, edges))

    if dggs is not None:
        system, levels = cells.get_system(dggs), list(c.columns.geo_levels)
        name = system.column_name(resolution)
        whole = units
        units = cached(f"boundaries_{name}", lambda: cells.finished_grid(cells.grid_pairs(whole, levels, system, resolution, c.crs), levels, system, resolution))
        if not units.head(1):
            raise ValueError(f"no {name} cells overlap the study area")
        places = buildings.select("building_id", point_on_surface("parts").alias("p")).select("building_id", "p.x", "p.y")
        overlay = cached(f"overlay_{name}", lambda: cells.cell_overlay(places, units, "building_id", [name, *levels], 500.0))
    return Catalog(units, buildings, overlay, sites, access, nodes, edges)


def tree_table(spark: SparkSession, c: Config, units: DataFrame | None = None, radius: float = 0.0) -> DataFrame:
    """Trees with centroid, height, area and crown; ids follow the crown, so every branch of a plan sees the same.

    With ``units``, files of a folder of GeoPackages that lie more than ``radius`` from all of them are not read. With a tile
    system, of the files that its pattern gives one tile name the newest counts, and files without a name do not.
    """
    if not c.data.trees_dir:
        raise ValueError("data.trees_dir is not set")
    names = {c.columns.tree_height_col: "tree_height", c.columns.tree_area_col: "tree_area"}
    rows = vector.polygons(vector.renamed(_tree_files(spark, c, units, radius), names))
    if "tree_area" not in rows.columns:
        rows = rows.withColumn("tree_area", geometry.area("parts"))
    at = geometry.centroid("parts")
    rows = rows.withColumn("c", at).withColumn("tree_id", F.xxhash64("parts"))
    return rows.select("tree_id", F.col("c.x").alias("x"), F.col("c.y").alias("y"), F.expr("try_cast(tree_height AS DOUBLE)").alias("tree_height"), F.col("tree_area").cast("double").alias("tree_area"), "parts", *BOX)


def _tree_files(spark: SparkSession, c: Config, units: DataFrame | None, radius: float) -> DataFrame:
    path = c.data.trees_dir
    if os.path.splitext(path.rstrip("/"))[1]:
        return vector.read_vector(spark, path, c.columns.tree_layer, c.crs)
    source = vector.geopackage_epsg(spark, path, c.columns.tree_layer)
    wanted = None
    if units is not None and (source is None or crs.projection(source) == crs.projection(c.crs)):
        wanted = vector.files_near(vector.package_boxes(spark, path, c.columns.tree_layer), units, radius)
    if c.tile_system.enabled and c.tile_system.tile_name_pattern:
        # a tile that was surveyed again is there once for each year
        at = F.col("path")
        named = vector.packages(spark, path).select(at, tiles.tile_name(at, c.tile_system.tile_name_pattern).alias("tile_name"), tiles.year(at).alias("year"))
        latest = tiles.newest(named.filter("tile_name IS NOT NULL AND tile_name <> ''")).select("path")
        wanted = latest if wanted is None else wanted.join(latest, "path", "left_semi")
    return vector.reprojected(vector.read_geopackage(spark, path, c.columns.tree_layer, wanted), source, c.crs, path)


def canopy_pixels(spark: SparkSession, c: Config, low: float, high: float, units: DataFrame | None = None, radius: float = 0.0) -> tuple[DataFrame, float]:
    """Binarised chunks of the canopy height tiles and the pixel's size; a tile with another EPSG code, or that cannot be
    decoded, is an error. With ``units``, tiles more than ``radius`` from all of them are not decoded."""
    epsg = int(str(c.crs).split(":")[-1])
    checks = geotiff.checked(spark, c.data.chm_tiles_dir, epsg)
    wrong = checks.filter("epsg IS NOT NULL AND error IS NOT NULL").head(1)
    if wrong:
        raise ValueError(f"{wrong[0]['path']}: {wrong[0]['error']}")
    broken = checks.filter("epsg IS NULL").select("path", "error").limit(20).collect()
    if broken:
        warnings.warn("canopy is missing where these tiles cannot be read: " + "; ".join(f"{r['path']}: {r['error']}" for r in broken), stacklevel=2)
    good = checks.filter("error IS NULL")
    step = good.agg(F.max("pixel")).first()[0]
    wanted = good if units is None else vector.files_near(good, units, radius)
    pixels = geotiff.read_chunks(spark, c.data.chm_tiles_dir, wanted, strict=True)
    return canopy.binarised(canopy.merged_tiles(pixels), low, high), float(step or 1.0)

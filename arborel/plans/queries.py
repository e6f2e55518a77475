"""Queries of the city's operators and the SQL that each is held against."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborel.functions import crs, geohash, geometry, rhealpix, s2
from arborel.operators import canopy, cells, graph, grid, merge, parks, spectral, tiles, trees, visibility
from arborel.operators.grid import BOX
from arborel.plans import city
from arborel.plans.city import with_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


# Distances in SQL: rectangle to point, and rectangle to rectangle, both squared.
_POINT_GAP = "(power(greatest(b.x0 - t.x, 0e0, t.x - b.x1), 2) + power(greatest(b.y0 - t.y, 0e0, t.y - b.y1), 2))"
_TALL = "t.a > 10 AND t.h > 3"


def _t3_sql(radius: int, join: str = "LEFT JOIN") -> str:
    return with_sql("b t", f"SELECT b.building_id, count(t.tree_id) AS tree_count_{radius}m FROM b {join} t ON {_TALL} AND {_POINT_GAP} <= {radius * radius}e0 GROUP BY b.building_id")


def _t3(radius: int, keep_zero: bool = True) -> Query:
    return lambda spark, sf: trees.trees_near_buildings(city.buildings(spark, sf), city.trees(spark, sf), radius, keep_zero)


for _r in (10, 25, 50, 75, 100):
    query(f"t3_count_{_r}m", _t3_sql(_r))(_t3(_r))
query("t3_inner", _t3_sql(100, "JOIN"))(_t3(100, False))


@query("t3_zero_kept", with_sql("b t", f"SELECT n, count(*) AS buildings FROM (SELECT b.building_id, count(t.tree_id) AS n FROM b LEFT JOIN t ON {_TALL} AND {_POINT_GAP} <= 2500e0 GROUP BY b.building_id) GROUP BY n"))
def t3_zero_kept(spark, sf):
    """How many buildings have how many trees within 50 m, none included."""
    return _t3(50)(spark, sf).groupBy(F.col("tree_count_50m").alias("n")).agg(F.count(F.lit(1)).alias("buildings"))


@query("tree_filter", with_sql("t", f"SELECT tree_id, h AS tree_height, round(a, 6) AS tree_area FROM t WHERE {_TALL}"))
def tree_filter(spark, sf):
    return trees.tall_trees(city.trees(spark, sf)).select("tree_id", "tree_height", F.round("tree_area", 6).alias("tree_area"))


_OVERLAY = "SELECT b.building_id, u.r_name, u.n_name FROM b JOIN u ON (b.x0 + b.x1) / 2 >= u.x0 AND (b.x0 + b.x1) / 2 < u.x1 AND (b.y0 + b.y1) / 2 >= u.y0 AND (b.y0 + b.y1) / 2 < u.y1"


def _overlay(spark, sf):
    return trees.overlay(city.buildings(spark, sf), city.units(spark, sf), ["r_name", "n_name"])


query("buildings_overlay", with_sql("b u", _OVERLAY))(_overlay)

_IN = "greatest(greatest(b.x0 - u.x1, u.x0 - b.x1), 0e0)"
_IN_Y = "greatest(greatest(b.y0 - u.y1, u.y0 - b.y1), 0e0)"


@query("buildings_in_region", with_sql("b u", f"SELECT DISTINCT building_id FROM b JOIN u ON u.r_name = 'ASIA' AND power({_IN}, 2) + power({_IN_Y}, 2) = 0"))
def buildings_in_region(spark, sf):
    return trees.near_units(city.buildings(spark, sf), city.units(spark, sf).filter("r_name = 'ASIA'"), "building_id").select("building_id")


@query("buildings_near_region", with_sql("b u", f"SELECT DISTINCT building_id FROM b JOIN u ON u.r_name = 'ASIA' AND power({_IN}, 2) + power({_IN_Y}, 2) <= 22500"))
def buildings_near_region(spark, sf):
    return trees.near_units(city.buildings(spark, sf), city.units(spark, sf).filter("r_name = 'ASIA'"), "building_id", 150.0).select("building_id")


_TOUCH = "t.x - t.r <= u.x1 AND t.x + t.r >= u.x0 AND t.y - t.r <= u.y1 AND t.y + t.r >= u.y0"
_TREES_UNIT = with_sql("u t", f"SELECT n_name, count(*) AS tree_count FROM u JOIN t ON {_TOUCH} GROUP BY n_name")


def _tree_count(spark, sf):
    return trees.trees_per_unit(city.units(spark, sf), city.trees(spark, sf), ["n_name"])


query("tree_count_per_unit", _TREES_UNIT)(_tree_count)


@query("tree_count_per_region", with_sql("u t", f"SELECT r_name, count(DISTINCT tree_id) AS tree_count FROM u JOIN t ON {_TOUCH} GROUP BY r_name"))
def tree_count_per_region(spark, sf):
    return trees.trees_per_unit(city.units(spark, sf), city.trees(spark, sf), ["r_name"])


_SHARE = "greatest(0e0, least(u.x1, t.x + t.r) - greatest(u.x0, t.x - t.r)) * greatest(0e0, least(u.y1, t.y + t.r) - greatest(u.y0, t.y - t.r))"


@query("t30_vector_stored_area", with_sql("u t", f"SELECT n_name, round(coalesce(sum(t.a), 0) * 100 / 1000000e0, 3) AS canopy_cover, 1000000 AS total_pixels FROM u LEFT JOIN t ON {_TOUCH} GROUP BY n_name").replace("1000000 AS", "CAST(1000000 AS BIGINT) AS"))
def t30_vector_stored_area(spark, sf):
    return canopy.cover_of_units(city.units(spark, sf), city.trees(spark, sf), ["n_name"])


_T30 = with_sql("u t", f"SELECT n_name, round(coalesce(sum({_SHARE}) FILTER (t.tree_id IS NOT NULL), 0) * 100 / 1000000e0, 3) AS canopy_cover, CAST(1000000 AS BIGINT) AS total_pixels FROM u LEFT JOIN t ON {_TOUCH} GROUP BY n_name")


def _t30(spark, sf):
    return canopy.cover_of_units(city.units(spark, sf), city.trees(spark, sf), ["n_name"], stored_area=False)


query("t30_vector_clipped", _T30)(_t30)

_T30B = with_sql(
    "b t",
    "SELECT building_id, tree_pixels, total_pixels, round(tree_pixels * 100 / total_pixels, 3) AS canopy_cover FROM (SELECT b.building_id, round(coalesce(sum(greatest(0e0, least(b.x1, t.x + t.r) - greatest(b.x0, t.x - t.r)) * greatest(0e0, least(b.y1, t.y + t.r) - greatest(b.y0, t.y - t.r))) FILTER (t.tree_id IS NOT NULL), 0), 3) AS tree_pixels, round(any_value((b.x1 - b.x0) * (b.y1 - b.y0))) AS total_pixels FROM b LEFT JOIN t ON t.x - t.r <= b.x1 AND t.x + t.r >= b.x0 AND t.y - t.r <= b.y1 AND t.y + t.r >= b.y0 GROUP BY b.building_id)",
)


def _t30_buildings(spark, sf):
    return canopy.cover_near_buildings(city.buildings(spark, sf), city.trees(spark, sf), 0.0)


query("t30_buildings_vector_0m", _T30B)(_t30_buildings)


@query("t30_buildings_vector_25m")
def t30_buildings_vector_25m(spark, sf):
    """Crowns within 25 m; the corner arcs have no closed form in SQL."""
    return canopy.cover_near_buildings(city.buildings(spark, sf), city.trees(spark, sf), 25.0)


_CANOPY = "CASE WHEN px.v IS NULL THEN NULL WHEN px.v BETWEEN 3 AND 60 THEN 1 ELSE 0 END"


def _binary(spark):
    return canopy.binarised(canopy.merged_tiles(city.chunks(spark)))


@query("raster_binarise", with_sql("px", f"SELECT coalesce({_CANOPY}, -1) AS canopy, count(*) AS n FROM px GROUP BY 1"))
def raster_binarise(spark, sf):
    pixels = canopy.binarised(canopy.merged_tiles(city.pixels(spark)))
    return pixels.groupBy(F.coalesce("canopy", F.lit(-1)).alias("canopy")).agg(F.count(F.lit(1)).alias("n"))


@query("raster_merged", with_sql("px", "SELECT x, y, v AS value, CAST(CASE WHEN i < 250 THEN 0 ELSE 1 END AS INTEGER) AS tile_id FROM px"))
def raster_merged(spark, sf):
    """All pixels of the two tiles, merged, with the tile that counted: the first where both have data or neither has."""
    return canopy.merged_tiles(city.pixels(spark)).select("x", "y", "value", "tile_id")


@query("t30_raster", with_sql("u px", f"SELECT n_name, round(sum({_CANOPY}) * 100e0 / count(px.v), 3) AS canopy_cover, count(px.v) AS total_pixels FROM u JOIN px ON px.x >= u.x0 AND px.x < u.x1 AND px.y >= u.y0 AND px.y < u.y1 GROUP BY n_name"))
def t30_raster(spark, sf):
    return canopy.raster_cover_of_units(city.units(spark, sf), _binary(spark), ["n_name"], city.PIXEL)


def _raster_buildings(condition: str) -> str:
    return with_sql("b px", f"SELECT building_id, CAST(sum({_CANOPY}) AS BIGINT) AS tree_pixels, count(px.v) AS total_pixels, round(sum({_CANOPY}) * 100e0 / count(px.v), 3) AS canopy_cover FROM b JOIN px ON {condition} AND px.v IS NOT NULL GROUP BY building_id")


@query("t30_buildings_raster", _raster_buildings("px.x >= b.x0 AND px.x < b.x1 AND px.y >= b.y0 AND px.y < b.y1"))
def t30_buildings_raster(spark, sf):
    return canopy.raster_cover_near_buildings(city.buildings(spark, sf), _binary(spark), city.PIXEL, all_touched=False)


@query("t30_buildings_raster_touched", _raster_buildings("px.x - 5 <= b.x1 AND px.x + 5 >= b.x0 AND px.y - 5 <= b.y1 AND px.y + 5 >= b.y0"))
def t30_buildings_raster_touched(spark, sf):
    return canopy.raster_cover_near_buildings(city.buildings(spark, sf), _binary(spark), city.PIXEL)


_EUCLID = with_sql(
    "b p",
    "SELECT building_id, closest_park_site_id, distance_euclidean FROM (SELECT b.building_id, p.park_id AS closest_park_site_id, round(sqrt(power(greatest(b.x0 - p.x1, p.x0 - b.x1, 0e0), 2) + power(greatest(b.y0 - p.y1, p.y0 - b.y1, 0e0), 2)), 1) AS distance_euclidean, row_number() OVER (PARTITION BY b.building_id ORDER BY power(greatest(b.x0 - p.x1, p.x0 - b.x1, 0e0), 2) + power(greatest(b.y0 - p.y1, p.y0 - b.y1, 0e0), 2), p.park_id) AS r FROM b, p) WHERE r = 1",
)


def _euclid(spark, sf):
    return parks.euclidean(city.buildings(spark, sf), city.parks(spark, sf))


query("park_euclid", _EUCLID)(_euclid)

_SNAP = "(SELECT {key}, node, snap, x, y FROM (SELECT q.{key}, n.node, n.x, n.y, sqrt(power(q.x - n.x, 2) + power(q.y - n.y, 2)) AS snap, row_number() OVER (PARTITION BY q.{key} ORDER BY sqrt(power(q.x - n.x, 2) + power(q.y - n.y, 2)), n.node) AS r FROM {of} q, n) WHERE r = 1)"
_CENTRES = "(SELECT building_id, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM b)"


@query("road_snap", with_sql("b n", f"SELECT building_id, node, round(snap, 6) AS snap FROM {_SNAP.format(key='building_id', of=_CENTRES)}"))
def road_snap(spark, sf):
    centres = city.buildings(spark, sf).select("building_id", geometry.centroid("parts").alias("c")).select("building_id", "c.x", "c.y")
    return parks.snapped(centres, city.road_nodes(spark), "building_id").select("building_id", "node", F.round("snap", 6).alias("snap"))


_NETWORK = with_sql(
    "b p g n",
    f", home AS {_SNAP.format(key='building_id', of=_CENTRES)}, gate AS {_SNAP.format(key='rank', of='g')}, "
    "ways AS (SELECT h.building_id, ga.rank, ga.snap + abs(h.x - ga.x) + abs(h.y - ga.y) AS d, h.snap FROM home h, gate ga), "
    "best AS (SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY round(d, 6), rank) AS r FROM ways) "
    "SELECT best.building_id, g.access_id AS closest_park_access_id, round(snap + d, 1) AS distance_manhattan FROM best JOIN g USING (rank) WHERE r = 1",
)


def _network(spark, sf):
    return parks.network(city.buildings(spark, sf), city.gates(spark, sf), city.road_nodes(spark), city.road_edges(spark))


query("park_network", _NETWORK)(_network)


@query("park_network_blocks", _NETWORK)
def park_network_blocks(spark, sf):
    """The same distances with the graph cut into blocks of 1.5 km, which hand labels to each other."""
    return parks.network(city.buildings(spark, sf), city.gates(spark, sf), city.road_nodes(spark), city.road_edges(spark), block=1500.0)


_T300 = f"SELECT building_id, closest_park_access_id, distance_manhattan, closest_park_site_id, distance_euclidean FROM ({_NETWORK}) JOIN ({_EUCLID}) USING (building_id)"


def _t300(spark, sf):
    return parks.near_parks(_network(spark, sf), _euclid(spark, sf))


query("t300_combined", _T300)(_t300)


@query("streets_near_units", with_sql("u e", "SELECT DISTINCT edge_id FROM e JOIN u ON u.r_name = 'ASIA' AND power(greatest(least(ax, bx) - x1, x0 - greatest(ax, bx), 0e0), 2) + power(greatest(least(ay, by_) - y1, y0 - greatest(ay, by_), 0e0), 2) <= 1000000"))
def streets_near_units(spark, sf):
    some = city.units(spark, sf).filter("r_name = 'ASIA'")
    return parks.streets_near_units(city.road_edges(spark), some, 1000.0).select("edge_id")


@query("street_nodes", with_sql("n e", "SELECT node FROM n WHERE node IN (SELECT u FROM e UNION SELECT v FROM e)"))
def street_nodes(spark, sf):
    return parks.nodes_of_streets(city.road_nodes(spark), city.road_edges(spark)).select("node")


@query("parallel_street_keys", with_sql("e", "SELECT edge_id, row_number() OVER (PARTITION BY u // 2, v // 2 ORDER BY edge_id) - 1 AS key FROM e"))
def parallel_street_keys(spark, sf):
    """Streets between pairs of nodes, which makes many of them parallel."""
    pairs = city.road_edges(spark).select("edge_id", F.floor(F.col("u") / 2).alias("u"), F.floor(F.col("v") / 2).alias("v"))
    return graph.edge_keys(pairs).select("edge_id", "key")


@query("total_bounds", with_sql("b", "SELECT round(min(x0), 6) AS x0, round(min(y0), 6) AS y0, round(max(x1), 6) AS x1, round(max(y1), 6) AS y1 FROM b"))
def total_bounds(spark, sf):
    return grid.total_bounds(city.buildings(spark, sf)).select(*(F.round(c, 6).alias(c) for c in BOX))


@query("road_components", with_sql("n", f"SELECT node, CAST(CASE WHEN node < {10 * city.LINES} THEN 0 ELSE {10 * city.LINES} END AS BIGINT) AS component FROM n"))
def road_components(spark, sf):
    """The lattice without the streets between its tenth and eleventh lines."""
    cut = city.road_edges(spark).filter("NOT (ax = 2250 AND bx = 2500)")
    return graph.node_components(cut)


@query("largest_component", with_sql("e", "SELECT edge_id FROM e WHERE ax >= 2500"))
def largest_component(spark, sf):
    return graph.largest_component(city.road_edges(spark).filter("NOT (ax = 2250 AND bx = 2500)")).select("edge_id")


@query("derive_nodes", with_sql("e", ", ends AS (SELECT edge_id, 0 AS side, ax AS x, ay AS y FROM e UNION ALL SELECT edge_id, 1, bx, by_ FROM e) SELECT row_number() OVER (ORDER BY min(edge_id * 2 + side)) - 1 AS node, x, y FROM ends GROUP BY x, y"))
def derive_nodes(spark, sf):
    lines = city.road_edges(spark).select("edge_id", F.expr("array(named_struct('x', ax + 0.01, 'y', ay), named_struct('x', bx, 'y', by - 0.02))").alias("path"))
    return graph.derived_nodes(lines)[0]


_ACCESS = with_sql(
    "p",
    f", l AS (SELECT CAST(range AS DOUBLE) * 250 AS pos FROM range({city.LINES})), "
    "c AS (SELECT park_id, pos AS x, unnest([y0, y1]) AS y FROM p JOIN l ON pos > x0 AND pos < x1 UNION ALL SELECT park_id, unnest([x0, x1]), pos FROM p JOIN l ON pos > y0 AND pos < y1 "
    "UNION ALL SELECT park_id, l.pos, (greatest(y0, m.pos) + least(y1, m.pos + 250)) / 2 FROM p JOIN l ON l.pos IN (x0, x1) JOIN l m ON m.pos < 5000 AND greatest(y0, m.pos) < least(y1, m.pos + 250) "
    "UNION ALL SELECT park_id, (greatest(x0, m.pos) + least(x1, m.pos + 250)) / 2, l.pos FROM p JOIN l ON l.pos IN (y0, y1) JOIN l m ON m.pos < 5000 AND greatest(x0, m.pos) < least(x1, m.pos + 250)), "
    "d AS (SELECT park_id, min((round(x, 6), round(y, 6))) AS q FROM c WHERE x BETWEEN 0 AND 5000 AND y BETWEEN 0 AND 5000 GROUP BY park_id, round(x), round(y)), "
    "a AS (SELECT park_id, q[1] AS x, q[2] AS y FROM d UNION ALL SELECT park_id, (x0 + x1) / 2, (y0 + y1) / 2 FROM p WHERE park_id NOT IN (SELECT park_id FROM d)) "
    "SELECT park_id || '_acc' || (row_number() OVER (PARTITION BY park_id ORDER BY x, y) - 1) AS access_id, park_id, round(x, 4) AS x, round(y, 4) AS y FROM a",
)


@query("park_access_points", _ACCESS)
def park_access_points(spark, sf):
    found = parks.access_points(city.parks(spark, sf), city.road_edges(spark))
    return found.select("access_id", "park_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


# Visibility: pairs, lines and obstacles of rectangles; a segment is clipped by slabs.
_VIS = (
    f", tt AS (SELECT tree_id, x, y, h, r FROM t WHERE {_TALL}), bb AS (SELECT * FROM b WHERE h > 0), "
    "pr0 AS (SELECT b.building_id, t.tree_id, b.h AS bh, t.h AS th, t.x AS tx, t.y AS ty, b.x0, b.y0, b.x1, b.y1, t.x >= b.x0 AND t.x <= b.x1 AND t.y >= b.y0 AND t.y <= b.y1 AS inside FROM bb b JOIN tt t ON " + _POINT_GAP + " <= 10000e0), "
    "pr1 AS (SELECT *, least(ty - y0, x1 - tx, y1 - ty, tx - x0) AS m FROM pr0), "
    "pr AS (SELECT building_id, tree_id, bh, th, tx, ty, "
    "CASE WHEN NOT inside THEN greatest(x0, least(tx, x1)) WHEN m = ty - y0 THEN tx WHEN m = x1 - tx THEN x1 WHEN m = y1 - ty THEN tx ELSE x0 END AS ox, "
    "CASE WHEN NOT inside THEN greatest(y0, least(ty, y1)) WHEN m = ty - y0 THEN y0 WHEN m = x1 - tx THEN ty WHEN m = y1 - ty THEN y1 ELSE ty END AS oy FROM pr1), "
    "pl AS (SELECT *, sqrt(power(tx - ox, 2) + power(ty - oy, 2)) AS len FROM pr), "
    "ob AS (SELECT 'b' AS kind, building_id AS id, h, x0, y0, x1, y1 FROM bb UNION ALL SELECT 't', tree_id, h, x - r, y - r, x + r, y + r FROM tt), "
    "hit AS (SELECT pl.*, ob.h AS obs_h, "
    "CASE WHEN tx = ox THEN CASE WHEN ox BETWEEN x0 AND x1 THEN 0e0 END ELSE least((x0 - ox) / (tx - ox), (x1 - ox) / (tx - ox)) END AS xa, CASE WHEN tx = ox THEN 1e0 ELSE greatest((x0 - ox) / (tx - ox), (x1 - ox) / (tx - ox)) END AS xb, "
    "CASE WHEN ty = oy THEN CASE WHEN oy BETWEEN y0 AND y1 THEN 0e0 END ELSE least((y0 - oy) / (ty - oy), (y1 - oy) / (ty - oy)) END AS ya, CASE WHEN ty = oy THEN 1e0 ELSE greatest((y0 - oy) / (ty - oy), (y1 - oy) / (ty - oy)) END AS yb "
    "FROM pl JOIN ob ON least(ox, tx) <= x1 AND greatest(ox, tx) >= x0 AND least(oy, ty) <= y1 AND greatest(oy, ty) >= y0 AND NOT (kind = 'b' AND id = building_id) AND NOT (kind = 't' AND id = tree_id) WHERE len > 0), "
    "cut AS (SELECT *, greatest(xa, ya, 0e0) AS lo, least(xb, yb, 1e0) AS hi FROM hit WHERE xa IS NOT NULL AND ya IS NOT NULL), "
    "f AS (SELECT building_id, tree_id, bh, th, obs_h, greatest(lo, 0.05e0 / len) AS f_lo, least(hi, 1 - 0.05e0 / len) AS f_hi FROM cut WHERE lo <= hi), "
    "k AS (SELECT building_id, tree_id, "
    + ", ".join(
        f"max(CASE WHEN obs_h >= least({a} + f_lo * ({z} - {a}), {a} + f_hi * ({z} - {a})) THEN 1 ELSE 0 END) AS blk_{i}_{j}"
        for i, a in (("bottom", "0e0"), ("middle", "bh / 2"), ("top", "bh"))
        for j, z in (("bottom", "0e0"), ("middle", "th / 2"), ("top", "th"))
    )
    + " FROM f WHERE f_lo <= f_hi GROUP BY building_id, tree_id) "
)


def _vis_sql(body: str) -> str:
    return with_sql("b t", _VIS + body)


def _vis_inputs(spark, sf):
    return visibility.usable_buildings(city.buildings(spark, sf)), trees.tall_trees(city.trees(spark, sf))


@query("visibility_pairs", _vis_sql("SELECT building_id, tree_id, round(ox, 6) AS ox, round(oy, 6) AS oy, round(len, 6) AS sight_len FROM pl"))
def visibility_pairs(spark, sf):
    return visibility.sight_lines(*_vis_inputs(spark, sf))


@query("visibility_blocked", _vis_sql("SELECT * FROM k"))
def visibility_blocked(spark, sf):
    return visibility.blocked_lines(*_vis_inputs(spark, sf))


def _seen(level: str) -> str:
    return "(" + " OR ".join(f"coalesce(blk_{level}_{j}, 0) = 0" for j in ("bottom", "middle", "top")) + ")"


_COUNTS = (
    f"SELECT bb.building_id, count(*) FILTER (v.tree_id IS NOT NULL AND {_seen('bottom')}) AS visible_trees_bottom, count(*) FILTER (v.tree_id IS NOT NULL AND {_seen('middle')}) AS visible_trees_middle, count(*) FILTER (v.tree_id IS NOT NULL AND {_seen('top')}) AS visible_trees_top, count(*) FILTER (v.tree_id IS NOT NULL AND ({_seen('bottom')} OR {_seen('middle')} OR {_seen('top')})) AS visible_trees FROM bb LEFT JOIN (SELECT pl.building_id, pl.tree_id, k.* EXCLUDE (building_id, tree_id) FROM pl LEFT JOIN k USING (building_id, tree_id)) v ON v.building_id = bb.building_id GROUP BY bb.building_id"
)


@query("visibility_counts", _vis_sql(_COUNTS))
def visibility_counts(spark, sf):
    return visibility.visibility(city.buildings(spark, sf), trees.tall_trees(city.trees(spark, sf)))


# From a building's middle; the relations of pairs, lines and obstacles are the same otherwise.
_FROM = _VIS[_VIS.index("CASE WHEN NOT inside") : _VIS.index(" FROM pr1)")]


@query("visibility_centroid", with_sql("b t", _VIS.replace(_FROM, "(x0 + x1) / 2 AS ox, (y0 + y1) / 2 AS oy") + _COUNTS))
def visibility_centroid(spark, sf):
    return visibility.visibility(city.buildings(spark, sf), trees.tall_trees(city.trees(spark, sf)), observer="centroid")


@query("height_quality", with_sql("b", "SELECT count(*) AS n_all, CAST(sum(CASE WHEN h IS NULL OR h <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad FROM b"))
def height_quality(spark, sf):
    return visibility.height_quality(city.buildings(spark, sf))


# Roll-up.
_UNITS = with_sql("u", "SELECT DISTINCT n_name, r_name FROM u")
_MERGE_T30 = f"SELECT r_name, round(sum(canopy_cover * total_pixels) / sum(total_pixels), 2) AS canopy_cover FROM ({_T30}) LEFT JOIN ({_UNITS}) USING (n_name) GROUP BY r_name"
_MERGE_TREES = f"SELECT r_name, CAST(sum(tree_count) AS BIGINT) AS total_trees FROM ({_TREES_UNIT}) LEFT JOIN ({_UNITS}) USING (n_name) GROUP BY r_name"
_OVERLAY_SQL = with_sql("b u", _OVERLAY)
_MERGE_T30B = f"SELECT r_name, round(avg(canopy_cover), 2) AS building_canopy_cover_0m FROM ({_T30B}) LEFT JOIN ({_OVERLAY_SQL}) USING (building_id) GROUP BY r_name"
_METRICS = f"SELECT t300.*, coalesce(tree_count_25m, 0) AS tree_count_25m, coalesce(tree_count_100m, 0) AS tree_count_100m FROM ({_T300}) t300 LEFT JOIN ({_t3_sql(25, 'JOIN')}) USING (building_id) LEFT JOIN ({_t3_sql(100, 'JOIN')}) USING (building_id)"
_MEANS = f"SELECT r_name, round(avg(tree_count_25m), 2) AS tree_count_25m, round(avg(tree_count_100m), 2) AS tree_count_100m, round(avg(distance_manhattan), 2) AS park_distance_manhattan, round(avg(distance_euclidean), 2) AS park_distance_euclidean FROM ({_METRICS}) LEFT JOIN ({_OVERLAY_SQL}) USING (building_id) GROUP BY r_name"


@query("merge_t30", _MERGE_T30)
def merge_t30(spark, sf):
    return merge.canopy(_t30(spark, sf), city.units(spark, sf), "r_name", "n_name")


@query("merge_tree_totals", _MERGE_TREES)
def merge_tree_totals(spark, sf):
    return merge.tree_totals(_tree_count(spark, sf), city.units(spark, sf), "r_name", "n_name")


@query("merge_t30_buildings", _MERGE_T30B)
def merge_t30_buildings(spark, sf):
    return merge.building_canopy({0: _t30_buildings(spark, sf)}, _overlay(spark, sf), "r_name")


@query("merge_t3_t300", _METRICS)
def merge_t3_t300(spark, sf):
    b = city.buildings(spark, sf)
    return merge.building_metrics(_t300(spark, sf), b, dict.fromkeys((25, 100), trees.tree_counts(b, city.trees(spark, sf), [25, 100])))


@query("merge_units", _MEANS)
def merge_units(spark, sf):
    return merge.building_means(merge_t3_t300(spark, sf), _overlay(spark, sf), "r_name", [25, 100])


_SPECTRAL = (
    "WITH v AS (SELECT user_id AS pixel, ts, event_id, label AS unit, abs(CAST(embedding[5] AS DOUBLE)) + 1 AS nir, abs(CAST(embedding[9] AS DOUBLE)) + 1 AS red, abs(CAST(embedding[13] AS DOUBLE)) + 1 AS green, abs(CAST(embedding[17] AS DOUBLE)) + 1 AS swir FROM events JOIN embeddings ON user_id = vec_id WHERE value % 100 < 60 AND ts >= TIMESTAMP '2000-01-01' AND ts < TIMESTAMP '2100-01-01'), "
    "c AS (SELECT pixel, unit, max((nir - red) / (nir + red)) AS NDVI, max((green - nir) / (green + nir)) AS NDWI, max((swir - nir) / (swir + nir)) AS NDBI FROM v GROUP BY pixel, unit) "
)
_INDICES = ["NDVI", "NDWI", "NDBI"]


def _composite(spark, sf):
    kept = spectral.indexed(city.scenes(spark, sf), _INDICES, "2000-01-01", "2100-01-01", 60.0)
    return spectral.composite(kept, _INDICES, ("pixel", "unit"))


@query("spectral_composite", _SPECTRAL + "SELECT pixel, unit, " + ", ".join(f"round({i}, 9) AS {i}" for i in _INDICES) + " FROM c")
def spectral_composite(spark, sf):
    return _composite(spark, sf).select("pixel", "unit", *(F.round(i, 9).alias(i) for i in _INDICES))


@query("spectral_median", _SPECTRAL + "SELECT unit, " + ", ".join(f"round(median({i}), 9) AS {i}" for i in _INDICES) + " FROM c GROUP BY unit")
def spectral_median(spark, sf):
    return spectral.medians(_composite(spark, sf), _INDICES, "unit").select("unit", *(F.round(i, 9).alias(i) for i in _INDICES))


_SPECTRAL_UNITS = _SPECTRAL.rstrip() + ", m AS (SELECT unit, " + ", ".join(f"median({i}) AS {i}" for i in _INDICES) + " FROM c GROUP BY unit), un AS (SELECT n_name, r_name, n_nationkey AS unit FROM nation JOIN region ON n_regionkey = r_regionkey) SELECT r_name, " + ", ".join(f"round(avg({i}), 2) + 0e0 AS {i}" for i in _INDICES) + " FROM m JOIN un USING (unit) GROUP BY r_name"
_SPECTRAL_UNITS = _SPECTRAL_UNITS


def _spectral_by_nation(spark, sf):
    nation = spark.read.parquet(f"{sf}/nation.parquet").select("n_name", F.col("n_nationkey").alias("unit"))
    return spectral.medians(_composite(spark, sf), _INDICES, "unit").join(nation, "unit").select("n_name", *_INDICES)


@query("merge_spectral", _SPECTRAL_UNITS)
def merge_spectral(spark, sf):
    return merge.spectral_means(_spectral_by_nation(spark, sf), city.units(spark, sf), "r_name", "n_name")


@query(
    "merge_all",
    f"SELECT m.r_name, coalesce(total_trees, 0) AS total_trees, tree_count_25m, tree_count_100m, canopy_cover, building_canopy_cover_0m, park_distance_manhattan, park_distance_euclidean, NDVI, NDWI, NDBI FROM ({_MEANS}) m LEFT JOIN ({_MERGE_T30}) USING (r_name) LEFT JOIN ({_SPECTRAL_UNITS}) USING (r_name) LEFT JOIN ({_MERGE_TREES}) USING (r_name) LEFT JOIN ({_MERGE_T30B}) USING (r_name)",
)
def merge_all(spark, sf):
    canopy_rows = merge.with_spectral(merge_t30(spark, sf), merge_spectral(spark, sf), "r_name")
    return merge.merged(merge_units(spark, sf), canopy_rows, merge_tree_totals(spark, sf), merge_t30_buildings(spark, sf), "r_name", [25, 100], [0])


# Grids. A cell's name is spelt from the bits of its column and row, the longitude's bit first.
def _geohash_sql(i: str, j: str, precision: int) -> str:
    nx, ny = geohash.bits(precision)
    return (
        f"list_reduce(list_transform(range({precision}), lambda c: substr('{geohash.DIGITS}', CAST(1 + list_sum(list_transform(range(5), lambda q: "
        f"CASE WHEN (5*c + q) % 2 = 0 THEN (({i} >> CAST({nx - 1} - (5*c + q) // 2 AS INTEGER)) & 1) ELSE (({j} >> CAST({ny - 1} - (5*c + q) // 2 AS INTEGER)) & 1) END << CAST(4 - q AS INTEGER))) AS INTEGER), 1)), lambda a, z: a || z)"
    )


def _cell_index(lon: str, lat: str, precision: int) -> tuple[str, str]:
    w, h = geohash.cell_size(precision)
    return f"CAST(floor(({lon} + 180e0) / CAST('{w!r}' AS DOUBLE)) AS BIGINT)", f"CAST(floor(({lat} + 90e0) / CAST('{h!r}' AS DOUBLE)) AS BIGINT)"


_LON, _LAT = "(0.10e0 + (x0 + x1) / 2 / 1e5)", "(52.20e0 + (y0 + y1) / 2 / 1e5)"


@query("geohash_encode", with_sql("b", f"SELECT building_id, {_geohash_sql(*_cell_index(_LON, _LAT, 9), 9)} AS geohash_9 FROM b"))
def geohash_encode(spark, sf):
    b = city.buildings(spark, sf)
    lon, lat = 0.10 + (F.col("x0") + F.col("x1")) / 2 / 1e5, 52.20 + (F.col("y0") + F.col("y1")) / 2 / 1e5
    return b.select("building_id", cells.get_system("geohash").cell(lon, lat, 9).alias("geohash_9"))


_P = 6
_W, _H = geohash.cell_size(_P)
_COVER = (
    f", ud AS (SELECT r_name, n_name, 0.10e0 + x0 / 1e5 AS x0, 52.20e0 + y0 / 1e5 AS y0, 0.10e0 + x1 / 1e5 AS x1, 52.20e0 + y1 / 1e5 AS y1 FROM u), "
    f"ci AS (SELECT r_name, n_name, ud.x0, ud.y0, ud.x1, ud.y1, unnest(range(CAST(floor((x0 + 180e0) / CAST('{_W!r}' AS DOUBLE)) AS BIGINT), CAST(floor((x1 + 180e0) / CAST('{_W!r}' AS DOUBLE)) AS BIGINT) + 1)) AS i FROM ud), "
    f"cj AS (SELECT *, unnest(range(CAST(floor((y0 + 90e0) / CAST('{_H!r}' AS DOUBLE)) AS BIGINT), CAST(floor((y1 + 90e0) / CAST('{_H!r}' AS DOUBLE)) AS BIGINT) + 1)) AS j FROM ci), "
    f"cc AS (SELECT *, {_geohash_sql('i', 'j', _P)} AS cell, i * CAST('{_W!r}' AS DOUBLE) - 180 AS cx0, j * CAST('{_H!r}' AS DOUBLE) - 90 AS cy0, i * CAST('{_W!r}' AS DOUBLE) - 180 + CAST('{_W!r}' AS DOUBLE) AS cx1, j * CAST('{_H!r}' AS DOUBLE) - 90 + CAST('{_H!r}' AS DOUBLE) AS cy1 FROM cj), "
    "rk AS (SELECT cell, r_name, n_name, cx0, cy0, cx1, cy1, row_number() OVER (PARTITION BY cell ORDER BY ((cx0 + cx1) / 2 >= x0 AND (cx0 + cx1) / 2 < x1 AND (cy0 + cy1) / 2 >= y0 AND (cy0 + cy1) / 2 < y1) DESC, "
    "round(greatest(0e0, least(x1, cx1) - greatest(x0, cx0)) * greatest(0e0, least(y1, cy1) - greatest(y0, cy0)), 15) DESC, r_name, n_name) AS place FROM cc) "
)


def _grid(spark, sf):
    system = cells.get_system("geohash")
    return cells.finished_grid(cells.grid_pairs(city.degrees(city.units(spark, sf)), ["r_name", "n_name"], system, _P), ["r_name", "n_name"], system, _P)


@query("geohash_cover", with_sql("u", _COVER + "SELECT DISTINCT cell FROM cc"))
def geohash_cover(spark, sf):
    return cells.grid_pairs(city.degrees(city.units(spark, sf)), ["r_name", "n_name"], cells.get_system("geohash"), _P).select("cell").distinct()


@query("geohash_parent", with_sql("u", _COVER + "SELECT cell AS geohash_6, r_name, n_name FROM rk WHERE place = 1"))
def geohash_parent(spark, sf):
    return _grid(spark, sf).select("geohash_6", "r_name", "n_name")


@query(
    "geohash_overlay",
    with_sql("u b", _COVER + f"SELECT building_id, cell AS geohash_6, r_name, n_name FROM b JOIN rk ON place = 1 AND {_LON} >= cx0 AND {_LON} < cx1 AND {_LAT} >= cy0 AND {_LAT} < cy1"),
)
def geohash_overlay(spark, sf):
    points = city.buildings(spark, sf).select("building_id", (0.10 + (F.col("x0") + F.col("x1")) / 2 / 1e5).alias("x"), (52.20 + (F.col("y0") + F.col("y1")) / 2 / 1e5).alias("y"))
    return cells.cell_overlay(points, _grid(spark, sf), "building_id", ["geohash_6", "r_name", "n_name"], 0.005)


def _s2_sql(level: int) -> str:
    """The id written out: cube face, quadratic projection, and the Hilbert curve's quadrants one by one from the largest."""
    st = lambda u: f"CASE WHEN {u} >= 0 THEN sqrt(1 + 3 * {u}) / 2 ELSE 1 - sqrt(1 - 3 * {u}) / 2 END"
    bit = lambda v: f"(({v} >> ({level - 1} - k)) & 1)"
    quadrants = [q for row in s2.QUADRANT for q in row]
    text = with_sql(
        "b",
        f", ll AS (SELECT building_id, radians({_LON}) AS theta, radians({_LAT}) AS phi FROM b), xyz AS (SELECT building_id, cos(phi) * cos(theta) AS x, cos(phi) * sin(theta) AS y, sin(phi) AS z FROM ll), "
        "fc AS (SELECT *, CASE WHEN abs(x) > abs(y) AND abs(x) > abs(z) THEN CASE WHEN x >= 0 THEN 0 ELSE 3 END WHEN abs(y) > abs(z) THEN CASE WHEN y >= 0 THEN 1 ELSE 4 END WHEN z >= 0 THEN 2 ELSE 5 END AS f FROM xyz), "
        "uv AS (SELECT building_id, f, CASE f WHEN 0 THEN y / x WHEN 1 THEN -x / y WHEN 2 THEN -x / z WHEN 3 THEN z / x WHEN 4 THEN z / y ELSE -y / z END AS u, CASE f WHEN 0 THEN z / x WHEN 1 THEN z / y WHEN 2 THEN -y / z WHEN 3 THEN y / x WHEN 4 THEN -x / y ELSE -x / z END AS v FROM fc), "
        f"ij AS (SELECT building_id, f, CAST(floor(({st('u')}) * {2**level}) AS BIGINT) AS i, CAST(floor(({st('v')}) * {2**level}) AS BIGINT) AS j FROM uv), "
        "w AS (SELECT building_id, f, i, j, 0 AS k, f & 1 AS o, CAST(0 AS HUGEINT) AS id FROM ij UNION ALL "
        f"SELECT building_id, f, i, j, k + 1, xor(o, CAST({list(s2.TURN)}[q + 1] AS INTEGER)), id * 4 + q FROM (SELECT *, CAST({quadrants}[o * 4 + 2 * {bit('i')} + {bit('j')} + 1] AS INTEGER) AS q FROM w WHERE k < {level})) "
        f"SELECT building_id, lower(lpad(to_hex(CAST(CAST(f AS HUGEINT) * {2**61} + id * {2 ** (61 - 2 * level)} + {2 ** (60 - 2 * level)} AS UBIGINT)), 16, '0')) AS s2_{level} FROM w WHERE k = {level}",
    )
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


@query("s2_cells", _s2_sql(17))
def s2_cells(spark, sf):
    """S2 cells of level 17; the tests also have published ids."""
    b = city.buildings(spark, sf)
    return b.select("building_id", s2.cell(0.10 + (F.col("x0") + F.col("x1")) / 2 / 1e5, 52.20 + (F.col("y0") + F.col("y1")) / 2 / 1e5, 17).alias("s2_17"))


def _rhealpix_sql(resolution: int) -> str:
    """The cell's name written out: authalic latitude, square, place in it, and a digit for each division into nine."""
    e, pi, n = rhealpix._E, math.pi, rhealpix.SIDES**resolution
    q = lambda s: f"({1 - e**2!r}e0 * ({s} / (1 - {e**2!r}e0 * {s} * {s}) - ln((1 - {e!r}e0 * {s}) / (1 + {e!r}e0 * {s})) / {2 * e!r}e0))"
    digits = " || ".join(f"CAST((j // {rhealpix.SIDES ** (resolution - 1 - k)}) % 3 * 3 + (i // {rhealpix.SIDES ** (resolution - 1 - k)}) % 3 AS VARCHAR)" for k in range(resolution))
    return with_sql(
        "b",
        f", ll AS (SELECT building_id, radians({_LON} - 360 * floor(({_LON} + 180) / 360)) AS lam, {q(f'sin(radians({_LAT}))')} / {rhealpix._QP!r}e0 AS s FROM b), "
        f"sp AS (SELECT *, least(3, CAST(floor((lam + {pi!r}e0) / {pi / 2!r}e0) AS INTEGER)) AS q, sqrt(greatest(0e0, 3 * (1 - abs(s)))) AS sigma FROM ll), "
        f"tu AS (SELECT *, (lam + {3 * pi / 4!r}e0 - q * {pi / 2!r}e0) * sigma AS dx, -sign(s) * {pi / 4!r}e0 * sigma AS dy, CASE WHEN s > 0 THEN q ELSE (4 - q) % 4 END AS turn FROM sp), "
        f"uv AS (SELECT building_id, CASE WHEN abs(s) <= 2e0 / 3 THEN q + 1 WHEN s > 0 THEN 0 ELSE 5 END AS f, "
        f"CASE WHEN abs(s) <= 2e0 / 3 THEN (lam + {pi!r}e0) / {pi / 2!r}e0 - q ELSE CASE turn WHEN 0 THEN dx WHEN 1 THEN -dy WHEN 2 THEN -dx ELSE dy END / {pi / 2!r}e0 + 0.5e0 END AS u, "
        f"CASE WHEN abs(s) <= 2e0 / 3 THEN ({pi / 4!r}e0 - s * {3 * pi / 8!r}e0) / {pi / 2!r}e0 ELSE 0.5e0 - CASE turn WHEN 0 THEN dy WHEN 1 THEN dx WHEN 2 THEN -dy ELSE -dx END / {pi / 2!r}e0 END AS v FROM tu), "
        f"ij AS (SELECT building_id, f, CAST(floor(u * {n}) AS BIGINT) AS i, CAST(floor(v * {n}) AS BIGINT) AS j FROM uv) "
        f"SELECT building_id, substr('{rhealpix.FACES}', f + 1, 1) || {digits} AS rhealpix_{resolution} FROM ij",
    )


@query("rhealpix_cells", _rhealpix_sql(9))
def rhealpix_cells(spark, sf):
    """rHEALPix cells of resolution 9 at buildings; see the tests."""
    b = city.buildings(spark, sf)
    return b.select("building_id", cells.get_system("rhealpix").cell(0.10 + (F.col("x0") + F.col("x1")) / 2 / 1e5, 52.20 + (F.col("y0") + F.col("y1")) / 2 / 1e5, 9).alias("rhealpix_9"))


def _system_grid(name: str, resolution: int) -> Query:
    def run(spark, sf):
        system = cells.get_system(name)
        pairs = cells.grid_pairs(city.degrees(city.units(spark, sf)), ["r_name", "n_name"], system, resolution)
        return cells.finished_grid(pairs, ["r_name", "n_name"], system, resolution).select(system.column_name(resolution), "r_name", "n_name")

    return run


query("s2_parent")(_system_grid("s2", 14))
query("rhealpix_parent")(_system_grid("rhealpix", 8))


# Projections: Krüger's series for UTM zone 31, written out.
_TM = crs._series(crs.utm(31))


def _utm_sql() -> str:
    radius, a, _, e, _ = _TM
    north = "xi" + "".join(f" + {c!r}e0 * sin({2 * k + 2} * xi) * cosh({2 * k + 2} * eta)" for k, c in enumerate(a)).replace("e-0", "e-0")
    east = "eta" + "".join(f" + {c!r}e0 * cos({2 * k + 2} * xi) * sinh({2 * k + 2} * eta)" for k, c in enumerate(a))
    fix = lambda s: __import__("re").sub(r"(e-\d+)e0", r"\1", s)
    return fix(
        with_sql(
            "b",
            f", d AS (SELECT building_id, radians(0.10e0 + x0 / 1e5 - 3) AS lam, radians(52.20e0 + y0 / 1e5) AS phi FROM b), s AS (SELECT building_id, lam, sinh(atanh(sin(phi)) - {e!r}e0 * atanh({e!r}e0 * sin(phi))) AS t FROM d), "
            f"c AS (SELECT building_id, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM s) SELECT building_id, round(500000 + 0.9996e0 * {radius!r}e0 * ({east}), 3) AS east, round(0.9996e0 * {radius!r}e0 * ({north}), 3) AS north FROM c",
        )
    )


@query("crs_utm_forward", _utm_sql())
def crs_utm_forward(spark, sf):
    east, north = crs.project(0.10 + F.col("x0") / 1e5, 52.20 + F.col("y0") / 1e5, "EPSG:32631")
    return city.buildings(spark, sf).select("building_id", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


@query("crs_utm_round_trip", with_sql("b", "SELECT building_id, round(0.10e0 + x0 / 1e5, 9) AS lon, round(52.20e0 + y0 / 1e5, 9) AS lat FROM b"))
def crs_utm_round_trip(spark, sf):
    east, north = crs.project(0.10 + F.col("x0") / 1e5, 52.20 + F.col("y0") / 1e5, "EPSG:32631")
    rows = city.buildings(spark, sf).select("building_id", east.alias("e"), north.alias("n"))
    lon, lat = crs.inverse(F.col("e"), F.col("n"), crs.utm(31))
    return rows.select("building_id", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@query("crs_web_mercator", with_sql("b", "SELECT building_id, round(radians(0.10e0 + x0 / 1e5) * 6378137e0, 3) AS x, round(6378137e0 * ln(tan(pi() / 4 + radians(52.20e0 + y0 / 1e5) / 2)), 3) AS y FROM b"))
def crs_web_mercator(spark, sf):
    x, y = crs.project(0.10 + F.col("x0") / 1e5, 52.20 + F.col("y0") / 1e5, 3857)
    return city.buildings(spark, sf).select("building_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


# Tile catalogue over file names made of part keys.
_NAMES = "SELECT 'file:/data/' || (2018 + p_partkey % 4) || '/VOM_' || CASE WHEN p_partkey % 5 = 0 THEN 'HS_' ELSE '' END || 'TL' || lpad(CAST(p_partkey % 20 AS VARCHAR), 2, '0') || lpad(CAST((p_partkey * 5) % 100 AS VARCHAR), 2, '0') || '_' || p_partkey || '.tif' AS path, p_partkey FROM part"
_CATALOGUE = f"SELECT regexp_replace(path, '^file:(//)?', '') AS path, 'CHM' AS file_type, nullif(regexp_extract(path, 'VOM_([A-Z]{{2}}[0-9]{{4}})_', 1), '') AS tile_name, CAST(regexp_extract(path, '/([0-9]{{4}})/', 1) AS INTEGER) AS year FROM ({_NAMES}) WHERE NOT contains(path, 'VOM_HS_')"


def _paths(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet").select(
        F.expr("concat('file:/data/', CAST(2018 + p_partkey % 4 AS STRING), '/VOM_', CASE WHEN p_partkey % 5 = 0 THEN 'HS_' ELSE '' END, 'TL', lpad(CAST(p_partkey % 20 AS STRING), 2, '0'), lpad(CAST((p_partkey * 5) % 100 AS STRING), 2, '0'), '_', CAST(p_partkey AS STRING), '.tif')").alias("path")
    )


@query("tile_catalogue", _CATALOGUE)
def tile_catalogue(spark, sf):
    return tiles.catalogue(_paths(spark, sf))


@query("tile_latest", f"SELECT tile_name, year, path FROM (SELECT *, row_number() OVER (PARTITION BY tile_name ORDER BY year DESC, path) AS r FROM ({_CATALOGUE})) WHERE r = 1")
def tile_latest(spark, sf):
    return tiles.newest(tiles.catalogue(_paths(spark, sf)))


@query(
    "translate_tile_name",
    "WITH a AS (SELECT p_partkey AS k, 'TL' || p_partkey % 10 || CASE WHEN p_partkey % 2 = 0 THEN '0' ELSE '5' END || (p_partkey // 10) % 10 || CASE WHEN p_partkey % 3 = 0 THEN '0' ELSE '5' END AS name FROM part) "
    "SELECT k, name, 'TL' || name[3] || name[5] || CASE WHEN name[6] = '0' THEN 'S' ELSE 'N' END || CASE WHEN name[4] = '0' THEN 'W' ELSE 'E' END AS other, lower(name) AS back FROM a".replace("lower(name)", "'tl' || substr(name, 3)"),
)
def translate_tile_name(spark, sf):
    name = F.expr("concat('TL', CAST(p_partkey % 10 AS STRING), CASE WHEN p_partkey % 2 = 0 THEN '0' ELSE '5' END, CAST((p_partkey div 10) % 10 AS STRING), CASE WHEN p_partkey % 3 = 0 THEN '0' ELSE '5' END)")
    rows = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("k"), name.alias("name"))
    rows = rows.withColumn("other", tiles.other_name(F.col("name")))
    return rows.withColumn("back", tiles.other_name(F.col("other")))


# Geometry of rectangles has closed forms.
@query("geometry_measures", with_sql("b", "SELECT building_id, round((x1 - x0) * (y1 - y0), 6) AS area, round(2 * (x1 - x0 + y1 - y0), 6) AS perimeter, round((x0 + x1) / 2, 6) AS cx, round((y0 + y1) / 2, 6) AS cy, round((x1 - x0) * (y1 - y0) + 20 * (x1 - x0 + y1 - y0) + 100 * pi(), 6) AS grown FROM b"))
def geometry_measures(spark, sf):
    c = geometry.centroid("parts")
    rows = city.buildings(spark, sf).select("building_id", geometry.area("parts").alias("a"), geometry.perimeter("parts").alias("p"), c.alias("c"), geometry.convex_buffer_area("parts", 10.0).alias("g"))
    return rows.select("building_id", F.round("a", 6).alias("area"), F.round("p", 6).alias("perimeter"), F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"), F.round("g", 6).alias("grown"))

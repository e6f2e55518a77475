"""Distance to the nearest park (the 300 of the rule), straight and along roads, and park access points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborel.functions import geometry
from arborel.functions.overlay import point_on_surface
from arborel.operators.graph import nearest_source
from arborel.operators.grid import BOX, POINT, box_join, nearest

#: Streets and parks this far from a unit count for its buildings.
SEARCH = 2000.0


def euclidean(buildings: DataFrame, parks: DataFrame, size: float = 100.0) -> DataFrame:
    """Per building: closest_park_site_id and distance_euclidean (1 decimal, 0 where they touch); ties go to the least park."""
    park_box = tuple(f"p_{c}" for c in BOX)
    a = buildings.select("building_id", *BOX, geometry.unless_box("parts"), geometry.is_box("parts").alias("is_box"))
    b = parks.select("park_id", *(F.col(c).alias(f"p_{c}") for c in BOX), geometry.unless_box("parts").alias("p_parts"), geometry.is_box("parts").alias("p_is_box"))
    exact = F.when(F.col("is_box") & F.col("p_is_box"), geometry.box_gap(BOX, park_box)).otherwise(geometry.polygon_distance(geometry.or_box("parts", BOX), geometry.or_box("p_parts", park_box)))
    found = nearest(a, b, size, "building_id", "park_id", exact, BOX, park_box, keep=[], flags=("is_box", "p_is_box"))
    return found.select("building_id", F.col("park_id").alias("closest_park_site_id"), F.round("distance", 1).alias("distance_euclidean"))


def snapped(points: DataFrame, nodes: DataFrame, key: str, size: float = 250.0) -> DataFrame:
    """Each point's nearest road node: key, node, snap (the distance); ties go to the least node."""
    b = nodes.select("node", F.col("x").alias("n_x"), F.col("y").alias("n_y"))
    a = points.select(key, "x", "y")
    distance = F.sqrt(F.pow(F.col("x") - F.col("n_x"), 2) + F.pow(F.col("y") - F.col("n_y"), 2))
    found = nearest(a, b, size, key, "node", distance, POINT, ("n_x", "n_y", "n_x", "n_y"), keep=[])
    return found.select(key, "node", F.col("distance").alias("snap"))


def network(buildings: DataFrame, access: DataFrame, nodes: DataFrame, edges: DataFrame, size: float = 250.0, block: float = 5000.0) -> DataFrame:
    """Per building: closest_park_access_id and distance_manhattan, the way along roads with both ways to and from them.

    ``access`` has access_id, rank (its order, which breaks ties), x and y. Buildings start at their
    centroid. Where no access can be reached both are null. 1 decimal.
    """
    gates = snapped(access.select("access_id", "rank", "x", "y"), nodes, "access_id", size).join(access.select("access_id", "rank"), "access_id")
    sources = gates.select("node", F.col("snap").alias("dist"), F.col("rank").alias("source"))
    labels = nearest_source(nodes, edges, sources, block)
    centres = buildings.select("building_id", geometry.centroid("parts").alias("c")).select("building_id", "c.x", "c.y")
    homes = snapped(centres, nodes, "building_id", size)
    found = homes.join(labels, "node", "left").join(access.select(F.col("rank").alias("source"), "access_id"), "source", "left")
    return buildings.select("building_id").join(found.select("building_id", F.col("access_id").alias("closest_park_access_id"), F.round(F.col("snap") + F.col("dist"), 1).alias("distance_manhattan")), "building_id", "left")


def near_parks(by_road: DataFrame, straight: DataFrame) -> DataFrame:
    """Both distances; buildings that have only one are left out."""
    return by_road.join(straight, "building_id")


def streets_near_units(edges: DataFrame, units: DataFrame, radius: float = SEARCH, size: float = 1000.0) -> DataFrame:
    """Edges (edge_id, ax, ay, bx, by ...) at most ``radius`` from any unit."""
    a = edges.select("edge_id", *(f(x, y).alias(f"e_{c}") for c, f, x, y in zip(BOX, (F.least, F.least, F.greatest, F.greatest), ("ax", "ay", "ax", "ay"), ("bx", "by", "bx", "by"))), "ax", "ay", "bx", "by")
    a = a.withColumn("e_parts", F.expr("array(array(array(named_struct('x', ax, 'y', ay), named_struct('x', bx, 'y', by))))"))
    pairs = box_join(a, units.select(*BOX, "parts"), size, radius, tuple(f"e_{c}" for c in BOX), BOX, geometry.polygon_distance("e_parts", "parts") <= radius)
    return edges.join(pairs.select("edge_id").distinct(), "edge_id", "left_semi")


def nodes_of_streets(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes at which an edge ends."""
    ends = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct()
    return nodes.join(ends, "node", "left_semi")


def access_points(parks: DataFrame, edges: DataFrame, entrances: DataFrame | None = None, snap: float = 15.0, size: float = 250.0) -> DataFrame:
    """Where parks can be entered: access_id (<park>_acc<i>), park_id, x, y.

    Entrances at most ``snap`` from a park's boundary count for the nearest park; parks without
    get the places where roads cross their boundary, one for each square metre; parks without
    either a point inside. Points of a park are numbered by x, then y;
    places of roads are rounded to a millionth of a metre.
    """
    p = parks.select("park_id", *(F.col(c).alias(f"p_{c}") for c in BOX), F.col("parts").alias("p_parts"))
    park_box = tuple(f"p_{c}" for c in BOX)
    found = None
    if entrances is not None:
        near = box_join(entrances.select("entrance_id", "x", "y"), p, size, snap, POINT, park_box)
        near = near.withColumn("d", F.expr(f"sqrt({geometry.boundary_distance2_sql('p_parts', 'x', 'y')})")).filter(F.col("d") <= snap)
        best = near.groupBy("entrance_id").agg(F.min(F.struct("d", "park_id")).alias("b"), F.first("x").alias("x"), F.first("y").alias("y"))
        found = best.select(F.col("b.park_id").alias("park_id"), "x", "y")
    left = p if found is None else p.join(found.select("park_id").distinct(), "park_id", "left_anti")
    streets = edges.select("edge_id", "ax", "ay", "bx", "by", F.least("ax", "bx").alias("e_x0"), F.least("ay", "by").alias("e_y0"), F.greatest("ax", "bx").alias("e_x1"), F.greatest("ay", "by").alias("e_y1"))
    met = box_join(left, streets, size, 0.0, park_box, ("e_x0", "e_y0", "e_x1", "e_y1"))
    det = "((bx - ax) * (e.by - e.ay) - (by - ay) * (e.bx - e.ax))"
    t = f"(((e.ax - ax) * (e.by - e.ay) - (e.ay - ay) * (e.bx - e.ax)) / nullif({det}, 0))"
    u = f"(((e.ax - ax) * (by - ay) - (e.ay - ay) * (bx - ax)) / nullif({det}, 0))"
    at = lambda t: f"named_struct('x', round(ax + {t} * (bx - ax), 6), 'y', round(ay + {t} * (by - ay), 6))"
    # where a road runs along the boundary, the middle of the shared stretch
    foot = lambda c: f"((e.{c}x - ax) * (bx - ax) + (e.{c}y - ay) * (by - ay)) / nullif((bx - ax) * (bx - ax) + (by - ay) * (by - ay), 0)"
    along = f"transform(filter({geometry.edges_sql('p_parts')}, e -> {det} = 0 AND (e.ax - ax) * (by - ay) = (e.ay - ay) * (bx - ax)), e -> named_struct('lo', greatest(0D, least({foot('a')}, {foot('b')})), 'hi', least(1D, greatest({foot('a')}, {foot('b')}))))"
    met = met.withColumn("_shared", F.expr(f"filter({along}, s -> s.lo < s.hi)"))
    places_of = f"transform(filter({geometry.edges_sql('p_parts')}, e -> {t} BETWEEN 0 AND 1 AND {u} BETWEEN 0 AND 1), e -> {t})"
    # ends of a stretch are crossings with the next edge, whose place may differ in the last digits; a millionth of a metre is the same place
    same = "1e-6D / nullif(sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay)), 0)"
    apart = f"filter({places_of}, m -> NOT exists(_shared, s -> m BETWEEN s.lo - {same} AND s.hi + {same}))"
    places = F.expr(f"concat(transform({apart}, m -> {at('m')}), transform(_shared, s -> {at('((s.lo + s.hi) / 2)')}))")
    crossings = met.select("park_id", F.explode(places).alias("c")).select("park_id", "c.x", "c.y")
    thin = crossings.groupBy("park_id", F.round("x").alias("rx"), F.round("y").alias("ry")).agg(F.min(F.struct("x", "y")).alias("c")).select("park_id", "c.x", "c.y")
    rest = left.join(thin.select("park_id").distinct(), "park_id", "left_anti").select("park_id", point_on_surface("p_parts").alias("c")).select("park_id", "c.x", "c.y")
    points = thin.unionByName(rest)
    if found is not None:
        points = points.unionByName(found)
    from pyspark.sql import Window

    i = F.row_number().over(Window.partitionBy("park_id").orderBy("x", "y")) - 1
    return points.withColumn("i", i).select(F.concat(F.col("park_id").cast("string"), F.lit("_acc"), F.col("i").cast("string")).alias("access_id"), "park_id", "x", "y")


def public_parks(parks: DataFrame, function_column: str | None = None, function_value: str | None = None) -> DataFrame:
    """Parks whose function is the one given, all of them unless both are given."""
    if function_column and function_value is not None:
        return parks.filter(F.col(function_column) == function_value)
    return parks


def linked_access(access: DataFrame, parks: DataFrame, reference: str = "park_access_ref") -> DataFrame:
    """Access points that refer to one of ``parks``, all of them if they refer to none."""
    if reference not in access.columns:
        return access
    return access.join(parks.select(F.col("park_id").alias(reference)).distinct(), reference, "left_semi")

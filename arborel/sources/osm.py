"""OpenStreetMap layers from exported JSON (elements with tags, nodes and geometry).

Exports are read by Spark; the same filters and names apply as for layers fetched from a
service: residential or given kinds of buildings, parks by tags without private ones, walkable
roads as edges between their nodes, entrances as points. Coordinates are projected on the way in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborel.functions import crs

# Kinds of buildings and tags of parks by default.
RESIDENTIAL = ("residential", "house", "apartments", "detached", "semidetached_house", "terrace", "bungalow", "dormitory", "static_caravan", "houseboat")
PARK_TAGS = {"leisure": ["park", "recreation_ground"], "landuse": ["village_green", "recreation_ground"]}
PRIVATE = ("private", "no", "customers")
# Ways that a network leaves out, by their tags; the kinds are those of the configuration.
_NEVER = {"highway": ("abandoned", "construction", "no", "planned", "platform", "proposed", "raceway", "razed"), "area": ("yes",)}
_FOOT_ONLY = ("bridleway", "corridor", "elevator", "escalator", "footway", "path", "pedestrian", "steps", "track")
_MOTOR_ONLY = ("motor", "motorway", "motorway_link")
LEFT_OUT = {
    "all": {},
    "all_public": {"access": ("private",), "service": ("private",)},
    "walk": {"access": ("private",), "service": ("private",), "foot": ("no",), "highway": ("bus_guideway", "cycleway", *_MOTOR_ONLY)},
    "bike": {"access": ("private",), "service": ("private",), "bicycle": ("no",), "highway": ("bus_guideway", "corridor", "elevator", "escalator", "footway", "steps", *_MOTOR_ONLY)},
    "drive_service": {"access": ("private",), "motor_vehicle": ("no",), "motorcar": ("no",), "highway": ("bus_guideway", "cycleway", *_FOOT_ONLY), "service": ("emergency_access", "parking", "parking_aisle", "private")},
    "drive": {"access": ("private",), "motor_vehicle": ("no",), "motorcar": ("no",), "highway": ("bus_guideway", "cycleway", "service", *_FOOT_ONLY), "service": ("alley", "driveway", "emergency_access", "parking", "parking_aisle", "private")},
}
FORM = (
    "elements ARRAY<STRUCT<type: STRING, id: BIGINT, lat: DOUBLE, lon: DOUBLE, nodes: ARRAY<BIGINT>, tags: MAP<STRING, STRING>, "
    "geometry: ARRAY<STRUCT<lat: DOUBLE, lon: DOUBLE>>, members: ARRAY<STRUCT<type: STRING, ref: BIGINT, role: STRING, geometry: ARRAY<STRUCT<lat: DOUBLE, lon: DOUBLE>>>>>>"
)


def elements(spark: SparkSession, path: str) -> DataFrame:
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", FORM)["elements"]).alias("e")).select("e.*")


def _ring(column, epsg: str | int):
    def point(g):
        x, y = crs.project(g["lon"], g["lat"], epsg)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(column, point)


def areas(found: DataFrame, epsg: str | int) -> DataFrame:
    """Closed ways and multipolygon relations: osm_id (type/id), tags, parts. Holes go with the first shell of a relation."""
    osm_id = F.concat(F.col("type"), F.lit("/"), F.col("id").cast("string"))
    ways = found.filter("type = 'way' AND size(geometry) >= 4 AND geometry[0] = element_at(geometry, -1)")
    ways = ways.select(osm_id.alias("osm_id"), "tags", F.array(F.array(_ring(F.col("geometry"), epsg))).alias("parts"))
    members = lambda role: F.filter("members", lambda m: (m["role"] == role) & (F.size(m["geometry"]) >= 4))
    relations = found.filter("type = 'relation' AND exists(members, m -> m.role = 'outer')")
    shells = F.transform(members("outer"), lambda m: F.array(_ring(m["geometry"], epsg)))
    holes = F.transform(members("inner"), lambda m: _ring(m["geometry"], epsg))
    parts = F.transform(shells, lambda s, i: F.when(i == 0, F.concat(s, holes)).otherwise(s))
    return ways.unionByName(relations.select(osm_id.alias("osm_id"), "tags", parts.alias("parts"))).filter(F.size("parts") > 0)


def buildings(found: DataFrame, epsg: str | int, kinds: list[str] | None = None) -> DataFrame:
    """building_id, parts: residential kinds by default, every building for ["all"]."""
    kind = F.col("tags")["building"]
    rows = areas(found, epsg).filter(kind.isNotNull())
    if not kinds or "all" not in kinds:
        rows = rows.filter(kind.isin(list(kinds or RESIDENTIAL)))
    return rows.select(F.col("osm_id").alias("building_id"), F.expr("try_cast(tags['height'] AS DOUBLE)").alias("building_height"), "parts")


def parks(found: DataFrame, epsg: str | int, tags: dict[str, list[str]] | None = None, exclude_private: bool = True) -> DataFrame:
    """park_id, parts of areas with any of the tags, without those that only some may enter."""
    wanted = F.lit(False)
    for key, values in (tags or PARK_TAGS).items():
        wanted = wanted | F.coalesce(F.col("tags")[key].isin(list(values)), F.lit(False))
    rows = areas(found, epsg).filter(wanted)
    if exclude_private:
        rows = rows.filter(~F.coalesce(F.col("tags")["access"].isin(list(PRIVATE)), F.lit(False)))
    return rows.select(F.col("osm_id").alias("park_id"), "parts")


def in_network(network: str) -> Column:
    """Whether a way with a highway tag is part of a network: walk leaves out motorways and what is closed to feet, and so on."""
    out = F.col("tags")["highway"].isNotNull()
    for rule in (_NEVER, LEFT_OUT[network]):
        for tag, values in rule.items():
            out = out & ~F.coalesce(F.col("tags")[tag].isin(list(values)), F.lit(False))
    return out


def roads(found: DataFrame, epsg: str | int, network: str = "walk") -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the ways of a network, each way cut at its nodes: node, x, y; edge_id, u, v, w, ax, ay, bx, by."""
    ways = found.filter("type = 'way' AND size(nodes) >= 2 AND size(nodes) = size(geometry)").filter(in_network(network))
    ways = ways.select("id", "nodes", _ring(F.col("geometry"), epsg).alias("g"))
    step = "transform(sequence(0, size(nodes) - 2), i -> named_struct('k', i, 'u', nodes[i], 'v', nodes[i + 1], 'a', g[i], 'b', g[i + 1]))"
    edges = ways.select("id", F.explode(F.expr(step)).alias("s")).select(
        F.concat_ws("_", F.col("id").cast("string"), F.col("s.k").cast("string")).alias("edge_id"), "s.u", "s.v",
        F.sqrt(F.pow(F.col("s.b.x") - F.col("s.a.x"), 2) + F.pow(F.col("s.b.y") - F.col("s.a.y"), 2)).alias("w"),
        F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"),
    )
    ends = edges.select(F.col("u").alias("node"), F.col("ax").alias("x"), F.col("ay").alias("y")).unionByName(edges.select(F.col("v").alias("node"), F.col("bx").alias("x"), F.col("by").alias("y")))
    return ends.groupBy("node").agg(F.min("x").alias("x"), F.min("y").alias("y")), edges


def entrances(found: DataFrame, epsg: str | int) -> DataFrame:
    """entrance_id, x, y of nodes that are entrances or gates."""
    rows = found.filter("type = 'node' AND (tags['entrance'] IS NOT NULL OR tags['barrier'] IN ('gate', 'entrance'))")
    x, y = crs.project(F.col("lon"), F.col("lat"), epsg)
    return rows.select(F.col("id").alias("entrance_id"), x.alias("x"), y.alias("y"))


"""Vector layers as tables with a ``shape`` struct: (Geo)Parquet, GeoJSON, GeoPackage and shapefiles.

Every reader goes through Spark's own file access, so inputs may lie in any store that Spark
reads. Geometry that is null, empty or broken gives a null shape.
"""

from __future__ import annotations

import json
import logging
import os
import sqlite3
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborel.functions import crs, geometry
from arborel.sources import shapefile, wkb

log = logging.getLogger("arborel")


def read_vector(spark: SparkSession, path: str, layer: str | None = None, crs_to: str | int | None = None) -> DataFrame:
    """The features of a file or folder with their attributes and ``shape``, by the name's ending.

    With ``crs_to`` shapes come in the coordinates of that EPSG code, moved from those that the file says it has. A file
    that does not say is taken to have them already, with a warning.
    """
    ending = os.path.splitext(path.rstrip("/"))[1].lower()
    if ending in (".parquet", ".geoparquet"):
        rows, source = read_geoparquet(spark, path), geoparquet_epsg
    elif ending in (".geojson", ".json"):
        rows, source = read_geojson(spark, path), lambda *_: geojson_epsg(spark, path, rows)
    elif ending == ".gpkg":
        rows, source = read_geopackage(spark, path, layer), lambda *_: geopackage_epsg(spark, path, layer)
    elif ending == ".shp":
        rows, source = shapefile.read_shapefile(spark, path), shapefile.shapefile_epsg
    else:
        raise ValueError(f"cannot read {path}: known are .parquet, .geoparquet, .geojson, .json, .gpkg and .shp")
    return rows if crs_to is None else reprojected(rows, source(spark, path), crs_to, path)


def _code(name: object) -> int | None:
    """The EPSG code that a CRS is named by."""
    text = str(name or "").upper()
    if "CRS84" in text:
        return 4326
    digits = text.replace("/", ":").rpartition(":")[2]
    return int(digits) if digits.isdigit() else None


def geoparquet_epsg(spark: SparkSession, path: str) -> int | None:
    """What the file metadata says: a CRS that is left out means degrees; without such metadata nothing is known."""
    files = spark.read.parquet(path).inputFiles()
    if not files:
        return None
    hadoop, parquet = spark._jvm.org.apache.hadoop.fs, spark._jvm.org.apache.parquet.hadoop
    reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(hadoop.Path(files[0]), spark._jsc.hadoopConfiguration()))
    try:
        meta = reader.getFooter().getFileMetaData().getKeyValueMetaData().get("geo")
    finally:
        reader.close()
    if meta is None:
        return None
    meta = json.loads(meta)
    column = meta.get("columns", {}).get(meta.get("primary_column", "geometry"), {})
    if "crs" not in column:
        return 4326
    named = (column["crs"] or {}).get("id") or {}
    return _code(f"{named.get('authority')}:{named.get('code')}")


def geojson_epsg(spark: SparkSession, path: str, rows: DataFrame) -> int | None:
    """What the file's member crs says; without it degrees, unless a coordinate cannot be one."""
    named = spark.read.text(path, wholetext=True).select(F.get_json_object("value", "$.crs.properties.name").alias("n")).filter("n IS NOT NULL").first()
    if named:
        return _code(named["n"])
    points = F.concat(F.flatten(F.flatten(F.coalesce("shape.parts", F.array()))), F.flatten(F.coalesce("shape.paths", F.array())), F.coalesce("shape.points", F.array()))
    far = rows.filter("shape IS NOT NULL").filter(F.exists(points, lambda p: (F.abs(p["x"]) > 180) | (F.abs(p["y"]) > 90)))
    return None if far.head(1) else 4326


def reprojected(layer: DataFrame, source: int | None, target: str | int, name: str = "a layer", shape: str = "shape") -> DataFrame:
    """``layer`` with its shapes moved from one EPSG code's coordinates to another's."""
    crs.projection(target)
    if source is None:
        warnings.warn(f"{name} does not say its CRS; its coordinates are taken for those of {target}", stacklevel=2)
    if source is None or crs.projection(source) == crs.projection(target):
        return layer

    def point(p: Column) -> Column:
        x, y = crs.project(*crs.unproject(p["x"], p["y"], source), target)
        return F.struct(x.alias("x"), y.alias("y"))

    def rings(column: Column) -> Column:
        return F.transform(column, lambda ring: F.transform(ring, point))

    s = F.col(shape)
    moved = F.struct(s["kind"].alias("kind"), F.transform(s["parts"], rings).alias("parts"), rings(s["paths"]).alias("paths"), F.transform(s["points"], point).alias("points"))
    return layer.withColumn(shape, F.when(s.isNotNull(), moved))


def read_geoparquet(spark: SparkSession, path: str, column: str = "geometry") -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.withColumn("shape", wkb.shape_of(column)).drop(column) if column in rows.columns else rows


def _json_shape(geometry_column: Column) -> Column:
    """GeoJSON coordinates, kept as text until the type is known, as a shape."""
    points = "ARRAY<ARRAY<DOUBLE>>"
    g = geometry_column
    pick = lambda form: F.from_json(F.concat(F.lit('{"c":'), g["coordinates"], F.lit("}")), f"c {form}")["c"]
    point = lambda c: F.struct(c[0].alias("x"), c[1].alias("y"))
    line = lambda cs: F.transform(cs, point)
    kind = g["type"]
    parts = F.when(kind == "Polygon", F.array(F.transform(pick(f"ARRAY<{points}>"), line))).when(kind == "MultiPolygon", F.transform(pick(f"ARRAY<ARRAY<{points}>>"), lambda p: F.transform(p, line)))
    paths = F.when(kind == "LineString", F.array(line(pick(points)))).when(kind == "MultiLineString", F.transform(pick(f"ARRAY<{points}>"), line))
    spots = F.when(kind == "Point", F.array(point(pick("ARRAY<DOUBLE>")))).when(kind == "MultiPoint", line(pick(points)))
    names = F.create_map(*(F.lit(x) for pair in (("Point", "point"), ("LineString", "line"), ("Polygon", "polygon"), ("MultiPoint", "multipoint"), ("MultiLineString", "multiline"), ("MultiPolygon", "multipolygon")) for x in pair))
    return F.when(kind.isNotNull(), F.struct(F.try_element_at(names, kind).alias("kind"), parts.alias("parts"), paths.alias("paths"), spots.alias("points")))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features with their properties as text columns."""
    whole = spark.read.text(path, wholetext=True)
    form = "STRUCT<features: ARRAY<STRUCT<id: STRING, properties: MAP<STRING, STRING>, geometry: STRUCT<type: STRING, coordinates: STRING>>>>"
    features = whole.select(F.explode(F.from_json("value", form)["features"]).alias("f"))
    names = sorted(r[0] for r in features.select(F.explode(F.map_keys("f.properties"))).distinct().collect())
    return features.select(*(F.col("f.properties")[n].alias(n) for n in names), *([] if "id" in names else [F.col("f.id").alias("id")]), _json_shape(F.col("f.geometry")).alias("shape"))


# Column types of the GeoPackage format.
_TYPES = {"INTEGER": T.LongType(), "INT": T.LongType(), "MEDIUMINT": T.LongType(), "SMALLINT": T.LongType(), "TINYINT": T.LongType(), "BOOLEAN": T.LongType(), "REAL": T.DoubleType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "BLOB": T.BinaryType()}


def _open(content: bytes) -> sqlite3.Connection:
    base = sqlite3.connect(":memory:")
    base.deserialize(bytes(content))
    return base


def _layer(base: sqlite3.Connection, layer: str | None) -> tuple[str, str, list[tuple[str, str]]]:
    tables = dict(base.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY rowid").fetchall())
    if not tables or (layer is not None and layer not in tables):
        raise ValueError(f"no layer {layer!r}; there are {sorted(tables)}")
    name = layer or next(iter(tables))
    quoted = name.replace('"', '""')
    columns = [(r[1], r[2].split("(")[0].upper()) for r in base.execute(f'PRAGMA table_info("{quoted}")')]
    return name, tables[name], columns


def _first_package(spark: SparkSession, path: str, layer: str | None) -> dict | None:
    """Geometry column, columns and EPSG code of the layer in the first readable package below ``path``, or its ``error``."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    base = _open(content)
                    table, geom, columns = _layer(base, layer)
                    about = {"geom": geom, "columns": columns, "epsg": _package_code(base, table)}
                except sqlite3.Error as e:
                    log.warning("%s cannot be read: %s", name, e)
                    continue
                except ValueError as e:
                    about = {"error": str(e)}
                yield pd.DataFrame({"path": [name], "about": [json.dumps(about)]})

    # the schema of a package is a few hundred bytes; one is enough
    found = packages(spark, path).mapInPandas(look, "path string, about string").agg(F.min(F.struct("path", "about")).alias("a")).first()["a"]
    return json.loads(found["about"]) if found else None


def _package_code(base: sqlite3.Connection, table: str) -> int | None:
    try:
        row = base.execute("SELECT r.organization_coordsys_id FROM gpkg_geometry_columns c JOIN gpkg_spatial_ref_sys r ON r.srs_id = c.srs_id WHERE c.table_name = ? AND upper(r.organization) = 'EPSG'", (table,)).fetchone()
    except sqlite3.Error:
        return None
    return int(row[0]) if row else None


def packages(spark: SparkSession, path: str) -> DataFrame:
    """path and content of each GeoPackage below ``path``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gpkg").option("recursiveFileLookup", "true").load(path).select("path", "content")


def geopackage_epsg(spark: SparkSession, path: str, layer: str | None = None) -> int | None:
    return (_first_package(spark, path, layer) or {}).get("epsg")


def package_boxes(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """path and box of each GeoPackage below ``path``, as its table of contents tells it; a null box where it does not."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, content in zip(batch["path"], batch["content"]):
                box = None
                try:
                    base = _open(content)
                    box = base.execute("SELECT min_x, min_y, max_x, max_y FROM gpkg_contents WHERE table_name = ?", (_layer(base, layer)[0],)).fetchone()
                except (sqlite3.Error, ValueError):
                    pass  # it is not left out for that; reading it tells what is wrong
                out.append((name, *(box or (None,) * 4)))
            yield pd.DataFrame(out, columns=["path", "x0", "y0", "x1", "y1"]).astype({c: float for c in ("x0", "y0", "x1", "y1")})

    found = packages(spark, path).mapInPandas(look, "path string, x0 double, y0 double, x1 double, y1 double")
    return found.select("path", *(F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("x0", "y0", "x1", "y1")))


def read_geopackage(spark: SparkSession, path: str, layer: str | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """A layer (the first, if none is named) of one or more GeoPackages; files that cannot be read are left out and logged.

    The schema is that of the first file; a file is read by one task. With ``wanted`` (path) only those files are read.
    """
    files = packages(spark, path)
    if wanted is not None:
        files = files.join(wanted.select("path").distinct(), "path", "left_semi")
    about = _first_package(spark, path, layer)
    if about is None:
        raise ValueError(f"no GeoPackage at {path}")
    if "error" in about:
        raise ValueError(about["error"])
    geom, columns = about["geom"], about["columns"]
    attributes = [(c, _TYPES.get(t, T.StringType())) for c, t in columns if c != geom]
    schema = T.StructType([*(T.StructField(c, t) for c, t in attributes), T.StructField("_wkb", T.BinaryType())])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, content in zip(batch["path"], batch["content"]):
                try:
                    base = _open(content)
                    name, column, there = _layer(base, layer)
                    known = {c for c, _ in there}
                    pick = ", ".join('"' + c.replace('"', '""') + '"' if c in known else "NULL" for c, _ in [*attributes, (column, None)])
                    found = base.execute(f'SELECT {pick} FROM "{name.replace(chr(34), chr(34) * 2)}"').fetchall()
                except (sqlite3.Error, ValueError) as e:
                    log.warning("%s is left out: %s", at, e)
                    continue
                out = pd.DataFrame(found, columns=[*(c for c, _ in attributes), "_wkb"], dtype=object)
                out["_wkb"] = out["_wkb"].map(wkb.package_body)
                for c, t in attributes:
                    if isinstance(t, T.StringType):
                        out[c] = out[c].map(lambda v: None if v is None else str(v))
                yield out

    found = files.mapInPandas(rows, schema)
    return found.withColumn("shape", wkb.shape_of("_wkb")).drop("_wkb")


def polygons(layer: DataFrame, shape: str = "shape") -> DataFrame:
    """Polygon features with ``parts`` and their box; others are left out."""
    rows = layer.withColumn("parts", F.col(f"{shape}.parts")).drop(shape).filter(F.size("parts") > 0)
    return rows.withColumns(geometry.bbox("parts"))


def points(layer: DataFrame, shape: str = "shape") -> DataFrame:
    """Point features with ``x`` and ``y``; others are left out."""
    rows = layer.filter(F.size(f"{shape}.points") > 0)
    return rows.withColumns({"x": F.col(f"{shape}.points")[0]["x"], "y": F.col(f"{shape}.points")[0]["y"]}).drop(shape)


def lines(layer: DataFrame, shape: str = "shape") -> DataFrame:
    """Line features with ``path``, one row for each part of a multi-line."""
    return layer.withColumn("path", F.explode(f"{shape}.paths")).drop(shape).filter(F.size("path") > 1)


def renamed(layer: DataFrame, names: dict[str | None, str]) -> DataFrame:
    """Given columns under their canonical names; those that are not there are passed over."""
    return layer.withColumnsRenamed({a: b for a, b in names.items() if a and a in layer.columns})


def numeric(layer: DataFrame, column: str) -> DataFrame:
    """A column as double, null where it is no number."""
    return layer.withColumn(column, F.expr(f"try_cast(`{column}` AS DOUBLE)")) if column in layer.columns else layer


def files_near(boxes: DataFrame, units: DataFrame, radius: float = 0.0) -> DataFrame:
    """Paths whose box is at most ``radius`` from any unit's, and those whose box is not known."""
    from arborel.operators.grid import BOX, box_join

    files = boxes.select("path", *(F.col(c).alias(f"m_{c}") for c in BOX))
    near = box_join(files, units.select(*BOX), 5000.0, radius, tuple(f"m_{c}" for c in BOX), BOX).select("path")
    return near.unionByName(files.filter("m_x0 IS NULL OR m_y0 IS NULL OR m_x1 IS NULL OR m_y1 IS NULL").select("path")).distinct()


def feature_collection(rows: list[dict]) -> str:
    """A small GeoJSON text, for exports and tests."""
    return json.dumps({"type": "FeatureCollection", "features": rows})

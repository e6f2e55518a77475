import json
import sqlite3
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborel import cli
from arborel.functions import geometry
from arborel.operators import canopy
from arborel.plans import city
from arborel.sources import footprints, geotiff, osm, shapefile, sinks, vector, wkb
from arborel.streaming import tiles as stream

SQUARE = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]


def box(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


def polygon(ring, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": "Polygon", "coordinates": [ring]}}


def parts(*rings):
    return [[[{"x": x, "y": y} for x, y in r]] for r in rings]


def test_wkb():
    for p in (parts(SQUARE), parts(SQUARE, box(20, 20, 21, 21))):
        got = wkb.decode(wkb.encode_parts(p))
        assert got["parts"] == p and got["kind"] == ("polygon" if len(p) == 1 else "multipolygon")
    assert wkb.decode(struct.pack(">BIdd", 0, 1, 1.0, 2.0))["points"] == [{"x": 1.0, "y": 2.0}]
    assert wkb.decode(struct.pack("<BIddd", 1, 1001, 1.0, 2.0, 9.0))["points"] == [{"x": 1.0, "y": 2.0}]
    assert wkb.decode(struct.pack("<BIIdd", 1, 0x20000001, 4326, 1.0, 2.0))["points"] == [{"x": 1.0, "y": 2.0}]
    assert wkb.decode(struct.pack("<BII4d", 1, 2, 2, 0.0, 0.0, 1.0, 1.0))["paths"] == [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]]
    for bad in (None, b"", b"\1", b"\1\2\0\0\0\xff", struct.pack("<BI", 1, 99)):
        assert wkb.decode(bad) is None
    assert wkb.encode_parts(None) is None


def test_geojson(spark, tmp_path):
    features = [
        polygon(SQUARE, id="a", h=3),
        {"type": "Feature", "properties": {"id": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[SQUARE], [box(20, 20, 22, 22)]]}},
        {"type": "Feature", "properties": {"id": "p"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"type": "Feature", "properties": {"id": "l"}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 0]], [[5, 5], [6, 6], [7, 7]]]}},
        {"type": "Feature", "properties": {"id": "n"}, "geometry": None},
    ]
    path = tmp_path / "x.geojson"
    path.write_text(vector.feature_collection(features))
    layer = vector.read_vector(spark, f"file://{path}")
    got = {r["id"]: r for r in vector.polygons(layer).collect()}
    assert set(got) == {"a", "m"} and got["m"]["x1"] == 22 and got["a"]["h"] == "3"
    assert [tuple(r[c] for c in ("id", "x", "y")) for r in vector.points(layer).collect()] == [("p", 1.0, 2.0)]
    assert sorted(len(r["path"]) for r in vector.lines(layer).collect()) == [2, 3]
    numeric = vector.numeric(vector.renamed(layer, {"h": "height", None: "x", "nope": "y"}), "height")
    assert {r["id"]: r["height"] for r in numeric.collect()}["a"] == 3.0
    with pytest.raises(ValueError, match="cannot read"):
        vector.read_vector(spark, "x.shp")


def gpkg(path, rows):
    base = sqlite3.connect(path)
    base.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    base.execute("INSERT INTO gpkg_geometry_columns VALUES ('trees', 'geom')")
    base.execute("CREATE TABLE trees (fid INTEGER PRIMARY KEY, geom BLOB, height REAL, area REAL, note TEXT(9))")
    for ring, h, a in rows:
        blob = b"GP\0\1" + struct.pack("<i", 32632) + wkb.encode_parts(parts(ring))
        base.execute("INSERT INTO trees (geom, height, area, note) VALUES (?, ?, ?, 'n')", (blob, h, a))
    base.commit()
    base.close()


def test_geopackage(spark, tmp_path):
    gpkg(tmp_path / "a.gpkg", [(SQUARE, 5.0, 100.0), (box(1, 1, 2, 2), None, 1.0)])
    gpkg(tmp_path / "b.gpkg", [(box(3, 3, 4, 4), 9.0, 1.0)])
    (tmp_path / "c.gpkg").write_bytes(b"no database")
    got = sorted(tuple(r[c] for c in ("height", "area", "x0", "note")) for r in vector.polygons(vector.read_geopackage(spark, f"file://{tmp_path}", "trees")).filter("height > 0").collect())
    assert got == [(5.0, 100.0, 0.0, "n"), (9.0, 1.0, 3.0, "n")]
    with pytest.raises(ValueError, match="no layer"):
        vector.read_geopackage(spark, f"file://{tmp_path}/a.gpkg", "nope")


def test_geoparquet_and_footprints(spark, tmp_path):
    shape = bytearray(wkb.encode_parts(parts(SQUARE)))
    rows = [("a", "7.5", 0.9, shape, (0.0, 0.0, 10.0, 10.0)), ("b", "tall", 0.2, shape, (50.0, 50.0, 60.0, 60.0)), ("", None, 0.8, None, (1.0, 1.0, 2.0, 2.0))]
    path = f"file://{tmp_path}/f.parquet"
    spark.createDataFrame(rows, "id string, height string, confidence double, geometry binary, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>").withColumnRenamed("id", "id").write.parquet(path)
    found = footprints.overture_buildings(spark, path, (0, 0, 20, 20)).collect()
    assert {r["building_id"]: r["building_height"] for r in found} == {"a": 7.5, "": None}
    assert footprints.open_buildings(spark, path).count() == 2
    assert vector.polygons(vector.read_geoparquet(spark, path)).count() == 2


def tiff(values, compression, predictor, tile=None):
    """A little TIFF writer of its own, for variants that the library does not write."""
    h, w = values.shape
    dtype = values.dtype

    def packed(block):
        if predictor == 2:
            block = np.diff(block, axis=1, prepend=np.zeros((block.shape[0], 1), dtype)).astype(dtype)
        raw = block.astype(dtype.newbyteorder("<")).tobytes()
        if predictor == 3:
            big = block.astype(dtype.newbyteorder(">")).view(np.uint8).reshape(block.shape[0], block.shape[1], dtype.itemsize).transpose(0, 2, 1).reshape(block.shape[0], -1)
            raw = np.diff(big, axis=1, prepend=np.zeros((big.shape[0], 1), np.uint8)).astype(np.uint8).tobytes()
        if compression == 8:
            return zlib.compress(raw)
        if compression == 32773:
            return b"".join(bytes([len(raw[i : i + 128]) - 1]) + raw[i : i + 128] for i in range(0, len(raw), 128))
        if compression == 5:
            bits, width, table, out = "", 9, {bytes([i]): i for i in range(256)}, []
            bits += format(256, "09b")
            n, word = 258, b""
            for b in raw:
                c = word + bytes([b])
                if c in table:
                    word = c
                    continue
                bits += format(table[word], f"0{width}b")
                table[c] = n
                n += 1
                width = min(12, max(9, n.bit_length())) if n < 4094 else 12
                if n >= 4093:
                    bits += format(256, f"0{width}b")
                    table, n, width = {bytes([i]): i for i in range(256)}, 258, 9
                word = bytes([b])
            bits += format(table[word], f"0{width}b")
            n += 1
            width = min(12, max(9, n.bit_length()))
            bits += format(257, f"0{width}b")
            bits += "0" * (-len(bits) % 8)
            return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))
        return raw

    if tile:
        padded = np.zeros((-(-h // tile) * tile, -(-w // tile) * tile), dtype)
        padded[:h, :w] = values
        blocks = [packed(padded[i : i + tile, j : j + tile]) for i in range(0, h, tile) for j in range(0, w, tile)]
        layout = [(322, 3, [tile]), (323, 3, [tile]), (324, 4, None), (325, 4, [len(b) for b in blocks])]
    else:
        blocks = [packed(values[i : i + 4]) for i in range(0, h, 4)]
        layout = [(273, 4, None), (278, 3, [4]), (279, 4, [len(b) for b in blocks])]
    form = {"u": 1, "i": 2, "f": 3}[dtype.kind]
    entries = [(256, 4, [w]), (257, 4, [h]), (258, 3, [dtype.itemsize * 8]), (259, 3, [compression]), (277, 3, [1]), (317, 3, [predictor]), (339, 3, [form]), *layout]
    at = 8
    places = []
    for b in blocks:
        places.append(at)
        at += len(b)
    extra, table = b"", b""
    for tag, kind, value in sorted(entries):
        value = places if value is None else value
        raw = struct.pack(f"<{len(value)}{'H' if kind == 3 else 'I'}", *value)
        if len(raw) > 4:
            raw, extra = struct.pack("<I", at + len(extra)), extra + raw
        table += struct.pack("<HHI", tag, kind, len(value)) + raw.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", at + len(extra)) + b"".join(blocks) + extra + struct.pack("<H", len(entries)) + table + b"\0" * 4


@pytest.mark.parametrize("compression", [1, 8, 5, 32773])
@pytest.mark.parametrize("dtype, predictor", [("u1", 1), ("i2", 2), ("f4", 1), ("f4", 3), ("f8", 3)])
@pytest.mark.parametrize("tile", [None, 16])
def test_tiff_variants(compression, dtype, predictor, tile):
    r = np.random.default_rng(1)
    values = r.integers(0, 60, (21, 37)).astype(dtype)
    assert (geotiff.decode(tiff(values, compression, predictor, tile)).values == values).all()


def test_geotiff(spark, tmp_path):
    values = np.array([[1.0, 5.0, np.nan], [70.0, 3.0, 2.9]])
    (tmp_path / "a.tif").write_bytes(geotiff.encode(values, 100.0, 200.0, 10.0, 32632, nodata=-9999.0))
    (tmp_path / "b.tif").write_bytes(geotiff.encode(values, 130.0, 200.0, 10.0, 27700, deflate=False))
    (tmp_path / "c.tif").write_bytes(b"not a raster")
    r = geotiff.decode((tmp_path / "a.tif").read_bytes())
    assert (r.x0, r.y0, r.px, r.epsg) == (100.0, 200.0, 10.0, 32632)
    folder = f"file://{tmp_path}"
    told = {x["path"].rsplit("/", 1)[1]: x["error"] for x in geotiff.checked(spark, folder, 32632).collect()}
    assert told["a.tif"] is None and "27700" in told["b.tif"] and told["c.tif"]
    pixels = geotiff.read_pixels(spark, folder).filter("tile_id LIKE '%a.tif'")
    got = {(p["x"], p["y"]): p["canopy"] for p in canopy.binarised(pixels).collect()}
    assert got == {(105.0, 195.0): 0, (115.0, 195.0): 1, (125.0, 195.0): None, (105.0, 185.0): 0, (115.0, 185.0): 1, (125.0, 185.0): 0}


def test_files_far_off_are_not_read(spark, tmp_path):
    """Of tiles, those near the units are read: by their headers, or a package's table of contents."""
    units = spark.createDataFrame([(0.0, 0.0, 100.0, 100.0)], "x0 double, y0 double, x1 double, y1 double")
    values = np.full((4, 4), 9.0)
    for name, x in (("near", 90.0), ("far", 900.0)):
        (tmp_path / f"{name}.tif").write_bytes(geotiff.encode(values, x, 50.0, 5.0, 32632))
    checks = geotiff.checked(spark, f"file://{tmp_path}", 32632)
    near = vector.files_near(checks, units)
    pixels = geotiff.read_pixels(spark, f"file://{tmp_path}", near)
    assert pixels.count() == 16 and pixels.agg(F.max("x")).first()[0] == 107.5 and checks.agg(F.max("pixel")).first()[0] == 5.0
    (tmp_path / "near.tif").write_bytes(geotiff.encode(values, 90.0, 50.0, 5.0, 32632)[:-9])
    with pytest.raises(Exception, match="near.tif cannot be decoded"):
        geotiff.read_pixels(spark, f"file://{tmp_path}", near, strict=True).count()
    (tmp_path / "trees").mkdir()
    for name, x in (("a", 150), ("b", 5000), ("c", 5)):
        gpkg(tmp_path / "trees" / f"{name}.gpkg", [(box(x, 5, x + 3, 8), 5.0, 9.0)])
        if name != "c":
            base = sqlite3.connect(tmp_path / "trees" / f"{name}.gpkg")
            base.execute("CREATE TABLE gpkg_contents (table_name TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL)")
            base.execute("INSERT INTO gpkg_contents VALUES ('trees', ?, 5, ?, 8)", (x, x + 3))
            base.commit()
            base.close()
    folder = f"file://{tmp_path}/trees"
    for radius, kept in ((0.0, [5.0]), (60.0, [5.0, 150.0])):
        wanted = vector.files_near(vector.package_boxes(spark, folder, "trees"), units, radius)
        assert sorted(r["x0"] for r in vector.polygons(vector.read_geopackage(spark, folder, "trees", wanted)).collect()) == kept


def test_the_newest_of_a_tile_counts(spark, tmp_path):
    from arborel import config as settings
    from arborel.sources import catalog

    for year, name, x in ((2019, "trees_TL0010", 1), (2022, "trees_TL0010", 2), (2019, "trees_TL0510", 3), (2019, "notes", 4)):
        (tmp_path / str(year)).mkdir(exist_ok=True)
        gpkg(tmp_path / str(year) / f"{name}.gpkg", [(box(x, 0, x + 1, 1), 5.0, 9.0)])
    raw = {"study_area_name": "t", "crs": "EPSG:32632", "data": {k: "x.gpkg" for k in ("buildings", "parks_sites", "parks_access", "roads", "census_boundaries")} | {"trees_dir": f"file://{tmp_path}"}, "columns": {"geo_levels": ["a"], "building_id": "b", "tree_layer": "trees"}, "output": {"base_dir": "o"}}
    for system, kept in ((None, [1, 2, 3, 4]), ({"enabled": True, "tile_name_pattern": r"_([A-Z]{2}\d{4})\."}, [2, 3])):
        c = settings.parse_config(raw | ({"tile_system": system} if system else {}))
        assert sorted(r["x0"] for r in catalog.tree_table(spark, c).collect()) == kept


def test_osm(spark, tmp_path):
    ll = lambda *p: [{"lat": a, "lon": b} for a, b in p]
    ring = ll((45.0, 9.0), (45.0, 9.001), (45.001, 9.001), (45.0, 9.0))
    found = [
        {"type": "way", "id": 1, "tags": {"building": "house", "height": "6"}, "geometry": ring, "nodes": [1, 2, 3, 1]},
        {"type": "way", "id": 2, "tags": {"building": "garage"}, "geometry": ring, "nodes": [1, 2, 3, 1]},
        {"type": "way", "id": 3, "tags": {"leisure": "park"}, "geometry": ring},
        {"type": "way", "id": 4, "tags": {"leisure": "park", "access": "private"}, "geometry": ring},
        {"type": "relation", "id": 5, "tags": {"leisure": "park"}, "members": [{"type": "way", "ref": 1, "role": "outer", "geometry": ring}, {"type": "way", "ref": 2, "role": "inner", "geometry": ring}]},
        {"type": "way", "id": 6, "tags": {"highway": "footway"}, "nodes": [10, 11, 12], "geometry": ll((45.0, 9.0), (45.0, 9.001), (45.0, 9.002))},
        {"type": "node", "id": 7, "lat": 45.0, "lon": 9.0, "tags": {"barrier": "gate"}},
        {"type": "node", "id": 8, "lat": 45.0, "lon": 9.0},
    ]
    (tmp_path / "o.json").write_text(json.dumps({"elements": found}))
    e = osm.elements(spark, f"file://{tmp_path}/o.json")
    assert [(r[0], r[1]) for r in osm.buildings(e, 32632).collect()] == [("way/1", 6.0)]
    assert osm.buildings(e, 32632, ["all"]).count() == 2
    assert sorted(r[0] for r in osm.parks(e, 32632).collect()) == ["relation/5", "way/3"]
    assert osm.parks(e, 32632, exclude_private=False).count() == 3
    nodes, edges = osm.roads(e, 32632)
    assert nodes.count() == 3 and [round(r["w"]) for r in edges.collect()] == [79, 79]
    assert osm.entrances(e, 32632).count() == 1


def study(tmp_path):
    """Four tracts of 200 m, a building each, trees, two parks, a road lattice and a canopy tile."""
    tracts = [polygon(box(x, y, x + 200, y + 200), district=f"D{x // 400}", tract=f"T{x}{y}") for x in (0, 200) for y in (0, 200)]
    homes = [polygon(box(x + 50, y + 50, x + 60, y + 60), id=f"b{x}{y}", h=None if x == y == 0 else 10.0) for x in (0, 200) for y in (0, 200)]
    trees = [(box(70 + 10 * i, 52, 76 + 10 * i, 58), 8.0, 36.0) for i in range(3)] + [(box(270, 250, 272, 252), 8.0, 4.0)]
    parks = [polygon(box(300, 300, 340, 340), id="p1"), polygon(box(0, 300, 30, 330), id="p2")]
    gates = [{"type": "Feature", "properties": {"id": i}, "geometry": {"type": "Point", "coordinates": at}} for i, at in (("g1", [300, 300]), ("g2", [30, 300]))]
    roads = [{"type": "Feature", "properties": {}, "geometry": {"type": "LineString", "coordinates": c}} for a in range(0, 401, 100) for b in range(0, 400, 100) for c in ([[a, b], [a, b + 100]], [[b, a], [b + 100, a]])]
    for name, features in (("tracts", tracts), ("homes", homes), ("parks", parks), ("gates", gates), ("roads", roads)):
        (tmp_path / f"{name}.geojson").write_text(vector.feature_collection(features))
    (tmp_path / "trees").mkdir()
    gpkg(tmp_path / "trees" / "t.gpkg", trees)
    import yaml

    config = {
        "study_area_name": "x", "crs": "EPSG:32632",
        "data": {"buildings": f"file://{tmp_path}/homes.geojson", "parks_sites": f"file://{tmp_path}/parks.geojson", "parks_access": f"file://{tmp_path}/gates.geojson", "roads": f"file://{tmp_path}/roads.geojson", "census_boundaries": f"file://{tmp_path}/tracts.geojson", "trees_dir": f"file://{tmp_path}/trees/t.gpkg"},
        "columns": {"geo_levels": ["district", "tract"], "building_id": "id", "building_height_col": "h", "tree_layer": "trees"},
        "output": {"base_dir": f"file://{tmp_path}/out"},
    }
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(config))
    return str(tmp_path / "c.yaml"), f"file://{tmp_path}/out"


def test_command_line(spark, tmp_path, capsys):
    pytest.importorskip("yaml")
    config, out = study(tmp_path)
    go = lambda *more: cli.main(["run", "-c", config, *more])
    assert go("-p", "T3", "--query_method", "sql", "--buffer", "100") == 0
    t3 = {r["building_id"]: r["tree_count_100m"] for r in spark.read.parquet(f"{out}/t3_100m").collect()}
    assert t3 == {"b00": 3, "b0200": 0, "b2000": 0, "b200200": 0}
    for process in ("Tree_count", "T30", "T300", "Visibility"):
        assert go("-p", process) == 0
    assert {r["tract"]: r["tree_count"] for r in spark.read.parquet(f"{out}/tree_count").collect()} == {"T00": 3, "T200200": 1}
    t30 = {r["tract"]: (r["canopy_cover"], r["total_pixels"]) for r in spark.read.parquet(f"{out}/t30").collect()}
    assert t30["T00"] == (pytest.approx(0.27), 40000) and t30["T0200"][0] == 0
    t300 = {r["building_id"]: r for r in spark.read.parquet(f"{out}/t300").collect()}
    assert t300["b200200"]["distance_euclidean"] == pytest.approx(56.6) and t300["b200200"]["closest_park_access_id"] == "g1"
    seen = {r["building_id"]: r["visible_trees"] for r in spark.read.parquet(f"{out}/visibility_100m").collect()}
    assert seen == {"b0200": 0, "b2000": 0, "b200200": 0}  # b00 has no height
    assert go("-p", "T3", "--buffer", "25") == 0
    assert go("-p", "Merge", "--t3_buffers", "25", "100") == 0
    merged = {r["district"]: r for r in spark.read.parquet(f"{out}/database/T3_30_300_spectral.parquet").collect()}
    assert set(merged) == {"D0"} and merged["D0"]["total_trees"] == 4 and merged["D0"]["tree_count_100m"] == 0.75
    assert go("-p", "Merge", "--t3_buffers", "50") == 1 and "t3_50m" in capsys.readouterr().err
    for bad in (("-p", "T3", "--geo_level", "nope"), ("-p", "T3", "--dggs", "s2"), ("-p", "Spectral"), ("-p", "T3", "--dggs", "s2", "--dggs_resolution", "9", "--sub_geo_level", "tract"), ("-p", "T3", "--h3_resolution", "9", "--dggs", "h3")):
        assert go(*bad) == 1
    # cells in place of tracts
    assert go("-p", "Tree_count", "--dggs", "geohash", "--dggs_resolution", "7") == 0
    counted = spark.read.parquet(f"{out}/tree_count").collect()
    assert sum(r["tree_count"] for r in counted) >= 4 and all(len(r["geohash_7"]) == 7 for r in counted)
    # a run that resumes leaves what is there
    assert go("-p", "T3", "--buffer", "100", "--no-overwrite") == 0
    assert spark.read.parquet(f"{out}/t3_100m").count() == 4


def test_layers_in_other_coordinates(spark, tmp_path):
    """Each format says its CRS in its own way; shapes come in the study's."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from arborel.functions import crs

    at = spark.range(1).select(*(v.alias(n) for n, v in zip("xy", crs.project(F.lit(9.1), F.lit(45.2), 32632)))).first()
    want = (pytest.approx(at["x"], abs=0.02), pytest.approx(at["y"], abs=0.02))
    ring = [[9.1, 45.2], [9.2, 45.2], [9.2, 45.3], [9.1, 45.2]]
    (tmp_path / "d.geojson").write_text(vector.feature_collection([polygon(ring, id="a")]))
    metres = [list(map(float, p)) for p in spark.createDataFrame([tuple(p) for p in ring], "a double, b double").select(*crs.project(F.col("a"), F.col("b"), 3857)).collect()]
    named = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}, "features": [polygon(metres, id="a")]}
    (tmp_path / "m.geojson").write_text(json.dumps(named))
    table = pa.table({"id": ["a"], "geometry": [bytes(wkb.encode_parts(parts(ring)))]})
    for name, geo in (("p", {"primary_column": "geometry", "columns": {"geometry": {"encoding": "WKB"}}}), ("q", {"columns": {"geometry": {"crs": {"id": {"authority": "EPSG", "code": 4326}}}}})):
        pq.write_table(table.replace_schema_metadata({"geo": json.dumps(geo)}), tmp_path / f"{name}.parquet")
    gpkg(tmp_path / "g.gpkg", [(ring, 5.0, 1.0)])
    base = sqlite3.connect(tmp_path / "g.gpkg")
    base.execute("ALTER TABLE gpkg_geometry_columns ADD COLUMN srs_id INTEGER")
    base.execute("UPDATE gpkg_geometry_columns SET srs_id = 7")
    base.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_id INTEGER, organization TEXT, organization_coordsys_id INTEGER)")
    base.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (7, 'epsg', 4326)")
    base.commit()
    base.close()
    for name in ("d.geojson", "m.geojson", "p.parquet", "q.parquet", "g.gpkg"):
        got = vector.polygons(vector.read_vector(spark, f"file://{tmp_path}/{name}", None, "EPSG:32632")).first()
        assert (got["x0"], got["y0"]) == want, name
    pq.write_table(table, tmp_path / "silent.parquet")
    with pytest.warns(UserWarning, match="does not say its CRS"):
        assert vector.polygons(vector.read_vector(spark, f"file://{tmp_path}/silent.parquet", None, 32632)).first()["x0"] == 9.1
    pq.write_table(table.replace_schema_metadata({"geo": json.dumps({"columns": {"geometry": {"crs": {"id": {"authority": "EPSG", "code": 9999}}}}})}), tmp_path / "odd.parquet")
    with pytest.raises(ValueError, match="9999"):
        vector.read_vector(spark, f"file://{tmp_path}/odd.parquet", None, 32632)


def write_shapefile(stem, kind, records, columns, prj=None):
    """A little writer of its own: records are (list of rings or points, values)."""
    body, table = b"", b""
    for i, (rings, values) in enumerate(records):
        if rings is None:
            content = struct.pack("<i", 0)
        elif kind == 1:
            content = struct.pack("<i2d", 1, *rings)
        else:
            points = [p for r in rings for p in r]
            starts = [sum(map(len, rings[:k])) for k in range(len(rings))]
            box = [f(p[a] for p in points) for f in (min, max) for a in (0, 1)]
            content = struct.pack("<i4d2i", kind, *box, len(rings), len(points)) + struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">2i", i + 1, len(content) // 2) + content
        table += b" " + b"".join(str("" if v is None else v).encode().ljust(w) if t == "C" else str("" if v is None else v).encode().rjust(w) for v, (_, t, w) in zip(values, columns))
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i", 1000, kind) + b"\0" * 64
    stem.with_suffix(".shp").write_bytes(head + body)
    width = 1 + sum(w for _, _, w in columns)
    names = b"".join(n.encode().ljust(11, b"\0") + t.encode() + b"\0" * 4 + bytes([w, 2 if t == "N" else 0]) + b"\0" * 14 for n, t, w in columns)
    stem.with_suffix(".dbf").write_bytes(struct.pack("<4BIHH", 3, 24, 1, 1, len(records), 33 + len(names), width) + b"\0" * 20 + names + b"\r" + table + b"\x1a")
    if prj:
        stem.with_suffix(".prj").write_text(prj)


def test_shapefiles(spark, tmp_path):
    clockwise = lambda x0, y0, x1, y1: [(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]
    hole = clockwise(2, 2, 3, 3)[::-1]
    columns = [("name", "C", 8), ("height", "N", 9)]
    write_shapefile(tmp_path / "a", 5, [([clockwise(0, 0, 10, 10), hole, clockwise(20, 20, 30, 30)], ("Müller", 7.25)), (None, ("empty", None)), ([clockwise(5, 5, 6, 6)], ("", "x"))], columns)
    layer = vector.read_vector(spark, f"file://{tmp_path}/a.shp")
    got = vector.polygons(layer).withColumn("area", geometry.area("parts")).collect()
    assert [(r["name"], r["height"], r["area"], r["x1"]) for r in got] == [("Müller", 7.25, 199.0, 30.0), (None, None, 1.0, 6.0)]
    assert layer.count() == 3 and [len(p) for p in got[0]["parts"]] == [2, 1]
    write_shapefile(tmp_path / "p", 1, [((9.0, 45.0), ("at", 1)), ((9.001, 45.0), ("by", 2))], columns, 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984"]]')
    points = vector.points(vector.read_vector(spark, f"file://{tmp_path}/p.shp", None, 32632)).orderBy("height").collect()
    assert points[0]["x"] == pytest.approx(500000, abs=0.01) and points[1]["x"] == pytest.approx(500078.8, abs=0.2)
    write_shapefile(tmp_path / "l", 3, [([[(0, 0), (1, 1)], [(2, 2), (3, 3), (4, 4)]], ("l", 1))], columns)
    assert sorted(len(r["path"]) for r in vector.lines(vector.read_vector(spark, f"file://{tmp_path}/l.shp")).collect()) == [2, 3]
    codes = {'PROJCS["WGS_1984_UTM_Zone_33S",GEOGCS["GCS_WGS_1984"]]': 32733, 'PROJCS["x",AUTHORITY["EPSG","27700"]]': 27700, 'PROJCS["British_National_Grid"]': 27700, "": None, 'PROJCS["own"]': None}
    assert {k: shapefile.prj_epsg(k) for k in codes} == codes


def test_networks(spark):
    tags = [{"highway": "residential"}, {"highway": "motorway"}, {"highway": "footway"}, {"highway": "cycleway"}, {"highway": "proposed"}, {"highway": "service", "service": "driveway"}, {"highway": "path", "foot": "no"}, {"highway": "track", "access": "private"}, {"name": "no way"}, {"highway": "primary", "area": "yes"}]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "i int, tags map<string,string>")
    kept = {n: {r["i"] for r in rows.filter(osm.in_network(n)).collect()} for n in osm.LEFT_OUT}
    assert kept == {"all": {0, 1, 2, 3, 5, 6, 7}, "all_public": {0, 1, 2, 3, 5, 6}, "walk": {0, 2, 5}, "bike": {0, 3, 5, 6}, "drive_service": {0, 1, 5}, "drive": {0, 1}}


def test_exports_stand_for_remote_layers(spark, tmp_path):
    """A study whose buildings, parks, gates and roads are one export of OpenStreetMap."""
    yaml = pytest.importorskip("yaml")
    place = lambda x, y: {"lat": 45.0 + y / 111_000, "lon": 9.0 + x / 78_700}
    ring = lambda x, y, s: [place(x, y), place(x + s, y), place(x + s, y + s), place(x, y + s), place(x, y)]
    found = [{"type": "way", "id": i, "tags": {"building": "house"}, "geometry": ring(x, 100, 10)} for i, x in ((1, 100), (2, 300), (3, 9000))]
    found += [{"type": "way", "id": 4, "tags": {"leisure": "park"}, "geometry": ring(500, 100, 60)}]
    found += [{"type": "way", "id": 5, "tags": {"highway": "residential"}, "nodes": list(range(50, 58)), "geometry": [place(100 * k, 130) for k in range(8)]}]
    found += [{"type": "way", "id": 6, "tags": {"highway": "motorway"}, "nodes": [70, 71], "geometry": [place(90, 111), place(110, 111)]}, {"type": "way", "id": 7, "tags": {"highway": "footway"}, "nodes": [80, 81], "geometry": [place(290, 112), place(310, 112)]}]
    (tmp_path / "o.json").write_text(json.dumps({"elements": found}))
    corner = [[9.0, 45.0], [9.01, 45.0], [9.01, 45.005], [9.0, 45.005], [9.0, 45.0]]
    (tmp_path / "wards.geojson").write_text(vector.feature_collection([polygon(corner, city="c", ward="w")]))
    study = {
        "study_area_name": "exported", "crs": "EPSG:32632", "data": {"buildings": "osm", "parks_sites": "osm", "parks_access": "osm", "roads": "osm", "census_boundaries": f"file://{tmp_path}/wards.geojson"},
        "columns": {"geo_levels": ["city", "ward"]}, "output": {"base_dir": f"file://{tmp_path}/out"}, "exports": {"osm": f"file://{tmp_path}/o.json"},
    }
    (tmp_path / "s.yaml").write_text(yaml.safe_dump(study))
    assert cli.main(["run", "-c", str(tmp_path / "s.yaml"), "-p", "T300"]) == 0
    got = {r["building_id"]: r for r in spark.read.parquet(f"file://{tmp_path}/out/t300").collect()}
    # the house far off is no part of the study, the motorway no way to walk, and the lone footway no network
    assert set(got) == {"way/1", "way/2"}
    assert got["way/1"]["distance_euclidean"] == pytest.approx(390, abs=3) and got["way/2"]["distance_euclidean"] == pytest.approx(190, abs=3)
    assert got["way/1"]["distance_manhattan"] == pytest.approx(400 + 26, abs=70)
    study["exports"] = {}
    (tmp_path / "s.yaml").write_text(yaml.safe_dump(study | {"output": {"base_dir": f"file://{tmp_path}/other"}}))
    assert cli.main(["run", "-c", str(tmp_path / "s.yaml"), "-p", "T300"]) == 1


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "0012", 1.5), ("b", "7", float("nan"))], "geo_code string, code string, v double")
    path = f"file://{tmp_path}/t"
    assert sinks.written_codes(spark, path) is None and not sinks.is_complete(spark, path)
    sinks.write_by_code(sinks.without_nan(rows), path)
    assert spark.read.parquet(path).filter("v IS NULL").count() == 1
    sinks.marked_table(rows, path + "m")
    assert sinks.is_complete(spark, path + "m")
    sinks.write_by_code(rows.filter("geo_code = 'a'"), path)
    assert spark.read.parquet(path).count() == 2
    sinks.write_single(rows, f"file://{tmp_path}/s")
    assert (tmp_path / "s").is_file() and [p.name for p in tmp_path.iterdir() if p.name.startswith("s.")] == []
    sinks.write_single(rows, f"file://{tmp_path}/s")
    many = spark.createDataFrame([(k, f"x {i % 2}") for i, k in enumerate([5, 3, 9, 1])] + [(0, None)], "n int, geo_code string")
    sinks.write_csv_by_code(many, f"file://{tmp_path}/csv", "T3", "_25m")
    files = sorted(p for p in (tmp_path / "csv").iterdir() if not p.name.startswith("."))
    assert [p.name for p in files] == ["T3_x 0_25m.csv", "T3_x 1_25m.csv"] and files[0].read_text().split() == ["n,geo_code", "5,x", "0", "9,x", "0"]
    sinks.consolidate(spark, f"file://{tmp_path}/s", "geo_code string, code string, v double", f"file://{tmp_path}/c")
    assert {r["code"] for r in spark.read.parquet(f"file://{tmp_path}/c").collect()} == {"0012", "7"}
    with pytest.raises(ValueError):
        sinks.write_single(rows, path, "xml")


def test_stream(spark, tmp_path):
    import os

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    units = city.units(spark, sf)
    folder, sums, mark = (f"file://{tmp_path}/{n}" for n in ("tiles", "sums", "mark"))
    pixels = canopy.merged_tiles(city.pixels(spark)).select("tile_id", "x", "y", "value").selectExpr("CAST(tile_id AS STRING) AS tile_id", "x", "y", "value")
    for k in (0, 1):
        pixels.filter(f"tile_id = '{k}'").write.mode("append").parquet(folder)
        stream.update_sums(spark, folder, units, ["n_name"], 10.0, sums, mark)
    stream.update_sums(spark, folder, units, ["n_name"], 10.0, sums, mark)
    want = canopy.raster_cover_of_units(units, canopy.binarised(pixels), ["n_name"], 10.0)
    assert sorted(map(tuple, stream.cover(spark, sums, ["n_name"]).collect())) == sorted(map(tuple, want.collect()))


def test_access_points(spark):
    from arborel.functions import geometry
    from arborel.operators import parks

    sites = spark.createDataFrame([(1, 0.0, 0.0, 40.0, 40.0), (2, 100.0, 100.0, 140.0, 140.0), (3, 500.0, 500.0, 520.0, 520.0)], "park_id long, x0 double, y0 double, x1 double, y1 double").withColumn("parts", geometry.rect("x0", "y0", "x1", "y1"))
    roads = spark.createDataFrame([(1, -10.0, 20.0, 20.0, 20.0), (2, 100.0, 110.0, 100.0, 130.0), (3, 90.0, 120.0, 100.2, 120.0)], "edge_id long, ax double, ay double, bx double, by double")
    got = sorted((r["access_id"], r["x"], r["y"]) for r in parks.access_points(sites, roads).collect())
    # a crossing; the middle of the stretch along the boundary, which is within a metre of another crossing; the centroid
    assert got == [("1_acc0", 0.0, 20.0), ("2_acc0", 100.0, 120.0), ("3_acc0", 510.0, 510.0)]
    gates = spark.createDataFrame([(7, 510.0, 530.0), (8, 510.0, 536.0), (9, 0.0, -14.0)], "entrance_id long, x double, y double")
    got = sorted((r["access_id"], r["x"], r["y"]) for r in parks.access_points(sites, roads, gates).collect())
    assert got == [("1_acc0", 0.0, -14.0), ("2_acc0", 100.0, 120.0), ("3_acc0", 510.0, 530.0)]

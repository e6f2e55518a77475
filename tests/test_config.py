"""Studies as a user writes them, each rule of the configuration broken once, and those that only warn."""

import warnings

import pytest

from arborel.config import NETWORKS, grid_options, load_config, parse_config, remote
from arborel.operators.cells import RESOLUTIONS

HARBOUR = """
study_area_name: old harbour
crs: EPSG:32756
gee_project: none of ours
data:
  buildings: gs://harbour/footprints.parquet
  parks_sites: green.geojson
  parks_access: gates.geojson
  roads: streets.gpkg
  road_nodes: corners.gpkg
  census_boundaries: wards.gpkg
  trees_dir: crowns
columns:
  geo_levels: [borough, ward, block]
  building_id: footprint
  building_height_col: eaves
  tree_id_col: crown
osm: {exclude_private: false, park_tags: {leisure: [park, garden]}}
output: {base_dir: out/harbour}
unknown_section: {left: aside}
"""


def harbour(*changes):
    """The study with values set or, by None after a slash, taken out: ("data", "roads", "osm"), ("columns", "building_id", "/")."""
    yaml = pytest.importorskip("yaml")
    raw = yaml.safe_load(HARBOUR)
    for *path, value in changes:
        at = raw
        for step in path[:-1]:
            at = at.setdefault(step, {})
        if value == "/":
            del at[path[-1]]
        else:
            at[path[-1]] = value
    return raw


def test_a_study_from_a_file(tmp_path):
    (tmp_path / "study.yaml").write_text(HARBOUR)
    c = load_config(tmp_path / "study.yaml")
    assert (c.study_area_name, c.crs, c.data.road_nodes, c.data.chm_tiles_dir) == ("old harbour", "EPSG:32756", "corners.gpkg", None)
    assert c.columns.geo_levels == ("borough", "ward", "block") and c.columns.tree_id_col == "crown"
    assert c.osm.park_tags == {"leisure": ["park", "garden"]} and not c.osm.exclude_private
    assert (c.dggs, c.dggs_resolution, c.gee_project) == (None, None, "none of ours")
    assert not c.tile_system.enabled and c.output.base_dir == "out/harbour"


def test_what_is_left_out_has_its_usual_value():
    c = parse_config(harbour(("osm", "/"), ("columns", "tree_id_col", "/"), ("columns", "building_height_col", "/")))
    assert {f: getattr(c.columns, f) for f in ("tree_id_col", "tree_height_col", "tree_area_col", "tree_layer")} == {"tree_id_col": "treeID", "tree_height_col": "height", "tree_area_col": "area", "tree_layer": "trees"}
    assert [c.columns.road_edge_start, c.columns.road_edge_end, c.columns.road_edge_length, c.columns.building_height_col] == ["start_node", "end_node", "length", None]
    assert (c.osm.network_type, c.osm.exclude_private, c.osm.fetch_buffer, c.open_buildings.confidence_threshold) == ("walk", True, 2000, 0.7)


@pytest.mark.parametrize("path", [("study_area_name",), ("crs",), ("data",), ("columns",), ("output",), ("data", "buildings"), ("data", "roads"), ("data", "parks_access"), ("data", "census_boundaries"), ("columns", "geo_levels"), ("output", "base_dir")])
def test_a_field_that_must_be_there(path):
    with pytest.raises(ValueError, match=path[-1]):
        parse_config(harbour((*path, "/")))


@pytest.mark.parametrize(
    "changes, named",
    [
        ([("crs", "EPSG:4")], "crs"),
        ([("crs", "the usual one")], "crs"),
        ([("data", ["a", "list"])], "data"),
        ([("columns", None)], "columns"),
        ([("columns", "geo_levels", "borough")], "geo_levels"),
        ([("columns", "geo_levels", [])], "geo_levels"),
        ([("columns", "building_id", "/")], "building_id"),
        ([("data", "census_boundaries", "Osm")], "census_boundaries"),
        *(([("data", layer, source)], layer) for layer in ("roads", "road_nodes", "parks_sites", "parks_access", "census_boundaries") for source in ("overture", " Open_Buildings")),
        ([("data", "roads", "osm")], "road_nodes"),
        ([("data", "parks_sites", "osm"), ("columns", "park_function_value", "play")], "park_function"),
        ([("osm", "network_type", "tram")], "network_type"),
        ([("osm", "building_types", ["flats", 3])], "building_types"),
        ([("osm", "park_tags", "leisure")], "park_tags"),
        ([("osm", "fetch_buffer", 12.5)], "fetch_buffer"),
        ([("osm", "fetch_buffer", True)], "fetch_buffer"),
        ([("open_buildings", "confidence_threshold", 1.0)], "confidence_threshold"),
        ([("open_buildings", "confidence_threshold", "high")], "confidence_threshold"),
    ],
)
def test_a_rule_that_is_broken(changes, named):
    with pytest.raises(ValueError, match=named):
        parse_config(harbour(*changes))


@pytest.mark.parametrize("changes, named", [([("data", "buildings", "open_buildings")], "building_height_col"), ([("data", "parks_sites", "osm"), ("columns", "park_access_ref_col", "site")], "park_access_ref_col")])
def test_what_only_warns(changes, named):
    with pytest.warns(UserWarning, match=named):
        parse_config(harbour(*changes))


def test_sources_by_name():
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        c = parse_config(harbour(("data", "buildings", "OVERTURE "), ("columns", "building_id", "/"), ("data", "roads", "osm"), ("data", "road_nodes", "/"), *((("osm", "network_type", NETWORKS[0]),))))
    assert [remote(x) for x in (c.data.buildings, c.data.roads, c.data.parks_sites, "osm.gpkg", None, 7)] == ["overture", "osm", None, None, None, None]


@pytest.mark.parametrize("name", sorted(RESOLUTIONS))
def test_every_grid_within_its_range(name):
    low, high = RESOLUTIONS[name]
    for level in (low, (low + high) // 2, high):
        c = parse_config(harbour(("dggs", name), ("dggs_resolution", level)))
        assert (c.dggs, c.dggs_resolution) == (name, level)
    for level in (low - 1, high + 1, low + 0.5, str(high), True):
        with pytest.raises(ValueError, match="dggs_resolution"):
            grid_options({"dggs": name, "dggs_resolution": level})
    for half in ({"dggs": name}, {"dggs_resolution": high}):
        with pytest.raises(ValueError, match="together"):
            grid_options(half)


def test_grids_by_other_names():
    with pytest.raises(ValueError, match="quadkey"):
        grid_options({"dggs": "quadkey", "dggs_resolution": 14})
    with pytest.warns(DeprecationWarning):
        assert grid_options({"h3_resolution": 4}) == ("h3", 4)
    with pytest.raises(ValueError, match="older spelling"):
        grid_options({"h3_resolution": 4, "dggs_resolution": 4})
    assert grid_options({}) == (None, None)

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborel.functions import geometry, overlay
from arborel.operators.grid import BOX, POINT, box_join, nearest


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


SQUARE = [[ring([(0, 0), (10, 0), (10, 10), (0, 10)])]]
HOLED = [[ring([(0, 0), (10, 0), (10, 10), (0, 10)]), ring([(4, 4), (6, 4), (6, 6), (4, 6)])]]
TWO = [[ring([(0, 0), (1, 0), (1, 1), (0, 1)])], [ring([(5, 5), (7, 5), (7, 7), (5, 7)])]]
ELL = [[ring([(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)])]]


def one(spark, column, **parts):
    schema = ", ".join(f"{k} {geometry.PARTS if isinstance(v, list) else 'double'}" for k, v in parts.items())
    return spark.createDataFrame([tuple(parts.values())], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("parts, area, perimeter", [(SQUARE, 100, 40), (HOLED, 96, 48), (TWO, 5, 12), (ELL, 7, 16)])
def test_measures(spark, parts, area, perimeter):
    assert one(spark, geometry.area("pp"), pp=parts) == pytest.approx(area)
    assert one(spark, geometry.perimeter("pp"), pp=parts) == pytest.approx(perimeter)


def test_centroid(spark):
    c = one(spark, geometry.centroid("pp"), pp=HOLED)
    assert (c["x"], c["y"]) == pytest.approx((5, 5))
    c = one(spark, geometry.centroid("pp"), pp=TWO)
    assert (c["x"], c["y"]) == pytest.approx(((0.5 + 6 * 4) / 5, (0.5 + 6 * 4) / 5))


def test_contains(spark):
    for x, y, inside in [(5, 5, False), (1, 1, True), (0, 0, True), (10, 5, False), (5, 10, False), (-1, 5, False)]:
        assert one(spark, geometry.contains_point("pp", "xx", "yy"), pp=HOLED, xx=float(x), yy=float(y)) is inside


def test_distances(spark):
    assert one(spark, geometry.point_distance("pp", "xx", "yy"), pp=HOLED, xx=5.0, yy=5.0) == pytest.approx(1)
    assert one(spark, geometry.point_distance("pp", "xx", "yy"), pp=SQUARE, xx=13.0, yy=14.0) == pytest.approx(5)
    assert one(spark, geometry.polygon_distance("pp", "qq"), pp=SQUARE, qq=[[ring([(13, 14), (15, 14), (15, 16)])]]) == pytest.approx(5)
    assert one(spark, geometry.polygon_distance("pp", "qq"), pp=SQUARE, qq=[[ring([(2, 2), (3, 2), (3, 3)])]]) == 0
    assert one(spark, geometry.polygon_distance("pp", "qq"), pp=SQUARE, qq=[[ring([(10, 2), (13, 2), (13, 3)])]]) == 0
    cross = [[ring([(-1, 4), (11, 4), (11, 5), (-1, 5)])]]
    assert one(spark, geometry.polygon_distance("pp", "qq"), pp=SQUARE, qq=cross) == 0


def test_closest_point_and_cuts(spark):
    c = one(spark, geometry.closest_point("pp", "xx", "yy"), pp=SQUARE, xx=12.0, yy=3.0)
    assert (c["x"], c["y"]) == (10, 3)
    cut = geometry.segment_cuts("pp", "CAST(-10 AS DOUBLE)", "5D", "30D", "5D")
    got = one(spark, cut, pp=SQUARE)
    assert (got["lo"], got["hi"]) == pytest.approx((0.25, 0.5))
    assert one(spark, geometry.segment_cuts("pp", "20D", "0D", "30D", "9D"), pp=SQUARE) is None
    along = one(spark, geometry.segment_cuts("pp", "0D", "0D", "20D", "0D"), pp=SQUARE)
    assert (along["lo"], along["hi"]) == pytest.approx((0, 0.5))


def test_null_and_empty(spark):
    rows = spark.createDataFrame([(None,), ([],)], f"pp {geometry.PARTS}")
    got = rows.select(geometry.area("pp").alias("a"), geometry.bbox("pp")["x0"].alias("x")).collect()
    assert [r["x"] for r in got] == [None, None] and got[0]["a"] is None and got[1]["a"] == 0


def test_intersection_area():
    assert overlay.intersection_area(HOLED, [[ring([(5, 0), (20, 0), (20, 10), (5, 10)])]]) == pytest.approx(48)
    assert overlay.intersection_area(ELL, [[ring([(0.5, 0.5), (3, 0.5), (3, 3), (0.5, 3)])]]) == pytest.approx(0.5 * 2.5 + 0.5 * 2)
    assert overlay.intersection_area(SQUARE, [[ring([(20, 20), (21, 20), (21, 21)])]]) == 0
    assert overlay.intersection_area(None, SQUARE) == 0
    r = random.Random(2)
    for _ in range(20):
        a = [[ring([(r.uniform(0, 10), r.uniform(0, 10)) for _ in range(3)])]]
        b = [[ring([(r.uniform(0, 10), r.uniform(0, 10)) for _ in range(3)])]]
        n = 40000
        xy = np.random.default_rng(3).uniform(0, 10, (n, 2))
        inside = lambda g: _inside(g[0][0], xy)
        assert overlay.intersection_area(a, b) == pytest.approx(100 * (inside(a) & inside(b)).mean(), abs=1.2)


def _inside(points, xy):
    out = np.zeros(len(xy), bool)
    for p, q in zip(points, points[1:]):
        crossed = (p["y"] > xy[:, 1]) != (q["y"] > xy[:, 1])
        with np.errstate(divide="ignore", invalid="ignore"):
            out ^= crossed & (xy[:, 0] < (q["x"] - p["x"]) * (xy[:, 1] - p["y"]) / (q["y"] - p["y"]) + p["x"])
    return out


def test_surface_point_and_buffer():
    for parts in (SQUARE, HOLED, TWO, ELL):
        p = overlay.surface_point(parts)
        inside = sum(bool(_inside(r, np.array([[p["x"], p["y"]]]))[0]) for part in parts for r in part) % 2
        assert inside == 1
    assert overlay.surface_point(None) is None
    grown = overlay.buffer_ring(overlay._ring(SQUARE[0][0]), 5.0, 8)
    assert overlay._area(grown[:-1]) == pytest.approx(100 + 40 * 5 + 16 * 25 * math.sin(math.pi / 16))


def test_box_join_is_a_cross_join(spark):
    r = random.Random(1)
    a = [(i, x := r.uniform(-50, 50), y := r.uniform(-50, 50), x + r.uniform(0, 30), y + r.uniform(0, 30)) for i in range(60)]
    b = [(i, r.uniform(-60, 60), r.uniform(-60, 60)) for i in range(80)] + [(99, None, 1.0)]
    left = spark.createDataFrame(a, "a long, x0 double, y0 double, x1 double, y1 double")
    right = spark.createDataFrame(b, "b long, x double, y double")
    for size, radius in ((7.0, 0.0), (10.0, 12.0), (100.0, 5.0)):
        got = sorted((p["a"], p["b"]) for p in box_join(left, right, size, radius, BOX, POINT).collect())
        want = sorted((i, j) for i, x0, y0, x1, y1 in a for j, x, y in b if x is not None and max(x0 - x, 0, x - x1) ** 2 + max(y0 - y, 0, y - y1) ** 2 <= radius**2)
        assert got == want
    with pytest.raises(ValueError, match="columns"):
        box_join(left, left, 1.0)


def test_nearest_is_exact(spark):
    r = random.Random(5)
    a = [(i, r.uniform(0, 1000), r.uniform(0, 1000)) for i in range(50)]
    b = [(i, r.uniform(0, 1000), r.uniform(0, 1000)) for i in range(12)] + [(90, 9000.0, 9000.0), (91, 500.0, 500.0), (92, 500.0, 500.0)]
    left = spark.createDataFrame(a, "a long, x double, y double")
    right = spark.createDataFrame(b, "b long, u double, v double")
    d = F.sqrt(F.pow(F.col("x") - F.col("u"), 2) + F.pow(F.col("y") - F.col("v"), 2))
    found = nearest(left, right, 20.0, "a", "b", d, POINT, ("u", "v", "u", "v"), ("u", "v"))
    got = {p["a"]: p["b"] for p in found.collect()}
    assert got == {i: min((math.hypot(x - u, y - v), j) for j, u, v in b)[1] for i, x, y in a}
    assert nearest(left, right.limit(0), 20.0, "a", "b", d, POINT, ("u", "v", "u", "v"), ("u", "v")).count() == 0


def _near(parts, xy, radius):
    """Points inside a polygon or at most ``radius`` from its boundary."""
    inside = np.zeros(len(xy), bool)
    gap = np.full(len(xy), np.inf)
    for part in parts:
        for r in part:
            inside ^= _inside(r, xy)
            for p, q in zip(r, r[1:]):
                a, b = np.array([p["x"], p["y"]]), np.array([q["x"], q["y"]])
                t = np.clip(((xy - a) @ (b - a)) / ((b - a) @ (b - a)), 0, 1)
                gap = np.minimum(gap, np.hypot(*(xy - a - t[:, None] * (b - a)).T))
    return inside | (gap <= radius)


STAR = [[ring([(0, 0), (6, 1), (12, 0), (8, 5), (9, 11), (5, 7), (0, 10), (2, 5)])]]
RINGED = [[ring([(0, 0), (20, 0), (20, 20), (0, 20)]), ring([(3, 3), (3, 9), (9, 9), (9, 3)]), ring([(12, 12), (12, 13), (13, 13), (13, 12)])]]


@pytest.mark.parametrize("parts", [SQUARE, HOLED, TWO, ELL, STAR, RINGED, [*ELL, *TWO], [[ring([(0, 0), (0, 4), (1, 4), (1, 1), (4, 1), (4, 0)])]]])
@pytest.mark.parametrize("radius", [0.4, 1.5, 4.0])
def test_buffers_keep_parts_and_holes(parts, radius):
    shells = overlay.grown_rings(parts, radius, 16)
    rng = np.random.default_rng(4)
    xy = rng.uniform(-6, 26, (60000, 2))
    near = _near(parts, xy, radius)
    times = sum(_inside([{"x": x, "y": y} for x, y in s], xy).astype(int) for s in shells)
    assert times.max() <= 1  # pieces do not overlap
    # corners are cut, so next to nothing may be missing outside and nothing is too much
    assert ((times == 1) & ~near).sum() <= 3 and (near & (times == 0)).sum() <= 0.004 * near.sum() + 12
    assert sum(overlay._area(s[:-1]) for s in shells) == pytest.approx(32 * 32 * near.mean(), rel=0.03, abs=1.5)


def test_buffer_of_a_corner_house(spark):
    ell = [[ring([(0, 0), (20, 0), (20, 10), (10, 10), (10, 20), (0, 20)])]]
    shells = overlay.grown_rings(ell, 5.0, 64)
    # area, edges, five corners of a quarter circle, less what the two sides of the inner corner both have
    assert sum(overlay._area(s[:-1]) for s in shells) == pytest.approx(300 + 80 * 5 + 5 * math.pi * 25 / 4 - 25, rel=1e-3)
    rows = spark.createDataFrame([(ell,), (None,), (TWO,)], f"parts {geometry.PARTS}")
    got = [r["a"] for r in rows.select(overlay.round_buffer(5.0, 64)("parts").alias("g")).select(geometry.area("g").alias("a")).collect()]
    assert got[0] == pytest.approx(300 + 400 + 5 * math.pi * 25 / 4 - 25, rel=1e-3) and got[1] is None and 150 < got[2] < 99.6 + 122.6  # both parts, what they share once


def test_closed_forms_are_those_of_polygons(spark):
    """Rectangles on a coarse lattice, so that many touch, and other shapes, which have no closed form."""
    r = random.Random(9)
    rows = []
    for i in range(300):
        boxes = []
        for _ in range(2):
            x, y = r.randrange(0, 12), r.randrange(0, 12)
            boxes.append((float(x), float(y), float(x + r.randrange(1, 6)), float(y + r.randrange(1, 6))))
        flat = [v for b in boxes for v in b]
        rows.append((i, *flat, float(r.randrange(-2, 16)), float(r.randrange(-2, 16)), float(r.randrange(-2, 16)), float(r.randrange(-2, 16))))
    names = [f"{s}{c}" for s in ("aa_", "bb_") for c in BOX]
    table = spark.createDataFrame(rows, "i long, " + ", ".join(f"{n} double" for n in names) + ", px double, py double, qx double, qy double")
    a_box, b_box = names[:4], names[4:]
    table = table.withColumn("aa", geometry.rect(*a_box)).withColumn("bb", geometry.rect(*b_box)).withColumns({"fa": geometry.is_box("aa"), "fb": geometry.is_box("bb")})
    cut, plain = geometry.way_within("aa", "fa", a_box, ("px", "py"), ("qx", "qy")), geometry.segment_cuts("aa", "px", "py", "qx", "qy")
    point, known = geometry.nearest_boundary_point("aa", "fa", a_box, "px", "py"), geometry.closest_point("aa", "px", "py")
    got = table.filter("px <> qx OR py <> qy").select(
        "fa", cut.alias("cut"), plain.alias("plain"), point.alias("point"), known.alias("known"), geometry.box_gap(a_box, b_box).alias("gap"), geometry.polygon_distance("aa", "bb").alias("distance"),
        overlay.shared_area("aa", "bb", "fa", "fb", a_box, b_box).alias("shared"), overlay.overlap_area("aa", "bb").alias("overlap"), geometry.in_polygon("aa", "fa", a_box, "px", "py").alias("is_in"), geometry.contains_point("aa", "px", "py").alias("contained"),
    ).collect()
    assert len(got) > 250
    for x in got:
        assert x["fa"] and x["gap"] == pytest.approx(x["distance"]) and x["shared"] == pytest.approx(x["overlap"], abs=1e-9) and x["is_in"] == x["contained"]
        assert tuple(x["point"]) == pytest.approx(tuple(x["known"]))
        assert (x["cut"] is None) == (x["plain"] is None)
        if x["cut"]:
            assert tuple(x["cut"]) == pytest.approx(tuple(x["plain"]))
    assert [one(spark, geometry.is_box("pp"), pp=p) for p in (SQUARE, HOLED, TWO, ELL, [[ring([(0, 0), (1, 1), (2, 0), (1, -1)])]], [[ring([(0, 0), (1, 1), (2, 0)])]], [], [[]])] == [True, *[False] * 7]


@pytest.mark.parametrize("all_touched", [False, True])
def test_chunks_sum_as_pixels_do(spark, all_touched):
    """Zones of all forms over two overlapping tiles with gaps, by chunk and by pixel."""
    from arborel.operators import canopy
    from arborel.plans import city

    rows = [(i, p) for i, p in enumerate((SQUARE, HOLED, TWO, ELL, STAR, RINGED))]
    r = random.Random(8)
    zones = []
    for i in range(60):
        k, parts = rows[i % len(rows)]
        size, x, y = r.choice([3.0, 25.0, 90.0]), r.uniform(-100, 4900) if i % 3 else 2400.0, r.uniform(-100, 4900)
        zones.append((i, [[[{"x": x + size * p["x"], "y": y + size * p["y"]} for p in g] for g in part] for part in parts]))
    zones.append((99, [[ring([(2450, 100), (2550, 100), (2550, 300), (2450, 300)])]]))
    zones.append((98, [[ring([(90000, 100), (90050, 100), (90050, 300)])]]))
    table = spark.createDataFrame(zones, f"zone long, parts {geometry.PARTS}")
    table = table.withColumns(geometry.bbox("parts"))
    found = []
    for raster in (city.chunks(spark), city.pixels(spark)):
        sums = canopy.zonal(table, canopy.binarised(canopy.merged_tiles(raster)), ["zone"], city.PIXEL, all_touched)
        found.append({x["zone"]: (x["canopy_pixels"], x["total_pixels"]) for x in sums.collect()})
    assert found[0] == found[1] and len(found[0]) > 45 and 99 in found[0] and 98 not in found[0]


def test_medians_are_exact(spark):
    from arborel.operators import spectral

    r = random.Random(11)
    rows = [(r.choice(["a", "b", None]), r.choice([r.uniform(-1, 1), 0.25, None]), r.uniform(0.1, 0.10002)) for _ in range(500)]
    rows += [("one", 0.5, -3.0), ("two", 0.5, 1.0), ("two", 0.75, 2.0), ("none", None, None), ("same", -0.1, 0.0), ("same", -0.1, 0.0)]
    got = {x["u"]: (x["NDVI"], x["NDWI"]) for x in spectral.medians(spark.createDataFrame(rows, "u string, NDVI double, NDWI double"), ["NDVI", "NDWI"], "u").collect()}
    want = {u: tuple(float(np.median([x[k] for x in rows if x[0] == u and x[k] is not None])) if any(x[0] == u and x[k] is not None for x in rows) else None for k in (1, 2)) for u in {x[0] for x in rows}}
    assert got == {u: tuple(v if v is None else pytest.approx(v, abs=1e-12) for v in m) for u, m in want.items()}

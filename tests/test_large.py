"""What went wrong on larger copies of the tables, each in small."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from arborel.functions import geometry
from arborel.operators import parks
from arborel.operators.grid import BOX
from arborel.plans.queries import ORACLE_SQL, QUERIES
from test_oracles import rows

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part")


def both(spark, tmp_path, name, **keys):
    """What the query returns on copies of the smallest tables in which ``keys`` stand for those of a table, and its SQL."""
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    base = duckdb.connect()
    for t in TABLES:
        key = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}.get(t)
        new = f"SELECT o.* REPLACE (n.k AS {key}) FROM (SELECT *, row_number() OVER (ORDER BY {key}) AS place FROM '{SF}/{t}.parquet') o JOIN (SELECT unnest({list(keys[t])}) AS k, generate_subscripts({list(keys[t])}, 1) AS place) n ON (n.place - 1) % (SELECT count(*) FROM '{SF}/{t}.parquet') + 1 = o.place" if t in keys else f"SELECT * FROM '{SF}/{t}.parquet'"
        base.sql(f"COPY ({new}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        base.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    got = QUERIES[name](spark, str(tmp_path))
    want = base.sql(ORACLE_SQL[name])
    return rows(got.columns, got.collect()), rows(want.columns, want.fetchall())


def test_access_along_a_street(spark, tmp_path):
    """Parks with a side on a street: the side's ends are no places of their own."""
    got, want = both(spark, tmp_path, "park_access_points", supplier=[57502, 23449, 7])
    assert got == want and len(got) > 5


def test_nearest_among_many(spark, monkeypatch):
    """Parks by the hundred around every building: no pair is sorted, and the least park of those as near wins."""
    from arborel.operators import grid

    plans = []
    monkeypatch.setattr(grid, "written", lambda df, name, f=grid.written: (plans.append(df._jdf.queryExecution().executedPlan().toString()), f(df, name))[1])
    r = random.Random(5)
    table = lambda n, wide, key: spark.createDataFrame([(i, x := float(r.randrange(300)), y := float(r.randrange(300)), x + r.randrange(1, wide), y + r.randrange(1, wide)) for i in range(n)], f"{key} long, x0 double, y0 double, x1 double, y1 double").withColumn("parts", geometry.rect(*BOX))
    homes, sites = table(300, 15, "building_id"), table(400, 60, "park_id")
    homes = homes.unionByName(spark.createDataFrame([(999, 900.0, 900.0, 910.0, 910.0)], "building_id long, x0 double, y0 double, x1 double, y1 double").withColumn("parts", geometry.rect(*BOX)))
    # a triangle among the parks, which has no closed form
    sites = sites.unionByName(spark.createDataFrame([(-1, 880.0, 880.0, 890.0, 890.0, [[[(880.0, 880.0), (890.0, 880.0), (880.0, 890.0), (880.0, 880.0)]]])], f"park_id long, x0 double, y0 double, x1 double, y1 double, parts {geometry.PARTS}"))
    got = {x["building_id"]: (x["closest_park_site_id"], x["distance_euclidean"]) for x in parks.euclidean(homes, sites).collect()}
    b, p = homes.drop("parts").collect(), sites.filter("park_id >= 0").drop("parts").collect()
    gap = lambda u, v: (max(u.x0 - v.x1, v.x0 - u.x1, 0.0) ** 2 + max(u.y0 - v.y1, v.y0 - u.y1, 0.0) ** 2) ** 0.5
    want = {u.building_id: min((gap(u, v), v.park_id) for v in p) for u in b if u.building_id != 999}
    assert got.pop(999) == (-1, pytest.approx((450.0) ** 0.5, abs=0.05))
    assert got == {k: (i, pytest.approx(d, abs=0.0501)) for k, (d, i) in want.items()}
    assert any("FlatMapCoGroups" in x for x in plans)
    plans.clear()
    nodes = spark.createDataFrame([(i, float(r.randrange(300)), float(r.randrange(300))) for i in range(200)], "node long, x double, y double")
    snaps = {x["building_id"]: (x["snap"], x["node"]) for x in parks.snapped(homes.select("building_id", F.col("x0").alias("x"), F.col("y0").alias("y")), nodes, "building_id").collect()}
    n = nodes.collect()
    assert snaps == {u.building_id: min((math.sqrt((u.x0 - v.x) ** 2 + (u.y0 - v.y) ** 2), v.node) for v in n) for u in b}
    assert plans and not any("SortAggregate" in x for x in plans)


def test_dense_counts_are_no_pairs(spark):
    """Buildings of all forms, some rows of one building, among trees by the hundred, at block borders too."""
    from arborel.operators import trees

    r = random.Random(6)
    table = spark.createDataFrame([(i % 117, x := float(r.randrange(400, 620)), y := float(r.randrange(-120, 620)), x + r.randrange(1, 40), y + r.randrange(1, 700 if i == 5 else 40)) for i in range(120)], "building_id long, x0 double, y0 double, x1 double, y1 double")
    corner = "named_struct('x', {}, 'y', {})".format
    triangle = F.expr(f"array(array(array({corner('x0', 'y0')}, {corner('x1', 'y0')}, {corner('x0', 'y1')}, {corner('x0', 'y0')})))")
    homes = table.withColumn("parts", F.when((F.col("building_id") % 4 == 0) | (F.col("x0") % 7 == 0), triangle).otherwise(geometry.rect(*BOX)))
    places = [(float(r.randrange(380, 660)), float(r.randrange(-150, 660))) for _ in range(1500)] + [(500.0, 500.0)] * 3
    wood = spark.createDataFrame([(i, x, y, 20.0, 9.0) for i, (x, y) in enumerate(places)], "tree_id long, x double, y double, tree_area double, tree_height double")
    pairs = homes.join(wood, geometry.point_distance("parts", "x", "y") <= 25)
    want = {x["building_id"]: x["count"] for x in pairs.groupBy("building_id").count().collect()}
    found = trees.trees_near_buildings(homes, wood, 25.0, keep_zero=False)
    assert {x["building_id"]: x["tree_count_25m"] for x in found.collect()} == want and max(want.values()) > 40
    plan = trees.trees_near_buildings(homes.filter("building_id % 4 > 0"), wood, 25.0)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" in plan


def test_crowns_around_rectangles(spark):
    """Rectangles and triangles as footprints and crowns: the closed form is the area of the polygons."""
    from arborel.functions import overlay
    from arborel.operators import canopy

    r = random.Random(7)
    boxes = [(x := r.uniform(0, 60), y := r.uniform(0, 60), x + r.uniform(1, 20), y + r.uniform(1, 20)) for _ in range(400)]
    ring = lambda *points: [[[{"x": x, "y": y} for x, y in (*points, points[0])]]]
    shapes = [ring((x0, y0), (x1, y0), (x1, y1), (x0, y1)) if i % 5 else ring((x0, y0), (x1, y0), (x0, y1)) for i, (x0, y0, x1, y1) in enumerate(boxes)]
    table = lambda some, key: spark.createDataFrame([(i, *boxes[i], shapes[i]) for i in some], f"{key} long, x0 double, y0 double, x1 double, y1 double, parts {geometry.PARTS}")
    homes, crowns = range(12), range(12, 400)
    found = canopy.cover_near_buildings(table(homes, "building_id"), table(crowns, "tree_id"), 7.5).collect()
    grown = {i: [[[{"x": x, "y": y} for x, y in s]] for s in overlay.grown_rings(shapes[i], 7.5, 8)] for i in homes}
    want = {i: sum(overlay.intersection_area(grown[i], shapes[k]) for k in crowns) for i in homes}
    assert {x["building_id"]: x["tree_pixels"] for x in found} == {i: pytest.approx(v, abs=0.0011) for i, v in want.items()}
    areas = {i: sum(overlay._area(s[:-1]) for s in overlay.grown_rings(shapes[i], 7.5, 8)) for i in homes}
    assert {x["building_id"]: x["total_pixels"] for x in found} == {i: pytest.approx(v, abs=0.51) for i, v in areas.items()}


def test_sightlines_in_blocks(spark, monkeypatch):
    """Dense rectangles over block borders: blocks find what joins of pairs and obstacles find, repeated keys and other forms included."""
    from arborel.operators import sightlines, visibility

    r = random.Random(8)
    kinds = "building_id long, x0 double, y0 double, x1 double, y1 double, building_height double"
    boxes = [(i, x := float(r.randrange(430, 570)), y := float(r.randrange(-70, 70)), x + r.randrange(1, 12), y + r.randrange(1, 12), float(r.randrange(1, 30)) if i % 9 else None) for i in range(130)]
    homes = spark.createDataFrame([*boxes, (7, 500.0, -40.0, 508.0, -30.0, 6.0), (900, 440.0, -2.0, 560.0, 1.0, 3.0)], kinds).withColumn("parts", geometry.rect(*BOX))
    wood = spark.createDataFrame([(i % 78, x := float(r.randrange(430, 570)), y := float(r.randrange(-70, 70)), s := float(r.randrange(1, 5)), 1.5 + r.randrange(20)) for i in range(80)], "tree_id long, x double, y double, s double, tree_height double")
    wood = wood.selectExpr("*", "x - s AS x0", "y - s AS y0", "x + s AS x1", "y + s AS y1").withColumn("parts", geometry.rect(*BOX)).drop("s")
    corner = "named_struct('x', {}, 'y', {})".format
    triangle = F.expr(f"array(array(array({corner('x0', 'y0')}, {corner('x1', 'y0')}, {corner('x0', 'y1')}, {corner('x0', 'y0')})))")
    seen = lambda df, *keys: {tuple(x[k] for k in keys): tuple(x[c] for c in sorted(df.columns) if c not in keys) for x in df.collect()}
    monkeypatch.setattr(sightlines, "ASKED", 8)
    for all_homes, observer in ((homes, "facade"), (homes, "centroid"), (homes.withColumn("parts", F.when(F.col("building_id") == 3, triangle).otherwise(F.col("parts"))), "facade")):
        usable = visibility.usable_buildings(all_homes).cache()
        pairs = visibility.sight_pairs(usable, wood, 40.0, observer).cache()
        hidden = visibility.shades(pairs, visibility.obstacles(usable, wood)).cache()
        counts = visibility.visibility(all_homes, wood, 40.0, observer)
        want = seen(visibility.visible_trees(usable.select("building_id").distinct(), pairs, hidden), "building_id")
        assert seen(counts, "building_id") == want and 5 < max(v[0] for v in want.values())
        lines = visibility.blocked_lines(all_homes, wood, 40.0, observer)
        assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, visibility.blocked(pairs, hidden).select(lines.columns).collect()))
        found = visibility.sight_lines(usable, wood, 40.0, observer)
        a, b = sorted((x.building_id, x.tree_id, x.sight_len) for x in found.collect()), sorted((x.building_id, x.tree_id, x.way) for x in pairs.collect())
        assert [x[:2] for x in a] == [x[:2] for x in b] and [x[2] for x in a] == pytest.approx([x[2] for x in b], abs=1e-6)
        for df in (counts, lines, found):
            assert "FlatMapGroupsInArrow" in df._jdf.queryExecution().executedPlan().toString()


def test_merged_counts_meet_once(spark):
    """The tree counts of both buffers come from one meeting of buildings and trees, rectangles and other forms alike."""
    from arborel.operators import trees

    plan = QUERIES["merge_units"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("tree_count_100m") and plan.count("n_1") and "n_2" not in plan
    r = random.Random(9)
    homes = spark.createDataFrame([(i, x := float(r.randrange(450, 550)), y := float(r.randrange(100)), x + 9, y + 7) for i in range(40)], "building_id long, x0 double, y0 double, x1 double, y1 double")
    corner = "named_struct('x', {}, 'y', {})".format
    triangle = F.expr(f"array(array(array({corner('x0', 'y0')}, {corner('x1', 'y0')}, {corner('x0', 'y1')}, {corner('x0', 'y0')})))")
    homes = homes.withColumn("parts", F.when(F.col("building_id") % 3 == 0, triangle).otherwise(geometry.rect(*BOX)))
    wood = spark.createDataFrame([(float(r.randrange(430, 570)), float(r.randrange(-20, 120)), 20.0, 9.0) for _ in range(200)], "x double, y double, tree_area double, tree_height double")
    both_at_once = {x["building_id"]: (x["tree_count_5m"], x["tree_count_20m"]) for x in trees.tree_counts(homes, wood, [5, 20]).collect()}
    for k, buffer in enumerate((5, 20)):
        single = trees.trees_near_buildings(homes, wood, buffer).collect()
        assert {x["building_id"]: x[f"tree_count_{buffer}m"] for x in single} == {i: both_at_once.get(i, (0, 0))[k] for i in range(40)}


def test_crowns_in_rectangles_are_no_pairs(spark, monkeypatch):
    """Crowns in footprints and units, over block borders and with other forms too: blocks find what the polygons share."""
    from arborel.functions import overlay
    from arborel.operators import blocks, canopy, grid

    r = random.Random(10)
    boxes = [(x := r.randrange(47000, 53000) / 100, y := r.randrange(-3000, 3000) / 100, x + r.uniform(1, 30), y + r.uniform(1, 20)) for _ in range(330)]
    ring = lambda *points: [[[{"x": x, "y": y} for x, y in (*points, points[0])]]]
    square = [ring((x0, y0), (x1, y0), (x1, y1), (x0, y1)) for x0, y0, x1, y1 in boxes]
    mixed = [s if i % 7 else ring((x0, y0), (x1, y0), (x0, y1)) for i, (s, (x0, y0, x1, y1)) in enumerate(zip(square, boxes))]
    monkeypatch.setattr(blocks, "HOMES", 8)
    for shapes in (square, mixed):
        table = lambda some, key: spark.createDataFrame([(i, *boxes[i], shapes[i]) for i in some], f"{key} long, x0 double, y0 double, x1 double, y1 double, parts {geometry.PARTS}")  # noqa: B023, E731
        homes, crowns = table(range(40), "building_id"), table(range(40, 330), "tree_id")
        want = {i: sum(overlay.intersection_area(shapes[i], shapes[k]) for k in range(40, 330)) for i in range(40)}
        rows = canopy.cover_near_buildings(homes, crowns, 0.0)
        assert {x["building_id"]: x["tree_pixels"] for x in rows.collect()} == {i: pytest.approx(v, abs=0.0011) for i, v in want.items()} and max(want.values()) > 100
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan and ("ArrowEvalPython" in plan) == (shapes is mixed)
        for few in (0, 10_000):
            monkeypatch.setattr(grid, "FEW", few)
            units = homes.withColumnRenamed("building_id", "unit")
            cover = {x["unit"]: x["canopy_cover"] for x in canopy.cover_of_units(units, crowns, ["unit"], stored_area=False).collect()}
            assert cover == {i: pytest.approx(v * 100 / overlay.intersection_area(shapes[i], shapes[i]), abs=0.0011) for i, v in want.items()}


def test_rectangles_in_closed_form(spark):
    """Middle and area of a rectangle are those of its corners to the last digit; no other form is taken for one."""
    corner = lambda *points: [[[{"x": x, "y": y} for x, y in points]]]
    shapes = [corner((0.1, 0.2), (0.7, 0.2), (0.7, 0.5), (0.1, 0.5), (0.1, 0.2)), corner((0.0, 0.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)), corner((1.0, 1.0), (1.0, 3.0), (1.0, 3.0), (1.0, 1.0), (1.0, 1.0)), corner((0.0, 0.0), (1.0, 0.0)), [], None, corner((0.0, 0.0), (2.0, 0.0), (3.0, 1.0), (1.0, 1.0), (0.0, 0.0))]
    rows = spark.createDataFrame(list(enumerate(shapes)), f"i long, parts {geometry.PARTS}").select("i", geometry.is_box("parts").alias("b"), geometry.centroid("parts").alias("c"), geometry.area("parts").alias("a")).orderBy("i").collect()
    assert [x.b for x in rows][:2] == [True, False] and not any(x.b for x in rows[3:])
    assert tuple(rows[0].c) == ((0.1 + 0.7) / 2, (0.2 + 0.5) / 2) and rows[0].a == (0.7 - 0.1) * (0.5 - 0.2)
    assert tuple(rows[1].c) == pytest.approx((2 / 3, 2 / 3)) and rows[1].a == 2 and rows[2].c is None
    assert tuple(rows[6].c) == pytest.approx((1.5, 0.5)) and rows[6].a == 2 and rows[5].a is None


def test_most_ways_are_known_by_their_sector(monkeypatch):
    """Among obstacles by the dozen few ways are held against single ones, and what is told of all pairs is what each obstacle by itself tells."""
    import numpy as np

    from arborel.operators import sightlines, visibility

    r = np.random.default_rng(11)
    x0, y0 = r.integers(-10000, 11000, (2, 1500)) / 100
    box, top = [x0, y0, x0 + r.integers(8, 17, 1500), y0 + r.integers(8, 13, 1500)], r.integers(4, 31, 1500) * 1.0
    x, y, aim, crown = r.integers(0, 2500, 60) / 100, r.integers(0, 2500, 60) / 100, r.integers(3, 20, 60) + 0.5, r.uniform(1, 5, 60)
    x[:5], y[:5] = x0[:5], y0[:5]  # on corners
    rise, stood = np.r_[top, aim], [np.r_[a, b] for a, b in zip(box, (x - crown, y - crown, x + crown, y + crown))]
    own = np.r_[np.arange(1500), 1500 + np.arange(60)]
    own[7] = 3  # an obstacle that is another building's second part
    walked, walk = [], sightlines.Block.walk
    monkeypatch.setattr(sightlines.Block, "walk", lambda self, w: (walked.append(len(w)), walk(self, w))[1])
    for centre in (False, True):
        walked.clear()
        block, homes = sightlines.Block(own, rise, stood, (-120.0, -120.0, 160.0, 160.0)), sightlines.Homes(np.arange(1500), top, box)
        aims = sightlines.Aims(x, y, aim, 1500 + np.arange(60), 1500)
        block.cover(aims, homes)
        told = {(t, h): visibility.ALL for trees, counts, some in sightlines.hidden_pairs(homes, aims, 60.0) for t, h in zip(np.repeat(trees, counts), some)}
        hidden = len(told)
        seen = []
        for w in sightlines.ways(homes, aims, block, 60.0, centre):
            seen.append(w)
            tree, bits, counts, home = visibility.alike(w)
            told |= dict(zip(zip(np.repeat(tree, counts), home), np.repeat(bits, counts)))
        w = sightlines.joined(seen)
        near = sum(int((sightlines._gaps(*box, a, b) <= 3600).sum()) for a, b in zip(x, y))
        assert len(w) + hidden == near and hidden > 0.7 * near and sum(walked) < 0.25 * len(w) and len(told) <= near
        # all pairs by the general relation
        every = sightlines.Aims(x, y, aim, 1500 + np.arange(60), 1500)
        for pairs in sightlines.ways(homes, every, None, 60.0, centre):
            for k in r.choice(len(pairs), min(len(pairs), 1500), replace=False):
                ex, ey, way, eye, t, h = pairs.ex[k], pairs.ey[k], pairs.way[k], pairs.eye[k], pairs.tree[k], pairs.home[k]
                dx, dy = x[t] - ex, y[t] - ey
                with np.errstate(divide="ignore", invalid="ignore"):
                    a, b, c, d = (stood[0] - ex) / dx, (stood[2] - ex) / dx, (stood[1] - ey) / dy, (stood[3] - ey) / dy
                across = (np.where(dx == 0, np.where((stood[0] <= ex) & (ex <= stood[2]), 0.0, np.inf), np.minimum(a, b)), np.where(dy == 0, np.where((stood[1] <= ey) & (ey <= stood[3]), 0.0, np.inf), np.minimum(c, d)))
                lo, hi = np.maximum(np.maximum(*across), 0.0), np.minimum(np.minimum(np.where(dx == 0, 1.0, np.maximum(a, b)), np.where(dy == 0, 1.0, np.maximum(c, d))), 1.0)
                near, far = np.maximum(lo, 0.05 / max(way, 1e-9)), np.minimum(hi, 1 - 0.05 / max(way, 1e-9))
                met = (lo <= hi) & (near <= far) & (own != h) & (own != 1500 + t) & (way > 0)
                bits = sum(int((rise[met] >= np.minimum(e + near[met] * (z - e), e + far[met] * (z - e))).any()) << (3 * i + j) for i, e in enumerate((0.0, eye / 2, eye)) for j, z in enumerate((0.0, aim[t] / 2, aim[t])))
                assert told.get((t, h)) == (bits if met.any() else None), (t, h)


def test_blocked_lines_are_listed_by_tree(spark):
    """Pairs of one tree whose lines are alike leave the blocks as one row, and of rectangles nothing is asked of their corners."""
    import numpy as np

    from arborel.operators import sightlines, visibility

    shade = np.array([[-np.inf] * 3, [9.0, 9.0, 9.0], [9.0, 9.0, 9.0], [2.0, 4.0, 6.0], [9.0, 9.0, 9.0]])
    n, none = len(shade), np.zeros(len(shade))
    w = sightlines.Ways(home=np.arange(n), tree=np.array([4, 4, 4, 4, 1]), ex=none, ey=none, ax=none, ay=none, way=none + 1, eye=none, aim=none + 5, hcode=none, tcode=none, shade=shade)
    tree, bits, counts, home = visibility.alike(w)
    assert [*zip(tree, bits, counts)] == [(1, 511, 1), (4, 0b111011001, 1), (4, 511, 2)] and [*home] == [4, 3, 1, 2]
    plan = QUERIES["visibility_blocked"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(buildings" in plan
    rows = spark.createDataFrame([(0, 1.0, 2.0, 5.0, 4.0)], "i long, x0 double, y0 double, x1 double, y1 double").withColumn("parts", geometry.rect(*BOX))
    corner = "named_struct('x', {}, 'y', {})".format
    turned = F.expr(f"array(array(array({corner('x1', 'y1')}, {corner('x0', 'y1')}, {corner('x0', 'y0')}, {corner('x1', 'y0')}, {corner('x1', 'y1')})))")
    triangle = F.expr(f"array(array(array({corner('x0', 'y0')}, {corner('x1', 'y0')}, {corner('x0', 'y1')}, {corner('x0', 'y0')})))")
    told = lambda df: [x[0] for x in df.select(geometry.is_own_box("parts", BOX)).collect()]
    assert told(rows) == [True] and told(rows.withColumn("parts", turned)) == [True] and told(rows.withColumn("parts", triangle)) == [False]
    assert told(rows.withColumn("parts", F.expr(f"cast(null AS {geometry.PARTS})"))) == [False]

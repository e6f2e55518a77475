"""A city derived from the driver tables: 5 km by 5 km, in metres, of rectangles and a road lattice.

Every relation is a projection of a table, so its size follows the scale factor; in SQL the same
formulas have closed-form predicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborel.functions import geometry

M = 497969
STEP = 250.0
LINES = 21


def _place(k: str, a: int, b: int, c: int) -> Column:
    return F.expr(f"CAST(({k} * {a}L + {k} * {k} * {b}L + {c}L) % {M}L AS DOUBLE) / 100")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _boxed(df: DataFrame) -> DataFrame:
    return df.withColumn("parts", geometry.rect("x0", "y0", "x1", "y1"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """r_name, n_name, box, parts: nations as squares of 1 km; a region is a column of them."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    rows = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    rows = rows.select("r_name", "n_name", ((k % 5) * 1000.0).alias("x0"), (F.floor(k / 5) * 1000.0).alias("y0"))
    return _boxed(rows.withColumns({"x1": F.col("x0") + 1000.0, "y1": F.col("y0") + 1000.0}))


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """building_id, box, building_height (null for each fiftieth), parts."""
    rows = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("building_id"))
    k = F.col("building_id")
    rows = rows.withColumns({"x0": _place("building_id", 7919, 13, 0), "y0": _place("building_id", 104729, 31, 57)})
    rows = rows.withColumns({"x1": F.col("x0") + 10 + k % 7, "y1": F.col("y0") + 8 + k % 5, "building_height": F.when(k % 50 != 0, (4 + k % 27).cast("double"))})
    return _boxed(rows)


def trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tree_id, centroid x and y, tree_height, tree_area, box, parts (a square crown)."""
    rows = _table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("tree_id"), (1 + F.col("p_size").cast("double") / 10).alias("r"))
    rows = rows.withColumns({"x": _place("tree_id", 15485863, 17, 101), "y": _place("tree_id", 32452843, 29, 211), "tree_height": F.lit(1.5) + F.col("tree_id") % 19, "tree_area": 4 * F.col("r") * F.col("r")})
    rows = rows.withColumns({"x0": F.col("x") - F.col("r"), "y0": F.col("y") - F.col("r"), "x1": F.col("x") + F.col("r"), "y1": F.col("y") + F.col("r")})
    return _boxed(rows.drop("r"))


def parks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """park_id, box, parts."""
    rows = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("park_id"))
    side = 60.0 + 10 * (F.col("park_id") % 9)
    rows = rows.withColumns({"x0": _place("park_id", 7919, 13, 0), "y0": _place("park_id", 104729, 31, 57)})
    return _boxed(rows.withColumns({"x1": F.col("x0") + side, "y1": F.col("y0") + side}))


def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """access_id, rank, x, y: the south-west and north-east corners of each park."""
    p = parks(spark, sf_dir)
    corner = F.explode(F.array(F.struct(F.lit(0).alias("i"), F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.lit(1).alias("i"), F.col("x1").alias("x"), F.col("y1").alias("y"))))
    rows = p.select("park_id", corner.alias("c"))
    return rows.select(F.concat(F.col("park_id").cast("string"), F.lit("_acc"), F.col("c.i").cast("string")).alias("access_id"), (F.col("park_id") * 2 + F.col("c.i")).alias("rank"), "c.x", "c.y")


def road_nodes(spark: SparkSession) -> DataFrame:
    """node, x, y on a lattice of 21 by 21."""
    rows = spark.range(LINES * LINES).withColumnRenamed("id", "node")
    return rows.select("node", (F.floor(F.col("node") / LINES) * STEP).alias("x"), (F.col("node") % LINES * STEP).alias("y"))


def road_edges(spark: SparkSession) -> DataFrame:
    """edge_id, u, v, w, and the ends ax, ay, bx, by; even ids run east, odd ones north."""
    rows = spark.range(2 * LINES * LINES).withColumnRenamed("id", "edge_id")
    rows = rows.select("edge_id", F.floor(F.col("edge_id") / 2).alias("u"), (F.col("edge_id") % 2).alias("up"))
    rows = rows.withColumns({"i": F.floor(F.col("u") / LINES), "j": F.col("u") % LINES})
    rows = rows.filter(((F.col("up") == 0) & (F.col("i") < LINES - 1)) | ((F.col("up") == 1) & (F.col("j") < LINES - 1)))
    rows = rows.withColumn("v", F.when(F.col("up") == 0, F.col("u") + LINES).otherwise(F.col("u") + 1))
    rows = rows.withColumns({"ax": F.col("i") * STEP, "ay": F.col("j") * STEP, "w": F.lit(STEP)})
    rows = rows.withColumns({"bx": F.col("ax") + F.when(F.col("up") == 0, STEP).otherwise(0.0), "by": F.col("ay") + F.when(F.col("up") == 1, STEP).otherwise(0.0)})
    return rows.select("edge_id", "u", "v", "w", "ax", "ay", "bx", "by")


PIXEL = 10.0


def pixels(spark: SparkSession) -> DataFrame:
    """tile_id, x, y (centres), value: 500 by 500 pixels in two tiles that overlap by ten columns, with gaps."""
    rows = spark.range(500 * 500).select(F.floor(F.col("id") / 500).alias("i"), (F.col("id") % 500).alias("j"))
    value = F.when((F.col("i") + F.col("j")) % 97 != 0, ((F.col("i") * 31 + F.col("j") * 17 + F.col("i") * F.col("j")) % 700) / 10.0)
    west = rows.filter("i < 250").select(F.lit(0).alias("tile_id"), "i", "j", value.alias("value"))
    east = rows.filter("i >= 240").select(F.lit(1).alias("tile_id"), "i", "j", value.alias("value"))
    return west.unionByName(east).select("tile_id", (F.col("i") * PIXEL + PIXEL / 2).alias("x"), (F.col("j") * PIXEL + PIXEL / 2).alias("y"), "value")


SIDE = 64


def chunks(spark: SparkSession) -> DataFrame:
    """The pixels of the same two tiles in chunks of 64 by 64, as a reader of rasters gives them."""
    tile = spark.createDataFrame([(0, 0, 250), (1, 240, 500)], "tile_id int, i0 long, i1 long")
    rows = tile.withColumn("a", F.explode(F.sequence("i0", F.col("i1") - 1, F.lit(SIDE).cast("long")))).withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(499).cast("long"), F.lit(SIDE).cast("long"))))
    rows = rows.withColumns({"cols": F.least(F.lit(SIDE), F.col("i1") - F.col("a")).cast("int"), "rows": F.least(F.lit(SIDE), 500 - F.col("b")).cast("int")})
    i, j = (lambda p: F.col("a") + p % F.col("cols")), (lambda p: F.col("b") + F.col("rows") - 1 - F.floor(p / F.col("cols")))
    value = lambda p: F.when((i(p) + j(p)) % 97 != 0, ((i(p) * 31 + j(p) * 17 + i(p) * j(p)) % 700) / 10.0)
    values = F.transform(F.sequence(F.lit(0).cast("long"), (F.col("cols") * F.col("rows") - 1).cast("long")), value)
    return rows.select("tile_id", (F.col("a") * PIXEL).alias("x0"), ((F.col("b") + F.col("rows")) * PIXEL).alias("y1"), F.lit(PIXEL).alias("step"), "cols", "rows", values.alias("values"))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """unit, pixel, date, cloud and band values: events as visits of a pixel, embeddings as its reflectance."""
    visits = _table(spark, sf_dir, "events").select(F.col("user_id").alias("pixel"), F.col("ts").alias("date"), (F.col("value") % 100).alias("cloud"), "event_id")
    bands = _table(spark, sf_dir, "embeddings").select(F.col("vec_id"), F.col("label").alias("unit"), *(F.abs(F.col("embedding")[k].cast("double")).alias(b) + F.lit(1.0) for k, b in ((4, "nir"), (8, "red"), (12, "green"), (16, "swir"))))
    names = ["vec_id", "unit", "nir", "red", "green", "swir"]
    return visits.join(bands.toDF(*names), F.col("pixel") == F.col("vec_id"))


def degrees(df: DataFrame) -> DataFrame:
    """Boxes moved to longitude and latitude, for the grids."""
    out = df.withColumns({"x0": 0.10 + F.col("x0") / 1e5, "y0": 52.20 + F.col("y0") / 1e5, "x1": 0.10 + F.col("x1") / 1e5, "y1": 52.20 + F.col("y1") / 1e5})
    return out.withColumn("parts", geometry.rect("x0", "y0", "x1", "y1"))


#: The same relations in DuckDB SQL, as common table expressions.
SQL = {
    "u": "u AS (SELECT r_name, n_name, CAST((n_nationkey % 5) * 1000 AS DOUBLE) AS x0, CAST((n_nationkey // 5) * 1000 AS DOUBLE) AS y0, CAST((n_nationkey % 5) * 1000 + 1000 AS DOUBLE) AS x1, CAST((n_nationkey // 5) * 1000 + 1000 AS DOUBLE) AS y1 FROM nation JOIN region ON n_regionkey = r_regionkey)",
    "b": f"b0 AS (SELECT CAST(c_custkey AS BIGINT) AS k FROM customer), b1 AS (SELECT k, CAST((k*7919 + k*k*13) % {M} AS DOUBLE)/100 AS x0, CAST((k*104729 + k*k*31 + 57) % {M} AS DOUBLE)/100 AS y0 FROM b0), b AS (SELECT k AS building_id, x0, y0, x0 + 10 + k % 7 AS x1, y0 + 8 + k % 5 AS y1, CASE WHEN k % 50 <> 0 THEN CAST(4 + k % 27 AS DOUBLE) END AS h FROM b1)",
    "t": f"t0 AS (SELECT CAST(p_partkey AS BIGINT) AS k, 1 + CAST(p_size AS DOUBLE)/10 AS r FROM part), t AS (SELECT k AS tree_id, r, CAST((k*15485863 + k*k*17 + 101) % {M} AS DOUBLE)/100 AS x, CAST((k*32452843 + k*k*29 + 211) % {M} AS DOUBLE)/100 AS y, CAST(1.5 AS DOUBLE) + k % 19 AS h, 4*r*r AS a FROM t0)",
    "p": f"p0 AS (SELECT CAST(s_suppkey AS BIGINT) AS k FROM supplier), p AS (SELECT k AS park_id, CAST((k*7919 + k*k*13) % {M} AS DOUBLE)/100 AS x0, CAST((k*104729 + k*k*31 + 57) % {M} AS DOUBLE)/100 AS y0, CAST((k*7919 + k*k*13) % {M} AS DOUBLE)/100 + 60 + 10*(k % 9) AS x1, CAST((k*104729 + k*k*31 + 57) % {M} AS DOUBLE)/100 + 60 + 10*(k % 9) AS y1 FROM p0)",
    "g": "g AS (SELECT park_id || '_acc0' AS access_id, park_id * 2 AS rank, x0 AS x, y0 AS y FROM p UNION ALL SELECT park_id || '_acc1', park_id * 2 + 1, x1, y1 FROM p)",
    "n": f"n AS (SELECT range AS node, CAST(range // {LINES} AS DOUBLE) * 250 AS x, CAST(range % {LINES} AS DOUBLE) * 250 AS y FROM range({LINES * LINES}))",
    "e": f"e0 AS (SELECT range AS edge_id, range // 2 AS u, range % 2 AS up, (range // 2) // {LINES} AS i, (range // 2) % {LINES} AS j FROM range({2 * LINES * LINES})), e AS (SELECT edge_id, u, CASE WHEN up = 0 THEN u + {LINES} ELSE u + 1 END AS v, CAST(i AS DOUBLE) * 250 AS ax, CAST(j AS DOUBLE) * 250 AS ay, CAST(i + 1 - up AS DOUBLE) * 250 AS bx, CAST(j + up AS DOUBLE) * 250 AS by_ FROM e0 WHERE (up = 0 AND i < {LINES - 1}) OR (up = 1 AND j < {LINES - 1}))",
    "px": "ij AS (SELECT range // 500 AS i, range % 500 AS j FROM range(250000)), px AS (SELECT i, j, CAST(i AS DOUBLE)*10 + 5 AS x, CAST(j AS DOUBLE)*10 + 5 AS y, CASE WHEN (i + j) % 97 <> 0 THEN CAST((i*31 + j*17 + i*j) % 700 AS DOUBLE)/10 END AS v FROM ij)",
}


def with_sql(names: str, body: str) -> str:
    """``body`` with the named relations in front; a body that begins with a comma adds relations of its own."""
    return "WITH " + ", ".join(SQL[n] for n in names.split()) + ("" if body.startswith(",") else " ") + body

"""Discrete grids over census units: cells, their parent units, and buildings' cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborel.functions import crs, geohash, geometry, rhealpix, s2
from arborel.functions.overlay import overlap_area
from arborel.operators.grid import BOX, POINT, box_join

# The known systems and their resolutions.
RESOLUTIONS = {"h3": (0, 15), "s2": (0, 30), "geohash": (1, 12), "a5": (0, 30), "rhealpix": (0, 15)}


@dataclass(frozen=True)
class System:
    """A discrete grid by name."""

    name: str

    @property
    def range(self) -> tuple[int, int]:
        return RESOLUTIONS[self.name]

    def column_name(self, resolution: int) -> str:
        return f"{self.name}_{resolution}"

    def validate_resolution(self, resolution: int) -> None:
        low, high = self.range
        if isinstance(resolution, bool) or not isinstance(resolution, int) or not low <= resolution <= high:
            raise ValueError(f"{self.name} resolution must be an integer from {low} to {high}, not {resolution!r}")

    def cell(self, lon: Column, lat: Column, resolution: int) -> Column:
        """The cell that holds a point in degrees."""
        self.validate_resolution(resolution)
        if self.name == "geohash":
            return geohash.encode(lon, lat, resolution)
        if self.name == "s2":
            return s2.cell(lon, lat, resolution)
        if self.name == "rhealpix":
            return rhealpix.cell(lon, lat, resolution)
        raise NotImplementedError(f"{self.name} cells are not implemented; geohash, s2 and rhealpix are")

    def covering(self, x0: Column, y0: Column, x1: Column, y1: Column, resolution: int) -> Column:
        """Cells that touch a box of degrees, and maybe some beyond it: array of struct(cell, ring)."""
        self.validate_resolution(resolution)
        if self.name == "geohash":
            ring = lambda c: F.array(*(F.struct(c[a].alias("x"), c[b].alias("y")) for a, b in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))))
            return F.transform(geohash.covering(x0, y0, x1, y1, resolution), lambda c: F.struct(c["cell"].alias("cell"), ring(c).alias("ring")))
        if self.name not in ("s2", "rhealpix"):
            raise NotImplementedError(f"{self.name} coverings are not implemented; those of geohash, s2 and rhealpix are")
        # samples so dense that each cell which touches the box holds one, out to a cell's width around it
        width = (s2 if self.name == "s2" else rhealpix).width(resolution)
        step = width / 2
        far = 3 * width
        stretch = F.greatest(F.cos(F.radians(F.greatest(F.abs(y0), F.abs(y1)))), F.lit(0.05))
        steps = lambda a, b, d: F.sequence(F.lit(0), F.ceil((b - a) / d).cast("int"))
        left, right = x0 - far / stretch, x1 + far / stretch
        low, high = F.greatest(y0 - far, F.lit(-90.0)), F.least(y1 + far, F.lit(90.0))
        points = F.flatten(F.transform(steps(left, right, F.lit(step)), lambda i: F.transform(steps(low, high, F.lit(step)), lambda j: F.struct((left + i * step).alias("x"), F.least(low + j * step, F.lit(90.0)).alias("y")))))
        if self.name == "s2":
            found = F.array_distinct(F.transform(points, lambda p: s2.index(p["x"], p["y"], resolution)))
            return F.transform(found, lambda q: F.struct(s2.name(q, resolution).alias("cell"), s2.outline(q, resolution).alias("ring")))

        found = F.array_distinct(F.transform(points, lambda p: rhealpix.index(p["x"], p["y"], resolution)))
        return F.transform(found, lambda q: F.struct(rhealpix.name(q, resolution).alias("cell"), rhealpix.outline(q, resolution).alias("ring")))


def get_system(name: str) -> System:
    if name not in RESOLUTIONS:
        raise ValueError(f"dggs must be one of {sorted(RESOLUTIONS)}, not {name!r}")
    return System(name)


def _moved(ring: Column, epsg: str | int, back: bool = False) -> Column:
    def point(p: Column) -> Column:
        x, y = (crs.unproject if back else crs.project)(p["x"], p["y"], epsg)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(ring, point)


def grid_pairs(units: DataFrame, codes: list[str], system: System, resolution: int, epsg: str | int = 4326) -> DataFrame:
    """Units once for each cell near them: codes, the unit's parts, cell, and the whole cell as c_parts with its box c_x0 ... .

    Units and cells are in the coordinates of ``epsg``; cells are found in degrees.
    """
    corners = units.select(*codes, "parts", *BOX)
    if epsg != 4326:
        ring = F.array(*(F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))))
        corners = corners.withColumn("_ring", _moved(ring, epsg, back=True))
        corners = corners.withColumns({"x0": F.array_min("_ring.x"), "y0": F.array_min("_ring.y"), "x1": F.array_max("_ring.x"), "y1": F.array_max("_ring.y")})
    cells = corners.select(*codes, "parts", F.explode(system.covering(*(F.col(c) for c in BOX), resolution)).alias("c"))
    ring = F.col("c.ring") if epsg == 4326 else _moved(F.col("c.ring"), epsg)
    rows = cells.select(*codes, "parts", F.col("c.cell").alias("cell"), F.array(F.array(ring)).alias("c_parts"))
    return rows.withColumns({f"c_{k}": v for k, v in geometry.bbox("c_parts").items()})


def finished_grid(pairs: DataFrame, codes: list[str], system: System, resolution: int) -> DataFrame:
    """One row a cell that touches a unit: the cell's name, the codes of its parent, its polygon, box and area (km2).

    The parent is the unit that holds the cell's centre, else the one that the cell overlaps most; the
    least codes where several are as good. Cells stay whole. No cell at all is an error when the rows are read.
    """
    near = F.expr("c_x0 <= array_max(flatten(flatten(parts)).x) AND c_x1 >= array_min(flatten(flatten(parts)).x) AND c_y0 <= array_max(flatten(flatten(parts)).y) AND c_y1 >= array_min(flatten(flatten(parts)).y)")
    touching = pairs.filter(near & geometry.polygons_intersect("c_parts", "parts"))
    centre = touching.withColumn("centre", geometry.centroid("c_parts"))
    ranked = centre.withColumn("holds", geometry.contains_point("parts", "centre.x", "centre.y")).withColumn("share", overlap_area("c_parts", "parts"))
    place = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("holds"), F.desc(F.round("share", 15)), *codes))
    kept = ranked.withColumn("place", place).filter("place = 1")
    return kept.select(F.col("cell").alias(system.column_name(resolution)), *codes, F.col("c_parts").alias("parts"), *(F.col(f"c_{b}").alias(b) for b in BOX), (geometry.area("c_parts") / 1e6).alias("area"))


def cell_overlay(points: DataFrame, grid: DataFrame, key: str, codes: list[str], size: float) -> DataFrame:
    """Each point's grid row: key and codes; the least where several cells hold it."""
    g = grid.select(*codes, *BOX, "parts")
    pairs = box_join(points.select(key, "x", "y"), g, size, 0.0, POINT, BOX, geometry.contains_point("parts", "x", "y"))
    return pairs.groupBy(key).agg(F.min(F.struct(*codes)).alias("u")).select(key, *(F.col(f"u.{c}").alias(c) for c in codes))

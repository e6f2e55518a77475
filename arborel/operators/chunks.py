"""Rasters as chunks: a row holds a rectangle of pixels, so a country at one metre is a table of some hundred thousand rows.

A chunk has tile_id, x0 and y1 (its upper left corner), step (the pixel's size), cols, rows and values, an array of doubles by
row from the top, null or NaN without data. Sums over zones are made chunk by chunk in numpy: zones are dealt to the
chunks that their boxes meet, each chunk travels once, and a zone's parts of all chunks are summed. Rectangles take
two lookups in running sums, other polygons a pass over their pixel rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborel.functions import geometry
from arborel.operators.grid import BOX, box_join
from arborel.operators.lineage import written

_CHUNK = ("tile_id", "x0", "y1", "step", "cols", "rows", "values")
#: Tiles and their chunks meet in cells of this width, about a chunk at one metre.
CELL = 500.0


def is_chunks(raster: DataFrame) -> bool:
    return {"values", "cols", "rows", "step"} <= set(raster.columns)


def _boxes(chunks: DataFrame, prefix: str) -> DataFrame:
    """The chunk's name and box, without its values."""
    x1, y0 = F.col("x0") + F.col("cols") * F.col("step"), F.col("y1") - F.col("rows") * F.col("step")
    return chunks.select(_name().alias(f"{prefix}chunk"), F.col("tile_id").alias(f"{prefix}tile"), F.col("x0").alias(f"{prefix}x0"), y0.alias(f"{prefix}y0"), x1.alias(f"{prefix}x1"), F.col("y1").alias(f"{prefix}y1"))


def _name():
    return F.concat_ws("|", F.col("tile_id").cast("string"), F.col("x0").cast("string"), F.col("y1").cast("string"))


def _rows(batch: pa.RecordBatch, values: str) -> Iterator[dict]:
    """Rows of a batch, with ``values`` as arrays (null as NaN) and not as lists."""
    at = batch.schema.get_field_index(values)
    lists = batch.column(at)
    flat = lists.values.to_numpy(zero_copy_only=False).astype(float)
    cuts = lists.offsets.to_numpy()
    for i, row in enumerate(batch.remove_column(at).to_pylist()):
        yield row | {values: flat[cuts[i] : cuts[i + 1]]}


def _matrix(row: dict) -> np.ndarray:
    return row["values"].reshape(row["rows"], row["cols"])


def merged(chunks: DataFrame) -> DataFrame:
    """Chunks without the pixels that an earlier tile (by tile_id) has data for: where tiles overlap, the first with data counts.

    Only chunks that overlap meet; a pixel of another tile is the one that holds this pixel's centre. Chunks are written first,
    so that files are decoded once, and boxes are read without their pixels.
    """
    chunks = written(chunks.select(*_CHUNK), "chunks")
    inner = lambda c, d: F.col(c) + F.lit(1e-6) < F.col(d)  # noqa: E731  edges that only touch share no pixel
    overlap = inner("l_x0", "e_x1") & inner("e_x0", "l_x1") & inner("l_y0", "e_y1") & inner("e_y0", "l_y1")
    box = lambda p: tuple(f"{p}{c}" for c in BOX)
    pairs = box_join(_boxes(chunks, "l_"), _boxes(chunks, "e_"), CELL, 0.0, box("l_"), box("e_"), (F.col("e_tile") < F.col("l_tile")) & overlap)
    if not pairs.head(1):
        return chunks
    named = chunks.select(_name().alias("chunk"), *_CHUNK)
    others = named.join(pairs.select(F.col("e_chunk").alias("chunk"), F.col("l_chunk").alias("onto")), "chunk").select("onto", F.lit(0).alias("kind"), *_CHUNK)
    dealt = named.select(F.col("chunk").alias("onto"), F.lit(1).alias("kind"), *_CHUNK).unionByName(others)
    schema = chunks.select(*_CHUNK).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, earlier = None, []
        for batch in batches:
            for row in _rows(batch, "values"):
                if row["onto"] != at:
                    at, earlier = row["onto"], []
                if row["kind"] == 0:
                    earlier.append(row)
                    continue
                values = _matrix(row).copy()
                x = row["x0"] + (np.arange(row["cols"]) + 0.5) * row["step"]
                y = row["y1"] - (np.arange(row["rows"]) + 0.5) * row["step"]
                for e in earlier:
                    i, j = np.floor((e["y1"] - y) / e["step"]).astype(int), np.floor((x - e["x0"]) / e["step"]).astype(int)
                    r, c = np.flatnonzero((i >= 0) & (i < e["rows"])), np.flatnonzero((j >= 0) & (j < e["cols"]))
                    part = values[np.ix_(r, c)]
                    part[~np.isnan(_matrix(e)[np.ix_(i[r], j[c])])] = np.nan
                    values[np.ix_(r, c)] = part
                columns = [pa.array([row[k]], batch.schema.field(k).type) for k in _CHUNK[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([values.ravel()], pa.list_(pa.float64()))], [*_CHUNK])

    return written(dealt.repartition("onto").sortWithinPartitions("onto", "kind").mapInArrow(run, schema), "chunks")


def binarised(chunks: DataFrame, low: float, high: float) -> DataFrame:
    """Chunks of 1 where the value is within [low, high], 0 elsewhere, null without data."""
    return chunks.withColumn("values", F.transform("values", lambda v: F.when(v.isNull() | F.isnan(v), F.lit(None)).when(v.between(low, high), 1.0).otherwise(0.0)))


def _edges(parts: list) -> np.ndarray:
    """Edges of all rings: ax, ay, bx, by."""
    rings = [np.array([(p["x"], p["y"]) for p in ring], float) for part in parts for ring in part]
    return np.concatenate([np.concatenate([r[:-1], r[1:]], 1) for r in rings if len(r) > 1] or [np.empty((0, 4))])


class _Chunk:
    """A chunk of 0, 1 and NaN with running sums along its rows, and over both axes."""

    def __init__(self, row: dict):
        values = _matrix(row)
        h, w = values.shape
        self.x = row["x0"] + (np.arange(w) + 0.5) * row["step"]
        self.y = row["y1"] - (np.arange(h) + 0.5) * row["step"]
        self.half = row["step"] / 2
        self.along = np.zeros((2, h, w + 1))
        np.cumsum(np.nan_to_num(values), axis=1, out=self.along[0][:, 1:])
        np.cumsum(~np.isnan(values), axis=1, out=self.along[1][:, 1:])
        self.over = np.zeros((2, h + 1, w + 1))
        np.cumsum(self.along, axis=1, out=self.over[:, 1:])
        self.values = values

    def of_box(self, x0: float, y0: float, x1: float, y1: float, touched: bool) -> np.ndarray:
        """Sum and count of the pixels whose centre is in the box, left and lower edges included, or whose square it touches."""
        if touched:
            a, b = np.searchsorted(self.x + self.half, x0, "left"), np.searchsorted(self.x - self.half, x1, "right")
            c, d = np.searchsorted(-(self.y - self.half), -y1, "left"), np.searchsorted(-(self.y + self.half), -y0, "right")
        else:
            a, b = np.searchsorted(self.x, x0, "left"), np.searchsorted(self.x, x1, "left")
            c, d = np.searchsorted(-self.y, -y1, "right"), np.searchsorted(-self.y, -y0, "right")
        if a >= b or c >= d:
            return np.zeros(2)
        return self.over[:, d, b] - self.over[:, c, b] - self.over[:, d, a] + self.over[:, c, a]

    def of_polygon(self, edges: np.ndarray, touched: bool) -> np.ndarray:
        total = np.zeros(2)
        ax, ay, bx, by = edges.T
        inside = np.zeros(self.values.shape, bool) if touched else None
        rows = np.flatnonzero((self.y < max(ay.max(), by.max())) & (self.y >= min(ay.min(), by.min())))
        for i in rows.tolist():
            cross = (ay > self.y[i]) != (by > self.y[i])
            xs = np.sort((bx[cross] - ax[cross]) * (self.y[i] - ay[cross]) / (by[cross] - ay[cross]) + ax[cross])
            # from the first centre that is not left of a crossing on, up to the next crossing
            at = np.searchsorted(self.x, xs, "left")
            if touched:
                for a, b in zip(at[0::2], at[1::2]):
                    inside[i, a:b] = True
            else:
                total += (self.along[:, i, at[1::2]] - self.along[:, i, at[0::2]]).sum(1)
        if not touched:
            return total
        for x0, y0, x1, y1 in edges.tolist():
            c = np.flatnonzero((self.x + self.half >= min(x0, x1)) & (self.x - self.half <= max(x0, x1)))
            r = np.flatnonzero((self.y + self.half >= min(y0, y1)) & (self.y - self.half <= max(y0, y1)))
            if len(c) and len(r):
                # of the squares in the edge's box, those that do not lie on one side of its line
                off = np.abs((x1 - x0) * (self.y[r][:, None] - y0) - (y1 - y0) * (self.x[c][None, :] - x0))
                inside[np.ix_(r, c)] |= off <= self.half * (abs(x1 - x0) + abs(y1 - y0))
        seen = inside & ~np.isnan(self.values)
        return np.array([self.values[seen].sum(), seen.sum()])


def zonal(zones: DataFrame, chunks: DataFrame, key: list[str], all_touched: bool = False) -> DataFrame:
    """Per zone: canopy_pixels and total_pixels of binarised chunks, as ``canopy.zonal`` has them of pixels."""
    shapes = zones.select(F.struct(*key).alias("zone"), *BOX, "parts", geometry.is_box("parts").alias("is_box"))
    met = box_join(shapes, _boxes(chunks, "c_"), CELL, 0.0, BOX, tuple(f"c_{c}" for c in BOX))
    none = {f.name: F.lit(None).cast(f.dataType) for f in (*shapes.schema.fields, *chunks.select(*_CHUNK).schema.fields)}
    asked = met.select(F.col("c_chunk").alias("chunk"), F.lit(1).alias("kind"), "zone", "is_box", F.when(F.col("is_box"), F.array("x0", "y0", "x1", "y1")).alias("box"), F.when(~F.col("is_box"), F.col("parts")).alias("parts"), *(none[c].alias(f"r_{c}") for c in _CHUNK))
    held = chunks.select(_name().alias("chunk"), F.lit(0).alias("kind"), none["zone"].alias("zone"), F.lit(None).cast("boolean").alias("is_box"), F.lit(None).cast("array<double>").alias("box"), none["parts"].alias("parts"), *(F.col(c).alias(f"r_{c}") for c in _CHUNK))
    zone_type = dict(asked.dtypes)["zone"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chunk = None, None
        for batch in batches:
            zones_out, sums = [], []
            for row in _rows(batch, "r_values"):
                if row["kind"] == 0:
                    at, chunk = row["chunk"], _Chunk({c: row[f"r_{c}"] for c in _CHUNK})
                elif row["chunk"] == at:
                    found = chunk.of_box(*row["box"], all_touched) if row["is_box"] else chunk.of_polygon(_edges(row["parts"]), all_touched)
                    if found[1]:
                        zones_out.append(row["zone"])
                        sums.append(found)
            if sums:
                canopy, total = np.array(sums).round().astype(np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(zones_out, batch.schema.field("zone").type), pa.array(canopy), pa.array(total)], ["zone", "canopy", "total"])

    dealt = held.unionByName(asked).repartition("chunk").sortWithinPartitions("chunk", "kind")
    sums = dealt.mapInArrow(run, f"zone {zone_type}, canopy long, total long").groupBy("zone").agg(F.sum("canopy").alias("canopy_pixels"), F.sum("total").alias("total_pixels"))
    return sums.select(*(F.col(f"zone.{k}").alias(k) for k in key), "canopy_pixels", "total_pixels")

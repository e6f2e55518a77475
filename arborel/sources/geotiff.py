"""GeoTIFF rasters as pixel tables.

Files are read through Spark's binary source and decoded by numpy: strips or tiles, without
compression or with deflate, LZW or PackBits, predictors 1 to 3, integers and floats of 8 to 64
bits, the first band. ``checked`` reads headers only, and tells files that are no rasters.
"""

from __future__ import annotations

import logging
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of the format's types, and the tags that matter here.
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
_FORMS = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT, SCALE, TIEPOINT, KEYS, NODATA = 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
CHUNK = 512

log = logging.getLogger("arborel")


@dataclass
class Raster:
    """Values (nodata as NaN), the upper left corner, the pixel's size and the EPSG code (0 if there is none)."""

    values: np.ndarray
    x0: float
    y0: float
    px: float
    py: float
    epsg: int


def _tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None:
        raise ValueError("not a TIFF file")
    (magic,) = struct.unpack_from(order + "H", data, 2)
    big = magic == 43
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    (at,) = struct.unpack_from(order + ("Q" if big else "I"), data, 8 if big else 4)
    (n,) = struct.unpack_from(order + ("Q" if big else "H"), data, at)
    at += 8 if big else 2
    step, inline = (20, 8) if big else (12, 4)
    out = {}
    for i in range(n):
        tag, kind = struct.unpack_from(order + "HH", data, at + i * step)
        (count,) = struct.unpack_from(order + ("Q" if big else "I"), data, at + i * step + 4)
        size = _SIZES.get(kind, 1) * count
        place = at + i * step + 4 + inline
        if size > inline:
            (place,) = struct.unpack_from(order + ("Q" if big else "I"), data, place)
        if kind == 2:
            out[tag] = (bytes(data[place : place + count]).split(b"\0")[0].decode("latin-1"),)
        elif kind in _FORMS:
            out[tag] = struct.unpack_from(f"{order}{count}{_FORMS[kind]}", data, place)
    return order, out


def _lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, highest bit first, widened one code early."""
    out = bytearray()
    table: list[bytes] = []
    width, held, bits, before = 9, 0, 0, b""
    for byte in data:
        held = held << 8 | byte
        bits += 8
        while bits >= width:
            code = held >> (bits - width) & ((1 << width) - 1)
            bits -= width
            held &= (1 << bits) - 1
            if code == 257:
                return bytes(out)
            if code == 256:
                table = [bytes([i]) for i in range(256)] + [b"", b""]
                width, before = 9, b""
                continue
            if code < len(table):
                entry = table[code]
            elif before:
                entry = before + before[:1]
            else:
                raise ValueError("broken LZW data")
            out += entry
            if before:
                table.append(before + entry[:1])
            before = entry
            width = min(12, max(9, (len(table) + 1).bit_length()))
    return bytes(out)


def _packbits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2
    return bytes(out)


def _unpacked(data: bytes, compression: int) -> bytes:
    if compression == 1:
        return data
    if compression in (8, 32946):
        return zlib.decompress(data)
    if compression == 5:
        return _lzw(data)
    if compression == 32773:
        return _packbits(data)
    raise ValueError(f"unknown compression {compression}")


@dataclass
class Place:
    """Size in pixels, the upper left corner, the pixel's size and the EPSG code (0 if there is none)."""

    width: int
    height: int
    x0: float
    y0: float
    px: float
    py: float
    epsg: int


def _place(t: dict[int, tuple]) -> Place:
    px, py = t[SCALE][:2] if SCALE in t else (1.0, 1.0)
    tie = t.get(TIEPOINT, (0.0,) * 6)
    keys = t.get(KEYS, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    return Place(t[WIDTH][0], t[HEIGHT][0], tie[3] - tie[0] * px, tie[4] + tie[1] * py, px, py, codes.get(3072, codes.get(2048, 0)))


def decode(data: bytes) -> Raster:
    """The first band of a GeoTIFF."""
    data = bytes(data)
    order, t = _tags(data)
    one = lambda tag, default=None: t[tag][0] if tag in t else default
    width, height, samples = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    kind = {1: "u", 2: "i", 3: "f"}[one(FORMAT, 1)] + str(one(BITS, 8) // 8)
    dtype = np.dtype(order + kind)
    planar, predictor = one(PLANAR, 1), one(PREDICTOR, 1)
    if TILES in t:
        w, h, places, sizes = one(TILE_WIDTH), one(TILE_HEIGHT), t[TILES], t[TILE_BYTES]
    else:
        w, h, places, sizes = width, min(one(ROWS, height), height), t[STRIPS], t[STRIP_BYTES]
    across, down = -(-width // w), -(-height // h)
    depth = samples if planar == 1 else 1
    out = np.zeros((height, width), float)
    for k in range(across * down):
        row, column = k // across * h, k % across * w
        rows = h if TILES in t else min(h, height - row)
        if not sizes[k]:
            out[row : row + rows, column : column + w] = np.nan
            continue
        raw = _unpacked(data[places[k] : places[k] + sizes[k]], one(COMPRESSION, 1))
        if predictor == 3:
            planes = np.frombuffer(raw, np.uint8)[: rows * w * depth * dtype.itemsize].reshape(rows, -1)
            planes = _summed(planes, depth).reshape(rows, dtype.itemsize, w * depth)
            block = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(">" + kind).reshape(rows, w, depth)
        else:
            block = np.frombuffer(raw, dtype, rows * w * depth).reshape(rows, w, depth)
            if predictor == 2:
                block = np.cumsum(block.astype(dtype.newbyteorder("=")), axis=1, dtype=dtype.newbyteorder("="))
        part = block[: height - row, : width - column, 0]
        out[row : row + part.shape[0], column : column + part.shape[1]] = part
    if NODATA in t:
        try:
            none = float(str(one(NODATA)).strip())
            out[out == (float(np.float32(none)) if kind == "f4" else none)] = np.nan
        except ValueError:
            pass
    at = _place(t)
    return Raster(out, at.x0, at.y0, at.px, at.py, at.epsg)


def _summed(rows: np.ndarray, step: int) -> np.ndarray:
    """Bytes as running sums with a stride."""
    out = rows.reshape(rows.shape[0], -1, step).copy()
    return np.cumsum(out, axis=1, dtype=np.uint8).reshape(rows.shape)


def encode(values: np.ndarray, x0: float, y0: float, px: float, epsg: int, nodata: float | None = None, deflate: bool = True) -> bytes:
    """A one-band float32 GeoTIFF, for exports and tests."""
    body = np.ascontiguousarray(np.where(np.isnan(values), np.nan if nodata is None else nodata, values), "<f4").tobytes()
    body = zlib.compress(body) if deflate else body
    height, width = values.shape
    entries = [
        (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [32]), (COMPRESSION, 3, [8 if deflate else 1]), (262, 3, [1]), (STRIPS, 4, [0]), (SAMPLES, 3, [1]),
        (ROWS, 4, [height]), (STRIP_BYTES, 4, [len(body)]), (FORMAT, 3, [3]), (SCALE, 12, [px, px, 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, x0, y0, 0.0]),
        (KEYS, 3, [1, 1, 0, 2, 1024, 0, 1, 1, 3072, 0, 1, epsg]),
    ]
    if nodata is not None:
        entries.append((NODATA, 2, [*f"{nodata!r}".encode(), 0]))
    head = 8 + 2 + 12 * len(entries) + 4
    tail, table = b"", b""
    for tag, kind, values_ in sorted(entries):
        raw = bytes(values_) if kind == 2 else struct.pack(f"<{len(values_)}{_FORMS[kind]}", *values_)
        if tag == STRIPS:
            table += struct.pack("<HHI", tag, kind, 1) + b"@@@@"
        elif len(raw) <= 4:
            table += struct.pack("<HHI", tag, kind, len(values_)) + raw.ljust(4, b"\0")
        else:
            table += struct.pack("<HHII", tag, kind, len(values_), head + len(tail))
            tail += raw + b"\0" * (len(raw) % 2)
    table = table.replace(b"@@@@", struct.pack("<I", head + len(tail)))
    return b"II*\0" + struct.pack("<IH", 8, len(entries)) + table + struct.pack("<I", 0) + tail + body


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").option("recursiveFileLookup", "true").load(path).select("path", "content")


def read_chunks(spark: SparkSession, path: str, wanted: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Files as chunks of at most CHUNK by CHUNK pixels: tile_id (the path), x0 and y1 (upper left corner), step, cols, rows and
    values (NaN without data).

    With ``wanted`` (path) only those files are decoded. A file that cannot be is left out, or with ``strict`` an error;
    so is one whose pixels are not square.
    """
    schema = "tile_id string, x0 double, y1 double, step double, cols int, rows int, values array<double>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    r = decode(content.as_py())
                    if abs(r.px - r.py) > 1e-9 * r.px:
                        raise ValueError(f"pixels of {r.px} by {r.py} are not square")
                except (ValueError, KeyError, IndexError, struct.error, zlib.error) as e:
                    if strict:
                        raise ValueError(f"{name} cannot be decoded: {e}") from e
                    log.warning("%s is left out: %s", name, e)
                    continue
                for i in range(0, r.values.shape[0], CHUNK):
                    for j in range(0, r.values.shape[1], CHUNK):
                        part = r.values[i : i + CHUNK, j : j + CHUNK]
                        columns = [[name], [r.x0 + j * r.px], [r.y0 - i * r.py], [r.px], pa.array([part.shape[1]], pa.int32()), pa.array([part.shape[0]], pa.int32()), pa.array([part.ravel()], pa.list_(pa.float64()))]
                        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["tile_id", "x0", "y1", "step", "cols", "rows", "values"])

    files = _files(spark, path)
    if wanted is not None:
        files = files.join(wanted.select("path").distinct(), "path", "left_semi")
    return files.select("path", "content").mapInArrow(rows, schema)


def read_pixels(spark: SparkSession, path: str, wanted: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """The pixels of ``read_chunks`` one by one: tile_id, x, y (centres), value (null without data)."""
    found = read_chunks(spark, path, wanted, strict).select("tile_id", "x0", "y1", "step", "cols", F.posexplode("values").alias("i", "v"))
    x = F.col("x0") + (F.col("i") % F.col("cols") + 0.5) * F.col("step")
    y = F.col("y1") - (F.floor(F.col("i") / F.col("cols")) + 0.5) * F.col("step")
    return found.select("tile_id", x.alias("x"), y.alias("y"), F.when(~F.isnan("v"), F.col("v")).alias("value"))


def checked(spark: SparkSession, path: str, epsg: int) -> DataFrame:
    """path, epsg, width, height, pixel, box (x0 ... y1) and error of each file, from its header alone; error tells files that
    are no rasters or have another EPSG code."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    at = _place(_tags(bytes(content))[1])
                    box = (at.x0, at.y0 - at.height * at.py, at.x0 + at.width * at.px, at.y0)
                    out.append((name, at.epsg, at.width, at.height, at.px, *box, None if at.epsg == epsg else f"EPSG:{at.epsg} is not EPSG:{epsg}"))
                except Exception as e:  # any broken file is told, none stops the others
                    out.append((name, None, None, None, None, None, None, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(out, columns=["path", "epsg", "width", "height", "pixel", "x0", "y0", "x1", "y1", "error"])

    return _files(spark, path).mapInPandas(rows, "path string, epsg int, width int, height int, pixel double, x0 double, y0 double, x1 double, y1 double, error string")

"""Tile catalogues from file paths: kind, tile name, year, and the newest tile of each name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = r"VOM_([A-Z]{2}\d{4})_"


def kind(path: Column) -> Column:
    """HS for hillshade files, else CHM."""
    return F.when(path.contains("VOM_HS_"), "HS").otherwise("CHM")


def tile_name(path: Column, pattern: str = NAME) -> Column:
    """The first group of the pattern, null where it does not occur."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def year(path: Column) -> Column:
    """The year that is a folder of the path, null without one."""
    return F.nullif(F.regexp_extract(path, r"/(\d{4})/", 1), F.lit("")).cast("int")


def other_name(name: Column) -> Column:
    """A tile of 5 km by its other name: TL0045 and TL04NW; null where it is neither."""
    square, code = F.substring(name, 1, 2), F.upper(F.substring(name, 3, 4))
    at = lambda i: F.substring(code, i, 1)
    words = F.concat(F.upper(square), at(1), at(3), F.translate(at(4), "05", "SN"), F.translate(at(2), "05", "WE"))
    digits = F.concat(F.lower(square), at(1), F.translate(at(4), "WE", "05"), at(2), F.translate(at(3), "SN", "05"))
    return F.when(code.rlike(r"^\d[05]\d[05]$"), words).when(code.rlike(r"^\d\d[NS][EW]$"), digits)


def catalogue(paths: DataFrame, path: str = "path", pattern: str = NAME) -> DataFrame:
    """path (without ``file:``), file_type, tile_name and year of each canopy-height file."""
    plain = F.regexp_replace(path, "^file:(?://)?", "")
    found = paths.select(plain.alias("path"), kind(F.col(path)).alias("file_type"), tile_name(F.col(path), pattern).alias("tile_name"), year(F.col(path)).alias("year"))
    return found.filter("file_type = 'CHM'")


def newest(tiles: DataFrame) -> DataFrame:
    """One tile for each name: the latest year, then the least path."""
    best = tiles.groupBy("tile_name").agg(F.max("year").alias("year"), F.min_by("path", F.struct(-F.coalesce("year", F.lit(-1)), F.col("path"))).alias("path"))
    return best.select("tile_name", "year", "path")


def read_catalogue(spark: SparkSession, folder: str, pattern: str = NAME) -> DataFrame:
    """The catalogue of a folder's GeoTIFF files; only names are listed, no contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").option("recursiveFileLookup", "true").load(folder).select("path")
    return catalogue(files, "path", pattern)

"""Building footprints of published datasets, from local or mirrored copies of their Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborel.sources import wkb


def overture_buildings(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """building_id, building_height, shape of footprints whose bbox meets ``box`` (degrees); the bbox columns prune row groups."""
    x0, y0, x1, y1 = box
    rows = spark.read.parquet(path).filter((F.col("bbox.xmin") <= x1) & (F.col("bbox.xmax") >= x0) & (F.col("bbox.ymin") <= y1) & (F.col("bbox.ymax") >= y0))
    return rows.select(F.col("id").alias("building_id"), F.expr("try_cast(height AS DOUBLE)").alias("building_height"), wkb.shape_of("geometry").alias("shape"))


def open_buildings(spark: SparkSession, path: str, confidence: float = 0.7, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """building_id (the plus code, or ob_<number> without one), shape of footprints of enough confidence; there are no heights.

    ``box`` (degrees) prunes by the columns longitude and latitude, where there are any; footprints reach a little beyond their place.
    """
    rows = spark.read.parquet(path).filter(F.col("confidence") >= confidence)
    if box is not None and {"longitude", "latitude"} <= set(rows.columns):
        rows = rows.filter(F.col("longitude").between(box[0] - 0.01, box[2] + 0.01) & F.col("latitude").between(box[1] - 0.01, box[3] + 0.01))
    number = F.concat(F.lit("ob_"), F.abs(F.xxhash64("geometry")).cast("string"))
    name = F.coalesce(F.nullif(F.col("full_plus_code"), F.lit("")), number) if "full_plus_code" in rows.columns else number
    return rows.select(name.alias("building_id"), F.lit(None).cast("double").alias("building_height"), wkb.shape_of("geometry").alias("shape"))

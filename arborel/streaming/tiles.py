"""Zonal sums over tiles as they arrive: each new Parquet tile is counted once, whatever restarts.

The stream reads a folder of pixel tables (tile_id, x, y, value) with ``availableNow``; its
checkpoint remembers the tiles that are done. Every batch adds rows of partial sums to a table,
in a folder named by the batch, so a batch that runs again replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborel.operators import canopy

PIXELS = "tile_id STRING, x DOUBLE, y DOUBLE, value DOUBLE"


def update_sums(spark: SparkSession, tiles: str, units: DataFrame, codes: list[str], pixel_size: float, sums: str, checkpoint: str, low: float = 3.0, high: float = 60.0) -> None:
    """Add the sums of all tiles that have come since the last call; returns when they are done."""

    def add(batch: DataFrame, number: int) -> None:
        found = canopy.zonal(units, canopy.binarised(batch, low, high), codes, pixel_size)
        found.write.mode("overwrite").parquet(f"{sums.rstrip('/')}/batch={number}")

    stream = spark.readStream.schema(PIXELS).option("recursiveFileLookup", "true").parquet(tiles)
    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def cover(spark: SparkSession, sums: str, codes: list[str]) -> DataFrame:
    """canopy_cover and total_pixels of every unit so far; null cover where no pixel had data."""
    total = spark.read.parquet(sums).groupBy(*codes).agg(F.sum("canopy_pixels").alias("canopy_pixels"), F.sum("total_pixels").alias("total_pixels"))
    share = F.try_divide(F.col("canopy_pixels") * F.lit(100.0), F.col("total_pixels").cast("double"))
    return total.select(*codes, F.round(share, 3).alias("canopy_cover"), "total_pixels")

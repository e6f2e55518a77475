"""Spectral indices over a table of band values: filter, composite, median of each unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ratio(a: str, b: str) -> Column:
    return F.try_divide(F.col(a) - F.col(b), F.col(a) + F.col(b))


# The published definitions.
INDICES = {"NDVI": ("nir", "red"), "NDWI": ("green", "nir"), "NDBI": ("swir", "nir")}


def indexed(scenes: DataFrame, indices: list[str], start: str, end: str, cloud: float) -> DataFrame:
    """Scenes within [start, end) and under the cloud percentage, with a column for each index."""
    unknown = set(indices) - set(INDICES)
    if unknown:
        raise ValueError(f"unknown spectral indices: {sorted(unknown)}")
    kept = scenes.filter((F.col("date") >= F.lit(start).cast("timestamp")) & (F.col("date") < F.lit(end).cast("timestamp")) & (F.col("cloud") < cloud))
    return kept.withColumns({i: _ratio(*INDICES[i]) for i in indices})


def composite(scenes: DataFrame, indices: list[str], keys: tuple[str, ...] = ("pixel",)) -> DataFrame:
    """The greatest value over time of each index at each pixel."""
    return scenes.groupBy(*keys).agg(*(F.max(i).alias(i) for i in indices))


#: Values are first counted in bins of one in so many.
BINS = 4096.0


def medians(pixels: DataFrame, indices: list[str], unit: str) -> DataFrame:
    """The exact median of each index in each unit, null where it has no values.

    Values are counted in bins, and the bins' running counts tell which one or two hold the middle. Only their values are then put
    in order, as counts of different values, so no task holds all values of a unit.
    """
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("index"), F.col(i).cast("double").alias("value")) for i in indices)))
    values = pixels.select(F.struct(F.col(unit).alias("unit")).alias("of"), each.alias("e")).select("of", "e.index", "e.value").filter("value IS NOT NULL")
    bin_ = F.when(F.isnan("value"), F.lit(2**62)).otherwise(F.floor(F.col("value") * BINS))
    values = values.withColumn("bin", bin_).groupBy("of", "index", "bin", "value").agg(F.count(F.lit(1)).alias("n"))
    sums = values.groupBy("of", "index", "bin").agg(F.sum("n").alias("n"))
    whole, upto = Window.partitionBy("of", "index"), Window.partitionBy("of", "index").orderBy("bin")
    placed = sums.select("of", "index", "bin", (F.sum("n").over(upto) - F.col("n")).alias("before"), F.sum("n").over(upto).alias("after"), F.sum("n").over(whole).alias("all"))
    middle = placed.filter("before <= floor(all / 2) AND after > floor((all - 1) / 2)").select("of", "index", "bin", "before", "all")
    ordered = Window.partitionBy("of", "index", "bin").orderBy("value")
    held = values.join(middle, ["of", "index", "bin"]).withColumn("last", F.col("before") + F.sum("n").over(ordered) - 1).withColumn("first", F.col("last") - F.col("n") + 1)
    at = lambda k: F.max(F.when(F.expr(f"{k} BETWEEN first AND last"), F.col("value")))
    found = held.groupBy("of", "index").agg(((at("floor((all - 1) / 2)") + at("floor(all / 2)")) / 2).alias("m"))
    wide = found.groupBy("of").agg(*(F.max(F.when(F.col("index") == i, F.col("m"))).alias(i) for i in indices))
    # a struct of a null is no null, so units without a name are joined too
    units = pixels.select(F.struct(F.col(unit).alias("unit")).alias("of")).distinct()
    return units.join(wide, "of", "left").select(F.col("of.unit").alias(unit), *indices)

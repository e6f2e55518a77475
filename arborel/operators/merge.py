"""Roll-up of all metrics into one row for each geographic unit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lifted(rows: DataFrame, units: DataFrame, level: str, sub_level: str) -> DataFrame:
    """``rows`` of sub_level units with the level they belong to."""
    if level == sub_level:
        return rows
    return rows.join(units.select(sub_level, level).distinct(), sub_level, "left")


def canopy(t30: DataFrame, units: DataFrame, level: str, sub_level: str) -> DataFrame:
    """canopy_cover of each unit: sub-units weighted by their valid pixels, 2 decimals."""
    rows = lifted(t30, units, level, sub_level)
    mean = F.try_divide(F.sum(F.col("canopy_cover") * F.col("total_pixels")), F.sum("total_pixels").cast("double"))
    return rows.groupBy(level).agg(F.round(mean, 2).alias("canopy_cover"))


def tree_totals(counts: DataFrame, units: DataFrame, level: str, sub_level: str) -> DataFrame:
    return lifted(counts, units, level, sub_level).groupBy(level).agg(F.sum("tree_count").alias("total_trees"))


def building_canopy(by_buffer: dict[int, DataFrame], overlay: DataFrame, level: str) -> DataFrame | None:
    """building_canopy_cover_<buffer>m: mean over a unit's buildings, for each buffer; None without any.

    One long table with a buffer column is grouped once, instead of a full join for each buffer.
    """
    if not by_buffer:
        return None
    long = reduce(DataFrame.unionByName, (df.select("building_id", "canopy_cover", F.lit(b).alias("buffer")) for b, df in by_buffer.items()))
    rows = long.join(overlay.select("building_id", level), "building_id", "left")
    return rows.groupBy(level).agg(*(F.round(F.avg(F.when(F.col("buffer") == b, F.col("canopy_cover"))), 2).alias(f"building_canopy_cover_{b}m") for b in by_buffer))


def spectral_means(spectral: DataFrame, units: DataFrame, level: str, sub_level: str) -> DataFrame:
    """Mean of every index column, 2 decimals."""
    indices = [c for c in spectral.columns if c not in (level, sub_level)]
    return lifted(spectral, units, level, sub_level).groupBy(level).agg(*(F.round(F.avg(c), 2).alias(c) for c in indices))


def with_spectral(canopy_rows: DataFrame, means: DataFrame | None, level: str) -> DataFrame:
    return canopy_rows if means is None else canopy_rows.join(means, level, "left")


def building_metrics(t300: DataFrame, buildings: DataFrame, t3_by_buffer: dict[int, DataFrame]) -> DataFrame:
    """T300 rows of known buildings with their tree counts (0 where there are none) and the optional attributes they have.
    A table that has the counts of several buffers is joined once."""
    extra = [c for c in ("distance_water", "map_use", "building_area") if c in buildings.columns]
    out = t300.join(buildings.select("building_id", *extra), "building_id")
    for table in {id(df): df for df in t3_by_buffer.values()}.values():
        out = out.join(table.select("building_id", *(f"tree_count_{b}m" for b, df in t3_by_buffer.items() if df is table)), "building_id", "left")
    return out.fillna(0, [f"tree_count_{b}m" for b in t3_by_buffer])


def building_means(metrics: DataFrame, overlay: DataFrame, level: str, buffers: list[int]) -> DataFrame:
    """Means of a unit's buildings, 2 decimals: tree counts, both park distances, and the distance to water if it is there."""
    rows = metrics if level in metrics.columns else metrics.join(overlay.select("building_id", level).distinct(), "building_id", "left").distinct()
    means = [F.round(F.avg(f"tree_count_{b}m"), 2).alias(f"tree_count_{b}m") for b in buffers]
    means += [F.round(F.avg("distance_manhattan"), 2).alias("park_distance_manhattan"), F.round(F.avg("distance_euclidean"), 2).alias("park_distance_euclidean")]
    if "distance_water" in rows.columns:
        means.append(F.round(F.avg("distance_water"), 2).alias("water_distance"))
    return rows.groupBy(level).agg(*means)


def merged(means: DataFrame, canopy_rows: DataFrame, totals: DataFrame, building_canopy_rows: DataFrame | None, level: str, buffers: list[int], canopy_buffers: list[int]) -> DataFrame:
    """One row a unit that has buildings; tree columns without value are 0; columns in the published order."""
    out = means.join(canopy_rows, level, "left").join(totals, level, "left")
    if building_canopy_rows is not None:
        out = out.join(building_canopy_rows, level, "left")
    trees = [f"tree_count_{b}m" for b in buffers]
    out = out.fillna(0, ["total_trees", *trees])
    lead = [level, "total_trees", *trees, "canopy_cover", *(f"building_canopy_cover_{b}m" for b in canopy_buffers if building_canopy_rows is not None), "park_distance_manhattan", "park_distance_euclidean"]
    return out.select(*lead, *(c for c in out.columns if c not in lead))

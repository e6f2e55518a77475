"""Command line: one process of a study area, for all of its geographic codes in one job."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborel.config import Config, grid_options, load_config
from arborel.operators import canopy, merge, parks, trees, visibility
from arborel.operators.cells import get_system
from arborel.session import get_spark
from arborel.sources import catalog, sinks

log = logging.getLogger("arborel")

PROCESSES = ("T3", "T30", "T30_buildings", "T300", "Tree_count", "Visibility", "Spectral", "Merge")
FOLDERS = {p: p.lower() for p in PROCESSES}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="arborel", description=__doc__)
    run = p.add_subparsers(dest="command", required=True).add_parser("run", help="run one process over a study area")
    add = run.add_argument
    add("--config", "-c", required=True)
    add("--process", "-p", required=True, choices=PROCESSES)
    add("--geo_level")
    add("--sub_geo_level")
    add("--dggs")
    add("--dggs_resolution", type=int)
    add("--h3_resolution", type=int, help="older spelling of --dggs h3 --dggs_resolution N")
    add("--geo_code")
    add("--csv", action="store_true", help="write one CSV file for each geographic code as well")
    add("--query_method", choices=("rdd", "sql"), default="rdd", help="rdd leaves buildings without trees out of T3, sql counts them 0")
    add("--buffer", type=int, default=100)
    add("--tree_area", type=float, default=10)
    add("--tree_height", type=float, default=3)
    add("--observer_mode", choices=("facade", "centroid"), default="facade")
    add("--low_threshold", type=float, default=3)
    add("--high_threshold", type=float, default=60)
    add("--gee_scale", type=float, default=1.0)
    add("--start_date", default="2024-01-01")
    add("--end_date", default="2024-12-31")
    add("--imagery_ee_path", default="COPERNICUS/S2_HARMONIZED")
    add("--cloud_coverage", type=float, default=10)
    add("--spectral_indexes", nargs="+", default=["NDVI", "NDWI", "NDBI"])
    add("--t3_buffers", nargs="+", type=int, default=[10, 25, 50, 75, 100])
    add("--parallel", action="store_true", help="accepted; all codes run in one job")
    add("--n_workers", type=int, default=2, help="accepted; see --parallel")
    add("--log_level", default="INFO")
    add("--overwrite", action=argparse.BooleanOptionalAction, default=True)
    return p


def checked(args: argparse.Namespace, config: Config) -> argparse.Namespace:
    """Levels and grid of a run, by the rules that hold between options and configuration."""
    levels = config.columns.geo_levels
    if args.geo_level and args.geo_level not in levels:
        raise ValueError(f"--geo_level {args.geo_level!r} is not in columns.geo_levels: {list(levels)}")
    given = {k: getattr(args, k) for k in ("dggs", "dggs_resolution", "h3_resolution") if getattr(args, k) is not None}
    named = any(given)
    if "h3_resolution" not in given:
        for k in ("dggs", "dggs_resolution"):
            if k not in given and getattr(config, k) is not None:
                given[k] = getattr(config, k)
    args.dggs, args.dggs_resolution = grid_options(given)
    if args.dggs and args.process == "Spectral":
        if named:
            raise ValueError("Spectral works on a boundaries asset and takes no --dggs")
        log.warning("Spectral has no grid cells: dggs of the configuration is ignored")
        args.dggs = args.dggs_resolution = None
    if args.dggs:
        if args.sub_geo_level:
            raise ValueError("--sub_geo_level cannot be combined with --dggs, whose cells take its place")
        args.sub_geo_level = get_system(args.dggs).column_name(args.dggs_resolution)
    args.sub_geo_level = args.sub_geo_level or levels[-1]
    if args.process == "Merge":
        args.geo_level = args.geo_level or (args.sub_geo_level if args.dggs else levels[-2] if len(levels) > 1 else levels[0])
    else:
        args.geo_level = args.geo_level or levels[0]
    if args.process == "Spectral" and not config.gee_boundaries_asset:
        raise ValueError("Spectral needs gee_boundaries_asset in the configuration")
    return args


def _with_codes(rows: DataFrame, c: catalog.Catalog, args) -> DataFrame:
    """Building rows with their sub-unit and the code of their partition."""
    codes = c.overlay.select("building_id", F.col(args.geo_level).alias("geo_code"), args.sub_geo_level)
    return rows.join(codes, "building_id", "left")


def result(spark: SparkSession, config: Config, c: catalog.Catalog, args) -> DataFrame:
    """The process's rows for all codes, with ``geo_code``."""
    sub, level = args.sub_geo_level, args.geo_level
    lifted = c.units.select(sub, F.col(level).alias("geo_code")).distinct()
    reach = float(args.buffer if args.process in ("T3", "T30_buildings", "Visibility") else 0)
    if args.process in ("T3", "Tree_count", "Visibility"):
        table = catalog.tree_table(spark, config, c.units, reach)
    if args.process == "T3":
        rows = trees.trees_near_buildings(c.buildings, table, args.buffer, args.query_method == "sql", args.tree_area, args.tree_height)
        return _with_codes(rows, c, args)
    if args.process == "Tree_count":
        return trees.trees_per_unit(c.units, table, [sub]).join(lifted, sub)
    if args.process == "Visibility":
        if "building_height" not in c.buildings.columns:
            raise ValueError("Visibility needs building heights: set columns.building_height_col")
        tall = trees.tall_trees(table, args.tree_area, args.tree_height)
        return _with_codes(visibility.visibility(c.buildings, tall, args.buffer, args.observer_mode), c, args).withColumn("buffer", F.lit(args.buffer))
    if args.process in ("T30", "T30_buildings"):
        if config.data.chm_tiles_dir:
            pixels, step = catalog.canopy_pixels(spark, config, args.low_threshold, args.high_threshold, c.units, reach)
            if args.process == "T30":
                return canopy.raster_cover_of_units(c.units, pixels, [sub], step).join(lifted, sub)
            return _with_codes(canopy.raster_cover_near_buildings(c.buildings, pixels, step, args.buffer), c, args).withColumn("buffer", F.lit(args.buffer))
        if config.data.canopy_height_ee_path:
            raise NotImplementedError("data.canopy_height_ee_path is a remote asset; export it as GeoTIFF tiles and set chm_tiles_dir")
        table = catalog.tree_table(spark, config, c.units, reach)
        if args.process == "T30":
            return canopy.cover_of_units(c.units, table, [sub]).join(lifted, sub)
        return _with_codes(canopy.cover_near_buildings(c.buildings, table, args.buffer), c, args).withColumn("buffer", F.lit(args.buffer))
    if args.process == "T300":
        by_road = parks.network(c.buildings, c.access, c.nodes, c.edges)
        return _with_codes(parks.near_parks(by_road, parks.euclidean(c.buildings, c.parks)), c, args)
    raise NotImplementedError("Spectral runs on a remote imagery service; arborel.operators.spectral works on band tables")


def merged(spark: SparkSession, config: Config, c: catalog.Catalog, args) -> DataFrame:
    """One row a unit from the results that earlier runs have written."""
    base = config.output.base_dir.rstrip("/")
    read = lambda name: spark.read.parquet(f"{base}/{name}")
    level, sub, buffers = args.geo_level, args.sub_geo_level, list(args.t3_buffers)
    for name in ("t30", "t300", "tree_count", *(f"t3_{b}m" for b in buffers)):
        if sinks.written_codes(spark, f"{base}/{name}") is None:
            raise FileNotFoundError(f"{base}/{name}: run its process before Merge")
    around = {b: read(f"t30_buildings_{b}m") for b in sorted({*buffers, 0, 100}) if sinks.written_codes(spark, f"{base}/t30_buildings_{b}m") is not None}
    canopy_rows = merge.canopy(read("t30"), c.units, level, sub)
    if sinks.written_codes(spark, f"{base}/spectral") is not None:
        canopy_rows = merge.with_spectral(canopy_rows, merge.spectral_means(read("spectral").drop("geo_code"), c.units, level, sub), level)
    t300 = read("t300").drop("geo_code", sub, *config.columns.geo_levels)
    metrics = merge.building_metrics(t300, c.buildings, {b: read(f"t3_{b}m") for b in buffers})
    return merge.merged(
        merge.building_means(metrics, c.overlay, level, buffers), canopy_rows, merge.tree_totals(read("tree_count"), c.units, level, sub),
        merge.building_canopy(around, c.overlay, level), level, buffers, list(around),
    )


def run(args: argparse.Namespace) -> None:
    config = load_config(args.config)
    args = checked(args, config)
    spark = get_spark()
    c = catalog.load(spark, config, args.dggs, args.dggs_resolution)
    base = config.output.base_dir.rstrip("/")
    if args.process == "Merge":
        sinks.write_single(merged(spark, config, c, args), f"{base}/database/T3_30_300_spectral.parquet", "parquet")
        return
    rows = result(spark, config, c, args)
    if args.geo_code:
        rows = rows.filter(F.col("geo_code") == args.geo_code)
    name = FOLDERS[args.process] + (f"_{args.buffer}m" if args.process in ("T3", "T30_buildings", "Visibility") else "")
    sinks.write_by_code(sinks.without_nan(rows), f"{base}/{name}", overwrite=args.overwrite)
    if args.csv:
        written = spark.read.parquet(f"{base}/{name}")
        if args.geo_code:
            written = written.filter(F.col("geo_code") == args.geo_code)
        suffix = name[len(FOLDERS[args.process]) :]
        sinks.write_csv_by_code(written, f"{base}/{args.process}", args.process, suffix)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=args.log_level.upper())
    try:
        run(args)
    except (ValueError, FileNotFoundError, NotImplementedError) as e:
        print(f"Error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

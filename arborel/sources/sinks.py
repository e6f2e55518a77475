"""Writing results: one partition for each geographic code, resumable, and single-file exports."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def written_codes(spark: SparkSession, path: str, code: str = "geo_code") -> DataFrame | None:
    """Codes that ``path`` has already, None if there is nothing."""
    try:
        return spark.read.parquet(path).select(code).distinct()
    except AnalysisException:
        return None


def write_by_code(rows: DataFrame, path: str, code: str = "geo_code", overwrite: bool = True) -> None:
    """One folder for each code. Codes that are there are replaced, or with ``overwrite`` off left as they are."""
    if not overwrite:
        done = written_codes(rows.sparkSession, path, code)
        if done is not None:
            rows = rows.join(done, code, "left_anti")
        rows.write.mode("append").partitionBy(code).parquet(path)
        return
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(code).parquet(path)


def _moved(spark: SparkSession, moves: list[tuple[str, str]], done: str) -> None:
    """Rename files, replacing what is there, then delete the folder ``done``; in any file system that Spark writes."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    for old, new in moves:
        target = path(new)
        system = target.getFileSystem(conf)
        system.mkdirs(target.getParent())
        system.delete(target, True)
        if not system.rename(path(old), target):
            raise OSError(f"cannot write {new}")
    path(done).getFileSystem(conf).delete(path(done), True)


def _parts(spark: SparkSession, folder: str) -> list[str]:
    """The part files below a folder."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    files = path(folder).getFileSystem(conf).listFiles(path(folder), True)
    out = []
    while files.hasNext():
        name = files.next().getPath().toString()
        if name.rpartition("/")[2].startswith("part-"):
            out.append(name)
    return sorted(out)


def write_single(rows: DataFrame, path: str, form: str = "csv") -> None:
    """One file of the name ``path``, for results of a few rows a unit; all rows pass through one task."""
    if form not in ("csv", "parquet"):
        raise ValueError("form must be csv or parquet")
    spark, aside = rows.sparkSession, f"{path}.{uuid.uuid4().hex}"
    writer = rows.coalesce(1).write
    writer.option("header", True).csv(aside) if form == "csv" else writer.parquet(aside)
    _moved(spark, [(_parts(spark, aside)[0], path)], aside)


def write_csv_by_code(rows: DataFrame, folder: str, prefix: str, suffix: str = "", code: str = "geo_code") -> None:
    """One CSV file for each code, <folder>/<prefix>_<code><suffix>.csv; a code's rows pass through one task, in the order of
    their first column. Rows without a code are in none."""
    spark, aside = rows.sparkSession, f"{folder.rstrip('/')}/.{uuid.uuid4().hex}"
    named = rows.filter(F.col(code).isNotNull()).withColumn("_code", F.col(code))
    first = next(c for c in rows.columns if c != code)
    named.repartition("_code").sortWithinPartitions("_code", first).write.partitionBy("_code").option("header", True).csv(aside)
    moves = []
    for part in _parts(spark, aside):
        value = unquote(part.rpartition("/")[0].rpartition("_code=")[2])
        moves.append((part, f"{folder.rstrip('/')}/{prefix}_{value}{suffix}.csv"))
    _moved(spark, moves, aside)


def consolidate(spark: SparkSession, pattern: str, schema: str, path: str) -> None:
    """CSV files of a pattern as one Parquet table; the schema is given, so codes such as 0012 stay text."""
    spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(pattern).write.mode("overwrite").parquet(path)


def marked_table(rows: DataFrame, path: str) -> None:
    """A cached table; Spark's success mark is written last, so a table that was cut off does not count as complete."""
    rows.write.mode("overwrite").parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a cached table's success mark is there, in any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def without_nan(rows: DataFrame) -> DataFrame:
    """NaN as null, so that averages and CSV files take it for missing."""
    return rows.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in rows.dtypes))

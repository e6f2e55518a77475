"""Tables written to the shared folder to cut the lineage of loops."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def tables_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``; local sessions that name none get a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="arborel-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/arborel/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the application's folder, read again."""
    spark = df.sparkSession
    path = f"{tables_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Delete all tables that this application has written on the way; results that were not read or written yet are lost with them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(tables_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

"""A local Spark session for command-line use; on a cluster, the session that is there is used."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def get_spark(app: str = "arborel", **conf: str) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return ship(active)
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"} | conf
    return ship(SparkSession.builder.appName(app).config(map=settings).getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """The session, with this package sent to its executors once, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="arborel-"), "arborel.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(package):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark

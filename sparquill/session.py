"""A session with the settings that the engine is planned for."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


_SHIPPED: set[str] = set()


def session(master: str | None = None, **settings: str) -> SparkSession:
    """AQE with coalescing and skew joins; everything else is the cluster's choice unless given. The package goes to the
    executors' Python workers with it."""
    builder = SparkSession.builder.appName("sparquill")
    if master:
        builder = builder.master(master)
    wanted = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    } | {k.replace("__", "."): v for k, v in settings.items()}
    for key, value in wanted.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers of a session, as a zip by Spark's own file server, unless it was sent before."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    _SHIPPED.add(spark.sparkContext.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="sparquill-zip-")
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/sparquill", "zip", os.path.dirname(package), os.path.basename(package)))

"""Session settings the engine is tuned for."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Skips the per-expression call-site capture while plans are built.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def build_session(name: str, **extra: str) -> SparkSession:
    """A session with the engine's settings; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, wherever it was imported from."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="siftworks-"), "siftworks.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)

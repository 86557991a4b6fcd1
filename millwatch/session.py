"""Session settings used by the bench, the tests and stand-alone jobs."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM leaves methods above this size uncompiled: wide rows then run far slower in
    # one generated method than in several.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_sent: set[str] = set()


def get_session(app: str = "millwatch", master: str | None = None, **extra: str) -> SparkSession:
    """Build a session. On a cluster leave ``master`` out and let submit decide."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the Python workers, once per application: it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId not in _sent:
        folder = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="millwatch-"), "millwatch")
        context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(folder), os.path.basename(folder)))
        _sent.add(context.applicationId)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone, which results depend on, and the limit for generated methods; ship the package."""
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(key, SETTINGS[key])
    return ship(spark)

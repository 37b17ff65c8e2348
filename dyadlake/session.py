"""Session defaults: ANSI on, adaptive execution on, UTC."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "dyadlake", **more: str) -> SparkSession:
    """A session with the library's settings; an existing one is reused as it is."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

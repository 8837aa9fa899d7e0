"""Session settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins are planned from sizes measured at run time, and a skewed partition of a join is split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method above 8000 bytes; Spark then splits wide parsing projections into small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """For the owner of a session; no operator and no query changes settings by itself."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark

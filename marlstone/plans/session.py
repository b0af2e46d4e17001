"""A session with the settings the jobs rely on.

Library functions work on any session; only the command line builds one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs an extra exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, settings: Mapping[str, str] | None = None) -> SparkSession:
    """``settings`` may point Spark at an object store, e.g. ``spark.hadoop.fs.s3a.endpoint``."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**ADAPTIVE, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

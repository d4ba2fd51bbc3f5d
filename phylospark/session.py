"""Session settings that suit the library's plans."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution splits skewed joins and merges small shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(name: str = "phylospark", **settings: str) -> SparkSession:
    """A session with the library's settings; ``settings`` come on top (dots as ``__``)."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

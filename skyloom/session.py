"""A session with the settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.chunkBase64String.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("skyloom")
    if master:
        builder = builder.master(master)
    return builder.config(map={**SETTINGS, **settings}).getOrCreate()


def ensure(spark: SparkSession) -> SparkSession:
    """Applies the settings to a session made elsewhere."""
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark

"""Bright spots as a stream: counts and energy per tile and time window, with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid


def tile_activity(points: DataFrame, event_time: str, lateness: str = "1 hour", window: str = "1 day", depth: int = 4, lon: str = "lon", lat: str = "lat", value: str = "value") -> DataFrame:
    x, y = grid.tile_x(depth, F.col(lon)), grid.tile_y(depth, F.col(lat))
    kept = points.withWatermark(event_time, lateness).withColumn("_x", x).withColumn("_y", y)
    out = kept.groupBy(F.window(event_time, window).alias("w"), "_x", "_y").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value) * F.col(value)).alias("energy"))
    return out.select(F.col("w.start").alias("start"), F.col("_x").alias("x"), F.col("_y").alias("y"), "n", "energy")

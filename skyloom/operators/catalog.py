"""The scene catalogue: union of sensors, extents and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import grid

ALI_BANDS = [f"radiance_B{b:02d}" for b in range(2, 11)]


def union(hyperspectral: DataFrame, multispectral: DataFrame) -> DataFrame:
    """Both sensors' rows; a multispectral row's radiance is the sum of its bands'."""
    bands = {c: F.col(c) for c in ALI_BANDS if c in multispectral.columns}
    summed = multispectral.withColumn("radiance", B.total_radiance(bands))
    return hyperspectral.unionByName(summed, allowMissingColumns=True)


def with_centre(rows: DataFrame, corners: str = "corners") -> DataFrame:
    c = grid.centroid(F.col(corners))
    return rows.withColumn("longitude", c["longitude"]).withColumn("latitude", c["latitude"])


def extent(rows: DataFrame) -> DataFrame:
    """Bounds of radiance (the lower is 0 at most) and time over all sensors."""
    return rows.agg(
        F.least(F.min("radiance"), F.lit(0.0)).alias("min_radiance"), F.max("radiance").alias("max_radiance"),
        F.min("acquisition_start").alias("min_time"), F.max("acquisition_start").alias("max_time"),
    )


def select(rows: DataFrame, radiance: tuple[float, float] | None = None, time: tuple[int, int] | None = None, centre: tuple[float, float] | None = None, radius: float = 0.0) -> DataFrame:
    """Rows in the ranges (bounds included) and closer to the centre than `radius` degrees."""
    if radiance:
        rows = rows.where(F.col("radiance").between(*radiance))
    if time:
        rows = rows.where(F.col("acquisition_start").between(*time))
    if centre:
        rows = rows.where(grid.within_degrees(F.col("longitude"), F.col("latitude"), *centre, radius))
    return rows

"""Radiance calibration: scaling, solar irradiance and top-of-atmosphere correction."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: solar irradiance of the nine multispectral bands B02..B10
ALI_IRRADIANCE = {2: 1851.8, 3: 1967.6, 4: 1837.2, 5: 1551.47, 6: 1164.53, 7: 957.46, 8: 451.37, 9: 230.03, 10: 79.61}

# fixed values: (day of year, distance from the sun in astronomical units)
SUN_DISTANCE = [
    (1, 0.9832), (15, 0.9836), (32, 0.9853), (46, 0.9878), (60, 0.9909), (74, 0.9945), (91, 0.9993), (106, 1.0033), (121, 1.0076),
    (135, 1.0109), (152, 1.0140), (166, 1.0158), (182, 1.0167), (196, 1.0165), (213, 1.0149), (227, 1.0128), (242, 1.0092), (258, 1.0057),
    (274, 1.0011), (288, 0.9972), (305, 0.9925), (319, 0.9892), (335, 0.9860), (349, 0.9843), (365, 0.9833), (366, 0.9832375),
]

#: The last band of the visible and near-infrared detector.
LAST_VNIR = 70


def band_number(name: Column) -> Column:
    return F.regexp_replace(name, "^B", "").try_cast("int")


def band_of_file(path: Column) -> Column:
    """The band in the name of a band's file, or an empty string."""
    return F.regexp_extract(path, r"_(B[0-9]+)_[^/]*$", 1)


def wavelength(band: Column) -> Column:
    """Central wavelength of a hyperspectral band, in nanometres."""
    return F.when(band < 70.5, (band - 10) * 10.213 + 446).otherwise((band - 79) * 10.110 + 930)


def wavelength_of(band: int) -> float:
    return (band - 10) * 10.213 + 446 if band < 70.5 else (band - 79) * 10.110 + 930


def irradiance_rule(band: int, kelvin: float = 5772.0) -> float:
    """Solar irradiance (W m-2 um-1) of a hyperspectral band as that of a black body of the sun's
    size and distance.  Measured tables are passed to `hyperion_divide` instead."""
    h, c, k, ratio = 6.62607015e-34, 2.99792458e8, 1.380649e-23, 6.957e8 / 1.495978707e11
    x = wavelength_of(band) * 1e-9
    return math.pi * ratio**2 * 2 * h * c**2 / x**5 / math.expm1(h * c / (x * k * kelvin)) * 1e-6


def irradiance_table(spark: SparkSession, bands=range(1, 243)) -> DataFrame:
    """(band, irradiance) by the rule; a closed list of hyperspectral bands."""
    return spark.createDataFrame([(b, irradiance_rule(b)) for b in bands], "band int, irradiance double")


def _lookup(table: dict[int, float], key: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[key]


def scale_hyperion(v: Column, band: Column, vnir: Column | float, swir: Column | float) -> Column:
    return v / F.when(band <= LAST_VNIR, vnir if isinstance(vnir, Column) else F.lit(vnir)).otherwise(swir if isinstance(swir, Column) else F.lit(swir))


def scale_ali(v: Column) -> Column:
    return v / 300.0


def rescale_ali(v: Column, scale: Column, offset: Column, factor: float = 300.0) -> Column:
    """`factor` is 300 for values divided by 300 at ingest and 30 for those already in tens."""
    return v * factor * scale + offset


def ali_factor(v: Column) -> Column:
    """An aggregate: 300 if the values are whole numbers once multiplied by 300, else 30."""
    return F.when(F.sum(F.rint(v * 300.0) - v * 300.0) < 1e-4, 300.0).otherwise(30.0)


def ali_scaling(l1t: Column, band: Column, what: str) -> Column:
    """Of a two-level metadata map: BANDn_SCALING_FACTOR or BANDn_OFFSET."""
    return l1t["RADIANCE_SCALING"][F.concat(F.lit("BAND"), band.cast("string"), F.lit(f"_{what}"))].cast("double")


def ali_divide(v: Column, band: Column) -> Column:
    return v / _lookup(ALI_IRRADIANCE, band)


def hyperion_divide(pixels: DataFrame, table: DataFrame, value: str = "v", band: str = "band", compat: bool = False) -> DataFrame:
    """Divides by each band's irradiance.  `table` (band, irradiance) has a row for each of at
    most 242 bands, so it is broadcast.  `compat` takes the next band's value."""
    key = F.col(band) + 1 if compat else F.col(band)
    lut = F.broadcast(table.select(F.col("band").alias("_b"), F.col("irradiance").alias("_e")))
    return pixels.join(lut, key == F.col("_b")).withColumn(value, F.col(value) / F.col("_e")).drop("_b", "_e")


def sun_distance(day: Column) -> Column:
    """Linear in between the days of SUN_DISTANCE."""
    out = F.lit(None).cast("double")
    for (d0, v0), (d1, v1) in reversed(list(zip(SUN_DISTANCE, SUN_DISTANCE[1:], strict=False))):
        out = F.when(day <= d1, v0 + (day - d0) * ((v1 - v0) / (d1 - d0))).otherwise(out)
    return out


def top_of_atmosphere(v: Column, day: Column, sun_elevation: Column) -> Column:
    d = sun_distance(day)
    return math.pi * d * d * v / F.sin(F.radians(sun_elevation))


def calibrate(v: Column, band: Column, sensor: Column, l1t: Column, irradiance: Column, day: Column, sun_elevation: Column, factor: float = 300.0) -> Column:
    """The whole pipeline by sensor; `irradiance` is the band's, for the hyperspectral sensor."""
    ali = ali_divide(rescale_ali(v, ali_scaling(l1t, band, "SCALING_FACTOR"), ali_scaling(l1t, band, "OFFSET"), factor), band)
    return top_of_atmosphere(F.when(sensor == "HYPERION", v / irradiance).otherwise(ali), day, sun_elevation)


def sun_max_radiance(sun_elevation: Column) -> Column:
    return F.greatest(F.sin(F.radians(sun_elevation)) * 500.0, F.lit(10.0))

"""Land cover from scenes: calibration, training and class rasters, end to end."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import calib, keys
from ..operators import classify
from ..schema import Analytic

OUTPUTS = ("one", "three", "four")


def load_analytic(where: str, **params) -> Analytic:
    """An analytic by `package.module:name`; a function there gets the keyword parameters."""
    module, _, name = where.partition(":")
    found = getattr(import_module(module), name)
    return found(**params) if params or not hasattr(found, "apply") else found


def calibrated(pixels: DataFrame, bands: list[str], scenes: DataFrame, irradiance: dict[int, float] | None = None, factor: float = 300.0) -> DataFrame:
    """Pixel tables (scene_id, row, col, v) at the top of the atmosphere, by each scene's sensor,
    sun elevation and day.  `irradiance` maps hyperspectral bands to measured values."""
    table = irradiance or {b: calib.irradiance_rule(b) for b in range(1, 243)}
    numbers = [int(b.lstrip("B")) for b in bands]
    of = lambda g, k: keys.l1t_value(F.col("metadata"), g, k)
    pair = lambda gain, shift: F.struct(gain.cast("double").alias("gain"), shift.cast("double").alias("shift"))
    read = scenes.select(
        "scene_id",
        of("PRODUCT_METADATA", "SENSOR_ID").alias("_sensor"),
        F.from_json(F.col("metadata")["L1T"], "map<string,map<string,string>>").alias("_l1t"),
        keys.day_of_year(of("PRODUCT_METADATA", "START_TIME")).alias("_day"),
        of("PRODUCT_PARAMETERS", "SUN_ELEVATION").cast("double").alias("_sun"),
    )
    # calibration is linear, so each scene has a gain and a shift for each band
    hyperion = F.array(*(pair(F.lit(1.0) / F.lit(table.get(n)), F.lit(0.0)) for n in numbers))
    ali = F.array(*(pair(calib.ali_divide(calib.ali_scaling(F.col("_l1t"), F.lit(n), "SCALING_FACTOR") * factor, F.lit(n)), calib.ali_divide(calib.ali_scaling(F.col("_l1t"), F.lit(n), "OFFSET"), F.lit(n))) for n in numbers))
    lines = read.select("scene_id", F.when(F.col("_sensor") == "HYPERION", hyperion).otherwise(ali).alias("_lines"), calib.top_of_atmosphere(F.lit(1.0), F.col("_day"), F.col("_sun")).alias("_top"))
    v = F.zip_with("v", "_lines", lambda x, c: (x * c["gain"] + c["shift"]) * F.col("_top"))
    return pixels.join(lines, "scene_id").select(*(c for c in pixels.columns if c != "v"), v.alias("v"))


def multispectral(pixels: DataFrame, bands: list[str]) -> tuple[DataFrame, list[str]]:
    """Features: the synthesised bands of hyperspectral pixels, or the pixels' own."""
    numbers = [int(b.lstrip("B")) for b in bands]
    if max(numbers) <= 10:
        return pixels.withColumn("features", F.col("v")), bands
    made = B.synthesise(F.col("v"), numbers)
    return pixels.withColumn("features", F.array(*made.values())), list(made)


def training_set(pixels: DataFrame, bands: list[str], cls: str = "class", limit: int = 5000, seed: int = 1) -> DataFrame:
    """(features, class) of calibrated pixels of known class: masked and balanced."""
    rows, _ = multispectral(pixels, bands)
    kept = rows.where(B.mask_truthy(F.col("features"))).select("features", F.col(cls).alias("class"))
    return classify.balance(kept, F.xxhash64(F.lit(seed), F.to_json("features")), limit)


def classified(pixels: DataFrame, bands: list[str], training: DataFrame, classifier: str = "rbf_svm", output: str = "three", ratios: bool = False, fixed_channels: bool = False) -> DataFrame:
    """Calibrated pixels with their class and its raster bands; pixels without data have none.

    `output` is "one" (FLOOD), "three" (clouds, land, water) or "four" (cloud, land, water, forest)."""
    if output not in OUTPUTS:
        raise ValueError(f"output is one of {OUTPUTS}")
    rows, _ = multispectral(pixels, bands)
    model = classify.fit(training, classifier, ratios=ratios)
    found = classify.predict(rows.where(B.mask_truthy(F.col("features"))), model, ratios=ratios)
    if output == "one":
        return found.withColumn("FLOOD", classify.flood_band(F.col("class")))
    return (classify.raster_three if output == "three" else classify.raster_four)(found, fixed_channels)

"""Exploring a region of a scene: spectra, scatters and false-colour images."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands as B
from ..sources.codec import png
from . import tiles


def crop(pixels: DataFrame, x1: int, y1: int, x2: int, y2: int, width: Column | int, height: Column | int) -> DataFrame:
    """Rows of a pixel rectangle, half-open; the far edges are limited to width - 1 and
    height - 1, so a full image loses its last row and column."""
    w = width if isinstance(width, Column) else F.lit(width)
    h = height if isinstance(height, Column) else F.lit(height)
    return pixels.where(
        (F.col("col") >= max(x1, 0)) & (F.col("col") < F.least(F.lit(x2), w - 1)) & (F.col("row") >= max(y1, 0)) & (F.col("row") < F.least(F.lit(y2), h - 1))
    )


def spectrum(pixels: DataFrame, bands: list[str], log: bool = False) -> DataFrame:
    """(pos, band, value): the mean of each band's positive values, or ln(sum) - ln(count); bands
    without any have no row.  Values are summed by band before they move, so each task sends a row
    for each band."""
    each = pixels.select(F.posexplode("v").alias("pos", "x")).where((F.col("x") > 0) & (F.col("pos") < len(bands)))
    sums = each.groupBy("pos").agg(F.sum("x").alias("s"), F.count(F.lit(1)).cast("double").alias("n"))
    value = F.ln("s") - F.ln("n") if log else F.col("s") / F.col("n")
    return sums.select("pos", F.array(*map(F.lit, bands))[F.col("pos")].alias("band"), value.alias("value"))


def scatter(pixels: DataFrame, bands: list[str], horizontal: str, vertical: str) -> DataFrame:
    """(row, col, h, v) of two expressions, without pixels where a band that they use is zero."""
    eh, ev = B.Expression(horizontal, bands), B.Expression(vertical, bands)
    value = lambda b: F.col("v")[bands.index(b)]
    kept = pixels
    for b in dict.fromkeys([*eh.used, *ev.used]):
        kept = kept.where(value(b) != 0)
    return kept.select("row", "col", eh.column(value).alias("h"), ev.column(value).alias("v"))


def false_colour(pixels: DataFrame, bands: list[str], red: str, green: str, blue: str, low: float = 0.0, high: float = 0.0) -> DataFrame:
    """(row, col, r, g, b, a): three expressions in 256 bins between the bounds, or between the
    5 % and 95 % nearest-rank values if the bounds are equal; transparent where a used band is
    zero.  A region without opaque pixels and bounds is an error when it is read."""
    es = [B.Expression(e, bands) for e in (red, green, blue)]
    value = lambda b: F.col("v")[bands.index(b)]
    full = F.lit(True)
    for b in dict.fromkeys(u for e in es for u in e.used):
        full = full & (value(b) != 0)
    shown = pixels.select("row", "col", full.alias("full"), *(e.column(value).alias(n) for e, n in zip(es, "rgb", strict=True)))
    if low == high:
        bounds = tiles.nearest_rank_range(shown.where("full").withColumn("_g", F.lit(1)), ["r", "g", "b"], ["_g"])
        fail = F.raise_error(F.lit("no non-empty pixels were found")).cast("double")
        one = shown.agg(F.lit(1).alias("_g")).join(F.broadcast(bounds), "_g", "left").select(F.coalesce("low", fail).alias("low"), F.coalesce("high", fail).alias("high"), "_g")
        shown = shown.withColumn("_g", F.lit(1)).join(F.broadcast(one), "_g").drop("_g")  # one row
    else:
        shown = shown.withColumn("low", F.lit(low)).withColumn("high", F.lit(high))
    bins = [B.stretch_bins(F.col(c), F.col("low"), F.col("high")).alias(c) for c in "rgb"]
    return shown.select("row", "col", *bins, F.when(F.col("full"), 255).otherwise(0).alias("a"))


def image_bytes(rgba: DataFrame, x1: int, y1: int, width: int, height: int) -> bytes:
    """A PNG of a region; the region must fit the driver, as the image does."""
    t = rgba.select("row", "col", "r", "g", "b", "a").toArrow()
    out = np.zeros((height, width, 4), np.uint8)
    at = t.column("row").to_numpy() - y1, t.column("col").to_numpy() - x1
    for k, name in enumerate("rgba"):
        out[(*at, k)] = t.column(name).to_numpy()
    return png(out)


def extremes(pixels: DataFrame, bands: list[str], names: list[str]) -> DataFrame:
    """The least and greatest value of the named bands."""
    v = F.array(*(F.col("v")[bands.index(n)] for n in names))
    return pixels.agg(F.min(F.array_min(v)).alias("low"), F.max(F.array_max(v)).alias("high"))


def valid_corners(pixels: DataFrame, valid: Column) -> DataFrame:
    """Where the valid area touches its bounding box: for the first and last row and column with
    a valid pixel, the mean position along them."""
    ok = pixels.where(valid)
    rows = ok.groupBy("row").agg(F.avg("col").alias("mean"))
    cols = ok.groupBy("col").agg(F.avg("row").alias("mean"))
    top = rows.agg(F.min("row").alias("top_row"), F.min_by("mean", "row").alias("top_col"), F.max("row").alias("bottom_row"), F.max_by("mean", "row").alias("bottom_col"))
    side = cols.agg(F.min("col").alias("left_col"), F.min_by("mean", "col").alias("left_row"), F.max("col").alias("right_col"), F.max_by("mean", "col").alias("right_row"))
    return top.withColumn("_k", F.lit(1)).join(side.withColumn("_k", F.lit(1)), "_k").drop("_k")  # one row each


def dimensions(scenes: DataFrame) -> DataFrame:
    return scenes.select("scene_id", F.to_json("bands").alias("band_names"), F.array("width", "height", "depth").alias("dimensions"))

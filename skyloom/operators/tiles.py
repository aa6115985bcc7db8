"""Overlay of scenes on tiles, stretching to colours, and the pyramid.

Pixels of tiles are rows (depth, x, y, row, col, ...), with row 0 in the north.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import calib, grid
from ..schema import LayerSpec
from ..shipping import ship
from ..sources.codec import png
from .ranks import at_ranks, between

WIDTH, HEIGHT = 512, 256
TILE = ("depth", "x", "y")


def overlay(pixels: DataFrame, values: list[str], order: list[str], cell: list[str], mask: str = "mask", threshold: float = 0.5 / 255) -> DataFrame:
    """Of each cell, the values of the last valid pixel by `order` (time, then tie-breaks).

    Order-free, so one aggregation does it, partly before the shuffle, and a hot tile's scenes
    never meet in one task unaggregated."""
    valid = pixels.where(F.col(mask) > threshold)
    last = F.max_by(F.struct(*values), F.struct(*order))
    return valid.groupBy(*cell).agg(last.alias("_v")).select(*cell, *(F.col(f"_v.{v}").alias(v) for v in values))


def percentile_range(pixels: DataFrame, bands: list[str], group: list[str], low: float = 5, high: float = 95, floor: float = 10) -> DataFrame:
    """Per group: `low` and `high`, the least lower and the greatest upper percentile among the
    bands, over values above `floor`, or over all where no band has such a value.  Equal bounds
    give the least and greatest value, and if those are equal 0 and 1.

    Percentiles are exact, by ranks, and no task holds a group's values.  Values above the floor are
    the last ones in order, so their ranks are ranks among all."""
    shares = {"low": low / 100, "high": high / 100}
    parts = F.explode(F.array(*(F.struct(F.lit(i).alias("band"), F.col(b).cast("double").alias("v")) for i, b in enumerate(bands))))
    rows = pixels.select(*group, parts.alias("p")).select(*group, F.col("p.band").alias("_band"), F.col("p.v").alias("_value"))
    some = lambda s: lambda n, k: F.when(k > 0, (n - k) + (k - 1) * F.lit(s))
    every = lambda s: lambda n, k: (n - 1) * F.lit(s)
    places = {f"{kind}_{end}": at(s) for kind, at in (("some", some), ("every", every)) for end, s in shares.items()}
    ranks = {"_a": lambda n, k: F.lit(0), "_b": lambda n, k: n - 1}
    for name, at in places.items():
        ranks[f"{name}_0"] = lambda n, k, at=at: F.floor(at(n, k))
        ranks[f"{name}_1"] = lambda n, k, at=at: F.ceil(at(n, k))
    found = at_ranks(rows, [*group, "_band"], "_value", ranks, above=floor)
    value = lambda name: between(F.col(f"{name}_0"), F.col(f"{name}_1"), places[name](F.col("_total"), F.col("_above"))).alias(name)
    found = found.select(*group, *map(value, places), "_a", "_b")
    r = found.groupBy(*group).agg(*((F.min if name.endswith("low") else F.max)(name).alias(name) for name in places), F.min("_a").alias("_a"), F.max("_b").alias("_b"))
    best = lambda end: F.coalesce(F.col(f"some_{end}"), F.col(f"every_{end}")).alias(end)
    return settled(r.select(*group, best("low"), best("high"), "_a", "_b"))


def settled(r: DataFrame) -> DataFrame:
    """Replaces equal bounds by the data's (_a, _b), and those by 0 and 1 if equal too."""
    same, flat = F.col("low") == F.col("high"), F.col("_a") == F.col("_b")
    low = F.when(same & flat, 0.0).when(same, F.col("_a")).otherwise(F.col("low"))
    high = F.when(same & flat, 1.0).when(same, F.col("_b")).otherwise(F.col("high"))
    return r.withColumn("_l", low).withColumn("_h", high).drop("low", "high", "_a", "_b").withColumnsRenamed({"_l": "low", "_h": "high"})


def nearest_rank_range(values: DataFrame, bands: list[str], group: list[str]) -> DataFrame:
    """Per group: the least 5 % and greatest 95 % nearest-rank values among the bands; ranks are
    floor(0.05 n) and min(ceil(0.95 n), n - 1) from 0.  Exact, and no task holds a group's values."""
    parts = F.explode(F.array(*(F.struct(F.lit(b).alias("band"), F.col(b).alias("v")) for b in bands)))
    rows = values.select(*group, parts.alias("p")).select(*group, F.col("p.band").alias("_band"), F.col("p.v").alias("_value"))
    ends = {"low": lambda n: F.floor(n * 0.05), "high": lambda n: F.least(F.ceil(n * 0.95), n - 1)}
    return at_ranks(rows, [*group, "_band"], "_value", ends).groupBy(*group).agg(F.min("low").alias("low"), F.max("high").alias("high"))


def layer_pixels(pixels: DataFrame, spec: LayerSpec, scene: str = "scene_id", mask: str = "mask", sun_elevation: str | None = None) -> DataFrame:
    """Colours r, g, b, a (0 to 255) of a layer, with bounds taken from each tile of each scene.

    `mask` is 0 to 1.  RGB takes three bands; yellow puts one band into red, green and alpha."""
    group = [*TILE, scene]
    names = list(spec.bands)
    pct = lambda s: float(s[:-1]) if isinstance(s, str) and s.endswith("%") else None
    low, high = pct(spec.min_radiance), pct(spec.max_radiance)
    ranged = pixels
    if low is not None or high is not None:  # fixed bounds need no pass over the pixels
        ranges = percentile_range(pixels, names, group, low if low is not None else 5, high if high is not None else 95)
        ranged = pixels.join(ranges.withColumnsRenamed({"low": "_low", "high": "_high"}), group)
    lo = F.col("_low") if low is not None else F.lit(float(spec.min_radiance))
    if spec.max_radiance == "sun":
        hi = calib.sun_max_radiance(F.col(sun_elevation))
    else:
        hi = F.col("_high") if high is not None else F.lit(float(spec.max_radiance))
    colour = [F.floor(B.stretch(F.col(b), lo, hi)).cast("int") for b in names]
    alpha = F.floor(F.greatest(F.least(F.col(mask) * 255.0, F.lit(255.0)), F.lit(0.0))).cast("int")
    rgba = (*colour, alpha) if spec.image_type == "RGB" else (colour[0], colour[0], F.lit(0), colour[0])
    return ranged.select(*pixels.columns, F.lit(spec.name).alias("layer"), *(c.alias(n) for c, n in zip(rgba, "rgba", strict=True)))


def global_pixel(depth: Column, x: Column, y: Column, row: Column, col: Column) -> tuple[Column, Column]:
    """Pixel coordinates at a depth, from the grid's north-west corner."""
    rows = F.pow(F.lit(2.0), depth + 1).cast("bigint")
    return x.cast("bigint") * WIDTH + col, (rows - 1 - y) * HEIGHT + row


def shallower(pixels: DataFrame, levels: int, depth: int = grid.DEEPEST) -> DataFrame:
    """The pyramid `levels` up: every 2**levels-th pixel in each direction of the whole grid.  A
    projection and a filter; nothing is shuffled."""
    step = 1 << levels
    gx, gy = global_pixel(F.lit(depth), F.col("x"), F.col("y"), F.col("row"), F.col("col"))
    rest = [c for c in pixels.columns if c not in (*TILE, "row", "col")]
    kept = pixels.withColumn("_gx", gx).withColumn("_gy", gy).where((F.col("_gx") % step == 0) & (F.col("_gy") % step == 0))
    sx, sy = F.call_function("shiftright", "_gx", F.lit(levels)), F.call_function("shiftright", "_gy", F.lit(levels))
    rows = 1 << (depth - levels + 1)
    div = lambda c, n: F.floor(c / n)
    return kept.select(
        F.lit(depth - levels).alias("depth"),
        div(sx, WIDTH).cast("int").alias("x"),
        (F.lit(rows - 1) - div(sy, HEIGHT)).cast("int").alias("y"),
        (sy % HEIGHT).cast("int").alias("row"),
        (sx % WIDTH).cast("int").alias("col"),
        *rest,
    )


def pyramid(pixels: DataFrame, depth: int = grid.DEEPEST, top: int = 1) -> DataFrame:
    """The pixels of all levels from `depth` up to `top`."""
    out = pixels
    for k in range(1, depth - top + 1):
        out = out.unionByName(shallower(pixels, k, depth).select(*pixels.columns))
    return out


def collate(pixels: DataFrame) -> DataFrame:
    """One step up, tile by tile: every other pixel, put into the parent's quadrant (the block
    form of `shallower`, which it equals).  The reader of one level needs only the next."""
    p = grid.tile_parent(F.col("depth"), F.col("x"), F.col("y"))
    o = grid.tile_offset(F.col("x"), F.col("y"))
    rest = [c for c in pixels.columns if c not in (*TILE, "row", "col")]
    half = pixels.where((F.col("row") % 2 == 0) & (F.col("col") % 2 == 0))
    return half.select(
        p["depth"].alias("depth"), p["x"].alias("x"), p["y"].alias("y"),
        (F.floor(F.col("row") / 2) + (1 - o["dy"]) * (HEIGHT // 2)).cast("int").alias("row"),
        (F.floor(F.col("col") / 2) + o["dx"] * (WIDTH // 2)).cast("int").alias("col"),
        *rest,
    )


def images(pixels: DataFrame, layer: str = "layer") -> DataFrame:
    """(depth, x, y, layer, png): one image for each tile and layer from r, g, b, a pixels.

    A tile has at most WIDTH * HEIGHT pixels, so a group is bounded."""

    def draw(table: pa.Table) -> pa.Table:
        at = table.column("row").to_numpy(), table.column("col").to_numpy()
        rgba = np.zeros((HEIGHT, WIDTH, 4), np.uint8)
        for k, name in enumerate("rgba"):
            rgba[(*at, k)] = table.column(name).to_numpy()
        one = {c: [table.column(c)[0].as_py()] for c in (*TILE, layer)}
        return pa.table({**one, "png": [png(rgba)]}, schema=pa.schema([("depth", pa.int32()), ("x", pa.int32()), ("y", pa.int32()), (layer, pa.string()), ("png", pa.binary())]))

    ship(pixels.sparkSession)
    named = pixels.select(*(F.col(c).cast("int").alias(c) for c in TILE), layer, *(F.col(c).cast("int").alias(c) for c in ("row", "col", *"rgba")))
    return named.groupBy(*TILE, layer).applyInArrow(draw, f"depth int, x int, y int, {layer} string, png binary")

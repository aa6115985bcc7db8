"""The three jobs end to end: tiles and pyramid, bright spots, and region exploration."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid, keys
from ..functions.projection import Projection, pixel_place
from ..operators import geo, points, tiles
from ..schema import Analytic, LayerSpec, chain
from ..shipping import ship
from ..staging import materialise, released
from ..sources import codec, rasters, store


def wide(pixels: DataFrame, bands: list[str], value: str = "v") -> DataFrame:
    """One column for each band instead of an array."""
    rest = [c for c in pixels.columns if c != value]
    return pixels.select(*rest, *(F.col(value)[i].alias(b) for i, b in enumerate(bands)))


def analysed(pixels: DataFrame, bands: list[str], analytics: list[Analytic]) -> tuple[DataFrame, list[str]]:
    return chain(wide(pixels, bands), bands, analytics)


#: What the store keeps of a cell: its colour, and the scene that it is from.
CELL = ("row", "col")
KEPT = (*"rgba", "ts", "scene_id")


def cells_path(path: str) -> str:
    """Where the pixels that are shown lie, beside the images at `path`."""
    return f"{path.rstrip('/')}-cells"


def add_cells(cells: DataFrame, path: str) -> DataFrame:
    """Lays new cells of the deepest level's overlay (layer, depth, x, y, row, col, r, g, b, a, ts,
    scene_id) on the store at `path`, all levels up, and redraws the tiles that they are in.
    Returns these tiles' keys.

    A level's pixel is one of the deepest level's, and of each the last scene's is shown; so every
    level is overlaid by itself, new cells on those of the same blocks, in any order of
    arrival.  Blocks without a new cell are neither read nor written, in cells and images alike."""
    spark, here = cells.sparkSession, cells_path(path)
    touched = materialise(cells.select(*tiles.TILE, "layer").distinct(), "touched")
    with released(spark):
        new = materialise(cells.withColumn("block", store.tile_block(F.col("x"), F.col("y"))), "cells")
        old = store.in_blocks(new, here)
        every = new if old is None else new.unionByName(old)
        place = ["layer", *tiles.TILE, *CELL, "block"]
        last = every.groupBy(*place).agg(F.max_by(F.struct(*KEPT), F.struct("ts", "scene_id")).alias("_v"))
        store.replace_blocks(last.select(*place, *(F.col(f"_v.{c}").alias(c) for c in KEPT)), here)
        shown = store.in_blocks(new, here).join(touched, ["layer", *tiles.TILE], "left_semi")
        store.write_tiles(tiles.images(shown.select("layer", *tiles.TILE, *CELL, *"rgba")), path)
    return touched


def pixels_to_tiles(pixels: DataFrame, bands: list[str], layers: list[LayerSpec], path: str, analytics: list[Analytic] = (), depth: int = grid.DEEPEST, top: int = 1) -> DataFrame:
    """Resampled pixels of scenes (as `geo.tile_scenes` gives them) to images of all levels at `path`, added to
    those that are there.

    One shuffle overlays the scenes, and levels are a filter over its result.  Further scenes, later or
    earlier ones, go on top of or under what is stored, and only the tiles that they touch, up to
    `top`, are redrawn.  Returns the stored table."""
    spark = pixels.sparkSession
    with released(spark):
        # resampled once, as every layer reads them, and those with percentiles twice
        pixels, names = analysed(materialise(pixels, "pixels"), list(bands), list(analytics))
        cells = None
        for spec in layers:
            if not set(spec.bands) <= set(names):
                raise ValueError(f"layer {spec.name} lacks {set(spec.bands) - set(names)}")
            colours = tiles.layer_pixels(pixels, spec)
            one = tiles.overlay(colours, list(KEPT), ["ts", "scene_id"], [*tiles.TILE, *CELL, "layer"])
            levels = tiles.pyramid(one, depth, top)
            cells = levels if cells is None else cells.unionByName(levels)
        add_cells(cells, path)
    return store.read_tiles(spark, path)


def scenes_to_tiles(scenes: DataFrame, bands: list[str], layers: list[LayerSpec], path: str, analytics: list[Analytic] = (), depth: int = grid.DEEPEST, top: int = 1, **resampling) -> DataFrame:
    """Scenes of common bands to images at `path` (see `pixels_to_tiles`), each resampled in one task."""
    return pixels_to_tiles(geo.tile_scenes(scenes, depth, **resampling), bands, layers, path, analytics, depth, top)


def rasters_to_tiles(strips: DataFrame, l1t: DataFrame, bands: tuple[str, ...], layers: list[LayerSpec], path: str, analytics: list[Analytic] = (), depth: int = grid.DEEPEST, top: int = 1, projection: str = "", **resampling) -> DataFrame:
    """Band files, as `rasters.read_strips` reads them, to images at `path` (see `pixels_to_tiles`), by blocks: no
    task holds a scene, of whatever size."""
    with released(strips.sparkSession):
        pixels = geo.tile_blocks(rasters.block_strips(strips, l1t, bands, projection), depth, **resampling)
        start = F.col("l1t")["PRODUCT_METADATA"]["START_TIME"]
        times = l1t.select(F.col("folder").alias("scene_id"), keys.acquisition_time(start).alias("ts"))
        return pixels_to_tiles(pixels.join(times, "scene_id"), sorted(bands), layers, path, analytics, depth, top)


def bright_spots(scenes: DataFrame, bands: list[str], band: str, threshold: float | str, path: str, analytics: list[Analytic] = (), k: int = 10) -> DataFrame:
    """Scenes to bright pixels to clusters to points appended under `path`; returns the points."""
    pixels, names = analysed(codec.pixels_of(scenes), list(bands), list(analytics))
    if band not in names:
        raise ValueError(f"no band {band!r}")
    ship(scenes.sparkSession)
    hot = points.bright(pixels, band, threshold)
    meta = scenes.select("scene_id", keys.geo_transform(F.col("metadata")).alias("_geo"), F.col("metadata")["Projection"].alias("_wkt"), keys.acquisition_time(keys.l1t_value(F.col("metadata"), "PRODUCT_METADATA", "START_TIME")).alias("ts"))
    placed = hot.join(meta, "scene_id")
    x, y = pixel_place(F.col("_geo"), F.col("row"), F.col("col"))

    @F.pandas_udf("longitude double, latitude double")
    def degrees(a: pd.Series, b: pd.Series, wkt: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"longitude": a.astype(float), "latitude": b.astype(float)})
        for w, at in wkt.fillna("").groupby(wkt.fillna("")).groups.items():
            lon, lat = Projection.parse(w).to_degrees(a.loc[at].to_numpy(), b.loc[at].to_numpy())
            out.loc[at, "longitude"], out.loc[at, "latitude"] = lon, lat
        return out

    spots = placed.select(degrees(x, y, F.col("_wkt")).alias("_p"), "ts", F.col(band).alias("intensity")).select("_p.*", "ts", "intensity")
    model = points.kmeans(spots, k)
    found = points.centres(model)
    rows = points.cluster_points(points.cluster_statistics(points.assign(spots, found)), found)
    store.write_points(rows, path)
    return store.read_points(scenes.sparkSession, path)

"""Image files and the text files of a map page."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions import grid
from ..shipping import ship
from .codec import png


class _Files(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class PngFiles(DataSource):
    """A sink (`png_files`) that writes (name, png) rows as files under option `path`, a folder that
    all executors reach.  Files appear whole: they are written beside their place and renamed."""

    @classmethod
    def name(cls) -> str:
        return "png_files"

    def schema(self) -> str:
        return "name string, png binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _PngWriter(self.options["path"])


class _PngWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        os.makedirs(self.path, exist_ok=True)
        names = []
        for row in iterator:
            to = os.path.join(self.path, f"{row.name}.png")
            with open(f"{to}.part-{os.getpid()}", "wb") as f:
                f.write(row.png)
            os.replace(f.name, to)
            names.append(row.name)
        return _Files(names)


def write_png(images: DataFrame, path: str) -> None:
    """Tile images as files named after tile and layer."""
    spark: SparkSession = images.sparkSession
    ship(spark)
    spark.dataSource.register(PngFiles)
    named = images.select(grid.tile_name(F.col("depth"), F.col("x"), F.col("y"), F.col("layer")).alias("name"), "png")
    named.write.format("png_files").mode("append").option("path", path).save()


def preview(raster: DataFrame, bands: tuple[str, str, str], height: int, width: int) -> bytes:
    """A picture of three bands from 0 to 1, such as a class raster's; the image must fit the driver."""
    t = raster.select("row", "col", *(F.greatest(F.least(F.col(b) * 255, F.lit(255.0)), F.lit(0.0)).cast("int").alias(f"c{i}") for i, b in enumerate(bands))).toArrow()
    out = np.zeros((height, width, 3), np.uint8)
    at = t.column("row").to_numpy(), t.column("col").to_numpy()
    for i in range(3):
        out[(*at, i)] = t.column(f"c{i}").to_numpy()
    return png(out)


def map_bundle(folder: str, image: bytes, corners: dict[str, tuple[float, float]]) -> list[str]:
    """A quick-look image and, for each named place, a text file with its longitude and latitude;
    the centre and the bounds are added.  Returns the files' names."""
    os.makedirs(folder, exist_ok=True)
    lons, lats = zip(*corners.values(), strict=True)
    places = {**corners, "center": (sum(lons) / len(lons), sum(lats) / len(lats)), "southwest": (min(lons), min(lats)), "northeast": (max(lons), max(lats))}
    with open(os.path.join(folder, "image.png"), "wb") as f:
        f.write(image)
    for name, (lon, lat) in places.items():
        with open(os.path.join(folder, f"{name}.txt"), "w") as f:
            f.write(f"{lon!r} {lat!r}\n")
    return ["image.png", *(f"{n}.txt" for n in places)]

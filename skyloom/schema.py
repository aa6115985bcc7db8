"""Schemas of scenes, tiles, points and the rest, as Spark DDL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame

STRIP = "struct<index:bigint,strip:binary>"
SCENE = (
    "metadata map<string,string>, bands array<string>, height int, width int, depth int, dtype int, itemsize int, "
    f"nbytes bigint, fortran boolean, byteorder string, data array<{STRIP}>"
)
BYTE_ORDERS = ("LittleEndian", "BigEndian", "NativeEndian", "IgnoreEndian")
PIXEL = "scene_id string, row int, col int, v array<double>"
BLOCK = "scene_id string, band string, height int, width int, data binary"
TILE = "depth int, x int, y int, tile string"
TILE_IMAGE = "row_key string, metadata string, l2png binary"
POINT = "row_key string, tile string, ts bigint, identifier string, longitude double, latitude double, metadata string"
BRIGHT = "key string, longitude double, latitude double, ts bigint, intensity double"
TRAINING = "features array<double>, class int"
CATALOGUE = (
    "directory string, acquisition_start bigint, radiance double, "
    + ", ".join(f"radiance_B{b:02d} double" for b in range(2, 11))
    + ", corners array<array<double>>"
)
L1T = "map<string,map<string,string>>"

#: What numeric readers return where a value is missing.
MISSING_DOUBLE, MISSING_METADATA = -1000.0, "{}"


@dataclass(frozen=True)
class LayerSpec:
    """An image layer.  A bound is a number, a percentile as "p%", or "sun" (upper bound only)."""

    name: str
    bands: tuple[str, ...]
    image_type: str = "RGB"
    min_radiance: float | str = "5%"
    max_radiance: float | str = "95%"

    def __post_init__(self) -> None:
        if self.image_type not in ("RGB", "yellow"):
            raise NotImplementedError(f"image type {self.image_type!r}")
        if len(self.bands) != (3 if self.image_type == "RGB" else 1):
            raise ValueError(f"{self.image_type} layers take {3 if self.image_type == 'RGB' else 1} bands")


class Analytic(Protocol):
    """A per-pixel analytic: takes and returns a wide pixel table with one column for each band."""

    name: str

    def bands_out(self, bands: list[str]) -> list[str]: ...

    def apply(self, pixels: DataFrame, bands: list[str]) -> DataFrame: ...


@dataclass(frozen=True)
class ColumnAnalytic:
    """An analytic made of a function on DataFrames, with keyword parameters."""

    name: str
    outputs: Callable[[list[str]], list[str]]
    body: Callable[..., DataFrame]
    params: dict = field(default_factory=dict)

    def bands_out(self, bands: list[str]) -> list[str]:
        return self.outputs(bands)

    def apply(self, pixels: DataFrame, bands: list[str]) -> DataFrame:
        return self.body(pixels, bands, **self.params)


def chain(pixels: DataFrame, bands: list[str], analytics: list[Analytic]) -> tuple[DataFrame, list[str]]:
    """Applies analytics from left to right; each sees the bands that the one before it left."""
    for a in analytics:
        pixels, bands = a.apply(pixels, bands), a.bands_out(bands)
    return pixels, bands

"""The global longitude/latitude quadtree.

At depth d each axis has 2**(d + 1) indices; tiles are named `Tdd-xxxxx-yyyyy`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DEEPEST = 10
Num = Column | int


def _col(x: Num) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _cells(depth: Num) -> Column:
    return F.pow(F.lit(2.0), _col(depth) + 1)


def tile_x(depth: Num, lon: Column, clamp: bool = False) -> Column:
    """Longitudes wrap into (-180, 180]; the upper edge has the index 2**(d + 1), one past the
    last tile, unless `clamp` puts it into the last."""
    turned = lon + 180.0
    wrapped = turned - 360.0 * (F.ceil(turned / 360.0) - 1)
    x = F.floor(wrapped / 360.0 * _cells(depth))
    return (F.least(x, (_cells(depth) - 1).cast("bigint")) if clamp else x).cast("int")


def tile_y(depth: Num, lat: Column) -> Column:
    """Latitudes outside -90..90 are an error; the north pole is in the last row."""
    n = _cells(depth)
    y = F.least(F.floor((lat + 90.0) / 180.0 * n), (n - 1).cast("bigint"))
    bad = F.raise_error(F.concat(F.lit("latitude out of range: "), lat.cast("string"))).cast("int")
    return F.when(F.abs(lat) > 90.0, bad).otherwise(y.cast("int"))


def tile_index(depth: Num, lon: Column, lat: Column, clamp: bool = False) -> Column:
    return F.struct(_col(depth).cast("int").alias("depth"), tile_x(depth, lon, clamp).alias("x"), tile_y(depth, lat).alias("y"))


def tile_name(depth: Num, x: Column, y: Column, layer: Column | None = None) -> Column:
    name = F.format_string("T%02d-%05d-%05d", _col(depth).cast("int"), x.cast("int"), y.cast("int"))
    return name if layer is None else F.concat(name, F.lit("-"), layer)


def parse_tile(name: Column) -> Column:
    """depth, x and y of a tile's name; null where it is not one."""
    part = lambda i: F.regexp_extract(name, r"^T(\d{2})-(\d{5})-(\d{5})", i)
    number = lambda i: F.when(part(i) != "", part(i)).cast("int")
    return F.struct(number(1).alias("depth"), number(2).alias("x"), number(3).alias("y"))


def tile_corners(depth: Num, x: Column, y: Column) -> Column:
    n = _cells(depth)
    return F.struct(
        (x * 360.0 / n - 180.0).alias("lon_min"),
        ((x + 1) * 360.0 / n - 180.0).alias("lon_max"),
        (y * 180.0 / n - 90.0).alias("lat_min"),
        ((y + 1) * 180.0 / n - 90.0).alias("lat_max"),
    )


def ancestor(index: Column, levels: Num) -> Column:
    """A tile's index on one axis, `levels` up."""
    return F.call_function("shiftright", index, _col(levels).cast("int"))


def tile_parent(depth: Num, x: Column, y: Column) -> Column:
    return F.struct((_col(depth) - 1).cast("int").alias("depth"), ancestor(x, 1).alias("x"), ancestor(y, 1).alias("y"))


def tile_offset(x: Column, y: Column) -> Column:
    """The quadrant of its parent that a tile is."""
    return F.struct(F.pmod(x, F.lit(2)).cast("int").alias("dx"), F.pmod(y, F.lit(2)).cast("int").alias("dy"))


def index_range(depth: Num, lon_min: Column, lon_max: Column, lat_min: Column, lat_max: Column) -> Column:
    """Index bounds (inclusive) of a bounding box."""
    x1, x2, y1, y2 = tile_x(depth, lon_min), tile_x(depth, lon_max), tile_y(depth, lat_min), tile_y(depth, lat_max)
    return F.struct(F.least(x1, x2).alias("x_min"), F.greatest(x1, x2).alias("x_max"), F.least(y1, y2).alias("y_min"), F.greatest(y1, y2).alias("y_max"))


def tiles_between(depth: Num, bounds: Column) -> Column:
    """All tiles within index bounds: array of (depth, x, y)."""
    xs, ys = F.sequence(bounds["x_min"], bounds["x_max"]), F.sequence(bounds["y_min"], bounds["y_max"])
    tile = lambda x, y: F.struct(_col(depth).cast("int").alias("depth"), x.alias("x"), y.alias("y"))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: tile(x, y))))


def view_depth(zoom: Num) -> Column:
    """The tile depth shown at a map zoom."""
    return F.least(_col(zoom) - 2, F.lit(DEEPEST)).cast("int")


def centroid(corners: Column) -> Column:
    """Mean longitude and latitude of [lon, lat] corners."""
    mean = lambda k: F.aggregate(corners, F.lit(0.0), lambda a, c: a + c[k]) / F.size(corners)
    return F.struct(mean(0).alias("longitude"), mean(1).alias("latitude"))


def within_degrees(lon: Column, lat: Column, lon0: float, lat0: float, radius: float) -> Column:
    """Closer than `radius` in degrees on the plane; a radius of 0 takes all."""
    if radius == 0:
        return F.lit(True)
    return F.sqrt((lat - lat0) * (lat - lat0) + (lon - lon0) * (lon - lon0)) < radius


def morton(x: Num, y: Num) -> Column:
    """The bits of x and y (below 2**16 each) taken in turn, y's above x's: tiles near each other
    have near numbers, and a quadtree cell of any level is a range of them."""

    def spread(c: Column) -> Column:
        c = c.cast("bigint")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return c

    return spread(_col(x)).bitwiseOR(F.shiftleft(spread(_col(y)), 1))


def morton_ranges(x_min: int, x_max: int, y_min: int, y_max: int, most: int = 16, depth: int = DEEPEST) -> list[tuple[int, int]]:
    """At most `most` ranges (both ends included) of Morton numbers that hold all tiles of a box, and
    as few others as that allows.

    Cells of the quadtree that the box crosses are split, level by level, as long as the ranges are
    few enough; neighbouring ranges become one."""
    side = 1 << (depth + 2)  # the index of the upper longitude edge is one past the last
    x_min, y_min, x_max, y_max = max(x_min, 0), max(y_min, 0), min(x_max, side - 1), min(y_max, side - 1)
    if x_min > x_max or y_min > y_max:
        return []

    def joined(cells: list[tuple[int, int, bool]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for lo, size, _ in sorted(cells):
            if out and out[-1][1] + 1 == lo:
                out[-1] = (out[-1][0], lo + size - 1)
            else:
                out.append((lo, lo + size - 1))
        return out

    def corner(z: int) -> tuple[int, int]:
        bits = range(depth + 2)
        return sum((z >> (2 * i) & 1) << i for i in bits), sum((z >> (2 * i + 1) & 1) << i for i in bits)

    cells = [(0, side * side, False)]
    while True:
        finer = []
        for lo, size, whole in cells:
            if whole or size == 1:
                finer.append((lo, size, True))
                continue
            for part in range(4):
                at, n = lo + part * size // 4, size // 4
                (x, y), w = corner(at), int(math.isqrt(n))
                if x <= x_max and y <= y_max and x + w > x_min and y + w > y_min:
                    finer.append((at, n, x >= x_min and y >= y_min and x + w - 1 <= x_max and y + w - 1 <= y_max))
        if len(joined(finer)) > most:
            return joined(cells)
        if finer == cells:
            return joined(cells)
        cells = finer


def in_ranges(value: Column, ranges: list[tuple[int, int]]) -> Column:
    """Whether a number is in one of the ranges: comparisons alone, which reach the files' statistics."""
    found = F.lit(False)
    for k, (lo, hi) in enumerate(ranges):
        one = (value >= lo) & (value <= hi)
        found = one if k == 0 else found | one
    return found

"""Scenes onto the tile grid: sections, candidate tiles, affine maps and spline resampling."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from ..functions.projection import Projection
from ..shipping import in_arrow
from ..staging import materialise
from ..sources import codec

# ---- in SQL: sections and candidate tiles ------------------------------------------------------


def sections(n: int) -> Column:
    """Bounds of n latitude stripes, as fractions of the height."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda s: F.struct(s.alias("section"), (s / n).alias("bottom"), ((s + 0.5) / n).alias("middle"), ((s + 1) / n).alias("top")))


def candidate_tiles(scenes: DataFrame, corners: str = "corners", depth: int = grid.DEEPEST) -> DataFrame:
    """(…, depth, x, y): each scene once for every tile in its corners' index range."""
    lons, lats = F.transform(corners, lambda c: c[0]), F.transform(corners, lambda c: c[1])
    xs, ys = F.transform(lons, lambda v: grid.tile_x(depth, v)), F.transform(lats, lambda v: grid.tile_y(depth, v))
    bounds = F.struct(F.array_min(xs).alias("x_min"), F.array_max(xs).alias("x_max"), F.array_min(ys).alias("y_min"), F.array_max(ys).alias("y_max"))
    named = scenes.withColumn("_b", bounds)
    return named.withColumn("_t", F.explode(grid.tiles_between(depth, F.col("_b")))).select(*scenes.columns, "_t.*")


# ---- splines ------------------------------------------------------------------------------------

#: Poles of the B-spline prefilters by order.
POLES = {
    2: [math.sqrt(8) - 3],
    3: [math.sqrt(3) - 2],
    4: [math.sqrt(664 - math.sqrt(438976)) + math.sqrt(304) - 19, math.sqrt(664 + math.sqrt(438976)) - math.sqrt(304) - 19],
    5: [math.sqrt(67.5 - math.sqrt(4436.25)) + math.sqrt(26.25) - 6.5, math.sqrt(67.5 + math.sqrt(4436.25)) - math.sqrt(26.25) - 6.5],
}


def prefilter(image: np.ndarray, order: int) -> np.ndarray:
    """B-spline coefficients along the first two axes (mirrored ends)."""
    out = np.array(image, float)
    if order < 2:
        return out
    for axis in (0, 1):
        c = np.moveaxis(out, axis, 0)
        n = len(c)
        if n == 1:
            continue
        for z in POLES[order]:
            c *= (1 - z) * (1 - 1 / z)
        for z in POLES[order]:
            reach = min(n, 1 + int(math.ceil(-40 / math.log(abs(z)))))
            if reach < n:
                first = np.tensordot(z ** np.arange(reach), c[:reach], 1)
            else:
                k = np.arange(1, n - 1)
                first = c[0] + z ** (n - 1) * c[-1] + np.tensordot(z**k + z ** (2 * n - 2 - k), c[1:-1], 1)
                first = first / (1 - z ** (2 * n - 2))
            c[0] = first
            for i in range(1, n):
                c[i] += z * c[i - 1]
            c[-1] = (z * c[-2] + c[-1]) * z / (z * z - 1)
            for i in range(n - 2, -1, -1):
                c[i] = z * (c[i + 1] - c[i])
    return out


def spline_weights(t: np.ndarray, order: int) -> np.ndarray:
    """Weights (order + 1, ...) of the nodes around; t is the distance from the first of them."""
    nodes = np.arange(order + 1).reshape(-1, *[1] * t.ndim)
    d = np.abs(t - nodes)

    def basis(x: np.ndarray, k: int) -> np.ndarray:  # centred B-spline of degree k, by truncated powers
        total = np.zeros_like(x)
        for j in range(k + 2):
            total += (-1) ** j * math.comb(k + 1, j) * np.maximum(x + (k + 1) / 2 - j, 0) ** k
        return total / math.factorial(k)

    return basis(d, order)


def mirrored(k: np.ndarray, n: int) -> np.ndarray:
    """Indices beyond the ends of n points, reflected in them."""
    if n == 1:
        return np.zeros_like(k)
    k = np.abs(k) % (2 * n - 2)
    return np.where(k >= n, 2 * n - 2 - k, k)


def evaluate(coef: np.ndarray, y: np.ndarray, x: np.ndarray, order: int, size: tuple[int, int] | None = None, first: tuple[int, int] = (0, 0)) -> np.ndarray:
    """The spline with coefficients `coef` (the image itself for order 0 and 1) at places inside the image.

    `coef` may be a part of the coefficients of an image of `size`, starting at `first`."""
    (h, w), (top, left) = size or coef.shape[:2], first
    if order == 0:
        return coef[np.floor(y + 0.5).astype(int) - top, np.floor(x + 0.5).astype(int) - left]
    y0 = np.floor(y - (order - 1) / 2).astype(int)
    x0 = np.floor(x - (order - 1) / 2).astype(int)
    wy, wx = spline_weights(y - y0, order), spline_weights(x - x0, order)
    total = np.zeros((len(y), *coef.shape[2:]))
    for a in range(order + 1):
        for b in range(order + 1):
            weight = (wy[a] * wx[b]).reshape(-1, *[1] * (coef.ndim - 2))
            total += weight * coef[mirrored(y0 + a, h) - top, mirrored(x0 + b, w) - left]
    return total


def resample(image: np.ndarray, matrix: np.ndarray, offset: np.ndarray, shape: tuple[int, int], order: int = 3) -> np.ndarray:
    """out[o] = spline(image)(matrix @ o + offset); 0 where that lies outside the image."""
    if not 0 <= order <= 5:
        raise ValueError("orders are 0 to 5")
    i, j = np.meshgrid(np.arange(shape[0]), np.arange(shape[1]), indexing="ij")
    y = matrix[0, 0] * i + matrix[0, 1] * j + offset[0]
    x = matrix[1, 0] * i + matrix[1, 1] * j + offset[1]
    h, w = image.shape[:2]
    out = np.zeros((*shape, *image.shape[2:]))
    inside = (y >= 0) & (y <= h - 1) & (x >= 0) & (x <= w - 1)
    if inside.any():
        out[inside] = evaluate(prefilter(image, order), y[inside], x[inside], order)
    return out


# ---- one scene onto tiles -------------------------------------------------------------------------


def index_of(depth: int, lon: float, lat: float) -> tuple[int, int]:
    if abs(lat) > 90:
        raise ValueError("latitude out of range")
    n, turned = 2 ** (depth + 1), lon + 180.0
    wrapped = turned - 360.0 * (math.ceil(turned / 360.0) - 1)
    return math.floor(wrapped / 360.0 * n), min(math.floor((lat + 90.0) / 180.0 * n), n - 1)


@dataclass(frozen=True)
class Section:
    """A stripe of a scene: its rows, the affine map from places (lat, lon) to its pixels, the place of
    its pixel (0, 0), and the tiles that its corners span."""

    first: int
    last: int
    from_geo: np.ndarray
    origin: np.ndarray
    xs: range
    ys: range

    def of_tile(self, depth: int, x: int, y: int, width: int, height: int) -> tuple[np.ndarray, np.ndarray]:
        """(matrix, offset) from a tile's pixels to the section's."""
        n = 2 ** (depth + 1)
        step = np.array([[-180.0 / n / height, 0.0], [0.0, 360.0 / n / width]])
        corner = np.array([(y + 1) * 180.0 / n - 90.0, x * 360.0 / n - 180.0])
        return self.from_geo @ step, self.from_geo @ (corner - self.origin)


def sections_of(metadata: dict[str, str], rows: int, cols: int, depth: int, n_sections: int) -> list[Section]:
    """The sections of a scene of rows x cols pixels.

    In a section the map from pixels to degrees is taken as affine: its columns are the change
    of place per row and per column, measured through the section's middle."""
    left, px, _, top, _, py = json.loads(metadata["GeoTransform"])
    place = Projection.parse(metadata.get("Projection", ""))

    def geo(fx: float, fy: float) -> np.ndarray:  # (lat, lon) at fractions of width and height
        lon, lat = place.to_degrees(np.array(left + fx * px * cols), np.array(top + fy * py * rows))
        return np.array([float(lat), float(lon)])

    out = []
    for s in range(n_sections):
        low, mid, high = s / n_sections, (s + 0.5) / n_sections, (s + 1) / n_sections
        at = [index_of(depth, p[1], p[0]) for p in (geo(0, low), geo(0, high), geo(1, low), geo(1, high))]
        per_row = (geo(0.5, high) - geo(0.5, low)) / ((high - low) * rows)
        per_col = (geo(1, mid) - geo(0, mid)) / cols
        to_geo = np.column_stack([per_row, per_col])
        first = math.floor(low * rows)
        # the place of the section's pixel (0, 0), exact in the middle of its left edge
        origin = geo(0, mid) - to_geo @ np.array([mid * rows - first, 0.0])
        xs, ys = ([a[k] for a in at] for k in (0, 1))
        out.append(Section(first, math.ceil(high * rows), np.linalg.inv(to_geo), origin, range(min(xs), max(xs) + 1), range(min(ys), max(ys) + 1)))
    return out


def scene_tiles(scene: dict, depth: int = grid.DEEPEST, width: int = 512, height: int = 256, order: int = 3, n_sections: int = 1, mask_bands: list[str] | None = None):
    """Yields (x, y, cube with the mask as last plane) of every tile that the scene covers."""
    cube = codec.cube_of(scene).astype(float)
    rows, cols, _ = cube.shape
    chosen = [b for b in scene["bands"] if mask_bands is None or b in mask_bands]
    valid = np.all([cube[:, :, scene["bands"].index(b)] > 0 for b in chosen], axis=0).astype(float)
    for s in sections_of(scene["metadata"], rows, cols, depth, n_sections):
        part, part_mask = cube[s.first : s.last], valid[s.first : s.last]
        for x in s.xs:
            for y in s.ys:
                matrix, offset = s.of_tile(depth, x, y, width, height)
                mask = resample(part_mask, matrix, offset, (height, width), order)
                if not (mask > 0.5).any():  # before any other band is touched
                    continue
                out = np.dstack([resample(part, matrix, offset, (height, width), order), mask])
                out[mask < 0.01] = 0.0
                yield x, y, out


def tile_scenes(scenes: DataFrame, depth: int = grid.DEEPEST, width: int = 512, height: int = 256, order: int = 3, n_sections: int = 1, mask_bands: list[str] | None = None) -> DataFrame:
    """(scene_id, ts, depth, x, y, row, col, mask, v) of every non-empty tile pixel; `v` has the
    scene's bands.  A scene is one row, so tasks hold one scene and one tile at a time; see
    `tile_blocks` for scenes of any size."""
    from ..functions import keys

    names = ["scene_id", "metadata", "bands", "height", "width", "depth", "dtype", "itemsize", "nbytes", "fortran", "byteorder", "data"]
    timed = scenes.withColumn("_ts", keys.acquisition_time(keys.l1t_value(F.col("metadata"), "PRODUCT_METADATA", "START_TIME")))

    def apply(batches):
        for b in batches:
            for k in range(len(b)):
                scene = b.slice(k, 1).to_pylist()[0]
                scene["metadata"] = dict(scene["metadata"])
                for x, y, cube in scene_tiles(scene, depth, width, height, order, n_sections, mask_bands):
                    row, col = np.nonzero(cube[:, :, -1] > 0)
                    part = cube[row, col]
                    m, d = len(part), part.shape[1] - 1
                    v = pa.ListArray.from_arrays(np.arange(0, m * d + 1, d, dtype=np.int32), part[:, :-1].ravel())
                    same = lambda value, kind: pa.array([value] * m, kind)  # noqa: B023,E731
                    yield pa.RecordBatch.from_arrays(
                        [same(scene["scene_id"], pa.string()), same(scene["_ts"], pa.int64()), same(depth, pa.int32()), same(x, pa.int32()), same(y, pa.int32()), pa.array(row.astype(np.int32)), pa.array(col.astype(np.int32)), pa.array(part[:, -1]), v],
                        names=["scene_id", "ts", "depth", "x", "y", "row", "col", "mask", "v"],
                    )

    return in_arrow(timed.select(*names, "_ts"), apply, "scene_id string, ts bigint, depth int, x int, y int, row int, col int, mask double, v array<double>")


# ---- scenes of any size, by blocks ----------------------------------------------------------------

#: Rows and columns of a block.
BLOCK = 256


def halo(order: int) -> int:
    """Pixels around a block that its coefficients depend on to rounding: a spline's prefilter forgets
    by its largest pole's factor with each pixel; and the nodes around a place."""
    if order < 2:
        return order + 1
    return math.ceil(math.log(1e-17) / math.log(max(map(abs, POLES[order])))) + order + 1


def strips_of(scenes: DataFrame, values_at_once: int = 1 << 18) -> DataFrame:
    """(scene_id, frame, start, step, values): the stored runs of scenes as pieces, so that the rest of
    the work never sees a scene whole.  `frame` has what places a scene (metadata, bands, height,
    width) as JSON; a piece's values are `step` apart from `start` on, by row, column and band."""
    frame = F.to_json(F.struct(F.col("metadata"), F.col("bands"), F.col("height"), F.col("width"), F.col("dtype"), F.col("itemsize"), F.col("byteorder"), F.col("fortran")))
    rows = scenes.select("scene_id", frame.alias("frame"), F.explode("data").alias("s")).select("scene_id", "frame", F.col("s.index").cast("bigint").alias("index"), "s.strip")

    def apply(batches):
        for b in batches:
            for name, f, index, strip in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                meta = json.loads(f)
                if meta["fortran"]:
                    raise ValueError("blocks take scenes that are stored row by row")
                v = np.frombuffer(strip, codec._dtype(meta["dtype"], meta["itemsize"], meta["byteorder"])).astype("<f8")
                for lo in range(0, len(v), values_at_once):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([f]), pa.array([index + lo], pa.int64()), pa.array([1], pa.int32()), pa.array([v[lo : lo + values_at_once].tobytes()], pa.binary())], names=["scene_id", "frame", "start", "step", "values"]
                    )

    return in_arrow(rows, apply, "scene_id string, frame string, start bigint, step int, values binary")


def tile_blocks(strips: DataFrame, depth: int = grid.DEEPEST, width: int = 512, height: int = 256, order: int = 3, n_sections: int = 1, mask_bands: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """What `tile_scenes` gives without its time, from pieces of scenes (see `strips_of`), for scenes of any size.

    Sections are cut into blocks; a piece goes to the blocks that it is in and to those whose margin
    it is in, so a block is resampled by itself: its spline coefficients are those of the whole
    section to rounding, and it fills the pixels of tiles that lie in it.  A task holds one block.
    Whether a tile is kept depends on all of its blocks, which an aggregate over their largest
    masks tells."""
    if not 0 <= order <= 5:
        raise ValueError("orders are 0 to 5")
    margin = halo(order)

    def spans(meta: dict) -> list[Section]:
        return sections_of(meta["metadata"], meta["height"], meta["width"], depth, n_sections)

    def deal(batches):
        known: dict[str, tuple[dict, list[Section]]] = {}
        for b in batches:
            for name, f, start, step, raw in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if f not in known:
                    known.clear()
                    known[f] = (m := json.loads(f), spans(m))
                meta, sections = known[f]
                w, d = meta["width"], len(meta["bands"])
                v = np.frombuffer(raw, "<f8")
                at = start + step * np.arange(len(v))
                row, col = at // (w * d), at // d % w
                out = []
                for k, s in enumerate(sections):
                    lo, hi = max(int(row[0]), s.first), min(int(row[-1]), s.last - 1)
                    if lo > hi:
                        continue
                    for by in range(max(lo - s.first - margin, 0) // block, (min(hi - s.first + margin, s.last - 1 - s.first)) // block + 1):
                        top = s.first + by * block
                        here = (row >= max(top - margin, s.first)) & (row < min(top + block + margin, s.last))
                        if not here.any():
                            continue
                        c = col[here]
                        for bx in range(max(int(c.min()) - margin, 0) // block, min(int(c.max()) + margin, w - 1) // block + 1):
                            mine = here & (col >= bx * block - margin) & (col < bx * block + block + margin)
                            if mine.any():
                                out.append((name, f, k, by, bx, at[mine].astype("<i8").tobytes(), v[mine].tobytes()))
                if out:
                    cols = list(zip(*out, strict=True))
                    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["scene_id", "frame", "section", "by", "bx", "at", "values"])

    names = ["scene_id", "section", "depth", "x", "y", "row", "col", "mask", "v"]
    kinds = [pa.string(), *[pa.int32()] * 6, pa.float64()]

    def draw(table: pa.Table) -> pa.Table:
        one = lambda c: table.column(c)[0].as_py()
        meta = json.loads(one("frame"))
        s, by, bx = spans(meta)[one("section")], one("by"), one("bx")
        bands, w, h = meta["bands"], meta["width"], s.last - s.first
        top, left = max(by * block - margin, 0), max(bx * block - margin, 0)
        cube = np.zeros((min(by * block + block + margin, h) - top, min(bx * block + block + margin, w) - left, len(bands)))
        for at, raw in zip(table.column("at").to_pylist(), table.column("values").to_pylist(), strict=True):
            at = np.frombuffer(at, "<i8")
            cube[at // (w * len(bands)) - s.first - top, at // len(bands) % w - left, at % len(bands)] = np.frombuffer(raw, "<f8")
        chosen = [k for k, b in enumerate(bands) if mask_bands is None or b in mask_bands]
        valid = (cube[:, :, chosen] > 0).all(2).astype(float)
        coef = prefilter(np.dstack([cube, valid]), order)
        # tiles by the places of the block's corners, and one around for rounding
        ends_y, ends_x = (by * block, min(by * block + block, h)), (bx * block, min(bx * block + block, w))
        corners = np.array([np.linalg.solve(s.from_geo, [y, x]) + s.origin for y in ends_y for x in ends_x])
        n = 2 ** (depth + 1)
        ys, xs = (np.floor((corners[:, k] + shift) / turn * n).astype(int) for k, shift, turn in ((0, 90.0, 180.0), (1, 180.0, 360.0)))
        near = lambda found, span: range(max(found.min() - 1, span.start), min(found.max() + 1, span.stop - 1) + 1)
        out = []
        # a range of tiles may lie a turn of the globe away from the corners' own degrees
        columns = near(xs, s.xs) if s.xs.stop <= n and xs.min() >= 0 and xs.max() < n else s.xs
        for x in columns:
            for y in near(ys, s.ys):
                matrix, offset = s.of_tile(depth, x, y, width, height)
                back = [np.linalg.solve(matrix, np.array([a, b]) - offset) for a in (ends_y[0] - 1, ends_y[1] + 1) for b in (ends_x[0] - 1, ends_x[1] + 1)]
                (i0, j0), (i1, j1) = np.floor(np.min(back, axis=0)).astype(int), np.ceil(np.max(back, axis=0)).astype(int)
                i, j = np.meshgrid(np.arange(max(i0, 0), min(i1, height - 1) + 1), np.arange(max(j0, 0), min(j1, width - 1) + 1), indexing="ij")
                sy = matrix[0, 0] * i + matrix[0, 1] * j + offset[0]
                sx = matrix[1, 0] * i + matrix[1, 1] * j + offset[1]
                inside = (sy >= 0) & (sy <= h - 1) & (sx >= 0) & (sx <= w - 1)
                inside &= (np.floor(sy) // block == by) & (np.floor(sx) // block == bx)
                if not inside.any():
                    continue
                found = evaluate(coef, sy[inside], sx[inside], order, (h, w), (top, left))
                on = found[:, -1] >= 0.01
                if on.any():
                    out.append((x, y, i[inside][on], j[inside][on], found[on]))
        m, d = sum(len(o[2]) for o in out), len(bands)
        values = np.concatenate([o[4] for o in out]) if out else np.zeros((0, d + 1))
        each = lambda k: np.concatenate([np.broadcast_to(o[k], len(o[2])) for o in out]).astype(np.int32) if out else np.zeros(0, np.int32)
        v = pa.ListArray.from_arrays(np.arange(0, m * d + 1, d, dtype=np.int32), values[:, :-1].ravel())
        cols = [[one("scene_id")] * m, [one("section")] * m, [depth] * m, each(0), each(1), each(2), each(3), values[:, -1]]
        return pa.Table.from_arrays([*(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), v], names=names)

    dealt = in_arrow(strips.select("scene_id", "frame", "start", "step", "values"), deal, "scene_id string, frame string, section int, by int, bx int, at binary, values binary")
    drawn = dealt.groupBy("scene_id", "section", "by", "bx").applyInArrow(draw, "scene_id string, section int, depth int, x int, y int, row int, col int, mask double, v array<double>")
    drawn = materialise(drawn, "drawn")
    tile = ["scene_id", "section", "x", "y"]
    kept = drawn.groupBy(*tile).agg(F.max("mask").alias("m")).where("m > 0.5")
    return drawn.join(kept.select(*tile), tile, "left_semi").select(*(c for c in names if c != "section"))

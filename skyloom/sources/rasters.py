"""Band rasters as a table of their strips and tiles, of which a query reads only what it needs.

A Python data source: every row is a piece of a band file.  Filters on the band and on the rows and
columns of pieces are pushed into it, so a crop reads the directory of each file and the byte ranges
of the pieces that it meets.  Files are opened by Arrow's file systems, in any store that they know.
"""

from __future__ import annotations

import fnmatch
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..functions import calib
from ..shipping import in_arrow, ship
from .scenes import DEFAULT_BANDS, Tiff

SCHEMA = "folder string, band string, height int, width int, geo array<double>, row0 int, row1 int, col0 int, col1 int, stored bigint, data binary"
ARROW = pa.schema([
    ("folder", pa.string()), ("band", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("geo", pa.list_(pa.float64())),
    ("row0", pa.int32()), ("row1", pa.int32()), ("col0", pa.int32()), ("col1", pa.int32()), ("stored", pa.int64()), ("data", pa.binary()),
])
#: Bytes of a file that one task reads, about.
PART = 64 << 20
BAND = re.compile(r"_(B[0-9]+)_[^/]*$")
#: The end of a piece that bounds on a column speak of: columns of `SCHEMA` by place in a piece's box.
ENDS = ("row0", "row1", "col0", "col1")


def band_name(path: str) -> str:
    """The band of a file like EO1H..._B029_L1T.TIF, or nothing."""
    found = BAND.search(path)
    return found[1] if found else ""


@dataclass
class Part(InputPartition):
    """Every `of`-th piece of a file, from the `at`-th."""

    path: str
    folder: str
    at: int
    of: int


class StripReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        options = {k.lower(): v for k, v in options.items()}  # Spark's don't tell cases apart
        self.path, self.glob = options["path"].rstrip("/"), options.get("pathglobfilter", "EO1*_B[0-9][0-9]*_L1T.TIF")
        self.part = int(options.get("partbytes", PART))
        self.bands: set[str] | None = None
        self.bounds: list[tuple[str, str, int]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality of bands and bounds on the ends of pieces; Spark applies the rest."""
        signs = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name == "band" and isinstance(f, (EqualTo, In)):
                some = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.bands = some if self.bands is None else self.bands & some
            elif name in ENDS and type(f) in signs and isinstance(f.value, int):
                self.bounds.append((name, signs[type(f)], f.value))
            else:
                yield f

    def meets(self, box: tuple[int, int, int, int]) -> bool:
        """Whether a piece (first row, first column, rows, columns) is within the bounds that were pushed."""
        y, x, h, w = box
        ends = {"row0": y, "row1": y + h - 1, "col0": x, "col1": x + w - 1}
        tests = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
        return all(tests[sign](ends[name], value) for name, sign, value in self.bounds)

    def partitions(self) -> list[Part]:
        store, top = pyarrow.fs.FileSystem.from_uri(self.path)
        # folders are named as Spark's own readers name them
        root = f"file:{top}" if self.path.startswith("file:") else self.path
        out = []
        for f in store.get_file_info(pyarrow.fs.FileSelector(top, recursive=True)):
            band = band_name(f.base_name)
            if f.is_file and fnmatch.fnmatchcase(f.base_name, self.glob) and band and (self.bands is None or band in self.bands):
                n = max(1, -(-f.size // self.part))
                folder = root + f.path[len(top) :].rsplit("/", 1)[0]
                out += [Part(f.path, folder, k, n) for k in range(n)]
        return out

    def read(self, part: Part | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no file met the filters
            return
        store, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        with store.open_input_file(part.path) as file:
            tiff = Tiff(lambda at, n: file.read_at(n, at))
            n = len(tiff.places)
            for k in range(part.at * n // part.of, (part.at + 1) * n // part.of):
                y, x, h, w = box = tiff.box(k)
                if self.meets(box):
                    data = tiff.piece(k).astype("<f8").tobytes()
                    row = [part.folder, band_name(part.path), tiff.height, tiff.width, tiff.geo, y, y + h - 1, x, x + w - 1, tiff.places[k][1], data]
                    yield pa.RecordBatch.from_pylist([dict(zip(ARROW.names, row, strict=True))], schema=ARROW)


class BandStrips(DataSource):
    """Pieces of band TIFFs under `path` (see `SCHEMA`): `stored` is a piece's size in the file, and `data`
    holds its values as little-endian doubles, row by row."""

    @classmethod
    def name(cls) -> str:
        return "band_strips"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> StripReader:
        return StripReader(dict(self.options))


def read_strips(spark: SparkSession, path: str, bands: tuple[str, ...] | None = DEFAULT_BANDS, window: tuple[int, int, int, int] | None = None, **options: str) -> DataFrame:
    """The pieces of the bands' files that meet `window` (first row, last row, first column, last
    column), by default all; others' bytes aren't read."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BandStrips)
    rows = spark.read.format("band_strips").options(**options).load(path)
    if bands:
        rows = rows.where(F.col("band").isin(list(bands)))
    if window:
        r0, r1, c0, c1 = window
        rows = rows.where((F.col("row1") >= r0) & (F.col("row0") <= r1) & (F.col("col1") >= c0) & (F.col("col0") <= c1))
    return rows


def pixels_of_strips(strips: DataFrame, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(folder, band, row, col, value) of pieces, cut to the window."""
    r0, r1, c0, c1 = window or (0, 1 << 30, 0, 1 << 30)

    def apply(batches):
        for b in batches:
            for folder, band, y, x, x1, raw in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                v = np.frombuffer(raw, "<f8").reshape(-1, x1 - x + 1)
                i, j = np.meshgrid(np.arange(y, y + len(v)), np.arange(x, x1 + 1), indexing="ij")
                on = (i >= r0) & (i <= r1) & (j >= c0) & (j <= c1)
                m = int(on.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([folder] * m, pa.string()), pa.array([band] * m, pa.string()), pa.array(i[on], pa.int32()), pa.array(j[on], pa.int32()), pa.array(v[on])], names=["folder", "band", "row", "col", "value"]
                )

    return in_arrow(strips.select("folder", "band", "row0", "col0", "col1", "data"), apply, "folder string, band string, row int, col int, value double")


def block_strips(strips: DataFrame, l1t: DataFrame, bands: tuple[str, ...], projection: str = "", sensor: str = "hyperion") -> DataFrame:
    """(scene_id, frame, start, step, values) of the pieces of `bands`, calibrated: scenes as
    `operators.geo.tile_blocks` takes them, straight from band files, so that no task ever holds a scene.
    `l1t` has (folder, l1t_json); a folder that lacks a band has zeros there."""
    names = sorted(bands)

    def apply(batches):
        for b in batches:
            for folder, band, h, w, geo, y, x, x1, raw, text in zip(*(b.column(i).to_pylist() for i in range(10)), strict=True):
                scaling = json.loads(text).get("RADIANCE_SCALING", {})
                factor = 300.0 if sensor != "hyperion" else float(scaling["SCALING_FACTOR_VNIR" if int(band[1:]) <= calib.LAST_VNIR else "SCALING_FACTOR_SWIR"])
                meta = {"L1T": text, "GeoTransform": json.dumps(geo), "Projection": projection}
                frame = json.dumps({"metadata": meta, "bands": names, "height": h, "width": w})
                v = (np.frombuffer(raw, "<f8") / factor).reshape(-1, x1 - x + 1)
                k, n = len(v), len(names)
                start = [((y + i) * w + x) * n + names.index(band) for i in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([folder] * k), pa.array([frame] * k), pa.array(start, pa.int64()), pa.array([n] * k, pa.int32()), pa.array([r.tobytes() for r in v], pa.binary())], names=["scene_id", "frame", "start", "step", "values"]
                )

    rows = strips.where(F.col("band").isin(names)).join(l1t.select("folder", "l1t_json"), "folder")
    rows = rows.select("folder", "band", "height", "width", "geo", "row0", "col0", "col1", "data", "l1t_json")
    return in_arrow(rows, apply, "scene_id string, frame string, start bigint, step int, values binary")

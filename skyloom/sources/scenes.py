"""Scenes from raw files: text metadata, band TIFFs, assembly; and configuration."""

from __future__ import annotations

import configparser
import json
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calib, grid
from ..schema import CATALOGUE
from ..shipping import in_arrow
from . import codec

DEFAULT_BANDS = ("B029", "B023", "B016")
FOLDER = r"^(.*)/[^/]*$"


def parse_l1t(text: str) -> dict[str, dict[str, str]]:
    """Groups of `NAME = VALUE` lines; nested groups are top-level ones; END ends the file."""
    out: dict[str, dict[str, str]] = {}
    stack: list[str] = []
    for line in text.splitlines():
        name, _, value = (x.strip() for x in line.partition("="))
        if name == "END":
            break
        value = value.strip('"')
        if name == "GROUP":
            stack.append(value)
            out.setdefault(value, {})
        elif name == "END_GROUP":
            if stack:
                stack.pop()
        elif name and stack:
            out[stack[-1]][name] = value
    return out


def read_l1t(spark: SparkSession, path: str, glob: str = "*.L1T") -> DataFrame:
    """(folder, l1t map, l1t_json): the first metadata file of each folder, by name."""
    text = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path, wholetext=True)
    return l1t_of(text.select(F.regexp_extract(F.col("_metadata.file_path"), FOLDER, 1).alias("folder"), F.col("_metadata.file_path").alias("file"), "value"))


def l1t_of(files: DataFrame) -> DataFrame:
    """What `read_l1t` returns, from (folder, file, value) rows of metadata texts."""

    def apply(batches):
        for b in batches:
            found = [parse_l1t(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([json.dumps(x, sort_keys=True) for x in found])], names=["folder", "file", "l1t_json"])

    parsed = in_arrow(files.select("folder", "file", "value"), apply, "folder string, file string, l1t_json string")
    first = parsed.groupBy("folder").agg(F.min_by("l1t_json", "file").alias("l1t_json"))
    return first.withColumn("l1t", F.from_json("l1t_json", "map<string,map<string,string>>"))


def _lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, highest bit first, 256 to start anew and 257 at the end."""
    out, table, width, bits, n, last = [], [], 9, 0, 0, None
    for byte in data:
        bits, n = (bits << 8) | byte, n + 8
        if n < width:
            continue
        n -= width
        code, bits = bits >> n, bits & ((1 << n) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, None
            continue
        if last is None:
            entry = table[code]
        else:
            entry = table[code] if code < len(table) else last + last[:1]
            table.append(last + entry[:1])
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        out.append(entry)
        last = entry
    return b"".join(out)


def _packbits(data: bytes) -> bytes:
    """Runs: a count of bytes that follow, or of copies of the next."""
    out, at = bytearray(), 0
    while at < len(data):
        k = data[at]
        if k < 128:
            out += data[at + 1 : at + 2 + k]
            at += 2 + k
        else:
            out += data[at + 1 : at + 2] * (257 - k) if k > 128 else b""
            at += 2 if k > 128 else 1
    return bytes(out)


#: Decoders by TIFF's number of the compression.
UNPACK = {1: bytes, 5: _lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: _packbits}


def _unpredicted(raw: np.ndarray, predictor: int, kind: np.dtype) -> np.ndarray:
    """Values of a piece (rows, bytes of a row) as (rows, columns, samples are not told apart)."""
    if predictor == 3:  # sums of bytes, which are in planes, the highest first
        planes = np.cumsum(raw, axis=1, dtype=np.uint8).reshape(len(raw), kind.itemsize, -1)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(kind.newbyteorder(">"))[..., 0]
    return np.ascontiguousarray(raw).view(kind)


#: Structs of a TIFF's field types.
FIELDS = {1: "B", 2: "s", 3: "H", 4: "I", 11: "f", 12: "d"}


class Tiff:
    """The first band of the first image of a TIFF, in strips or tiles, plain or compressed (LZW,
    deflate, runs), of 8 to 32-bit integers or 32/64-bit floats.

    `read(at, n)` gives bytes of the file; the directory is read at once, and of the image only the
    pieces that are asked for."""

    def __init__(self, read) -> None:
        self.read = read
        head = read(0, 8)
        self.order = {b"II": "<", b"MM": ">"}[head[:2]]
        magic, at = struct.unpack(self.order + "HI", head[2:8])
        if magic != 42:
            raise ValueError("not a TIFF")
        tags = self._directory(at)
        first = lambda tag, default: tags.get(tag, [default])[0]
        self.tiled = 324 in tags
        if first(259, 1) not in UNPACK or not (self.tiled or 273 in tags):
            raise ValueError(f"compression {first(259, 1)}")
        self.unpack, self.predictor = UNPACK[first(259, 1)], first(317, 1)
        self.width, self.height, bits, fmt = first(256, 0), first(257, 0), first(258, 1), first(339, 1)
        kinds = {(8, 1): "u1", (16, 1): "u2", (16, 2): "i2", (32, 1): "u4", (32, 2): "i4", (32, 3): "f4", (64, 3): "f8"}
        if (bits, fmt) not in kinds:
            raise ValueError(f"samples of {bits} bits, format {fmt}")
        self.kind = np.dtype(self.order + kinds[bits, fmt])
        self.samples = first(277, 1) if first(284, 1) == 1 else 1  # bands in planes: the first plane's pieces come first
        self.rows, self.cols = (first(323, 0), first(322, 0)) if self.tiled else (min(first(278, self.height), self.height), self.width)
        self.across, down = -(-self.width // self.cols), -(-self.height // self.rows)
        self.places = list(zip(tags[324 if self.tiled else 273], tags[325 if self.tiled else 279], strict=True))[: self.across * down]
        scale, tie = tags.get(33550), tags.get(33922)
        self.geo = [tie[3] - tie[0] * scale[0], scale[0], 0.0, tie[4] + tie[1] * scale[1], 0.0, -scale[1]] if scale and tie else [0.0] * 6

    def _directory(self, at: int) -> dict[int, list]:
        order, tags = self.order, {}
        (n,) = struct.unpack(order + "H", self.read(at, 2))
        entries = self.read(at + 2, 12 * n)
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", entries, 12 * k)
            if kind not in FIELDS:
                continue
            size = struct.calcsize(order + FIELDS[kind]) * count
            raw = entries[12 * k + 8 : 12 * k + 12]
            if size > 4:
                raw = self.read(struct.unpack(order + "I", raw)[0], size)
            tags[tag] = list(struct.unpack_from(f"{order}{count}{FIELDS[kind]}", raw))
        return tags

    def box(self, k: int) -> tuple[int, int, int, int]:
        """First row and column of piece k, and its rows and columns within the image."""
        y, x = k // self.across * self.rows, k % self.across * self.cols
        return y, x, min(self.rows, self.height - y), min(self.cols, self.width - x)

    def piece(self, k: int) -> np.ndarray:
        """Values of piece k, without what lies beyond the image."""
        y, _, h, w = self.box(k)
        n = self.rows if self.tiled else h
        raw = np.frombuffer(self.unpack(self.read(*self.places[k])), np.uint8, n * self.cols * self.samples * self.kind.itemsize).reshape(n, -1)
        values = _unpredicted(raw, self.predictor, self.kind).reshape(n, self.cols, self.samples)
        if self.predictor == 2:
            values = np.cumsum(values, axis=1, dtype=self.kind.newbyteorder("="))
        return values[:h, :w, 0].astype(float)


def read_tiff(data: bytes) -> tuple[np.ndarray, list[float]]:
    """The first band of a TIFF (see `Tiff`) and its geographic transform (zeros if it has none)."""
    tiff = Tiff(lambda at, n: data[at : at + n])
    image = np.zeros((tiff.height, tiff.width))
    for k in range(len(tiff.places)):
        y, x, h, w = tiff.box(k)
        image[y : y + h, x : x + w] = tiff.piece(k)
    return image, tiff.geo


def tiff_bytes(image: np.ndarray, geo: list[float], rows: int | None = None) -> bytes:
    """An uncompressed TIFF of 64-bit floats with its geographic transform, in strips of `rows` rows, by
    default in one: what `read_tiff` reads."""
    raw = np.ascontiguousarray(image, "<f8").tobytes()
    (h, w), scale, tie = image.shape, [geo[1], -geo[5], 0.0], [0.0, 0.0, 0.0, geo[0], geo[3], 0.0]
    rows = min(rows or h, h)
    n, size = -(-h // rows), rows * w * 8
    sizes = [min(size, len(raw) - k * size) for k in range(n)]
    start = 8 + 2 + 12 * 11 + 4  # behind the header and the list of entries
    lists = start + 72 if n > 1 else 0  # places and sizes of strips, where they don't fit their entries
    pixels = start + 72 + (8 * n if n > 1 else 0)
    longs = {256: (1, w), 257: (1, h), 273: (n, lists or pixels), 278: (1, rows), 279: (n, lists + 4 * n if lists else sizes[0])}
    entries = [(tag, 4, k, v) for tag, (k, v) in longs.items()] + [(tag, 3, 1, v) for tag, v in {258: 64, 259: 1, 277: 1, 339: 3}.items()] + [(33550, 12, 3, start), (33922, 12, 6, start + 24)]
    body = b"".join(struct.pack("<HHII", *e) for e in sorted(entries))
    where = struct.pack(f"<{2 * n}I", *(pixels + k * size for k in range(n)), *sizes) if lists else b""
    return b"II" + struct.pack("<HIH", 42, 8, len(entries)) + body + struct.pack("<I9d", 0, *scale, *tie) + where + raw


def read_bands(spark: SparkSession, path: str, bands: tuple[str, ...] | None = DEFAULT_BANDS, glob: str = "EO1*_B[0-9][0-9]*_L1T.TIF") -> DataFrame:
    """(folder, band, height, width, geo, data): one row for each band file; only the files of the
    bands asked for are read.  `data` holds little-endian doubles, row by row."""
    return bands_of(spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path), bands)


def bands_of(files: DataFrame, bands: tuple[str, ...] | None = DEFAULT_BANDS) -> DataFrame:
    """What `read_bands` returns, from (path, content) rows of TIFFs."""
    named = files.select(F.regexp_extract("path", FOLDER, 1).alias("folder"), calib.band_of_file(F.col("path")).alias("band"), "content")
    wanted = named.where(F.col("band").isin(list(bands)) if bands else F.col("band") != "")

    def apply(batches):
        for b in batches:
            for folder, band, content in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                image, geo = read_tiff(content)
                yield pa.RecordBatch.from_pylist(
                    [{"folder": folder, "band": band, "height": image.shape[0], "width": image.shape[1], "geo": geo, "data": image.astype("<f8").tobytes()}],
                    schema=pa.schema([("folder", pa.string()), ("band", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("geo", pa.list_(pa.float64())), ("data", pa.binary())]),
                )

    return in_arrow(wanted, apply, "folder string, band string, height int, width int, geo array<double>, data binary")


def assemble(bands: DataFrame, l1t: DataFrame, projection: str = "", require_all: tuple[str, ...] | None = None, sensor: str = "hyperion") -> DataFrame:
    """One calibrated scene for each folder: its bands sorted by name, stacked and scaled.

    Folders without any band have no row; with `require_all`, neither have those that lack one."""
    grouped = bands.groupBy("folder").agg(F.sort_array(F.collect_list(F.struct("band", "height", "width", "geo", "data"))).alias("b"))
    if require_all:
        grouped = grouped.where(F.size(F.array_intersect(F.transform("b", lambda x: x["band"]), F.array(*map(F.lit, require_all)))) == len(require_all))
    joined = grouped.join(l1t.select("folder", "l1t_json"), "folder")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    from ..schema import SCENE

    ddl = f"scene_id string, {SCENE}"
    arrow = to_arrow_schema(_parse_datatype_string(ddl))

    def apply(batches):
        for b in batches:
            for row in b.to_pylist():
                l1t_ = json.loads(row["l1t_json"])
                planes = []
                for x in row["b"]:
                    v = np.frombuffer(x["data"], "<f8").reshape(x["height"], x["width"])
                    if sensor == "hyperion":
                        n = int(x["band"][1:])
                        v = v / float(l1t_["RADIANCE_SCALING"]["SCALING_FACTOR_VNIR" if n <= calib.LAST_VNIR else "SCALING_FACTOR_SWIR"])
                    else:
                        v = v / 300.0
                    planes.append(v)
                meta = {"L1T": row["l1t_json"], "GeoTransform": json.dumps(row["b"][0]["geo"]), "Projection": projection}
                scene = codec.scene_of(np.dstack(planes), [x["band"] for x in row["b"]], meta)
                scene["data"] = [{"index": i, "strip": s} for i, s in scene["data"]]
                scene["metadata"] = list(meta.items())
                yield pa.RecordBatch.from_pylist([{"scene_id": row["folder"], **scene}], schema=arrow)

    return in_arrow(joined, apply, ddl)


def read_scenes(spark: SparkSession, path: str, corrupt: str = "skip") -> DataFrame:
    """Serialized scenes, one a line."""
    return codec.decode_lines(spark.read.text(path), "value", corrupt)


def write_scenes(scenes: DataFrame, path: str) -> None:
    codec.encode_lines(scenes).write.text(path)


def read_tiles(lines: DataFrame) -> DataFrame:
    """(depth, x, y, ts, payload) of `tile-time TAB payload` lines; bad keys are skipped, and so
    are the payloads that say BROKEN."""
    kv = lines.select(F.substring_index("value", "\t", 1).alias("key"), F.regexp_replace("value", r"^[^\t]*\t", "").alias("payload"))
    part = lambda i: F.regexp_extract("key", r"^T(\d\d)-(\d{5})-(\d{5})-(\d{10})$", i).try_cast("bigint")
    out = kv.select(part(1).cast("int").alias("depth"), part(2).cast("int").alias("x"), part(3).cast("int").alias("y"), part(4).alias("ts"), "payload")
    return out.where(F.col("depth").isNotNull() & (F.col("payload") != "BROKEN"))


def tile_lines(tiles: DataFrame) -> DataFrame:
    """The lines that `read_tiles` reads, from (depth, x, y, ts, payload); a null payload is BROKEN."""
    key = F.concat(grid.tile_name(F.col("depth"), F.col("x"), F.col("y")), F.lit("-"), F.lpad(F.col("ts").cast("string"), 10, "0"))
    return tiles.select(F.concat(key, F.lit("\t"), F.coalesce("payload", F.lit("BROKEN"))).alias("value"))


def read_bright(lines: DataFrame) -> DataFrame:
    """Bright pixels from `world TAB lon lat ts intensity` lines: numbers that don't parse are
    null, and any other key is an error."""
    key = F.substring_index("value", "\t", 1)
    ok = F.when(key == "world", key).otherwise(F.raise_error(F.concat(F.lit("unexpected key "), key)).cast("string"))
    parts = F.split(F.trim(F.regexp_replace("value", r"^[^\t]*\t", "")), r"\s+")
    number = lambda i, kind: F.get(parts, F.lit(i)).try_cast(kind)
    return lines.select(ok.alias("key"), number(0, "double").alias("longitude"), number(1, "double").alias("latitude"), number(2, "bigint").alias("ts"), number(3, "double").alias("intensity"))


def read_catalogue(spark: SparkSession, path: str, sensor: str) -> DataFrame:
    """Catalogue rows of a JSON document with a `data` array."""
    return catalogue_of(spark.read.text(path, wholetext=True), sensor)


def catalogue_of(documents: DataFrame, sensor: str) -> DataFrame:
    """What `read_catalogue` returns, from JSON documents (value)."""
    row = CATALOGUE.replace(" double", ":double").replace(" string", ":string").replace(" bigint", ":bigint").replace("corners array", "corners:array")
    doc = documents.select(F.from_json("value", f"data array<struct<{row}>>").alias("d")).select("d.data")
    return doc.select(F.lit(sensor).alias("sensor"), F.explode("data").alias("d")).select("sensor", "d.*")


def read_training(lines: DataFrame) -> DataFrame:
    """(features, class) of rows of numbers, the class last."""
    nums = F.transform(F.split(F.trim("value"), r"\s+"), lambda x: x.cast("double"))
    return lines.where(F.trim("value") != "").select(F.slice(nums, F.lit(1), F.size(nums) - 1).alias("features"), F.element_at(nums, -1).cast("int").alias("class"))


def write_training(rows: DataFrame, path: str, n_features: int) -> None:
    form = " ".join(["%-12.5f"] * n_features + ["%d"])
    rows.select(F.format_string(form, *(F.col("features")[i] for i in range(n_features)), F.col("class")).alias("value")).write.text(path)


def training_files(spark: SparkSession, path: str, classes: tuple[str, ...]) -> DataFrame:
    """Serialized scenes under folders named after land covers: (file, cover, class, value)."""
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    named = text.select(F.col("_metadata.file_path").alias("file"), "value").withColumn("cover", F.regexp_extract("file", r"/([^/]+)/[^/]+$", 1))
    number = F.array_position(F.array(*map(F.lit, classes)), F.col("cover")).cast("int")
    return named.withColumn("class", number).where(F.col("class") > 0)


@dataclass(frozen=True)
class Config:
    """Settings of the DEFAULT section of an INI file."""

    values: dict[str, str]

    @classmethod
    def read(cls, *paths: str) -> Config:
        parser = configparser.ConfigParser(interpolation=None)
        parser.read(paths)
        return cls(dict(parser.defaults()))

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.values.get(key.lower(), default)


@dataclass(frozen=True)
class ClusterTemplate:
    """What a clustering model file declares: fields and initial centres."""

    fields: tuple[str, ...]
    centres: tuple[tuple[float, ...], ...]

    @classmethod
    def read(cls, text: str) -> ClusterTemplate:
        import xml.etree.ElementTree as ET

        root = ET.fromstring(text)
        local = lambda e: e.tag.rpartition("}")[2]
        fields = tuple(e.get("field") for e in root.iter() if local(e) == "ClusteringField")
        centres = tuple(tuple(map(float, a.text.split())) for c in root.iter() if local(c) == "Cluster" for a in c if local(a) == "Array" and a.text)
        return cls(fields, centres)

"""Scene codec: zero-suppressed strips, one Avro datum a scene, Base64 lines, and PNG.

A scene is a (height, width, depth) cube.  Only runs of non-zero elements are kept, as
(index of the first element, bytes).
"""

from __future__ import annotations

import base64
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import BYTE_ORDERS, SCENE
from ..shipping import in_arrow

#: numpy's number of float64, the only element type of the relational path.
FLOAT64 = np.dtype("f8").num


# ---- strips -----------------------------------------------------------------------------------


def _dtype(dtype: int, itemsize: int, byteorder: str) -> np.dtype:
    kinds = {np.dtype(c).num: np.dtype(c) for c in "?bBhHiIlLqQfd"}
    if dtype not in kinds or kinds[dtype].itemsize != itemsize:
        raise ValueError(f"element type {dtype} of {itemsize} bytes")
    return kinds[dtype].newbyteorder({"BigEndian": ">", "LittleEndian": "<"}.get(byteorder, "="))


def suppress_zeros(cube: np.ndarray, fortran: bool = False) -> list[tuple[int, bytes]]:
    flat = cube.ravel("F" if fortran else "C")
    on = np.concatenate(([0], (flat != 0).view(np.int8), [0]))
    edges = np.flatnonzero(np.diff(on))
    return [(int(a), flat[a:b].tobytes()) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def expand_zeros(strips, height: int, width: int, depth: int, dtype: np.dtype, fortran: bool = False) -> np.ndarray:
    flat = np.zeros(height * width * depth, dtype)
    for index, strip in strips:
        part = np.frombuffer(strip, dtype)
        if index < 0 or index + len(part) > len(flat):
            raise ValueError("a strip lies outside the cube")
        flat[index : index + len(part)] = part
    return flat.reshape((height, width, depth), order="F" if fortran else "C").astype(dtype.newbyteorder("="))


#: Elements of a scene whose runs one task looks for.
STRETCH = 1 << 16


def zero_runs(cells: DataFrame, scene: str = "scene_id", index: str = "index", value: str = "value") -> DataFrame:
    """Relational form of `suppress_zeros`: (scene, start, length, values) of each run of
    neighbouring non-zero elements.

    Runs are found within stretches of a scene; only those that touch a stretch's end, two for each
    at most, then meet by scene to be joined."""
    cells = cells.where(F.col(value) != 0).withColumn("_part", F.floor(F.col(index) / STRETCH))
    w = Window.partitionBy(scene, "_part").orderBy(index)
    runs = cells.withColumn("_run", F.col(index) - F.row_number().over(w)).groupBy(scene, "_part", "_run").agg(
        F.min(index).alias("start"), F.count(F.lit(1)).alias("length"), F.transform(F.array_sort(F.collect_list(F.struct(index, value))), lambda s: s[value]).alias("values")
    )
    runs = runs.select(scene, "start", "length", "values")
    ends = (F.col("start") % STRETCH == 0) | ((F.col("start") + F.col("length")) % STRETCH == 0)
    order = Window.partitionBy(scene).orderBy("start")
    apart = F.coalesce(F.lag(F.col("start") + F.col("length")).over(order) != F.col("start"), F.lit(True))
    chained = runs.where(ends).withColumn("_new", apart.cast("int")).withColumn("_chain", F.sum("_new").over(order))
    joined = chained.groupBy(scene, "_chain").agg(F.min("start").alias("start"), F.sum("length").alias("length"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "values"))), lambda s: s["values"])).alias("values"))
    return runs.where(~ends).unionByName(joined.drop("_chain"))


# ---- Avro -------------------------------------------------------------------------------------


class _Writer:
    def __init__(self) -> None:
        self.out = bytearray()

    def long(self, n: int) -> None:
        n = (n << 1) ^ (n >> 63)
        while n > 0x7F:
            self.out.append(n & 0x7F | 0x80)
            n >>= 7
        self.out.append(n)

    def bytes(self, b: bytes) -> None:
        self.long(len(b))
        self.out += b

    def block(self, items, put) -> None:
        if items:
            self.long(len(items))
            for x in items:
                put(x)
        self.long(0)


class _Reader:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def long(self) -> int:
        n = shift = 0
        while True:
            b = self.data[self.at]
            self.at += 1
            n |= (b & 0x7F) << shift
            if b < 0x80:
                return (n >> 1) ^ -(n & 1)
            shift += 7

    def bytes(self) -> bytes:
        n = self.long()
        if n < 0 or self.at + n > len(self.data):
            raise ValueError("the datum ends early")
        self.at += n
        return self.data[self.at - n : self.at]

    def block(self, get) -> list:
        out = []
        while self.at < len(self.data):  # a missing last block counts as empty
            n = self.long()
            if n == 0:
                break
            if n < 0:
                n, _ = -n, self.long()
            out += [get() for _ in range(n)]
        return out


def validate(scene: dict) -> None:
    """Errors for what cannot be a scene."""
    if not all(isinstance(k, str) and isinstance(v, str) for k, v in scene["metadata"].items()):
        raise ValueError("metadata maps strings to strings")
    if not all(isinstance(b, str) for b in scene["bands"]):
        raise ValueError("bands are strings")
    if min(scene["height"], scene["width"], scene["depth"]) < 1:
        raise ValueError("a picture has three dimensions, none empty")
    if scene["depth"] != len(scene["bands"]):
        raise ValueError(f"{scene['depth']} planes but {len(scene['bands'])} bands")
    if scene["byteorder"] not in BYTE_ORDERS:
        raise ValueError(f"byte order {scene['byteorder']!r}")


def encode_avro(scene: dict) -> bytes:
    validate(scene)
    w = _Writer()

    def pair(kv):
        w.bytes(kv[0].encode())
        w.bytes(kv[1].encode())

    def strip(s):
        w.long(s[0])
        w.bytes(s[1])

    w.block(list(scene["metadata"].items()), pair)
    w.block(scene["bands"], lambda b: w.bytes(b.encode()))
    for k in ("height", "width", "depth", "dtype", "itemsize", "nbytes"):
        w.long(scene[k])
    w.out.append(1 if scene["fortran"] else 0)
    w.long(BYTE_ORDERS.index(scene["byteorder"]))
    w.block([(s["index"], s["strip"]) if isinstance(s, dict) else s for s in scene["data"]], strip)
    return bytes(w.out)


def decode_avro(data: bytes) -> dict:
    r = _Reader(data)
    out: dict = {"metadata": dict(r.block(lambda: (r.bytes().decode(), r.bytes().decode()))), "bands": r.block(lambda: r.bytes().decode())}
    for k in ("height", "width", "depth", "dtype", "itemsize", "nbytes"):
        out[k] = r.long()
    out["fortran"] = bool(r.data[r.at])
    r.at += 1
    out["byteorder"] = BYTE_ORDERS[r.long()]
    out["data"] = r.block(lambda: (r.long(), r.bytes()))
    validate(out)
    return out


def scene_of(cube: np.ndarray, bands: list[str], metadata: dict[str, str], fortran: bool = False) -> dict:
    if cube.ndim != 3:
        raise ValueError("a picture has three dimensions, none empty")
    cube = np.asarray(cube, "<f8")
    h, w, d = cube.shape
    return {
        "metadata": metadata, "bands": list(bands), "height": h, "width": w, "depth": d, "dtype": FLOAT64, "itemsize": 8, "nbytes": cube.nbytes,
        "fortran": fortran, "byteorder": "LittleEndian", "data": suppress_zeros(cube, fortran),
    }


def cube_of(scene: dict) -> np.ndarray:
    strips = [(s["index"], s["strip"]) if isinstance(s, dict) else s for s in scene["data"]]
    kind = _dtype(scene["dtype"], scene["itemsize"], scene["byteorder"])
    return expand_zeros(strips, scene["height"], scene["width"], scene["depth"], kind, scene["fortran"])


# ---- over DataFrames ----------------------------------------------------------------------------


def decode_lines(lines: DataFrame, column: str = "value", corrupt: str = "skip") -> DataFrame:
    """Scenes from Base64 lines.  Lines that don't decode are skipped, or an error."""

    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(SCENE))

    def apply(batches):
        for b in batches:
            rows = []
            for line in b.column(0).to_pylist():
                try:
                    scene = decode_avro(base64.b64decode(line or "", validate=True))
                except (ValueError, IndexError, KeyError):
                    if corrupt == "skip":
                        continue
                    raise
                scene["data"] = [{"index": i, "strip": s} for i, s in scene["data"]]
                scene["metadata"] = list(scene["metadata"].items())
                rows.append(scene)
            for row in rows:  # scenes are large: one a batch
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    return in_arrow(lines.select(column), apply, SCENE)


def encode_lines(scenes: DataFrame) -> DataFrame:
    """One Base64 line (`value`) for each scene."""
    names = ["metadata", "bands", "height", "width", "depth", "dtype", "itemsize", "nbytes", "fortran", "byteorder", "data"]

    def apply(batches):
        for b in batches:
            for row in b.to_pylist():
                row["metadata"] = dict(row["metadata"])
                yield pa.RecordBatch.from_arrays([pa.array([base64.b64encode(encode_avro(row)).decode()])], names=["value"])

    return in_arrow(scenes.select(*names), apply, "value string")


def pixels_of(scenes: DataFrame, id_col: str = "scene_id", rows_at_once: int = 64) -> DataFrame:
    """The pixel table (id, row, col, v) of scenes of float64 elements, a few image rows a batch."""
    kind = scenes.schema[id_col].dataType.simpleString()
    names = [id_col, "metadata", "bands", "height", "width", "depth", "dtype", "itemsize", "nbytes", "fortran", "byteorder", "data"]

    def apply(batches):
        for b in batches:
            for k in range(len(b)):
                scene = b.slice(k, 1).to_pylist()[0]
                if scene["itemsize"] != 8:
                    raise ValueError("the pixel table takes elements of 8 bytes")
                cube = cube_of(scene).astype(float)
                h, w, d = cube.shape
                for lo in range(0, h, rows_at_once):
                    part = cube[lo : lo + rows_at_once].reshape(-1, d)
                    at = np.arange(lo * w, lo * w + len(part))
                    v = pa.ListArray.from_arrays(np.arange(0, part.size + 1, d, dtype=np.int32), part.ravel())
                    ids = pa.array([scene[id_col]] * len(part), b.schema.field(0).type)
                    yield pa.RecordBatch.from_arrays([ids, pa.array((at // w).astype(np.int32)), pa.array((at % w).astype(np.int32)), v], names=[id_col, "row", "col", "v"])

    return in_arrow(scenes.select(*names), apply, f"{id_col} {kind}, row int, col int, v array<double>")


def valid(scene: Column | None = None) -> Column:
    """Whether a scene row is consistent, in SQL."""
    c = (lambda n: scene[n]) if scene is not None else F.col
    return (F.size(c("bands")) == c("depth")) & (c("height") > 0) & (c("width") > 0) & (c("depth") > 0) & c("byteorder").isin(*BYTE_ORDERS)


# ---- PNG ----------------------------------------------------------------------------------------


def png(rgba: np.ndarray) -> bytes:
    """An 8-bit PNG of a (height, width, 3 or 4) array."""
    h, w, c = rgba.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rgba.astype(np.uint8).reshape(h, w * c)], axis=1).tobytes()

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", w, h, 8, 6 if c == 4 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def unpng(data: bytes) -> np.ndarray:
    """Pixels of a PNG as `png` writes it (8 bits, no interlace, filter 0)."""
    at, idat, w, h, c = 8, b"", 0, 0, 4
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            w, h, bits, colour = struct.unpack(">IIBB", body[:10])
            if bits != 8 or colour not in (2, 6):
                raise ValueError("only 8-bit RGB and RGBA")
            c = 4 if colour == 6 else 3
        elif kind == b"IDAT":
            idat += body
        at += 12 + n
    raw = np.frombuffer(zlib.decompress(idat), np.uint8).reshape(h, 1 + w * c)
    if raw[:, 0].any():
        raise ValueError("filtered rows")
    return raw[:, 1:].reshape(h, w, c)

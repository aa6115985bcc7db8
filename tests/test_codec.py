import base64
import json
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.schema import SCENE
from skyloom.sources import codec, scenes


def cube(seed, shape):
    r = np.random.default_rng(seed)
    c = r.normal(size=shape)
    c[r.random(shape) < 0.5] = 0
    return c


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.tuples(*[st.integers(1, 6)] * 3), st.booleans())
def test_round_trip(seed, shape, fortran):
    c = cube(seed, shape)
    s = codec.scene_of(c, [f"B{i:03d}" for i in range(shape[2])], {"a": "ü", "b": ""}, fortran)
    back = codec.decode_avro(codec.encode_avro(s))
    assert np.array_equal(codec.cube_of(back), c)
    assert back["metadata"] == {"a": "ü", "b": ""} and back["fortran"] == fortran


def test_strips_are_runs():
    c = np.array([0, 1, 2, 0, 0, 3, 0.0]).reshape(1, 7, 1)
    assert [i for i, _ in codec.suppress_zeros(c)] == [1, 5]
    assert codec.suppress_zeros(np.zeros((2, 2, 2))) == []


def test_big_endian_and_missing_last_block():
    c = cube(1, (2, 3, 2))
    s = codec.scene_of(c, ["a", "b"], {})
    s["byteorder"] = "BigEndian"
    s["data"] = [(i, np.frombuffer(b, "<f8").astype(">f8").tobytes()) for i, b in s["data"]]
    data = codec.encode_avro(s)
    assert np.array_equal(codec.cube_of(codec.decode_avro(data)), c)
    assert np.array_equal(codec.cube_of(codec.decode_avro(data[:-1])), c)


@pytest.mark.parametrize("change", [{"depth": 3}, {"height": 0}, {"byteorder": "Middle"}, {"bands": ["a", 1]}, {"metadata": {"a": 1}}])
def test_invalid(change):
    with pytest.raises(ValueError):
        codec.encode_avro({**codec.scene_of(cube(1, (2, 2, 2)), ["a", "b"], {}), **change})


def test_strip_outside():
    with pytest.raises(ValueError):
        codec.expand_zeros([(3, np.ones(2).tobytes())], 2, 2, 1, np.dtype("<f8"))


def test_lines(spark):
    c = cube(3, (4, 5, 2))
    good = base64.b64encode(codec.encode_avro(codec.scene_of(c, ["B001", "B002"], {"scene": "s"}))).decode()
    lines = spark.createDataFrame([(good,), ("BROKEN",), ("",), (None,), (good[: len(good) // 2],)], "value string")
    df = codec.decode_lines(lines)
    assert df.count() == 1
    px = codec.pixels_of(df.withColumn("scene_id", F.col("metadata")["scene"]), rows_at_once=3)
    got = {(r.row, r.col): r.v for r in px.collect()}
    assert len(got) == 20 and all(np.array_equal(v, c[k]) for k, v in got.items())
    again = codec.encode_lines(df).first().value
    assert np.array_equal(codec.cube_of(codec.decode_avro(base64.b64decode(again))), c)
    with pytest.raises(Exception):
        codec.decode_lines(lines, corrupt="fail").count()
    assert df.where(codec.valid()).count() == 1
    assert spark.createDataFrame([], SCENE).where(codec.valid()).count() == 0


def test_png():
    r = np.random.default_rng(1)
    for c in (3, 4):
        a = r.integers(0, 256, (5, 7, c)).astype(np.uint8)
        assert np.array_equal(codec.unpng(codec.png(a)), a)


def tiff(image, dtype="<i2", geo=None):
    h, w = image.shape
    raw = image.astype(dtype).tobytes()
    fmt = {"i": 2, "u": 1, "f": 3}[np.dtype(dtype).kind]
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [np.dtype(dtype).itemsize * 8]), (259, 3, [1]), (273, 4, [0]), (277, 3, [1]), (278, 4, [h]), (279, 4, [len(raw)]), (339, 3, [fmt])]
    if geo:
        tags += [(33550, 12, [geo[1], -geo[5], 0.0]), (33922, 12, [0.0, 0.0, 0.0, geo[0], geo[3], 0.0])]
    start = 8 + 2 + 12 * len(tags) + 4
    extra, entries, where = b"", b"", start
    for tag, kind, vals in tags:
        code = {3: "H", 4: "I", 12: "d"}[kind]
        body = struct.pack(f"<{len(vals)}{code}", *vals)
        if tag == 273:
            entries += struct.pack("<HHI", tag, kind, 1) + b"DATA"
        elif len(body) <= 4:
            entries += struct.pack("<HHI", tag, kind, len(vals)) + body.ljust(4, b"\0")
        else:
            entries += struct.pack("<HHII", tag, kind, len(vals), where)
            extra += body
            where += len(body)
    entries = entries.replace(b"DATA", struct.pack("<I", where))
    return b"II" + struct.pack("<HI", 42, 8) + struct.pack("<H", len(tags)) + entries + b"\0\0\0\0" + extra + raw


def lzw(data):
    """A plain encoder, to be read back."""
    out, n, bits, width, table, run = bytearray(), 0, 0, 9, {bytes([i]): i for i in range(256)}, b""

    def put(code):
        nonlocal n, bits
        bits, n = (bits << width) | code, n + width
        while n >= 8:
            n -= 8
            out.append(bits >> n)
            bits &= (1 << n) - 1

    put(256)
    size = 258
    for c in data:
        nxt = run + bytes([c])
        if nxt in table:
            run = nxt
            continue
        put(table[run])
        table[nxt], size = size, size + 1
        run = bytes([c])
        if size >= 1 << width and width < 12:
            width += 1
        if size >= 4094:
            put(256)
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
    put(table[run])
    size += 1
    if size >= 1 << width and width < 12:
        width += 1
    put(257)
    if n:
        out.append(bits << (8 - n) & 255)
    return bytes(out)


def packbits(data):
    out = bytearray()
    for lo in range(0, len(data), 128):
        part = data[lo : lo + 128]
        out += bytes([257 - len(part), part[0]]) if len(part) > 1 and len(set(part)) == 1 else bytes([len(part) - 1]) + part
    return bytes(out)


def packed_tiff(image, dtype, order, compression, predictor, tile=None, rows=5, samples=1):
    """A TIFF in strips of `rows` or tiles, with further bands of noise."""
    kind = np.dtype(order + dtype)
    cube = np.dstack([image, *[image + k for k in range(1, samples)]]).astype(kind)
    h, w = image.shape
    th, tw = tile or (rows, w)
    pack = {1: bytes, 5: lzw, 8: zlib.compress, 32773: packbits}[compression]
    bodies = []
    for y in range(0, h, th):
        for x in range(0, w, tw):
            part = cube[y : y + th, x : x + tw]
            if tile:
                part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1]), (0, 0)))
            if predictor == 2:
                part = np.concatenate([part[:, :1], np.diff(part.astype(kind.newbyteorder("=")), axis=1)], axis=1).astype(kind)
            raw = np.ascontiguousarray(part).tobytes()
            if predictor == 3:
                lines = np.ascontiguousarray(part.reshape(len(part), -1).astype(kind.newbyteorder(">"))).view(np.uint8).reshape(len(part), -1, kind.itemsize)
                planes = lines.transpose(0, 2, 1).reshape(len(part), -1)
                raw = np.concatenate([planes[:, :1], np.diff(planes, axis=1)], axis=1).tobytes()
            bodies.append(pack(raw))
    o = {"<": "<", ">": ">"}[order]
    fmt = {"i": 2, "u": 1, "f": 3}[kind.kind]
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [kind.itemsize * 8]), (259, 3, [compression]), (277, 3, [samples]), (317, 3, [predictor]), (339, 3, [fmt])]
    tags += [(322, 3, [tw]), (323, 3, [th])] if tile else [(278, 4, [rows])]
    places = [(324 if tile else 273, 4, None), (325 if tile else 279, 4, [len(x) for x in bodies])]
    tags = sorted(tags + places)
    start = 8 + 2 + 12 * len(tags) + 4
    extra_at = start
    data_at = start + 2 * 4 * len(bodies)
    offsets = [data_at + sum(len(x) for x in bodies[:k]) for k in range(len(bodies))]
    entries, extra = b"", b""
    for tag, code, vals in tags:
        vals = offsets if vals is None else vals
        body = struct.pack(f"{o}{len(vals)}{'H' if code == 3 else 'I'}", *vals)
        if tag in (273, 279, 324, 325) and len(vals) > 1:
            entries += struct.pack(f"{o}HHII", tag, code, len(vals), extra_at + len(extra))
            extra += body
        else:
            entries += struct.pack(f"{o}HHI", tag, code, len(vals)) + body.ljust(4, b"\0")
    extra = extra.ljust(2 * 4 * len(bodies), b"\0")
    return (b"II" if o == "<" else b"MM") + struct.pack(f"{o}HIH", 42, 8, len(tags)) + entries + bytes(4) + extra + b"".join(bodies)


@pytest.mark.parametrize("compression", [1, 5, 8, 32773])
@pytest.mark.parametrize(("dtype", "predictor"), [("u2", 1), ("i2", 2), ("u1", 2), ("f4", 3), ("f8", 1), ("i4", 1), ("f8", 3)])
@pytest.mark.parametrize(("order", "tile", "samples"), [("<", None, 1), (">", (16, 16), 1), ("<", (8, 32), 3)])
def test_packed_tiffs(compression, dtype, predictor, order, tile, samples):
    r = np.random.default_rng(3)
    image = r.integers(0, 200, (37, 41)) // (1 if samples == 1 else 9) * (1.5 if dtype[0] == "f" else 1)
    image[5:20] = 7
    got, _ = scenes.read_tiff(packed_tiff(image.astype(dtype), dtype, order, compression, predictor, tile, samples=samples))
    assert np.array_equal(got, image.astype(dtype))


L1T = """GROUP = L1_METADATA_FILE
  GROUP = PRODUCT_METADATA
    SENSOR_ID = "HYPERION"
    START_TIME = "2012 030 01:02:03"
  END_GROUP = PRODUCT_METADATA
  GROUP = RADIANCE_SCALING
    SCALING_FACTOR_VNIR = 40.0
    SCALING_FACTOR_SWIR = 80.0
  END_GROUP = RADIANCE_SCALING
END_GROUP = L1_METADATA_FILE
END
AFTER = 1
"""


def test_ingest(spark, tmp_path):
    geo = [500000.0, 30.0, 0.0, 4000000.0, 0.0, -30.0]
    r = np.random.default_rng(5)
    images = {b: r.integers(0, 3000, (6, 4)) for b in ("B016", "B023", "B083", "B029")}
    for folder in ("s1", "s2"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / f"EO1H_{folder}_MTL.L1T").write_text(L1T)
        for b, im in images.items():
            if (folder, b) != ("s2", "B083"):
                (tmp_path / folder / f"EO1H_{folder}_{b}_L1T.TIF").write_bytes(tiff(im, geo=geo))
    meta = scenes.read_l1t(spark, str(tmp_path))
    assert {r.folder.rpartition("/")[2] for r in meta.collect()} == {"s1", "s2"}
    assert meta.first().l1t["RADIANCE_SCALING"]["SCALING_FACTOR_VNIR"] == "40.0"
    wanted = ("B016", "B029", "B083")
    bands = scenes.read_bands(spark, str(tmp_path), wanted)
    assert bands.count() == 5
    both = scenes.assemble(bands, meta).collect()
    assert {s.depth for s in both} == {2, 3}
    (one,) = scenes.assemble(bands, meta, require_all=wanted).collect()
    c = codec.cube_of({**one.asDict(), "data": [(d["index"], bytes(d["strip"])) for d in one.data]})
    assert one.bands == ["B016", "B029", "B083"]
    assert np.allclose(c, np.dstack([images["B016"] / 40, images["B029"] / 40, images["B083"] / 80]))
    assert json.loads(one.metadata["GeoTransform"]) == geo
    out = str(tmp_path / "lines")
    scenes.write_scenes(scenes.assemble(bands, meta), out)
    assert scenes.read_scenes(spark, out).count() == 2


def test_l1t_nesting_and_end():
    got = scenes.parse_l1t(L1T)
    assert set(got) == {"L1_METADATA_FILE", "PRODUCT_METADATA", "RADIANCE_SCALING"} and "AFTER" not in str(got)


@pytest.mark.parametrize("data", [tiff(np.ones((2, 2)), "<i2").replace(b"II", b"II", 1)[:8] + b"\0\0", b"MM\0\0\0\0\0\0\0\0"])
def test_bad_tiff(data):
    with pytest.raises(Exception):
        scenes.read_tiff(data)


def test_config_and_template(tmp_path):
    (tmp_path / "c.ini").write_text("[DEFAULT]\nlib.jvm = /x\naccumulate = 10%\n")
    c = scenes.Config.read(str(tmp_path / "none.ini"), str(tmp_path / "c.ini"))
    assert c.get("lib.jvm") == "/x" and c.get("accumulate") == "10%" and c.get("no", "d") == "d"
    t = scenes.ClusterTemplate.read(
        '<PMML xmlns="http://x"><ClusteringModel><ClusteringField field="longitude"/><ClusteringField field="latitude"/>'
        '<Cluster id="1"><Array n="2" type="real">1.5 -2</Array></Cluster><Cluster id="2"><Array n="2" type="real">0 3</Array></Cluster></ClusteringModel></PMML>'
    )
    assert t.fields == ("longitude", "latitude") and t.centres == ((1.5, -2.0), (0.0, 3.0))


def test_text_sources(spark, tmp_path):
    b = scenes.read_bright(spark.createDataFrame([("world\t1.5 -2 77 x",)], "value string")).first()
    assert (b.longitude, b.latitude, b.ts, b.intensity) == (1.5, -2.0, 77, None)
    with pytest.raises(Exception, match="unexpected key"):
        scenes.read_bright(spark.createDataFrame([("moon\t1 2 3 4",)], "value string")).collect()
    t = scenes.read_tiles(spark.createDataFrame([("T10-00001-00002-0000000003\tabc",), ("T10-1-2-3\tx",), ("T10-00001-00002-0000000003\tBROKEN",)], "value string")).collect()
    assert [(r.depth, r.x, r.y, r.ts, r.payload) for r in t] == [(10, 1, 2, 3, "abc")]
    rows = spark.createDataFrame([([1.0, 2.5], 3), ([0.0, -1.0], 1)], "features array<double>, class int")
    scenes.write_training(rows, str(tmp_path / "t"), 2)
    back = scenes.read_training(spark.read.text(str(tmp_path / "t")))
    assert sorted((r["class"], r.features) for r in back.collect()) == [(1, [0.0, -1.0]), (3, [1.0, 2.5])]
    for cover in ("clouds", "water", "other"):
        (tmp_path / "tr" / cover).mkdir(parents=True)
        (tmp_path / "tr" / cover / "f").write_text(cover)
    got = scenes.training_files(spark, str(tmp_path / "tr"), ("clouds", "desert", "water")).collect()
    assert sorted((r.cover, r["class"]) for r in got) == [("clouds", 1), ("water", 3)]
    (tmp_path / "cat.json").write_text(json.dumps({"data": [{"directory": "d", "acquisition_start": 5, "radiance_B02": 1.5, "corners": [[0, 0], [1, 0], [1, 1], [0, 1]]}]}))
    c = scenes.read_catalogue(spark, str(tmp_path / "cat.json"), "ALI").first()
    assert (c.sensor, c.directory, c.radiance_B02, c.radiance_B03, len(c.corners)) == ("ALI", "d", 1.5, None, 4)

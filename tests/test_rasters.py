"""Band files read by pieces: only what a query needs is read, and scenes go to tiles by blocks."""

import json

import numpy as np
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from skyloom.operators import geo
from skyloom.plans import pipelines
from skyloom.schema import LayerSpec
from skyloom.sources import rasters, scenes, store

GEO = [94.0, 0.01, 0.0, 41.0, 0.0, -0.01]
L1T = """GROUP = L1_METADATA_FILE
  GROUP = PRODUCT_METADATA
    START_TIME = "2012 030 00:00:00"
  END_GROUP = PRODUCT_METADATA
  GROUP = RADIANCE_SCALING
    SCALING_FACTOR_VNIR = 40.0
    SCALING_FACTOR_SWIR = 80.0
  END_GROUP = RADIANCE_SCALING
END_GROUP = L1_METADATA_FILE
END
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Two scenes of three bands, in strips of 5 rows."""
    top, cubes = tmp_path_factory.mktemp("bands"), {}
    for k, h in (("one", 83), ("two", 40)):
        (top / k).mkdir()
        (top / k / "a.L1T").write_text(L1T)
        for i, band in enumerate(("B016", "B023", "B029")):
            image = np.random.default_rng(i + h).random((h, 60)) * 2000 + 10
            cubes[k, band] = image
            (top / k / f"EO1H_{k}_{band}_L1T.TIF").write_bytes(scenes.tiff_bytes(image, [GEO[0] + (h == 40), *GEO[1:]], rows=5))
        (top / k / f"EO1H_{k}_B016_OTHER.TXT").write_text("no raster")
    return top, cubes


def test_strips_of_a_file(folder):
    top, cubes = folder
    data = (top / "one" / "EO1H_one_B016_L1T.TIF").read_bytes()
    image, at = scenes.read_tiff(data)
    assert np.array_equal(image, cubes["one", "B016"]) and at == pytest.approx(GEO)
    assert len(scenes.Tiff(lambda a, n: data[a : a + n]).places) == 17


def test_a_crop_reads_its_strips_alone(folder, monkeypatch):
    """Bytes are counted: the directory, and the strips that the window meets."""
    top, cubes = folder
    count = [0]

    class Counted:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def read_at(self, n, at):
            count[0] += n
            return self.file.read_at(n, at)

    real = pyarrow.fs.FileSystem.from_uri

    class Store:
        def __init__(self, uri):
            self.store, self.top = real(uri)

        def get_file_info(self, what):
            return self.store.get_file_info(what)

        def open_input_file(self, path):
            return Counted(self.store.open_input_file(path))

    monkeypatch.setattr(rasters.pyarrow.fs, "FileSystem", type("F", (), {"from_uri": staticmethod(lambda uri: (Store(uri), real(uri)[1]))}))
    reader = rasters.StripReader({"path": f"file://{top}"})
    left = list(reader.pushFilters([rasters.EqualTo(("band",), "B016"), rasters.GreaterThanOrEqual(("row1",), 22), rasters.LessThanOrEqual(("row0",), 31), rasters.EqualTo(("folder",), "x")]))
    assert left == [rasters.EqualTo(("folder",), "x")]  # what the source can't apply is Spark's
    parts = reader.partitions()
    assert {p.path.rsplit("/", 2)[-1] for p in parts} == {"EO1H_one_B016_L1T.TIF", "EO1H_two_B016_L1T.TIF"}
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted((r["row0"], r["row1"]) for r in rows) == sorted([(20, 24), (25, 29), (30, 34)] * 2)
    strips = 2 * 3 * 5 * 60 * 8
    assert strips <= count[0] <= strips + 2 * 2000 and count[0] < 0.3 * sum(c.nbytes for (_, b), c in cubes.items() if b == "B016")
    assert sum(r["stored"] for r in rows) == strips


def test_filters_reach_the_source(spark, folder):
    top, cubes = folder
    window = (22, 31, 7, 20)
    strips = rasters.read_strips(spark, f"file://{top}", ("B016", "B029"), window)
    assert {(r.row0, r.band) for r in strips.collect()} == {(r, b) for r in (20, 25, 30) for b in ("B016", "B029")}
    got = {(r.folder.rsplit("/", 1)[-1], r.band, r.row, r.col): r.value for r in rasters.pixels_of_strips(strips, window).collect()}
    want = {(k, b, i, j): float(cubes[k, b][i, j]) for k in ("one", "two") for b in ("B016", "B029") for i in range(22, 32) for j in range(7, 21)}
    assert got == want
    assert rasters.read_strips(spark, f"file://{top}", ("B999",)).isEmpty()


def test_files_are_cut_into_tasks(spark, folder):
    """Every piece is read once, however a file is cut."""
    top, _ = folder
    rows = rasters.read_strips(spark, f"file://{top}", None, partBytes="4000")
    assert rows.rdd.getNumPartitions() > 20
    assert rows.count() == 3 * (17 + 8) == rows.select("folder", "band", "row0").distinct().count()


def test_band_files_to_tiles_by_blocks(spark, folder, tmp_path):
    """Straight from strips gives the tiles of assembled scenes."""
    top, _ = folder
    bands = ("B016", "B023", "B029")
    l1t = scenes.read_l1t(spark, f"file://{top}")
    pieces = rasters.read_strips(spark, f"file://{top}", bands)
    how = {"depth": 8, "width": 64, "height": 32, "order": 3}
    got = geo.tile_blocks(rasters.block_strips(pieces, l1t, bands), **how, block=32).collect()
    whole = geo.tile_scenes(scenes.assemble(scenes.read_bands(spark, str(top)), l1t), **how).collect()
    name = lambda r: (r.scene_id.rsplit("/", 1)[-1], r.x, r.y, r.row, r.col)
    a, b = sorted((*name(r), r.mask, *r.v) for r in got), sorted((*name(r), r.mask, *r.v) for r in whole)
    assert len(a) == len(b) > 100 and [x[:5] for x in a] == [x[:5] for x in b]
    assert np.allclose([x[5:] for x in a], [x[5:] for x in b], rtol=0, atol=1e-9)
    spec = LayerSpec("RGB", ("B029", "B023", "B016"), "RGB", 0.0, 60.0)
    drawn = pipelines.rasters_to_tiles(pieces, l1t, bands, [spec], str(tmp_path / "t"), depth=7, top=6, order=1)
    assert {r.depth for r in drawn.collect()} == {6, 7} and json.loads(store.get_tile_metadata(spark, str(tmp_path / "t"), drawn.first().row_key).first().metadata) == {}
    assert drawn.where(F.length("l2png") > 60).count() == drawn.count()

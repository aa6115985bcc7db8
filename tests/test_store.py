"""The store of tiles and points: upserts by block, the incremental pyramid, ranges of the curve."""

import json
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skyloom.functions import grid
from skyloom.plans import pipelines
from skyloom.schema import SCENE, LayerSpec
from skyloom.sources import codec, store


def files(path) -> dict[str, tuple]:
    """Data files and when they were written, by place."""
    found = {}
    for top, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                f = os.path.join(top, n)
                found[os.path.relpath(f, path)] = os.stat(f).st_mtime_ns
    return found


def images(spark, *rows):
    return spark.createDataFrame([(d, x, y, layer, png.encode(), meta) for d, x, y, layer, png, meta in rows], "depth int, x int, y int, layer string, png binary, metadata string")


def stored(spark, path):
    return {r.row_key: (bytes(r.l2png).decode(), r.metadata) for r in store.read_tiles(spark, path).collect()}


def test_a_tile_replaces_itself_alone(spark, tmp_path):
    path = str(tmp_path / "tiles")
    store.write_tiles(images(spark, (10, 1561, 1485, "RGB", "a", "{}"), (10, 1562, 1485, "RGB", "b", "{}"), (10, 3, 4, "RGB", "far", "{}"), (9, 780, 742, "RGB", "up", "{}")), path)
    before = files(path)
    store.write_tiles(images(spark, (10, 1562, 1485, "RGB", "B", '{"n": 2}'), (10, 1563, 1485, "RGB", "c", "{}"), (10, 1561, 1485, "2012", "year", "{}")), path)
    assert stored(spark, path) == {
        "T10-01561-01485-RGB": ("a", "{}"), "T10-01562-01485-RGB": ("B", '{"n": 2}'), "T10-01563-01485-RGB": ("c", "{}"), "T10-00003-00004-RGB": ("far", "{}"),
        "T09-00780-00742-RGB": ("up", "{}"), "T10-01561-01485-2012": ("year", "{}"),
    }
    after = files(path)
    kept = {f for f in before if after.get(f) == before[f]}
    assert len(kept) == 2 and all("depth=9" in f or "b00000_00000" in f for f in kept)  # other blocks' files are the same ones
    assert store.tile_image(spark, path, "T10-01562-01485-RGB") == b"B" and store.tile_image(spark, path, "T10-01561-01485-2012") == b"year"
    assert store.get_tile_metadata(spark, path, "T10-01562-01485-RGB").first().metadata == '{"n": 2}'


def test_writing_nothing_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "tiles")
    store.write_tiles(images(spark, (4, 1, 1, "RGB", "a", "{}")), path)
    before = files(path)
    store.write_tiles(images(spark).limit(0), path)
    assert files(path) == before and stored(spark, path) == {"T04-00001-00001-RGB": ("a", "{}")}


def scene(name, day, value, lon, lat=41.0, n=40):
    r = np.random.default_rng(day)
    cube = np.full((n, n, 1), float(value)) + r.random((n, n, 1))
    meta = {"L1T": json.dumps({"PRODUCT_METADATA": {"START_TIME": f"2012 {day:03d} 00:00:00"}}), "GeoTransform": json.dumps([lon, 0.01, 0, lat, 0, -0.01]), "Projection": ""}
    return {"scene_id": name, **(s := codec.scene_of(cube, ["B016"], meta)), "data": [{"index": i, "strip": b} for i, b in s["data"]]}


def laid(spark, path, *scenes):
    table = spark.createDataFrame(list(scenes), f"scene_id string, {SCENE}")
    return pipelines.scenes_to_tiles(table, ["B016"], [LayerSpec("Y", ("B016",), "yellow", 0.0, 100.0)], path, depth=8, top=5, order=1)


def pictures(table):
    return {r.row_key: bytes(r.l2png) for r in table.collect()}


def test_incremental_pyramid(spark, tmp_path):
    """Batches in any order give what all scenes at once give; what they don't touch stays as it is."""
    a, b, c, far = scene("a", 30, 20, 94.0), scene("b", 60, 80, 94.2), scene("c", 45, 50, 94.1, 40.9), scene("far", 10, 70, -60.0, -20.0)
    whole = pictures(laid(spark, str(tmp_path / "whole"), a, b, c, far))
    path = str(tmp_path / "steps")
    laid(spark, path, b, far)  # the last scene first
    before, cells = files(path), files(pipelines.cells_path(path))
    laid(spark, path, a)
    steps = laid(spark, path, c)
    assert pictures(steps) == whole and len({k[:3] for k in whole}) == 4
    after = files(path)
    kept = [f for f in before if after.get(f) == before[f]]
    assert len(kept) == 4 and len([f for f in cells if files(pipelines.cells_path(path)).get(f) == cells[f]]) == 4  # the far scene's, a block for each level
    again = laid(spark, path, c)
    assert pictures(again) == whole


def test_morton():
    """A box's ranges hold all its tiles; one range for a cell of the quadtree; few enough always."""
    code = lambda x, y: sum((x >> i & 1) << (2 * i) | (y >> i & 1) << (2 * i + 1) for i in range(16))
    rng = np.random.default_rng(1)
    for _ in range(40):
        x0, y0, w, h = (int(v) for v in (*rng.integers(0, 2048, 2), *rng.integers(0, 60, 2)))
        box = (x0, min(x0 + w, 2048), y0, min(y0 + h, 2047))
        ranges = grid.morton_ranges(*box)
        assert 1 <= len(ranges) <= 16 and all(a <= b for a, b in ranges) and all(p[1] + 1 < q[0] for p, q in zip(ranges, ranges[1:], strict=False))
        inside = [code(x, y) for x in range(box[0], box[1] + 1) for y in range(box[2], box[3] + 1)]
        assert all(any(a <= z <= b for a, b in ranges) for z in inside)
        assert sum(b - a + 1 for a, b in grid.morton_ranges(*box, most=10**6)) == len(inside)  # exact where any number will do
    assert grid.morton_ranges(64, 127, 128, 191) == [(code(64, 128), code(127, 191))]
    assert grid.morton_ranges(5, 4, 0, 9) == [] and grid.morton_ranges(-9, -1, 0, 5) == []


def test_morton_column(spark):
    got = spark.createDataFrame([(x, y) for x in (0, 1, 5, 2047, 2048) for y in (0, 2, 1025, 2047)], "x int, y int").select("x", "y", grid.morton(F.col("x"), F.col("y")).alias("z")).collect()
    for r in got:
        assert r.z == sum((r.x >> i & 1) << (2 * i) | (r.y >> i & 1) << (2 * i + 1) for i in range(16))


@pytest.fixture(scope="module")
def point_table(spark, tmp_path_factory):
    rng = np.random.default_rng(2)
    rows = [(float(a), float(b), int(t)) for a, b, t in zip(rng.uniform(-179, 179, 60000), rng.uniform(-89, 89, 60000), rng.integers(0, 10**6, 60000), strict=True)]
    points = store.point_rows(spark.createDataFrame(rows, "longitude double, latitude double, ts bigint"), metadata=None)
    path = str(tmp_path_factory.mktemp("points") / "z")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext._jsc.hadoopConfiguration().setInt("parquet.block.size", 64 << 10)  # small row groups
    try:
        store.write_points(points, path, 8)
        other = f"{path}-xy"
        points.repartitionByRange(8, "x", "y", "ts").sortWithinPartitions("x", "y", "ts").write.parquet(other)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    return points, path, other


def groups(path, hit) -> tuple[int, int]:
    """Row groups that the statistics leave, and all."""
    met = total = 0
    for f in files(path):
        meta = pq.ParquetFile(os.path.join(path, f)).metadata
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = {n: meta.row_group(g).column(i).statistics for i, n in enumerate(names) if n in ("x", "y", "z")}
            met, total = met + bool(hit({n: (s.min, s.max) for n, s in stats.items()})), total + 1
    return met, total


@pytest.mark.parametrize("box", [(0, 2048, 1000, 1010), (1000, 1010, 0, 2047), (500, 560, 900, 960)])
def test_boxes_by_ranges(spark, point_table, box):
    points, path, other = point_table
    want = points.where(F.col("x").between(*box[:2]) & F.col("y").between(*box[2:])).select("row_key")
    found = store.scan_box(store.read_points(spark, path), *box, ordered=False)
    assert sorted(r[0] for r in found.select("row_key").collect()) == sorted(r[0] for r in want.collect())
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    try:
        plan = store.scan_box(store.read_points(spark, path), *box)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(z," in plan[plan.index("PushedFilters") :]  # the ranges reach the files
    ranges = grid.morton_ranges(*box)
    overlap = lambda a, lo, hi: a[0] <= hi and a[1] >= lo
    flat = lambda s: overlap(s["x"], *box[:2]) and overlap(s["y"], *box[2:])
    curve, n = groups(path, lambda s: flat(s) and any(overlap(s["z"], *r) for r in ranges))
    sorted_, m = groups(other, flat)
    assert n > 20
    if box[1] - box[0] > 2000:  # a wide box meets every range of x, but few of the curve
        assert curve / n < 0.45 and sorted_ / m > 0.9, (curve, n, sorted_, m)
    else:
        assert curve / n < 0.45, (curve, n)


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = store.point_rows(spark.createDataFrame([(float(i), 1.0, i) for i in range(50)], "longitude double, latitude double, ts bigint"), metadata=None)
    for _ in range(3):
        store.write_points(rows, path)
    assert spark.read.parquet(path).count() == 150
    store.compact_points(spark, path)
    assert spark.read.parquet(path).count() == 50 == store.read_points(spark, path).count()

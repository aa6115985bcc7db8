import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import bands as B
from skyloom.functions import calib
from skyloom.functions.projection import Projection
from skyloom.operators import catalog, change, classify, explore, geo, points, tiles
from skyloom.plans import pipelines
from skyloom.schema import ColumnAnalytic, LayerSpec, chain
from skyloom.sources import codec, scenes, store


# ---- expressions -----------------------------------------------------------------------------


def test_expression(spark):
    df = spark.createDataFrame([(2.0, 3.0), (0.0, 5.0)], "B001 double, B002 double")
    e = B.Expression("Math.pow(B001, 2) + (B002 > 4 ? -1 : B002 % 2) * 2", ["B001", "B002"])
    assert [r[0] for r in df.select(e.column(F.col)).collect()] == [6.0, -2.0]
    assert e.used == ["B001", "B002"] and not e.bare and B.Expression("B001", ["B001"]).bare


@pytest.mark.parametrize("text", ["java.lang.System.exit(0)", "B001; B002", "B009", "B001 +", "(B001", "B001 = 2", "reflect('a')", ""])
def test_expression_rejects(text):
    with pytest.raises(ValueError):
        B.Expression(text, ["B001", "B002"])


def test_masks(spark):
    rows = [([1.0, -2.0, 3.0],), ([-1.0, 2.0, 3.0],), ([1.0, 0.0, 3.0],), ([1.0, 2.0, 3.0],), ([5.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    got = df.select(B.mask_positive(F.col("v")).alias("p"), B.mask_truthy(F.col("v")).alias("t"), B.opaque(F.col("v")).alias("o")).collect()
    assert [r.p for r in got] == [False, False, False, True, True]
    assert [r.t for r in got] == [True, False, False, True, True]
    assert [r.o for r in got] == [True, True, False, True, True]


def test_co2_missing_band(spark):
    assert spark.range(1).select(B.co2_index({183: F.lit(1.0)})).first()[0] == 0.0
    px = spark.createDataFrame([tuple(float(i) for i in range(1, 8))], ", ".join(f"{b} double" for b in ("B016", "B183", "B184", "B185", "B186", "B188", "B189")))
    out, names = chain(px, px.columns, [ColumnAnalytic("co2", B.co2_bands, B.co2_analytic)])
    assert names == out.columns == ["B016", "CO2"]
    y = {b: np.log(i + 2 + 0.00125) for i, b in enumerate((183, 184, 185, 186, 188, 189))}
    fit = np.polyfit([183, 184, 188, 189], [y[b] for b in (183, 184, 188, 189)], 1)
    assert np.isclose(out.first().CO2, np.exp(-np.mean([y[b] - np.polyval(fit, b) for b in (185, 186)])))


# ---- tiles -------------------------------------------------------------------------------------


def test_overlay_is_sequential(spark):
    r = np.random.default_rng(2)
    rows = [(int(r.integers(2)), int(r.integers(3)), int(t), float(r.random()), float(r.random() < 0.7)) for t in r.permutation(60)]
    df = spark.createDataFrame(rows, "row int, col int, ts int, value double, mask double")
    want = {}
    for row, col, _, v, m in sorted(rows, key=lambda x: x[2]):
        if m > 0.5:
            want[row, col] = v
    got = tiles.overlay(df, ["value"], ["ts"], ["row", "col"])
    assert {(r.row, r.col): r.value for r in got.collect()} == want


def test_pyramid_forms_agree(spark):
    r = np.random.default_rng(3)
    rows = [(4, int(r.integers(32)), int(r.integers(32)), int(r.integers(256)) & ~7, int(r.integers(512)) & ~7, i) for i in range(400)]
    df = spark.createDataFrame(rows, "depth int, x int, y int, row int, col int, v int")
    step = df
    for k in range(1, 4):
        step = tiles.collate(step)
        a = {tuple(x) for x in step.select("depth", "x", "y", "row", "col", "v").collect()}
        b = {tuple(x) for x in tiles.shallower(df, k, 4).select("depth", "x", "y", "row", "col", "v").collect()}
        assert a == b and a
    assert tiles.pyramid(df, 4, 1).where("depth = 1").count() == tiles.shallower(df, 3, 4).count()


def test_degenerate_ranges(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 20.0), (2, 20.0), (2, 3.0), (3, 11.0)], "g int, v double")
    got = {r.g: (r.low, r.high) for r in tiles.percentile_range(df, ["v"], ["g"]).collect()}
    assert got == {1: (0.0, 1.0), 2: (3.0, 20.0), 3: (0.0, 1.0)}


def test_nearest_rank(spark):
    v = [float(x) for x in np.random.default_rng(1).integers(0, 30, 137)]
    r = tiles.nearest_rank_range(spark.createDataFrame([(1, x) for x in v], "g int, v double"), ["v"], ["g"]).first()
    s = sorted(v)
    assert (r.low, r.high) == (s[int(137 * 0.05)], s[min(int(np.ceil(137 * 0.95)), 136)])


def test_images_and_layers(spark):
    px = spark.createDataFrame([(1, 0, 0, 2, 3, 1, 5.0, 1.0), (1, 0, 0, 0, 0, 1, 50.0, 1.0)], "depth int, x int, y int, row int, col int, scene_id int, B1 double, mask double")
    y = tiles.layer_pixels(px, LayerSpec("C", ("B1",), "yellow", 0.0, 50.0))
    image = codec.unpng(bytes(tiles.images(y).first().png))
    assert image.shape == (256, 512, 4) and image[0, 0].tolist() == [255, 255, 0, 255] and image[2, 3].tolist() == [25, 25, 0, 25] and image.sum() == 765 + 75
    with pytest.raises(NotImplementedError):
        LayerSpec("x", ("a",), "blue")


# ---- geometry ------------------------------------------------------------------------------------


def test_projection_round_trip():
    for p in (Projection.utm(33), Projection.utm(56, south=True), Projection(lon0=9.0, lat0=40.0, scale=0.9999, east=1e5, north=2e5)):
        lon, lat = p.lon0 + np.linspace(-3, 3, 50), np.linspace(-70 if p.north == 1e7 else 1, 79, 50)
        x, y = p.to_grid(lon, lat)
        lon2, lat2 = p.to_degrees(x, y)
        assert np.allclose(lon, lon2, atol=1e-10) and np.allclose(lat, lat2, atol=1e-10)
    # a known place: 9 degrees east on the equator is the origin of zone 32; one degree north is 0.9996 meridian degrees
    x, y = Projection.utm(32).to_grid(9.0, 0.0)
    assert np.isclose(x, 500000) and np.isclose(y, 0, atol=1e-6)
    assert np.isclose(Projection.utm(32).to_grid(9.0, 45.0)[1], 0.9996 * 4984944.378, atol=0.01)


def test_projection_wkt(spark):
    wkt = 'PROJCS["WGS 84 / UTM zone 33N",GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563]]],PROJECTION["Transverse_Mercator"],PARAMETER["latitude_of_origin",0],PARAMETER["central_meridian",15],PARAMETER["scale_factor",0.9996],PARAMETER["false_easting",500000],PARAMETER["false_northing",0]]'
    assert Projection.parse(wkt) == Projection.utm(33)
    with pytest.raises(ValueError):
        Projection.parse('PROJCS["x",PROJECTION["Lambert_Conformal_Conic"]]')
    from skyloom.functions.projection import lon_lat

    got = spark.createDataFrame([(500000.0, 0.0)], "x double, y double").select(lon_lat(F.col("x"), F.col("y"), wkt).alias("p")).first().p
    assert np.isclose(got.longitude, 15) and np.isclose(got.latitude, 0)


CLARKE, INTERNATIONAL = 'GEOGCS["x",DATUM["x",SPHEROID["c",6378206.4,294.9786982]],UNIT["degree",0.0174532925]]', 'GEOGCS["x",DATUM["x",SPHEROID["i",6378388,297]]]'


def described(name, spheroid, unit="", **numbers):
    return f'PROJCS["x",{spheroid},PROJECTION["{name}"],' + ",".join(f'PARAMETER["{k}",{v}]' for k, v in {"false_easting": 0, "false_northing": 0, **numbers}.items()) + unit + "]"


@pytest.mark.parametrize(
    ("wkt", "at", "want"),
    [
        # worked examples of a textbook on map projections, to a decimetre
        (described("Lambert_Conformal_Conic_2SP", CLARKE, latitude_of_origin=23, central_meridian=-96, standard_parallel_1=33, standard_parallel_2=45), (-75, 35), (1894410.9, 1564649.5)),
        (described("Albers_Conic_Equal_Area", CLARKE, latitude_of_center=23, longitude_of_center=-96, standard_parallel_1=29.5, standard_parallel_2=45.5), (-75, 35), (1885472.7, 1535925.0)),
        (described("Polar_Stereographic", INTERNATIONAL, latitude_of_origin=-71, central_meridian=-100, scale_factor=1), (150, -75), (-1540033.6, -560526.4)),
        (described("Mercator_1SP", CLARKE, central_meridian=-180, scale_factor=1), (-75, 35), (11688673.7, 4139145.6)),
        (described("Lambert_Azimuthal_Equal_Area", CLARKE, latitude_of_center=40, longitude_of_center=-100), (-110, 30), (-965932.1, -1056814.9)),
        # a degree of the web's sphere
        (described("Mercator_Auxiliary_Sphere", 'GEOGCS["WGS 84",DATUM["x",SPHEROID["WGS 84",6378137,298.257223563]]]', central_meridian=0), (1, 0), (111319.4908, 0.0)),
    ],
)
def test_other_projections(wkt, at, want):
    p = Projection.parse(wkt)
    assert np.allclose(p.to_grid(*at), want, atol=0.1)
    r = np.random.default_rng(1)
    lon, lat = p.lon0 + r.uniform(-40, 40, 50), np.sign(p.lat0 or 1) * r.uniform(15, 80, 50)
    back = p.to_degrees(*p.to_grid(lon, lat))
    assert np.allclose((back[0] - lon + 180) % 360 - 180, 0, atol=1e-9) and np.allclose(back[1], lat, atol=1e-9)
    feet = Projection.parse(wkt[:-1] + ',UNIT["US survey foot",0.3048006096012192]]')
    assert np.allclose(np.array(feet.to_grid(*at)) * 0.3048006096012192, want, atol=0.1)


@pytest.mark.parametrize("kind", ["utm", "tm", "lambert", "albers", "polar", "mercator", "azimuthal", "sphere"])
def test_projections_as_columns(spark, kind):
    """SQL functions place points as arrays do, both ways, and no Python runs."""
    wkt = {
        "tm": described("Transverse_Mercator", CLARKE, latitude_of_origin=40, central_meridian=9, scale_factor=0.9999),
        "lambert": described("Lambert_Conformal_Conic_2SP", CLARKE, latitude_of_origin=23, central_meridian=-96, standard_parallel_1=33, standard_parallel_2=45),
        "albers": described("Albers_Conic_Equal_Area", CLARKE, latitude_of_center=23, longitude_of_center=-96, standard_parallel_1=29.5, standard_parallel_2=45.5),
        "polar": described("Polar_Stereographic", INTERNATIONAL, latitude_of_origin=-71, central_meridian=-100, scale_factor=1),
        "mercator": described("Mercator_1SP", CLARKE, central_meridian=-180, scale_factor=1),
        "azimuthal": described("Lambert_Azimuthal_Equal_Area", CLARKE, latitude_of_center=40, longitude_of_center=-100),
        "sphere": described("Mercator_Auxiliary_Sphere", CLARKE, central_meridian=0),
    }.get(kind)
    from skyloom.functions.projection import lon_lat

    p = Projection.parse(wkt) if wkt else Projection.utm(33)
    r = np.random.default_rng(3)
    reach = 3 if kind in ("utm", "tm") else 40
    lon, lat = p.lon0 + r.uniform(-reach, reach, 40), (-1 if kind == "polar" else 1) * r.uniform(15, 80, 40)
    x, y = p.to_grid(lon, lat)
    df = spark.createDataFrame([tuple(map(float, t)) for t in zip(lon, lat, x, y, strict=True)], "lon double, lat double, x double, y double")
    there = p.to_grid(F.col("lon"), F.col("lat"))
    if wkt:
        df = df.withColumn("back", lon_lat(F.col("x"), F.col("y"), wkt))
    else:
        a, b = p.to_degrees(F.col("x"), F.col("y"))
        df = df.withColumn("back", F.struct(a.alias("longitude"), b.alias("latitude")))
    found = df.select(there[0].alias("px"), there[1].alias("py"), "x", "y", "back", "lon", "lat")
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    got = found.collect()
    assert np.allclose([(g.px, g.py) for g in got], [(g.x, g.y) for g in got], rtol=1e-12, atol=1e-5)
    want = p.to_degrees(x, y)
    assert np.allclose([((g.back.longitude - w + 180) % 360 - 180, g.back.latitude) for g, w in zip(got, want[0], strict=True)], [(0, w) for w in want[1]], atol=1e-10)


@pytest.mark.parametrize("order", range(6))
def test_splines(order):
    r = np.random.default_rng(order)
    image = r.random((12, 9))
    same = geo.resample(image, np.eye(2), np.zeros(2), (12, 9), order)
    assert np.allclose(same, image, atol=1e-9)
    half = geo.resample(image, np.eye(2) * 2, np.zeros(2), (6, 4), order)
    assert np.allclose(half, image[::2, :8:2], atol=1e-9)
    flat = geo.resample(np.full((8, 8), 3.0), np.eye(2), np.array([0.3, 0.6]), (7, 7), order)
    assert np.allclose(flat, 3.0)
    if order == 1:
        assert np.isclose(geo.resample(image, np.eye(2), np.array([0.5, 0.25]), (1, 1), 1)[0, 0], (image[:2, :2] * [[0.375, 0.125], [0.375, 0.125]]).sum())
    out = geo.resample(image, np.eye(2), np.array([-1.0, 0.0]), (3, 3), order)
    assert (out[0] == 0).all()


def scene(name, time, value, lon=94.0, lat=41.0, step=0.01, n=40, bands=("B016", "B023", "B029")):
    r = np.random.default_rng(abs(hash(name)) % 1000)
    c = np.full((n, n, len(bands)), float(value)) + r.random((n, n, len(bands)))
    meta = {"L1T": json.dumps({"PRODUCT_METADATA": {"START_TIME": time, "SENSOR_ID": "HYPERION"}}), "GeoTransform": json.dumps([lon, step, 0, lat, 0, -step]), "Projection": ""}
    s = codec.scene_of(c, list(bands), meta)
    return {"scene_id": name, **s, "data": [{"index": i, "strip": b} for i, b in s["data"]]}


def scene_table(spark, *rows):
    from skyloom.schema import SCENE

    return spark.createDataFrame(list(rows), f"scene_id string, {SCENE}")


def test_scene_lands_where_it_belongs():
    s = scene("a", "2012 030 00:00:00", 50)
    found = {(x, y): c for x, y, c in geo.scene_tiles({**s, "data": [(d["index"], d["strip"]) for d in s["data"]]}, depth=10, width=64, height=32, order=1)}
    assert set(found) <= {(x, y) for x in range(1558, 1562) for y in range(1485, 1491)} and found
    for (x, y), c in found.items():
        on = np.argwhere(c[:, :, -1] > 0.5)
        lon, lat = (x + on[:, 1] / 64) * 360 / 2048 - 180, (y + 1 - on[:, 0] / 32) * 180 / 2048 - 90
        assert lon.min() >= 94.0 - 1e-9 and lon.max() <= 94.4 and lat.max() <= 41.0 + 1e-9 and lat.min() >= 40.6
    total = sum((c[:, :, -1] > 0.5).sum() for c in found.values())
    assert abs(total - (0.39 / (360 / 2048 / 64)) * (0.39 / (180 / 2048 / 32))) < 0.05 * total


@pytest.mark.parametrize("order", range(6))
def test_blocks_equal_whole_scenes(spark, order):
    """Tiles by blocks with margins are those of whole scenes, with holes, sections and two scenes at once."""
    made = []
    for k, (lon, lat) in enumerate(((94.0, 41.0), (-33.37, -20.03))):
        s = scene(f"s{k}", "2012 030 00:00:00", 20 + k, lon, lat, n=70 if k else 61)
        cube = codec.cube_of(s)
        r = np.random.default_rng(k)
        cube *= 1 + r.random(cube.shape)
        cube[r.random(cube.shape[:2]) < 0.1] = 0
        cube[20:40, 5:25] = 0
        again = codec.scene_of(cube, s["bands"], s["metadata"])
        made.append({"scene_id": s["scene_id"], **again, "data": [{"index": i, "strip": b} for i, b in again["data"]]})
    table = scene_table(spark, *made)
    how = {"depth": 9, "width": 48, "height": 32, "order": order, "n_sections": 2 if order in (1, 3) else 1, "mask_bands": ["B016", "B023"]}
    key = ["scene_id", "x", "y", "row", "col", "mask"]
    want = sorted((*(r[c] for c in key), tuple(r["v"])) for r in geo.tile_scenes(table, **how).collect())
    got = sorted((*(r[c] for c in key), tuple(r["v"])) for r in geo.tile_blocks(geo.strips_of(table, 500), **how, block=16).collect())
    assert len(got) == len(want) > 300 and [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([[g[5], *g[6]] for g in got], [[w[5], *w[6]] for w in want], rtol=0, atol=1e-9)


def test_tiles_end_to_end(spark, tmp_path):
    old, new = scene("old", "2012 030 00:00:00", 20), scene("new", "2012 031 00:00:00", 80, lon=94.2)
    table = scene_table(spark, old, new)
    out = pipelines.scenes_to_tiles(table, ["B016", "B023", "B029"], [LayerSpec("RGB", ("B029", "B023", "B016"), "RGB", 0.0, 100.0)], str(tmp_path / "t"), depth=6, top=4, order=1)
    rows = {(r.depth, r.x, r.y): bytes(r.l2png) for r in out.collect()}
    assert {d for d, _, _ in rows} == {4, 5, 6}
    image = codec.unpng(rows[max(rows)])
    assert image[..., 3].max() == 255 and 40 < image[image[..., 3] > 0][:, 0].mean() < 215
    key = next(r.row_key for r in out.collect() if r.depth == 6)
    assert store.tile_image(spark, str(tmp_path / "t"), key)[:4] == b"\x89PNG"
    assert store.get_tile_metadata(spark, str(tmp_path / "t"), key).first().metadata == "{}"
    with pytest.raises(OSError):
        store.tile_image(spark, str(tmp_path / "t"), "T06-00000-00000-RGB")


def test_bright_spots_end_to_end(spark, tmp_path):
    s = scene("a", "2012 030 00:00:00", 10, n=20)
    out = pipelines.bright_spots(scene_table(spark, s), ["B016", "B023", "B029"], "B016", "90%", str(tmp_path / "p"), k=3)
    rows = out.collect()
    assert len(rows) == 3 and all(94.0 <= r.longitude <= 94.2 and r.ts == 1327881600 for r in rows)
    assert sum(json.loads(r.metadata)["num pixels"] for r in rows) == 40


# ---- points ------------------------------------------------------------------------------------------


def test_store(spark, tmp_path):
    r = np.random.default_rng(12345)
    pts = [(float(a), float(b), 1000 + i, json.dumps({"significance": float(u)})) for i, (a, b, u) in enumerate(zip(r.normal(94.312, 0.1, 100), r.normal(40.183, 0.1, 100), r.random(100), strict=True))]
    rows = store.point_rows(spark.createDataFrame(pts, "longitude double, latitude double, ts bigint, metadata string"))
    path = str(tmp_path / "points")
    store.write_points(rows, path)
    store.write_points(rows.limit(10), path)  # an upsert
    back = store.read_points(spark, path)
    assert back.count() == 100
    tile = "T10-01561-01481"
    inside = [r for r in back.collect() if r.tile == tile]
    assert store.scan_tile_time(back, tile).count() == len(inside) > 0
    t = sorted(r.ts for r in inside)[-1]
    assert store.scan_tile_time(back, tile, 0, t).count() == len(inside) - 1  # the upper time is exclusive
    assert store.scan_tile_time(back, tile, 5, 1).count() == 0
    assert store.scan_box(back, 1561, 1561, 1481, 1481, 0, t).count() == len(inside)  # here it is not
    assert store.delete_range(back, tile, 5, 1).count() == 100
    doc = [json.loads(r.json) for r in store.points_json(back).collect()]
    assert {d["time"] for d in doc} >= {"0000001000"} and all("significance" in d["metadata"] for d in doc)
    coarse = points.first_per_coarse_tile(back, 3).collect()
    assert len(coarse) == 1 and coarse[0].row_key == min(r.row_key for r in back.collect())
    assert points.first_per_coarse_tile(back, 10).count() == 100
    srt = points.sorted_table(back, "significance", numeric=True, descending=True).select(F.get_json_object("metadata", "$.significance").cast("double")).collect()
    assert [r[0] for r in srt] == sorted((r[0] for r in srt), reverse=True)
    plan = store.scan_box(store.read_points(spark, path), 1, 2, 3, 4, 5, 6)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(x), IsNotNull(y), IsNotNull(ts), GreaterThanOrEqual(x,1)" in plan
    store.rewrite(spark, store.delete_range(back, tile), path)
    assert store.read_points(spark, path).count() == 100 - len(inside)
    store.drop_points(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_kmeans_beats_one_centre(spark):
    r = np.random.default_rng(3)
    rows = [(float(a), float(b), 5, float(w)) for c in ((0, 0), (10, 10), (-20, 5)) for a, b, w in zip(r.normal(c[0], 0.3, 40), r.normal(c[1], 0.3, 40), r.uniform(1, 2, 40), strict=True)]
    df = spark.createDataFrame([*rows, (None, 1.0, 5, 1.0)], "longitude double, latitude double, ts bigint, intensity double")
    found = points.centres(points.kmeans(df, k=3, trials=4))
    stats = points.cluster_statistics(points.assign(df.na.drop(), found)).collect()
    assert sum(s.num_pixels for s in stats) == 120 and all(s.rms_distance < 1 for s in stats)


def test_kmeans_seeds_follow_weights(spark):
    """Draws without repeats, in proportion to weight, whatever the order of rows and however often a place occurs."""
    rows = [(float(i), 0.0, 1.0 if i else 3.0) for i in range(10)]  # weights 9 and nine times 1
    df = spark.createDataFrame(rows, "longitude double, latitude double, intensity double")
    found = points.seeds(points.weighted(df), 2, 2000, seed=5)
    assert all(len({tuple(c) for c in t}) == 2 for t in found)
    first = np.mean(found[:, 0, 0] == 0)
    assert 0.46 < first < 0.54
    again = points.seeds(points.weighted(df.orderBy(F.desc("longitude")).repartition(3)), 2, 2000, seed=5)
    assert np.array_equal(found, again)
    few = points.seeds(points.weighted(spark.createDataFrame([(1.0, 2.0, 1.0)] * 50, df.schema)), 3, 2)
    assert np.array_equal(few, np.broadcast_to([1.0, 2.0], (2, 3, 2)))


def test_kmeans_is_no_worse_than_the_librarys(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    r = np.random.default_rng(9)
    at = np.concatenate([r.normal(c, 1.5, (60, 2)) for c in r.uniform(-60, 60, (7, 2))])
    df = spark.createDataFrame([(float(x), float(y), float(w)) for (x, y), w in zip(at, r.uniform(0.5, 2, len(at)), strict=True)], "longitude double, latitude double, intensity double")
    model = points.kmeans(df, k=7)
    rows = df.select(array_to_vector(F.array("longitude", "latitude")).alias("features"), (F.col("intensity") * F.col("intensity")).alias("w"))
    library = min(KMeans(k=7, weightCol="w", seed=s, tol=1e-5, maxIter=50).fit(rows).summary.trainingCost for s in range(3))
    assert model.cost <= library * 1.001
    w = points.weighted(df).toPandas()
    d = ((w[["x", "y"]].to_numpy()[:, None] - model.centres) ** 2).sum(2).min(1)
    assert model.cost == pytest.approx(float((d * w["w"]).sum()))


# ---- classification --------------------------------------------------------------------------------


def blobs(spark, n=60):
    r = np.random.default_rng(8)
    rows = [([float(x) for x in r.normal(m, 1.0, 3)], c) for c, m in ((1, 0), (2, 8), (3, 16), (4, 24)) for _ in range(n)]
    return spark.createDataFrame(rows, "features array<double>, class int")


@pytest.mark.parametrize("kind", ["bayes", "tree", "linear_svm", "rbf_svm"])
def test_classifiers(spark, kind):
    rows = blobs(spark)
    model = classify.fit(rows, kind)
    got = classify.predict(rows.withColumnRenamed("class", "truth"), model)
    right = got.where("truth = class").count() / 240
    assert right > (0.9 if kind != "linear_svm" else 0.6)  # one line against all can't part middle classes


def test_bayes_closed_form(spark):
    rows = blobs(spark)
    got = classify.bayes_scores(rows.withColumnRenamed("class", "truth"), classify.bayes_table(rows, 3))
    assert got.where("truth = class").count() > 230


def test_posteriors_far_from_all_classes(spark):
    """Where every density is too small to hold, probabilities still add up; no class above one half gives 0."""
    training = spark.createDataFrame([(k, [float(k * 10 + i), float(i % 3)]) for k in (1, 2, 3) for i in range(9)], "class int, features array<double>")
    table = classify.bayes_table(training, 2, sample=True, smoothing=0.0)
    rows = spark.createDataFrame([(0, [1e4, 1.0]), (1, [14.0, 1.0]), (2, [19.0, 1.0])], "id int, features array<double>")
    got = {r.id: r for r in classify.bayes_posteriors(rows, table).collect()}
    assert all(abs(sum(r.posteriors) - 1) < 1e-12 for r in got.values())
    assert got[0].rounded == 3 and got[1].rounded == 1 and got[2].rounded == 0 and got[2].posteriors[0] == pytest.approx(0.5)


def test_ranks_of_many_classes(spark):
    rows = spark.createDataFrame([(3 * (i % 20),) for i in range(100)], "class int")
    few = sorted(r["rank"] for r in classify.predicted_rank(rows).collect())
    assert few == sorted(r["rank"] for r in classify.predicted_rank(rows, literals=5).collect()) == sorted(i % 20 + 1 for i in range(100))


def test_pairs_of_classes(spark):
    """Planes are where the objective's gradient is zero, found in one pass for all pairs; votes pick the class."""
    r = np.random.default_rng(7)
    at = {1: (0, 0, 5), 2: (4, 0, 0), 3: (0, 5, 0)}
    rows = [(k, [float(v) for v in r.normal(c, 1.3) * (1, 10, 1)]) for k, c in at.items() for _ in range(50)]
    df = spark.createDataFrame([*rows, (None, [1.0, 1.0, 1.0])], "class int, features array<double>")
    machines = classify.fit_pairs(df.repartition(3), cost=10.0)
    x, y = np.array([v for _, v in rows]), np.array([k for k, _ in rows])
    z = (x - x.mean(0)) / x.std(0)
    assert [(a, b) for a, b, _, _ in machines.planes] == [(1, 2), (1, 3), (2, 3)] and machines.classes == (1, 2, 3)
    for a, b, w, bias in machines.planes:
        on = (y == a) | (y == b)
        side = np.where(y[on] == a, 1.0, -1.0)
        plane = np.array(w) * x.std(0)
        free = bias + np.array(w) @ x.mean(0)
        lack = np.maximum(1 - side * (z[on] @ plane + free), 0)
        gradient = plane - 2 * 10.0 / on.sum() * ((lack * side) @ z[on])
        assert np.abs(gradient).max() < 1e-6 and abs((lack * side).sum()) < 1e-5
    found = classify.vote(df.where("class IS NOT NULL").withColumnRenamed("class", "truth"), machines)
    assert found.where("class = truth").count() > 140
    tied = classify.PairMachines((1, 2, 3), ((1, 2, (1.0,), 0.0), (1, 3, (-1.0,), 0.0), (2, 3, (1.0,), 0.0)))
    assert classify.vote(spark.createDataFrame([([2.0],)], "features array<double>"), tied).first()["class"] == 1


def test_smo_converges_or_says_so():
    r = np.random.default_rng(2)
    x, y = r.normal(size=(60, 2)), np.where(r.random(60) < 0.5, 1.0, -1.0)
    with pytest.raises(ArithmeticError):
        classify._smo(x, y, 1e4, 1.0, most=5)
    sv, coef, bias = classify._smo(x, y, 10.0, 0.5)
    assert abs(coef.sum()) < 1e-6 and np.abs(coef).max() <= 10 + 1e-9 and len(sv) and np.isfinite(bias)


def test_balance_and_rasters(spark):
    rows = blobs(spark, 10).unionByName(blobs(spark, 5).where("class = 1"))
    n = {r["class"]: r["count"] for r in classify.balance(rows, F.rand(1), limit=100).groupBy("class").count().collect()}
    assert n == {1: 10, 2: 10, 3: 10, 4: 10}
    n = {r["class"]: r["count"] for r in classify.balance(rows, F.rand(1), first_class_only=True).groupBy("class").count().collect()}
    assert n == {1: 15, 2: 10, 3: 10, 4: 10}
    cls = spark.createDataFrame([(1,), (3,), (4,)], "class int")
    three = {r["class"]: (r.clouds, r.land, r.water) for r in classify.raster_three(cls).collect()}
    assert three == {1: (1.0, 0.0, 0.0), 3: (0.0, 2 / 3, 0.0), 4: (0.0, 0.0, 0.75)}
    fixed = {r["class"]: (r.clouds, r.land, r.water) for r in classify.raster_three(cls, True).collect()}
    assert fixed == {1: (1.0, 0.0, 0.0), 3: (0.0, 0.0, 1.0), 4: (0.0, 0.5, 0.0)}
    assert {r["class"]: (r.cloud, r.land, r.water, r.forest) for r in classify.raster_four(cls).collect()} == {1: (1, 0, 0, 0), 3: (0, 1, 0, 0), 4: (0, 0, 1, 0)}


# ---- change, catalogue, exploring ----------------------------------------------------------------------


def image(spark, c, name="v"):
    h, w, _ = c.shape
    return spark.createDataFrame([(i, j, [float(x) for x in c[i, j]]) for i in range(h) for j in range(w)], f"row int, col int, {name} array<double>")


def test_change_detection(spark):
    r = np.random.default_rng(4)
    a = r.random((8, 9, 4)) + 1
    b = a.copy()
    b[3, 4] = [2.5, 0.1, 0.1, 0.1]  # no longer than the rest, so no cloud
    at = {"geo": [0.0, 1.0, 0, 0.0, 0, -1.0], "wkt": "", "height": 8, "width": 9}
    names = [f"B{i}" for i in range(4)]
    out = {(x.row, x.col): x.r for x in change.detect(image(spark, a), names, image(spark, b), names, at, at).collect()}
    assert out[3, 4] < 0.9 and np.isclose(out[2, 2], 1.0)


def test_outline_and_overlap(spark):
    alpha = np.zeros((7, 7), bool)
    alpha[1:6, 1:6] = True
    df = spark.createDataFrame([(1, i, j, bool(alpha[i, j])) for i in range(7) for j in range(7)], "scene_id int, row int, col int, alpha boolean")
    got = {(r.row, r.col): r.outline for r in change.outline(df).collect()}
    for i in range(1, 6):
        for j in range(1, 6):
            n = alpha[i - 1 : i + 2, j - 1 : j + 2].sum()
            assert got[i, j] == (1 if 1 <= n <= 8 else 0)
    assert got[0, 0] == got[6, 3] == 0
    one = spark.createDataFrame([(1, 0.0, 10.0, 0.0, 10.0)], "id int, lat_min double, lat_max double, lon_min double, lon_max double")
    two = spark.createDataFrame([(1, 2.0, 3.0, 2.0, 3.0), (2, -1.0, 11.0, -1.0, 11.0), (3, 10.0, 12.0, 0.0, 1.0), (4, 4.0, 6.0, -5.0, 15.0)], one.schema)
    assert {r.b_id for r in change.overlapping_pairs(one, two).collect()} == {1}
    assert {r.b_id for r in change.overlapping_pairs(one, two, change.bbox_overlap).collect()} == {1, 2, 4}


def test_overlaps_of_any_size(spark):
    """From points to continents: the pairs of brute force, once each, and few rows for each box."""
    r = np.random.default_rng(6)

    def boxes(n, first):
        size = 10 ** r.uniform(-2, 2.2, (n, 2))
        low = np.c_[r.uniform(-90, 80, n), r.uniform(-180, 170, n)]
        size[:3] = 0, 4.0
        rows = [(first + i, float(y), float(min(y + h, 90)), float(x), float(min(x + w, 180))) for i, ((y, x), (h, w)) in enumerate(zip(low, size, strict=True))]
        return [*rows, (first + n, -90.0, 90.0, -180.0, 180.0)]

    one, two = boxes(70, 0), boxes(90, 1000)
    schema = "id int, lat_min double, lat_max double, lon_min double, lon_max double"
    left, right = spark.createDataFrame(one, schema), spark.createDataFrame(two, schema)
    meets = lambda p, q: p[1] < q[2] and q[1] < p[2] and p[3] < q[4] and q[3] < p[4]
    want = sorted((p[0], q[0]) for p in one for q in two if meets(p, q))
    got = sorted((x.a_id, x.b_id) for x in change.overlapping_pairs(left, right, change.bbox_overlap, cell=0.5).collect())
    assert got == want and len(want) > 200
    most = change.box_cells(right, "b", "all", 0.5).groupBy("b_id").count().agg(F.max("count")).first()[0]
    assert most <= 4 * 11


def joins_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_overlap_query_broadcasts_no_table(spark):
    """The whole catalogue's cells meet in a shuffle, however small its files are."""
    from skyloom.queries import QUERIES

    plan = joins_of(QUERIES["bbox_overlap"](spark, "/root/testdata/sf0.001"))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_symmetric_overlap_query_broadcasts_no_table(spark):
    """Nor do boxes of one size go to levels that no box is of."""
    from skyloom.queries import QUERIES

    plan = joins_of(QUERIES["bbox_overlap_symmetric"](spark, "/root/testdata/sf0.001"))
    assert plan.count("SortMergeJoin") == 1 and "Broadcast" not in plan and "Union" not in plan


def test_symmetric_overlap_query_as_it_ran(spark, tmp_path):
    """Orders whose files look small, as they repeat: nothing was broadcast when the plan had run, and no pair is lost."""
    from skyloom.queries import QUERIES

    n = 3000
    spark.sql(f"SELECT id AS o_orderkey, id % 700 AS o_custkey, timestamp'1995-01-01' AS o_orderdate, 1.0D AS o_totalprice FROM range({n})").write.parquet(f"{tmp_path}/orders.parquet")
    df = QUERIES["bbox_overlap_symmetric"](spark, str(tmp_path))
    got = sorted((x.a_id, x.b_id) for x in df.collect())
    la, oa = np.arange(n) % 700 * 5 % 160, np.arange(n) % 700 * 13 % 340
    want = [(a, int(b)) for a in range(0, n, 100) for b in np.flatnonzero((abs(la - la[a]) < 2.5) & (abs(oa - oa[a]) < 2.5))]
    assert got == want and len(want) > 100
    plan = joins_of(df)
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_catalogue(spark):
    hyp = spark.createDataFrame([("Hyperion", "h", 10, 5.0, [[0.0, 0.0], [2.0, 2.0]])], "sensor string, directory string, acquisition_start long, radiance double, corners array<array<double>>")
    ali = spark.createDataFrame([("ALI", "a", 20, 1.5, None, [[10.0, 0.0], [12.0, 2.0]])], "sensor string, directory string, acquisition_start long, radiance_B02 double, radiance_B03 double, corners array<array<double>>")
    u = catalog.with_centre(catalog.union(hyp, ali))
    assert {r.directory: r.radiance for r in u.collect()} == {"h": 5.0, "a": 1.5}
    assert catalog.select(u, centre=(1.0, 1.0), radius=10.0).count() == 1 and catalog.select(u, centre=(1.0, 1.0), radius=0).count() == 2
    assert catalog.select(u, time=(20, 20)).count() == 1
    assert tuple(catalog.extent(u).first()) == (0.0, 5.0, 10, 20)


def test_explore(spark):
    c = np.random.default_rng(6).random((6, 6, 3))
    c[1, 1, 0] = 0
    px = image(spark, c)
    names = ["B1", "B2", "B3"]
    got = explore.crop(px, -5, -5, 99, 99, 6, 6)
    assert got.count() == 25
    s = {r.band: r.value for r in explore.spectrum(got, names).collect()}
    assert np.isclose(s["B2"], c[:5, :5, 1].mean())
    assert explore.scatter(got, names, "B1", "B2*2").count() == 24
    rgba = explore.false_colour(got, names, "B1", "B2", "B3")
    png = codec.unpng(explore.image_bytes(rgba, 0, 0, 5, 5))
    assert png[1, 1, 3] == 0 and png[0, 0, 3] == 255
    with pytest.raises(Exception, match="no non-empty"):
        explore.false_colour(got.where("row = 1 and col = 1"), names, "B1", "B2", "B3").collect()
    row = explore.valid_corners(px, F.col("v")[0] > 0).first()
    assert (row.top_row, row.bottom_row, row.left_col, row.right_col) == (0, 5, 0, 5)


def test_registration_between_projections(spark):
    wkt = 'PROJCS["u",GEOGCS["g",DATUM["d",SPHEROID["WGS 84",6378137,298.257223563]]],PROJECTION["Transverse_Mercator"],PARAMETER["latitude_of_origin",0],PARAMETER["central_meridian",15],PARAMETER["scale_factor",0.9996],PARAMETER["false_easting",500000],PARAMETER["false_northing",0]]'
    px = spark.createDataFrame([(0, 0), (5, 7)], "row int, col int")
    x, y = Projection.utm(33).to_grid(np.array([15.0, 15.07]), np.array([45.0, 44.95]))
    got = change.register(px, [float(x[0]), 30.0, 0, float(y[0]), 0, -30.0], wkt, [15.0, 0.01, 0, 45.0, 0, -0.01], "", 10**6, 10**6).orderBy("row").collect()
    assert (got[0].row1, got[0].col1) == (0, 0)
    assert abs(got[1].row1 - round((y[0] - y[1]) / 30)) <= 1 and abs(got[1].col1 - round((x[1] - x[0]) / 30)) <= 1


# ---- images, plans ----------------------------------------------------------------------------------------


def test_png_files(spark, tmp_path):
    from skyloom.sources import images

    px = spark.createDataFrame([(1, 0, y, 0, 0, "L", 9, 8, 7, 255) for y in range(3)], "depth int, x int, y int, row int, col int, layer string, r int, g int, b int, a int")
    made = tiles.images(px)
    images.write_png(made, str(tmp_path / "png"))
    names = sorted(p.name for p in (tmp_path / "png").iterdir())
    assert names == [f"T01-00000-0000{y}-L.png" for y in range(3)]
    assert codec.unpng((tmp_path / "png" / names[0]).read_bytes())[0, 0].tolist() == [9, 8, 7, 255]
    assert tuple(points.view_counts(made, px).first()) == (3, 3, 3)
    files = images.map_bundle(str(tmp_path / "m"), b"x", {"top": (1.0, 2.0), "bottom": (3.0, 0.0)})
    assert "center.txt" in files and (tmp_path / "m" / "center.txt").read_text() == "2.0 1.0\n"
    cls = spark.createDataFrame([(0, 0, 1.0, 0.5, 0.0)], "row int, col int, a double, b double, c double")
    assert codec.unpng(images.preview(cls, ("a", "b", "c"), 1, 2)).tolist() == [[[255, 127, 0], [0, 0, 0]]]


def test_tile_lines(spark):
    rows = spark.createDataFrame([(10, 1, 2, 3, "abc"), (10, 1, 2, 4, None)], "depth int, x int, y int, ts bigint, payload string")
    lines = scenes.tile_lines(rows)
    assert lines.first().value == "T10-00001-00002-0000000003\tabc"
    assert [tuple(r) for r in scenes.read_tiles(lines).collect()] == [(10, 1, 2, 3, "abc")]


def test_classified_scene(spark):
    from skyloom.plans import floods

    names = [f"B{b:03d}" for b in range(9, 34)]
    meta = {"L1T": json.dumps({"PRODUCT_METADATA": {"SENSOR_ID": "HYPERION", "START_TIME": "2012 001 00:00:00"}, "PRODUCT_PARAMETERS": {"SUN_ELEVATION": "90"}})}
    r = np.random.default_rng(2)
    rows = [("s", i, j, 1 + i % 4, [float(x) for x in 40.0 * (1 + i % 4) + r.random(25) + (np.arange(25) * (i % 4))]) for i in range(8) for j in range(10)]
    rows.append(("s", 9, 9, 1, [0.0] * 25))
    px = spark.createDataFrame(rows, "scene_id string, row int, col int, class int, v array<double>")
    table = spark.createDataFrame([("s", meta)], "scene_id string, metadata map<string,string>")
    top = floods.calibrated(px, names, table)
    one = top.where("row = 0 and col = 0").first().v[0]
    assert np.isclose(one, np.pi * 0.9832**2 * rows[0][4][0] / calib.irradiance_rule(9))
    training = floods.training_set(top, names, limit=15)
    assert training.count() == 60
    for output, column in (("one", "FLOOD"), ("three", "water"), ("four", "forest")):
        got = floods.classified(top.withColumnRenamed("class", "truth"), names, training, "tree", output)
        assert column in got.columns and got.count() == 80 and got.where("class = truth").count() >= 78
    a = floods.load_analytic("skyloom.schema:ColumnAnalytic", name="co2", outputs=B.co2_bands, body=B.co2_analytic)
    assert a.bands_out(["B016"]) == ["B016", "CO2"]


def test_rbf_query_takes_any_size(spark, tmp_path):
    """The registered query trains on a balanced set, and predicts every row of a larger table."""
    from skyloom.queries import QUERIES

    n = 20100
    rows = spark.range(n).select(F.col("id").alias("vec_id"), F.when(F.col("id") < 60, F.col("id") % 4).otherwise(0).cast("int").alias("label"))
    rows.withColumn("embedding", F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (F.col("label") + i % 3 + F.rand(1) / 10).cast("float"))).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["rbf_svm"](spark, str(tmp_path))
    assert got.count() == n and got.where("predicted IS NULL").count() == 0


def test_large_machines_end_soon(monkeypatch):
    """Rows that no kernel parts well: few steps are left from the interior point, and they end at the same machine."""
    r = np.random.default_rng(3)
    x = r.normal(size=(2400, 5))
    x[:200] = x[200:400]
    y = np.where(x[:, 0] * x[:, 1] + r.normal(size=len(x)) > 0.2, 1.0, -1.0)
    sv, coef, bias = classify._smo(x, y, 10000.0, 0.001, most=2000)
    assert abs(coef.sum()) < 1e-3 and np.abs(coef).max() <= 10000.0 and len(coef) == len(sv)
    few, sides = x[:500], y[:500]
    slow = classify._smo(few, sides, 100.0, 0.01)
    monkeypatch.setattr(classify, "LARGE", 100)
    fast = classify._smo(few, sides, 100.0, 0.01, most=2000)
    score = lambda m: classify._scores(x, m[0], m[1], 0.01) + m[2]
    assert np.allclose(score(slow), score(fast), atol=0.01)
    monkeypatch.setattr(classify, "RANK", 3)  # no small factor: the long way
    assert np.allclose(score(classify._smo(few, sides, 100.0, 0.01)), score(slow), atol=1e-9)


def test_kmeans_query_runs_the_whole_job(spark, monkeypatch):
    """The registered query leaves the number of trials to the operator's default."""
    from skyloom import queries

    seen = []

    class Stop(Exception):
        pass

    def spy(rows, **options):
        seen.append(options)
        raise Stop

    monkeypatch.setattr(queries.points, "kmeans", spy)
    with pytest.raises(Stop):
        queries.QUERIES["kmeans_weighted"](spark, "/root/testdata/sf0.001")
    assert seen == [{"k": 10}]


def test_kmeans_rounds_take_few_tasks(spark, monkeypatch):
    """Parts are by the number of places, whatever the number of shuffle partitions."""
    parts = []
    lloyd = points.lloyd
    monkeypatch.setattr(points, "lloyd", lambda rows, centres: parts.append(rows.rdd.getNumPartitions()) or lloyd(rows, centres))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        p = spark.range(300).selectExpr("double(id % 20) AS longitude", "double(id) AS latitude", "1.0D + id % 3 AS intensity")
        points.kmeans(p, k=3, trials=2, max_iter=2)
        monkeypatch.setattr(points, "SHARE", 100)
        points.kmeans(p, k=3, trials=2, max_iter=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert set(parts[:2]) == {1} and set(parts[-2:]) == {3}


def test_pixels_close_to_a_rounding_step(spark, tmp_path):
    """Degrees by the SQL's own series, where a longer one rounds to the next step."""
    import duckdb

    from skyloom.queries import ORACLES, QUERIES

    events = [11012, 13035, 13206, 14062, 21066, 22113, 23835, 24357, *range(50)]
    rows = spark.createDataFrame([(i,) for i in events], "event_id long")
    rows = rows.selectExpr("event_id", "1L AS user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props", "timestamp'2024-01-01' AS ts")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(map(tuple, QUERIES["pixel_geographic"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert got == sorted(con.execute(ORACLES["pixel_geographic"]).fetchall())


def test_series_of_degrees():
    """The short series against the long one, over a zone's width, and with an origin off the equator."""
    for p in (Projection.utm(33), Projection.utm(56, south=True), Projection(lon0=9.0, lat0=40.0, scale=0.9999, east=1e5, north=2e5)):
        lon, lat = np.meshgrid(p.lon0 + np.linspace(-3.5, 3.5, 9), np.linspace(-84.0, 84.0, 43))
        at = p.to_degrees_by_series(*p.to_grid(lon, lat))
        assert np.allclose(at[0], lon, rtol=0, atol=1e-7) and np.allclose(at[1], lat, rtol=0, atol=1e-8)


def test_ranks(spark):
    """Values at ranks and percentiles, against sorting, with ties, signs, zeros and infinities."""
    from skyloom.operators import ranks

    r = np.random.default_rng(4)
    groups = {
        1: [float(x) for x in r.normal(size=900) * 10.0 ** r.integers(-8, 8, 900)], 2: [0.0, -0.0, 5.0, 5.0, 5.0, -3.0] * 20, 3: [7.0], 4: [float("inf"), float("-inf"), 1.0, -1.0, 2.5],
        5: [float(x) for x in r.integers(-3, 4, 400)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in [*vs, None]], "g int, v double")
    got = {x.g: x for x in ranks.at_ranks(df, ["g"], "v", {"least": lambda n: n * 0, "mid": lambda n: F.floor(n / 2), "most": lambda n: n - 1}).collect()}
    for g, vs in groups.items():
        s = sorted(vs)
        assert (got[g].least, got[g].mid, got[g].most) == (s[0], s[len(s) // 2], s[-1])
    some = df.where("g <> 4")
    for share in (0.0, 0.05, 0.5, 0.95, 1.0):
        p = {x.g: x.p for x in ranks.percentile(some, ["g"], "v", share, "p").collect()}
        assert all(np.isclose(p[g], np.percentile(groups[g], 100 * share)) for g in p) and len(p) == 4


@pytest.mark.parametrize("block", [128, 5])
def test_windows_over_blocks(spark, monkeypatch, block):
    """Sums over windows are the same whatever the blocks, with holes, and by two scenes at once."""
    monkeypatch.setattr(change, "BLOCK", block)
    r = np.random.default_rng(8)
    cells = {(k, int(i), int(j)): (float(a), float(b)) for k in (0, 1) for i in range(-3, 17) for j in range(0, 23) for a, b in [r.normal(size=2)] if r.random() < 0.8}
    df = spark.createDataFrame([(*at, *v) for at, v in cells.items()], "scene int, row int, col int, g1 double, g2 double")
    got = {(x.scene, x.row, x.col): (x.x2, x.y2, x.xy) for x in change.window_sums(df, 2, ["scene"]).collect()}
    want = {}
    for k, i, j in cells:
        near = [cells[k, a, b] for a in range(i - 2, i + 3) for b in range(j - 2, j + 3) if (k, a, b) in cells]
        want[k, i, j] = (sum(a * a for a, _ in near), sum(b * b for _, b in near), sum(a * b for a, b in near))
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)


@pytest.mark.parametrize("stretch", [1 << 16, 4])
def test_runs_over_stretches(spark, monkeypatch, stretch):
    monkeypatch.setattr(codec, "STRETCH", stretch)
    r = np.random.default_rng(6)
    flat = {s: r.integers(0, 3, 90).astype(float) for s in ("a", "b")} | {"c": np.ones(40), "d": np.zeros(9)}
    df = spark.createDataFrame([(s, i, float(v)) for s, vs in flat.items() for i, v in enumerate(vs)], "scene_id string, index int, value double")
    got = sorted((x.scene_id, x.start, x.length, tuple(x["values"])) for x in codec.zero_runs(df).collect())
    want = []
    for s, vs in flat.items():
        for start, raw in codec.suppress_zeros(vs.reshape(1, 1, -1)):
            run = np.frombuffer(raw)
            want.append((s, start, len(run), tuple(run)))
    assert got == sorted(want)


def test_rewrite_keeps_the_old_table_until_the_new_one_stands(spark, tmp_path):
    path = str(tmp_path / "points")
    rows = spark.createDataFrame([(float(i), 10.0, 1000 + i, "{}") for i in range(5)], "longitude double, latitude double, ts long, metadata string")
    store.write_points(store.point_rows(rows), path)
    kept = store.read_points(spark, path).where("ts >= 1002")
    store.rewrite(spark, kept, path)
    assert sorted(x.ts for x in store.read_points(spark, path).collect()) == [1002, 1003, 1004]
    assert [p.name for p in tmp_path.iterdir()] == ["points"]


def test_tiff_bytes_are_read_back():
    image = np.random.default_rng(2).normal(size=(3, 7))
    back, geo_ = scenes.read_tiff(scenes.tiff_bytes(image, [5.0, 2.0, 0.0, 9.0, 0.0, -3.0]))
    assert np.array_equal(back, image) and geo_ == [5.0, 2.0, 0.0, 9.0, 0.0, -3.0]


def test_fixed_bounds_take_one_pass(spark):
    px = spark.createDataFrame([(1, 0, 0, 2, 3, 1, 5.0, 1.0)], "depth int, x int, y int, row int, col int, scene_id int, B1 double, mask double")
    plan = tiles.layer_pixels(px, LayerSpec("C", ("B1",), "yellow", 0.0, 50.0))._jdf.queryExecution().toString()
    assert "Join" not in plan and "Aggregate" not in plan

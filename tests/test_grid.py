import math

import pytest
from pyspark.sql import functions as F

from skyloom.functions import calib, grid, keys


def indices(spark, places, depth=10, clamp=False):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in places], "lon double, lat double")
    t = grid.tile_index(depth, F.col("lon"), F.col("lat"), clamp)
    return [(r.x, r.y) for r in df.select(t["x"].alias("x"), t["y"].alias("y")).collect()]


def test_worked_example(spark):
    assert indices(spark, [(94.312, 40.183)]) == [(1560, 1481)]


def test_edges(spark):
    n = 2**11
    got = indices(spark, [(180, 90), (-180, -90), (540, 0), (-540, 0), (0, 0), (179.999, 89.999)])
    assert got == [(n, n - 1), (n, 0), (n, n // 2), (n, n // 2), (n // 2, n // 2), (n - 1, n - 1)]
    assert indices(spark, [(180, 0)], clamp=True) == [(n - 1, n // 2)]


def test_wrapping(spark):
    places = [(i * 7.3 - 180, i * 1.7 - 80) for i in range(60)]
    a = indices(spark, places)
    b = indices(spark, [(x + 360, y) for x, y in places])
    assert a == b
    for (x, y), (i, j) in zip(places, a, strict=True):
        turned = x + 180
        while turned <= 0:
            turned += 360
        while turned > 360:
            turned -= 360
        assert (i, j) == (math.floor(turned / 360 * 2048), math.floor((y + 90) / 180 * 2048))


def test_bad_latitude(spark):
    with pytest.raises(Exception, match="latitude out of range"):
        indices(spark, [(0, 90.5)])


def test_names_corners_parents(spark):
    row = spark.range(1).select(
        grid.tile_name(10, F.lit(1560), F.lit(1481)).alias("n"),
        grid.tile_name(10, F.lit(1), F.lit(2), F.lit("RGB")).alias("l"),
        grid.tile_corners(10, F.lit(1560), F.lit(1481)).alias("c"),
        grid.tile_parent(10, F.lit(1561), F.lit(1481)).alias("p"),
        grid.tile_offset(F.lit(1561), F.lit(1480)).alias("o"),
        grid.parse_tile(F.lit("T10-01560-01481-RGB")).alias("t"),
        grid.parse_tile(F.lit("nonsense")).alias("u"),
    ).first()
    assert row.n == "T10-01560-01481" and row.l == "T10-00001-00002-RGB"
    assert row.c.lon_min <= 94.312 < row.c.lon_max and row.c.lat_min <= 40.183 < row.c.lat_max
    assert (row.p.depth, row.p.x, row.p.y) == (9, 780, 740) and (row.o.dx, row.o.dy) == (1, 0)
    assert (row.t.depth, row.t.x, row.t.y) == (10, 1560, 1481) and row.u.x is None


def test_keys(spark):
    row = spark.range(1).select(
        keys.row_key(F.lit("T10-01560-01481"), F.lit(1234567), F.lit("00000000deadbeef")).alias("k"),
        keys.identifier(F.lit(94.3121), F.lit(40.1829)).alias("i"),
        keys.identifier(F.lit(94.3119), F.lit(40.1831)).alias("j"),
        keys.acquisition_time(F.lit("2012 030 01:02:03")).alias("t"),
        keys.acquisition_time(F.lit("soon")).alias("bad"),
        keys.day_of_year(F.lit("2012 366 00:00:00")).alias("d"),
    ).first()
    assert row.k == "T10-01560-01481-0001234567-00000000deadbeef"
    assert len(row.i) == 16 and row.i == row.j
    assert row.t == 1327885323 and row.bad is None and row.d == 366
    p = spark.createDataFrame([(row.k,)], "k string").select(keys.parse_row_key(F.col("k")).alias("p")).first().p
    assert (p.tile, p.ts, p.identifier) == ("T10-01560-01481", 1234567, "00000000deadbeef")


def test_sun_distance(spark):
    days = [1, 8, 15, 182, 365, 366]
    got = [r[0] for r in spark.createDataFrame([(d,) for d in days], "d int").select(calib.sun_distance(F.col("d"))).collect()]
    import numpy as np

    want = np.interp(days, *zip(*calib.SUN_DISTANCE, strict=True))
    assert np.allclose(got, want)


def test_irradiance_rule_is_solar():
    assert 1700 < calib.irradiance_rule(16) < 2100  # about 507 nm
    assert calib.irradiance_rule(200) < 100

"""Deterministic raster-like views of the test tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIXEL_WIDTH = 25
BANDS = [f"B{i:03d}" for i in range(1, 65)]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("user_id").alias("scene_id"),
        F.col("event_type").alias("layer"),
        F.col("value"),
        F.col("props").alias("metadata"),
        F.floor(F.unix_timestamp("ts")).cast("bigint").alias("ts"),
        (F.pmod(F.col("user_id") * 37 + F.col("event_id") * 11, F.lit(360)) - 180 + F.lit(0.5)).cast("double").alias("lon"),
        (F.pmod(F.col("event_id") * 7, F.lit(180)) - 90 + F.lit(0.25)).cast("double").alias("lat"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id",
        F.floor(F.col("vec_id") / PIXEL_WIDTH).cast("int").alias("row"),
        (F.col("vec_id") % PIXEL_WIDTH).cast("int").alias("col"),
        (F.col("label") % 4 + 1).cast("int").alias("class"),
        F.transform("embedding", lambda x: F.greatest(x.cast("double"), F.lit(0.0)) * 100.0).alias("v"),
    )


def signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels that keep negative values."""
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 100.0).alias("v"))


def tile_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.lit(2).alias("depth"),
        F.pmod("l_partkey", F.lit(8)).cast("int").alias("x"),
        F.pmod("l_suppkey", F.lit(4)).cast("int").alias("y"),
        F.col("l_linenumber").cast("int").alias("row"),
        (F.col("l_quantity").cast("int") % 16).alias("col"),
        F.unix_timestamp("l_shipdate").alias("ts"),
        "l_shipdate",
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.col("l_extendedprice").alias("value"),
        F.col("l_discount").alias("mask"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    lon0, lat0 = F.pmod(F.col("o_custkey") * 13, F.lit(340)) - 170, F.pmod(F.col("o_custkey") * 5, F.lit(160)) - 80
    d = lambda c: c.cast("double")
    return o.select(
        F.when(F.col("o_orderkey") % 2 == 0, "Hyperion").otherwise("ALI").alias("sensor"),
        F.col("o_orderkey").alias("directory"),
        F.unix_timestamp("o_orderdate").alias("acquisition_start"),
        F.col("o_totalprice").alias("radiance"),
        d(lon0).alias("lon0"),
        d(lat0).alias("lat0"),
        F.array(F.array(d(lon0), d(lat0)), F.array(d(lon0 + 1), d(lat0)), F.array(d(lon0 + 1), d(lat0 + 1)), F.array(d(lon0), d(lat0 + 1))).alias("corners"),
    )


POINTS_SQL = """fx_points AS (
  SELECT event_id, user_id AS scene_id, event_type AS layer, value, props AS metadata,
    CAST(floor(epoch(ts)) AS BIGINT) AS ts,
    CAST((user_id*37+event_id*11)%360-180 AS DOUBLE)+0.5 AS lon,
    CAST((event_id*7)%180-90 AS DOUBLE)+0.25 AS lat
  FROM events)"""

PIXELS_SQL = f"""fx_pixels AS (
  SELECT vec_id, CAST(vec_id // {PIXEL_WIDTH} AS INTEGER) AS row, CAST(vec_id % {PIXEL_WIDTH} AS INTEGER) AS col,
    CAST(label % 4 + 1 AS INTEGER) AS class,
    list_transform(embedding, lambda x: greatest(CAST(x AS DOUBLE), 0.0) * 100.0) AS v
  FROM embeddings)"""

SIGNED_SQL = """fx_signed AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 100.0) AS v FROM embeddings)"""

TILES_SQL = """fx_tilepix AS (
  SELECT 2 AS depth, CAST(l_partkey % 8 AS INTEGER) AS x, CAST(l_suppkey % 4 AS INTEGER) AS y,
    CAST(l_linenumber AS INTEGER) AS row, CAST(CAST(floor(l_quantity) AS INTEGER) % 16 AS INTEGER) AS col,
    CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ts, l_shipdate, l_orderkey, l_linenumber, l_extendedprice,
    l_extendedprice AS value, l_discount AS mask
  FROM lineitem)"""

CATALOGUE_SQL = """fx_catalog AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'Hyperion' ELSE 'ALI' END AS sensor, o_orderkey AS directory,
    CAST(floor(epoch(o_orderdate)) AS BIGINT) AS acquisition_start, o_totalprice AS radiance,
    CAST((o_custkey*13)%340-170 AS DOUBLE) AS lon0, CAST((o_custkey*5)%160-80 AS DOUBLE) AS lat0
  FROM orders)"""


def x_sql(depth: int, lon: str = "lon") -> str:
    n = 2.0 ** (depth + 1)
    turned = f"({lon} + 180.0)"
    return f"CAST(floor(({turned} - 360.0*(ceil({turned}/360.0)-1))/360.0*{n}) AS INTEGER)"


def y_sql(depth: int, lat: str = "lat") -> str:
    n = 2 ** (depth + 1)
    return f"CAST(least(floor(({lat} + 90.0)/180.0*{n}.0), {n - 1}) AS INTEGER)"


def name_sql(depth: str, x: str, y: str) -> str:
    pad = lambda v, k: f"lpad(CAST({v} AS VARCHAR), {k}, '0')"
    return f"('T' || {pad(depth, 2)} || '-' || {pad(x, 5)} || '-' || {pad(y, 5)})"

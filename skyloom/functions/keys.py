"""Row keys of points, identifiers and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_TIME, LAST_TIME = 0, 9999999999


def identifier(lon: Column, lat: Column, scale: int = 1000) -> Column:
    """16 hex digits of the MD5 of a place rounded to 1 / scale of a degree."""
    whole = lambda c: F.round(c * scale).cast("bigint").cast("string")
    return F.substring(F.md5(F.concat(whole(lon), F.lit(","), whole(lat)).cast("binary")), 1, 16)


def row_key(tile: Column, ts: Column, ident: Column) -> Column:
    return F.concat(tile, F.lit("-"), F.lpad(ts.cast("string"), 10, "0"), F.lit("-"), ident)


def parse_row_key(key: Column) -> Column:
    return F.struct(
        F.substring(key, 1, 15).alias("tile"),
        F.substring(key, 17, 10).try_cast("bigint").alias("ts"),
        F.substring(key, 28, 16).alias("identifier"),
    )


def acquisition_time(text: Column) -> Column:
    """Epoch seconds (UTC) of "year day-of-year hh:mm:ss"; null where it is not one."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit("yyyy DDD HH:mm:ss")))


def day_of_year(text: Column) -> Column:
    return F.dayofyear(F.try_to_timestamp(text, F.lit("yyyy DDD HH:mm:ss")))


def l1t_value(metadata: Column, group: str, key: str) -> Column:
    """A value of the two-level metadata, from the map's JSON text under "L1T"."""
    return F.from_json(metadata["L1T"], "map<string,map<string,string>>")[group][key]


def geo_transform(metadata: Column) -> Column:
    """The six numbers: left, pixel width, its rotation, top, rotation, pixel height."""
    return F.from_json(metadata["GeoTransform"], "array<double>")


def client_time(ts: Column) -> Column:
    return F.date_format(F.timestamp_seconds(ts), "yyyy-MM-dd HH:mm")


def client_month(ts: Column) -> Column:
    return F.date_format(F.timestamp_seconds(ts), "M/yy")

"""The key-ordered store of tile images and points, as Parquet tables.

Points are partitioned by nothing and sorted along a Z-order curve of their tiles, then by time; a
box is cut into few ranges of the curve, so that wide and tall boxes alike prune row groups.  Tiles are
partitioned by layer, depth and blocks of neighbouring tiles; a write replaces single tiles and
rewrites the blocks that they are in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid, keys
from ..staging import materialise, released


def point_rows(points: DataFrame, lon: str = "longitude", lat: str = "latitude", ts: str = "ts", metadata: str | None = "metadata") -> DataFrame:
    """Store rows of points: the key, its parts and typed tile columns."""
    p = points.withColumn("_t", grid.tile_index(grid.DEEPEST, F.col(lon), F.col(lat)))
    tile = grid.tile_name(F.col("_t.depth"), F.col("_t.x"), F.col("_t.y"))
    p = p.withColumn("_tile", tile).withColumn("_id", keys.identifier(F.col(lon), F.col(lat)))
    meta = F.coalesce(F.col(metadata), F.lit("{}")) if metadata else F.lit("{}")
    return p.select(
        keys.row_key(F.col("_tile"), F.col(ts), F.col("_id")).alias("row_key"),
        F.col("_tile").alias("tile"),
        F.col(ts).cast("bigint").alias("ts"),
        F.col("_id").alias("identifier"),
        F.col(lon).cast("double").alias("longitude"),
        F.col(lat).cast("double").alias("latitude"),
        meta.alias("metadata"),
        F.col("_t.x").alias("x"),
        F.col("_t.y").alias("y"),
    )


#: A point's columns that its key determines; `z` is the tile's place on the curve.
KEYED = ("row_key", "tile", "ts", "identifier", "x", "y", "z")


def latest(rows: DataFrame, order: Column | None = None, keys: tuple[str, ...] = ("row_key",)) -> DataFrame:
    """One row for each key, the last by `order` (upserts: the last write wins).  Filters on
    columns among `keys` reach the scan below."""
    names = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*names), order if order is not None else F.struct(*names))
    return rows.groupBy(*keys).agg(best.alias("r")).select(*keys, *(F.col(f"r.{c}").alias(c) for c in names))


def write_points(rows: DataFrame, path: str, partitions: int | None = None) -> None:
    """Appends points, sorted for pruning; readers see each key once by `read_points`."""
    version = F.lit(uuid.uuid4().hex)
    stamped = rows.drop("z").withColumn("z", grid.morton(F.col("x"), F.col("y"))).withColumn("_written", F.struct(F.current_timestamp().alias("at"), version.alias("v")))
    ranged = stamped.repartitionByRange(partitions, "z", "ts") if partitions else stamped.repartitionByRange("z", "ts")
    ranged.sortWithinPartitions("z", "ts").write.mode("append").parquet(path)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """The table's points, each key once.  What a key determines is grouped by, so that predicates
    on tiles and times are pushed to the files."""
    raw = spark.read.parquet(path)
    return latest(raw, F.col("_written"), KEYED).drop("_written").select(*(c for c in raw.columns if c != "_written"))


def scan_tile_time(points: DataFrame, tile: str, start: int = keys.FIRST_TIME, end: int = keys.LAST_TIME, ordered: bool = True) -> DataFrame:
    """Points of a tile in a time range, in key order if `ordered`.  The upper time is exclusive, as keys at
    it sort behind the bare end key; an empty range gives nothing."""
    depth, x, y = int(tile[1:3]), int(tile[4:9]), int(tile[10:15])
    if depth != grid.DEEPEST:
        raise ValueError("points are keyed by tiles of the deepest level")
    found = points.where((F.col("x") == x) & (F.col("y") == y) & (F.col("ts") >= start) & (F.col("ts") < end))
    if "z" in points.columns:
        found = found.where(F.col("z") == grid.morton(x, y))
    return found.orderBy("row_key") if ordered else found


def scan_box(points: DataFrame, x_min: int, x_max: int, y_min: int, y_max: int, start: int = keys.FIRST_TIME, end: int = keys.LAST_TIME, ordered: bool = True) -> DataFrame:
    """Points of a range of tiles and times, bounds included, in key order if `ordered`.  Points read
    from the store are looked up by ranges of the curve, too."""
    p = points.where(F.col("x").between(x_min, x_max) & F.col("y").between(y_min, y_max))
    if "z" in points.columns:
        p = p.where(grid.in_ranges(F.col("z"), grid.morton_ranges(x_min, x_max, y_min, y_max)))
    if (start, end) != (keys.FIRST_TIME, keys.LAST_TIME):
        p = p.where(F.col("ts").between(start, end))
    return p.orderBy("row_key") if ordered else p


def delete_range(points: DataFrame, tile: str, start: int = keys.FIRST_TIME, end: int = keys.LAST_TIME) -> DataFrame:
    """What is left after deleting a tile's points of a time range (see `scan_tile_time`)."""
    if start > end:
        return points
    x, y = int(tile[4:9]), int(tile[10:15])
    return points.where(~((F.col("x") == x) & (F.col("y") == y) & (F.col("ts") >= start) & (F.col("ts") < end)))


def rewrite(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Replaces a points table by `rows`, which may read it: written beside it, then swapped.  The old
    table is only deleted once the new one is in its place; after a crash between, both are beside
    it, the old one under a name that ends in `-old`."""
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    write_points(rows, beside)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    table, new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, beside, f"{beside}-old"))
    if fs.exists(table) and not fs.rename(table, old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(new, table):
        fs.rename(old, table)
        raise OSError(f"cannot move the new table to {path}")
    fs.delete(old, True)


def compact_points(spark: SparkSession, path: str) -> None:
    """Rewrites a points table with each key once, so that reads meet one sorted run of files again."""
    rewrite(spark, read_points(spark, path), path)


def drop_points(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def tile_rows(images: DataFrame) -> DataFrame:
    """Store rows of tile images (depth, x, y, layer, png, and maybe metadata)."""
    meta = F.col("metadata") if "metadata" in images.columns else F.lit("{}")
    return images.select(grid.tile_name(F.col("depth"), F.col("x"), F.col("y"), F.col("layer")).alias("row_key"), meta.alias("metadata"), F.col("png").alias("l2png"), "x", "y", "layer", F.col("depth").cast("int").alias("depth"))


#: Tiles on each side of a block: a folder holds at most the square of it for a layer and depth.
TILE_BLOCK = 4
PARTS = ("layer", "depth", "block")


def tile_block(x: Column, y: Column) -> Column:
    """The name of the block of 2**TILE_BLOCK x 2**TILE_BLOCK tiles that a tile is in."""
    return F.format_string("b%05d_%05d", F.shiftright(x, TILE_BLOCK).cast("int"), F.shiftright(y, TILE_BLOCK).cast("int"))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def in_blocks(like: DataFrame, path: str) -> DataFrame | None:
    """The stored rows in the blocks of `like`, a table of the same columns; other blocks' folders aren't
    read.  None where there is no table yet."""
    spark = like.sparkSession
    if not exists(spark, path):
        return None
    stored = spark.read.schema(like.schema).parquet(path)  # names of layers that look like numbers stay names
    return stored.join(like.select(*PARTS).distinct(), list(PARTS), "left_semi").select(*like.columns)


def replace_blocks(rows: DataFrame, path: str) -> None:
    """Writes whole blocks, each as one file, in place of what they held; others stay untouched.  The
    rows may come from the table itself, as files are swapped when all are written."""
    dealt = rows.repartition(*PARTS)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)


def write_tiles(images: DataFrame, path: str) -> None:
    """Upserts tile images (depth, x, y, layer, png, and maybe metadata): a tile of a key that is stored
    replaces it, all other tiles stay.  Only blocks with a written tile are read and rewritten; one
    writer at a time."""
    spark = images.sparkSession
    with released(spark):
        new = materialise(tile_rows(images).withColumn("block", tile_block(F.col("x"), F.col("y"))), "tiles")
        old = in_blocks(new, path)
        keys_ = [*PARTS, "row_key"]
        merged = new if old is None else old.join(new.select(*keys_), keys_, "left_anti").unionByName(new)
        replace_blocks(merged, path)


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """All stored tiles, with the block that each is in."""
    return spark.read.schema("row_key string, metadata string, l2png binary, x int, y int, layer string, depth int, block string").parquet(path)


def tile_at(tiles: DataFrame, key: str) -> DataFrame:
    """Of store rows, the one of a key like Tdd-xxxxx-yyyyy-layer; no row if there is none."""
    depth, layer = int(key[1:3]), key[16:]
    x, y = int(key[4:9]), int(key[10:15])
    found = tiles.where((F.col("layer") == layer) & (F.col("depth") == depth) & (F.col("x") == x) & (F.col("y") == y))
    return found.where(F.col("block") == tile_block(F.lit(x), F.lit(y))) if "block" in tiles.columns else found


def get_tile(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The image row of a key (see `tile_at`) in the table at `path`."""
    return tile_at(read_tiles(spark, path), key)


def get_tile_metadata(spark: SparkSession, path: str, key: str) -> DataFrame:
    return get_tile(spark, path, key).select("row_key", "metadata")


def tile_image(spark: SparkSession, path: str, key: str) -> bytes:
    """A tile's PNG; a missing key is an OSError."""
    row = get_tile(spark, path, key).select("l2png").first()
    if row is None:
        raise OSError(f"no image under {key!r}")
    return bytes(row[0])


def points_json(points: DataFrame) -> DataFrame:
    """Each point as a JSON object (`json`), numbers in full."""
    return points.select(
        "row_key",
        F.concat(
            F.lit('{"tile": "'), F.col("tile"), F.lit('", "time": "'), F.lpad(F.col("ts").cast("string"), 10, "0"), F.lit('", "identifier": "'), F.col("identifier"),
            F.lit('", "longitude": '), F.col("longitude").cast("string"), F.lit(', "latitude": '), F.col("latitude").cast("string"), F.lit(', "metadata": '), F.col("metadata"), F.lit("}"),
        ).alias("json"),
    )

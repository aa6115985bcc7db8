"""The overlay as a stream: late scenes only replace what is older."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import grid
from ..operators import tiles
from ..plans import pipelines
from ..staging import delete, released


def latest_cells(pixels: DataFrame, values: list[str], order: list[str], cell: list[str], mask: str = "mask", threshold: float = 0.5 / 255) -> DataFrame:
    """For use in update or complete mode: of each cell the values of its last valid pixel."""
    last = F.max_by(F.struct(*values), F.struct(*order))
    return pixels.where(F.col(mask) > threshold).groupBy(*cell).agg(last.alias("_v")).select(*cell, *(F.col(f"_v.{v}").alias(v) for v in values))


#: Batches after which a table's parts are laid together.
COMPACTED = 16


def _parts(spark, path: str) -> tuple[int, list[str]]:
    """The number up to which batches lie in one part (-1 if in none), and the folders that make up the table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return -1, []
    names = [f.getPath().getName() for f in fs.listStatus(place) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    number = {n: int(n.partition("=")[2]) for n in names if n.startswith(("batch=", "upto="))}
    base = max((k for n, k in number.items() if n.startswith("upto=")), default=-1)
    return base, [f"{path}/{n}" for n, k in number.items() if (n.startswith("upto=") and k == base) or (n.startswith("batch=") and k > base)]


def into_table(pixels: DataFrame, path: str, checkpoint: str, values: list[str], order: list[str], cell: list[str], mask: str = "mask", threshold: float = 0.5 / 255, compacted: int = COMPACTED) -> StreamingQuery:
    """Keeps a Parquet table of cells up to date: every batch is reduced by itself and written under its
    own number, so a batch that runs again replaces itself; `current` reduces the parts on reading.

    After every `compacted` batches the parts are reduced to one, with a row for each cell, so neither
    the parts nor what a read has to reduce grow with the stream's age.  Until the new part is
    whole the old ones count; afterwards they are deleted."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        base, _ = _parts(spark, path)
        if number <= base:  # run again after it went into the common part
            return
        last = F.max_by(F.struct(*values), F.struct(*order))
        rows = batch.where(F.col(mask) > threshold).groupBy(*cell).agg(last.alias("v"), F.max(F.struct(*order)).alias("o"))
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if (number + 1) % compacted == 0:
            _, parts = _parts(spark, path)
            merged = spark.read.schema(rows.schema).parquet(*parts).groupBy(*cell).agg(F.max_by("v", "o").alias("v"), F.max("o").alias("o"))
            merged.write.mode("overwrite").parquet(f"{path}/upto={number}")
            for old in parts:
                delete(spark, old)

    return pixels.writeStream.option("checkpointLocation", checkpoint).queryName(f"overlay-{uuid.uuid4().hex[:8]}").foreachBatch(put).trigger(availableNow=True).start()


def current(spark, path: str, values: list[str], cell: list[str]) -> DataFrame:
    """The last values of every cell of a table that `into_table` keeps."""
    parts = spark.read.parquet(*_parts(spark, path)[1])
    return parts.groupBy(*cell).agg(F.max_by("v", "o").alias("v")).select(*cell, *(F.col(f"v.{x}").alias(x) for x in values))


def into_tiles(colours: DataFrame, path: str, checkpoint: str, depth: int = grid.DEEPEST, top: int = 1) -> StreamingQuery:
    """Lays a stream of coloured pixels (`tiles.layer_pixels`, with ts) on the tile store at `path`: each batch is
    overlaid by itself and put on or under what is stored, and only tiles that it touches are redrawn, up
    to the level `top`.  Late scenes and batches that run again give what all scenes at once give."""

    def put(batch: DataFrame, number: int) -> None:
        one = tiles.overlay(batch, list(pipelines.KEPT), ["ts", "scene_id"], [*tiles.TILE, *pipelines.CELL, "layer"])
        with released(batch.sparkSession):
            pipelines.add_cells(tiles.pyramid(one, depth, top), path)

    return colours.writeStream.option("checkpointLocation", checkpoint).queryName(f"tiles-{uuid.uuid4().hex[:8]}").foreachBatch(put).trigger(availableNow=True).start()

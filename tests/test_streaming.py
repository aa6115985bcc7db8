from pyspark.sql import functions as F

from skyloom.operators import tiles
from skyloom.streaming import bright, overlay

SCHEMA = "x int, row int, col int, ts timestamp, scene string, value double, mask double"


def source(spark, tmp_path, n=3):
    for k in range(n):
        rows = [(i % 2, i % 3, i % 4, f"2024-01-0{1 + (i * 7 + k) % 9} 00:00:00", f"s{k}", float(i + 100 * k), 1.0 if i % 5 else 0.0) for i in range(40)]
        df = spark.createDataFrame(rows, SCHEMA.replace("ts timestamp", "ts string")).withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))


def test_stream_equals_batch(spark, tmp_path):
    stream, batch = source(spark, tmp_path)
    cell, order = ["x", "row", "col"], ["ts", "scene", "value"]
    want = {tuple(r) for r in tiles.overlay(batch, ["value"], order, cell).collect()}
    q = overlay.into_table(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["value"], order, cell)
    q.awaitTermination()
    assert {tuple(r) for r in overlay.current(spark, str(tmp_path / "out"), ["value"], cell).collect()} == want
    q = overlay.latest_cells(stream, ["value"], order, cell).writeStream.format("memory").queryName("cells").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.table("cells").collect()} == want


def test_parts_are_laid_together(spark, tmp_path):
    """Parts and their rows stay few however many batches come; a batch that runs again changes nothing."""
    import os

    stream, batch = source(spark, tmp_path, n=7)
    cell, order, out = ["x", "row", "col"], ["ts", "scene", "value"], str(tmp_path / "out")
    want = {tuple(r) for r in tiles.overlay(batch, ["value"], order, cell).collect()}
    overlay.into_table(stream, out, str(tmp_path / "ck"), ["value"], order, cell, compacted=3).awaitTermination()
    assert sorted(n for n in os.listdir(out) if "=" in n) == ["batch=6", "upto=5"]
    base = spark.read.parquet(f"{out}/upto=5")
    assert base.count() == base.select(*cell).distinct().count()
    assert {tuple(r) for r in overlay.current(spark, out, ["value"], cell).collect()} == want
    overlay.into_table(stream, out, str(tmp_path / "again"), ["value"], order, cell, compacted=3).awaitTermination()  # all batches anew
    assert {tuple(r) for r in overlay.current(spark, out, ["value"], cell).collect()} == want


def test_a_stream_of_scenes_keeps_the_pyramid(spark, tmp_path):
    """Batches of scenes, late ones and repeated ones among them, give the images of all scenes at once."""
    from skyloom.plans import pipelines
    from skyloom.sources import store

    schema = "depth int, x int, y int, row int, col int, layer string, r int, g int, b int, a int, ts bigint, scene_id string, mask double"

    def scene(name, ts, x):
        return [(4, x, 5, i, j, "L", (i * j + ts) % 256, i % 256, 7, 255, ts, name, 1.0 if (i + j) % 3 else 0.0) for i in range(0, 200, 3) for j in range(0, 300, 7)]

    batches = [scene("b", 20, 3), scene("a", 10, 3) + scene("c", 30, 2), scene("b", 20, 3)]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    overlay.into_tiles(stream, str(tmp_path / "t"), str(tmp_path / "ck"), depth=4, top=3).awaitTermination()
    one = tiles.overlay(spark.read.parquet(str(tmp_path / "in")), list(pipelines.KEPT), ["ts", "scene_id"], [*tiles.TILE, *pipelines.CELL, "layer"])
    pipelines.add_cells(tiles.pyramid(one, 4, 3), str(tmp_path / "whole"))
    images = lambda p: {r.row_key: bytes(r.l2png) for r in store.read_tiles(spark, str(tmp_path / p)).collect()}
    assert images("t") == images("whole") and len(images("t")) == 3


def test_windows(spark, tmp_path):
    stream, batch = source(spark, tmp_path)
    placed = stream.withColumn("lon", F.col("x") * 10.0).withColumn("lat", F.col("row") * 10.0)
    q = bright.tile_activity(placed, "ts").writeStream.format("memory").queryName("activity").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("activity").agg(F.sum("n")).first()[0] == batch.count()

"""Bright spots and the point queries of the map client."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import grid, keys
from ..shipping import in_arrow
from ..sources import store
from ..staging import materialise, released
from . import ranks


def bright(pixels: DataFrame, value: str, threshold: float | str, scene: str = "scene_id") -> DataFrame:
    """Pixels above a number, or above each scene's own percentile given as "p%"."""
    if not (isinstance(threshold, str) and threshold.endswith("%")):
        return pixels.where(F.col(value) > float(threshold))
    cut = ranks.percentile(pixels, [scene], value, float(threshold[:-1]) / 100, "_cut")
    return pixels.join(cut, scene).where(F.col(value) > F.col("_cut")).drop("_cut")


@dataclass(frozen=True)
class Clusters:
    """Centres (longitude, latitude) and their cost, the weighted sum of squared distances."""

    centres: np.ndarray
    cost: float


def weighted(points: DataFrame) -> DataFrame:
    """(x, y, w, h): each place once, with the weight of its points, intensity squared, added up; `h` is
    a hash of the place, which seeds are drawn by."""
    at = [F.col(c).cast("double") for c in ("longitude", "latitude", "intensity")]
    rows = points.select(at[0].alias("x"), at[1].alias("y"), B.super_intensity(at[2]).alias("w")).where("x IS NOT NULL AND y IS NOT NULL AND w > 0")
    return rows.groupBy("x", "y").agg(F.sum("w").alias("w")).withColumn("h", F.xxhash64("x", "y"))


#: Places that a task of a round goes over.
SHARE = 1 << 14


def places(points: DataFrame) -> DataFrame:
    """`weighted` points, kept, in as many parts as their number asks for: a round is over in a moment, and a
    part costs a start of Python, so parts as the shuffle left them would take longer to start than to run."""
    rows = materialise(weighted(points), "places")
    return rows.repartition(max(1, -(-rows.count() // SHARE))).persist(StorageLevel.MEMORY_AND_DISK)


def seeds(rows: DataFrame, k: int, trials: int, seed: int = 1) -> np.ndarray:
    """(trials, k, 2): for each trial k places, drawn without repeats in proportion to weight.

    A place's key in a trial is -log(u) / weight, u being uniform and made of the seed, the trial and
    the place's hash; the k least keys are such a draw.  Every task names its own k of each trial, so
    trials x k rows a task are shuffled.  Where there are fewer than k places, the last are repeated."""
    numbers = np.arange(1, trials + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)

    def apply(batches):
        best: list[list] = [[] for _ in range(trials)]
        for b in batches:
            x, y, w = (np.array(b.column(i)) for i in range(3))
            h = np.array(b.column(3)).astype(np.int64).view(np.uint64)
            for t in range(trials):
                z = h ^ numbers[t]
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # mixes all bits
                    z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
                u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)
                key = -np.log(np.maximum(u, 1e-300)) / w
                least = np.lexsort((y, x, key))[:k]
                best[t] = sorted([*best[t], *zip(key[least], x[least], y[least], strict=True)])[:k]
        found = [(t, *e) for t in range(trials) for e in best[t]]
        yield pa.RecordBatch.from_pydict({n: pa.array([f[i] for f in found], kind) for i, (n, kind) in enumerate((("t", pa.int32()), ("key", pa.float64()), ("x", pa.float64()), ("y", pa.float64())))})

    named = in_arrow(rows.select("x", "y", "w", "h"), apply, "t int, key double, x double, y double")
    ranked = named.withColumn("i", F.row_number().over(Window.partitionBy("t").orderBy("key", "x", "y"))).where(F.col("i") <= k)
    out = np.full((trials, k, 2), np.nan)
    for r in ranked.collect():  # trials x k rows
        out[r["t"], r["i"] - 1] = r["x"], r["y"]
    for t in range(trials):
        n = int((~np.isnan(out[t, :, 0])).sum())
        if not n:
            raise ValueError("no point has a place and a weight")
        out[t, n:] = out[t, n - 1]
    return out


#: Places that a trial draws for each centre.
DRAWN = 32


def spread_out(places: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the places: the first, then each with a chance that grows with its squared distance from those
    taken.  The places were drawn by weight, so here they count alike."""
    taken = [0]
    d = ((places - places[0]) ** 2).sum(1)
    while len(taken) < k:
        i = int(rng.choice(len(places), p=d / d.sum())) if d.sum() > 0 else len(taken) % len(places)
        taken.append(i)
        d = np.minimum(d, ((places - places[i]) ** 2).sum(1))
    return places[taken]


def lloyd(rows: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(means, cost) of one round for all trials' centres (trials, k, 2): the weighted means of the points
    nearest to each (ties to the first; a centre without points stays) and the trials' costs before.

    One pass serves all trials; a task gives one row for each trial and centre."""
    trials, k, _ = centres.shape

    def apply(batches):
        sums = np.zeros((trials, k, 4))  # weight, weight times place, cost
        for b in batches:
            x, y, w = (np.array(b.column(i)) for i in range(3))
            for t in range(trials):
                d = (x[:, None] - centres[t, :, 0]) ** 2 + (y[:, None] - centres[t, :, 1]) ** 2
                near = d.argmin(1)
                cost = d[np.arange(len(x)), near]
                for i, v in enumerate((w, w * x, w * y, w * cost)):
                    sums[t, :, i] += np.bincount(near, v, k)
        t, c = np.divmod(np.arange(trials * k), k)
        flat = sums.reshape(-1, 4)
        yield pa.RecordBatch.from_pydict({"t": pa.array(t, pa.int32()), "c": pa.array(c, pa.int32()), **{n: flat[:, i] for i, n in enumerate(("w", "wx", "wy", "cost"))}})

    found = in_arrow(rows.select("x", "y", "w"), apply, "t int, c int, w double, wx double, wy double, cost double")
    means, cost = centres.copy(), np.zeros(trials)
    for r in found.groupBy("t", "c").agg(*(F.sum(n).alias(n) for n in ("w", "wx", "wy", "cost"))).collect():  # trials x k rows
        cost[r["t"]] += r["cost"]
        if r["w"] > 0:
            means[r["t"], r["c"]] = r["wx"] / r["w"], r["wy"] / r["w"]
    return means, cost


def kmeans(points: DataFrame, k: int = 10, trials: int = 10, tolerance: float = 1e-5, seed: int = 1, max_iter: int = 100) -> Clusters:
    """The best of several weighted k-means runs (weight: intensity squared) on longitude and latitude,
    by cost.  Each starts from places drawn in proportion to weight, of which `spread_out` takes k, and
    ends when no centre moves by more than `tolerance`; all trials share every pass over the points."""
    with released(points.sparkSession):
        rows = places(points)  # every round goes over them
        drawn = seeds(rows, DRAWN * k, trials, seed)
        centres = np.stack([spread_out(d, k, np.random.default_rng([seed, t])) for t, d in enumerate(drawn)])
        moving = np.arange(trials)
        for _ in range(max_iter):
            means, _cost = lloyd(rows, centres[moving])
            moved = np.abs(means - centres[moving]).max((1, 2)) > tolerance
            centres[moving] = means
            moving = moving[moved]
            if not len(moving):
                break
        _, cost = lloyd(rows, centres)
        rows.unpersist()
    best = int(np.argmin(cost))
    return Clusters(centres[best], float(cost[best]))


def centres(model: Clusters) -> list[tuple[str, float, float]]:
    return [(str(i), float(c[0]), float(c[1])) for i, c in enumerate(model.centres)]


def assign(points: DataFrame, centres: list[tuple[str, float, float]]) -> DataFrame:
    """Adds the nearest centre (ties to the first) and the distance to it, in degrees.  Centres
    are a closed list of a few tens, so they are literals: no join, no shuffle."""
    def entry(c: tuple[str, float, float]) -> Column:
        dx, dy = F.col("longitude") - c[1], F.col("latitude") - c[2]
        return F.struct(F.sqrt(dx * dx + dy * dy).alias("distance"), F.lit(c[0]).alias("cluster"))

    best = F.array_min(F.array(*map(entry, centres)))
    return points.withColumn("_n", best).withColumn("cluster", F.col("_n.cluster")).withColumn("distance", F.col("_n.distance")).drop("_n")


def cluster_statistics(assigned: DataFrame) -> DataFrame:
    """Per cluster: pixels, total and greatest squared intensity, last time, and distances."""
    w, d2 = B.super_intensity(F.col("intensity")), F.col("distance") * F.col("distance")
    return assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("num_pixels"),
        F.sum(w).alias("total_intensity"),
        F.max(w).alias("max_intensity"),
        F.max("ts").alias("ts"),
        F.sqrt(F.sum(d2) / F.count(F.lit(1))).alias("rms_distance"),
        F.sqrt(F.try_divide(F.sum(w * d2), F.sum(w))).alias("weighted_rms_distance"),
    )


def cluster_points(stats: DataFrame, centres: list[tuple[str, float, float]]) -> DataFrame:
    """Store rows of clusters, at their centres, with the statistics as metadata."""
    spark = stats.sparkSession
    at = F.broadcast(spark.createDataFrame(centres, "cluster string, longitude double, latitude double"))
    meta = F.to_json(
        F.struct(
            F.col("cluster").alias("PMML id"), F.col("num_pixels").alias("num pixels"), F.col("total_intensity").alias("total intensity"), F.col("max_intensity").alias("max intensity"),
            F.col("rms_distance").alias("RMS distance"), F.col("weighted_rms_distance").alias("weighted RMS distance"),
        )
    )
    return store.point_rows(stats.join(at, "cluster").withColumn("metadata", meta))


def first_per_coarse_tile(points: DataFrame, group_depth: int, start: int = keys.FIRST_TIME, end: int = keys.LAST_TIME) -> DataFrame:
    """After the time filter, the first point by key of every tile at `group_depth` (all points
    at the deepest level), with the coarse tile's name."""
    p = points if (start, end) == (keys.FIRST_TIME, keys.LAST_TIME) else points.where(F.col("ts").between(start, end))
    if group_depth >= grid.DEEPEST:
        return p
    up = grid.DEEPEST - group_depth
    p = p.withColumn("_cx", grid.ancestor(F.col("x"), up)).withColumn("_cy", grid.ancestor(F.col("y"), up))
    names = p.columns
    one = p.groupBy("_cx", "_cy").agg(F.min_by(F.struct(*names), "row_key").alias("r")).select("r.*")
    return one.withColumn("tile", grid.tile_name(group_depth, F.col("_cx"), F.col("_cy"))).drop("_cx", "_cy")


def roll_up(points: DataFrame, depth: int, lon: str = "lon", lat: str = "lat", value: str = "value") -> DataFrame:
    """Counts, sums of squares and maxima per tile of a level."""
    up = grid.DEEPEST - depth
    x, y = grid.tile_x(grid.DEEPEST, F.col(lon)), grid.tile_y(grid.DEEPEST, F.col(lat))
    return points.groupBy(grid.ancestor(x, up).alias("x"), grid.ancestor(y, up).alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value) * F.col(value)).alias("energy"), F.max(value).alias("peak")
    )


def viewport(spark, zoom: int, lon_min: float, lon_max: float, lat_min: float, lat_max: float, layers: list[str], images: DataFrame) -> DataFrame:
    """Every tile and layer of a view with its image, null where there is none.  Only images in
    the view are read; the view's tiles are enumerated, not joined."""
    depth = min(zoom - 2, grid.DEEPEST)
    bounds = grid.index_range(depth, F.lit(lon_min), F.lit(lon_max), F.lit(lat_min), F.lit(lat_max))
    tiles = spark.range(1).select(F.explode(grid.tiles_between(depth, bounds)).alias("t")).select("t.*")
    wanted = tiles.withColumn("layer", F.explode(F.array(*map(F.lit, layers))))
    return wanted.join(images, ["depth", "x", "y", "layer"], "left")


def sorted_table(points: DataFrame, key: str, numeric: bool = False, descending: bool = False) -> DataFrame:
    """The client's table by a field or a metadata key, as numbers or text."""
    col = F.col(key) if key in points.columns else F.get_json_object("metadata", f"$.{key}")
    col = col.try_cast("double") if numeric else col.cast("string")
    return points.orderBy(col.desc() if descending else col.asc(), "row_key")


def metadata_keys(points: DataFrame) -> DataFrame:
    """All keys that occur in points' metadata."""
    return points.select(F.explode(F.json_object_keys("metadata")).alias("key")).distinct()


def view_counts(images: DataFrame, points: DataFrame) -> DataFrame:
    """What a view holds: tiles, tiles with an image, and points."""
    a = images.agg(F.count(F.lit(1)).alias("tiles"), F.count("png").alias("images")).withColumn("_k", F.lit(1))
    b = points.agg(F.count(F.lit(1)).alias("points")).withColumn("_k", F.lit(1))
    return a.join(b, "_k").drop("_k")  # one row each

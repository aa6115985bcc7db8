"""Change between two scenes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions.projection import Projection
from ..shipping import ship
from ..staging import materialise


def cloud_filter(pixels: DataFrame, value: str = "v", group: list[str] | None = None) -> DataFrame:
    """Rows whose squared length is at most the mean plus one (population) standard deviation of
    all.  The two moments are one small aggregate joined back, so no window gathers a scene."""
    s = B.dot(F.col(value), F.col(value))
    rows = pixels.withColumn("_s", s)
    keys = group or ["_k"]
    rows = rows if group else rows.withColumn("_k", F.lit(1))
    cut = rows.groupBy(*keys).agg((F.avg("_s") + F.stddev_pop("_s")).alias("_cut"))
    return rows.join(F.broadcast(cut) if not group else cut, keys).where(F.col("_s") <= F.col("_cut")).select(*pixels.columns)


def outline(pixels: DataFrame, alpha: str = "alpha", keys: tuple[str, ...] = ("scene_id",)) -> DataFrame:
    """Adds `outline`: 1 where 1 to 8 of a pixel and its eight neighbours are valid; pixels at the
    edge of the image are 0.  Missing pixels count as invalid."""
    k = list(keys)
    on = pixels.withColumn("g1", F.coalesce(F.col(alpha), F.lit(False)).cast("double")).withColumn("g2", F.lit(0.0))
    counted = window_sums(on, 1, k, {"_n": ("g1", "g1")}).drop("g1", "g2")
    edges = pixels.groupBy(*k).agg(F.min("row").alias("_r0"), F.max("row").alias("_r1"), F.min("col").alias("_c0"), F.max("col").alias("_c1"))
    joined = counted.join(edges, k)
    inner = (F.col("row") > F.col("_r0")) & (F.col("row") < F.col("_r1")) & (F.col("col") > F.col("_c0")) & (F.col("col") < F.col("_c1"))
    return joined.select(*pixels.columns, F.when(inner & F.col("_n").between(1, 8), 1).otherwise(0).alias("outline"))


def corner_overlap(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether a corner of box b lies in box a (keys lat_min, lat_max, lon_min, lon_max); misses
    boxes that cross, and a inside b."""
    low = lambda k: (a[f"{k}_min"] <= b[f"{k}_min"]) & (b[f"{k}_min"] < a[f"{k}_max"])
    high = lambda k: (a[f"{k}_min"] < b[f"{k}_max"]) & (b[f"{k}_max"] <= a[f"{k}_max"])
    return (low("lat") | high("lat")) & (low("lon") | high("lon"))


def bbox_overlap(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether two boxes have common inner points."""
    one = lambda k: (a[f"{k}_min"] < b[f"{k}_max"]) & (b[f"{k}_min"] < a[f"{k}_max"])
    return one("lat") & one("lon")


SIDES = ("lat_min", "lat_max", "lon_min", "lon_max")


def own_level(cell: float) -> Column:
    """The first level whose cells are as wide as a box; cells of level n are `cell` x 2**n degrees wide."""
    extent = F.greatest(F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min"), F.lit(0.0))
    return F.least(F.greatest(F.ceil(F.log2(F.greatest(extent / cell, F.lit(1.0)))), F.lit(0)), F.lit(_top(cell))).cast("int")


def _top(cell: float) -> int:
    """The level of cells as wide as the globe."""
    return max(0, math.ceil(math.log2(360.0 / cell)))


def box_cells(boxes: DataFrame, p: str, which: str, cell: float, among: list[int] | None = None) -> DataFrame:
    """Boxes (id and SIDES, renamed with the prefix `p`) once for each grid cell that they meet: (level, cy, cx).

    At its own level a box meets four cells at most; `which` is "own", "all" (its own and every coarser
    one) or "above" (those alone), up to cells as wide as the globe: a few dozen rows for a box of any size.
    Of coarser levels only those `among` the given are taken."""
    top, own = _top(cell), own_level(cell)
    first = own + 1 if which == "above" else own
    levels = F.when(first <= top, F.sequence(first, own if which == "own" else F.lit(top))).otherwise(F.array().cast("array<int>"))
    if among is not None:
        levels = F.array_intersect(levels, F.array(*map(F.lit, among)).cast("array<int>"))
    d = boxes.select(F.col("id").alias(f"{p}_id"), *(F.col(s).alias(f"{p}_{s}") for s in SIDES), F.explode(levels).alias("level"))
    side = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("level"))
    span = lambda axis: F.explode(F.sequence(F.floor(F.col(f"{p}_{axis}_min") / side), F.floor(F.col(f"{p}_{axis}_max") / side)))
    return d.withColumn("cy", span("lat")).withColumn("cx", span("lon"))


def overlapping_pairs(left: DataFrame, right: DataFrame, exact=corner_overlap, cell: float = 1.0) -> DataFrame:
    """Pairs of scenes (id, lat_min, ...) of any sizes that overlap by `exact`.

    Boxes meet in grid cells, by equi-joins, at the own level of the larger of the two; there a pair is
    reported from the cell of its common part's corner alone.  No box is compared with all others,
    and a continental one takes no more cells than a small one.  Boxes go only to levels that are own to
    some box of the other side, and neither side is broadcast: files say little of how many cells there are."""
    left_levels, right_levels = (sorted(r[0] for r in side.select(own_level(cell).alias("n")).where("n IS NOT NULL").distinct().collect()) for side in (left, right))  # a dozen at most
    a, b = ({s: F.col(f"{p}_{s}") for s in SIDES} for p in ("a", "b"))
    side = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("level"))
    corner = lambda axis: F.floor(F.greatest(a[f"{axis}_min"], b[f"{axis}_min"]) / side)
    first = (F.col("cy") == corner("lat")) & (F.col("cx") == corner("lon"))

    def met(of_left: str, of_right: str, levels: list[int]) -> DataFrame:
        both = box_cells(left, "a", of_left, cell, levels).join(box_cells(right, "b", of_right, cell, levels).hint("merge"), ["level", "cy", "cx"])
        return both.where(first & exact(a, b)).select("a_id", "b_id")

    # the right box is the larger, or as large; then the left one, where some left box is larger than some right one
    pairs = met("all", "own", right_levels)
    larger = [n for n in left_levels if right_levels and n > right_levels[0]]
    return pairs.unionByName(met("own", "above", larger)) if larger else pairs


#: Rows and columns of a block of pixels whose windows one task sums up.
BLOCK = 128


#: Sums over windows of two grey levels: squares of each and their products.
PRODUCTS = {"x2": ("g1", "g1"), "y2": ("g2", "g2"), "xy": ("g1", "g2")}


def window_sums(both: DataFrame, reach: int, keys: list[str], products: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Adds to pixels (keys, row, col, g1, g2, ...) sums over the pixels within `reach` rows and
    columns, by default x2, y2 and xy of g1 g1, g2 g2 and g1 g2.  A place must have one pixel.

    Pixels go to their block, and those near its edge to its neighbours too; a block is summed as an
    array of fixed size, so pixels move once, not once for each window that they are in."""
    products = products or PRODUCTS
    at = lambda c: F.sequence(F.floor((F.col(c) - reach) / BLOCK), F.floor((F.col(c) + reach) / BLOCK))
    dealt = both.withColumn("_by", F.explode(at("row"))).withColumn("_bx", F.explode(at("col")))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in both.schema.fields), *(f"`{name}` double" for name in products)])

    def box(a: np.ndarray) -> np.ndarray:
        """Sums over squares; `a` has a margin of `reach`."""
        for _ in range(2):  # along one axis, then along the other
            a = sum(a[i : len(a) - 2 * reach + i] for i in range(2 * reach + 1)).T
        return a

    def summed(table: pa.Table) -> pa.Table:
        row, col = (np.array(table.column(c)) for c in ("row", "col"))
        y, x = (np.array(table.column(c)[:1])[0] * BLOCK for c in ("_by", "_bx"))
        planes = {}
        for name in {n for pair in products.values() for n in pair}:
            planes[name] = np.zeros((BLOCK + 2 * reach, BLOCK + 2 * reach))
            planes[name][row - y + reach, col - x + reach] = np.nan_to_num(np.array(table.column(name), float))
        mine = np.flatnonzero((row >= y) & (row < y + BLOCK) & (col >= x) & (col < x + BLOCK))
        out = {c: table.column(c).take(pa.array(mine)) for c in both_columns}
        for name, (a, b) in products.items():
            out[name] = pa.array(box(planes[a] * planes[b])[row[mine] - y, col[mine] - x])
        return pa.table(out)

    both_columns = both.columns
    ship(both.sparkSession)
    return dealt.groupBy(*keys, "_by", "_bx").applyInArrow(summed, schema)


def gray_window_score(first: DataFrame, second: DataFrame, window: int = 1, keys: tuple[str, ...] = (), exponent: float = 0.5) -> DataFrame:
    """(keys, row, col, score): a Gaussian of the windows' grey levels.

    Per pixel x2, y2 and xy are dot products of the two windows; the score is
    exp(-exponent (x2 y2 - xy^2) / (sigma^2 (x2 + y2))) / (sqrt(2 pi) sigma)^(window - 1), sigma
    being the deviation of the first scene's grey levels over the common pixels."""
    k = list(keys)
    g1 = first.select(*k, "row", "col", B.gray(F.col("v")).alias("g1"))
    g2 = second.select(*k, "row", "col", B.gray(F.col("v")).alias("g2"))
    # the pair is joined once: two numbers a pixel, which windows and deviation both read
    both = materialise(g1.join(g2, [*k, "row", "col"]), "grey")
    near = window_sums(both, window, k)
    kk = k or ["_k"]
    tagged = both if k else both.withColumn("_k", F.lit(1))
    sigma = tagged.groupBy(*kk).agg(F.stddev_pop("g1").alias("sigma"))
    own = near if k else near.withColumn("_k", F.lit(1))
    s = own.join(F.broadcast(sigma) if not k else sigma, kk)  # without keys, one row
    t1, t2 = F.col("x2") * F.col("y2") - F.col("xy") * F.col("xy"), F.col("sigma") * F.col("sigma") * (F.col("x2") + F.col("y2"))
    score = F.exp(-exponent * F.try_divide(t1, t2)) / F.pow(math.sqrt(2 * math.pi) * F.col("sigma"), F.lit(window - 1))
    return s.select(*k, "row", "col", score.alias("score"))


def register(second: DataFrame, geo1: list[float], wkt1: str, geo2: list[float], wkt2: str, height1: int, width1: int) -> DataFrame:
    """Adds row1 and col1: the first scene's pixel at each of the second's, by inverting the
    first scene's transform; null outside it.  Projections are SQL functions, too."""
    x, y = geo2[0] + geo2[1] * F.col("col"), geo2[3] + geo2[5] * F.col("row")
    if wkt1 == wkt2:
        col, row = (x - geo1[0]) / geo1[1], (y - geo1[3]) / geo1[5]
        out = second.withColumn("row1", F.rint(row).cast("int")).withColumn("col1", F.rint(col).cast("int"))
    else:
        px, py = Projection.parse(wkt1).to_grid(*Projection.parse(wkt2).to_degrees(x, y))
        out = second.withColumn("row1", F.rint((py - geo1[3]) / geo1[5]).cast("int")).withColumn("col1", F.rint((px - geo1[0]) / geo1[1]).cast("int"))
    inside = F.col("row1").between(0, height1 - 1) & F.col("col1").between(0, width1 - 1)
    return out.withColumn("row1", F.when(inside, F.col("row1"))).withColumn("col1", F.when(inside, F.col("col1")))


def detect(first: DataFrame, bands1: list[str], second: DataFrame, bands2: list[str], place1: dict, place2: dict) -> DataFrame:
    """(row, col, r, g, b) in the first scene: 1 less the spectral change score, and 1 on both
    outlines; 0 where there is no common, cloudless pixel.

    Scenes are calibrated pixel tables (row, col, v); places have geo, wkt, height and width."""
    common = [b for b in bands1 if b in bands2]
    if not common:
        raise ValueError("the scenes have no common band")

    def prepared(p: DataFrame, bands: list[str]) -> DataFrame:
        v = F.array(*(F.col("v")[bands.index(b)] for b in common))
        return outline(p.select(F.lit(1).alias("scene_id"), "row", "col", v.alias("v"), B.mask_truthy(F.col("v")).alias("alpha")))

    # each side's outline is drawn once, and the pair is joined once, to four numbers a pixel
    one = materialise(prepared(first, bands1), "first")
    two = register(prepared(second, bands2), place1["geo"], place1["wkt"], place2["geo"], place2["wkt"], place1["height"], place1["width"])
    two = materialise(two.where("row1 IS NOT NULL"), "second")
    # of several pixels of the second scene at one of the first, the first by row and column
    at = two.groupBy(F.col("row1").alias("row"), F.col("col1").alias("col")).agg(
        F.min_by("v", F.when(F.col("alpha"), F.struct("row", "col"))).alias("v2")
    )
    met = one.where("alpha").select("row", "col", F.col("v").alias("v1")).join(at, ["row", "col"])
    change = F.coalesce(B.unit_range(B.change_score(F.col("v1"), F.col("v2"))), F.lit(0.0))
    square = lambda v: B.dot(F.col(v), F.col(v))
    both = materialise(met.where("v2 IS NOT NULL").select("row", "col", square("v1").alias("s1"), square("v2").alias("s2"), change.alias("p")), "common")
    # clouds of the first scene go, then those of the second among what is left
    cut = lambda rows, s: rows.agg(F.avg(s) + F.stddev_pop(s)).first()[0]
    cut1 = cut(both, "s1")
    clear = F.col("s1") <= F.lit(cut1)
    clear &= F.col("s2") <= F.lit(cut(both.where(clear), "s2"))
    scored = both.select("row", "col", F.when(clear, F.col("p")).otherwise(0.0).alias("p"))
    rim2 = two.where("outline = 1").select(F.col("row1").alias("row"), F.col("col1").alias("col"), F.lit(1).alias("rim")).distinct()
    painted = one.select("row", "col", "outline").join(scored, ["row", "col"], "left").join(rim2, ["row", "col"], "left")
    base = F.when(F.col("p").isNull(), 0.0).otherwise(1.0 - F.col("p")) + F.col("outline")
    value = F.when(F.col("rim") == 1, 1.0).otherwise(base)
    return painted.select("row", "col", *(value.alias(c) for c in "rgb"))

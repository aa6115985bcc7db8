"""Exact order statistics of large groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets to each doubling of a value.
FINE = 64
#: Buckets of positive values start here, those of negative ones end at its negative.
ZERO = 1 << 20


def bucket(v: Column) -> Column:
    """A whole number that never falls as a number rises; NaN comes last.  The logarithm is
    Java's, which promises never to fall either."""
    size = lambda x: F.floor(F.least(F.log2(x), F.lit(2000.0)) * FINE)
    return F.when(F.isnan(v), 1 << 30).when(v > 0, size(v) + ZERO).when(v < 0, -(size(-v) + ZERO)).otherwise(0).cast("int")


def at_ranks(values: DataFrame, group: list[str], value: str, ranks: dict[str, Callable[..., Column]], above: float | None = None) -> DataFrame:
    """Per group, for every name of `ranks` the value at that rank, counted from 0, and `_total`, how
    many values there are; null values don't count.  A rank is a function of that total, and with
    `above` also of how many values are greater than it, given as `_above` too.  A rank below 0 or
    not below the total gives null.

    Values are counted by buckets, of which a group has at most a few hundred thousand however large
    it is; then only the buckets that hold a rank are looked into, by counts of distinct values."""
    rows = values.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"))
    rows = rows.withColumn("_b", bucket(F.col("_v")))
    whole, run = Window.partitionBy(*group), Window.partitionBy(*group).orderBy("_b")
    over = [] if above is None else [F.count_if(F.col("_v") > above).alias("_a")]
    counts = rows.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"), *over)
    counts = counts.withColumn("_upto", F.sum("_n").over(run)).withColumn("_total", F.sum("_n").over(whole))
    sizes = ["_total"]
    if above is not None:
        counts, sizes = counts.withColumn("_above", F.sum("_a").over(whole)), ["_total", "_above"]
    sought = F.array(*(F.struct(F.lit(name).alias("name"), at(*map(F.col, sizes)).cast("long").alias("rank")) for name, at in ranks.items()))
    wanted = counts.withColumn("_s", F.explode(sought)).where((F.col("_upto") > F.col("_s.rank")) & (F.col("_upto") - F.col("_n") <= F.col("_s.rank")))
    wanted = wanted.select(*group, "_b", F.col("_s.name").alias("_name"), (F.col("_s.rank") - F.col("_upto") + F.col("_n")).alias("_rank"), *sizes)
    inner = rows.join(wanted, [*group, "_b"]).groupBy(*group, "_name", "_rank", "_v", *sizes).agg(F.count(F.lit(1)).alias("_n"))
    inner = inner.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*group, "_name", "_rank").orderBy("_v")))
    hit = inner.where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_n") <= F.col("_rank")))
    return hit.groupBy(*group).agg(*(F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks), *(F.max(c).alias(c) for c in sizes))


def between(low: Column, high: Column, place: Column) -> Column:
    """The value at a place between two ranks, linear between the values there."""
    return low + (high - low) * (place - F.floor(place))


def percentile(values: DataFrame, group: list[str], value: str, share: float, name: str) -> DataFrame:
    """Per group the percentile at `share` (0 to 1), linear between the two values next to it."""
    place = lambda n: (n - 1) * F.lit(float(share))
    found = at_ranks(values, group, value, {"_lo": lambda n: F.floor(place(n)), "_hi": lambda n: F.ceil(place(n))})
    return found.select(*group, between(F.col("_lo"), F.col("_hi"), place(F.col("_total"))).alias(name))

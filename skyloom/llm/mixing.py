"""Mixing sources by a time-varying curriculum.

Every source has a weight schedule, a line through (time, weight) knots over the run's time from 0
to 1.  Its integral is the source's weight; the mix's words are shared out by these, no source
beyond `most` passes over its documents, and what is above goes to the others by weight.  A
source's documents lie one after another in a shuffled order, pass after pass, along its cumulative
demand of words; the demand's inverse, in closed form between knots, gives each document the time
at which its source has called for the words before it.  A range sort by that time is the order of
training.

Only ids, sizes and hashes are shuffled, never texts.  A source of any size lies in many ranges of
(source, hash), which are summed apart and placed after one another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, let, materialise, take, with_row

WORD = r"[^\x20\x09-\x0D]+"
#: Knots of the schedules that sources take in turn, by code point: the first falls from 7.5 to 2.5
#: (weight 5), the second holds 2, the third rises from 0.5 to 1.5 (weight 1).
SCHEDULES = (((0.0, 7.5), (1.0, 2.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)))


def integrals(knots) -> list[float]:
    """The integral of the line through `knots` from time 0 to each knot."""
    total, out = 0.0, [0.0]
    for (t, a), (u, b) in zip(knots, knots[1:], strict=False):
        total += (a + b) / 2 * (u - t)
        out.append(total)
    return out


def _checked(schedules) -> None:
    for knots in schedules:
        times, weights = zip(*knots, strict=True)
        if times[0] != 0 or times[-1] != 1 or any(a >= b for a, b in zip(times, times[1:], strict=False)) or min(weights) < 0 or integrals(knots)[-1] <= 0:
            raise ValueError("a schedule's times rise from 0 to 1, its weights are not negative and not all zero")


def inverse(y: Column, knots) -> Column:
    """The time by which the integral of the line through `knots` reaches `y`: between two knots, the
    root of a quadratic, in the form that stays exact where the weight hardly changes."""
    sums, found = integrals(knots), None
    for i in reversed(range(len(knots) - 1)):
        (t, a), (u, b) = knots[i], knots[i + 1]
        rest = F.greatest(y - F.lit(sums[i]), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(float(a * a)) + F.lit(2.0 * (b - a) / (u - t)) * rest, F.lit(0.0)))
        step = F.when(rest > 0, 2 * rest / (F.lit(float(a)) + root)).otherwise(F.lit(0.0))
        here = F.least(F.lit(float(t)) + step, F.lit(float(u)))
        found = here if found is None else F.when(y < F.lit(sums[i + 1]), here).otherwise(found)
    return found


def called_at(share: Column, kind: Column, schedules=SCHEDULES) -> Column:
    """The time by which a source of schedule number `kind` has called for `share` (0 to 1) of its words."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        out = F.when(kind == k, let(share * F.lit(integrals(knots)[-1]), lambda y: inverse(y, knots))).otherwise(out)  # noqa: B023  called at once
    return out


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds `rank`, from 0, by source in code-point order, null last: ranges are counted apart, so
    any number of sources may be ranked."""
    # a range's number is settled by writing it
    cut = sources.repartitionByRange(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id())
    cut = materialise(cut, "sources")
    before = F.coalesce(F.sum("k").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = cut.groupBy("part").agg(F.count(F.lit(1)).alias("k")).select("part", before.alias("start"))  # one row a range
    w = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return cut.withColumn("at", F.row_number().over(w)).join(starts, "part").withColumn("rank", F.col("start") + F.col("at") - 1).drop("part", "at", "start")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, schedules=SCHEDULES) -> DataFrame:
    """(source, source_size, kind, target) from rows (source, size).

    The words of the mix are `share` times all sizes.  A source's target is its weight times a
    level, at most `most` times its size; the level rises until the targets add up.  Each round
    settles the sources that the last level fills, so a few sums find it."""
    _checked(schedules)
    if share > most:
        raise ValueError("a mix of more than `most` passes over everything cannot be had")
    weight = F.element_at(F.array(*(F.lit(integrals(k)[-1]) for k in schedules)), (F.col("kind") + 1).cast("int"))
    found = _ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    found = found.withColumn("kind", F.pmod("rank", F.lit(len(schedules))).cast("int"))
    found = materialise(found.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))).drop("rank"), "weights")
    wanted = share * (found.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        capped, n, left = found.agg(F.sum(F.when(over, F.col("cap"))), F.count_if(over), F.sum(F.when(~over, F.col("weight")))).first()
        if n == full or not left:
            break
        level, full = (wanted - (capped or 0)) / left, n
    return found.select("source", "source_size", "kind", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def _running(rows: DataFrame) -> DataFrame:
    """Adds `part`, the range that a row is in, and `start`, the words of its source before it in that
    range.  Rows are dealt by (source, hash); equal rows are parted by `salt`, so none is a hot key."""
    order = [F.col("source").isNull(), "source", "h", "size", "salt"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def apply(batches):
        last, total = None, 0
        for b in batches:
            source, size = b.column("source"), np.array(b.column("size"), np.int64)
            if not len(b):
                continue
            code = np.array(source.dictionary_encode().indices.fill_null(-1))
            new = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            begins = np.cumsum(size) - size
            base = begins[new].copy()
            first = (source[0].as_py(),)  # in a tuple, as a null source is one too
            if first == last:
                base[0] -= total
            starts = begins - np.repeat(base, np.diff(np.r_[new, len(b)]))
            last, total = (source[len(b) - 1].as_py(),), int(starts[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns)), pa.array(starts)], names=[*b.schema.names, "start"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return in_arrow(dealt, apply, f"{schema}, start long")


def _shuffled(seed: int) -> Column:
    """60 bits of the MD5 of seed, id and text, nulls as empty: a document's place in its source."""
    mark = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(mark), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, share: float = 1.5, most: int = 2, schedules=SCHEDULES, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, taken, passes): one row per document.

    `passes` holds (time, words) of each time that the mix reads the document: all of its words, but
    where its source's demand ends within it, which gets the words up to there.  So the words taken
    of a source are its target, rounded down, and no document is read more than `most` times.

    Sources are ordered by code point, null last (a source of its own); a null text has no words
    and documents without words are never read.  Documents of a source are shuffled by a hash of
    seed, id and text, so a rerun gives the same; equal rows are interchangeable.  An empty table
    gives no rows."""
    plain = take(docs, id_col, text_col, source_col).toDF("id", "text", "source")
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    rows = materialise(plain.select("id", F.col("source").cast("string").alias("source"), size.alias("size"), _shuffled(seed).alias("h"), F.monotonically_increasing_id().alias("salt")), "sizes")
    goals = materialise(targets(rows, share, most, schedules), "targets")
    laid = materialise(_running(rows).drop("salt"), "ranges")
    # the ranges of a source follow one another; one row for each range and source in it
    sums = laid.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    places = sums.select("source", "part", F.coalesce(before, F.lit(0)).alias("base"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    places = places.join(goals, same(places, goals)).select(places["source"].alias("of"), F.col("part").alias("in"), "base", "source_size", "kind", "target")
    rows = laid.join(places, laid["source"].eqNullSafe(places["of"]) & (F.col("part") == F.col("in")))
    end = F.floor("target")
    first = F.col("base") + F.col("start")

    def one(i):
        begin = first + i * F.col("source_size")
        words = F.greatest(F.least(begin + F.col("size"), end) - begin, F.lit(0))
        # where a target is under one word nothing is taken, and the share does not matter
        when = called_at(F.least(begin / F.greatest("target", F.lit(1.0)), F.lit(1.0)), F.col("kind"), schedules)
        return F.struct(when.alias("time"), words.cast("long").alias("words"))

    passes = F.filter(F.array(*(one(F.lit(i)) for i in range(most))), lambda p: p["words"] > 0)
    rows = rows.select("id", "source", "size", "source_size", "target", passes.alias("passes"), "h")
    return rows.withColumn("taken", F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"]))


def by_time(mixed: DataFrame) -> DataFrame:
    """`mixed` range-sorted by the time at which each document is first read; those never read come last."""
    first = F.try_element_at(F.transform("passes", lambda p: p["time"]), F.lit(1))
    order = [F.col("time").asc_nulls_last(), "h"]
    return mixed.withColumn("time", first).repartitionByRange(*order).sortWithinPartitions(*order)


def training_order(docs: DataFrame, share: float = 1.5, most: int = 2, schedules=SCHEDULES, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix in training order, with all their columns: a row for each time that one
    is read, with `_time` and `_words` (the words to read from its start), range-sorted by `_time`.

    Documents are looked up by a hash of id and text and by source; rows equal in these are numbered,
    as they are interchangeable."""
    mixed = mix(docs, share, most, schedules, seed, id_col, text_col, source_col)
    rows = with_row(docs, id_col, text_col, source_col).toDF("_row", "id", "text", "source")
    rows = rows.select("_row", F.col("source").cast("string").alias("source"), _shuffled(seed).alias("h"))
    nth = F.row_number().over(Window.partitionBy("h", "source").orderBy("h"))
    reads = mixed.select(F.col("source").alias("of"), F.col("h").alias("key"), nth.alias("k"), "passes").withColumn("p", F.explode("passes"))
    rows = rows.withColumn("nth", nth)
    found = rows.join(reads, (F.col("h") == F.col("key")) & (F.col("nth") == F.col("k")) & F.col("source").eqNullSafe(F.col("of")))
    found = found.select("p.time", "p.words", *(F.col(f"_row.c{i}") for i in range(len(docs.columns))), "h")
    found = found.repartitionByRange("time", "h").sortWithinPartitions("time", "h").drop("h")
    return found.toDF("_time", "_words", *docs.columns)

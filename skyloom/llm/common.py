"""Helpers shared by the corpus operators."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import in_arrow, ship  # noqa: F401  used by the operators
from ..staging import delete, materialise, released, shared_dir  # noqa: F401

#: What separates words in the word-level operators.
SPACE = r"[\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def take(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, matched by exact case first, so that further columns
    whose names clash (also up to case) cannot make a reference ambiguous."""
    have = df.columns
    plain = df.toDF(*(f"c{i}" for i in range(len(have))))
    picked = []
    for name in names:
        at = [i for i, c in enumerate(have) if c == name] or [i for i, c in enumerate(have) if c.lower() == name.lower()]
        if not at:
            raise ValueError(f"no column {name!r} among {have}")
        picked.append(F.col(f"c{at[0]}").alias(name))
    return plain.select(*picked)


def with_row(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all columns in a struct `_row`, to be unpacked by `rows_of`."""
    have = df.columns
    plain = df.toDF(*(f"c{i}" for i in range(len(have))))
    row = F.struct(*(F.col(f"c{i}") for i in range(len(have)))).alias("_row")
    exact = lambda n: ([i for i, c in enumerate(have) if c == n] or [i for i, c in enumerate(have) if c.lower() == n.lower()])[0]
    return plain.select(row, *(F.col(f"c{exact(n)}").alias(n) for n in names))


def rows_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """Undoes `with_row`: the original columns under their own names."""
    return df.select(*(F.col(f"_row.c{i}") for i in range(len(columns)))).toDF(*columns)


#: Inputs of fewer bytes may be dealt out anew before costly work.
SMALL_INPUT = 256 << 20


def spread(rows: DataFrame) -> DataFrame:
    """`rows` over all cores, if they come from fewer files than there are cores and are small:
    files of one row group cannot be split, and costly work would run in as many tasks.  Larger
    inputs stay as they are, for their files are enough and shuffling texts is dear."""
    sc = rows.sparkSession.sparkContext
    files = rows.inputFiles()
    if not files or len(files) >= sc.defaultParallelism:
        return rows
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(sc.defaultParallelism) if size < SMALL_INPUT else rows


def let(value: Column, body) -> Column:
    """`body(x)` with `x` bound to `value`, which is computed once however often `body` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def constant(value, schema: str) -> Column:
    """A nested constant, in one expression."""
    return F.from_json(F.lit(json.dumps(value)), schema)

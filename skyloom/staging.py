"""Tables that a job writes on its way: in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where that is
    unset on a local master, a temporary folder of this machine."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        place = os.path.join(tempfile.gettempdir(), "skyloom-shared")
    return place.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str, on_exit: bool = False) -> None:
    """Deletes a folder of any store, now or when the JVM ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if on_exit:
        files.deleteOnExit(place)
    else:
        files.delete(place, True)


#: Folders of the tables written in the innermost `released` block of this thread.
_block: ContextVar[list[str] | None] = ContextVar("block", default=None)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` as a table in the shared folder and reads it back: lineage ends there, a
    lost executor costs no recomputation, and the optimiser sees the table's real size.  The table
    stays until the JVM ends, or the `released` block that it is written in."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    delete(spark, path, on_exit=True)
    written = _block.get()
    if written is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that `materialise` wrote within it, in this thread.  What was
    derived from them must have been written by then."""
    written: list[str] = []
    token = _block.set(written)
    try:
        yield
    finally:
        _block.reset(token)
        for path in written:
            delete(spark, path)

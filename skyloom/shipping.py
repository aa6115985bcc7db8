"""Brings this package to the executors, for the operators that run Python there."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession | None = None) -> None:
    """Gives executors this package, once in a session."""
    spark = spark or SparkSession.active()
    sc = spark.sparkContext
    if getattr(sc, "_skyloom_shipped", False):
        return
    top = Path(__file__).resolve().parent
    place = os.path.realpath(tempfile.mkdtemp())  # the driver's file server reads it from here
    atexit.register(shutil.rmtree, place, ignore_errors=True)
    to = os.path.join(place, f"{top.name}.zip")
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(to)
    sc._skyloom_shipped = True


def in_arrow(df: DataFrame, apply, schema: str) -> DataFrame:
    """`df.mapInArrow`, with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(apply, schema)

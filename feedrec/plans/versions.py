"""Versioned tables: a folder per version and one pointer to the current one.

A version is written under a name of its own per attempt, then the pointer file
is replaced by a rename, so a crash at any step leaves the last good version in
place. Versions without a pointer are an error, not an empty table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER, PREVIOUS, COMMITTED = "CURRENT", "PREVIOUS", "_COMMITTED"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, *parts: str) -> bool:
    fs, p = _fs(spark, os.path.join(*parts))
    return fs.exists(p)


def current(spark: SparkSession, root: str) -> str | None:
    """Name of the current version, None if the table was never written. A move
    of the pointer that did not end leaves the previous one, which then counts."""
    for name in (POINTER, PREVIOUS):
        if _exists(spark, root, name):
            return spark.read.text(os.path.join(root, name)).first()["value"]  # one line
    if _exists(spark, root, COMMITTED):
        raise RuntimeError(f"{root} has versions but no pointer")
    return None


def read(spark: SparkSession, root: str) -> DataFrame | None:
    v = current(spark, root)
    return None if v is None else spark.read.parquet(os.path.join(root, v))


def new_name() -> str:
    return f"v-{uuid.uuid4().hex}"


def promote(spark: SparkSession, root: str, name: str) -> None:
    """Point to ``name``: the pointer is written beside, the old one set aside,
    then the new one renamed into its place."""
    fs, temp = _fs(spark, os.path.join(root, f"pointer-{uuid.uuid4().hex}"))
    _, mark = _fs(spark, os.path.join(root, COMMITTED))
    out = fs.create(temp, True)
    out.write(bytearray((name + "\n").encode()))
    out.close()
    _, pointer = _fs(spark, os.path.join(root, POINTER))
    _, old = _fs(spark, os.path.join(root, PREVIOUS))
    if fs.exists(pointer):
        fs.delete(old, True)
        fs.rename(pointer, old)
    if not fs.rename(temp, pointer):
        raise RuntimeError(f"could not move the pointer of {root}")
    if not fs.exists(mark):
        fs.create(mark, True).close()
    fs.delete(old, True)


def replace(df: DataFrame, root: str) -> DataFrame:
    """Write ``df`` as the current version and read it back."""
    spark, name = df.sparkSession, new_name()
    df.write.mode("errorifexists").parquet(os.path.join(root, name))
    promote(spark, root, name)
    return read(spark, root)

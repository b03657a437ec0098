"""Results by job date: one partition a day, replaced on its own.

A second run of a day overwrites that day's partition and no other (dynamic
partition overwrite); other days stay as they are, and a run that fails leaves
the day's old rows, as new files only replace old ones when the job commits.
Works on folders and on database tables, which may have further partition
columns (``dropped`` has the job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import setting

DAY = "dt"
DYNAMIC = ("spark.sql.sources.partitionOverwriteMode", "dynamic")


def dated(df: DataFrame, day: str, *others: str) -> DataFrame:
    """``df`` with the day, partition columns last."""
    if DAY in df.columns:
        raise ValueError(f"the result has a column {DAY} of its own")
    return df.select(*[c for c in df.columns if c not in others], *others, F.lit(day).alias(DAY))


def overwrite_day(df: DataFrame, path: str, day: str, *others: str) -> None:
    """Replace the partitions of ``day`` (and of the values of ``others`` that occur) in the folder."""
    dated(df, day, *others).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*others, DAY).parquet(path)


def read_days(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """All days, or one of them (the others are not read)."""
    with setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):  # days stay text
        df = spark.read.parquet(path)
    return df if day is None else df.where(F.col(DAY) == day)


def overwrite_table_day(df: DataFrame, table: str, day: str, *others: str) -> None:
    """The same for a database table, made on its first day. A table that is there
    without days, from before, is overwritten as a whole, as it always was."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        dated(df, day, *others).write.partitionBy(*others, DAY).saveAsTable(table)
        return
    columns = spark.table(table).columns
    rows = dated(df, day, *others) if DAY in columns else df
    with setting(spark, *DYNAMIC):
        rows.select(*columns).write.insertInto(table, overwrite=True)

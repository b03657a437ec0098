"""Theme catalogue: upsert (O04), wide-to-cells (O05), look-up with defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import THEME_DEFAULTS
from ..sources.readers import CATALOG_FIELDS

VALUE_FIELDS = CATALOG_FIELDS[1:]


def upsert_catalog(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per id and per field, a value present in the new batch overwrites
    the old one; a field missing from a short new line keeps the old value.
    Several lines for one id in the batch are merged cell by cell (the
    largest value of a cell wins, so the result does not depend on file
    order). One row per id survives."""
    batch = new.groupBy("id").agg(*[F.max(c).alias(c) for c in VALUE_FIELDS])
    o = old.select("id", *VALUE_FIELDS).alias("o")
    n = batch.alias("n")
    joined = o.join(n, F.col("o.id") == F.col("n.id"), "full")
    return joined.select(
        F.coalesce(F.col("n.id"), F.col("o.id")).alias("id"),
        *[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in VALUE_FIELDS])


def to_cells(df: DataFrame, key: str, family: str, cols: list[str]) -> DataFrame:
    """One (rowkey, family, qualifier, value) row per present field."""
    cells = df.select(F.col(key).alias("rowkey"), *[F.col(c).cast("string") for c in cols]) \
        .unpivot("rowkey", cols, "qualifier", "value")
    return (cells.where(F.col("value").isNotNull())
            .select("rowkey", F.lit(family).alias("family"), "qualifier", "value"))


def catalog_cells(catalog: DataFrame) -> DataFrame:
    return to_cells(catalog, "id", "a", VALUE_FIELDS)


def enrich_theme(df: DataFrame, catalog: DataFrame, theme_col: str = "theme_id") -> DataFrame:
    """Left look-up of quality, grade and ctime by theme; a theme or a
    cell that is missing takes the per-field default. ``catalog`` must hold
    one row per id (O04 guarantees it). Callers pass aggregated or distinct
    rows so the join moves one row per key. It is a merge join whatever the
    catalogue's size: rows parsed from lines are estimated at some hundredth of
    what they take, so a planner left to itself sends any catalogue through the driver."""
    look = catalog.select(F.col("id").alias("_cid"), "quality", "grade", "ctime").hint("merge")
    j = df.join(look, F.col(theme_col) == F.col("_cid"), "left").drop("_cid")
    for c, d in THEME_DEFAULTS.items():
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(d)))
    return j

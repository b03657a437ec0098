"""The hot list (fallback themes for short lists)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .catalog import enrich_theme


def hot_themes(dl: DataFrame, catalog: DataFrame, n: int) -> DataFrame:
    """Count download rows per theme (partial/final aggregate, so a hot
    theme never sits in one task), look up features with defaults, and keep
    the top ``n`` by (quality, downloads, ctime, id) all descending.

    ``rank`` is 0-based and numeric. The global order is a
    TakeOrderedAndProject: each task keeps its own top n, and only n rows
    per task reach the final merge, so ``n`` (a report size) bounds the
    single-partition step, not the data."""
    counts = dl.groupBy("theme_id").agg(F.count(F.lit(1)).alias("dn"))
    feats = enrich_theme(counts, catalog)
    order = [F.col("quality").desc(), F.col("dn").desc(), F.col("ctime").desc(),
             F.col("theme_id").desc()]
    top = feats.orderBy(*order).limit(n)
    ranked = top.withColumn("rank", (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
    return ranked.select("rank", F.col("theme_id").alias("id"), "dn", "grade", "quality", "ctime")

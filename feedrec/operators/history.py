"""Download history: per-user theme sets (O08), good / bad split (O09),
incremental merge (O10), seen filter (O19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nonempty
from .catalog import enrich_theme

HISTORY_COLS = ["user_id", "bucket", "theme_id", "quality", "grade", "ctime"]


def downloads_by_user(dl: DataFrame) -> DataFrame:
    """Distinct (user, theme) pairs of the download rows (flat, so a
    user with many downloads is just many rows, never one large set)."""
    return dl.where(nonempty("user_id") & nonempty("theme_id")).select("user_id", "theme_id").distinct()


def split_good_bad(df: DataFrame) -> DataFrame:
    """Good iff grade == "4", everything else is bad."""
    return df.withColumn("bucket", F.when(F.col("grade") == "4", "good").otherwise("bad"))


def build_history(dl: DataFrame, catalog: DataFrame) -> DataFrame:
    """O08 -> O07 -> O09: the history rows (user, bucket, theme 4-tuple)."""
    ut = downloads_by_user(dl)
    return split_good_bad(enrich_theme(ut, catalog)).select(*HISTORY_COLS)


def merge_history(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per user and bucket, new set union old set on the whole tuple.
    Write the result to a new version (never in place)."""
    return (old.select(*HISTORY_COLS).unionByName(new.select(*HISTORY_COLS))
            .where(nonempty("user_id")).distinct())


def exclude_seen(cand: DataFrame, history: DataFrame, user_col: str = "user_id",
                 theme_col: str = "theme_id") -> DataFrame:
    """Drop candidates the user already downloaded (good or bad), by id."""
    seen = history.select(F.col("user_id").alias("_u"), F.col("theme_id").alias("_t"))
    return cand.join(seen, (F.col(user_col) == F.col("_u")) & (F.col(theme_col) == F.col("_t")),
                     "left_anti")

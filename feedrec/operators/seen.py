"""Seen sets as bitmaps.

Themes get dense numbers; a user's seen themes are one bit each in rows of
64 bits (``slot`` = number div 64), or-ed map-side. A row is one number, so a user of a
few downloads spread over many themes has no row larger than a download, and a
user of very many has up to 64 downloads in one. The sets are a table bucketed by
(user, slot): a seen filter shuffles the candidates only, looks up one row per
candidate and tests a bit. Numbers never change: a later day's themes are numbered
after the known ones, and its sets are or-ed into the stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nonempty
from ..session import bucketed
from .als import dense_ids

BITS = 64  # of one row, a long


def theme_ids(history: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(theme_id, item): numbers of all themes of ``history``, after those of ``known``."""
    if known is None:
        return dense_ids(history, "theme_id", "item")
    top = known.agg(F.coalesce(F.max("item") + 1, F.lit(0))).first()[0]
    new = dense_ids(history.join(known, "theme_id", "left_anti"), "theme_id", "item")
    return known.select("theme_id", "item").unionByName(new.withColumn("item", (F.col("item") + top).cast("int")))


def _numbered(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    return (rows.join(ids.select("theme_id", "item"), "theme_id", how)
            .withColumn("slot", F.floor(F.col("item") / BITS)).withColumn("bit", F.pmod(F.col("item"), F.lit(BITS))))


def seen_sets(history: DataFrame, ids: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """(user_id, slot, bits) of all themes of each user, good or bad; with
    ``old``, of both days."""
    sets = (_numbered(history.where(nonempty("user_id")).select("user_id", "theme_id"), ids, "inner")
            .groupBy("user_id", "slot").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits")))
    if old is not None:
        sets = old.unionByName(sets).groupBy("user_id", "slot").agg(F.bit_or("bits").alias("bits"))
    return bucketed(sets, "user_id", "slot")


def is_set(bits: Column, bit: Column) -> Column:
    """Is the bit set? False without a row."""
    return F.coalesce(F.call_function("shiftright", bits, bit).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def unseen(cand: DataFrame, ids: DataFrame, sets: DataFrame) -> DataFrame:
    """The candidates that the user has not downloaded. A theme without a
    number is in nobody's history. Keeps the columns of ``cand``."""
    rows = _numbered(cand, ids, "left").join(sets, ["user_id", "slot"], "left")
    return rows.where(~is_set(F.col("bits"), F.col("bit"))).select(*cand.columns)

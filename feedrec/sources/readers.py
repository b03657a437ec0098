"""Scans and text formats of the jobs (O01, O02, O03) and the list files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import java_split, nonempty

# Fixed field order of the catalogue file.
CATALOG_FIELDS = ["id", "is_share", "status", "uid", "grade", "quality", "ctime", "tags"]
LIST_SEP = "\u0002"


def behavior_window(beh: DataFrame, since: str, inclusive: bool = False,
                    act: str | None = None) -> DataFrame:
    """The four used columns of the behaviour table, with
    ``pt > since`` (or ``>=``) and no upper bound. ``since`` is a driver-side
    constant so the predicate stays on the raw ``pt`` column and prunes
    partitions of a ``pt``-partitioned table."""
    cond = (F.col("pt") >= F.lit(since)) if inclusive else (F.col("pt") > F.lit(since))
    if act is not None:
        cond = cond & (F.col("act_type") == F.lit(act))
    return beh.where(cond).select("time", "theme_id", "user_id", "act_type")


def download_window(beh: DataFrame, since: str) -> DataFrame:
    """Download rows with ``pt >= since`` and a non-empty theme."""
    return (behavior_window(beh, since, inclusive=True, act="Download")
            .where(nonempty("theme_id"))
            .select("theme_id", "user_id"))


def parse_catalog_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Tab-separated catalogue lines -> typed columns. A short line loses
    its trailing fields (they are NULL here, i.e. "not present"), trailing
    empty fields count as missing, and a line without an id is dropped."""
    # The line is split once per row: the fields come out of a one-row
    # ``inline`` generator, which filters on the fields cannot be pushed
    # through, so no predicate re-inlines (and re-runs) the split.
    arr = lines.select(java_split(F.col(col), "\t").alias("_a"))
    out = arr.select(F.inline(F.array(F.struct(
        *[F.get("_a", i).alias(name) for i, name in enumerate(CATALOG_FIELDS)]))))
    return out.where(nonempty("id"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """O03 on files: plain text (not CSV, whose quoting rules differ)."""
    return parse_catalog_lines(spark.read.text(path))


def read_sim_list(spark: SparkSession, path: str) -> DataFrame:
    """``user \\t t1 \\002 t2 ...`` -> (user_id, simuser)."""
    arr = java_split(F.col("value"), "\t")
    return (spark.read.text(path)
            .select(F.get(arr, 0).alias("user_id"), F.get(arr, 1).alias("simuser"))
            .where(nonempty("user_id") & F.col("simuser").isNotNull()))


def read_profile_list(spark: SparkSession, path: str) -> DataFrame:
    """``user \\t profile \\t extend`` -> rows with exactly three fields."""
    arr = java_split(F.col("value"), "\t")
    return (spark.read.text(path)
            .where(F.size(arr) == 3)
            .select(F.get(arr, 0).alias("user_id"), F.get(arr, 1).alias("profile"),
                    F.get(arr, 2).alias("extend")))

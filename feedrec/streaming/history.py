"""Incremental download history (O10) driven by Structured Streaming.

The original updates the history once a day with that day's downloads. Here
new behaviour files are a file stream; each micro-batch is turned into
history rows (O02 -> O08 -> O07 -> O09) and merged into the stored history
(O10). The table lies in ``BUCKETS`` hash buckets of the user; a batch rewrites
only the buckets that its users fall in, under a name of its own per attempt. A
version is a manifest (bucket, path), and one pointer names the current one
(``plans/versions.py``), so a batch that fails at any step leaves the last good
version in place, and one that runs again gives the same rows: the merge is a
set union. The stream's own progress lives in the checkpoint location, which
must be a shared folder on a cluster.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import nonempty
from ..operators.history import HISTORY_COLS, build_history, merge_history
from ..plans import versions as V

BEHAVIOR_SCHEMA = "time string, theme_id string, user_id string, act_type string, pt string"
BUCKETS = 64


def _manifest(spark: SparkSession, root: str) -> dict[int, str]:
    """bucket -> folder of the current version; at most ``BUCKETS`` rows."""
    df = V.read(spark, root)
    return {} if df is None else {r.bucket: r.path for r in df.collect()}


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.parquet(*paths).select(*HISTORY_COLS)


def read_history(spark: SparkSession, root: str) -> DataFrame | None:
    paths = sorted(_manifest(spark, root).values())
    return _read(spark, paths) if paths else None


def merge_batch(batch: DataFrame, epoch: int, catalog: DataFrame, root: str) -> None:
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).cast("int")
    new = build_history(batch.where((F.col("act_type") == "Download") & nonempty("theme_id"))
                        .select("theme_id", "user_id"), catalog)
    touched = sorted(r.b for r in new.select(bucket.alias("b")).distinct().collect())  # BUCKETS at most
    if not touched:
        return
    manifest = _manifest(spark, root)
    paths = [manifest[b] for b in touched if b in manifest]
    merged = merge_history(_read(spark, paths), new) if paths else new
    data = os.path.join(root, "data", V.new_name())
    merged.select(*HISTORY_COLS, bucket.alias("user_bucket")).write.partitionBy("user_bucket").parquet(data)
    manifest |= {b: os.path.join(data, f"user_bucket={b}") for b in touched}
    V.replace(spark.createDataFrame(sorted(manifest.items()), "bucket int, path string").coalesce(1), root)


def start(spark: SparkSession, behavior_dir: str, catalog: DataFrame, root: str, checkpoint: str,
          available_now: bool = True):
    """Start the stream over parquet files landing in ``behavior_dir``."""
    stream = spark.readStream.schema(BEHAVIOR_SCHEMA).parquet(behavior_dir)
    w = (stream.writeStream.foreachBatch(lambda df, epoch: merge_batch(df, epoch, catalog, root))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()

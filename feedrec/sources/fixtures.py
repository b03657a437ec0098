"""Views that map the driver's TPC-H-ish tables onto the job's logical tables.

behavior : orders x lineitem -> (time, theme_id, user_id, act_type, pt)
catalog  : part -> the 8-field tab-separated theme file, parsed back
events   : events -> a second behaviour source with very hot items

Only the columns each view needs are read, so the parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import parse_catalog_lines

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    return j.select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.col("l_partkey").cast("string").alias("theme_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(F.col("l_returnflag") == "R", "Download")
         .when(F.col("l_returnflag") == "A", "Scan")
         .otherwise("Other").alias("act_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("pt"),
    )


def events_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """view -> Scan, purchase -> Download, other events -> Other; the item is
    the ``k`` field of ``props``. Few items, many users each: heavy keys."""
    e = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "props")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.get_json_object("props", "$.k").alias("theme_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "view", "Scan")
         .when(F.col("event_type") == "purchase", "Download")
         .otherwise("Other").alias("act_type"),
        F.date_format("ts", "yyyy-MM-dd").alias("pt"),
    )


def _tags_expr() -> F.Column:
    k = F.col("p_partkey")
    name_tokens = F.regexp_replace("p_name", " ", ",")
    return (F.when(k % 11 == 0, F.col("p_type"))
            .when(k % 7 == 0, F.concat(name_tokens, F.lit("，其他,"), F.col("p_type")))
            .when(k % 13 == 0, F.concat(name_tokens, F.lit(",,"), F.col("p_type"), F.lit(",。")))
            .otherwise(F.concat(name_tokens, F.lit(","), F.col("p_type"))))


def catalog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tab-separated line per part, as the catalogue file would hold it.
    Small parts (size <= 5) have no tags field; large ones (size > 45) stop
    after grade, so quality, ctime and tags fall back to defaults or drop."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name", "p_size")
    fields = F.array(
        F.col("p_partkey").cast("string"), F.lit("1"), F.lit("1"), F.col("p_brand"),
        (F.col("p_size") % 5).cast("string"), (F.col("p_partkey") % 2).cast("string"),
        (F.lit(1500000000) + F.col("p_partkey") * 60).cast("string"), _tags_expr())
    n = F.when(F.col("p_size") <= 5, 7).when(F.col("p_size") > 45, 5).otherwise(8)
    return p.select(F.array_join(F.slice(fields, F.lit(1), n), "\t").alias("value"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_catalog_lines(catalog_lines(spark, sf_dir))

"""Implicit-feedback ALS: dense ids (O36), ratings (O37), training (O38),
factor export (O39), predictions (O40) and their MSE (O41)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import act_weight, nonempty, time_decay
from ..params import Params
from ..session import cut_lineage

_LOW33 = (1 << 33) - 1


def dense_ids(df: DataFrame, col: str, out: str, partitions: int | None = None,
              checkpoint: bool = True) -> DataFrame:
    """0-based ids in ascending key order, without a global window.

    Distinct keys are range partitioned and sorted inside each partition;
    ``monotonically_increasing_id`` then gives (partition, local index).
    Offsets are the running count of the preceding partitions: a table with
    one row per partition (bounded by the partition count, so the window
    over it and its broadcast stay small). Output (key, id int)."""
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.where(nonempty(col)).select(col).distinct()
    r = (keys.repartitionByRange(p, col).sortWithinPartitions(col)
         .withColumn("_m", F.monotonically_increasing_id())
         .select(col, F.shiftright("_m", 33).alias("_p"), F.col("_m").bitwiseAND(F.lit(_LOW33)).alias("_l")))
    if checkpoint:
        r = cut_lineage(r)
    counts = r.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_o"))
    return (r.join(F.broadcast(offsets), "_p")
            .select(col, (F.col("_o") + F.col("_l")).cast("int").alias(out)))


def als_events(beh_window: DataFrame) -> DataFrame:
    return beh_window.where(nonempty("user_id") & nonempty("theme_id"))


def als_ratings(beh_window: DataFrame, users: DataFrame, items: DataFrame, p: Params) -> DataFrame:
    """One rating per event (no aggregation): act weight (1 / 7 / 0)
    times decay 1 / (1 + 0.1 days); an unparseable time is 180 days old; a
    bare date prefix parses. Output (user int, item int, rating double)."""
    ev = als_events(beh_window)
    r = (act_weight("act_type", p.als_scan, p.als_download)
         * time_decay("time", p.as_of, p.als_decay, p.als_fallback_days, lenient=True))
    return (ev.join(users, "user_id").join(items, "theme_id")
            .select(F.col("user").cast("int"), F.col("item").cast("int"), r.alias("rating")))


def ratings_text(ratings: DataFrame, sep: str = "::") -> DataFrame:
    return ratings.select(F.concat_ws(sep, "user", "item", F.col("rating").cast("string")).alias("value"))


def parse_ratings_text(lines: DataFrame, sep: str = "::") -> DataFrame:
    a = F.split(F.col("value"), sep)
    return lines.select(F.get(a, 0).cast("int").alias("user"), F.get(a, 1).cast("int").alias("item"),
                        F.get(a, 2).cast("double").alias("rating"))


def als_fit(ratings: DataFrame, p: Params):
    """ALS with a fixed seed, implicit or explicit (and the checkpoint
    folder, so ALS's own periodic checkpoints cut its lineage). A pair that the
    model cannot score is NaN, never a missing row."""
    from pyspark.ml.recommendation import ALS

    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(ratings.sparkSession)
    kw = dict(rank=p.als_rank, maxIter=p.als_iters, regParam=p.als_lambda, alpha=p.als_alpha,
              implicitPrefs=p.als_implicit, seed=p.seed, userCol="user", itemCol="item", ratingCol="rating",
              coldStartStrategy="nan", checkpointInterval=5)
    if p.als_blocks and p.als_blocks > 0:
        kw.update(numUserBlocks=p.als_blocks, numItemBlocks=p.als_blocks)
    return ALS(**kw).fit(ratings)


def als_factors(factors: DataFrame) -> DataFrame:
    """``id,v v v`` as (id, features string); also keeps the array."""
    return factors.select("id", F.array_join(F.transform("features", lambda x: x.cast("string")), " ")
                          .alias("features_text"), "features")


def als_predict(model, ratings: DataFrame) -> DataFrame:
    """Score every training pair. Output (user, item, rating, prediction).
    Every pair was trained on, so one without a score is an error."""
    pred = model.transform(ratings).select("user", "item", "rating", "prediction")
    checked = F.when(F.isnan("prediction"), F.raise_error(F.lit("a training pair has no factors"))).otherwise(F.col("prediction"))
    return pred.withColumn("prediction", checked.cast("float"))


def als_mse(pred: DataFrame) -> DataFrame:
    """Mean squared error of predictions against ratings."""
    return pred.agg(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)).alias("mse"),
                    F.count(F.lit(1)).alias("n"))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)


def dot_check(model, ratings: DataFrame) -> DataFrame:
    """O40 against the exported factors: (user, item, rating, prediction, dot)."""
    u = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("x"))
    i = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    # predictions lie by item already: the item's join first moves nothing
    return (als_predict(model, ratings).join(i, "item").join(u, "user")
            .select("user", "item", "rating", "prediction", _dot(F.col("x"), F.col("y")).alias("dot")))


def normal_equations(model, ratings: DataFrame, p: Params) -> DataFrame:
    """O38 check: user factors are the last half-step, so each solves its linear
    system exactly. With c = alpha |r| the implicit system of a user is
    (Y'Y + sum c y y' + lambda n I) x = sum over r > 0 of (1 + c) y, n the
    ratings above 0. Output (id, residual): the largest component left over.
    Y'Y is rank x rank numbers, a scalar subquery; the sums are one aggregate, one
    column a factor, over rows that the last join has laid by user. Factors move
    as the floats they are."""
    y = model.itemFactors.select(F.col("id").alias("item"), F.transform("features", lambda v: v.cast("double")).alias("y"))
    k = p.als_rank
    cell = F.explode(F.flatten(F.transform("y", lambda a, i: F.transform("y", lambda b, j: F.struct(
        (i * k + j).alias("at"), (a * b).alias("v"))))))
    yty = (y.select(cell.alias("c")).groupBy("c.at").agg(F.sum("c.v").alias("v"))
           .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda c: c["v"]).alias("m")))
    factors = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    x = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("x"))
    c = F.lit(float(p.als_alpha)) * F.abs("rating")
    r = (ratings.join(factors, "item").join(x, "user")
         .withColumn("w", c * _dot(F.col("x"), F.col("y")) - F.when(F.col("rating") > 0, 1 + c).otherwise(0.0)))
    sums = (r.groupBy("user").agg(F.sum((F.col("rating") > 0).cast("int")).alias("n"),
                                  *(F.sum(F.get("y", F.lit(j)).cast("double") * F.col("w")).alias(f"s{j}") for j in range(k)))
            .select("user", "n", F.array(*(f"s{j}" for j in range(k))).alias("s")))
    full = sums.join(x, "user").withColumn("m", yty.scalar())
    left = F.transform(F.col("x").cast("array<double>"), lambda v, j: F.abs(_dot(F.slice(F.col("m"), j * k + 1, F.lit(k)), F.col("x"))
                                              + F.get("s", j) + F.lit(float(p.als_lambda)) * F.col("n") * v))
    return full.select(F.col("user").alias("id"), F.array_max(left).alias("residual"))

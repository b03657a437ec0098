"""Neighbour lists without whole histories (O18 to O20 as one rank join).

A list needs a user's best ``size`` unseen candidates by (quality, ctime), while
the walk of O18 reads neighbours until the set holds ``max_n`` items. Sizes alone tell
how far the walk can get: every neighbour before the last one that is read has fewer
than ``max_n`` items, so at most one long history is read, as the last. The short
ones are joined as they are (fewer than ``max_n`` rows each). Of a long one only
its head in list order is: the best 2 ``size`` items, and four times as many in each
further round for the users who had seen too many of them. A history's head is a
limited window, cut map-side, so a neighbour with any number of items sends a
few rows to each follower. Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import nonempty
from ..functions.ranking import top_n
from ..session import cut_lineage
from .history import exclude_seen

TUPLE = ["theme_id", "quality", "grade", "ctime"]


def list_order() -> list[F.Column]:
    return [F.col("quality").desc(), F.col("ctime").desc(), F.col("theme_id").asc()]


def good_items(history: DataFrame) -> DataFrame:
    return history.where(F.col("bucket") == "good").select(F.col("user_id").alias("nb"), *TUPLE)


def reachable(sim: DataFrame, good: DataFrame, max_n: int) -> DataFrame:
    """(user_id, neighbor, rank, h_n): neighbours the walk can get to. The set
    before a neighbour holds at least the largest single history before it, so
    after one of ``max_n`` items nobody is read."""
    sizes = good.groupBy("nb").agg(F.count(F.lit(1)).alias("h_n"))
    s = sim.where(nonempty("user_id") & nonempty("neighbor")).select("user_id", "neighbor", "rank")
    prior = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return (s.join(sizes, F.col("neighbor") == F.col("nb"), "left")
            .withColumn("prev_max", F.coalesce(F.max(F.coalesce(F.col("h_n"), F.lit(0))).over(prior), F.lit(0)))
            .where(F.col("prev_max") < max_n).select("user_id", "neighbor", "rank", "h_n"))


def first_seen(s: DataFrame, good: DataFrame) -> DataFrame:
    """(user_id, tuple, first_rank) over the whole histories of the neighbours in ``s``."""
    return (s.join(good, F.col("neighbor") == F.col("nb"))
            .groupBy("user_id", *TUPLE).agg(F.min("rank").alias("first_rank")))


def read_ranks(first: DataFrame, max_n: int) -> DataFrame:
    """(user_id, first_rank, before): a neighbour is read iff the number of
    tuples first seen before it is below ``max_n``."""
    per_rank = first.groupBy("user_id", "first_rank").agg(F.count(F.lit(1)).alias("new_n"))
    w = Window.partitionBy("user_id").orderBy("first_rank").rowsBetween(Window.unboundedPreceding, -1)
    return (per_rank.withColumn("before", F.coalesce(F.sum("new_n").over(w), F.lit(0)))
            .where(F.col("before") < max_n).select("user_id", "first_rank"))


def short_walks(s: DataFrame, good: DataFrame, max_n: int) -> DataFrame:
    """``first_seen`` over the histories of fewer than ``max_n`` items, with
    ``before``: the number of tuples first seen by an earlier neighbour. A user has
    fewer than ``max_n`` of these rows a neighbour, so they are shuffled once, by
    user, and summed and counted there."""
    rows = (s.where(F.col("h_n") < max_n).join(good, F.col("neighbor") == F.col("nb"))
            .select("user_id", "rank", *TUPLE).repartition("user_id"))
    earlier = Window.partitionBy("user_id").orderBy("first_rank").rangeBetween(Window.unboundedPreceding, -1)
    return (rows.groupBy("user_id", *TUPLE).agg(F.min("rank").alias("first_rank"))
            .withColumn("before", F.count(F.lit(1)).over(earlier)))


def best_unseen(sim: DataFrame, history: DataFrame, max_n: int, size: int) -> DataFrame:
    """The ``size`` best unseen candidates of every user in list order (all, if
    there are fewer): (user_id, theme_id, quality, grade, ctime). ``neighbor_list``
    makes the same list of them as of all candidates."""
    good = good_items(history)
    s = cut_lineage(reachable(sim, good, max_n).where("h_n > 0"))
    first = cut_lineage(short_walks(s, good, max_n))
    short = first.where(F.col("before") < max_n)
    found = exclude_seen(short, history).select("user_id", *TUPLE)
    full = first.groupBy("user_id").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= max_n)
    todo = cut_lineage(s.where(F.col("h_n") >= max_n).join(full, "user_id", "left_anti")
                       .select("user_id", F.col("neighbor").alias("nb"), "h_n"))
    k, rounds = 2 * size, 0
    while not todo.isEmpty():
        heads = top_n(good.join(todo.select("nb").distinct(), "nb", "left_semi"), "nb", list_order(), k, "place").drop("place")
        part = cut_lineage(exclude_seen(todo.join(heads, "nb"), history).select("user_id", *TUPLE))
        enough = part.groupBy("user_id").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= size)
        # who is still short of items reads on; those whose history ends here are done
        todo = cut_lineage(todo.where(F.col("h_n") > k).join(enough, "user_id", "left_anti"))
        found = found.unionByName(part.join(todo.select("user_id"), "user_id", "left_anti"))
        k, rounds = k * 4, rounds + 1
    # the short ones are distinct already
    return top_n(found.distinct() if rounds else found, "user_id", list_order(), size, "place").drop("place")

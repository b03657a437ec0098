"""User-user collaborative filtering (O12-O18) and the neighbour list.

The plan, in shuffles: distinct (user, act, theme) [partial agg] -> norm per
(user, act) and heat per (theme, act) [partial aggs] -> self join on (theme,
act, block pair), every unordered pair once -> sum per unordered pair [partial
agg before the shuffle] -> mirror -> top N per user [WindowGroupLimit]. All
users of a group take part; a heavy group is split into blocks of about
``pair_block`` users, so no join key holds more than that on either side. Which
groups need to form their pairs is decided in ``simtop``. The
seeded sample of O14 is an opt-in (``theme_max_user``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import nonempty, r6
from ..functions.ranking import top_n
from ..params import Params
from ..session import cut_lineage
from . import simtop
from .neighbors import TUPLE, first_seen, good_items, list_order, reachable, read_ranks


def cf_rows(beh: DataFrame) -> DataFrame:
    """Distinct (user, act, theme) of a behaviour window; rows without a user
    or theme are dropped here rather than later (D22)."""
    return (beh.where(nonempty("user_id") & nonempty("theme_id"))
            .select("user_id", "act_type", "theme_id").distinct())


def user_act_norm(rows: DataFrame) -> DataFrame:
    """Distinct themes per (user, act)."""
    return rows.groupBy("user_id", "act_type").agg(F.count(F.lit(1)).alias("n"))


def theme_heat(rows: DataFrame) -> DataFrame:
    """Distinct users per (theme, act); only heat > 1 can form a pair."""
    return (rows.groupBy("theme_id", "act_type").agg(F.count(F.lit(1)).alias("heat"))
            .where(F.col("heat") > 1))


def sample_key(seed: int) -> F.Column:
    """Seeded, engine-independent shuffle order of the users of one group."""
    return F.md5(F.concat_ws("#", F.col("theme_id"), F.col("user_id"), F.lit(str(seed))))


def cap_users(rows: DataFrame, heat: DataFrame, k: int, seed: int) -> DataFrame:
    """Keep every user of a (theme, act) with fewer than ``k`` users,
    else a seeded sample of ``k``; heat stays the uncapped count. The sample
    is a per-group top-k on a hash, which Spark limits map-side before the
    shuffle, so a group holding a third of all rows ships k rows per task."""
    picked = top_n(rows, ["theme_id", "act_type"], [sample_key(seed).asc(), F.col("user_id").asc()],
                   k, "pick")
    return picked.join(heat, ["theme_id", "act_type"]).select("theme_id", "act_type", "user_id", "heat")


def members(rows: DataFrame, heat: DataFrame, p: Params) -> DataFrame:
    """Users of every (theme, act) that can form a pair, with its heat; the
    sample of O14 only where the parameters ask for it."""
    if p.theme_max_user:
        return cap_users(rows, heat, p.theme_max_user, p.seed)
    return rows.join(heat, ["theme_id", "act_type"]).select("theme_id", "act_type", "user_id", "heat")


def pair_contrib_half(capped: DataFrame, norm: DataFrame, p: Params) -> DataFrame:
    """O15, one direction: each unordered pair (a < b) of one (theme, act)
    gives act / ln(1 + heat) / sqrt(n_a * n_b). A group of more than
    ``pair_block`` users is cut into blocks by user hash; each pair of blocks
    is a join key of its own."""
    return contributions(simtop.weighted(capped, norm, p), p)


def contributions(c: DataFrame, p: Params) -> DataFrame:
    """Unordered pairs of the groups in ``c`` (rows of ``simtop.weighted``)."""
    blocks = F.ceil(F.col("heat") / F.lit(p.pair_block)).cast("int")
    c = c.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("user_id"), F.col("blocks")).cast("int"))
    a = c.select("theme_id", "act_type", "c", F.col("block").alias("lo"), F.col("user_id").alias("u"), F.col("n").alias("na"),
                 F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("hi"))
    b = c.select("theme_id", "act_type", F.col("block").alias("hi"), F.col("user_id").alias("v"), F.col("n").alias("nb"),
                 F.explode(F.sequence(F.lit(0), F.col("block"))).alias("lo"))
    j = a.join(b, ["theme_id", "act_type", "lo", "hi"]).where((F.col("lo") < F.col("hi")) | (F.col("u") < F.col("v")))
    contrib = F.col("c") / F.sqrt(F.col("na").cast("double") * F.col("nb").cast("double"))
    return j.select(F.least("u", "v").alias("ua"), F.greatest("u", "v").alias("ub"), "theme_id", "act_type",
                    contrib.alias("contrib"))


def half_sums(c: DataFrame, p: Params) -> DataFrame:
    """O15 summed: (ua, ub, sim) of every unordered pair in the groups of ``c``."""
    return contributions(c, p).groupBy("ua", "ub").agg(F.sum("contrib").alias("sim"))


def pair_totals(half: DataFrame) -> DataFrame:
    """O15 as a report: unordered pairs and their summed contribution per
    (theme, act); the pairs themselves are quadratic in a group."""
    return half.groupBy("theme_id", "act_type").agg(F.count(F.lit(1)).alias("pairs"), F.sum("contrib").alias("contrib"))


def mirror(df: DataFrame, a: str, b: str, out_a: str, out_b: str, *keep: str) -> DataFrame:
    """Emit both directions of each row: (a, b) and (b, a)."""
    s = F.explode(F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")),
                          F.struct(F.col(b).alias("x"), F.col(a).alias("y")))).alias("_d")
    return df.select(s, *keep).select(F.col("_d.x").alias(out_a), F.col("_d.y").alias(out_b), *keep)


def similar_users(beh_window: DataFrame, p: Params) -> DataFrame:
    """Top ``n_sim_users`` neighbours per user by summed contribution,
    over all pairs, of which ``simtop`` forms only those that can matter, or sums
    them as matrix products where most users meet.
    Output: user_id, neighbor, rank (1-based), sim (rounded)."""
    rows = cf_rows(beh_window)
    weighted = simtop.weighted(members(rows, theme_heat(rows), p), user_act_norm(rows), p)
    weighted = cut_lineage(weighted)
    groups = simtop.dense(weighted, p)
    if groups is not None:
        sums = simtop.block_best(weighted, groups, p)
    else:
        sums = simtop.candidate_sums(half_sums, mirror, weighted, p)
    return simtop.best(sums, p.n_sim_users).withColumn("sim", r6("sim"))


def similar_user_map(sim: DataFrame) -> DataFrame:
    """Nested form user -> map<neighbor, sim> (at most N entries)."""
    return sim.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("neighbor", "sim"))).alias("similar_user"))


def explode_user_map(m: DataFrame) -> DataFrame:
    return m.select("user_id", F.explode("similar_user").alias("neighbor", "sim"))


def neighbor_candidates(sim: DataFrame, history: DataFrame, max_n: int) -> DataFrame:
    """Walk neighbours by rank, adding each one's whole *good* history;
    stop before the next neighbour once the distinct set has ``max_n`` items.

    A tuple belongs to the set iff the first neighbour that has it is read;
    neighbour r is read iff the number of distinct tuples first seen before r
    is below ``max_n`` (a running sum over at most N ranks per user)."""
    good = good_items(history)
    first = first_seen(reachable(sim, good, max_n), good)
    return first.join(read_ranks(first, max_n), ["user_id", "first_rank"]).select("user_id", *TUPLE, "first_rank")


def neighbor_list(unseen: DataFrame, hot: DataFrame, users: DataFrame, size: int,
                  dedupe_backfill: bool = False) -> DataFrame:
    """Order candidates by (quality, ctime) descending; more than
    ``size`` -> keep the first ``size``; exactly ``size`` -> as is; fewer ->
    [quality "1" items] ++ first ``lack`` hot themes ++ [the other items].

    Output (user_id, pos 1-based, theme_id, section). Every user of ``users``
    gets a list, so a user without candidates gets the hot list head. A list
    is put together as arrays of at most ``size`` items and hot themes, so the
    candidates are grouped by user once and the lists themselves are not
    shuffled; never a cross join."""
    ranked = top_n(unseen.select("user_id", "theme_id", "quality", "ctime"), "user_id", list_order(), size, "sub")
    own = ranked.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("sub", "theme_id", "quality"))).alias("items"))
    # at most ``size`` hot themes are ever used: one row for all users
    head = (hot.where((F.col("rank") >= 0) & (F.col("rank") < size))
            .agg(F.sort_array(F.collect_list(F.struct("rank", F.col("id").alias("theme_id")))).alias("head")))
    u = (users.select("user_id").distinct().join(own, "user_id", "left")
         .withColumn("items", F.coalesce("items", F.array().cast(own.schema["items"].dataType)))
         .withColumn("lack", F.lit(size) - F.size("items")).withColumn("head", head.scalar()))

    def behind(x):
        return (F.col("lack") > 0) & F.coalesce(x["quality"] != "1", F.lit(False))

    def listed(items, section: int):
        return F.transform(items, lambda x: F.struct(x["theme_id"].alias("theme_id"), F.lit(section).alias("section")))

    if dedupe_backfill:
        fill = F.filter("head", lambda x: ~F.coalesce(F.exists("items", lambda y: y["theme_id"] == x["theme_id"]), F.lit(False)))
        fill = F.slice(fill, F.lit(1), F.col("lack"))
    else:
        fill = F.filter("head", lambda x: x["rank"] < F.col("lack"))
    whole = F.concat(listed(F.filter("items", lambda x: ~behind(x)), 0), listed(fill, 1), listed(F.filter("items", behind), 2))
    return (u.select("user_id", F.posexplode(whole).alias("pos", "of"))
            .select("user_id", (F.col("pos") + 1).cast("long").alias("pos"), F.col("of.theme_id").alias("theme_id"),
                    F.col("of.section").alias("section")))


def neighbor_list_text(lst: DataFrame, sep: str = "\u0002") -> DataFrame:
    """``user \\t t1 \\002 t2 ...`` lines of the list."""
    agg = lst.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("pos", "theme_id"))).alias("l"))
    return agg.select(F.concat_ws("\t", "user_id",
                                  F.array_join(F.transform("l", lambda x: x["theme_id"]), sep)).alias("value"))

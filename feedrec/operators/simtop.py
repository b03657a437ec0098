"""Exact top-N similar users without forming every pair.

A pair's similarity is a sum over the (theme, act) groups both users are in; a
group gives c / sqrt(n_u n_v) with c = act weight / ln(1 + heat). The hotter a group, the
less it gives and the more pairs it has (heat squared), so groups are taken from
the largest c down:

1. *head*: the groups of largest c whose pairs together stay within a share of
   all pairs (``head_share``, and ``head_per_result`` for each row of the result)
   form their pairs, and each user's N-th best sum so far is a lower bound tau;
2. *tail*: what the rest can add to a pair is at most t_u t_v (Cauchy-Schwarz),
   t_u being the norm of the user's tail rows, sqrt(sum c / n_u). A head pair
   is dropped for u where sum + t_u t_v stays below tau_u. A user with
   t_u max(t) below tau_u can have no new partner in the tail; only the *open* users,
   among them all with fewer than N partners, form tail pairs, and of these
   only the ones with t_u t_v up to tau_u;
3. head pairs that stay and were not formed in the tail get their tail sum by a
   join of the pair with the tail rows of its user with fewer ones.

Nothing is estimated: a dropped pair is below the N-th best by more than the
rounding that ranks are taken on, so the result is that of all pairs. Tail
groups of weight 0 (other acts) only serve users with too few partners.

Where a few groups hold so many users that most users meet (``dense``), pairs are
not formed as rows at all: users are cut into blocks, a task gets the rows of two
blocks, sums all groups of all their pairs as a product of two matrices and
returns the N best of each user there. What is shuffled is each user's groups,
once a block, and N rows a user and block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import act_weight, r9
from ..functions.ranking import top_n
from ..params import Params
from ..session import cut_lineage

SLACK = 1e-8  # sums are ranked on 9 digits
STEPS = 4  # heat classes of a doubling
DENSE_PAIRS = 5_000_000  # below so many pairs the join is cheap whatever their form
DENSE_GROUPS = 8192  # columns of a block's matrix at most
DENSE_CELLS = 1 << 23  # numbers of a block's matrix at most
STRIP = 256  # rows of a product held at once


def weighted(members: DataFrame, norm: DataFrame, p: Params) -> DataFrame:
    """Users of the groups with ``n`` (O12) and ``c``, what the group gives before the norms."""
    w = act_weight("act_type", p.scan_factor, p.download_factor)
    m = members.join(norm, ["user_id", "act_type"])
    if p.drop_zero:
        m = m.where(w != 0)
    return m.select("theme_id", "act_type", "user_id", "heat", "n",
                    (w / F.log(F.lit(1.0) + F.col("heat").cast("double"))).alias("c"))


def head_limit(rows: DataFrame, users: int, p: Params) -> float:
    """Groups with c above this number are the head. Groups are summed up by act
    and heat class (a factor of 2^(1/4)), some hundred rows whatever the data."""
    if min(p.scan_factor, p.download_factor) < 0:
        return -math.inf  # sums could fall again, so there is no bound: form all pairs
    groups = rows.groupBy("theme_id", "act_type").agg(F.first("c").alias("c"), F.count(F.lit(1)).cast("double").alias("k"), F.first("heat").alias("heat"))
    classes = (groups.groupBy("act_type", F.floor(F.log2("heat") * STEPS).alias("class"))
               .agg(F.max("c").alias("c"), F.sum(F.col("k") * (F.col("k") - 1) / 2).alias("pairs")).collect())
    budget = max(p.head_share * sum(r.pairs for r in classes), p.head_per_result * users * p.n_sim_users)
    formed = 0.0
    # classes of one act whose c overlap with another's end together with it
    for r in sorted(classes, key=lambda r: -r.c):
        formed += r.pairs
        if formed > budget:
            return r.c
    return -math.inf


def paired(a: DataFrame, b: DataFrame, p: Params) -> DataFrame:
    """Rows of ``a`` with rows of ``b`` of the same group, as (u, v, gain): c /
    sqrt(n_u n_v). Large groups are cut into blocks by user hash and each pair of
    blocks is a join key of its own. Further columns of both come along."""
    blocks = F.ceil(F.col("heat") / F.lit(p.pair_block)).cast("int")
    block = F.pmod(F.xxhash64("user_id"), blocks).cast("int")
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    a = a.withColumn("ub", block).withColumn("vb", every).withColumnRenamed("user_id", "u").withColumnRenamed("n", "nu")
    b = b.withColumn("vb", block).withColumn("ub", every).withColumnRenamed("user_id", "v").withColumnRenamed("n", "nv").drop("c", "heat")
    j = a.join(b, ["theme_id", "act_type", "ub", "vb"]).where("u <> v")
    return j.withColumn("gain", F.col("c") / F.sqrt(F.col("nu").cast("double") * F.col("nv").cast("double")))


def dense(rows: DataFrame, p: Params) -> DataFrame | None:
    """The groups (theme_id, act_type, c), if they are few and the pairs within
    them come to an eighth of the square of the users or more."""
    if min(p.scan_factor, p.download_factor) < 0:
        return None
    groups = rows.groupBy("theme_id", "act_type").agg(F.first("c").alias("c"), F.count(F.lit(1)).cast("double").alias("k"))
    n, pairs = groups.agg(F.count(F.lit(1)), F.sum(F.col("k") * (F.col("k") - 1) / 2)).first()
    if n > DENSE_GROUPS or (pairs or 0.0) < DENSE_PAIRS:
        return None
    users = rows.select("user_id").distinct().count()
    return groups.select("theme_id", "act_type", "c") if 8 * pairs >= users * users else None


def block_best(rows: DataFrame, groups: DataFrame, p: Params, size: int | None = None) -> DataFrame:
    """(u, v, sim): for every user and block of users the N best of all pairs."""
    listed = sorted(map(tuple, groups.select("theme_id", "act_type", "c").collect()))  # DENSE_GROUPS at most
    c = np.array([x[2] for x in listed])
    users = rows.select("user_id").distinct().count()
    size = size or max(1, min(16384, DENSE_CELLS // max(1, len(c))))
    blocks = max(-(-users // size), min(8, -(-users // 512)), 1)
    number = rows.sparkSession.createDataFrame([(t, a, i) for i, (t, a, _) in enumerate(listed)], "theme_id string, act_type string, g int")
    lists = (rows.join(number, ["theme_id", "act_type"]).groupBy("user_id").agg(F.collect_list(F.struct("g", F.col("n").cast("int").alias("n"))).alias("of"))
             .select("user_id", F.col("of.g").alias("g"), F.col("of.n").alias("n"), F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int").alias("block")))
    dealt = lists.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    dealt = dealt.select("user_id", "g", "n", (F.col("block") == lo).alias("low"), (F.col("block") == hi).alias("high"),
                         (F.call_function("div", hi * (hi + 1), F.lit(2)) + lo).cast("int").alias("pair"))
    placed = dealt.repartitionById(blocks * (blocks + 1) // 2, F.col("pair"))
    return placed.groupBy("pair").applyInPandas(_product(c, p.n_sim_users), "u string, v string, sim double")


def _product(c: np.ndarray, n: int):
    """The n best partners of the users of either block in the other one."""
    def matrix(pdf: pd.DataFrame) -> np.ndarray:
        x = np.zeros((len(pdf), len(c)))
        at = np.repeat(np.arange(len(pdf)), [len(g) for g in pdf.g])
        x[at, np.concatenate(pdf.g.to_list())] = 1 / np.sqrt(np.concatenate(pdf.n.to_list()).astype(float))
        return x

    def best_of(a: np.ndarray, b: np.ndarray, same: bool):
        for at in range(0, len(a), STRIP):
            part = a[at:at + STRIP]
            sim = (part * c) @ b.T
            met = sim > 0
            few = met.sum(axis=1) < n
            if few.any():  # groups that weigh nothing make partners too
                met[few] = (part[few] > 0).astype(np.float32) @ (b > 0).astype(np.float32).T > 0
            if same:
                met[np.arange(len(part)), at + np.arange(len(part))] = False
            rank = np.where(met, np.floor(sim * 1e9 + 0.5), -1.0)
            if len(b) > n:
                met &= rank >= np.partition(rank, len(b) - n, axis=1)[:, len(b) - n, None]
            i, j = np.nonzero(met)
            order = np.lexsort((j, -rank[i, j], i))
            i, j = i[order], j[order]
            keep = np.arange(len(i)) - np.searchsorted(i, i) < n
            yield at + i[keep], j[keep], sim[i[keep], j[keep]]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("user_id")  # positions in the order of ties
        one, two = pdf[pdf.low], pdf[pdf.high]
        same = bool((pdf.low & pdf.high).all())
        out = []
        if len(one) and len(two):
            a, b = matrix(one), matrix(two)
            for x, y, left, right in [(one, two, a, b)] if same else [(one, two, a, b), (two, one, b, a)]:
                u, v = x.user_id.to_numpy(), y.user_id.to_numpy()
                out += [pd.DataFrame({"u": u[i], "v": v[j], "sim": s}) for i, j, s in best_of(left, right, same)]
        return pd.concat(out) if out else pd.DataFrame({"u": [], "v": [], "sim": []})

    return run


def nth_best(sums: DataFrame, n: int) -> DataFrame:
    """(user_id, tau): the n-th best sum of every user with so many partners."""
    return top_n(sums, "u", [F.col("sim").desc()], n).where(F.col("rank") == n).select(F.col("u").alias("user_id"), F.col("sim").alias("tau"))


def tail_norms(tail: DataFrame) -> DataFrame:
    """(user_id, t, m): norm and number of a user's tail rows."""
    return tail.groupBy("user_id").agg(F.sqrt(F.sum(F.col("c") / F.col("n"))).alias("t"), F.count(F.lit(1)).alias("m"))


def _of(state: DataFrame, side: str) -> DataFrame:
    return state.select(F.col("user_id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("tau", "t", "m")))


def candidate_sums(half_sums, mirror, rows: DataFrame, p: Params) -> DataFrame:
    """(u, v, sim), both directions, with every pair that can be among the N
    best of u and its whole similarity."""
    users = rows.select("user_id").distinct().count()
    limit = head_limit(rows, users, p)
    sums = mirror(half_sums(rows.where(F.col("c") > limit), p), "ua", "ub", "u", "v", "sim")
    if limit == -math.inf:
        return sums
    tail = rows.where(F.col("c") <= limit)
    sums = cut_lineage(sums)
    state = cut_lineage(nth_best(sums, p.n_sim_users).join(tail_norms(tail), "user_id", "full"))
    most = state.agg(F.max("t")).first()[0] or 0.0
    few = F.col("tau").isNull() & (F.col("m") > 0)
    opened = state.where(few | (F.col("t") * most + SLACK >= F.col("tau")))
    if opened.isEmpty():
        if most == 0.0:
            return sums
        parts = None
    else:
        new = paired(tail.join(opened.select("user_id", "tau", F.col("t").alias("tu")), "user_id"),
                     tail.join(state.select("user_id", F.col("t").alias("tv")), "user_id"), p)
        new = new.where(F.col("tau").isNull() | (F.col("tu") * F.col("tv") + SLACK >= F.col("tau")))
        parts = new.select("u", "v", F.col("gain").alias("sim"))
        if most == 0.0:
            return sums.unionByName(parts).groupBy("u", "v").agg(F.sum("sim").alias("sim"))
    both = sums.join(_of(state, "u"), "u", "left").join(_of(state, "v"), "v", "left")
    reach = F.coalesce("t_u", F.lit(0.0)) * F.coalesce("t_v", F.lit(0.0))
    formed = F.col("tau_u").isNull() | (reach + SLACK >= F.col("tau_u"))
    both = cut_lineage(both.where(F.col("tau_u").isNull() | (F.col("sim") + reach + SLACK >= F.col("tau_u")))
                       .select("u", "v", "sim", "m_u", "m_v", (~formed & (reach > 0)).alias("ask")))
    out = both.select("u", "v", "sim").unionByName(tail_sums(both.where("ask"), tail))
    out = out if parts is None else out.unionByName(parts)
    return out.groupBy("u", "v").agg(F.sum("sim").alias("sim"))


def tail_sums(pairs: DataFrame, tail: DataFrame) -> DataFrame:
    """(u, v, sim) rows whose sum is what the tail gives to each of ``pairs``:
    the tail rows of the user with fewer are looked up among the other's."""
    first = F.col("m_u") <= F.col("m_v")
    asked = pairs.select("u", "v", F.when(first, F.col("u")).otherwise(F.col("v")).alias("user_id"),
                         F.when(first, F.col("v")).otherwise(F.col("u")).alias("other"))
    one = asked.join(tail.select("user_id", "theme_id", "act_type", "c", "n"), "user_id")
    two = tail.select(F.col("user_id").alias("other"), "theme_id", "act_type", F.col("n").alias("k"))
    return (one.join(two, ["other", "theme_id", "act_type"])
            .groupBy("u", "v").agg(F.sum(F.col("c") / F.sqrt(F.col("n").cast("double") * F.col("k").cast("double"))).alias("sim")))


def best(sums: DataFrame, n: int) -> DataFrame:
    """(user_id, neighbor, rank, sim): the n best of every user."""
    return (top_n(sums, "u", [r9("sim").desc(), F.col("v").asc()], n)
            .select(F.col("u").alias("user_id"), F.col("v").alias("neighbor"), "rank", "sim"))

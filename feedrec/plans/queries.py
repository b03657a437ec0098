"""The registered queries: each takes (spark, sf_dir) and returns a flat
DataFrame over the whole fixture tables. Column names equal the SQL twins'
(``oracle.py``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import age_days, act_weight, nonempty, r6, r9, split_limit
from ..operators import als as A
from ..operators import catalog as C
from ..operators import history as H
from ..operators import hot as HOT
from ..operators import neighbors as NB
from ..operators import profile as PR
from ..operators import seen as SEEN
from ..operators import serving as S
from ..operators import tags as T
from ..operators import usercf as U
from ..params import DEFAULT, EXPORT_ROWS, Params
from ..session import cut_lineage
from ..sources import fixtures as FX
from ..sources.readers import behavior_window, download_window, parse_catalog_lines

P = DEFAULT


class Ctx:
    """Builds the shared intermediate DataFrames of one query lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, p: Params = P,
                 behavior: Callable[[SparkSession, str], DataFrame] = FX.behavior):
        self.spark, self.dir, self.p = spark, sf_dir, p
        self._beh_fn = behavior
        self._memo: dict = {}

    def _m(self, key, fn):
        if key not in self._memo:
            self._memo[key] = fn()
        return self._memo[key]

    def _stored(self, key, fn):
        """A shared intermediate table that several later stages read (the
        original jobs store these as tables too): written once to the
        checkpoint folder, then read back, so no consumer recomputes it."""
        return self._m(("stored", key), lambda: cut_lineage(fn()))

    # sources
    @property
    def beh(self):
        return self._m("beh", lambda: self._beh_fn(self.spark, self.dir))

    @property
    def catalog(self):
        return self._m("catalog", lambda: FX.catalog(self.spark, self.dir))

    @property
    def cf_window(self):
        return behavior_window(self.beh, self.p.day_before(self.p.days_cf))

    @property
    def profile_window(self):
        return behavior_window(self.beh, self.p.datetime_before(self.p.days_profile))

    @property
    def history_dl(self):
        return download_window(self.beh, self.p.day_before(self.p.days_history))

    @property
    def hot_dl(self):
        return download_window(self.beh, self.p.day_before(self.p.days_hot))

    # E1
    @property
    def history(self):
        return self._m("history", lambda: H.build_history(self.history_dl, self.catalog))

    @property
    def hot(self):
        return self._m("hot", lambda: HOT.hot_themes(self.hot_dl, self.catalog, self.p.n_hot))

    @property
    def cf(self):
        def build():
            rows = U.cf_rows(self.cf_window)
            norm = U.user_act_norm(rows)
            heat = U.theme_heat(rows)
            return rows, norm, heat
        return self._m("cf", build)

    @property
    def capped(self):
        rows, norm, heat = self.cf
        return self._m("capped", lambda: U.cap_users(rows, heat, self.p.cap_sample, self.p.seed))

    @property
    def sim(self):
        return self._m("sim", lambda: U.similar_users(self.cf_window, self.p))

    @property
    def history_t(self):
        return self._stored("history", lambda: self.history)

    @property
    def sim_t(self):
        return self._stored("sim", lambda: self.sim)

    @property
    def hot_t(self):
        return self._stored("hot", lambda: self.hot)

    @property
    def candidates(self):
        return self._m("cand", lambda: U.neighbor_candidates(self.sim_t, self.history_t,
                                                            self.p.max_theme_from_sim))

    @property
    def unseen(self):
        def build():
            ids = self._stored("seen ids", lambda: SEEN.theme_ids(self.history_t))
            sets = self._m("seen", lambda: SEEN.seen_sets(self.history_t, ids))
            return SEEN.unseen(self.candidates, ids, sets)
        return self._m("unseen", build)

    @property
    def nb_list(self):
        def build():
            best = NB.best_unseen(self.sim_t, self.history_t, self.p.max_theme_from_sim, self.p.list_size_sim)
            return U.neighbor_list(best, self.hot_t, self.sim_t, self.p.list_size_sim, self.p.dedupe_backfill)
        return self._m("nbl", build)

    # E2
    @property
    def features(self):
        return self._m("features", lambda: T.theme_tag_features(self.catalog))

    @property
    def features_t(self):
        return self._stored("features", lambda: self.features)

    @property
    def simtags(self):
        return self._m("simtags", lambda: T.similar_tags(self.features, self.p))

    @property
    def recall(self):
        return self._m("recall", lambda: T.tag_recall(self.catalog, self.p.max_theme_per_tag))

    @property
    def index(self):
        return self._m("index", lambda: T.tag_index(self.simtags, self.recall))

    @property
    def profile(self):
        return self._m("profile", lambda: PR.user_profile(self.profile_window, self.features, self.p))

    @property
    def index_t(self):
        def build():
            ls, tg = T.tag_index(T.similar_tags(self.features_t, self.p), self.recall_t)
            return cut_lineage(ls), cut_lineage(tg)
        return self._m("index_t", build)

    @property
    def recall_t(self):
        return self._stored("recall", lambda: self.recall)

    @property
    def orig(self):
        ls, tg = self.index
        return self._m("orig", lambda: PR.indexed_profile(self.profile, ls, tg))

    @property
    def orig_t(self):
        ls, tg = self.index_t
        return self._stored("orig", lambda: PR.indexed_profile(
            PR.user_profile(self.profile_window, self.features_t, self.p), ls, tg))

    @property
    def expanded_lists(self):
        """One row a user and hop."""
        ls, tg = self.index_t
        return self._m("expanded_lists", lambda: PR.expand_lists(self.orig_t, ls, tg, self.history_t, self.p))

    @property
    def expanded(self):
        return PR.listed_themes(self.expanded_lists)

    @property
    def lists(self):
        return self._m("lists", lambda: PR.profile_lists(self.expanded_lists, self.orig_t, self.recall_t,
                                                        self.p.n_theme_per_user))

    # E3
    @property
    def merged(self):
        return self._m("merged", lambda: S.serving_merge(S.profile_strings(self.lists),
                                                        S.sim_strings(self.nb_list), self.hot_t,
                                                        self.p.list_size_sim, self.p.n_theme_per_user))

    # E4
    @property
    def als_events(self):
        # read three times: for the ids of users and items and for the ratings
        return self._stored("als_events", lambda: A.als_events(behavior_window(self.beh, self.p.day_before(self.p.days_als))))

    @property
    def als_ids(self):
        def build():
            ev = self.als_events
            return (A.dense_ids(ev, "user_id", "user"), A.dense_ids(ev, "theme_id", "item"))
        return self._m("als_ids", build)

    @property
    def ratings(self):
        users, items = self.als_ids
        return self._m("ratings", lambda: A.als_ratings(self.als_events, users, items, self.p))

    @property
    def ratings_t(self):
        """Narrow rows that the fit and whoever checks it read."""
        return self._stored("ratings", lambda: self.ratings)

    @property
    def als_model(self):
        return self._m("als_model", lambda: A.als_fit(self.ratings_t, self.p))


# ---------------------------------------------------------------- sources

def q_behavior_window(spark, d):
    return Ctx(spark, d).cf_window


def q_download_window(spark, d):
    return Ctx(spark, d).history_dl


def q_catalog_parse(spark, d):
    return Ctx(spark, d).catalog


def new_catalog_lines(spark, d) -> DataFrame:
    """A catalogue update batch derived from ``part``: every part with new
    grade / quality (short line for small parts, so ctime and tags keep the
    old value), new themes for one brand, and a second, conflicting line for
    another brand's themes."""
    p = FX.table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_name", "p_size")
    sid = F.col("p_partkey").cast("string")
    a = p.select(F.array_join(F.slice(F.array(
        sid, F.lit("1"), F.lit("1"), F.col("p_brand"), ((F.col("p_size") + 1) % 5).cast("string"),
        (F.col("p_size") % 2).cast("string"),
        (F.lit(1500000000) + F.col("p_partkey") * 60 + 7).cast("string"), F.col("p_type")),
        F.lit(1), F.when(F.col("p_size") < 25, 6).otherwise(8)), "\t").alias("value"))
    b = p.where(F.col("p_brand") == "Brand#1").select(F.concat_ws(
        "\t", (F.col("p_partkey") + 1000000).cast("string"), F.lit("1"), F.lit("1"), F.col("p_brand"),
        (F.col("p_size") % 5).cast("string"), (F.col("p_partkey") % 2).cast("string"),
        (F.lit(1500000000) + F.col("p_partkey") * 60).cast("string"), FX._tags_expr()).alias("value"))
    c = p.where(F.col("p_brand") == "Brand#2").select(F.concat_ws(
        "\t", sid, F.lit("1"), F.lit("1"), F.col("p_brand"), F.lit("4"), F.lit(""),
        (F.lit(1500000000) + F.col("p_partkey") * 60).cast("string"), F.col("p_type")).alias("value"))
    return a.unionByName(b).unionByName(c)


def upserted_catalog(spark, d):
    return C.upsert_catalog(FX.catalog(spark, d), parse_catalog_lines(new_catalog_lines(spark, d)))


def q_catalog_upsert(spark, d):
    return upserted_catalog(spark, d)


def q_catalog_cells(spark, d):
    return C.catalog_cells(Ctx(spark, d).catalog)


# ---------------------------------------------------------------- history

def q_theme_enrich(spark, d):
    c = Ctx(spark, d)
    themes = c.history_dl.select("theme_id").distinct()
    return C.enrich_theme(themes, c.catalog).select("theme_id", "quality", "grade", "ctime")


def q_user_downloads(spark, d):
    return H.downloads_by_user(Ctx(spark, d).history_dl)


def q_good_bad(spark, d):
    return Ctx(spark, d).history


def q_history_merge(spark, d):
    """Old state: downloads before the last 30 days with the old catalogue;
    new batch: the last 30 days with the updated catalogue (O04)."""
    c = Ctx(spark, d)
    cut = c.p.day_before(30)
    since = c.p.day_before(c.p.days_history)
    old = H.build_history(download_window(c.beh.where(F.col("pt") < cut), since), c.catalog)
    new = H.build_history(download_window(c.beh.where(F.col("pt") >= cut), since), upserted_catalog(spark, d))
    return H.merge_history(old, new)


# ---------------------------------------------------------------- hot list, user CF

def q_hot_themes(spark, d):
    return Ctx(spark, d).hot


def q_user_act_norm(spark, d):
    return Ctx(spark, d).cf[1]


def q_theme_heat(spark, d):
    return Ctx(spark, d).cf[2]


def q_capped_users(spark, d):
    return Ctx(spark, d).capped


def q_pair_contrib(spark, d):
    c = Ctx(spark, d)
    rows, norm, heat = c.cf
    t = U.pair_totals(U.pair_contrib_half(U.members(rows, heat, c.p), norm, c.p))
    return t.select("theme_id", "act_type", "pairs", r6("contrib").alias("contrib"))


def q_similar_users(spark, d):
    return Ctx(spark, d).sim


def q_similar_user_map(spark, d):
    return U.explode_user_map(U.similar_user_map(Ctx(spark, d).sim))


def q_neighbor_candidates(spark, d):
    return Ctx(spark, d).candidates


def q_unseen_candidates(spark, d):
    return Ctx(spark, d).unseen


def q_neighbor_list(spark, d):
    return Ctx(spark, d).nb_list


def q_similar_users_events(spark, d):
    """O12-O16 on the events source: ~100 items with hundreds of users each
    per action, all of them paired."""
    c = Ctx(spark, d, P.with_(as_of="2024-01-31"), behavior=FX.events_behavior)
    return c.sim


# ---------------------------------------------------------------- tags, profile

def q_tag_tokens(spark, d):
    return T.tag_token_rows(Ctx(spark, d).catalog)


def q_theme_tag_features(spark, d):
    return Ctx(spark, d).features


def q_time_decay(spark, d):
    c = Ctx(spark, d)
    rows = c.profile_window.select("user_id", "theme_id", "act_type", "time").distinct()
    age = age_days("time", c.p.as_of, c.p.days_profile)
    return rows.select("user_id", "theme_id", "act_type", "time", age.alias("age"),
                       r9(F.lit(1.0) / (F.lit(1.0) + F.lit(c.p.time_decay) * age)).alias("decay"))


def q_act_weight(spark, d):
    c = Ctx(spark, d)
    g = c.beh.groupBy("act_type").agg(F.count(F.lit(1)).alias("n"))
    return g.select("act_type", "n", act_weight("act_type", c.p.scan_factor, c.p.download_factor).alias("weight"),
                    act_weight("act_type", c.p.als_scan, c.p.als_download).alias("als_weight"))


def q_user_profile(spark, d):
    return Ctx(spark, d).profile.select("user_id", "tag", "weight")


def q_normalized_weights(spark, d):
    return Ctx(spark, d).profile.select("user_id", "tag", "rank", "raw", "weight")


def q_similar_tags(spark, d):
    return Ctx(spark, d).simtags


def q_tag_recall(spark, d):
    return Ctx(spark, d).recall.drop("tokens")


def q_tag_index(spark, d):
    ls, tg = Ctx(spark, d).index
    return T.tag_index_rows(ls, tg)


def q_profile_recall(spark, d):
    c = Ctx(spark, d)
    ls, _ = c.index_t
    return PR.profile_recall(c.orig_t, ls)


def q_profile_extend(spark, d):
    c = Ctx(spark, d)
    _, tg = c.index_t
    # products of two stored 6-decimal weights are exact at 12 decimals; a
    # 6-digit rounding would sit exactly on .5 and depend on the engine
    return PR.step_profile(c.orig_t, tg, exclude=False).select("user_id", "tag", F.round("weight", 12).alias("weight"))


def q_profile_expand(spark, d):
    return Ctx(spark, d).expanded


def q_profile_lists(spark, d):
    return Ctx(spark, d).lists


# ---------------------------------------------------------------- serving

def q_serving_merge(spark, d):
    return Ctx(spark, d).merged


def q_serving_cells(spark, d):
    return S.serving_cells(Ctx(spark, d).merged)


def q_sorted_export(spark, d):
    """O06 with split points from the table's own keys and weights."""
    c = Ctx(spark, d)
    cells = cut_lineage(S.serving_cells(c.merged))
    starts, files = S.split_points(cells, EXPORT_ROWS)
    return S.placed_rows(S.export_sorted(cells, starts, files, files_per_task=S.files_per_task(EXPORT_ROWS)))


# ---------------------------------------------------------------- ALS

def q_als_ids(spark, d):
    users, items = Ctx(spark, d).als_ids
    return (users.select(F.lit("user").alias("kind"), F.col("user_id").alias("key"), F.col("user").alias("id"))
            .unionByName(items.select(F.lit("item").alias("kind"), F.col("theme_id").alias("key"),
                                      F.col("item").alias("id"))))


def q_als_ratings(spark, d):
    return Ctx(spark, d).ratings.select("user", "item", r9("rating").alias("rating"))


def _factor_rows(factors):
    f = A.als_factors(factors)
    fine = F.forall("features", lambda v: ~F.isnan(v) & (F.abs(v) < float("inf")))
    return f.select("id", F.size("features").cast("long").alias("n_features"), fine.alias("finite"))


def q_als_user_factors(spark, d):
    return _factor_rows(Ctx(spark, d).als_model.userFactors)


def q_als_item_factors(spark, d):
    return _factor_rows(Ctx(spark, d).als_model.itemFactors)


def q_als_normal_equations(spark, d):
    """Every user's factors solve the user's linear system."""
    c = Ctx(spark, d)
    return A.normal_equations(c.als_model, c.ratings_t, c.p).select("id", (F.col("residual") < 1e-3).alias("solved"))


def q_als_predictions(spark, d):
    """Each training pair's prediction is the dot product of its factors."""
    c = Ctx(spark, d)
    same = F.abs(F.col("prediction") - F.col("dot")) < 1e-4
    return A.dot_check(c.als_model, c.ratings_t).select("user", "item", r9("rating").alias("rating"), same.alias("is_dot"))


def q_als_mse(spark, d):
    """The mean squared error equals that of the factors' dot products."""
    c = Ctx(spark, d)
    ratings = c.ratings_t
    m = A.als_mse(A.als_predict(c.als_model, ratings))
    again = A.dot_check(c.als_model, ratings).agg(F.avg(F.pow(F.col("rating") - F.col("dot"), 2)).alias("v"))
    return m.select("n", (F.abs(F.col("mse") - again.scalar()) < 1e-4).alias("same"))


def q_split_limit(spark, d):
    p = FX.table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    line = F.concat_ws("::", F.col("p_partkey").cast("string"), "p_name", "p_type", "p_brand")
    a = split_limit(line, "::", 2)
    return p.select(line.alias("line"), F.get(a, 0).alias("head"), F.get(a, 1).alias("rest"),
                    F.size(a).cast("long").alias("n_parts"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "behavior_window": q_behavior_window,
    "download_window": q_download_window,
    "catalog_parse": q_catalog_parse,
    "catalog_upsert": q_catalog_upsert,
    "catalog_cells": q_catalog_cells,
    "theme_enrich": q_theme_enrich,
    "user_downloads": q_user_downloads,
    "good_bad": q_good_bad,
    "history_merge": q_history_merge,
    "hot_themes": q_hot_themes,
    "user_act_norm": q_user_act_norm,
    "theme_heat": q_theme_heat,
    "capped_users": q_capped_users,
    "pair_contrib": q_pair_contrib,
    "similar_users": q_similar_users,
    "similar_user_map": q_similar_user_map,
    "similar_users_events": q_similar_users_events,
    "neighbor_candidates": q_neighbor_candidates,
    "unseen_candidates": q_unseen_candidates,
    "neighbor_list": q_neighbor_list,
    "tag_tokens": q_tag_tokens,
    "theme_tag_features": q_theme_tag_features,
    "time_decay": q_time_decay,
    "act_weight": q_act_weight,
    "user_profile": q_user_profile,
    "normalized_weights": q_normalized_weights,
    "similar_tags": q_similar_tags,
    "tag_recall": q_tag_recall,
    "tag_index": q_tag_index,
    "profile_recall": q_profile_recall,
    "profile_extend": q_profile_extend,
    "profile_expand": q_profile_expand,
    "profile_lists": q_profile_lists,
    "serving_merge": q_serving_merge,
    "serving_cells": q_serving_cells,
    "sorted_export": q_sorted_export,
    "als_ids": q_als_ids,
    "als_ratings": q_als_ratings,
    "als_user_factors": q_als_user_factors,
    "als_item_factors": q_als_item_factors,
    "als_normal_equations": q_als_normal_equations,
    "als_predictions": q_als_predictions,
    "als_mse": q_als_mse,
    "split_limit": q_split_limit,
}

"""User tag profile (O25), recall through the tag index (O30), profile
extension (O31), iterative expansion (O32) and the two lists (O33)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import act_weight, nonempty, r6, r9, time_decay
from ..functions.ranking import normalize, top_n
from ..params import Params
from ..session import bucketed, cut_lineage, joins_on_part_of_keys

PLACES = 16  # profile entries that are scored as one term each


def profile_records(beh_window: DataFrame, features: DataFrame) -> DataFrame:
    """Distinct behaviour rows with their theme's tag set, one array per theme,
    joined once. Records of one user with equal (act, time, tag set) collapse
    into one (the original keeps them in a set).
    Output (user_id, act_type, time, tags, record_n)."""
    rows = (beh_window.where(nonempty("user_id") & nonempty("theme_id"))
            .select("user_id", "act_type", "time", "theme_id").distinct())
    sets = features.groupBy("theme_id").agg(F.array_sort(F.collect_set(F.struct("tag", "tag_n"))).alias("tags"))
    rec = rows.join(sets, "theme_id").select("user_id", "act_type", "time", "tags").distinct()
    rec_n = rec.groupBy("user_id").agg(F.count(F.lit(1)).alias("record_n"))
    return rec.join(rec_n, "user_id")


def profile_weights(beh_window: DataFrame, features: DataFrame, p: Params) -> DataFrame:
    """O25 before ranking: weight(user, tag) = sum over records of
    act * decay * 1 / (1 + c * max(0, log10(tag_n div record_n))), with
    *integer* division; log10 is only taken when the quotient exceeds 1."""
    j = (profile_records(beh_window, features)
         .select("user_id", "act_type", "time", "record_n", F.inline("tags")))
    q = (F.col("tag_n") / F.col("record_n")).cast("long")
    cost = F.when(q > 1, F.log10(q.cast("double"))).otherwise(F.lit(0.0))
    heat = F.lit(1.0) / (F.lit(1.0) + F.lit(float(p.contingency)) * cost)
    w = (act_weight("act_type", p.scan_factor, p.download_factor)
         * time_decay("time", p.as_of, p.time_decay, p.days_profile) * heat)
    return j.select("user_id", "tag", w.alias("w")).groupBy("user_id", "tag").agg(F.sum("w").alias("raw"))


def user_profile(beh_window: DataFrame, features: DataFrame, p: Params) -> DataFrame:
    """O25 + O26: top ``max_profile_tag`` tags per user, normalised to
    [0.1, 1]. Output (user_id, tag, rank, raw, weight), weights rounded."""
    raw = profile_weights(beh_window, features, p)
    top = top_n(raw, "user_id", [r9("raw").desc(), F.col("tag").asc()], p.max_profile_tag)
    norm = normalize(top, "user_id", "tag", "raw")
    return norm.select("user_id", "tag", "rank", r6("raw").alias("raw"), r6("weight").alias("weight"))


def profile_map(profile: DataFrame) -> DataFrame:
    """Nested form user -> map<tag, weight> (at most K entries)."""
    return profile.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", "weight"))).alias("profile_tag"))


def indexed_profile(profile: DataFrame, ls: DataFrame, tg: DataFrame) -> DataFrame:
    """O30 first half: profile tags (non-empty) that the index knows; a user
    left without tags drops out. This is the profile used for scoring."""
    idx = ls.select("tag").distinct().join(tg.select("tag").distinct(), "tag")
    return (profile.where(nonempty("tag")).select("user_id", "tag", "weight")
            .join(idx, "tag", "left_semi"))


def recall_themes(tags: DataFrame, ls: DataFrame) -> DataFrame:
    """Themes on the recall lists of the given (user, tag) rows, one row per
    (user, theme)."""
    return (tags.where(nonempty("tag")).select("user_id", "tag")
            .join(ls.select("tag", "theme_id"), "tag").select("user_id", "theme_id").distinct())


def profile_recall(orig: DataFrame, ls: DataFrame) -> DataFrame:
    """(user_id, theme_id) recalled by the user's indexed tags."""
    return recall_themes(orig, ls)


def step_profile(frontier: DataFrame, tg: DataFrame, exclude: bool) -> DataFrame:
    """Extended weight of a similar tag = sum over frontier tags of
    similarity * weight. Later hops drop tags of the current frontier."""
    nxt = (frontier.where(nonempty("tag")).select("user_id", "tag", "weight")
           .join(tg.select("tag", "sim_tag", F.col("weight").alias("sim")), "tag")
           .groupBy("user_id", "sim_tag").agg(F.sum(F.col("weight") * F.col("sim")).alias("weight"))
           .withColumnRenamed("sim_tag", "tag"))
    if exclude:
        nxt = nxt.join(frontier.select("user_id", "tag"), ["user_id", "tag"], "left_anti")
    return nxt


def expand_recall(orig: DataFrame, ls: DataFrame, tg: DataFrame, history: DataFrame,
                  p: Params) -> DataFrame:
    """Start from the recalled themes minus history and the extended
    profile as frontier; while a user has fewer than ``min_recall`` themes and
    some frontier weight >= ``min_profile_weight``: add the recall lists of
    all frontier tags (minus history) and step the frontier one hop.

    A user also retires when the set of its frontier's tags comes back: the
    tags of the next frontier depend on the current ones alone, so no new theme
    can follow. There is no hop limit; the loop ends when no user is active.

    All users advance together. A user is one row: the themes known (recalled or in the
    history, as far as any recall list has them) are an array, and a hop's new
    themes are those of the frontier's lists that it does not hold. Every table of a hop
    (frontier, new themes, state) is bucketed by user, so a hop's joins and sums
    on users need no exchange; only the tag index meets the frontier by tag, as a
    broadcast where it is small. Written tables keep the plan small, and a lost
    executor does not replay earlier hops. Output (user_id, theme_id, hop)."""
    return listed_themes(expand_lists(orig, ls, tg, history, p))


def expand_lists(orig: DataFrame, ls: DataFrame, tg: DataFrame, history: DataFrame, p: Params) -> DataFrame:
    """``expand_recall`` with the themes of a user's hop as an array, one row:
    (user_id, themes, hop), bucketed by user."""
    with joins_on_part_of_keys(orig.sparkSession):
        return _expand(orig, ls, tg, history, p)


def listed_themes(lists: DataFrame) -> DataFrame:
    """The rows of ``expand_recall`` from those of ``expand_lists``."""
    return lists.select("user_id", F.explode("themes").alias("theme_id"), "hop")


def _signature(frontier: DataFrame) -> DataFrame:
    return frontier.groupBy("user_id").agg(F.max(r9("weight")).alias("m"), F.sort_array(F.collect_set("tag")).alias("sig"))


def _listed(tags: DataFrame, lists: DataFrame) -> DataFrame:
    """(user_id, got): the themes on the lists of a user's tags, one row a user."""
    return (tags.where(nonempty("tag")).select("user_id", "tag").join(lists, "tag")
            .groupBy("user_id").agg(F.array_distinct(F.flatten(F.collect_list("themes"))).alias("got")))


def _expand(orig: DataFrame, ls: DataFrame, tg: DataFrame, history: DataFrame, p: Params) -> DataFrame:
    user, empty = "user_id", F.array().cast("array<string>")
    lists = cut_lineage(ls.groupBy("tag").agg(F.collect_set("theme_id").alias("themes")))
    past = bucketed(history.select(user, "theme_id").join(ls.select("theme_id").distinct(), "theme_id", "left_semi")
                    .groupBy(user).agg(F.collect_set("theme_id").alias("past")), user)
    start = _listed(orig, lists).join(past, user, "left").withColumn("past", F.coalesce("past", empty))
    parts = [bucketed(start.select(user, F.array_except("got", "past").alias("themes"), "past", F.lit(0).alias("hop")), user)]
    frontier = bucketed(step_profile(orig, tg, exclude=False), user)
    none = F.array().cast("array<array<string>>")
    state = (_signature(frontier).join(parts[0].select(user, "themes", "past"), user, "left").withColumn("seen", none)
             .withColumn("c", F.size(F.coalesce("themes", empty)))
             .withColumn("known", F.concat(F.coalesce("themes", empty), F.coalesce("past", empty))))
    hop = 0
    while True:
        active = ((F.col("m") >= F.lit(float(p.min_profile_weight))) & (F.col("c") < p.min_recall)
                  & ~F.array_contains("seen", F.col("sig")))
        state = bucketed(state.where(active).select(user, "c", "known", F.concat("seen", F.array("sig")).alias("seen")), user)
        if state.isEmpty():
            out = parts[0].select(user, "themes", "hop")
            for part in parts[1:]:
                out = out.unionByName(part)
            return out.select(user, "themes", F.col("hop").cast("long").alias("hop"))
        hop += 1
        on = frontier.join(state.select(user), user, "left_semi")
        part = bucketed(_listed(on, lists).join(state.select(user, "known"), user)
                        .select(user, F.array_except("got", "known").alias("themes"), F.lit(hop).alias("hop")), user)
        parts.append(part)
        frontier = bucketed(step_profile(on, tg, exclude=True), user)
        state = (_signature(frontier).join(state, user).join(part.select(user, F.col("themes").alias("more")), user, "left")
                 .withColumn("more", F.coalesce("more", empty)).withColumn("c", F.col("c") + F.size("more"))
                 .withColumn("known", F.concat("known", "more")))


def profile_lists(cand: DataFrame, orig: DataFrame, recall: DataFrame, n: int) -> DataFrame:
    """score = sum of the user's indexed profile weights over the
    theme's tags; order (score, quality, ctime) descending; the first ``n``
    form the profile list and the last ``n``, reversed, the extend list.
    A profile has at most ``max_profile_tag`` entries, so it is one row per
    user and each candidate is scored in its own row, in tag order. The orders of
    both lists are each other's reverse: a user's candidates are sorted once.
    ``cand``: rows (user_id, theme_id), or those of ``expand_lists``, which meet the
    profile as one row a hop, so that neither candidates nor profiles are sorted for it.
    Output (user_id, list, pos, theme_id)."""
    attrs = recall.select("theme_id", "quality", "ctime", "tokens").dropDuplicates(["theme_id"])
    tags = orig.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("tag", "weight"))).alias("tags"))
    places = tags.agg(F.max(F.size("tags"))).first()[0] or 0
    if "themes" in cand.columns:
        c = (cand.select("user_id", "themes").join(tags, "user_id", "left")
             .select("user_id", "tags", F.explode("themes").alias("theme_id")).join(attrs, "theme_id"))
    else:
        c = cand.select("user_id", "theme_id").join(attrs, "theme_id").join(tags, "user_id", "left")
    score = F.lit(0.0)
    if places <= PLACES:  # one term a place is compiled code, a lambda over the profile is not
        for i in range(places):
            tag = F.get("tags", F.lit(i))
            score = score + F.when(F.array_contains("tokens", tag["tag"]), tag["weight"]).otherwise(0.0)
    else:
        own = F.filter(F.coalesce("tags", F.array().cast("array<struct<tag:string,weight:double>>")),
                       lambda t: F.array_contains("tokens", t["tag"]))
        score = F.aggregate(own, F.lit(0.0), lambda s, t: s + t["weight"])
    s = c.select("user_id", "theme_id", "quality", "ctime", score.alias("score"))
    s = s.withColumn("score", F.when(F.col("score") == 0, F.col("score")).otherwise(r9("score")))  # most are 0, rounding is dear
    w = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("quality").desc(), F.col("ctime").desc(), F.col("theme_id").asc())
    s = s.select("user_id", "theme_id", F.row_number().over(w).cast("long").alias("at"),
                 F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("of"))
    back = F.col("of") - F.col("at") + 1
    both = F.array_compact(F.array(
        F.when(F.col("at") <= n, F.struct(F.lit("profile").alias("list"), F.col("at").alias("pos"))),
        F.when(back <= n, F.struct(F.lit("extend").alias("list"), back.alias("pos")))))
    return (s.where((F.col("at") <= n) | (back <= n)).select("user_id", "theme_id", F.inline(both))
            .select("user_id", "list", "pos", "theme_id"))


def profile_list_text(lists: DataFrame, sep: str = "\u0002") -> DataFrame:
    """``user \\t profile \\t extend`` lines."""
    def joined(name):
        return F.array_join(F.transform(F.sort_array(F.collect_list(
            F.when(F.col("list") == name, F.struct("pos", "theme_id")))), lambda x: x["theme_id"]), sep)
    g = lists.groupBy("user_id").agg(joined("profile").alias("profile"), joined("extend").alias("extend"))
    return g.select(F.concat_ws("\t", "user_id", "profile", "extend").alias("value"))

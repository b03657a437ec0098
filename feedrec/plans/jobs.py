"""The four batch jobs, with the original stage names as options.

    python -m feedrec.plans.jobs simuser  --sf-dir D --out O --stages makeHotList,makeRecommendList
    python -m feedrec.plans.jobs profile  --sf-dir D --out O --stages updateProfile,updateSimTagAndRecallTheme,makeRecommendList
    python -m feedrec.plans.jobs serving  --sf-dir D --out O
    python -m feedrec.plans.jobs als      --sf-dir D --out O

Inputs are the behaviour table and the catalogue (``--behavior`` parquet and
``--catalog`` text, or the fixture views of ``--sf-dir``). Every output is a
Parquet table (or text file, for the list formats) under ``--out``, written
with ``mode('overwrite')``; later jobs read what earlier jobs wrote, as the
original programs pass tables to each other. The tables that a job both reads
and updates (catalogue, download history, similar users) are versioned
(``versions.py``); the stages after an update read the version just written.

``--set name=value`` (repeatable) or ``--settings FILE`` sets any field of
``Params``. Results are also kept by job date under ``<out>/daily``, and with
``--database DB`` as tables of that database, partitioned by ``dt``: a second run of a
day replaces that day only (``daily.py``). Each job counts the rows it cannot
use in ``<out>/dropped``, by date and job in ``<out>/daily/dropped``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import als as A
from ..operators import catalog as C
from ..operators import history as H
from ..operators import hot as HOT
from ..operators import neighbors as NB
from ..operators import profile as PR
from ..operators import serving as S
from ..operators import tags as T
from ..functions.columns import java_split, nonempty
from ..operators import usercf as U
from ..params import DEFAULT, Params
from ..sources import fixtures as FX
from ..sources.readers import (behavior_window, download_window, read_catalog,
                               read_profile_list, read_sim_list)
from . import daily as D
from . import versions as V


class Inputs:
    def __init__(self, spark: SparkSession, out: str, sf_dir: str | None = None,
                 behavior: str | None = None, catalog: str | None = None,
                 behavior_table: str | None = None, database: str | None = None):
        self.spark, self.out, self.sf_dir, self.database = spark, out, sf_dir, database
        self._beh, self._cat, self._beh_table = behavior, catalog, behavior_table

    def path(self, name: str) -> str:
        return os.path.join(self.out, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    @property
    def behavior(self) -> DataFrame:
        if self._beh_table:
            # a catalogue table, e.g. "db.userbehavior" partitioned by pt
            return self.spark.table(self._beh_table)
        if self._beh:
            return self.spark.read.parquet(self._beh)
        return FX.behavior(self.spark, self.sf_dir)

    @property
    def catalog(self) -> DataFrame:
        stored = V.read(self.spark, self.path("catalog"))
        if stored is not None:
            return stored
        if self._cat:
            return read_catalog(self.spark, self._cat)
        return FX.catalog(self.spark, self.sf_dir)


    def history(self, p: Params) -> DataFrame:
        """The merged download history, or the window's own where none is kept."""
        stored = V.read(self.spark, self.path("history"))
        return stored if stored is not None else H.build_history(
            download_window(self.behavior, p.day_before(p.days_history)), self.catalog)

    def publish(self, name: str, p: Params, *others: str) -> None:
        """Keep a result by job date, in ``<out>/daily`` and in the database, if one was named."""
        df = self.table(name)
        D.overwrite_day(df, self.path(os.path.join("daily", name)), p.as_of, *others)
        if self.database:
            D.overwrite_table_day(df, f"{self.database}.{name}", p.as_of, *others)

    def count_rejected(self, job: str, p: Params, rows: DataFrame) -> None:
        """Write and publish what a job left out: (source, reason, n)."""
        write(rows.select(F.lit(job).alias("job"), "source", "reason", F.col("n").cast("long").alias("n")), self.path("dropped"))
        self.publish("dropped", p, "job")


def write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def counts(source: str, df: DataFrame, **reasons) -> DataFrame:
    """(source, reason, n): rows of ``df`` for which each condition holds."""
    names = {r.replace("_", " "): c for r, c in reasons.items()}
    return (df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(r) for r, c in names.items()))
            .unpivot([], list(names), "reason", "n").select(F.lit(source).alias("source"), "reason", "n"))


def behavior_dropped(beh: DataFrame) -> DataFrame:
    return counts("behavior", beh, no_user=~nonempty("user_id"),
                  no_theme=nonempty("user_id") & ~nonempty("theme_id"))


def catalog_dropped(inp: Inputs) -> DataFrame:
    rows = counts("catalog", inp.catalog, missing_field=F.greatest(*[F.col(c).isNull() for c in T.REQUIRED]))
    if inp._cat:
        key = F.get(java_split(F.col("value"), "\t"), 0)
        rows = rows.unionByName(counts("catalog", inp.spark.read.text(inp._cat), no_id=key.isNull() | (key == "")))
    return rows


def lists_dropped(inp: Inputs) -> DataFrame:
    """Lines of the two list files that are no list: too few fields, no user."""
    fields = F.size(java_split(F.col("value"), "\t"))
    user = F.get(java_split(F.col("value"), "\t"), 0)
    prof, sim = (inp.spark.read.text(inp.path(x)) for x in ("profile_list_txt", "sim_list_txt"))
    return (counts("profile list", prof, not_three_fields=fields != 3)
            .unionByName(counts("similar list", sim, no_list=fields < 2, no_user=(fields >= 2) & (user == ""))))


def export(inp: Inputs, cells: DataFrame, p: Params, name: str) -> None:
    """Key-range files, split points and file count from the table's own keys."""
    starts, files = S.split_points(cells, p.rows_per_file)
    S.export_sorted(cells, starts, files, inp.path(name))


def simuser_job(inp: Inputs, p: Params, stages: set[str], new_catalog: str | None = None) -> None:
    if "updateTheme" in stages and new_catalog:
        cat = V.replace(C.upsert_catalog(inp.catalog, read_catalog(inp.spark, new_catalog)), inp.path("catalog"))
        export(inp, C.catalog_cells(cat), p, "catalog_cells")
    beh = inp.behavior
    if "updateDownloadHistory" in stages:
        new = H.build_history(download_window(beh, p.day_before(p.days_history)), inp.catalog)
        old = V.read(inp.spark, inp.path("history"))
        V.replace(new if old is None else H.merge_history(old, new), inp.path("history"))
    if "makeHotList" in stages:
        write(HOT.hot_themes(download_window(beh, p.day_before(p.days_hot)), inp.catalog, p.n_hot),
              inp.path("hot_themes"))
        inp.publish("hot_themes", p)
    stored = V.read(inp.spark, inp.path("similar_users"))
    sim = stored if "existSimUserData" in stages else None
    if "loadSimUserDataIntoHive" in stages or (sim is None and "makeRecommendList" in stages):
        fresh = U.similar_users(behavior_window(beh, p.day_before(p.days_cf)), p)
        if "loadSimUserDataIntoHive" in stages:  # always the newly computed result
            fresh = V.replace(fresh, inp.path("similar_users"))
            write(U.similar_user_map(fresh), inp.path("similar_user_map"))
            inp.publish("similar_user_map", p)
        # the list reads the table that was there before, where that is asked for
        sim = fresh if sim is None else sim
    if "makeRecommendList" in stages:
        hist = inp.history(p)
        unseen = NB.best_unseen(sim, hist, p.max_theme_from_sim, p.list_size_sim)
        lst = U.neighbor_list(unseen, inp.table("hot_themes"), sim, p.list_size_sim, p.dedupe_backfill)
        write(lst, inp.path("neighbor_list"))
        inp.publish("neighbor_list", p)
        U.neighbor_list_text(inp.table("neighbor_list")).write.mode("overwrite").text(inp.path("sim_list_txt"))
    window = behavior_window(beh, p.day_before(max(p.days_cf, p.days_history, p.days_hot)))
    inp.count_rejected("simuser", p, behavior_dropped(window).unionByName(catalog_dropped(inp)))


def profile_job(inp: Inputs, p: Params, stages: set[str]) -> None:
    beh = inp.behavior
    feats = T.theme_tag_features(inp.catalog)
    if "updateProfile" in stages:
        write(PR.user_profile(behavior_window(beh, p.datetime_before(p.days_profile)), feats, p),
              inp.path("user_profile"))
        inp.publish("user_profile", p)
    if "updateSimTagAndRecallTheme" in stages:
        ls, tg = T.tag_index(T.similar_tags(feats, p), T.tag_recall(inp.catalog, p.max_theme_per_tag))
        write(ls, inp.path("tag_ls"))
        write(tg, inp.path("tag_tg"))
        cells = (T.tag_index_nested(inp.table("tag_ls"), inp.table("tag_tg"))
                 .select(F.col("tag").alias("rowkey"), F.lit("a").alias("family"),
                         F.to_json("ls").alias("ls"), F.to_json("tg").alias("tg"))
                 .unpivot(["rowkey", "family"], ["ls", "tg"], "qualifier", "value"))
        export(inp, cells, p, "tag_index_cells")
    if "makeRecommendList" in stages:
        ls, tg = inp.table("tag_ls"), inp.table("tag_tg")
        orig = PR.indexed_profile(inp.table("user_profile"), ls, tg)
        write(orig, inp.path("indexed_profile"))
        orig = inp.table("indexed_profile")
        hist = inp.history(p)
        cand = PR.expand_lists(orig, ls, tg, hist, p)
        write(PR.profile_lists(cand, orig, ls, p.n_theme_per_user), inp.path("profile_lists"))
        inp.publish("profile_lists", p)
        PR.profile_list_text(inp.table("profile_lists")).write.mode("overwrite").text(inp.path("profile_list_txt"))
    window = behavior_window(beh, p.datetime_before(p.days_profile))
    inp.count_rejected("profile", p, behavior_dropped(window).unionByName(catalog_dropped(inp)))


def serving_job(inp: Inputs, p: Params) -> None:
    prof = read_profile_list(inp.spark, inp.path("profile_list_txt"))
    sim = read_sim_list(inp.spark, inp.path("sim_list_txt"))
    merged = S.serving_merge(prof, sim, inp.table("hot_themes"), p.list_size_sim, p.n_theme_per_user)
    write(merged, inp.path("serving"))
    inp.publish("serving", p)
    export(inp, S.serving_cells(inp.table("serving")), p, "serving_cells")
    inp.count_rejected("serving", p, lists_dropped(inp))


def als_job(inp: Inputs, p: Params) -> None:
    window = behavior_window(inp.behavior, p.day_before(p.days_als))
    ev = A.als_events(window)
    write(A.dense_ids(ev, "user_id", "user"), inp.path("als_users"))
    write(A.dense_ids(ev, "theme_id", "item"), inp.path("als_items"))
    ratings = A.als_ratings(ev, inp.table("als_users"), inp.table("als_items"), p)
    A.ratings_text(ratings).write.mode("overwrite").text(inp.path("ratings_txt"))
    r = A.parse_ratings_text(inp.spark.read.text(inp.path("ratings_txt")))
    model = A.als_fit(r, p)
    for name, f in [("user_features", model.userFactors), ("item_features", model.itemFactors)]:
        A.als_factors(f).select(F.concat_ws(",", F.col("id").cast("string"), "features_text").alias("value")) \
            .write.mode("overwrite").text(inp.path(name))
    pred = A.als_predict(model, r)
    pred.select(F.concat_ws("::", "user", "item", F.col("prediction").cast("string")).alias("value")) \
        .write.mode("overwrite").text(inp.path("predictions"))
    write(A.als_mse(pred), inp.path("als_mse"))
    inp.publish("als_mse", p)
    inp.count_rejected("als", p, behavior_dropped(window))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="feedrec.plans.jobs")
    ap.add_argument("job", choices=["simuser", "profile", "serving", "als"])
    ap.add_argument("--out", required=True)
    ap.add_argument("--sf-dir")
    ap.add_argument("--behavior")
    ap.add_argument("--behavior-table")
    ap.add_argument("--catalog")
    ap.add_argument("--new-catalog")
    ap.add_argument("--as-of", default=DEFAULT.as_of)
    ap.add_argument("--stages", default="")
    ap.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", dest="settings")
    ap.add_argument("--settings", dest="file", help="a file of NAME=VALUE lines")
    ap.add_argument("--database")
    a = ap.parse_args(argv)
    from ..session import build_session, drop_run_tables, ensure_checkpoint_dir

    spark = build_session()
    ensure_checkpoint_dir(spark)
    lines = open(a.file).read().splitlines() if a.file else []
    lines = [x for x in lines if x.strip() and not x.lstrip().startswith("#")]
    p = DEFAULT.with_(as_of=a.as_of).with_text(lines + a.settings)
    inp = Inputs(spark, a.out, a.sf_dir, a.behavior, a.catalog, a.behavior_table, a.database)
    stages = set(filter(None, a.stages.split(",")))
    if a.job == "simuser":
        simuser_job(inp, p, stages, a.new_catalog)
    elif a.job == "profile":
        profile_job(inp, p, stages)
    elif a.job == "serving":
        serving_job(inp, p)
    else:
        als_job(inp, p)
    drop_run_tables(spark)


if __name__ == "__main__":
    main()

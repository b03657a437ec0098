"""Results by job date, table sinks, and what each job counts as dropped."""

import os
import tempfile

import pytest

from feedrec.params import DEFAULT
from feedrec.plans import daily as D
from feedrec.plans import jobs as J

BEH = "time string, theme_id string, user_id string, act_type string, pt string"


def test_a_day_is_replaced_alone(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="feedrec-daily-"), "r")
    frame = lambda rows: spark.createDataFrame(rows, "k string, n int")
    D.overwrite_day(frame([("a", 1), ("b", 2)]), path, "2001-07-01")
    D.overwrite_day(frame([("a", 3)]), path, "2001-07-02")
    D.overwrite_day(frame([("c", 4)]), path, "2001-07-01")
    assert sorted(map(tuple, D.read_days(spark, path).collect())) == [("a", 3, "2001-07-02"), ("c", 4, "2001-07-01")]
    one = D.read_days(spark, path, "2001-07-02")
    assert [tuple(r) for r in one.collect()] == [("a", 3, "2001-07-02")]
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        D.overwrite_day(spark.sql("select 1 as dt"), path, "2001-07-01")
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"


def test_table_days_and_old_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS feedrec_days")
    try:
        frame = lambda rows: spark.createDataFrame(rows, "k string, n int, job string")
        for day, rows in (("1", [("a", 1, "x")]), ("2", [("a", 2, "x")]), ("1", [("b", 3, "y")]), ("2", [("c", 4, "x")])):
            D.overwrite_table_day(frame(rows), "feedrec_days.r", day, "job")
        # day 1 was written by two jobs, day 2 twice by one
        assert sorted((r.k, r.n, r.job, r.dt) for r in spark.table("feedrec_days.r").collect()) == [
            ("a", 1, "x", "1"), ("b", 3, "y", "1"), ("c", 4, "x", "2")]
        frame([("old", 0, "z")]).write.saveAsTable("feedrec_days.plain")
        D.overwrite_table_day(frame([("new", 1, "z")]), "feedrec_days.plain", "1")
        assert [tuple(r) for r in spark.table("feedrec_days.plain").collect()] == [("new", 1, "z")]
        assert spark.conf.get(D.DYNAMIC[0]).lower() == "static"
    finally:
        spark.sql("DROP DATABASE feedrec_days CASCADE")


def _beh(spark, path, rows):
    spark.createDataFrame([(f"{day} 10:00:00", t, u, a, day) for day, t, u, a in rows], BEH).write.parquet(path)
    return path


def test_two_days_of_jobs(spark, sf):
    out = tempfile.mkdtemp(prefix="feedrec-daily-jobs-")
    rows = [("2001-07-01", str(t), u, a) for t in (1, 2, 4, 8) for u in "abc" for a in ("Download", "Scan")]
    bad = [("2001-07-01", "1", None, "Scan"), ("2001-07-01", "1", "", "Scan"), ("2001-07-01", None, "a", "Scan"), ("2001-07-01", "", "", "Scan")]
    beh = _beh(spark, os.path.join(out, "in"), rows + bad)
    cat = os.path.join(out, "cat")
    spark.createDataFrame([(f"{i}\t1\t1\tu{i % 2}\t4\t1\t{1500000000 + i}\ttag{i % 3},x",) for i in range(1, 9)] + [("\t1\t1",), ("9\t1\t1\tu\t4",)],
                          "value string").coalesce(1).write.text(cat)
    spark.sql("CREATE DATABASE IF NOT EXISTS feedrec_jobs")
    try:
        inp = J.Inputs(spark, out, behavior=beh, catalog=cat, database="feedrec_jobs")
        sim = {"makeHotList", "loadSimUserDataIntoHive", "makeRecommendList"}
        for day, hot in (("2001-07-02", 3), ("2001-07-03", 2), ("2001-07-02", 1)):
            J.simuser_job(inp, DEFAULT.with_(as_of=day, n_hot=hot), sim)
        p = DEFAULT.with_(as_of="2001-07-02")
        J.profile_job(inp, p, {"updateProfile", "updateSimTagAndRecallTheme", "makeRecommendList"})
        spark.read.text(inp.path("profile_list_txt")).unionByName(spark.createDataFrame([("u\tonly two",), ("x",)], "value string")) \
            .write.text(inp.path("with_bad"))
        os.rename(inp.path("profile_list_txt"), inp.path("was"))
        os.rename(inp.path("with_bad"), inp.path("profile_list_txt"))
        J.serving_job(inp, p)
        J.als_job(inp, p)
        per_day = {r.dt: r["count"] for r in spark.table("feedrec_jobs.hot_themes").groupBy("dt").count().collect()}
        assert per_day == {"2001-07-02": 1, "2001-07-03": 2}
        folder = D.read_days(spark, inp.path("daily/hot_themes"))
        assert folder.exceptAll(spark.table("feedrec_jobs.hot_themes").select(*folder.columns)).isEmpty()
        for name in ("similar_user_map", "neighbor_list", "user_profile", "profile_lists", "serving", "als_mse"):
            assert spark.table(f"feedrec_jobs.{name}").where("dt = '2001-07-02'").count() > 0
        dropped = {(r.job, r.source, r.reason): r.n for r in D.read_days(spark, inp.path("daily/dropped"), "2001-07-02").collect()}
        behavior = {("behavior", "no user"): 3, ("behavior", "no theme"): 1}
        catalog = {("catalog", "missing field"): 1, ("catalog", "no id"): 1}
        assert dropped == ({("simuser", *k): n for k, n in (behavior | catalog).items()} | {("profile", *k): n for k, n in (behavior | catalog).items()}
                           | {("als", *k): n for k, n in behavior.items()}
                           | {("serving", "profile list", "not three fields"): 2, ("serving", "similar list", "no list"): 0, ("serving", "similar list", "no user"): 0})
    finally:
        spark.sql("DROP DATABASE feedrec_jobs CASCADE")

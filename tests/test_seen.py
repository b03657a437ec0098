"""Bitmap seen sets against the anti join; bucketed tables."""

import random

import pytest
from pyspark.sql import functions as F

from feedrec.operators import history as H
from feedrec.operators import seen as S
from feedrec.session import bucketed


def pairs(spark, rows):
    return spark.createDataFrame(rows, "user_id string, theme_id string")


@pytest.mark.parametrize("themes", [30, 70_000])
def test_same_rows_as_the_anti_join(spark, themes):
    rng = random.Random(themes)
    pick = [f"t{i}" for i in ([*range(20), *range(themes - 10, themes)] if themes > 100 else range(themes))]
    hist = [(f"u{i % 9}", rng.choice(pick)) for i in range(200)] + [("all", f"t{i}") for i in range(themes)] + [("", "t1"), (None, "t2")]
    cand = [(u, t, n) for u in ["u1", "u2", "all", "new", "", None] for t in pick + ["unknown", None] for n in (1, 1)]
    h, c = pairs(spark, hist), spark.createDataFrame(cand, "user_id string, theme_id string, n int")
    ids = S.theme_ids(h)
    got = sorted(map(str, S.unseen(c, ids, S.seen_sets(h, ids)).collect()))
    # a user without a name has no history of their own
    want = sorted(map(str, H.exclude_seen(c, h.where("user_id <> ''")).collect()))
    assert got == want and len(got) > 50


def test_a_second_day_keeps_the_numbers(spark):
    one, two = pairs(spark, [("a", "m"), ("a", "z"), ("b", "m")]), pairs(spark, [("a", "c"), ("c", "m"), ("b", "m")])
    ids = S.theme_ids(one)
    later = S.theme_ids(two, ids)
    assert sorted(map(tuple, later.collect())) == [("c", 2), ("m", 0), ("z", 1)]
    sets = S.seen_sets(two, later, S.seen_sets(one, ids))
    assert sets.count() == 3  # one row a user
    cand = pairs(spark, [(u, t) for u in "abcd" for t in "cmz"])
    assert sorted(map(tuple, S.unseen(cand, later, sets).collect())) == [
        ("b", "c"), ("b", "z"), ("c", "c"), ("c", "z"), ("d", "c"), ("d", "m"), ("d", "z")]
    again = S.seen_sets(two, S.theme_ids(two, later), sets)  # the same day once more changes nothing
    assert sorted(map(str, again.collect())) == sorted(map(str, sets.collect()))


def test_empty_history(spark):
    none = pairs(spark, [])
    ids = S.theme_ids(none)
    assert [tuple(r) for r in S.unseen(pairs(spark, [("a", "b")]), ids, S.seen_sets(none, ids)).collect()] == [("a", "b")]


def test_bucketed_tables_leave_no_entry_and_need_no_exchange(spark):
    t = bucketed(spark.range(1000).select(F.col("id").cast("string").alias("user_id"), (F.col("id") % 7).alias("x")), "user_id")
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("feedrec_")]
    plan = t.groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and t.count() == 1000


def test_few_downloads_of_many_themes_take_few_bytes(spark):
    """One download in each of many places costs a number, not a bitmap of 4 KB."""
    themes = pairs(spark, []).unionByName(spark.range(70_000).selectExpr("'all' AS user_id", "format_string('t%05d', id) AS theme_id"))
    few = spark.range(400).selectExpr("concat('u', id) AS user_id", "explode(array(0, 63, 64, 40000, 69999)) AS n")
    h = themes.unionByName(few.selectExpr("user_id", "format_string('t%05d', n) AS theme_id"))
    ids = S.theme_ids(h)
    sets = S.seen_sets(h, ids)
    assert dict(sets.dtypes)["bits"] == "bigint" and sets.where("user_id <> 'all'").count() == 1600
    assert sets.where("user_id = 'all'").count() == 1094
    cand = pairs(spark, [("u7", f"t{n:05d}") for n in (0, 1, 62, 63, 64, 65, 40000, 69998, 69999)])
    assert sorted(r.theme_id for r in S.unseen(cand, ids, sets).collect()) == ["t00001", "t00062", "t00065", "t69998"]

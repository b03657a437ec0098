"""The four batch jobs end to end on sf0.001, and the streaming history."""

import os
import tempfile

from pyspark.sql import functions as F

from feedrec.operators.history import build_history
from feedrec.params import DEFAULT
from feedrec.plans import jobs as J
from feedrec.sources import fixtures as FX
from feedrec.sources.readers import download_window


def test_jobs_chain(spark, sf):
    out = tempfile.mkdtemp(prefix="feedrec-jobs-")
    inp = J.Inputs(spark, out, sf_dir=sf)
    J.simuser_job(inp, DEFAULT, {"makeHotList", "loadSimUserDataIntoHive", "makeRecommendList"})
    J.profile_job(inp, DEFAULT, {"updateProfile", "updateSimTagAndRecallTheme", "makeRecommendList"})
    J.serving_job(inp, DEFAULT)
    assert inp.table("hot_themes").count() == DEFAULT.n_hot
    assert inp.table("neighbor_list").count() > 0
    assert inp.table("profile_lists").count() > 0
    serving = inp.table("serving")
    users = serving.count()
    assert users > 0
    cells = inp.table("serving_cells")
    assert cells.count() == users * 11
    lines = spark.read.text(os.path.join(out, "sim_list_txt")).first()["value"]
    assert "\t" in lines


def test_streaming_history_equals_batch(spark, sf):
    root = tempfile.mkdtemp(prefix="feedrec-stream-")
    land, hist, ckpt = (os.path.join(root, x) for x in ("landing", "history", "ckpt"))
    beh = FX.behavior(spark, sf).where(F.col("pt") >= DEFAULT.day_before(DEFAULT.days_history))
    cat = FX.catalog(spark, sf)
    beh.where(F.col("pt") < "2000-01-01").write.parquet(os.path.join(land, "a"))
    beh.where(F.col("pt") >= "2000-01-01").write.parquet(os.path.join(land, "b"))
    from feedrec.streaming import read_history, start
    q = start(spark, land + "/*", cat, hist, ckpt)
    q.awaitTermination(300)
    got = read_history(spark, hist)
    want = build_history(download_window(FX.behavior(spark, sf), DEFAULT.day_before(DEFAULT.days_history)), cat)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _day(spark, path, rows):
    spark.createDataFrame([(f"2001-07-{d:02d} 10:00:00", t, u, "Download", f"2001-07-{d:02d}") for d, t, u in rows],
                          "time string, theme_id string, user_id string, act_type string, pt string").write.parquet(path)
    return path


def test_two_days_in_sequence(spark, sf):
    """Day 1's downloads are in the history that day 2's list reads, though
    day 2's window no longer holds them."""
    out = tempfile.mkdtemp(prefix="feedrec-days-")
    one = _day(spark, os.path.join(out, "in1"), [(1, "1", "a"), (1, "1", "b"), (1, "2", "b"), (1, "4", "a"), (1, "4", "b")])
    two = _day(spark, os.path.join(out, "in2"), [(20, "9", "a"), (20, "9", "b"), (20, "4", "b"), (20, "2", "b")])
    stages = {"updateDownloadHistory", "makeHotList", "loadSimUserDataIntoHive", "makeRecommendList"}
    J.simuser_job(J.Inputs(spark, out, sf, behavior=one), DEFAULT.with_(as_of="2001-07-02"), stages)
    inp = J.Inputs(spark, out, sf, behavior=two)
    J.simuser_job(inp, DEFAULT.with_(as_of="2001-07-21", days_history=5, n_hot=1), stages)
    hist = {(r.user_id, r.theme_id) for r in inp.history(DEFAULT).collect()}
    assert hist == {("a", "1"), ("b", "1"), ("b", "2"), ("a", "4"), ("b", "4"), ("a", "9"), ("b", "9")}
    listed = {(r.user_id, r.theme_id) for r in inp.table("neighbor_list").where("section <> 1").collect()}
    assert not listed & hist
    assert {(r.source, r.reason) for r in inp.table("dropped").collect()} >= {("behavior", "no user"), ("catalog", "missing field")}


def test_stage_mix_keeps_the_similar_users(spark, sf):
    out = tempfile.mkdtemp(prefix="feedrec-mix-")
    inp = J.Inputs(spark, out, sf_dir=sf)
    J.simuser_job(inp, DEFAULT, {"loadSimUserDataIntoHive"})
    before = J.V.read(spark, inp.path("similar_users")).count()
    J.simuser_job(inp, DEFAULT, {"existSimUserData", "loadSimUserDataIntoHive"})
    assert J.V.read(spark, inp.path("similar_users")).count() == before > 0


def test_pointer_survives_a_crash_at_each_step(spark):
    import pytest

    from feedrec.plans import versions as V
    root = tempfile.mkdtemp(prefix="feedrec-pointer-")
    first = V.replace(spark.range(3).toDF("x"), root)
    assert first.count() == 3
    name = V.new_name()
    spark.range(5).toDF("x").write.parquet(os.path.join(root, name))
    assert V.read(spark, root).count() == 3  # written, not promoted
    os.rename(os.path.join(root, "CURRENT"), os.path.join(root, "PREVIOUS"))
    assert V.read(spark, root).count() == 3  # the old pointer set aside, the new one not there yet
    V.promote(spark, root, name)
    assert V.read(spark, root).count() == 5
    os.rename(os.path.join(root, "CURRENT"), os.path.join(root, "lost"))
    if os.path.exists(os.path.join(root, "PREVIOUS")):
        os.rename(os.path.join(root, "PREVIOUS"), os.path.join(root, "lost2"))
    with pytest.raises(RuntimeError):
        V.read(spark, root)


def test_epoch_again_gives_the_same_rows(spark, sf):
    from feedrec.streaming.history import merge_batch, read_history
    root = tempfile.mkdtemp(prefix="feedrec-epoch-")
    cat = FX.catalog(spark, sf)
    beh = FX.behavior(spark, sf).where(F.col("pt") >= DEFAULT.day_before(DEFAULT.days_history))
    for epoch, part in enumerate((beh.where("pt < '2000-01-01'"), beh.where("pt >= '2000-01-01'"), beh.where("pt >= '2000-01-01'"))):
        merge_batch(part, min(epoch, 1), cat, root)
    want = build_history(download_window(FX.behavior(spark, sf), DEFAULT.day_before(DEFAULT.days_history)), cat)
    got = read_history(spark, root)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_settings_by_text():
    p = DEFAULT.with_text(["theme_max_user=6", "als_implicit=false", "time_decay=0.5", "split_keys=3,6", "as_of=2001-01-01"])
    assert (p.theme_max_user, p.als_implicit, p.time_decay, p.split_keys, p.as_of) == (6, False, 0.5, ("", "3", "6"), "2001-01-01")
    assert DEFAULT.with_text(["theme_max_user=none"]).theme_max_user is None

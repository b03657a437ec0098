"""Near duplicates send through the driver what was counted, or little."""

from feedrec.llm import jaccard as J
from feedrec.session import joins_broadcast_up_to


def test_planner_broadcasts_little_while_links_are_made(spark, monkeypatch):
    name, keep, held = "spark.sql.autoBroadcastJoinThreshold", J._links, []
    monkeypatch.setattr(J, "_links", lambda *a: held.append(spark.conf.get(name)) or keep(*a))
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "other words"), (4, None), (None, text)], "doc_id long, text string")
    before = spark.conf.get(name)
    kept = sorted(map(str, J.keep_one(docs).select("doc_id").collect()))
    assert kept == sorted(f"Row(doc_id={i})" for i in (1, 3, 4, None))
    assert held == [str(J.BROADCAST_BYTES)] * 2 and spark.conf.get(name) == before
    for own in ("-1", "256k"):  # what the session bounds lower stays
        spark.conf.set(name, own)
        try:
            with joins_broadcast_up_to(spark, 1 << 20):
                assert spark.conf.get(name) in ("-1", str(256 << 10))
            assert spark.conf.get(name) == own
        finally:
            spark.conf.set(name, before)


def test_more_ids_than_the_bound_are_shuffled(spark, tmp_path, monkeypatch):
    spark.range(500).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    join = {}
    for bound in (500, 499):
        monkeypatch.setattr(J, "BROADCAST_IDS", bound)
        join[bound] = spark.range(10**6).join(J._small(ids), "id", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in join[500] and "SortMergeJoin" in join[499] and "Broadcast" not in join[499]

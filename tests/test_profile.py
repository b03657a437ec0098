"""Tag profile, tag index and the expansion on hand-worked rows."""

from pyspark.sql import functions as F

from feedrec.functions.columns import time_decay
from feedrec.operators import profile as PR
from feedrec.params import DEFAULT
from feedrec.session import cut_lineage

BEH = "time string, theme_id string, user_id string, act_type string"
FEAT = "theme_id string, author string, author_n long, tag string, tag_n long"


def test_equal_records_collapse(spark):
    feats = spark.createDataFrame([("T1", "au", 2, "a", 2), ("T1", "au", 2, "b", 2),
                                   ("T2", "au", 2, "a", 2), ("T2", "au", 2, "b", 2)], FEAT)
    b = spark.createDataFrame([("2001-07-01 00:00:00", "T1", "u", "Scan"),
                               ("2001-07-01 00:00:00", "T2", "u", "Scan")], BEH)
    rec = PR.profile_records(b, feats).collect()
    assert len(rec) == 1 and rec[0].record_n == 1
    assert [(t.tag, t.tag_n) for t in rec[0].tags] == [("a", 2), ("b", 2)]


def test_integer_division_in_heat(spark):
    # tag x is on 19 themes; the user has 10 distinct records -> 19 div 10 = 1,
    # log10(1) = 0, so the heat factor is exactly 1
    feats = [("T0", "au", 1, "x", 19), ("T0", "au", 1, "z", 5)]
    feats += [(f"T{i}", "au", 1, "y", 5) for i in range(1, 10)]
    feats += [(f"T{i}", "au", 1, f"w{i}", 5) for i in range(1, 10)]
    f = spark.createDataFrame(feats, FEAT)
    b = spark.createDataFrame([(f"2001-07-{i + 1:02d} 00:00:00", f"T{i}", "u", "Scan") for i in range(10)], BEH)
    raw = {r.tag: r.raw for r in PR.profile_weights(b, f, DEFAULT).collect()}
    decay = spark.range(1).select(time_decay(__import__("pyspark.sql.functions", fromlist=["lit"]).lit(
        "2001-07-01 00:00:00"), DEFAULT.as_of, DEFAULT.time_decay, DEFAULT.days_profile).alias("d")).first().d
    assert abs(raw["x"] - DEFAULT.scan_factor * decay) < 1e-12


def test_profile_weights_normalised(spark, sf):
    from feedrec.plans.queries import Ctx
    prof = Ctx(spark, sf).profile.collect()
    assert prof
    by_user = {}
    for r in prof:
        assert 0.1 - 1e-9 <= r.weight <= 1.0 + 1e-9
        by_user.setdefault(r.user_id, []).append(r.weight)
    assert all(max(ws) == 1.0 and len(ws) <= DEFAULT.max_profile_tag for ws in by_user.values())


def test_expansion_stops_on_a_cycle(spark):
    orig = spark.createDataFrame([("u", "A", 1.0)], "user_id string, tag string, weight double")
    ls = spark.createDataFrame([("A", 1, "1"), ("B", 1, "2")], "tag string, rank long, theme_id string")
    tg = spark.createDataFrame([("A", "B", 1, 1.0), ("B", "A", 1, 1.0)],
                               "tag string, sim_tag string, rank long, weight double")
    hist = spark.createDataFrame([], "user_id string, theme_id string")
    out = PR.expand_recall(orig, ls, tg, hist, DEFAULT)
    assert sorted((r.theme_id, r.hop) for r in out.collect()) == [("1", 0), ("2", 1)]


def test_expansion_follows_a_long_chain(spark):
    """Seven productive hops, then nothing new: the loop needs no hop limit."""
    tags = [f"T{i}" for i in range(8)]
    orig = spark.createDataFrame([("u", "T0", 1.0), ("v", "T6", 1.0)], "user_id string, tag string, weight double")
    ls = spark.createDataFrame([(t, 1, f"i{t}") for t in tags], "tag string, rank long, theme_id string")
    tg = spark.createDataFrame([(a, b, 1, 1.0) for a, b in zip(tags, tags[1:])],
                               "tag string, sim_tag string, rank long, weight double")
    hist = spark.createDataFrame([("u", "iT3")], "user_id string, theme_id string")
    got = {(r.user_id, r.theme_id, r.hop) for r in PR.expand_recall(orig, ls, tg, hist, DEFAULT).collect()}
    assert got == {("u", f"iT{i}", i) for i in range(8) if i != 3} | {("v", "iT6", 0), ("v", "iT7", 1)}


def test_no_candidate_in_history(spark, sf):
    from feedrec.plans.queries import Ctx
    c = Ctx(spark, sf)
    seen = c.history.select("user_id", "theme_id")
    assert c.expanded.join(seen, ["user_id", "theme_id"]).count() == 0
    assert c.unseen.join(seen, ["user_id", "theme_id"]).count() == 0


def test_lists_are_bounded(spark, sf):
    from pyspark.sql import functions as F

    from feedrec.plans.queries import Ctx
    lists = Ctx(spark, sf).lists
    mx = lists.groupBy("user_id", "list").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert mx <= DEFAULT.n_theme_per_user


def test_hops_need_no_exchange(spark, monkeypatch):
    """All state of a hop is bucketed by user: only the first tables are shuffled."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before, keep, exchanges = spark.conf.get(key), PR.bucketed, []

    def counted(df, *keys):
        exchanges.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return keep(df, *keys)

    monkeypatch.setattr(PR, "bucketed", counted)
    ls = spark.createDataFrame([(f"g{i}", f"t{i}", "1", "1", []) for i in range(5)], "tag string, theme_id string, quality string, ctime string, tokens array<string>")
    tg = spark.createDataFrame([(f"g{i}", f"g{i + 1}", 1.0) for i in range(4)], "tag string, sim_tag string, weight double")
    orig = spark.createDataFrame([("u", "g0", 1.0), ("v", "g1", 1.0)] + [(f"w{i}", "g0", 1.0) for i in range(4000)],
                                 "user_id string, tag string, weight double")
    hist = spark.createDataFrame([("v", "good", "t2")], "user_id string, bucket string, theme_id string")
    ls, tg = cut_lineage(ls), cut_lineage(tg)  # tables of known size, as in the jobs
    out = PR.expand_recall(orig, ls, tg, hist, DEFAULT)
    got = sorted(map(tuple, out.where("user_id in ('u', 'v')").collect()))
    assert out.count() == 4001 * 5 + 3 and got == [("u", f"t{i}", i) for i in range(5)] + [("v", "t1", 0), ("v", "t3", 2), ("v", "t4", 3)]
    assert len(exchanges) > 12 and sum(exchanges[5:]) == 0
    assert spark.conf.get(key) == before


def test_both_lists_come_from_one_sort(spark, monkeypatch):
    """Ties by quality, ctime and id in either direction; as many terms as the
    longest profile, or a lambda beyond ``PLACES``."""
    theme = "theme_id string, grade string, quality string, ctime string, tokens array<string>"
    recall = spark.createDataFrame([(f"i{k}", "4", str(k % 2), "1", [f"g{k % 3}", f"g{k % 5}"]) for k in range(15)], theme)
    cand = spark.createDataFrame([(u, f"i{k}") for u, n in (("a", 15), ("b", 4), ("none", 3)) for k in range(n)], "user_id string, theme_id string")
    weights = {("a", "g0"): 1.0, ("a", "g3"): 0.4, ("a", "g1"): 0.1, ("b", "g2"): 1.0}
    orig = spark.createDataFrame([(u, g, w) for (u, g), w in weights.items()], "user_id string, tag string, weight double")

    def place(u, k):
        return (-sum(weights.get((u, g), 0.0) for g in {f"g{k % 3}", f"g{k % 5}"}), -(k % 2), f"i{k}")

    want = []
    for u, n in (("a", 15), ("b", 4), ("none", 3)):
        best = [x[2] for x in sorted(place(u, k) for k in range(n))]
        want += [(u, "profile", i, x) for i, x in enumerate(best[:6], 1)] + [(u, "extend", i, x) for i, x in enumerate(best[::-1][:6], 1)]
    lists = PR.profile_lists(cand, orig, recall, 6)
    plan = lists._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "aggregate(" not in plan
    assert sorted(map(tuple, lists.collect())) == sorted(want)
    monkeypatch.setattr(PR, "PLACES", 2)
    assert sorted(map(tuple, PR.profile_lists(cand, orig, recall, 6).collect())) == sorted(want)


def test_a_hop_holds_one_row_a_user(spark, monkeypatch):
    """Known themes are an array of the user's row, not a row each."""
    keep, tables = PR.bucketed, []

    def counted(df, *keys):
        tables.append(keep(df, *keys))
        return tables[-1]

    monkeypatch.setattr(PR, "bucketed", counted)
    orig = spark.createDataFrame([("u", "A", 1.0), ("v", "B", 1.0)], "user_id string, tag string, weight double")
    ls = spark.createDataFrame([(g, i, f"{g}{i}") for g in "ABC" for i in range(20)], "tag string, rank long, theme_id string")
    tg = spark.createDataFrame([("A", "B", 1, 1.0), ("B", "C", 1, 1.0)], "tag string, sim_tag string, rank long, weight double")
    hist = spark.createDataFrame([("u", "B3"), ("u", "elsewhere"), ("v", "C1")], "user_id string, theme_id string")
    out = PR.expand_recall(orig, ls, tg, hist, DEFAULT)
    assert sorted((r.user_id, r.hop, r.n) for r in out.groupBy("user_id", "hop").agg(F.count("*").alias("n")).collect()) == [
        ("u", 0, 20), ("u", 1, 19), ("u", 2, 20), ("v", 0, 20), ("v", 1, 19)]
    assert max(t.count() for t in tables) <= 2


def test_lists_of_a_hop_as_one_row(spark):
    """Candidates as one row a user and hop: the same lists, and the profile
    joins the rows, not every candidate."""
    orig = spark.createDataFrame([("u", "a", 0.5), ("u", "b", 0.25), ("v", "a", 1.0)], "user_id string, tag string, weight double")
    recall = spark.createDataFrame([(t, i, f"t{i}", "4", str(i % 2), f"15000{i % 3}", list(f"{'ab'[i % 2]}xc")) for i in range(30) for t in "xc"],
                                   "tag string, rank long, theme_id string, grade string, quality string, ctime string, tokens array<string>")
    hops = [("u", [f"t{i}" for i in range(10)], 0), ("u", [f"t{i}" for i in range(10, 25)], 1), ("v", ["t3", "t8", "none"], 0),
            ("w", ["t1"], 0), ("w", [], 1), (None, ["t5"], 0)]
    wide = spark.createDataFrame(hops, "user_id string, themes array<string>, hop long")
    flat = PR.listed_themes(wide)
    got = PR.profile_lists(wide, orig, recall, 6)
    want = sorted(map(str, PR.profile_lists(flat, orig, recall, 6).collect()))
    assert sorted(map(str, got.collect())) == want and len(want) == 12 + 4 + 2 + 2
    p = got._jdf.queryExecution().optimizedPlan().toString()
    assert p.index("Generate explode(themes") < p.index("Join LeftOuter")  # the join lies below

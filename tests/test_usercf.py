"""User CF, hot list, neighbour walk and list fix-up on hand-worked rows."""

import math

from pyspark.sql import functions as F

from feedrec.operators import history as H
from feedrec.operators import hot as HOT
from feedrec.operators import usercf as U
from feedrec.params import DEFAULT

BEH = "time string, theme_id string, user_id string, act_type string"


def beh(spark, rows):
    return spark.createDataFrame([("2001-07-01 00:00:00", t, u, a) for t, u, a in rows], BEH)


def test_pair_weight_and_symmetry(spark):
    b = beh(spark, [("t1", "a", "Scan"), ("t1", "b", "Scan"), ("t2", "a", "Scan")])
    sim = {(r.user_id, r.neighbor): r.sim for r in U.similar_users(b, DEFAULT).collect()}
    w = round(1.0 / math.log(3.0) / math.sqrt(2.0 * 1.0) * DEFAULT.scan_factor, 6)
    assert sim == {("a", "b"): w, ("b", "a"): w}


def test_heat_one_gives_no_pair(spark):
    b = beh(spark, [("t1", "a", "Scan"), ("t2", "b", "Scan")])
    assert U.similar_users(b, DEFAULT).count() == 0


def test_cap_samples_but_keeps_heat(spark):
    b = beh(spark, [("t", f"u{i}", "Download") for i in range(8)])
    rows = U.cf_rows(b)
    capped = U.cap_users(rows, U.theme_heat(rows), 6, 42)
    assert capped.count() == 6
    assert {r.heat for r in capped.collect()} == {8}
    pc = U.pair_contrib_half(capped, U.user_act_norm(rows), DEFAULT)
    assert pc.count() == 6 * 5 // 2
    expected = DEFAULT.download_factor / math.log(9.0)
    assert all(abs(r.contrib - expected) < 1e-12 for r in pc.collect())
    # the sample is seeded: same seed, same users
    again = U.cap_users(rows, U.theme_heat(rows), 6, 42)
    assert sorted(r.user_id for r in capped.collect()) == sorted(r.user_id for r in again.collect())


def test_heavy_group_in_blocks(spark):
    """One group holds a third of all users: blocks give the same pairs."""
    b = beh(spark, [("hot", f"u{i:02d}", "Scan") for i in range(30)]
            + [(f"t{i}", f"u{j:02d}", "Scan") for i in range(20) for j in (i, i + 30, i + 50)])
    rows = U.cf_rows(b)
    heat, norm = U.theme_heat(rows), U.user_act_norm(rows)

    def pairs(block):
        p = DEFAULT.with_(pair_block=block)
        half = U.pair_contrib_half(U.members(rows, heat, p), norm, p)
        return sorted((r.ua, r.ub, r.theme_id, round(r.contrib, 12)) for r in half.collect())

    assert pairs(1024) == pairs(4)
    assert len(pairs(4)) == 30 * 29 // 2 + 20 * 3


def hist(spark, rows):
    return spark.createDataFrame(
        [(u, b, t, q, "4" if b == "good" else "1", c) for u, b, t, q, c in rows],
        "user_id string, bucket string, theme_id string, quality string, grade string, ctime string")


def test_early_stop(spark):
    sim = spark.createDataFrame([("me", "n1", 1, 1.0), ("me", "n2", 2, 0.9), ("me", "n3", 3, 0.8)],
                                "user_id string, neighbor string, rank long, sim double")
    h = hist(spark, [("n1", "good", "1", "0", "1"), ("n1", "good", "2", "0", "1"),
                     ("n2", "good", "2", "0", "1"), ("n2", "good", "3", "0", "1"),
                     ("n3", "good", "4", "0", "1")])
    got = sorted(r.theme_id for r in U.neighbor_candidates(sim, h, 3).collect())
    assert got == ["1", "2", "3"]          # the third neighbour is never read


def test_list_fixup_three_branches(spark):
    L = 4
    hot = spark.createDataFrame([(0, "h0"), (1, "h1"), (2, "h2")], "rank long, id string")

    def cand(u, n):
        # ctime compares as a string, so keep the width fixed
        return [(u, f"{u}{i}", "1" if i % 2 == 0 else "0", str(900 - i)) for i in range(n)]

    un = spark.createDataFrame(cand("long", L + 1) + cand("exact", L) + cand("short", L - 2),
                               "user_id string, theme_id string, quality string, ctime string")
    users = spark.createDataFrame([("long",), ("exact",), ("short",), ("none",)], "user_id string")
    out = U.neighbor_list(un, hot, users, L).orderBy("user_id", "pos").collect()
    lists = {}
    for r in out:
        lists.setdefault(r.user_id, []).append(r.theme_id)
    # sorted by (quality, ctime) desc: quality-1 items first, newer ctime first
    assert lists["long"] == ["long0", "long2", "long4", "long1"]
    assert lists["exact"] == ["exact0", "exact2", "exact1", "exact3"]
    assert lists["short"] == ["short0", "h0", "h1", "short1"]
    assert lists["none"] == ["h0", "h1", "h2"]


def test_hot_rank_is_numeric(spark):
    dl = spark.createDataFrame([(f"t{i:02d}", f"u{j}") for i in range(12) for j in range(i + 1)],
                               "theme_id string, user_id string")
    cat = spark.createDataFrame([], "id string, quality string, grade string, ctime string")
    hot = HOT.hot_themes(dl, cat, 100).orderBy("rank").collect()
    assert [r["rank"] for r in hot] == list(range(12))
    assert hot[0].id == "t11" and hot[0].dn == 12 and hot[0].quality == "0"


def test_seen_filter_by_id(spark):
    cand = spark.createDataFrame([("u", "1"), ("u", "2")], "user_id string, theme_id string")
    h = hist(spark, [("u", "bad", "2", "9", "1")])
    assert [r.theme_id for r in H.exclude_seen(cand, h).collect()] == ["1"]


def test_history_merge_idempotent(spark):
    h = hist(spark, [("u", "good", "1", "0", "1"), ("v", "bad", "2", "1", "1")])
    m = H.merge_history(h, h)
    assert m.count() == 2
    assert H.merge_history(m, h).count() == 2
    assert F is not None


def test_dedupe_backfill_option(spark):
    hot = spark.createDataFrame([(0, "x"), (1, "h1"), (2, "h2")], "rank long, id string")
    un = spark.createDataFrame([("u", "x", "1", "900")], "user_id string, theme_id string, quality string, ctime string")
    users = spark.createDataFrame([("u",)], "user_id string")
    plain = [r.theme_id for r in U.neighbor_list(un, hot, users, 3).orderBy("pos").collect()]
    dedup = [r.theme_id for r in U.neighbor_list(un, hot, users, 3, dedupe_backfill=True).orderBy("pos").collect()]
    assert plain == ["x", "x", "h1"]          # the original pads without a dedupe
    assert dedup == ["x", "h1", "h2"]


def test_drop_zero_option(spark):
    b = beh(spark, [("t1", "a", "Other"), ("t1", "b", "Other"), ("t2", "a", "Scan"), ("t2", "c", "Scan")])
    kept = {(r.user_id, r.neighbor): r.sim for r in U.similar_users(b, DEFAULT).collect()}
    pruned = {(r.user_id, r.neighbor): r.sim for r in U.similar_users(b, DEFAULT.with_(drop_zero=True)).collect()}
    assert kept[("a", "b")] == 0.0            # 'other' pairs occupy a neighbour slot by default
    assert ("a", "b") not in pruned and pruned[("a", "c")] == kept[("a", "c")]

"""Bounded neighbour lists against the walk over whole histories."""

import random

import pytest

from feedrec.operators import history as H
from feedrec.operators import neighbors as NB
from feedrec.operators import usercf as U


def history(spark, rows):
    return spark.createDataFrame([(u, b, t, q, "4" if b == "good" else "1", c) for u, b, t, q, c in rows],
                                 "user_id string, bucket string, theme_id string, quality string, grade string, ctime string")


def sim_table(spark, rows):
    return spark.createDataFrame(rows, "user_id string, neighbor string, rank long, sim double")


def case(rng):
    users = [f"u{i:02d}" for i in range(14)]
    rows = []
    for i, u in enumerate(users):
        size = rng.choice([0, 1, 3, 5, 9]) if i % 5 else rng.randint(10, 60)  # some histories are long
        for t in rng.sample(range(70), size):
            rows.append((u, rng.choice(["good", "good", "good", "bad"]), f"t{t}", str(t % 3), str(t % 7)))
    # readers of long histories who have seen much of them
    for u in users[1:4]:
        rows += [(u, "bad", t, q, c) for w, _, t, q, c in rows if w == users[0]][:45]
    sim = [(u, v, r, 1.0 / r) for u in users for r, v in enumerate(rng.sample([v for v in users if v != u], 6), 1)]
    return sim + [("", "u01", 1, 1.0), ("u01", None, 7, 0.1)], rows


@pytest.mark.parametrize("seed,max_n,size", [(1, 10, 2), (2, 6, 4), (3, 1, 3), (4, 30, 20), (5, 12, 1)])
def test_same_list_as_from_whole_histories(spark, seed, max_n, size):
    sim, rows = case(random.Random(seed))
    sim, hist = sim_table(spark, sim), history(spark, rows)
    hot = spark.createDataFrame([(i, f"h{i}") for i in range(5)], "rank long, id string")
    whole = H.exclude_seen(U.neighbor_candidates(sim, hist, max_n), hist)
    want = sorted(map(tuple, U.neighbor_list(whole, hot, sim, size).collect()))
    got = sorted(map(tuple, U.neighbor_list(NB.best_unseen(sim, hist, max_n, size), hot, sim, size).collect()))
    assert got == want


def test_long_history_is_not_copied_to_its_followers(spark, monkeypatch):
    """10,000 items of one neighbour, 300 followers: each gets a head of 2 size rows."""
    hist = history(spark, [("star", "good", f"t{i:05d}", str(i % 2), str(i)) for i in range(10_000)]
                   + [(f"f{i:03d}", "bad", "t09999", "1", "9999") for i in range(300)]
                   + [("f000", "good", f"t{i:05d}", str(i % 2), str(i)) for i in range(1, 10_000, 2)])
    sim = sim_table(spark, [(f"f{i:03d}", "star", 1, 1.0) for i in range(300)])
    sizes, keep = [], NB.cut_lineage
    monkeypatch.setattr(NB, "cut_lineage", lambda df: sizes.append((out := keep(df)).count()) or out)
    got = NB.best_unseen(sim, hist, 30, 5).collect()
    assert len(got) == 300 * 5 and sum(sizes) <= 2 * 300 * 10 + 2 * 10_000  # whole histories would be 3,000,000 rows
    assert sorted(r.theme_id for r in got if r.user_id == "f001")[-1] == "t09997"
    assert {r.quality for r in got if r.user_id == "f000"} == {"0"}  # has seen all of quality 1, read five rounds deep


def test_lists_are_grouped_by_user_once(spark, capsys):
    """The candidates are shuffled once, by user; the lists made of them are not."""
    sim, rows = case(random.Random(6))
    sim, hist = sim_table(spark, sim), history(spark, rows)
    hot = spark.createDataFrame([(i, f"h{i}") for i in range(30)], "rank long, id string")
    unseen = hist.select("user_id", "theme_id", "quality", "ctime")
    U.neighbor_list(unseen, hot, sim, 20).explain()
    plan = capsys.readouterr().out
    # candidates and users; before, candidates twice and the lists as well
    assert plan.count("Exchange hashpartitioning") == 2 and "Cartesian" not in plan and "NestedLoop" not in plan


def test_walk_over_short_histories_counts_as_the_joins_do(spark):
    sim, rows = case(random.Random(7))
    sim, good = sim_table(spark, sim), NB.good_items(history(spark, rows + rows[:9]))
    s = NB.reachable(sim, good, 8)
    first = NB.first_seen(s.where("h_n < 8"), good)
    want = first.join(NB.read_ranks(first, 8), ["user_id", "first_rank"]).select("user_id", *NB.TUPLE, "first_rank")
    got = NB.short_walks(s, good, 8).where("before < 8").drop("before").select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

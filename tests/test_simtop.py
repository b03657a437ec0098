"""Pruned user similarity against all pairs."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedrec.operators import simtop as S
from feedrec.operators import usercf as U
from feedrec.params import DEFAULT

BEH = "time string, theme_id string, user_id string, act_type string"


def plain(rows, p):
    """Top N of every user over all pairs."""
    rows = set(rows)
    n, group = defaultdict(int), defaultdict(list)
    for t, u, a in rows:
        n[u, a] += 1
        group[t, a].append(u)
    sim = defaultdict(float)
    for (_, a), users in group.items():
        w = {"Scan": p.scan_factor, "Download": p.download_factor}.get(a, 0.0)
        for u in users:
            for v in users:
                if u != v:
                    sim[u, v] += w / math.log(1 + len(users)) / math.sqrt(n[u, a] * n[v, a])
    out = []
    for u in {u for u, _ in sim}:
        best = sorted((-round(s, 9), v) for (x, v), s in sim.items() if x == u)[:p.n_sim_users]
        out += [(u, v, i, round(-s, 6)) for i, (s, v) in enumerate(best, 1)]
    return sorted(out)


def behaviour(kind, rng):
    rows = []
    for i in range(60):
        u = f"u{i:02d}"
        if kind == "hot":  # a third of all rows lie in two themes, the rest in cool ones
            rows += [(f"hot{j}", u, rng.choice(["Scan", "Download"])) for j in range(2)]
            rows += [(f"t{rng.randrange(40)}", u, rng.choice(["Scan", "Download", "Other"])) for _ in range(rng.randint(0, 8))]
        elif kind == "dense":  # few themes of about the same heat
            rows += [(f"t{rng.randrange(12)}", u, rng.choice(["Scan", "Download", "Other"])) for _ in range(rng.randint(1, 14))]
        else:  # most acts weigh nothing and many users have few partners
            rows += [(f"t{rng.randrange(5)}", u, "Other") for _ in range(3)]
            rows += [(f"d{rng.randrange(45)}", u, "Download") for _ in range(rng.choice([0, 0, 1, 2]))]
    return rows


@pytest.mark.parametrize("kind", ["hot", "dense", "light"])
@pytest.mark.parametrize("share,per_result,block", [(0.0, 0, 1024), (0.1, 0, 7), (0.4, 0, 1024), (0.25, 4, 1024)])
def test_same_rows_as_all_pairs(spark, kind, share, per_result, block):
    rows = behaviour(kind, random.Random(f"{kind}{share}"))
    p = DEFAULT.with_(head_share=share, head_per_result=per_result, n_sim_users=3, pair_block=block)
    beh = spark.createDataFrame([("2001-07-01 00:00:00", t, u, a) for t, u, a in rows], BEH)
    got = sorted((r.user_id, r.neighbor, r.rank, r.sim) for r in U.similar_users(beh, p).collect())
    want = plain(rows, p)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert all(abs(x[3] - y[3]) < 2e-6 for x, y in zip(got, want))


def test_negative_weights_form_all_pairs(spark):
    rows = behaviour("dense", random.Random(3))
    p = DEFAULT.with_(head_share=0.0, head_per_result=0, n_sim_users=3, scan_factor=-1.0)
    beh = spark.createDataFrame([("2001-07-01 00:00:00", t, u, a) for t, u, a in rows], BEH)
    got = sorted((r.user_id, r.neighbor, r.rank) for r in U.similar_users(beh, p).collect())
    assert got == [x[:3] for x in plain(rows, p)]


def test_hot_groups_form_no_pairs_when_they_cannot_matter(spark):
    """Everyone shares the hot themes; three cool partners of each user decide."""
    rows = [("hot", f"u{i:03d}", "Scan") for i in range(200)] + [("other", f"u{i:03d}", "Other") for i in range(200)]
    rows += [(f"c{i // 4}-{j}", f"u{i:03d}", "Download") for i in range(200) for j in range(3)]
    p = DEFAULT.with_(head_share=0.1, head_per_result=0, n_sim_users=3)
    beh = U.cf_rows(spark.createDataFrame([("2001-07-01 00:00:00", t, u, a) for t, u, a in rows], BEH))
    weighted = S.weighted(U.members(beh, U.theme_heat(beh), p), U.user_act_norm(beh), p)
    limit = S.head_limit(weighted, 200, p)
    assert U.contributions(weighted.where(F.col("c") > limit), p).count() == 50 * 6 * 3  # of 40,700 pairs
    sums = S.candidate_sums(U.half_sums, U.mirror, weighted, p)
    assert sums.count() == 600  # the 19,900 hot pairs of either direction were never formed
    got = sorted((r.user_id, r.neighbor, r.rank) for r in S.best(sums, 3).collect())
    assert got == [x[:3] for x in plain(rows, p)]


@pytest.mark.parametrize("kind,size", [("hot", 7), ("dense", 25), ("light", 11), ("dense", 100)])
def test_block_products_give_the_rows_of_all_pairs(spark, kind, size):
    rows = behaviour(kind, random.Random(kind)) + [("t1", f"twin{i}", "Scan") for i in range(9)]
    p = DEFAULT.with_(n_sim_users=3)
    beh = U.cf_rows(spark.createDataFrame([("2001-07-01 00:00:00", t, u, a) for t, u, a in rows], BEH))
    weighted = S.weighted(U.members(beh, U.theme_heat(beh), p), U.user_act_norm(beh), p)
    got = S.best(S.block_best(weighted, weighted.select("theme_id", "act_type", "c").distinct(), p, size), 3).collect()
    want = plain(rows, p)
    got = sorted((r.user_id, r.neighbor, r.rank, r.sim) for r in got)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert all(abs(x[3] - y[3]) < 2e-6 for x, y in zip(got, want))


def test_crowded_groups_form_no_pair_rows(spark, monkeypatch):
    """Everyone meets everyone: no pair is joined, the rows are those of the pair join."""
    rng = random.Random(5)
    rows = [(f"t{rng.randrange(9)}", f"u{i:03d}", rng.choice(["Scan", "Download", "Other"])) for i in range(120) for _ in range(8)]
    p = DEFAULT.with_(n_sim_users=3)
    beh = spark.createDataFrame([("2001-07-01 00:00:00", t, u, a) for t, u, a in rows], BEH)
    want = sorted(map(tuple, U.similar_users(beh, p).collect()))
    monkeypatch.setattr(S, "DENSE_PAIRS", 1000)
    monkeypatch.setattr(U, "half_sums", None)
    monkeypatch.setattr(S, "paired", None)
    assert sorted(map(tuple, U.similar_users(beh, p).collect())) == want

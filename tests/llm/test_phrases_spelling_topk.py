"""Phrase collocations, spelling variants and exact top-k against plain
versions, on sf0.001 and on odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from feedrec.llm import collocation, spelling, topk
from feedrec.llm.common import read


def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


ODD = [(1, None, None), (2, "", "en"), (3, "one", "en"), (4, "A b. a B, a b\ta b", None), (4, "A b. a B, a b\ta b", None), (None, "a b c d e f g", "en"),
       (6, " \n .;", "de"), (7, "x" * 40_000 + " y", "en"), (8, "w " * 20_000, "en"), (9, "é ñ 你好 \x00 \x1c tail\x0bz", "é"),
       (10, "x y z x y z x y z x y", "en"), (11, "çA Ça ÇA ç", "é")]


def documents(spark, rows=ODD):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "doc_id", "text", "lang", "1 as n", "'q' as phrase", "2 as w1", "3 as f", "4 as word", "5 as key", "6 as side")


# ------------------------------------------------------------------ phrases

def plain_phrases(rows, least, best=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    inner = Counter()
    for (lang, w), v in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inner[lang, w[i:i + k]] = max(inner[lang, w[i:i + k]], v)
    out = []
    for (lang, w), a in cand.items():
        if inner[lang, w] >= a:
            continue
        s, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, -s, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    out.sort()
    rank, found = Counter(), []
    for lang, s, a, p, left, right in out:
        rank[lang] += 1
        if rank[lang] <= best:
            found.append((lang, rank[lang], p.decode(), -a, left, right, n[lang], -s))
    return sorted(found)


@pytest.mark.parametrize("bounds", [{}, {"filter_bits": 32768, "chunk_bytes": 3000, "task_rows": 50, "bucket_bytes": 2000}, {"filter_bits": 32768 * 2, "chunk_bytes": 1}])
@pytest.mark.parametrize("least", [2, 3])
def test_phrases_of_odd_rows(spark, least, bounds):
    got = collocation.collocations(documents(spark), least, **bounds)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(ODD, least)


def test_phrases_of_a_table(spark, sf):
    docs = read(spark, sf, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    got = sorted(map(tuple, collocation.collocations(docs, 10, 300, chunk_bytes=200_000).collect()))
    assert got == plain_phrases(rows, 10, 300) and len(got) > 300


def test_phrases_of_random_pieces(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("aab") + rng.choice(["", " ", " ", "  ", ". ", "\t", ",", "\r"]) for _ in range(rng.randint(0, 60))),
             rng.choice([None, "x", "und"])) for i in range(60)]
    assert sorted(map(tuple, collocation.collocations(documents(spark, rows), 4, 20).collect())) == plain_phrases(rows, 4, 20)


def test_phrases_of_an_empty_table(spark):
    assert collocation.collocations(documents(spark, [])).collect() == []
    assert collocation.collocations(documents(spark, [(1, None, None), (2, "a", "en")])).collect() == []


def test_long_texts_are_cut_at_pieces():
    text = "a b c d. " * 500
    parts = list(collocation._segments(text, 100))
    assert "".join(parts) == text and len(parts) > 30 and all(p.strip().endswith(".") for p in parts)
    assert list(collocation._segments("x" * 1000, 100)) == ["x" * 1000]


def test_scores_beyond_64_bits(spark):
    big = spark.range(1).selectExpr("3000000000000L as a", "90000000000000L as n", "3000000000001L as l", "3000000000007L as r")
    want = 1000 * 3000000000000 * 90000000000000 // (3000000000001 * 3000000000007)
    assert big.select(collocation.score(big.a, big.n, big.l, big.r).alias("s")).first().s == want


# ------------------------------------------------------------------ spelling

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows, least_length=5, least_count=3, every=97):
    n = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least_length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least_count}


def plain_variants(n):
    found = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, others in found.items():
        top = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(found[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def test_index_finds_all_words_with_one_error():
    rng = random.Random(1)
    for trial in range(120):
        letters = ("ab", "abcé", "a\U00010400")[trial % 3]
        n = list({"".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(40)})
        got = set()
        for turn in (1, -1):
            kept = [len(w) - len(w) // 2 if turn == 1 else len(w) // 2 for w in n]
            p, w = spelling.near_in_shard([x[::turn] for x in n], [x[::turn] for x in n], kept)
            pairs = list(zip(p.tolist(), w.tolist()))
            assert len(pairs) == len(set(pairs))
            got |= {(n[i], n[j]) for i, j in pairs}
        assert got == {(a, b) for a in n for b in n if near(a, b)}


def test_long_words_in_the_index():
    a = "ab" * 1500
    words = [a, a + "b", a[:700] + "c" + a[701:], a[1:], "z" + a, a[:-1], "x" * 3000, "x" * 2999]
    got = set()
    for turn in (1, -1):
        kept = [len(w) - len(w) // 2 if turn == 1 else len(w) // 2 for w in words]
        p, w = spelling.near_in_shard([x[::turn] for x in words], [x[::turn] for x in words], kept)
        got |= set(zip(p.tolist(), w.tolist()))
    assert got == {(i, j) for i, x in enumerate(words) for j, y in enumerate(words) if near(x, y)}


@pytest.mark.parametrize("shard", [8192, 3])
def test_near_words_across_shards(spark, shard):
    rng = random.Random(3)
    # half of all words share their first letters and half their last ones: hot keys that must be cut
    words = {"hot" + "".join(rng.choice("abc") for _ in range(3)) for _ in range(25)}
    words |= {"".join(rng.choice("abc") for _ in range(3)) + "end" for _ in range(25)} | {"cold", "colds", "hotaaaend"}
    df = spark.createDataFrame([(w, len(w)) for w in sorted(words)], "word string, n long")
    got = [tuple(r) for r in spelling.near_words(df, shard).collect()]
    assert sorted(got) == sorted((a, b, len(b)) for a in words for b in words if near(a, b))


def test_variants_follow_forms(spark):
    n = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 47, "zzzzz": 3, "zzzzy": 5, "lonely": 9, "tie": 1, "tia": 4, "tib": 4}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(df).collect())) == plain_variants(n)


def test_spelling_of_a_table(spark, sf):
    docs = read(spark, sf, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    want = plain_words(rows)
    assert {r.word: r.n for r in spelling.vocabulary(docs).collect()} == want
    some = dict(sorted(want.items())[:1500])
    df = spark.createDataFrame(list(some.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(df).collect())) == plain_variants(some)


def test_spelling_of_odd_rows(spark):
    rows = ODD + [(i, "Colour coloUr COLOR, ÉCOLE écoleé École " + "k" * 3000 + " " + "k" * 3001 + " École" * (i % 3), "en") for i in range(12)]
    got = spelling.spelling(documents(spark, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == plain_variants(plain_words(rows))
    assert spelling.spelling(documents(spark, [])).collect() == []
    assert spelling.spelling(documents(spark, [(1, None, None), (2, "", "")])).collect() == []


# ------------------------------------------------------------------ top-k

def plain_top(rows, every=50, k=5):
    sound = [(i, [math.floor(256 * x) if abs(x) < 1e15 else int(x) * 256 for x in v]) for i, v in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {(i, tuple(v)) for i, v in sound if i is not None and i % every == 0}
    out = []
    for q, a in queries:
        scored = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, v)))), i is None, i or 0) for i, v in sound if i != q)
        out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr(
        "vec_id", "embedding", "1 as score", "2 as rank", "'z' as id", "3 as x", "4 as query_no")


def test_top_k_of_a_table(spark, sf):
    df = read(spark, sf, "embeddings")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    got = topk.nearest(df)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_top(rows)


@pytest.mark.parametrize("cells", [(4_000_000, 2_000_000), (7, 9), (1, 1)])
def test_top_k_of_odd_rows(spark, cells):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(size=4) * (rng.random(4) < 0.6)]) for i in range(-60, 60)]
    rows += [(None, [9.0, 9.0, 9.0, 9.0]), (None, [9.0, 9.0, 9.0, 9.0]), (100, None), (150, [1.0, None]), (200, [float("nan")]), (250, [float("inf"), 1.0]),
             (300, []), (350, [0.0, 0.0, 0.0, 0.0, 0.0, 5.0]), (350, [0.0, 0.0, 0.0, 0.0, 0.0, 5.0]), (350, [1.0]), (351, [2.0, 2.0]),
             (352, [2.0, 2.0]), (2 ** 63 - 1, [2.0, 2.0]), (400, [-0.001, 0.0039])]
    got = topk.nearest(vectors(spark, rows), 50, 5)
    small = topk.top_k(vectors(spark, rows).where("vec_id % 50 = 0"), vectors(spark, rows), 5, query_cells=cells[0], block_cells=cells[1])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, small.collect()), key=repr) == plain_top(rows)


def test_top_k_of_huge_components_and_ties(spark):
    rows = [(0, [1e300, -1e300, 3.0]), (50, [1e5, 7e8, 0.1]), (1, [1e300, 1e300, 0.0]), (2, [1e9, 1.0, 1.0]), (3, [1e9, 1.0, 1.0]), (4, [1e9, 1.0, 1.0]),
            (5, [1e9, 1.0, 1.0]), (6, [1e9, 1.0, 1.0]), (7, [1e9, 1.0, 1.0]), (8, [2.0 ** 27, 2.0 ** 26 + 1 / 256, 1.0])]
    assert sorted(map(tuple, topk.nearest(vectors(spark, rows)).collect()), key=repr) == plain_top(rows)


def test_top_k_with_few_rows(spark):
    assert topk.nearest(vectors(spark, [])).collect() == []
    assert topk.nearest(vectors(spark, [(1, [1.0])])).collect() == []
    assert topk.nearest(vectors(spark, [(50, [1.0])])).collect() == []
    assert [tuple(r) for r in topk.nearest(vectors(spark, [(50, [1.0]), (7, [-1.0])], "float")).collect()] == [(50, 1, 7, -65536)]


def test_blocks_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array([3, None, 1, 2]), pa.array([[1.0], [2.0, 3.0], [], [4.0, 5.0, 6.0]], pa.list_(pa.float64()))], names=["id", "x"])
    for cells in (1, 3, 5, 100):
        blocks = list(topk._blocks(iter([batch, batch]), cells))
        assert sum(len(b.ids) for b in blocks) == 8 and sum(len(b.x) for b in blocks) == 12
        assert all(np.array_equal(b.ids[:b.known], np.sort(b.ids[:b.known])) for b in blocks)

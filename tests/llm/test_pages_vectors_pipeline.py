"""Main text, vectors, components, and the pipeline."""

import html
import math
import re

import numpy as np
import pytest

import corpus_pipeline
from feedrec.llm import graph, pages, vectors
from feedrec.llm.common import read

LONG = "The cat of the house is in the garden and it was on the wall with a friend of the family. " * 3
GOOD = LONG.strip()


def test_article_of_every_page(spark, sf):
    rows = read(spark, sf, "pages").collect()
    got = {r.page_id: r for r in pages.extract(read(spark, sf, "pages")).collect()}
    assert len(got) == len(rows)
    for r in rows:
        body = re.search("<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        want = "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in re.split("</?(?:p|h1)>", body)) if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p>", ""), ("plain < text", ""),
    (f"<div class='menu'><a href=x>Home</a></div><p>{LONG}</p><p>Short.</p><footer>{LONG}</footer>", GOOD + "\n\nShort."),
    (f"<div class='cookie-notice'>{LONG}</div><h2>Title</h2><p>{LONG}", "Title\n\n" + GOOD),
    (f"<body class='has-sidebar'><main><p>One.</p><aside>{LONG}</aside><p>Two &amp; &lt;b&gt;</p></main><div>{LONG}</div>", "One.\n\nTwo & <b>"),
    (f"<article><p>{LONG}</p><div id=comments><p>{LONG}</p></div></article>", GOOD),
    (f"<article>Text<form>{LONG}</form><!-- x --><script>var a='<p>no</p>'</script></article>", "Text"),
    (f"<article class='comment'>{LONG}</article><p>{LONG}</p>", GOOD),
    (f"<p hidden>{LONG}</p><p style='display: none'>{LONG}</p><p>{LONG}</p>", GOOD),
    ("<ul>" + "<li><a href=x>A link of the menu</a>" * 20 + "</ul>" + f"<p>{LONG}</p>", GOOD),
    (f"<p>{LONG}<p>x" + "\x00 \t y", GOOD + "\n\nx\x00 y"),
])
def test_block_rules(page, text):
    assert pages.main_text(page) == text


BARE = "Win prizes daily! Huge sale today, click here now, order fast, great offers, members save big, hurry up today"


@pytest.mark.parametrize("page,text", [
    # the article is only a teaser card
    (f"<article><h3>Read more</h3><p>Short.</p></article><div><h1>Title</h1><p>{LONG}</p><p>Short line.</p><p>{LONG}</p></div>",
     "Title\n\n" + GOOD + "\n\nShort line.\n\n" + GOOD),
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><main><p>Teaser of another page</p></main>", GOOD + "\n\n" + GOOD),
    (f"<article><h1>Title</h1></article><div><p>{LONG}</p></div>", "Title\n\n" + GOOD),
    (f"<p>{LONG}</p><p>{LONG}</p><article><p>{LONG}</p></article>", "\n\n".join([GOOD] * 3)),
    # what the text leaves open goes by the mark
    (f"<p>Top.</p><article><h1>Title</h1><p>One.</p><p>{BARE}</p></article><p>{BARE}</p><p>End.</p>", "Title\n\nOne.\n\n" + BARE),
    (f"<p>Top.</p><article><h1>Title</h1><p>{LONG}</p><p>{BARE}</p><p>Last.</p></article><p>End.</p>", f"Title\n\n{GOOD}\n\n{BARE}\n\nLast."),
    # boilerplate without a name inside the article
    (f"<article><p>{LONG}</p><p><a href=x>Share this with all your friends</a></p><p>{BARE}</p><p>© A paper</p></article>", GOOD),
    (f"<article><p><a href=x>Home</a></p><p>You are here</p><p><a href=y>News</a></p><h1>Title</h1><p>{LONG}</p></article>", "Title\n\n" + GOOD),
    # no mark
    (f"<div><p>{BARE}</p><p><a href=x>Link</a></p><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div><p>{BARE}</p></div>",
     f"Title\n\n{GOOD}\n\nShort.\n\n{GOOD}"),
])
def test_rules_decide_beside_marks(page, text):
    assert pages.main_text(page) == text


@pytest.mark.parametrize("tag", ["<video-player src=x></video-player>", "<button-group>", "<svg viewBox='0 > 1'/>", "<math/>", "<button>Go", "<select><option>a<option>b",
                                 "<div><button><i>Go</i> on</div>", "<button>Go<p></p><button>Stop</button>", "<video src=x>", "<svg><path d='M0'>",
                                 "<svg><svg></svg></svg>", "<object><object>no</object>no</object>", "<svg><foreignObject><p>no</p></foreignObject></svg>"])
def test_only_the_skipped_element_is_skipped(tag):
    for tail in ("", "<p><svg></svg><button>x</button><video>y</video></p>"):
        assert pages.main_text(f"<p>{LONG}</p>{tag}<p>{LONG}</p>{tail}") == GOOD + "\n\n" + GOOD
    assert pages.main_text(f"<p>{LONG} <b><button>Go</b> {LONG}</p>") == GOOD + " " + GOOD


@pytest.mark.parametrize("name", ["section class='related-work'", "p class='banner-text'", "div id='legal'", "section id='social-history'", "div class='cookie-recipe'"])
def test_a_hint_in_a_name_is_settled_by_the_text(name):
    tag = name.split()[0]
    for page in ("<article><p>{0}</p><{1}>{0}</{2}></article>", "<p>{0}</p><{1}>{0}</{2}>"):
        assert pages.main_text(page.format(LONG, name, tag)) == GOOD + "\n\n" + GOOD
        assert pages.main_text(page.format(LONG, name, tag).replace(f"{LONG}</{tag}></a", f"Short.</{tag}></a").replace(
            f"{name}>{LONG}", f"{name}>Short.")) == GOOD
        assert pages.main_text(page.format(LONG, name, tag).replace(f"{name}>{LONG}", f"{name}><a href=x>{LONG}</a>")) == GOOD
    assert pages.main_text(f"<{name}>{LONG}</{tag}><article><p>{LONG}</p></article>") == GOOD


@pytest.mark.parametrize("name", ["sidebar", "left-sidebar", "acme-sidebar", "sidebar-content", "related-posts", "cookie-notice", "comment-list", "ad-slot-2",
                                  "social-share-buttons", "site-footer", "newsletter"])
def test_names_of_boilerplate(name):
    for page in ("<article><p>{0}</p><div class='{1}'><p>{0}</p></div></article>", "<p>{0}</p><div id={1}>{0}</div>"):
        assert pages.main_text(page.format(LONG, name)) == GOOD


@pytest.mark.parametrize("n", [10, 7_900, 8_100, 300_000])
def test_attributes_of_any_length(n):
    for q in "'\"":
        assert pages.main_text(f"<div data-x={q}{'a>' * (n // 2)}{q} class='sidebar'><p>{LONG}</p></div><p>{LONG}</p>") == GOOD
        assert pages.main_text(f"<div class='sidebar' data-x={q}{'<' * n}{q}>{LONG}</div><p>{LONG}</p>") == GOOD
    # a quote without its end
    assert pages.main_text(f"<div class=sidebar data-x='{'a' * n}>{LONG}</div><p>{LONG}</p>") == GOOD


def test_only_an_attribute_hides():
    for attr in ("title='the hidden truth'", "data-hidden=1", "data-id='sidebar'", "aria-hidden=false", "class='overflow-hidden'", "alt='class=nav'"):
        assert pages.main_text(f"<p {attr}>{LONG}</p>") == GOOD
    for attr in ("hidden", "aria-hidden='true'", "STYLE='display : none'", "role=banner"):
        assert pages.main_text(f"<p {attr}>{LONG}</p><p>{LONG}</p>") == GOOD


def test_long_blocks_may_begin_with_a_copyright_sign():
    assert pages.main_text(f"<article><p>© {LONG}</p><p>© 2020 A paper of the city</p></article>") == "© " + GOOD
    assert pages.main_text(f"<p>© {LONG}</p><p>© 2020 A paper of the city</p>") == "© " + GOOD


@pytest.mark.parametrize("text", [
    "这个城市的历史很长，也有不少人在这里生活和工作。他们说，过去的日子是艰难的，但是现在好了。" * 4,
    "この町の歴史は長く、多くの人がここに住んでいる。昔の話を聞くと、今の生活がよくわかると彼は言った。" * 4,
    "ประวัติของเมืองนี้ยาวนานและมีผู้คนที่อยู่ในเมืองจำนวนมาก" * 5])
def test_scripts_without_blanks(text):
    assert pages.main_text(f"<div><p>{text}</p><p>© 2020</p></div><div><a href=x>{text[:20]}</a></div>") == text
    assert pages.main_text(f"<article><p>{text}</p></article>") == text


def test_odd_markup_is_linear():
    for page in ('<div class="x' * 20_000, "<p>a" * 20_000, "<script>" * 20_000, "<div>" * 20_000 + "</p>" * 20_000, "<a '" * 20_000, "&amp" * 50_000, "<a '\"" * 20_000, "<a \"\"''" * 20_000,
                 "<a \"'\" '<a'" * 20_000, "<a " + "x='' " * 20_000, "<a x=\"" + "<b y='" * 20_000):
        assert isinstance(pages.main_text(page), str)


def test_pages_odd_rows(spark):
    d = spark.createDataFrame([(1, "u", None, 5), (1, None, "<article>x</article>", 6), (None, "v", "", 7)],
                              "page_id long, url string, html string, text long")
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in pages.extract(d).collect()) == [
        (0, "v", "", 0), (1, "", "x", 1), (1, "u", "", 0)]
    assert pages.extract(d.limit(0)).collect() == []


# ------------------------------------------------------------------ components, vectors

def test_components(spark):
    rng = np.random.default_rng(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, i) for i in range(501, 700)]
    rand = [tuple(map(int, rng.integers(1000, 1100, 2))) for _ in range(60)]
    edges = chain + hub + rand + [(7, 7), (100, 101)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain(rows, least=0.95):
    fine = {}
    for k, (i, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, dtype=float)
            fine[k] = a / np.linalg.norm(a)
    near = {k: [j for j in fine if j != k and len(fine[j]) == len(fine[k]) and fine[j] @ fine[k] >= least] for k in fine}
    comp = {}
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        comp[k] = min(rows[j][0] for j in seen if rows[j][0] is not None) if rows[k][0] is not None else None
    return [(i if i is not None else -1, len(near.get(k, ())), comp[k] if comp[k] is not None else -1) for k, (i, _) in enumerate(rows)]


def test_vectors(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(40):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((len(rows), (base + rng.normal(size=16) * 0.03).tolist()))
    rows += [(len(rows) + i, rows[3][1]) for i in range(5)]  # copies of one vector
    n = len(rows)
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 16), (n + 3, [1.0, None] + [0.0] * 14), (n + 4, [float("nan")] * 16),
             (n + 5, [float("inf")] + [0.0] * 15), (n + 6, [1.0, 0.0]), (n + 7, [2.0, 0.0]), (5, rows[5][1]), (n + 8, [1e-30] + [0.0] * 15)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as label", "'x' as node")
    got = vectors.near_vectors(d).collect()
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id) for r in got) == sorted(plain(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert vectors.near_vectors(d.limit(0)).collect() == []


def test_graph_search_reaches_the_range():
    rng = np.random.default_rng(6)
    v = rng.normal(size=(3000, 24))
    v[:900] = v[0] + rng.normal(size=(900, 24)) * 0.05  # a group larger than the beam
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    g = vectors.Graph(v)
    q, n = g.search(v[:300], 0.95, vectors.BEAM)
    truth = (v[:300] @ v.T >= 0.95).sum()
    assert len(q) >= 0.98 * truth


def grouped(rng, large, pairs, alone):
    """Nodes: a large dense group, pairs, and vectors without links."""
    base = rng.normal(size=16)
    rows = [base + rng.normal(size=16) * 0.02 for _ in range(large)]
    for _ in range(pairs):
        b = rng.normal(size=16)
        rows += [b, b + rng.normal(size=16) * 0.02]
    return [(i, x.tolist()) for i, x in enumerate(rows + list(rng.normal(size=(alone, 16)) * 3))]


def test_audit_sees_lost_pairs(spark):
    rows = grouped(np.random.default_rng(8), 300, 60, 480)
    d = spark.createDataFrame([(i, 1, v) for i, v in rows], "node long, weight long, embedding array<double>")
    truth = {i: n for i, n, _ in plain(rows)}
    for lost, recall in ((lambda i: False, 1.0), (lambda i: 300 <= i < 420, 0.0), (lambda i: i < 150, 0.5)):
        found = spark.createDataFrame([(i, 0 if lost(i) else n) for i, n in truth.items()], "node long, links long")
        assert abs(vectors.audit(d, found, 0.95) - recall) < 0.15
        assert (vectors.audit(d, found, 0.95) >= 0.98) == (recall == 1.0)
    rare = d.where("node >= 418")  # one pair in 482 nodes: drawn on
    found = rare.selectExpr("node", "0L as links")
    assert vectors.audit(rare, found, 0.95, queries=16) == 0.0


def test_no_task_holds_a_large_shard(spark, monkeypatch):
    """A dense group far over the bound is searched in bounded pieces, with the same result."""
    monkeypatch.setattr(vectors, "LIMIT", 60)
    rows = grouped(np.random.default_rng(12), 400, 60, 100)
    nodes = spark.createDataFrame([((i * 0x9E3779B97F4A7C15) % 2**63, 1, v) for i, v in rows], "node long, weight long, embedding array<double>")
    seen = spark.sparkContext.accumulator(0)
    search, bound = vectors._search_shard, 2 * 60 + 60

    def watched(*a):
        run = search(*a)

        def inner(pdf):
            seen.add(len(pdf) > bound)
            return run(pdf)
        return inner

    monkeypatch.setattr(vectors, "_search_shard", watched)
    c = vectors.centroids(vectors._unit([v for _, v in rows]), 4)
    for searches in (3, 4):
        found = vectors._found(nodes, c, 0.95, searches, vectors.BEAM).groupBy("node").sum("links").collect()
        assert len(found) == len(rows) and seen.value == 0
    monkeypatch.setattr(vectors, "SHARD", 150)
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(d).collect()) == sorted(plain(rows))
    assert seen.value == 0


def test_a_search_below_the_bound_raises(spark, monkeypatch):
    monkeypatch.setattr(vectors, "audit", lambda *a: 0.5)
    d = spark.createDataFrame(grouped(np.random.default_rng(9), 3, 2, 5), "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall of 0.5"):
        vectors.near_vectors(d)


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark, sf):
    docs = read(spark, sf, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == read(spark, sf, "documents").columns
        after = docs.count()
        assert 0.5 * before < after <= before
        before = after
    from feedrec.llm import decontaminate, jaccard, secrets
    again = jaccard.near_duplicates(docs)
    assert again.count() == before
    assert decontaminate.report(docs, read(spark, sf, "benchmark")).where("contaminated").count() == 0
    assert secrets.report(docs).where("n_assign + n_access + n_hex > 0").count() == 0
    packed = corpus_pipeline.pack_windows(spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == before


def test_pipeline_stages_on_odd_rows(spark, sf):
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c", "en", "s", 5),
                                 (3, "password=abcdefgh " * 3, "en", "s", 9), (4, "word " * 40_000, "en", "s", 9)],
                                "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'z' as score", "1 as bucket")
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.store(stage(spark, docs, sf), f"odd-{name}")
            assert docs.columns == odd.columns
        assert corpus_pipeline.pack_windows(spark, docs, sf).count() >= docs.select("doc_id").distinct().count()

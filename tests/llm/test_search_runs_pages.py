"""Lexical search, periodic runs and main text against brute force."""

import hashlib
import html
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from rivulet.llm import lexical, pages, queries, runs

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Lexical search


def expected_ranks(docs, items, k=10):
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    number, total = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    holding = {}
    for _, some in terms:
        for t in set(some):
            holding[t] = holding.get(t, 0) + 1
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(LOWER))) & set(holding)
        scored = []
        for doc, some in terms:
            score = 0
            for t in asked & set(some):
                tf = some.count(t)
                w = math.floor(1000 * math.log((2 * number + 2) / (2 * holding[t] + 1)))
                m = 100 - 90 + (90 * len(some) * number) // total
                score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, math.inf if doc is None else doc))
        scored.sort()
        out += [(item, r + 1, None if d == math.inf else d, -s) for r, (s, d) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def random_docs(rng, n, words=40):
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "straße", "x1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [
        rng.choice([" ", ", ", "\n", "-"]).join(rng.choices(vocabulary, weights, k=rng.randint(1, words)))
        for _ in range(n)
    ]
    return list(enumerate(texts))


@pytest.mark.parametrize("cells, block, terms", [(1 << 24, 128, 8192), (2000, 4, 8192), (600, 2, 30)])
def test_search_is_exact(spark, monkeypatch, cells, block, terms):
    monkeypatch.setattr(lexical, "CELLS", cells)
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "ITEM_TERMS", terms)
    rng = random.Random(cells)
    docs = random_docs(rng, 300)
    docs += [(1000 + i, docs[7][1]) for i in range(25)]  # more ties than places
    docs += [(None, docs[7][1]), (2000, None), (2001, ""), (2002, "?! ..."), (7, docs[7][1])]
    items = [(i, t) for i, t in random_docs(rng, 12, 8)]
    items += [(50, docs[7][1]), (50, docs[7][1]), (51, None), (52, ""), (53, "unknown"), (None, "w1 W1")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    # Names that the operator uses inside are no matter.
    d = d.selectExpr("*", "1 as n", "2 as score", "3 as item")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank", "2 as doc_id")
    got = sorted((tuple(r) for r in lexical.search(d, q).collect()), key=repr)
    assert got == expected_ranks(docs, items)


def test_blocks_are_skipped_by_their_bounds_only():
    rng = np.random.default_rng(5)
    rows, terms, values = [], [], []
    for doc in range(3000):
        topic = doc % 30
        some = np.unique(np.append(rng.integers(topic * 10, topic * 10 + 10, 6), rng.integers(300, 320, 4)))
        rows += [doc] * len(some)
        terms += some.tolist()
        values += rng.integers(1, 1000, len(some)).tolist()
    shard = lexical.Shard(np.arange(3000), np.array(rows), np.array(terms), np.array(values), 320)
    scored = 0
    for topic in range(30):
        asked = np.arange(topic * 10, topic * 10 + 10).tolist() + [300, 305, 310]
        asked, weights = np.array(asked), np.array([900.0] * 10 + [30.0] * 3)
        some, everything = lexical.Best(10), lexical.Best(10)
        scored += lexical.look_up(shard, asked, weights, some)
        assert lexical.look_up(shard, asked, weights, everything, skip=False) > 1000
        assert some.scores.tolist() == everything.scores.tolist()
        assert some.ids.tolist() == everything.ids.tolist()
    assert scored < 30 * 300


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs, items).collect() == []
    assert lexical.search(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).collect() == []
    assert lexical.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_of_long_texts_are_whole(monkeypatch):
    text = ("Ab1 été " * 500 + "x" * 300).encode()
    whole = lexical.counted(text)
    monkeypatch.setattr(lexical, "PART", 7)
    assert lexical.counted(text) == whole
    assert whole[0][b"ab1"] == 500 and whole[1] == 1001


# Periodic runs


def expected_runs(words, least=6, times=4):
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                found.setdefault((i, j + p - i), p)
            i = j + 1 if j == i else j
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def expected_digest(doc_id, words):
    found = expected_runs(words)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(found),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{n},{p}\n" for s, n, p in found)),
        sha(kept),
    )


def expected_loop(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("listed", [4, 2048])
def test_runs_by_brute_force(monkeypatch, listed):
    monkeypatch.setattr(runs, "LISTED", listed)
    rng = random.Random(listed)
    for _ in range(600):
        least, times = rng.choice([(6, 4), (6, 4), (2, 2), (8, 2), (9, 3), (3, 5)])
        texts = []
        for _ in range(rng.randint(1, 4)):
            letters = rng.choice([1, 2, 3, 6])
            words = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(0, 50))]
            if words and rng.random() < 0.6:
                a, p = rng.randrange(len(words)), rng.randint(1, 7)
                loop = words[a : a + p]
                words = words[:a] + (loop * 30)[: rng.randint(1, 60)] + words[a:]
            texts.append(words)
        assert runs.runs_of(texts, least, times) == [expected_runs(t, least, times) for t in texts]


def test_runs_of_long_texts():
    assert runs.runs_of([[b"ha", b"ho"] * 50_000]) == [[(0, 100_000, 2)]]
    period = [b"%d" % i for i in range(9_000)]
    assert runs.runs_of([[b"x", *period * 5, b"y"]]) == [[(1, 45_000, 9_000)]]


def test_runs_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [expected_digest(r[0], expected_loop(r[0], WORD.findall(r[1] or ""))) for r in docs]
    got = queries.op12_periodic_runs(spark, SF)
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(w[1] > 0 for w in want) > 5


def test_runs_of_odd_rows(spark):
    loop = "a b\tc \n" * 6
    rows = [(1, loop), (1, loop), (None, loop), (2, None), (3, ""), (4, " \n"), (5, "x " * 6), (6, "x " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as runs", "2 as collapsed", "3 as n_words", "4 as best"
    )
    found = runs.periodic_runs(docs)
    got = [(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in found.collect()]
    of_loop = (18, [(0, 18, 3)], "a b c")
    want = [(1, *of_loop), (1, *of_loop), (None, *of_loop), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], "")]
    want += [(5, 6, [(0, 6, 1)], "x"), (6, 5, [], "x x x x x")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert runs.digests(runs.periodic_runs(runs.looped(docs.limit(0)))).collect() == []
    empty = runs.digests(found).where("doc_id = 2").first()
    assert tuple(empty)[:6] == (2, 0, None, None, None, None)
    assert empty["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, times=1)


# Main text

ODD_PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style>
<script>var t="</p><article>no</article>";</script><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Menu<li>More</ul></nav><div class="site-banner ad-box">Buy</div>
<article data-x="a > b"><header><h1>Title &eacute;</h1></header><div class='ad'><p>Advert</div>
<p>One <b>two</b>\n\t three&#33;<br>four<p class="share">Tell friends<p>5 &lt; 6 < 7<!-- gone > -->
<ul><li>first<li>second</ul><form><p>Mail?<input></form><aside>Side</aside>
<span class="advert">inline <i>advert</i></span>tail<table><tr><td>x<td>y</table>
<section id="comments"><article class="comment"><p>Reader</article></section>
<p hidden>Hidden<p style="display: none">None<footer>By me</footer></article>
<div role="contentinfo">Foot</div></body></html>"""


def test_lines_of_an_odd_page():
    got = pages.lines(ODD_PAGE)
    want = ["Title é", "One two three! four", "5 < 6 < 7", "first", "second", "tail", "x", "y"]
    assert got == [(t, pages.ARTICLE) for t in want]


def test_whole_lines_have_what_markup_rules_out():
    page = "<nav>Menu</nav><p>a <span class=ad>Buy <b>now</b></span>b<aside>Side<p>x</aside>c"
    got = pages.whole_lines(page)
    assert got == [("Menu", pages.GONE), ("a b", 0), ("Buy now", pages.GONE), *[(t, pages.GONE) for t in ("Side", "x")], ("c", 0)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("plain &amp; text", [("plain & text", 0)]),
        ("<p>a<p>b</p></div>c", [("a", 0), ("b", 0), ("c", 0)]),
        ("<main><p>a</main>b", [("a", 1), ("b", 0)]),
        ("<div itemprop=articleBody>a</div>", [("a", 2)]),
        ("<p>a <script>never closed", [("a", 0)]),
        ("<p>a<!-- never closed <p>b", [("a", 0)]),
        ("<p>a<p class='never closed>b", [("a", 0), ("b", 0)]),
        ("<p>a<p class=", [("a", 0)]),
        ("<b><i>a</b> b<div>c", [("a b", 0), ("c", 0)]),
        ("<head><title>t</title><p>a", [("a", 0)]),
        ("<body class='has-sidebar'><div class='no-comments'>a", [("a", 0)]),
        ("<article><p>a" + "<b>b" * 2000 + "</article>c", [("a" + "b" * 2000, 2), ("c", 0)]),
    ],
)
def test_lines(page, want):
    assert pages.lines(page) == want


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            same = table[i][j] + 1 if a[i] == b[j] else 0
            table[i + 1][j + 1] = max(same, table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("table", [1 << 31, 20])
def test_alignment_by_brute_force(monkeypatch, table):
    monkeypatch.setattr(pages, "TABLE", table)
    rng = random.Random(table)
    for _ in range(500):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(0, 18))] for _ in range(2))
        found = pages.shared_lines(a, b)
        assert found == sorted(set(found)) and len(found) == longest(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def test_pages_without_article_lose_what_their_neighbour_has(spark):
    def page(*own):
        return "".join(f"<div>{t}</div>" for t in ("Site", *own[:1], "Subscribe now", *own[1:], "Imprint"))

    rows = [
        (1, "http://a.org/news/1", page("one", "two")),
        (2, "http://a.org/news/2", page("three")),
        (3, "https://A.org/news/2?copy", page("three")),  # the same page again
        (4, "http://a.org/sport/9.html", page("four", "five")),
        (5, "http://b.org/news/1", page("six")),  # alone on its host
        (6, None, page("seven")),
        (7, "http://c.org/1", "<p>x<p>y"),
        (8, "http://c.org/2", "<p>x<p>y<p>z"),
        (9, "http://a.org/news/3", None),
        (None, "http://a.org/news/1", page("one", "two")),
        (10, "http://a.org/news/1b", "<article><p>Site<p>Imprint</article>"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r[0]: r[2] for r in pages.main_text(frame.selectExpr("*", "1 as host", "2 as keep", "3 as lines")).collect()}
    assert got == {
        1: "one\n\nSubscribe now\n\ntwo",  # its neighbour is page 10, whose article has two of its lines
        None: "one\n\nSubscribe now\n\ntwo",
        2: "three\n\nSubscribe now",
        3: "three\n\nSubscribe now",
        4: "four\n\nfive",
        5: "Site\n\nsix\n\nSubscribe now\n\nImprint",
        6: "Site\n\nseven\n\nSubscribe now\n\nImprint",
        7: "x\n\ny",
        8: "z",
        9: "",
        10: "Site\n\nImprint",
    }
    assert pages.main_text(frame.limit(0)).collect() == []


def test_pages_with_an_article_are_compared_with_their_neighbour_too(spark):
    menu, foot = "<nav><a>Home</a></nav>", "<footer>Imprint</footer>"
    rows = [
        (1, "http://a.org/1", f"{menu}<article><h1>one</h1><p>quoted<p>more</article><p>Mail us{foot}"),
        (2, "http://a.org/2", f"{menu}<article><h1>two</h1><p>quoted</article><p>Mail us{foot}"),
        # Names no article: what is the neighbour's menu or footer is the site's here too.
        (3, "http://a.org/2b", "<div>Home</div><div>three</div><div>Imprint</div>"),
        (4, "http://b.org/1", f"{menu}<main>quoted</main>{foot}"),  # alone on its host
        (5, "http://c.org/1", f"{menu}{foot}"),
        (6, "http://c.org/2", f"{menu}<p>six{foot}"),
        # A copy but for its menu is not the page next door of the page that it copies.
        (7, "http://d.org/1", f"{menu}<p>Top<p>seven{foot}"),
        (8, "http://d.org/2", f"<nav>Other</nav><p>Top<p>seven{foot}"),
        (9, "http://d.org/3", f"{menu}<p>Top<p>nine{foot}"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_lines"], r["n_shared"]) for r in pages.main_text(frame).collect()}
    assert got == {
        1: ("one\n\nquoted\n\nmore", 4, 2),  # the quotation comes back, it is the article's
        2: ("two\n\nquoted", 3, 0),  # of its neighbours, the one by path is page 3
        3: ("three", 3, 2),
        4: ("quoted", 1, 0),
        5: ("", 0, 0),
        6: ("six", 1, 0),
        7: ("seven", 2, 1),
        8: ("seven", 2, 1),
        9: ("nine", 2, 1),
    }


@pytest.mark.parametrize("few", [3, 1000])
def test_neighbours_by_a_sequential_model(spark, monkeypatch, few):
    monkeypatch.setattr(pages, "FEW", few)
    rng = random.Random(few)
    tags = {pages.GONE: "nav", pages.OPEN: "p", pages.ARTICLE: "article"}
    rows, hosts = {}, {}
    for i in range(120):
        # Lines in one order, so that two pages share those in both.
        took = sorted(rng.sample(range(30), rng.randint(2, 12)))
        zones = [pages.GONE, pages.OPEN, *[pages.ARTICLE] * (i % 2)]
        lines = [(f"line {j}", rng.choice(zones)) for j in took] + [(f"own {i}", pages.OPEN)]
        host, path = f"h{rng.choice([0, 0, 0, 1, 2])}.org", "/" + "".join(rng.choices("abc", k=5)) + str(i)
        rows[i] = (f"http://{host}{path}", lines)
        hosts.setdefault(host, []).append((path, i))
    want = {}
    for found in hosts.values():
        found.sort()
        for k, (path, i) in enumerate(found):
            two = [found[j] for j in (k - 1, k + 1) if 0 <= j < len(found)]
            _, near = max(two, key=lambda p: len(os.path.commonprefix([path, p[0]])))
            theirs = {t for t, _ in rows[near][1]}
            left = [(t, z) for t, z in rows[i][1] if z != pages.GONE]
            best = max(z for _, z in left)
            text = [t for t, z in left if z == best and (best > pages.OPEN or t not in theirs)]
            want[i] = ("\n\n".join(text), len(left), sum(t in theirs for t, _ in left))
    made = [(i, u, "".join(f"<{tags[z]}>{t}</{tags[z]}>" for t, z in x)) for i, (u, x) in rows.items()]
    frame = spark.createDataFrame(made, "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_lines"], r["n_shared"]) for r in pages.main_text(frame).collect()}
    assert got == want


def test_neighbours_of_a_hot_host_are_the_same_in_chunks(spark):
    spark.conf.set("spark.rivulet.rowsPerChunk", "20")
    try:
        rows = [(i, f"http://a.org/p/{i:04d}", f"<p>Site<p>own {i}<p>group {i // 5}<p>End") for i in range(400)]
        frame = spark.createDataFrame(rows, "page_id long, url string, html string")
        got = {r[0]: r[2] for r in pages.main_text(frame).collect()}
    finally:
        spark.conf.unset("spark.rivulet.rowsPerChunk")
    # The neighbour of a first page of ten is the next one; else, equally near, the one before.
    assert got == {i: f"own {i}" + (f"\n\ngroup {i // 5}" if i % 10 == 5 else "") for i in range(400)}


def test_a_host_of_more_pages_than_a_tasks_share_is_spread(spark, monkeypatch):
    rows = [(i, f"http://{'a' if i % 4 else i}.org/p/{i:04d}", f"<article><p>Site<p>own {i}</article>") for i in range(400)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    plans, found = [], []
    for few in (10, 1000):
        monkeypatch.setattr(pages, "FEW", few)
        made = pages.main_text(frame)
        plans.append(made._jdf.queryExecution().optimizedPlan().toString())
        found.append(sorted(tuple(r) for r in made.collect()))
    assert found[0] == found[1]
    assert [r[4:] for r in found[0]] == [(2, 1 if i % 4 else 0) for i in range(400)]
    # A task's share is 100 pages; the host has 300.
    assert "_chunk" in plans[0] and "_chunk" not in plans[1]


def test_articles_of_the_given_pages(spark):
    given = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.op13_main_text(spark, SF).collect()}
    assert len(got) == len(given)
    for r in given:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        blocks = [re.sub(r"<[^>]*>", "", part) for part in re.split(r"<(?:/?p|/?h1)>", inner.replace("<br>", " "))]
        blocks = [" ".join(WORD.findall(html.unescape(b))) for b in blocks]
        want = "\n\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want
        assert got[r["page_id"]]["n_chars"] == len(want)

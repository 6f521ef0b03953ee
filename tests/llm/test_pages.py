import html
import random
import re
import time

import numpy as np

from lakeloom.llm import pages, queries
from lakeloom.llm.common import read_table
from tests.conftest import SF


def test_query_gives_the_articles(spark):
    source = {r["page_id"]: r["html"] for r in read_table(spark, SF, "pages").collect()}
    rows = queries.queries()["op8_main_text"](spark, SF).collect()
    assert len(rows) == len(source)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", source[r["page_id"]], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner))).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_ranks_are_a_suffix_order():
    rng = random.Random(5)
    for n in (1, 2, 30, 200):
        t = np.array([rng.randint(0, 3) for _ in range(n)])
        for depth in (1, 3, 6, 8):
            rank = pages.suffix_ranks(t, depth)
            keys = [tuple(t[i : i + depth]) for i in range(n)]
            assert all((rank[i] < rank[j]) == (keys[i] < keys[j]) for i in range(n) for j in range(n))


def runs(stream, n):
    return [tuple(stream[i : i + n]) for i in range(len(stream) - n + 1)]


def test_counts_and_coverage_equal_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        streams = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(1, 7))]
        want = {}
        for s in streams:
            for r in set(runs(s, 3)):
                want[r] = want.get(r, 0) + 1
        names = {int(h): r for s in streams for h, r in zip(pages.run_hashes([s], 3)[0], runs(s, 3))}
        hashes, counts = pages.run_counts(streams, 3)
        assert {names[int(h)]: int(c) for h, c in zip(hashes, counts)} == want and len(hashes) == len(want)
        for s in streams:
            flags = [False] * len(s)
            for i, r in enumerate(runs(s, 3)):
                if want[r] >= 3:
                    flags[i : i + 3] = [True] * 3
            assert pages.covered(s, hashes[counts >= 3], 3).tolist() == flags


def page(body):
    return f"<html><head><title>t</title><style>a{{}}</style></head><body>{body}</body></html>"


def test_markup():
    text = lambda h: " ".join(t for k, t in pages.parse(h) if k == 2)
    cases = {
        "<nav>n</nav><article><h1>A</h1><p>b<b>c</b> d<br>e<p>f</article><footer>x</footer>": "A bc d e f",
        "<main>one<div class='ad'>no</div><form><p>no</form>two<aside>no</aside></main>": "one two",
        "<article>a&amp;b &lt;p&gt; &eacute;&#8364; x&nbsp;y</article>": "a&b <p> é€ x y",
        "<article>a<script>if (a < b) { '</p>' }</script>b<!-- c <p> -->c<style>p{}</style></article>": "abc",
        "<article><header><h1>T</h1></header>x<div id=comments><p>no</div><section class='cookie-notice'>no</section></article>": "T x",
        "<article>open <p>unclosed": "open unclosed",
        "<article>a</p></div>b</article>": "a b",
        "<div role='main'>m</div><div role=navigation>n</div>": "m",
        "<article><div hidden>no</div><p style='display: none'>no</p>yes</article>": "yes",
        "<article>5 < 6 and <3</article>": "5 < 6 and <3",
        "<div class='layout has-sidebar'><article>in</article></div>": "in",
        "<article><script>never closed": "",
        # End tags that HTML implies, and raw elements that ignore a slash.
        "<article><p class='share'>Share<p>Real one<p>Real two</article>": "Real one Real two",
        "<article><ul><li class='ad'>Buy<li>Real item</ul></article>": "Real item",
        "<article><dl><dt class='ad'>no<dd>yes</dl><table><tr><td class=ad>no<td>cell<tr><td>row</table></article>": "yes cell row",
        "<article><script src='x'/>var a=1;</script>text</article>": "text",
        "<article>a<svg><text>no</text></svg><svg/>b<template>no</template></article>": "ab",
        "<article><b>bold<p>one</b>two<div>three</div></article>": "bold onetwo three",
        "<article><a class='share' href='/'>Share<p>x</a>yes <i>i</i></article>": "yes i",
        "<article>a <!--> b <!-- c --> d <?php e > f</article>": "a b d f",
        "<article><p title='a > b'>quoted</p><p title=\"unclosed>x</article>": "quoted x",
        # One word of a class name says little about a part that holds the text.
        "<main><div class='page search-results'><p>Real body</div></main>": "Real body",
        "<article><h1>T</h1><div class='post-content header-image login-required'>Real body text</div></article>": "T Real body text",
        "<form id='aspnetForm'><main>All of a page</main><div class='siteFooter'>no</div></form>": "All of a page",
        "<article>short<div class='ad'>an advert that is longer than the article</div></article>": "short",
        "<article>short<section id='comments'>comments that are longer than the article</section></article>": "short",
    }
    for body, want in cases.items():
        assert text(page(body)) == want, body
    assert pages.parse(None) == pages.parse("") == []


def test_repeated_runs_outside_the_article_go(spark):
    notice = "please accept our terms before you read on this site"
    rows = [(i, "http://h.example/x", page(f"<div>{notice} unique{i} words{i}</div><article>story {i} {notice}</article>")) for i in range(4)]
    rows += [(10, "http://h.example/y", page(f"<div><p>{notice}</p><p>a page without an article</p></div>")), (11, None, None), (12, "", ""), (12, "", "")]
    rows += [(20 + i, "http://copies.example/z", page("<div>copied page with many words that all copies share</div>")) for i in range(5)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"]) for r in pages.main_text(df).collect()]
    by = dict(got)
    assert len(got) == len(rows)
    for i in range(4):
        assert by[i] == f"unique{i} words{i} story {i} {notice}"
    assert by[10] == "a page without an article" and by[11] == by[12] == "" and by[22] == "copied page with many words that all copies share"
    assert pages.main_text(df.where("false")).count() == 0


def test_result_does_not_depend_on_shards(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, "http://big.example/", page(f"<p>the same long notice stands on every page here</p><article>{i} text</article>")) for i in range(100)]
    # A passage on a few pages only, unmarked bodies without an article, copies, and near copies.
    words = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 999)) for _ in range(n))
    passage, shared = words(12), words(60)
    bodies = {200 + i: words(40) for i in range(30)}
    rows += [(i, "http://big.example/b", page(f"<div>{passage}</div><p>{b}</p>" if i % 10 == 0 else f"<p>{b}</p>")) for i, b in bodies.items()]
    rows += [(300 + i, "http://big.example/c", page(f"<p>{shared} own{i}</p>")) for i in range(5)] + [(400, "http://big.example/c", page(f"<p>{shared} own0</p>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"{i} text" for i in range(100)} | bodies | {300 + i: f"{shared} own{i}" for i in range(5)} | {400: f"{shared} own0"}
    for size in (1 << 20, 4000, 300):
        monkeypatch.setattr(pages, "SHARD", size)
        assert {r["page_id"]: r["text"] for r in pages.main_text(df).collect()} == want


def test_hostile_markup_takes_time_in_proportion():
    began = time.time()
    for hostile in ("<a \"" * 250_000, "<p>x" * 100_000 + "</b>" * 100_000, "<div>" * 200_000, "<b><p>" * 150_000 + "</b>" * 50_000, "<a b='" * 150_000, "<!--" * 200_000, "<script>" * 100_000, "<li class=ad>" * 70_000, "</" * 400_000, "<td>" * 200_000 + "</p>" * 50_000):
        pages.parse(hostile)
    assert time.time() - began < 20


def test_long_page(spark):
    long = page("<article>" + "<p>word word</p>" * 40_000 + "</article>")
    assert pages.main_text(spark.createDataFrame([(1, "http://a/", long)], "page_id long, url string, html string")).first()["n_chars"] == 40_000 * 10 - 1

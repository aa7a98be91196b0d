"""The cut against brute force, blocks of odd markup, whole pages of several kinds, and the query next to the articles of the given pages."""

from __future__ import annotations

import html
import itertools
import random
import re

import pytest

from tierline.llm import html_extraction as H
from tierline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LONG = "A paragraph that says what there is to say on this, in a sentence of quite some words."


def cost(side, scores, edges):
    own = sum(-s for s, x in zip(scores, side) if x and s < 0) + sum(s for s, x in zip(scores, side) if not x and s > 0)
    return own + sum(c for a, e in enumerate(edges) for b, c in e if a < b and side[a] != side[b])


def test_minimum_cut_equals_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 9)
        scores, edges = [rng.randrange(-9, 10) for _ in range(n)], [[] for _ in range(n)]
        for a, b in itertools.combinations(range(n), 2):
            if rng.random() < 0.5:
                c = rng.randrange(1, 6)
                edges[a].append((b, c))
                edges[b].append((a, c))
        least = min((cost(s, scores, edges), sum(s)) for s in itertools.product((False, True), repeat=n))
        got = H.minimum_cut(scores, edges)
        assert (cost(got, scores, edges), sum(got)) == least


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a&amp;b &lt;i&gt; &eacute;&nbsp;&#x41;\n\t c", ["a&b <i> é A c"]),
        ("<p>one<p>two<b>three<p>four</b> five", ["one", "twothree", "four five"]),
        ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><th>c<td><p>d</table>e", ["a", "b", "c", "d", "e"]),
        ("<p>x<script>if (a < b) '</p><p>no'</script>y<style>p > q {}</style>z", ["xyz"]),
        ("<head><title>t</title><p>body without a start", ["body without a start"]),
        ("<p>a<!-- <p>no</p> --->b<!doctype x><?php no ?>c", ["abc"]),
        ("<p>1 < 2 <3 </ 4 <a href='x>y'>5</a>", ["1 < 2 <3 </ 4 5"]),
        ('<p>a<b title="never ends>c</b> d', ["ac d"]),
        ("<p>a <textarea>no</textarea><select><option>no</select><button>no</button><svg><text>no</text></svg> b", ["a b"]),
        ("<p>a<br>b<br/>c</p>d", ["a b c", "d"]),
        ("<p hidden>no</p><div style='display: none'><p>no</div><p aria-hidden=true>no</p><p>yes", ["yes"]),
        ("<p>cut off <em>he", ["cut off he"]),
        ("<p>cut in a tag <em cla", ["cut in a tag"]),
        ("<p>&am</p><p>&amp</p>", ["&am", "&"]),
    ],
)
def test_blocks(page, want):
    assert [b.text for b in H.blocks_of(page)[0]] == want


def test_an_article_among_everything_else():
    page = f"""<!doctype html><html class="no-js"><head><title>T</title><script>var a = "<p>x</p>"</script></head><body class="has-sidebar">
    <header id="top"><h1>Site name</h1><p>{LONG}</p></header><div class="cookie-notice">{LONG}</div>
    <div id="main-nav"><a href=x>Home</a> | <a>About us</a></div><div class="breadcrumbs">You are here</div>
    <div class="layout with-sidebar"><div class="post-content"><header class="entry-header"><h1><a href="/x">The title</a></h1></header>
    <p>{LONG} First.<p>Short.<ul><li>one<li>two &amp; three<li>four</ul><div class="ad-slot"><p>{LONG}</p></div>
    <table><tr><td>a<td>b<tr><td>c<td>d</table><blockquote>Quote&nbsp;of   someone<br>else.</blockquote>
    <form><label>Name</label><input><p>{LONG}</p></form><aside><p>{LONG}</p></aside><p>{LONG} Last.</p></div>
    <div class="sidebar"><h3>Popular</h3><article class="content"><p>{LONG}</p></article></div></div>
    <section id="comments"><h2>3 comments</h2><article class="comment"><p>{LONG * 9}</p></article><article><p>{LONG * 9}</p></article></section>
    <footer>&copy; 2020 Someone. All rights reserved.</footer>"""
    want = ["The title", f"{LONG} First.", "Short.", "one", "two & three", "four", "a", "b", "c", "d", "Quote of someone else.", f"{LONG} Last."]
    assert H.extract(page).split("\n") == want
    moved = page.replace('<div class="post-content">', "<article>").replace("Last.</p></div>", "Last.</p></article>")
    assert H.extract(moved).split("\n") == want


def test_a_page_without_marks():
    page = f"""<body><div><a>Home</a> <a>News</a> <a>Sport</a></div><div><div><h1>Title of the page</h1><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div>
    <div><ul><li><a>Link one</a><li><a>Link two here</a></ul></div></div><div>Copyright 2020 Example Inc. All rights reserved.</div>"""
    assert H.extract(page).split("\n") == ["Title of the page", LONG, "Yes.", LONG]


def test_a_boilerplate_word_around_the_whole_page_is_not_believed():
    assert H.extract(f'<div class="promo-layout"><article><p>{LONG}</p></article></div><div>x</div>') == LONG
    assert H.extract(f'<div class="comments"><article><p>{LONG}</p></article></div><div>x</div>') == ""


def test_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "plain text & more"), (None, f"<article><p>{LONG}"), (4, "plain text & more"), (5, "<div>" * 3000 + "x"), (6, "<"), (7, "<nav>a</nav>")]
    pages = spark.createDataFrame([(*r, None, "7", "7") for r in rows], "page_id long, html string, url string, text string, n_chars string")
    got = {(r["page_id"], r["text"], r["n_chars"]) for r in H.main_text(pages).collect()}
    assert got == {(1, "", 0), (2, "", 0), (3, "", 0), (4, "plain text & more", 17), (None, LONG, len(LONG)), (5, "", 0), (6, "<", 1), (7, "", 0)}
    assert H.main_text(pages).count() == len(rows) and H.main_text(pages.limit(0)).count() == 0
    assert H.extract("<article>" + "<p>one &amp; two</p>" * 20_000) == "\n".join(["one & two"] * 20_000)


def test_query_returns_the_article_of_every_page(spark):
    want = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.DOTALL).group(1)
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        want[r["page_id"], r["url"]] = "\n".join(p for p in parts if p)
    got = QUERIES["op11_html_extraction"](spark, SF).collect()
    assert {(r["page_id"], r["url"]): r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)

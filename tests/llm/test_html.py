"""Main text of pages made by hand and of the test table."""

from __future__ import annotations

import random
import re
import time
from html import unescape

import pytest

from aerolap.llm.html import LEVELS, extract, main_text, parse

LONG = "A sentence of the article, with commas, and more words than a menu has. " * 3

CASES = [
    ("", ""), ("   ", ""), ("plain text only", "plain text only"), ("a &lt;b&gt; &amp;amp; c", "a <b> &amp; c"),
    ("<p>one<p>two", "one\ntwo"), ("<p>a\n  b<br>c</p>", "a b c"), ("<p>a<b>b</b>c <i>d</i></p>", "abc d"),
    (f"<nav><a href=x>Menu</a></nav><article><h1>T</h1><p>{LONG}</p></article><footer>foot</footer>",
     f"T\n{LONG.strip()}"),
    (f"<div class='ad'>Buy</div><div id=content><p>{LONG}</p><div class=ads>x</div><p>End.</p></div>",
     f"{LONG.strip()}\nEnd."),
    (f"<article><p>{LONG}</p><script>var t='<p>no</p>';</script><style>p{{}}</style><p>z</p></article>",
     f"{LONG.strip()}\nz"),
    (f"<header><h1>Site</h1></header><main><p>{LONG}</p><form><p>Name</p><input></form></main>"
     f"<aside><p>{LONG}</p></aside>", LONG.strip()),
    (f"<article><p>{LONG}</p></article><section id='comments'><p>{LONG}</p><p>{LONG}</p></section>", LONG.strip()),
    (f"<div class='cookie-notice'><p>{LONG}</p></div><article><p>{LONG}</p><ul><li>a<li>b</ul></article>",
     f"{LONG.strip()}\na\nb"),
    (f"<!-- <p>no</p> --><article><!-- a > b --><p title='a>b'>{LONG}</p></article>", LONG.strip()),
    ("<article>x</article>", "x"),
    ("<article><p>unclosed <b>bold<p>next</article><footer><p>f</p></footer>", "unclosed bold\nnext"),
    ("<div style='display:none'><p>hidden</p></div><p>seen</p>", "seen"),
    ("<p>caf&eacute; &#233; &#xe9; &nbsp; x</p>", "café é é x"),
    ("<script>never closed <p>x</p>", ""),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("a < b and c > d", "a < b and c > d"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_cases(page, want):
    assert main_text(page) == want


SECTION = "".join(f"<p>{i}, {LONG}</p>" for i in range(20))
SECTION_TEXT = "\n".join(f"{i}, {LONG.strip()}" for i in range(20))


@pytest.mark.parametrize("n", [1, 3])
@pytest.mark.parametrize("outer", ["article", "main", "div"])
def test_short_sections_beside_a_long_one(outer, n):
    short = "".join(f"<p>Short {i}.</p>" for i in range(n))
    page = (f"<nav><a href=x>Menu</a></nav><{outer}><h1>T</h1><section>{SECTION}</section>"
            f"<section><h2>H</h2>{short}</section><ul><li>a<li>b</ul><table><tr><td>c</table>"
            f"<figure><figcaption>d</figcaption></figure><div>e</div>bare</{outer}>")
    want = ["T", SECTION_TEXT, "H", *(f"Short {i}." for i in range(n)), "a", "b", "c", "d", "e", "bare"]
    assert main_text(page) == "\n".join(want)


def test_sections_below_wrappers_and_a_plain_menu():
    page = (f"<body><div><a href=x>Home</a> | <a href=y>About us</a></div><div><div><section>{SECTION}</section></div>"
            "<div><section><p>Short.</p></section></div></div></body>")
    assert main_text(page) == f"{SECTION_TEXT}\nShort."


@pytest.mark.parametrize("page,want", [
    ("<article><p class=ad>Buy<p>Text one</p><p>Text two</p></article>", "Text one\nText two"),
    ("<article><p class=ad>Buy<div>Text one</div><p>Text two</article>", "Text one\nText two"),
    ("<article><ul><li class=ad>x<li>real<li class=ad><p>x<li>more</ul><p>end</p></article>", "real\nmore\nend"),
    ("<article><dl><dt class=ad>x<dd>real<dd class=ad>y<dt>more</dl></article>", "real\nmore"),
    ("<article><table><tr class=ad><td>x<td>y<tr><td>real<td class=ad><div>z<td>more</table>end</article>",
     "real\nmore\nend"),
    ("<article><table><tbody><tr class=ad><td>x<tbody><tr><td>real</table></article>", "real"),
    ("<article><table><tr class=ad><td><table><tr><td>x</table>y<tr><td>real</table></article>", "real"),
    ("<article><p>a <span class=ad>x<p>real</p></article>", "a\nreal"),
    ("<article><p>a <span class=ad>x <span>y</span> <b>z</b></span> b</p><p>c, longer</p></article>", "a\nb\nc, longer"),
    ("<article><div class=ad><a href=x>Buy</div><p>real, not linked</p></article>", "real, not linked"),
    ("<head><meta charset=utf-8><body><article><p>real</p></article>", "real"),
])
def test_unwanted_elements_end_where_others_do(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("names", [
    "style='overflow:hidden'", "class='overflow-hidden'", "class='content has-sidebar'", "class='no-sidebar'",
    "class='post with-comments'", "data-class='ad'", "title='hidden class=ad'", "data-state=hidden",
    "class='card--no-footer'", "id='hasComments'"])
@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_names_that_only_contain_an_unwanted_word(tag, names):
    """Beside a longer text, so that only the name decides."""
    page = f"<div><{tag} {names}><p>Kept.</p></{tag}><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(page) == "\n".join(["Kept.", LONG.strip(), LONG.strip()])


@pytest.mark.parametrize("names", [
    "class=sidebar", "class='left-sidebar'", "id=sidebarLeft", "class='x comments'", "class='comment-list'",
    "class='site-footer'", "class='main-nav'", "id='ad-container'", "hidden", "hidden=''", "aria-hidden=true",
    "style='color:red; display : none'", "style='visibility:hidden'", "role=navigation"])
def test_unwanted_names(names):
    assert main_text(f"<article><p>{LONG}</p><div {names}><p>Gone.</p></div></article>") == LONG.strip()


@pytest.mark.parametrize("opening", [
    "<div class=widget>", "<form action=x>", "<article class=sidebar>", "<div class=widget><div id=share>",
    "<div style='display:none'>", "<div role=dialog>", "<article><h1>T</h1><div class=promo>"])
def test_an_element_with_most_of_the_text_stays(opening):
    page = f"<nav><p><a href=x>{LONG * 9}</a></p></nav>{opening}<p>{LONG}</p><p class=ad>Buy</p><p>{LONG}</p>"
    assert main_text(page).removeprefix("T\n") == f"{LONG.strip()}\n{LONG.strip()}"


def test_comments_in_code():
    code = "<pre><code>x = 1 <span class='comment'># one</span>\n<b class=ad>y</b></code></pre>"
    page = f"<article><p>{LONG}</p>{code}<p>a <code>b <i class=comment>c</i></code> d <i class=ad>e</i></p></article>"
    assert main_text(page) == f"{LONG.strip()}\nx = 1 # one y\na b c d"


def test_links_cost_a_container_its_place():
    menu = "".join(f"<p><a href=x>Item {i}, with, many, commas, here</a></p>" for i in range(30))
    assert main_text(f"<div>{menu}</div><div><p>{LONG}</p></div>") == LONG.strip()


def test_a_very_long_and_deep_page():
    body = "".join(f"<p>{i}, {LONG}</p>" for i in range(3000))
    assert main_text(f"<nav>x</nav><article>{body}</article>").count("\n") == 2999
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


BIO = "<p>Jo writes about ships, and lives by the sea.</p>"
TEXT = LONG.strip()


@pytest.mark.parametrize("page,want", [
    (f"<div id=content><p>{LONG}</p><p>{LONG}</p></div><div class=bio>{BIO}</div>", [TEXT, TEXT]),
    (f"<div class=x>Buy this</div><div id=content><p>{LONG}</p></div><div class=bio>{BIO}</div>", [TEXT]),
    (f"<div class=row><div class=col-a><p>{LONG}</p><p>{LONG}</p></div><div class=col-b>{BIO}</div></div>", [TEXT] * 2),
    (f"<div class=part1><p>{LONG}</p><p>{LONG}</p></div><div class=part2><p>Short.</p></div>", [TEXT, TEXT, "Short."]),
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><div><p>Short.</p></div><div class=bio>{BIO}</div>", [TEXT, TEXT, "Short."]),
    (f"<h1>T</h1><div class=a><p>{LONG}</p></div><p>Between.</p><div class=b>{BIO}</div>", ["T", TEXT, "Between."]),
    (f"<div class=entry><div class=a><p>{LONG}</p><p>{LONG}</p></div><div class=note>Note.</div></div>"
     f"<div class=b>{BIO}</div>", [TEXT, TEXT, "Note."]),
    (f"<div class=entry><div class=a><p>{LONG}</p></div></div><div class=entry-end>End.</div>", [TEXT, "End."]),
    (f"<table><tr><td class=left>{BIO}<td class=mid><p>{LONG}</p><p>{LONG}</p><td>Plain</table>", [TEXT, TEXT, "Plain"]),
    (f"<div class=left><p>{LONG}</p><p>{LONG}</p></div><div class=right><p>{LONG}</p><p>{LONG}</p></div>", [TEXT] * 4),
    (f"<div>One, {LONG}</div><div>Two, {LONG}</div><div>Three, {LONG}</div><div>4.</div>",
     [f"One, {TEXT}", f"Two, {TEXT}", f"Three, {TEXT}", "4."]),
    (f"<body class=page><div><a href=x>Home</a> <a href=y>News</a></div><div id=text>{LONG}</div></body>", [TEXT]),
    (f"<div role=main><div class=a><p>{LONG}</p></div><div class=b>Kept.</div></div><div class=c>Gone.</div>",
     [TEXT, "Kept."]),
    (f"<section id=a><p>{LONG}</p></section><section id=b><p>Short.</p></section>", [TEXT, "Short."]),
    (f"<div id=content><p>{LONG}</p><div class=quote>Said.</div><pre class=x>code</pre></div>", [TEXT, "Said.", "code"]),
    (f"<div class=a><p>{LONG}</p><p>{LONG}</p></div><h2 id=s>H</h2><ul class=l><li>i</ul>", [TEXT, TEXT, "H", "i"]),
])
def test_pages_without_an_article(page, want):
    assert main_text(page) == "\n".join(want)


def test_points_by_brute_force():
    """Sums over ancestors of every paragraph, on random trees."""
    rng = random.Random(3)
    for _ in range(200):
        page = "".join(rng.choice(["<div>", "<section>", "<div>", "</div>", "</section>", "a, b, c", LONG,
                                   "<a href=x>link</a>", "<p>", "<ul><li>", "</ul>"]) for _ in range(40))
        tree = parse(page)
        nodes = [tree.root]
        for node in nodes:
            nodes += node.children
        points, length, linked = ({id(n): 0 for n in nodes} for _ in range(3))
        for node in nodes:
            for i in node.own:
                s, up, level = tree.paragraphs[i], node, 0
                while up is not None:
                    share = LEVELS[min(level, len(LEVELS) - 1)] / LEVELS[0]
                    points[id(up)] += (1 + s.count(",") + min(len(s) / 100, 3)) * share
                    length[id(up)] += len(s)
                    linked[id(up)] += tree.linked[i]
                    up, level = up.parent, level + 1
        assert sum(len(n.own) for n in nodes) == len(tree.paragraphs)
        for node in nodes:
            assert node.points == pytest.approx(points[id(node)])
            assert (node.length, node.linked) == (length[id(node)], linked[id(node)])


@pytest.mark.parametrize("page", [
    "<div>x" * 100_000, "<div class=ad>x" * 100_000, "<span class=ad>x" * 100_000, "<li><div>" * 50_000 + "x",
    "<svg>" * 100_000, "<div>" * 100_000 + "</p></li><li>x</li>" * 20_000,
    "<span class=ad>" * 50_000 + "<div></div>" * 50_000, "<div class=ad><article>x" * 50_000])
def test_time_grows_with_length_not_depth(page):
    begin = time.process_time()
    main_text(page)
    assert time.process_time() - begin < 20           # 8,000 nested div took 16 s when it was quadratic


def test_an_unwanted_article_beside_the_text_is_no_article():
    page = f"<nav><p>{LONG}</p><p>{LONG}</p></nav><article><nav>{BIO}</nav></article>"
    assert main_text(page) == f"{TEXT}\n{TEXT}"


def test_pages_table(spark):
    """The table's articles, cut out by pattern: its pages are made of one
    article, its heading and paragraphs."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"] or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", article[1]) if article else []
        plain = (" ".join(unescape(re.sub(r"<[^>]*>", " ", b) if "<br>" in b else re.sub(r"<[^>]*>", "", b)).split())
                 for b in blocks)
        assert got[r["page_id"]]["text"] == "\n".join(b for b in plain if b)
        assert got[r["page_id"]]["url"] == r["url"]


def test_nulls_clashes_and_empty(spark):
    df = spark.createDataFrame([(1, None, None, "old"), (1, "u", "<p>x</p>", "old"), (None, "u", "", "old")],
                               "page_id bigint, url string, html string, text string")
    out = extract(df)
    assert out.columns == ["page_id", "url", "text"]
    assert sorted(r["text"] for r in out.collect()) == ["", "", "x"]
    assert extract(df.limit(0)).collect() == []

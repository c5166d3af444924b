"""Main text of pages of several layouts, broken ones among them."""

from __future__ import annotations

import html
import math
import re
import time

import pytest

from rowwarden.llm import html_text, queries

P1 = "The river rose in the night, and by morning the lower fields were under water; nobody was hurt."
P2 = "Farmers moved their herds to the hills, where the grass is thin. They expect to wait a week or more."
P3 = "A council meeting is set for Friday. It will decide on the dike, the road and the old mill."
NAV = '<ul class="menu"><li><a href="/a">Home</a></li><li><a href="/b">World news</a></li><li><a href="/c">Sport</a></li></ul>'

LAYOUTS = {
    "article": f"<html><body><nav>{NAV}</nav><article><h1>Flood</h1><p>{P1}</p><p>{P2}</p></article><footer>All rights reserved. Some &amp; more.</footer></body></html>",
    "divs": f'<body><div id="header"><a href="/">Site name</a></div>{NAV}<div class="content"><h1>Flood</h1><p>{P1}<p>{P2}</div><div class="sidebar"><p>Most read: five ways to cook rice, said the chef.</p></div></body>',
    "plain": f"<body>{NAV}<div><h1>Flood</h1><p>{P1}</p><p>{P2}</p></div><div><a href='/x'>Next page</a> <a href='/y'>Older</a></div></body>",
    "comments": f'<main><article><header><h1>Flood</h1></header><p>{P1}</p><p>{P2}</p></article><section class="comments"><article class="comment"><p>I was there, it was terrible. We lost two cows, and a cart.</p></article></section></main>',
    "notice": f'<body><div class="cookie-notice"><p>We use cookies, as all sites do. Please accept them, or leave.</p></div><article><h1>Flood</h1><p>{P1}</p><div class="ad">Buy rubber boots, now!</div><p>{P2}</p><form><label>Mail</label><input></form></article>',
    "silent": f"<head><title>t</title><style>p {{ }}</style></head><body><script>var x = '<p>no</p>';</script><article><h1>Flood</h1><!-- <p>no</p> --><p>{P1}</p><noscript>no</noscript><p>{P2}</p></article>",
    "cut": f"<article><h1>Flood</h1><p>{P1}</p><p>{P2}</p></article><footer>&copy; someb",
    "tags": f"<article><h1>Fl<b>oo</b>d</h1><p>{P1.replace('night', '<i>ni</i>ght')}</p>\n\n<p>  {P2.replace(' ', chr(10) + '  ')} </p></article>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert html_text.main_text(LAYOUTS[name]) == f"Flood {P1} {P2}"


FLOOD = f"<h1>Flood</h1><p>{P1}</p><p>{P2}</p>"
TALK = "<p>I was there, it was terrible. We lost two cows, and a cart.</p>" * 3
MISLEADING = {
    "promoted": f'<body><div class="promoted-article">{FLOOD}</div></body>',
    "layout": f'<body><div class="page search layout"><ul class="menu"><li><a href="/a">Home</a></li></ul><article>{FLOOD}</article></div></body>',
    "nested": f'<body><div class="banner"><div class="ad-free widget"><div class="share">{FLOOD}</div></div></div></body>',
    "around all": f'<body><div id="sidebar-left-layout"><div class="text">{FLOOD}</div><div class="comments">{TALK}</div></div></body>',
    "beside": f'<body><div class="related-stories">{FLOOD}</div><nav>{NAV}</nav><footer>All rights reserved, by us.</footer></body>',
    "main": f'<main>{FLOOD}<div><a href="/p">Prev</a> <a href="/n">Next</a></div><div>Tags: <a href="/a">a</a> b</div></main>',
    "short ends": f'<article>{FLOOD}<div>Share this</div><div class="by">Desk</div></article>',
    "long comments": f'<article>{FLOOD}</article><div class="comments">{TALK}</div>',
    "long advert": f'<div class="content">{FLOOD}</div><div class="ad"><p>{P3} {P3}</p></div>',
}


@pytest.mark.parametrize("name", MISLEADING)
def test_names_only_weigh(name):
    assert html_text.main_text(MISLEADING[name]) == f"Flood {P1} {P2}"


def test_short_parts_of_an_article_stay():
    page = f"<article><h2>Part one</h2><p>{P1}</p><h3>A map</h3><table><tr><td>North</td><td>12</td></tr></table><ol><li>Boots</li><li>A lamp</li></ol><p>Wait.</p><p>Stay home</p></article>"
    assert html_text.main_text(page) == f"Part one {P1} A map North 12 Boots A lamp Wait. Stay home"


def plain_kept(page: str) -> list[tuple[str, bool]]:
    """Text nodes and whether weights, smoothing and threshold keep them, step by step from the definition."""
    found = [(e, " ".join(t.split())) for e, _, t in html_text.read(page) if t.strip() and not e.nothing]
    free = html_text.outvoted(found)
    weight = []
    for e, _ in found:
        same = [t for x, t in found if x.path == e.path]
        mean = sum(map(len, same)) / len(same)
        marks = sum(len(re.findall("[.,;:!?…。，、！？；：]", t)) for t in same) / len(same)
        spread = (sum((len(t) - mean) ** 2 for t in same) / len(same)) ** 0.5
        w = (mean * (1 + marks)) ** 0.5 * math.log(math.e + spread) * (2 if e.main else 1) * (0.1 if e.link else 1)
        d = e.doubt
        while d is not None and id(d) in free:
            d = d.parent.doubt if d.parent else None
        weight.append((w * (0.1 if d is not None else 1), d is not None))
    pick = lambda i: weight[min(max(i, 0), len(weight) - 1)][0]
    smooth = [sum(k * pick(i + j - 2) for j, k in enumerate((0.1, 0.2, 0.4, 0.2, 0.1))) for i in range(len(weight))]
    bar = 0.25 * sum(s * len(t) for s, (_, t) in zip(smooth, found)) / sum(len(t) for _, t in found)
    return [(t, s >= bar and not against) for (_, t), s, (_, against) in zip(found, smooth, weight)]


@pytest.mark.parametrize("page", [*LAYOUTS.values(), *MISLEADING.values()], ids=[*LAYOUTS, *MISLEADING])
def test_decisions_equal_the_plain_ones(page, monkeypatch):
    seen = []
    real = html_text._article
    monkeypatch.setattr(html_text, "_article", lambda nodes, kept: seen.append([(t, bool(k)) for (_, t), k in zip(nodes, kept)]) or real(nodes, kept))
    html_text.main_text(page)
    assert seen == [plain_kept(page)]


def test_outvoting_is_linear_in_nested_names():
    page = '<div class="ad">' * 3000 + f"<p>{P1}</p>" + '<div class="menu">x, y.</div>' * 3000
    began = time.process_time()
    assert P1 in html_text.main_text(page)
    assert time.process_time() - began < 20


def test_lists_in_the_article_stay_and_link_lists_go():
    page = f"<body><article><h1>H</h1><p>{P1}</p><ul><li>Bring boots, and a lamp.</li><li>Leave early.</li></ul><ul><li><a href='/1'>Read more here</a></li></ul></article></body>"
    assert html_text.main_text(page) == f"H {P1} Bring boots, and a lamp. Leave early."


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "</p></p>", "<script>x", "<!-- open", "<![CDATA[x", "<nav>menu</nav>", "&#0;&#xFFFFFFFF;", "<div>" * 3000 + "x", "<p a='" + "y" * 9000])
def test_broken_pages_do_not_crash(page):
    assert isinstance(html_text.main_text(page), str)


@pytest.mark.parametrize("name", LAYOUTS)
@pytest.mark.parametrize("opened", ["<div>", "<div><font>", "<i><div>"])
def test_layouts_below_deep_nesting(name, opened):
    head, body = re.match(r"((?:<html>|<head>.*</head>|<body>)*)(.*)", LAYOUTS[name], re.S).groups()
    page = head + opened * 1000 + "<script>var x = 1;</script>" + body
    assert html_text.main_text(page) == f"Flood {P1} {P2}"


def test_time_grows_with_the_page_alone():
    deep = "<span>" * 100_000 + "<br>x" * 100_000 + "</b>" * 100_000 + "<p><div>" * 50_000
    began = time.process_time()
    assert isinstance(html_text.main_text(deep), str)
    assert time.process_time() - began < 30


def test_references_and_white_space():
    text = "Caf&eacute; &lt;b&gt; &amp;amp; &#8364;5, sold.\t\nNow, then."
    assert html_text.main_text(f"<article><p>{text}</p><p>{P3}</p></article>") == f"Café <b> &amp; €5, sold. Now, then. {P3}"


def test_whole_table(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op2_tag_path_ratios(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(given)
    for r in given:
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"<(/?(p|h1|br)\b[^>]*)>", " ", body))
        want = " ".join(html.unescape(body).split())
        assert (got[r.page_id].text, got[r.page_id].url, got[r.page_id].n_chars) == (want, r.url, len(want))


def test_nulls_repeats_and_other_columns(spark):
    rows = [(1, None, None, "x"), (None, "u", "", "x"), (2, "u", LAYOUTS["article"], "x"), (2, "u", LAYOUTS["article"], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.n_chars) for r in got) == [(False, 1, 0), (False, 2, got[-1].n_chars), (False, 2, got[-1].n_chars), (True, 0, 0)]
    assert html_text.extract(pages.limit(0)).count() == 0

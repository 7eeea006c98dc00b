from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pytest

from eventloom.llm import boost, dom, extract, layouts, queries
from eventloom.llm.tables import read

SF = "/root/testdata/sf0.001"


def by_definition(page: str) -> str:
    """The main text of the given tables' pages, whose article element is known and holds h1 and p alone."""
    article = re.search("<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def lines(spark):
    return extract.sample_lines(read(spark, SF, "pages"))


@pytest.fixture(scope="module")
def model(lines):
    return extract.learn(lines)


def test_query_extracts_the_articles_of_all_pages(spark):
    pages = {r.page_id: r for r in read(spark, SF, "pages").collect()}
    got = queries.op11_boosted_blocks(spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert len(rows) == len(pages)
    for r in rows:
        want = by_definition(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def quality(pages: list[dom.Page], model: extract.Model) -> tuple[float, float, float]:
    kept = found = wanted = exact = 0
    for page, text in zip(pages, extract.main_texts(pages, model), strict=True):
        got, want = Counter(text.split("\n") if text else []), Counter(t for t, m in zip(page.text, page.main, strict=True) if t and m == 1)
        kept += sum(len(t) * n for t, n in (got & want).items())
        found, wanted, exact = found + sum(len(t) * n for t, n in got.items()), wanted + sum(len(t) * n for t, n in want.items()), exact + (got == want)
    return kept / found, kept / wanted, exact / len(pages)


def test_layouts_not_seen_in_training(lines, model):
    """Other pages of the layouts; of those whose elements say nothing by name or kind, most."""
    pages = layouts.training_pages(lines, 400, seed=12_345)
    precision, recall, exact = quality([dom.parse(p, marks=True) for p in pages], model)
    assert precision > 0.97 and recall > 0.97 and exact > 0.85
    unnamed = [re.sub(r' (?:class|id)="[^"]*"', "", p) for p in pages]
    precision, recall, _ = quality([dom.parse(p, marks=True) for p in unnamed], model)
    assert precision > 0.9 and recall > 0.9


HAND = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="home"><div id=page>
<div class="site-header"><a href=/>Daily</a><div class=main-menu><a href=a>News</a> <a href=b>Sport</a></div></div>
<div class="cookie-notice"><p>We use cookies to make this site work. Do you accept them?</p><button>Yes</button></div>
<div class='post'><h1>A title &amp; more</h1><div class='ad-slot'>Buy this now, it is very cheap.</div>
<div class=post-content><p>First&nbsp;paragraph of the story, with
 a line break, <b>bold</b> words and a <a href=x>link in it</a>.<p>Second paragraph, which isn&#39;t closed; it says a lot of things about the matter at hand.
<ul><li>one item of a list in the story</li><li>another item of the list</li></ul><script>if (a < b) document.write("<p>no</p>")</script>
<blockquote>Quoted words of somebody who knows about it, at some length.</blockquote></div></div>
<div id="comments"><h3>Comments</h3><div class="comment"><b>Ann</b><p>I read this and I liked it very much, thank you for it.</p></div><div class="comment"><b>Bob</b><p>So did I, though I would have written more.</p></div>
<form class=reply><textarea>say</textarea><input type=submit></form></div>
<div class=sidebar><h4>Popular</h4><ul><li><a href=1>Some other story</a></li><li><a href=2>And one more</a></li></ul></div>
<div class=footer>&copy; 2020 Daily. All rights reserved.</div></div>"""


def test_a_page_by_hand(model):
    (text,) = extract.main_texts([dom.parse(HAND)], model)
    assert text.split("\n") == [
        "A title & more", "First paragraph of the story, with a line break, bold words and a link in it.", "Second paragraph, which isn't closed; it says a lot of things about the matter at hand.",
        "one item of a list in the story", "another item of the list", "Quoted words of somebody who knows about it, at some length.",
    ]


def texts(page: str) -> list[str]:
    return [t for t in dom.parse(page).text if t]


def test_parser_mends_mistakes():
    assert texts("<p>a<p>b<div>c</p>d</div>e") == ["a", "b", "c", "d", "e"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    assert texts("a<!-- <p>x</p> -->b<!-->c<!doctype x>d<?php e ?>f") == ["abcdf"]
    assert texts("<script>var a='</p>'</script>x<style>y") == ["x"]
    assert texts("1 < 2 &lt; 3 &amp;amp; &copy &#8364; &notin; <3 </ 4>") == ["1 < 2 < 3 &amp; © € ∉ <3"]
    assert texts("<p title='a>b' x=\"c>d\" y=it's>z</p><p/>w") == ["z", "w"]
    assert texts("<svg><svg></svg><p>x</p></svg>y<noscript>n</noscript><button>b</button><select><option>o</select>z<object>w") == ["yzw"]
    assert texts("a \t\n\xa0b<br>c<br/><br>d<hr>e") == ["a b c d", "e"]
    assert texts("<p>unclosed tag <a href='x") == ["unclosed tag"] and texts("") == [] and texts("<") == ["<"] and texts("\x00</div></p>") == ["\x00"]
    deep = dom.parse("<div>" * 3000 + "x" + "</div>" * 3000)
    assert len(deep.parent) == 3001 and deep.text[-1] == "x"


def test_nothing_comes_back_from_a_block_left_out():
    page = dom.parse("<div><p>a</p><p>b</p></div><div><p>c</p></div>")
    margin = np.array([0.0, -3.0, 9.0, 9.0, 3.0, 2.0])
    assert extract.decode([page], np.array([0, 6]), margin) == [[5]]


def test_features_of_subtrees_and_siblings():
    pages = [dom.parse(x) for x in ("<div class=ads><p>one two.</p><p><a>three</a></p></div><p>four</p>", "", "<ul><li>x</ul>")]
    x, first = dom.features(pages, {"p": 1.0, "div": -1.0}, {"ad": -2.0})
    f = {k: x[:, i] for i, k in enumerate(dom.FEATURES)}
    assert first.tolist() == [0, 5, 6, 9] and np.isfinite(x).all()
    assert np.allclose(np.expm1(f["chars"])[:5], [17, 13, 8, 5, 4]) and np.allclose(f["share"][:5], [1, 13 / 17, 8 / 17, 5 / 17, 4 / 17])
    assert f["link_share"][3] == 1 and f["link_share"][1] == 5 / 13 and f["up_names_low"][2] == -2 and f["names_low"][1] == -2 and f["down_names_low"][0] == -2
    assert f["up_tag_low"][2] == -1 and f["tag"][2] == 1 and np.expm1(f["before_chars"][3]).round() == 8 and np.expm1(f["after_chars"][2]).round() == 5 and f["place"][3] == 0.5


def test_trees_learn_and_say_the_prior_without_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boost.fit(x[:3000], y[:3000])
    assert ((trees.margin(x[3000:]) > 0) == y[3000:]).mean() > 0.95
    assert boost.fit(np.zeros((0, 3)), np.zeros(0)).margin(np.zeros((2, 3))).tolist() == [0, 0]
    assert (boost.fit(x, np.ones(4000)).margin(x) > 5).all()


def test_odd_rows(spark, model):
    """Nulls, nothing, repeated rows, clashing names, a very long page."""
    long = "<article>" + "".join(f"<p>paragraph {k} of a very long page, with some words in it.</p>" for k in range(20_000)) + "</article>"
    rows = [(None, None, None, 5, None), (1, "u", "", 6, "x"), (2, "u", "<html><head><title>t</title></head>", 7, "x"), (3, None, HAND, 8, "y"), (3, None, HAND, 8, "y"), (4, "v", long, 9, "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, `a.b` string")
    got = extract.extract(df, model)
    assert got.columns == ["page_id", "url", "html", "a.b", "text", "n_chars"]
    out = got.collect()
    assert Counter(r.page_id for r in out) == Counter(r[0] for r in rows)
    by = {r.page_id: r for r in out}
    assert by[None].text == by[1].text == by[2].text == "" and by[None].n_chars == 0 and by[4].text.count("\n") == 19_999 and by[3].n_chars == len(by[3].text) > 200
    assert extract.extract(df.limit(0), extract.fit(df.limit(0)), keep_html=False).count() == 0

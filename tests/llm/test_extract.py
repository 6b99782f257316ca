"""Main text of pages: known layouts, broken markup, and the decoding rule."""

from __future__ import annotations

import random
import re
import time
from html import unescape

import numpy as np
import pytest

from turnmill.llm.boosting import Boosting, Trees
from turnmill.llm.dom import Page, attribute_words
from turnmill.llm.extract import Nodes, decode, extract_pages, fit, main_text
from turnmill.llm.page_models import PageMaker


@pytest.fixture(scope="module")
def trees():
    return fit()


def everything(html):
    page = Page(html)
    return page.text([True] * len(page.tag))


@pytest.mark.parametrize(
    "html,text",
    [
        ("", ""),
        ("plain  text\n only", "plain text only"),
        ("<p>a<p>b", "a b"),
        ("<p>fo<b>o</b>bar<br>baz</p>", "foobar baz"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "a b c d e"),
        ("<p>&lt;x&gt; &amp &eacute;&#233;&#x2014; &nope;</p>", "<x> & éé— &nope;"),
        ("<script>var t='</p><p>no';</script>yes<style>p{}</style>", "yes"),
        ("<script>unfinished <p>no", ""),
        ("<!-- <p>no</p> -->a<!-- unfinished <p>no", "a"),
        ("a < b <3 <div class='x>y' title=\"<p>\">c</div></section></p> d", "a < b <3 c d"),
        ("<table><tr><td>1<td>2<tr><th>3</table>", "1 2 3"),
        ("<div>a<div>b</p></div>c</div>d", "a b c d"),
        ("<DIV>A<P>B</DIV>C<unfinished attr='", "A B C"),
        ("<textarea><p>no</textarea><title>no</title>ok<noscript>no</noscript>", "ok"),
        ("a  b&nbsp;c", "a b c"),
    ],
)
def test_reading(html, text):
    assert everything(html) == text


def test_deep_and_long_pages_are_read_whole(trees):
    deep = "<div>" * 20000 + "deep" + "</div>" * 20000
    assert everything(deep) == "deep"
    words = [f"word{k}" for k in range(60000)]
    long = "<body><article>" + "".join(f"<p>{' '.join(words[k : k + 100])}</p>" for k in range(0, 60000, 100))
    assert extract_pages([long], trees) == [" ".join(words)]


def test_nothing_below_a_dropped_element_is_kept():
    draw = random.Random(4)
    for _ in range(200):
        parent = [-1] + [draw.randrange(k) for k in range(1, 9)]
        p = np.array([draw.random() for _ in parent])
        weight = np.array([draw.uniform(0.5, 4) for _ in parent])
        kept = decode(parent, weight, p)
        cost = lambda ks: sum(-w * np.log(q if k else 1 - q) for k, w, q in zip(ks, weight, p))
        best = min(
            cost([True, *(bool(mask >> k & 1) for k in range(8))])
            for mask in range(256)
            if all((parent[k + 1] == 0 or mask >> (parent[k + 1] - 1) & 1) for k in range(8) if mask >> k & 1)
        )
        assert cost(kept) == pytest.approx(best)
        assert all(kept[parent[k]] for k in range(1, 9) if kept[k])


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(1)
    x = draw.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    made = Trees(x[:2000], y[:2000], Boosting(trees=40))
    assert ((made.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_unseen_example_pages(trees):
    maker, right, total = PageMaker(77), 0.0, 120
    for _ in range(total):
        page = Page(maker.page())
        label = [True] * len(page.tag)
        for k in range(1, len(page.tag)):
            mark = re.search(r'data-label="([01])"', page.attributes[k])
            label[k] = mark[1] == "1" if mark else label[page.parent[k]]
        nodes = Nodes(page)
        kept = decode(page.parent, 1 + nodes.own, trees.probability(nodes.features()))
        got, want = page.text(kept).split(), page.text(label).split()
        right += 2 * len(set(got) & set(want)) / max(1, len(set(got)) + len(set(want)))
    assert right / total >= 0.95


def test_given_pages_give_their_article(spark, small, trees):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    wrong = 0
    for page, text in zip(pages, extract_pages([p["html"] for p in pages], trees)):
        article = re.search(r"<article>(.*?)</article>", page["html"], re.DOTALL)[1]
        wrong += text != " ".join(unescape(re.sub(r"<[^>]*>", " ", article)).split())
    assert wrong <= len(pages) // 100


FURNITURE = """<html><head><title>T</title></head><body><div class="cookie-notice"><p>We use small
files, accept them all.</p></div><header class="site-header"><p>The Daily Thing</p></header>
<div class="layout"><main><h1>A title</h1><p>First paragraph of the story, with several words in it, and
more.</p><p>Second one &amp; last, which is longer than the first and goes on for a while.</p></main>
<aside class="sidebar"><h3>Popular</h3><ul><li><a href=/a>Other story</a></li></ul></aside></div>
<section id="comments" class="comments"><h3>Comments</h3><div class="comment"><p>Nice story, I liked it
very much and will come back.</p></div></section><form><p>Write to us</p></form>
<footer>&copy; The Daily Thing</footer></body></html>"""


def test_page_furniture_goes(trees):
    assert extract_pages([FURNITURE], trees) == [
        "A title First paragraph of the story, with several words in it, and more. "
        "Second one & last, which is longer than the first and goes on for a while."
    ]


def test_attribute_words():
    assert attribute_words(' class="Side-Bar x" ID=main hidden')[0] == ["side", "bar", "x", "main"]
    assert attribute_words(' style="display : none"')[1] and not attribute_words(' class="hidden"')[1]


def test_awkward_pages(spark, trees):
    rows = [(1, None, "m"), (2, "", "m"), (3, "just text", "m"), (3, "just text", "m"), (None, FURNITURE, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    made = main_text(pages)
    assert made.columns == ["page_id", "html", "text", "main_text"]
    found = sorted((r["page_id"] or 0, r["main_text"]) for r in made.collect())
    assert found[1:] == [(1, ""), (2, ""), (3, "just text"), (3, "just text")]
    assert main_text(pages.filter("false")).collect() == []


@pytest.mark.parametrize(
    "html,text",
    [
        ('<article><svg class="i"/><p>one</p></article>', "one"),
        ("<div><svg class=i /><math/><p>one</p></div>", "one"),
        ("<div><svg hidden/><p>one</p><svg><text>gone</text></svg><p>two</p></div>", "one two"),
        ("<p>so <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math> is</p>", "so x+1 is"),
        ("<div><svg class=i/>lost</svg><p>one</p></div>", "one"),
    ],
)
def test_pictures_and_formulas(html, text):
    page = Page(html)
    assert page.text([True] * len(page.tag)) == text


def test_stray_end_tags_of_deep_pages_cost_little():
    deep = "<div>" * 8000 + "x</p>" * 8000
    start = time.perf_counter()
    Page(deep)
    assert time.perf_counter() - start < 2

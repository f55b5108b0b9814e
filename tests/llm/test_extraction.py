from __future__ import annotations

import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressure.llm import extraction as X
from pressure.llm.dom import parse


def blocks(source: str) -> list[str]:
    return [t for t in parse(source).text if t is not None]


def test_blocks_of_broken_markup():
    assert blocks("<p>one<p>two <b>x<p>three</b> y") == ["one", "two x", "three y"]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert blocks("a &amp; b&nbsp;c &lt;p&gt; <!-- <p>no --> d<br>e <script>if (a<b) '</p>'</script>f") == ["a & b c <p> d e f"]
    assert blocks("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert blocks('<a title="x>y">t</a> 3 < 4 <img alt="no">z') == ["t 3 < 4 z"]
    assert blocks("<style>p{</style") == [] and blocks("<p") == [] and blocks("<!-- open") == [] and blocks("") == []
    assert blocks("</div></p>text</article>") == ["text"]
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert blocks(deep) == ["deep"]


def test_no_text_is_lost_behind_open_or_deep_elements():
    for tag in ("svg", "object", "canvas", "video", "audio", "template"):
        assert blocks(f"<p>one <{tag} class=x>two<p>three") == ["one two", "three"]
        assert blocks(f"<p>one <{tag}>no</{tag}> two <{tag}/>three") == ["one two three"]
    assert blocks("<p>so <math><mi>x</mi> = <mn>2</mn></math> holds") == ["so x = 2 holds"]
    assert blocks("<p>one<script>two<p>three") == ["one"]
    for n in (400, 600, 3000):
        page = parse("<article><p>a</p>" + "<div><b>" * n + "deep" + "</b></div>" * n + "<p>last</p></article><p>out")
        inside = [up for t, up in zip(page.text, page.parent, strict=True) if t in ("a", "last")]
        assert [t for t in page.text if t is not None] == ["a", "deep", "last", "out"]
        assert page.parent[inside[0]] == page.parent[inside[1]]


def test_messages_give_the_marginals_of_summing_over_all_labellings():
    rng = np.random.default_rng(1)
    page = parse("<div><p>a</p><ul><li>b</li><li>c</li></ul></div><p>d")
    forest = X.Forest([page, parse("<p>x")])
    weights = rng.normal(0, 1, X.FEATURES)
    edges = rng.normal(0, 1, (2, 4))
    total, _, _ = X.marginals(forest, weights, edges)
    n = len(page.parent)
    own = forest.unary(weights)[:n]
    mass = np.zeros((n, 2))
    for code in range(2**n):
        label = [(code >> i) & 1 for i in range(n)]
        score = sum(own[i] * label[i] for i in range(n))
        score += sum(edges[forest.kind[i], 2 * label[page.parent[i]] + label[i]] for i in range(1, n))
        for i in range(n):
            mass[i, label[i]] += np.exp(score)
    assert np.allclose(np.log(mass[:, 1] / mass[:, 0]), total[:n])


def test_held_out_labelled_pages():
    weights, edges = X.trained()
    right = total = 0
    for source, marks in X.labelled_pages(200, seed=99):
        forest = X.Forest([parse(source)])
        odds, _, _ = X.marginals(forest, weights, edges)
        right += int(((odds >= 0)[forest.leaf] == np.array(marks, bool)).sum())
        total += len(marks)
    assert right / total > 0.97


def article(source: str) -> str:
    inner = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1]
    parts = re.split(r"</?(?:p|h1|h2|h3|li|ul|ol|div|blockquote)[^>]*>", inner)
    texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " ")))).strip() for p in parts]
    return "\n".join(t for t in texts if t)


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in X.extraction_report(pages).collect()}
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_parts_that_are_not_the_article():
    source = """<html><body><header class="site-header"><h1>Site</h1><p>Our motto is long and has many words in it.</p></header>
    <div class="cookie-notice"><p>We use cookies on this site. Please accept them all.</p><button>OK</button></div>
    <nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>
    <article><h1>Title</h1><p>First paragraph of the article, with some words.</p><div class="ad">Buy now</div>
    <p>Second one &amp; more.</p><ul><li>Point one of the list.</li><li>Point two.</li></ul></article>
    <aside class="sidebar"><h3>Related</h3><p>Another story that is not this one.</p></aside>
    <section class="comments"><h2>Comments</h2><article class="comment"><p>I have read this and I do not agree with a word of it.</p></article></section>
    <form action="/s"><label>Mail</label><input name="m"><button>Send</button></form>
    <footer><p>&copy; 2020 Site. All rights reserved.</p></footer></body></html>"""
    weights, edges = X.trained()
    want = "Title\nFirst paragraph of the article, with some words.\nSecond one & more.\nPoint one of the list.\nPoint two."
    assert X.extract([source, ""], weights, edges) == [want, ""]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    rows = [(1, None, None), (None, "u", ""), (3, "u", "plain"), (3, "u", "<p>" + "long " * 60000), (4, "u", "<" * 2000), (5, "u", "&#x0;&bogus;<p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old")).withColumn("n_chars", F.lit(1))
    if empty:
        pages = pages.limit(0)
    got = X.extraction_report(pages).collect()
    assert len(got) == (0 if empty else len(rows))
    assert all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, None)] == ([] if empty else ["", ""])

import html
import itertools
import re

import numpy as np
import pytest

from haulmark.llm import extraction as X
from haulmark.llm import page_samples
from haulmark.llm.dom import parse

KINDS = "page_id bigint, url string, html string, text string, n_chars int"


@pytest.fixture
def texts(spark):
    def extract(sources):
        pages = spark.createDataFrame([(i, f"u{i}", s, "clash", 1) for i, s in enumerate(sources)], KINDS)
        rows = X.main_text(pages).orderBy("page_id").collect()
        assert [r["page_id"] for r in rows] == list(range(len(sources)))
        assert all(r["n_chars"] == len(r["text"]) and r["url"] == f"u{r['page_id']}" for r in rows)
        return [r["text"] for r in rows]

    return extract


def labelled_text(source):
    page = parse(source)
    return "\n".join(t for t, keep in zip(page.text, page.labelled, strict=True) if keep and t)


def test_marginals_equal_the_sum_over_all_labellings():
    rng = np.random.default_rng(0)
    for source in ("<p>a</p>", "<div>x<p>a<p>b</div><ul><li>c<li>d", "<div><div><p>a</p>b</div>c</div>", ""):
        f = X.forest([parse(source), parse("<h1>t</h1>u")])
        weights, edges = rng.normal(size=X.FEATURES), rng.normal(size=(X.EDGES, 2, 2))
        nodes, pairs, log_sum = X.messages(f, weights, edges)
        own = f.features @ weights
        n = len(own)
        total, ones, both = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for y in itertools.product((0, 1), repeat=n):
            score = sum(own[i] * y[i] + (edges[f.edge[i], y[f.parent[i]], y[i]] if f.parent[i] >= 0 else 0) for i in range(n))
            p = np.exp(score)
            total += p
            ones += p * np.array(y)
            for i in range(n):
                if f.parent[i] >= 0:
                    both[i, y[f.parent[i]], y[i]] += p
        assert np.allclose(nodes[:, 1], ones / total)
        assert np.allclose(pairs, both / total)
        assert np.isclose(log_sum, np.log(total))


def test_held_out_pages():
    model = X.default_model()
    sources = list(page_samples.pages(200, seed=5))
    found = [set(t.split("\n")) for t in model.content([parse(s) for s in sources])]
    wanted = [set(labelled_text(s).split("\n")) for s in sources]
    right = sum(len(a & b) for a, b in zip(found, wanted, strict=True))
    assert right > 0.985 * sum(map(len, found))
    assert right > 0.985 * sum(map(len, wanted))
    assert sum(a == b for a, b in zip(found, wanted, strict=True)) > 0.9 * len(sources)


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in X.main_text(pages).collect():
        article = source[row["page_id"]].split("<article>")[1].split("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?p>|</?h1>", article))
        assert row["text"] == "\n".join(b for b in blocks if b)


def test_other_layouts(texts):
    long = "This is a paragraph of the story with more than a few words in it, as there are in most. It goes on a little."
    site = (
        '<body class="home"><div id="cookie-consent"><p>We use cookies to improve this site.</p><button>Accept</button></div>'
        '<div class="site-header"><a href="/">The Site</a><ul class="menu"><li><a href="/a">News</a><li><a href="/b">Sport</a></ul></div>'
        f'<div class="wrap"><div class="post-content"><h1>A &lt;title&gt; &amp; more</h1><p>{long}</p><p>{long}\n\n <b>Bold</b>&nbsp;end</p>'
        f'<div class="ad-slot">Buy this now.</div><ul><li>First of the points.</li><li>Second of the points.</li></ul><p>{long}'
        '</div><div class="sidebar"><h3>More</h3><ul><li><a href="/c">Other story</a></li><li><a href="/d">Third story</a></li></ul></div></div>'
        f'<div id="comments"><h3>2 comments</h3><div class="comment"><p>{long}</p></div><form><textarea>x</textarea></form></div>'
        '<div class="footer">&copy; 2020 The Site. All rights reserved.</div>'
    )
    want = f"A <title> & more\n{long}\n{long} Bold end\nFirst of the points.\nSecond of the points.\n{long}"
    assert texts([site]) == [want]


def test_missing_empty_and_broken_pages(texts):
    para = "Some words that make a sentence in a paragraph of this page, which is cut off."
    broken = f"<article><h1>Title</h1><p>{para}<p>{para}</span></td></p></article><footer>x <a hre"
    assert texts([None, "", "<script>var a = '<p>x</p>'", broken]) == ["", "", "", f"Title\n{para}\n{para}"]
    assert texts([]) == []


def test_very_long_and_deep_pages(texts):
    para = "Some words that make a sentence in a paragraph of this page, and go on."
    long = "<article><h1>T</h1>" + f"<p>{para}</p>" * 100_000 + "</article>"
    deep = "<div>" * 20_000 + "<p>x"
    found = texts([long, deep, "<" * 200_000, "<!--" * 100_000, '<a href="' * 100_001])
    assert found[0] == "T" + f"\n{para}" * 100_000


def test_trees_supply_missing_ends():
    page = parse('<ul><li>a<li>b<b>c</ul>d<p>e<div>f</div>g<table><tr><td>1<td>2<tr><td>3</table><br>h&amp;amp <i>j</i>\t k')
    assert [(t, x) for t, x in zip(page.tag, page.text, strict=True) if x] == [
        ("li", "a"), ("li", "bc"), ("#text", "d"), ("p", "e"), ("div", "f"), ("#text", "g"), ("td", "1"), ("td", "2"),
        ("td", "3"), ("#text", "h&amp j k"),
    ]


def test_quotes_in_attributes_hide_no_text():
    page = parse("<p title=it's>a</p><p title=\"x > y\">b</p><p class='one two'>c</p><P ID=Main>d</P>")
    assert page.text[1:] == ["a", "b", "c", "d"]
    assert page.names[3:] == [("one", "two"), ("main",)]

import itertools
import math
import random
import re

import numpy as np
import pytest

from loadtide.llm import extract as X
from loadtide.llm.dom import Page, blocks
from loadtide.llm.domtrain import pages

D = "/root/testdata/sf0.001"


def everything(source):
    p = Page(source)
    return blocks(p, [True] * len(p.tag))


@pytest.mark.parametrize(
    "source, text",
    [
        ("<p>a<p>b<br>c</p> d", "a\n\nb c\n\nd"),
        ("<p>a &amp; b&nbsp; c&#233;&copy;</p>", "a & b c\xe9\xa9"),
        ("x<script>var a='</p>';</script>y<style>p{}</style>z", "xyz"),
        ("<!-- <p>no</p> --><div>yes</div><!-- open", "yes"),
        ("<ul><li>one<li>two</ul>three", "one\n\ntwo\n\nthree"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
        ("<p>in <b>bold</b>, <a href='x>y'>link</a>.</p>", "in bold, link."),
        ("<p><b>open<br><p>next</p>", "open\n\nnext"),
        ("a < b and c > d", "a < b and c > d"),
        ("<div>a</span>b</div></div>c", "ab\n\nc"),
        ("plain", "plain"),
        ("", ""),
        ("<", "<"),
        ("<p", "<p"),
        ("<SCRIPT>x", ""),
        ("<title>t</title>b", "b"),
        ("<pre>a\n  b</pre>", "a b"),
        ("<br/><hr/>a<img alt='>'/>b", "ab"),
    ],
)
def test_blocks(source, text):
    assert everything(source) == text


def test_odd_sources_end():
    rng = random.Random(1)
    bits = ["<", ">", "/", "p", "div", "<p>", "</p>", "<div class='a", '"', "'", "<!--", "-->", "&", "&amp", " ", "x", "<script>", "</script>", "=", "<li>", "<td>", "]]>", "<![CDATA["]
    for _ in range(2000):
        source = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        p = Page(source)
        assert all(0 <= a < k for k, a in enumerate(p.parent) if k) and all(k < e <= len(p.tag) for k, e in enumerate(p.end))
    assert len(Page("<div>" * 20000 + "x").tag) == 20001


def test_decoding_is_the_best_consistent_choice():
    rng = np.random.default_rng(0)
    for _ in range(60):
        source = "".join(rng.choice(["<div>", "</div>", "x"]) for _ in range(9))
        p = Page(source)
        n = len(p.tag)
        if n > 9:
            continue
        c = rng.uniform(0.02, 0.98, n)

        def value(keep):
            return sum(math.log(c[k] if keep[k] else 1 - c[k]) for k in range(n))

        valid = [k for k in itertools.product([False, True], repeat=n) if all(not k[i] or k[p.parent[i]] for i in range(1, n))]
        got = X.decode(p, c)
        assert tuple(got) in valid and value(got) == pytest.approx(max(map(value, valid)))


def test_held_out_layouts(spark):
    """Pages of layouts that the model hasn't seen; a few have no cue at all."""
    model = X._model(spark.sparkContext.applicationId, X.TRAIN_PAGES, X.TREES, 5)
    sources = pages(300, 77)
    x, y = X._labelled(300, 77)
    chance = model.chance(x)
    at = same = 0
    for s in sources:
        p = Page(s)
        n = len(p.tag)
        same += blocks(p, X.decode(p, chance[at : at + n])) == blocks(p, y[at : at + n] > 0)
        at += n
    assert same >= 0.9 * 300


def test_class_words_of_no_list(spark):
    """Layouts as before, every class word replaced by one that neither the features nor the training pages know."""
    named, unnamed = (X._model(spark.sparkContext.applicationId, X.TRAIN_PAGES, X.TREES, 5, part) for part in (0.0, 1.0))
    sources = pages(300, 78, 1.0)
    found = [Page(s) for s in sources]
    _, y = X._labelled(300, 78, 1.0)
    chance = X.chances(named, unnamed, found)
    at = same = before = 0
    for p, own in zip(found, np.split(named.chance(X.node_features(found)), np.cumsum([len(p.tag) for p in found])[:-1])):
        n = len(p.tag)
        want = blocks(p, y[at : at + n] > 0)
        same += blocks(p, X.decode(p, chance[at : at + n])) == want
        before += blocks(p, X.decode(p, own)) == want
        at += n
    print("exact pages without known words:", same, "by the other trees:", before)
    assert same >= 0.75 * 300 and same > before


def test_pages_of_the_table(spark):
    """The given pages mark their article by its tag, which is read here without any model."""
    from loadtide.llm.queries import op3_extract

    rows = {r.page_id: (r.url, r.html) for r in spark.read.parquet(f"{D}/pages.parquet").collect()}
    got = op3_extract(spark, D).collect()
    assert sorted(r.page_id for r in got) == sorted(rows)
    for r in got:
        url, source = rows[r.page_id]
        want = everything(re.search(r"<article>.*</article>", source, re.S)[0])
        assert (r.url, r.text, r.n_chars) == (url, want, len(want))


def test_other_parts_are_left_out(spark):
    para = "<p>" + "Some words of a long paragraph, and some more of them. " * 6 + "</p>"
    text = " ".join(("Some words of a long paragraph, and some more of them. " * 6).split())
    source = f"""<html><body><div id="cookie-notice">We use cookies. <button>Accept</button></div>
      <div class="topnav"><a href="/">Home</a> <a href="/b">Blog</a> <a href="/c">Contact</a></div>
      <div class="content"><h1>A title of its own</h1>{para}<div class="ad-box">Buy this now.</div>{para}</div>
      <div class="sidebar"><h3>Recent</h3><ul><li><a href="/1">One post</a></li><li><a href="/2">Another post</a></li></ul></div>
      <section class="comments"><h2>Comments</h2><div class="comment"><b>Ann</b><p>I like it very much, thanks.</p></div></section>
      <form class="newsletter"><label>Mail</label><input><button>Go</button></form><div class="footer">&copy; Site</div></body></html>"""
    df = spark.createDataFrame([(1, "u", source)], "page_id long, url string, html string")
    assert X.extract(df).first().text == f"A title of its own\n\n{text}\n\n{text}"


def test_defined_cases(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>" + "word " * 300_000 + "</p>"), (3, "u", "<div>"), (None, "u", "just text here"), (None, "u", "just text here")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "page_id long, url string, html string, text int, n_chars string")
    got = X.extract(df).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert len({r.text for r in got if r.page_id is None}) == 1
    assert X.extract(df.limit(0)).count() == 0

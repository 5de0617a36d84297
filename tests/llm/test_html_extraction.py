"""Operator 7: parsing, exact marginals against enumeration, extraction of labelled pages."""

import html
import itertools
import math
import random
import re

import pytest

from tessera.llm import html_extraction as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x("</p>")</script></head><body>
<header><div>Site Head</div></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">Away</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, and this is a long notice text about how we handle your data.</p></div>
<article><h1>Title &amp; more</h1><p>First para<b>graph</b>   with <a href=x>link</a>.<p>Second<br>line, &lt;ok&gt;
&copy; &#233;<!-- no > comment --></p><ul><li>one<li>two</ul><form><p>Your name here</p></form>
<div class="advert"><p>Buy now this thing that is long enough to look like text, really.</p></div>
<table><tr><td>a<td>b</table><style>p > a {}</style>
<section class="comments"><h3>Reader comments</h3><p>I think this article is great and has a lot of text in it, yes it does.</p>
</section></article><aside><p>Side bar text that is somewhat long and dull and goes on for a while.</p></aside>
<footer>(c) me</footer>"""
TEXT = "Title & more First paragraph with link. Second line, <ok> © é one two a b"


def sample_pages(n=40):
    rng, out = random.Random(4), []
    for i in range(n):
        ps = [" ".join(rng.choice(["erthat", "onand", "é&amp;", "of", "thing."]) for _ in range(rng.randrange(1, 80)))
              for _ in range(rng.randrange(1, 9))]
        text = " ".join(html.unescape(p) for p in ps)
        body = "".join(f"<p>{p}</p>" if k % 3 else f"<p>{p}<br>" for k, p in enumerate(ps))
        out.append((f"<html><body><nav><ul><li><a href=x>A {i}</a></li></ul></nav><div class='ad'>Buy {i} things</div>"
                    f"<article>{body}</article><footer>&copy; site {i}</footer>" + "</body></html>" * (i % 2), " ".join(text.split())))
    return out


@pytest.fixture(scope="module")
def weights():
    return H.train([p for p, _ in sample_pages()])


def test_awkward_page(weights):
    assert H.main_text(PAGE, weights) == TEXT


def test_pages_without_landmarks(weights):
    other = PAGE.replace("<article>", '<div id="content" class="post-body">').replace("</article>", "</div>")
    assert H.main_text(other, weights) == TEXT


def test_labelled_pages(weights):
    for page, text in sample_pages(25):
        assert H.main_text(page, weights) == text


def test_marginals_are_exact():
    page = H.parse("<div><p>some text here</p><p class=nav>b</p><ul><li>x<li>long " + "y " * 90 + "</ul></div><p>z</p>")
    w = {f: random.Random(f).uniform(-2, 2) for fs in H.node_features(page) for f in fs}
    w |= {f"edge:{k}:{e}": random.Random(k + e).uniform(-2, 1) for k in ("page", "box", "inner") for e in ("10", "01")}
    prob, mixed, feats, kinds = H.marginals(page, w)
    n = len(feats)
    total, on, ten, one = 0.0, [0.0] * n, [0.0] * n, [0.0] * n
    for state in itertools.product((0, 1), repeat=n):
        e = sum(sum(w.get(f, 0) for f in feats[k]) for k in range(n) if state[k])
        edge = [f"{state[page.parent[k]]}{state[k]}" if k else "" for k in range(n)]
        p = math.exp(e + sum(w.get(f"edge:{kinds[k]}:{edge[k]}", 0.0) for k in range(n)))
        total += p
        for k in range(n):
            on[k] += p * state[k]
            ten[k] += p * (edge[k] == "10")
            one[k] += p * (edge[k] == "01")
    assert prob == pytest.approx([x / total for x in on], abs=1e-9)
    for k in range(1, n):
        assert mixed[k] == pytest.approx((ten[k] / total, one[k] / total), abs=1e-9)


@pytest.mark.parametrize("page", ["", "<", "</", "<a", "<p", "<!--", "<!-- x", "</p></div>", "a < b > c", "<script>x", "<p>" * 3000,
                                  "<div>" * 3000 + "x", "<a" * 20000, "<p title='x>y", '<p class="a\'b">k</p>', "&", "&#0;&#x110000;"])
def test_broken_pages_do_not_fail(page, weights):
    assert isinstance(H.main_text(page, weights), str)


def test_query_rows(spark):
    rows = [(1, "u", PAGE, "t"), (2, None, None, None), (3, "v", "", ""), (None, "w", PAGE, "t"), (1, "u", PAGE, "t")]
    rows += [(10 + i, "s", p, None) for i, (p, _) in enumerate(sample_pages(30))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(pages).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, None)] == [TEXT] * 3
    assert [r["text"] for r in got if r["page_id"] in (2, 3)] == ["", ""]
    assert H.extract(pages.limit(0)).count() == 0

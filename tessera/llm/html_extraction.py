"""Operator 7: main text of web pages by a tree-structured graphical model.

A page becomes the tree of its block elements. Each node is content or not; its
evidence is its tag, the words of its class, id and role, and the text it holds,
and every parent-child edge has a potential: content inside a part that is none
is unlikely, a part to leave out inside content less so. Messages
up and down the tree (sum-product, exact on a tree) give each node's marginal;
the text of the nodes above one half is the page's text.

Weights are trained on a bounded sample of labelled pages (``TRAIN_PAGES``):
pages that mark their article themselves, whose landmark elements give each
node's label. Training climbs the exact likelihood gradient, observed minus
expected features, from a prior that knows the usual names of page parts; names
that the sample lacks keep their prior weight.

Scoring is one pass over the pages with a small table of weights, no shuffle.
Null or empty html gives empty text; a page of any length is parsed whole in
linear time; unclosed tags end with the page; copies give equal text; an empty
table gives no rows; without labelled pages the prior is used.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import bounded_batches, only, strings, text_or_empty

TRAIN_PAGES = 300
#: longest page used for training
TRAIN_CHARS = 60_000
PRIOR_STRENGTH = 0.02
STEPS = 30

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr img label nobr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video title head textarea".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl select html body".split())

# fixed values: usual names of page parts, as parts of class, id and role
AWAY = ("nav", "menu", "breadcrumb", "header", "masthead", "footer", "foot", "sidebar", "side", "aside", "widget", "ad",
        "ads", "advert", "advertisement", "adsense", "banner", "promo", "promotion", "sponsor", "sponsored", "cookie",
        "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login",
        "form", "search", "share", "sharing", "social", "related", "recommended", "recommendations", "comment", "comments",
        "disqus", "reply", "replies", "respond", "pagination", "pager", "tags", "legal", "copyright", "disclaimer", "toolbar",
        "navigation", "contentinfo", "complementary", "skip", "toc", "meta", "byline")
HOME = ("article", "main", "content", "post", "story", "entry", "body", "text", "prose")
AWAY_TAGS = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "select", "button", "fieldset")
_AWAY, _HOME = frozenset(AWAY), frozenset(HOME)

_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_PART = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Block tree of a page in document order (parents before children) and its text runs (node, text)."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


def parse(html: str) -> Page:
    """The block tree; linear in the page's length."""
    page = Page()
    stack: list[tuple[str, int]] = []  # open block elements
    inline: dict[str, int] = defaultdict(int)
    opened: dict[str, int] = defaultdict(int)
    run: list[str] = []

    def add(tag: str, attrs: str) -> int:
        page.parent.append(stack[-1][1] if stack else -1)
        page.tag.append(tag)
        page.names.append(" ".join(m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)).lower() if attrs else "")
        page.chars.append(0)
        page.linked.append(0)
        return len(page.tag) - 1

    def end_run() -> None:
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                page.runs.append((stack[-1][1], text))
            run.clear()

    def text(piece: str) -> None:
        if piece:
            run.append(piece)
            n = len(piece) - piece.count(" ")
            page.chars[stack[-1][1]] += n
            if inline["a"]:
                page.linked[stack[-1][1]] += n

    def close(upto: int) -> None:
        end_run()
        while len(stack) > upto:
            opened[stack.pop()[0]] -= 1
        inline.clear()

    stack.append(("#page", add("#page", "")))
    at, last = 0, html.rfind(">")
    while True:
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        text(html[at:lt])
        head = html[lt + 1:lt + 2]
        if head in "!?" and head:
            end = html.find("-->", lt + 4) + 2 if html.startswith("<!--", lt) else html.find(">", lt)
            at = end + 1 if end > lt else len(html)
            continue
        if not (head.isascii() and head.isalpha() or head == "/"):
            text("<")
            at = lt + 1
            continue
        if lt > last:  # the page ends inside a tag
            break
        m = _TAG.match(html, lt) or _LOOSE.match(html, lt)
        if m is None:  # "</" and no name: skipped up to its end
            at = html.find(">", lt) + 1
            continue
        at = m.end()
        shut, tag, attrs = m[1], m[2].lower(), m[3]
        if tag in ("br", "hr"):
            end_run()
        elif tag in RAW and not shut:
            if tag == "head" or attrs.endswith("/"):
                continue
            over = re.compile(f"</{tag}[^>]*>", re.I).search(html, at)
            at = over.end() if over else len(html)
        elif tag in INLINE:
            inline[tag] = max(0, inline[tag] + (-1 if shut else 1))
        elif tag in VOID or tag in RAW:
            continue
        elif shut:
            if opened[tag]:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                close(k)
        else:
            end_run()
            rivals = SIBLINGS.get(tag, ())
            k = len(stack) - 1
            while rivals and k > 0 and stack[k][0] not in SCOPES:
                if stack[k][0] in rivals:
                    close(k)
                k = min(k, len(stack)) - 1
            if tag in CLOSES_P and opened["p"]:
                k = len(stack) - 1
                while stack[k][0] != "p":
                    k -= 1
                close(k)
            node = add(tag, attrs)
            opened[tag] += 1
            stack.append((tag, node))
    end_run()
    return page


def node_features(page: Page) -> list[list[str]]:
    """Names of each node's features (their values are 1)."""
    out = []
    for k, tag in enumerate(page.tag):
        f = ["bias", f"tag:{tag}"]
        parts = set(_PART.findall(page.names[k])) if page.names[k] else ()
        f += [f"name:{p}" for p in sorted(parts) if p in _AWAY or p in _HOME]
        n = page.chars[k]
        f.append("text:none" if not n else "text:short" if n < 40 else "text:some" if n < 200 else "text:long")
        if n and 2 * page.linked[k] > n:
            f.append("text:links")
        out.append(f)
    return out


def edge_kinds(page: Page) -> list[str]:
    """Kind of the edge to each node's parent."""
    return ["root" if p < 0 else "page" if page.tag[p] in ("#page", "html", "body") else
            "box" if page.tag[p] in ("div", "section", "table", "td") else "inner" for p in page.parent]


def prior() -> dict[str, float]:
    """Weights before training. Feature weights are log-odds of content; an edge has a weight for a content parent of
    a child that is none (``10``) and for the reverse (``01``)."""
    w = {"bias": 0.0, "text:none": 0.0, "text:short": -0.2, "text:some": 0.3, "text:long": 0.8, "text:links": -2.0}
    w |= {f"tag:{t}": -9.0 for t in AWAY_TAGS} | {f"name:{p}": -9.0 for p in AWAY} | {f"name:{p}": 5.0 for p in HOME}
    w |= {"tag:article": 7.0, "tag:main": 4.0, "tag:li": -0.3, "tag:#page": -3.0, "tag:html": -2.0, "tag:body": -1.0}
    w |= {"edge:page:10": -0.5, "edge:page:01": -0.5, "edge:box:10": -1.0, "edge:box:01": -4.0,
          "edge:inner:10": -1.0, "edge:inner:01": -4.0}
    return w


def marginals(page: Page, w: dict[str, float]):
    """Content probability of each node, (``10``, ``01``) probabilities of each edge, features and edge kinds; by
    messages up and down the tree."""
    feats, kinds = node_features(page), edge_kinds(page)
    n = len(feats)
    own = [sum(w.get(f, 0.0) for f in fs) for fs in feats]
    cost = [(w.get(f"edge:{k}:10", 0.0), w.get(f"edge:{k}:01", 0.0)) for k in kinds]
    up, inward = [0.0] * n, own[:]  # log-odds
    for c in range(n - 1, 0, -1):  # children come after their parents
        x, (ten, one) = inward[c], cost[c]
        up[c] = _log_sum(x, ten) - _log_sum(x + one, 0.0)
        inward[page.parent[c]] += up[c]
    full, mixed = inward[:], [(0.0, 0.0)] * n
    for c in range(1, n):
        p, (ten, one) = page.parent[c], cost[c]
        rest = full[p] - up[c]  # the parent without this child
        full[c] = inward[c] + _log_sum(rest, one) - _log_sum(rest + ten, 0.0)
        x = inward[c]
        total = _log_sum(_log_sum(rest + x, rest + ten), _log_sum(x + one, 0.0))
        mixed[c] = (math.exp(rest + ten - total), math.exp(x + one - total))
    return [_sigmoid(x) for x in full], mixed, feats, kinds


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def _log_sum(a: float, b: float) -> float:
    """log(e^a + e^b)."""
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def landmark_labels(page: Page) -> list[int] | None:
    """Labels of a page that marks its article: inside it, and in no part to leave out. None: it marks none."""
    label, article = [], False
    for k, tag in enumerate(page.tag):
        p = page.parent[k]
        parts = set(_PART.findall(page.names[k])) if page.names[k] else set()
        away = tag in AWAY_TAGS or bool(parts & _AWAY)
        inside = tag == "article" or (p >= 0 and label[p] == 1)
        article |= tag == "article"
        label.append(int(inside and not away))
    return label if article else None


def train(pages: list[str], strength: float = PRIOR_STRENGTH, steps: int = STEPS) -> dict[str, float]:
    """Weights that maximise the labels' likelihood, held to the prior with ``strength``."""
    start = prior()
    parsed = [(p, y) for p, y in ((p, landmark_labels(p)) for p in map(parse, pages)) if y]
    if not parsed:
        return start
    w, square = dict(start), defaultdict(float)
    for _ in range(steps):
        grad: dict[str, float] = defaultdict(float)
        for page, y in parsed:
            share = 1 / len(parsed)
            prob, mixed, feats, kinds = marginals(page, w)
            for k, fs in enumerate(feats):
                d = (y[k] - prob[k]) * share
                for f in fs:
                    grad[f] += d
                if k:
                    seen = (y[page.parent[k]], y[k])
                    grad[f"edge:{kinds[k]}:10"] += ((seen == (1, 0)) - mixed[k][0]) * share
                    grad[f"edge:{kinds[k]}:01"] += ((seen == (0, 1)) - mixed[k][1]) * share
        for f in grad.keys() | w.keys():
            g = grad[f] - strength * (w.get(f, 0.0) - start.get(f, 0.0))
            square[f] += g * g
            w[f] = w.get(f, 0.0) + 0.2 * g / (math.sqrt(square[f]) + 1e-6)
    return w


def main_text(html: str, w: dict[str, float]) -> str:
    page = parse(html)
    prob = marginals(page, w)[0]
    return " ".join(text for node, text in page.runs if prob[node] > 0.5)


def fit(pages: DataFrame, html_col: str = "html", n_pages: int = TRAIN_PAGES) -> dict[str, float]:
    """Weights from ``n_pages`` different labelled pages, the first by a hash of their html: the hashes are picked first, and
    only the pages of those travel to the driver."""
    rows = pages.select(F.col(f"`{html_col}`").alias("h")).filter(F.char_length("h") <= TRAIN_CHARS) \
        .filter(F.col("h").rlike("(?i)<article")).withColumn("x", F.xxhash64("h"))
    picked = [r["x"] for r in rows.select("x").distinct().orderBy("x").limit(n_pages).collect()]
    found = rows.filter(F.col("x").isin(picked)).groupBy("x").agg(F.min("h").alias("h")).collect() if picked else []
    return train([r["h"] for r in sorted(found, key=lambda r: r["x"])])


def extract(pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page."""
    import pyarrow as pa

    weights = fit(pages, html_col) if weights is None else weights
    rows = only(pages, id_col, url_col, html_col).select(
        F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), text_or_empty(html_col).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [main_text(h, weights) for h in strings(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()),
                                              pa.array([len(t) for t in out], pa.int64())],
                                             names=[id_col, url_col, "text", "n_chars"])

    kind = [f.dataType.simpleString() for f in rows.schema]
    return bounded_batches(rows).mapInArrow(run, f"`{id_col}` {kind[0]}, `{url_col}` {kind[1]}, text string, n_chars long")

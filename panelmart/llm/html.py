"""Main text of HTML pages by a tree-structured graphical model.

A page is parsed into its element tree.  Every element is a binary variable
(content or not) with a node potential from its tag, its class and id words, the
length of its own text and its share of link text, and a parent-child potential
for the kind of child.  On a tree sum-product message passing is exact: one
upward pass (children to parents) and one downward pass give every element's
content marginal.  Text below elements with a marginal above one half is kept.

The weights of the potentials maximise the likelihood of labelled pages, the
expected counts coming from the same two passes.  Labelled pages are
HTML in which the elements of the main text carry ``data-main="1"`` (or ``"0"``
where an element inside is not main text).  At most ``TRAINING_PAGES`` pages are
used; without labelled pages of one's own, ``labelled_pages`` builds a set from
templates.

Map-only: one page at a time, parsing and both passes linear in its length.
"""

from __future__ import annotations

import functools
import html as entities
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe".split())  # not rendered, or not markup
RAW_END = {name: re.compile(rf"</{name}(?=[ \t\n\x0c\r/>])", re.I | re.A) for name in RAW}
BLOCKS = frozenset("address article aside blockquote body br button caption center dd details dialog div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol "
                   "option p pre section summary table tbody td tfoot th thead tr ul".split())
# an opening tag ends these open elements (up to the first barrier)
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
ENDS_P = BLOCKS - {"br", "body", "html", "label", "button", "caption", "legend", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "summary"}
BARRIERS = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
            "p": {"td", "th", "button", "object"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE_KIND = {"p": "para", "li": "item", "td": "cell", "th": "cell", **{h: "head" for h in HEADINGS}}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[A-Za-z/!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"[ \t\n\x0b\x0c\r]+")
NAMING = ("class", "id", "role", "itemprop", "aria-label")
MAIN = 'data-main="1"'
KINDS = ("para", "item", "cell", "head", "block", "inline")
TRAINING_PAGES = 2_000
RIDGE, STEPS, RATE = 0.1, 200, 0.15
THRESHOLD = 0.5


class Page:
    """Element tree of a page: parallel lists, parents before their children."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attrs = ["#page"], [-1], [""]
        self.pieces: list[tuple[int, str, bool]] = []  # (element, raw text, a block starts before it)
        self._parse(source)

    def _parse(self, source: str) -> None:
        tag, parent, attrs, pieces = self.tag, self.parent, self.attrs, self.pieces
        stack, at, fresh, end = [0], 0, True, len(source)
        endless: set[str] = set()  # raw elements without an end tag from here on
        while at < end:
            m = TOKEN.search(source, at)
            if m is None:
                pieces.append((stack[-1], source[at:], fresh))
                break
            if m.start() > at:
                pieces.append((stack[-1], source[at:m.start()], fresh))
                fresh = False
            at, name = m.end(), m.group(2)
            if not name:
                continue  # comment, doctype, broken tag
            name = name.lower()
            if name in BLOCKS:
                fresh = True
            if m.group(1):
                for depth in range(len(stack) - 1, 0, -1):
                    if tag[stack[depth]] == name:
                        del stack[depth:]
                        break
                continue
            self._imply_ends(name, stack)
            tag.append(name)
            parent.append(stack[-1])
            attrs.append(m.group(3))
            if name in VOID or m.group(3).endswith("/"):
                continue
            if name in RAW:  # its content is no text; up to the matching end tag
                close = None if name in endless else RAW_END[name].search(source, at)
                if close:
                    at = source.find(">", close.end()) + 1 or end
                    continue
                endless.add(name)
                if name in ("script", "style"):  # never closed: code up to the next tag, then the page goes on
                    ahead = TOKEN.search(source, at)
                    at = ahead.start() if ahead else end
                continue
            stack.append(len(tag) - 1)

    def _imply_ends(self, name: str, stack: list[int]) -> None:
        for ended, kind in ((ENDS.get(name), name), ({"p"} if name in ENDS_P else None, "p")):
            if not ended:
                continue
            barriers = BARRIERS.get(kind, ())
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = self.tag[stack[depth]]
                if open_tag in ended:
                    del stack[depth:]
                    break
                if open_tag in barriers:
                    break


def _kind(tag: str) -> str:
    return INLINE_KIND.get(tag, "block" if tag in BLOCKS else "inline")


def _length_class(n: int) -> str:
    return f"text={(n > 0) + (n > 24) + (n > 99)}"


def name_features(tag: str, attrs: str) -> list[str]:
    out = [f"tag={tag}"]
    if "=" in attrs:
        for name, value in ATTRIBUTE.findall(attrs):
            if name.lower() in NAMING:
                out += [f"name={w.lower()}" for w in NAME_WORDS.findall(value)]
    return list(dict.fromkeys(out))


def text_features(page: Page) -> list[list[str]]:
    """Own text length and share of link text, per element."""
    n = len(page.tag)
    own, total, links = [0] * n, [0] * n, [0] * n
    for element, raw, _ in page.pieces:
        size = len(raw.strip())
        own[element] += size
        total[element] += size
        if page.tag[element] == "a":
            links[element] += size
    for i in range(n - 1, 0, -1):
        total[page.parent[i]] += total[i]
        links[page.parent[i]] += total[i] if page.tag[i] == "a" else links[i]
    return [[_length_class(own[i]), f"links={min(3, 4 * links[i] // max(total[i], 1))}"] for i in range(n)]


def labels_of(page: Page) -> list[int]:
    out = [0] * len(page.tag)
    for i in range(1, len(page.tag)):
        m = re.search(r'data-main="([01])"', page.attrs[i])
        out[i] = int(m.group(1)) if m else out[page.parent[i]]
    return out


# ---------------------------------------------------------------- training

# Usual names of what stands around an article, and of the article itself.
AROUND_NAMES = ("menu nav navbar navigation topnav breadcrumb header masthead banner footer copyright imprint sidebar side "
                "widget related recommended ad ads advert advertisement sponsor sponsored promo cookie cookies consent gdpr "
                "notice alert popup modal newsletter subscribe signup login search form comments comment discussion "
                "replies reply respond share social tags pagination toolbar disclaimer").split()
MAIN_NAMES = "content article post entry body text story main".split()


def _around() -> list[str]:
    """Pieces that are no main text, each with one telling name or tag only."""
    shapes = ['<div class="{n}"><p>{l}</p></div>', '<section id="{n}"><h3>{s}</h3><p>{l}</p><p>{s}</p></section>', '<div class="{n}">{l}</div>',
              '<div id="{n}"><ul><li>{l}</li><li>{s}</li></ul></div>', '<div class="{n}">{k}</div>', '<div class="{n} box">{s}</div>',
              '<section class="{n}"><div><p>{l}</p></div><div><p>{l}</p></div></section>']
    tagged = ["<{n}><p>{l}</p></{n}>", "<{n}>{l}</{n}>", "<{n}><h3>{s}</h3><p>{l}</p></{n}>", "<{n}>{k}</{n}>", "<{n}><h1>{s}</h1></{n}>",
              "<{n}><div><p>{l}</p></div></{n}>", "<{n}>{s}</{n}>"]
    pieces = [(name, shapes[(i + 2 * j) % len(shapes)]) for j in range(4) for i, name in enumerate(AROUND_NAMES)]
    pieces += [(tag, shape) for shape in tagged for tag in ("nav", "header", "footer", "aside", "form")]
    return [shape.format(n=name, s=_words(1 + i % 5), l=_words(1 + 7 * i % 60), k=f'<ul><li><a href="/a">{_words(1 + i % 3)}</a></li></ul>')
            for i, (name, shape) in enumerate(pieces)]


def _words(n: int) -> str:
    """Neutral text of ``n`` words."""
    return " ".join("some plain words that stand in a text of any kind and length".split()[i % 13] for i in range(n))


def labelled_pages() -> list[str]:
    """Labelled pages from templates: articles in their usual shapes, with and without
    the usual pieces around and inside them."""
    bodies = [
        '<h1>A title of the story</h1><p>{0}</p><p>{0}{0}</p><p>{0}{0}{0}</p>',
        '<h1>A title</h1><p><b>{0}<br><p>{0}</p><p>{0}{0}</p><p>Short one.</p>',
        '<h2>A title of the story</h2><div><p>{0}{0}</p><ul><li>A point of the list</li><li>{0}</li></ul></div><blockquote><p>{0}</p></blockquote>',
        '<h1>Title</h1><p>{0}<a href="/x">a link</a> and <em>more</em> <i>words</i> and <span>others</span>.</p><h2>Part two</h2><p>{0}</p>'
        '<table><tr><th>Head</th><td>Cell</td></tr></table><pre>some code</pre><figure><figcaption>A picture of it</figcaption></figure>',
        '<p>{0}</p>', '<h1>Title</h1><p>Word.</p>', '<h1>Title</h1>{0}{0}<br>{0}', '<h1>{0}</h1><p>Some | words</p><p>{0}</p>',
    ]
    mains = ['<article {m}>{b}</article>', '<main><article {m}>{b}</article></main>', '<main {m}>{b}</main>',
             '<article {m}><div class="inner">{b}</div></article>', '<div {m}>{b}</div>', '',
             *(f'<div class="{name}" {{m}}>{{b}}</div>' for name in MAIN_NAMES), '<section {m}>{b}</section>']
    around = _around()
    out = []
    for k, inside in enumerate(around):
        main, body = mains[k % len(mains)], bodies[k % len(bodies)].format(_words(2 + 11 * k % 70) + ". ")
        extra = inside.replace(">", ' data-main="0">', 1)  # what is no main text also stands inside the article
        other = around[(13 * k + 5) % len(around)].replace(">", ' data-main="0">', 1)
        if k % 8:
            body = (extra + body, body + extra, body.replace("<p>", extra + "<p>", 1), other + body + extra)[k % 4]
        beside = [around[(k * f + 3) % len(around)] for f in (1, 7, 11, 17)]
        if main:
            inner = "".join([*beside[:2], main.format(m=MAIN, b=body), *beside[2:]])
            inner = f'<div class="wrapper container page" id="wrap">{inner}</div>' if k % 3 == 0 else inner
            out.append(f"<html><head><title>A title</title></head><body>{inner}</body></html>")
        else:  # the text stands in the body itself
            beside = [x.replace(">", ' data-main="0">', 1) for x in beside]
            inner = "".join([*beside[:2], body, *beside[2:]])
            out.append(f"<html><head><title>A title</title></head><body {MAIN}>{inner}</body></html>")
    return out


def _passes(bias: np.ndarray, coupling: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Content marginals and expected parent-child sign products of a forest (element 0: clamped root).

    ``bias`` holds log odds; a pair weighs exp(coupling / 2) where the signs agree, else the inverse.
    """
    up = bias.copy()                       # log odds of an element from itself and all below it
    message = np.zeros(len(bias))
    for level in reversed(levels):
        half = coupling[level] / 2
        message[level] = np.logaddexp(up[level] + half, -half) - np.logaddexp(up[level] - half, half)
        np.add.at(up, parent[level], message[level])
    whole, product = up, np.zeros(len(bias))
    below = up.copy()
    whole[0] = -30.0
    for level in levels:
        half, q = coupling[level] / 2, whole[parent[level]] - message[level]  # the parent without this child
        b = below[level]
        whole[level] = b + np.logaddexp(q + half, -half) - np.logaddexp(q - half, half)
        same = np.logaddexp(0.0, q + b) + half
        differ = np.logaddexp(q, b) - half
        product[level] = np.tanh((same - differ) / 2)
    return 1 / (1 + np.exp(-np.clip(whole, -30, 30))), product


def fit(sources: list[str]) -> dict[str, float]:
    """Weights of node features and of the parent-child couplings (maximum likelihood, ridge, Adam)."""
    names: dict[str, int] = {}
    rows, cols, target, parents, kinds, depth = [0], [0], [0], [0], [0], [0]
    names["all"] = 0
    for source in sources:
        page = Page(source)
        labels, texts = labels_of(page), text_features(page)
        first = len(target) - 1
        for i in range(1, len(page.tag)):
            at = page.parent[i] and first + page.parent[i]
            for v in ["all", *name_features(page.tag[i], page.attrs[i].replace("data-main", "x")), *texts[i]]:
                rows.append(first + i)
                cols.append(names.setdefault(v, len(names)))
            target.append(labels[i])
            parents.append(at)
            kinds.append(KINDS.index(_kind(page.tag[i])))
            depth.append(depth[at] + 1)
    y = np.array(target, dtype=float)
    if not 0 < y.sum() < len(y) - 1:
        return {}
    x = np.zeros((len(y), len(names)))
    x[rows, cols] = 1.0
    x[0] = 0.0
    parent, kind, depths = np.array(parents), np.array(kinds), np.array(depth)
    levels = [np.flatnonzero(depths == d) for d in range(1, depths.max() + 1)]
    sign = 2 * y - 1
    seen = np.bincount(kind[1:], (sign * sign[parent])[1:], minlength=len(KINDS)) / 2
    weights = np.zeros(len(names) + len(KINDS))
    weights[len(names):] = 1.0
    first_moment, second_moment = np.zeros(len(weights)), np.zeros(len(weights))
    for step in range(1, STEPS + 1):
        w, j = weights[:len(names)], weights[len(names):]
        p, product = _passes(x @ w, j[kind], parent, levels)
        expected = np.bincount(kind[1:], product[1:], minlength=len(KINDS)) / 2
        p[0] = 0.0
        gradient = np.concatenate((x.T @ (y - p), seen - expected)) - RIDGE * weights
        first_moment = 0.9 * first_moment + 0.1 * gradient
        second_moment = 0.99 * second_moment + 0.01 * gradient ** 2
        weights += RATE * (first_moment / (1 - 0.9 ** step)) / (np.sqrt(second_moment / (1 - 0.99 ** step)) + 1e-9)
    out = dict(zip(names, weights.tolist()))
    return out | {f"edge={k}": float(v) for k, v in zip(KINDS, weights[len(names):])}


@functools.lru_cache(maxsize=1)
def default_weights() -> dict[str, float]:
    return fit(labelled_pages())


def train(labelled: DataFrame, html_col: str = "html", max_pages: int = TRAINING_PAGES) -> dict[str, float]:
    """Weights from at most ``max_pages`` labelled pages (those with the smallest hash)."""
    sample = (labelled.select(F.col(html_col).alias("html")).where(F.length("html") > 0)
              .orderBy(F.xxhash64("html"), "html").limit(max_pages))
    return fit([r.html for r in sample.collect()])


# ---------------------------------------------------------------- inference

class Model:
    """Potentials from fitted weights; without weights nothing is content."""

    def __init__(self, weights: dict[str, float]):
        self.weights = {k: v for k, v in weights.items() if not k.startswith("edge=")}
        self.bias = weights.get("all", -30.0)
        self.edge = {}
        for kind in KINDS:
            same = math.exp(weights.get(f"edge={kind}", 0.0) / 2)
            self.edge[kind] = (same, 1 / same, 1 / same, same)
        self.memo: dict[tuple[str, str], float] = {}

    def node_odds(self, tag: str, attrs: str) -> float:
        key = (tag, attrs if "=" in attrs else "")
        known = self.memo.get(key)
        if known is None:
            known = self.bias + sum(self.weights.get(f, 0.0) for f in name_features(*key))
            if len(self.memo) > 50_000:
                self.memo.clear()
            self.memo[key] = known
        return known

    def marginals(self, page: Page) -> list[float]:
        """Probability of content per element: messages up, then down."""
        n, parent, tag = len(page.tag), page.parent, page.tag
        texts = text_features(page)
        beliefs: list[tuple[float, float]] = [(1.0, 1e-6)]  # the page itself is no content
        for i in range(1, n):
            x = self.node_odds(tag[i], page.attrs[i]) + sum(self.weights.get(f, 0.0) for f in texts[i])
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
            beliefs.append((1 - p, p))
        edges = [self.edge[_kind(t)] for t in tag]
        up: list[tuple[float, float]] = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):  # children come after their parents
            b0, b1 = beliefs[i]
            e00, e01, e10, e11 = edges[i]
            m0, m1 = e00 * b0 + e01 * b1, e10 * b0 + e11 * b1
            up[i] = (m0, m1)
            p0, p1 = beliefs[parent[i]]
            p0, p1 = p0 * m0, p1 * m1
            scale = p0 + p1
            beliefs[parent[i]] = (p0 / scale, p1 / scale)
        out = [0.0] * n
        whole = list(beliefs)
        out[0] = whole[0][1] / (whole[0][0] + whole[0][1])
        for i in range(1, n):
            p0, p1 = whole[parent[i]]
            m0, m1 = up[i]
            q0, q1 = p0 / m0, p1 / m1  # the parent without this child's own message
            e00, e01, e10, e11 = edges[i]
            d0, d1 = q0 * e00 + q1 * e10, q0 * e01 + q1 * e11
            b0, b1 = beliefs[i][0] * d0, beliefs[i][1] * d1
            scale = b0 + b1
            whole[i] = (b0 / scale, b1 / scale)
            out[i] = whole[i][1]
        return out

    def text(self, source: str | None) -> str:
        """Main text of one page: blocks in page order, joined by one space."""
        if not source:
            return ""
        page = Page(source)
        content = self.marginals(page)
        out, pending = [], False
        for element, raw, starts in page.pieces:
            pending = pending or starts
            if content[element] > THRESHOLD:
                if pending:
                    out.append(" ")
                    pending = False
                out.append(entities.unescape(raw) if "&" in raw else raw)
        return SPACE.sub(" ", "".join(out)).strip(" ")


def extract_text(pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id",
                 url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text and n_chars of every page.

    Null or empty HTML, and pages without main text, give an empty text.  Broken
    markup is read as browsers do (unclosed elements end with their parents).  One
    result per input row; null ids and repeated rows are kept; other columns are not
    read; an empty table gives an empty result.
    """
    weights = weights if weights is not None else default_weights()
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    schema = f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(weights)
        for batch in batches:
            texts = [model.text(x.as_py()) for x in batch.column(2)]
            sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes)],
                                             [id_col, url_col, "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(run, schema)

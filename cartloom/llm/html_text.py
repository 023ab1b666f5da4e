"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements with its runs of text as leaves. Each node is content or not:
its own weights depend on tag, class and id words and, for text, on length, links and punctuation; parent-child
weights depend on whether the child is an element or text. One upward and one downward pass of sum-product
messages give each node's marginal, and text whose marginal exceeds one half is kept, in page order. Weights maximise the
likelihood of labelled pages, a fixed number of them, made here from invented layouts.

Null or empty html has empty text; rows are independent, so repeated rows, ties and empty tables need no care.
Very long and deeply nested pages are read whole, within one task, in linear time; a tag that is never closed is text.
Columns other than page_id, url and html are not read, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^\"'>]|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S,
)
_START = re.compile(r"<(?:[!?]|(/?)([a-zA-Z]))")
_NAME_END = re.compile(r"[\s/>]")
_QUOTE_OR_END = re.compile(r"[\"'>]")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template svg iframe select option".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var".split()
)
#: What ends an option: its own end tag, which is passed over, or else one of these or a block, read as tags.
_OPTION_ENDS = re.compile(r"</?(?:option|optgroup|select|datalist)(?=[\s/>])", re.I)
#: Start tags that end an open element of the same group.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_LISTS = ("ul", "ol", "dl", "table")
_TAGS = (
    "article main nav header footer aside form section div p h1 h2 h3 h4 h5 h6 ul ol li table tr td th "
    "blockquote pre figure figcaption body html head dl dt dd button fieldset details address"
).split()
_BLOCK = re.compile(rf"</?(?:{'|'.join(_TAGS)})(?=[\s/>])", re.I)
_WORDS = {
    "content": r"content|article|post(?!ing)|entry|story|main|body|text",
    "menu": r"nav|menu|breadcrumb|pagination|toc|skip",
    "head": r"head(?!line)|masthead|top(?![-_]?(?:story|stories|news|article|post|ic))|logo",
    "foot": r"foot|copyright|legal",
    "side": r"side|widget|related|recommend|popular|trending|rail",
    "notice": r"cookie|notice|consent|banner|alert|popup|modal|gdpr|overlay",
    "advert": r"\bads?\b|advert|sponsor|promo",
    "comment": r"comment|repl(?:y|ies)|discuss|respond|disqus",
    "form": r"form|search|login|subscribe|newsletter|signup",
    "share": r"share(?![-_]?(?:price|holder))|social|follow|byline|meta|tags?\b",
}
_WORDS = {k: re.compile(v, re.I) for k, v in _WORDS.items()}
_TEXT = ("text", "short", "medium", "long", "links", "sentence", "copyright", "words")
FEATURES = {name: k for k, name in enumerate(["bias", *(f"tag {t}" for t in _TAGS), "tag other", *_WORDS, *_TEXT, "hidden"])}


@dataclass
class Tree:
    """Nodes in page order, parents before children; `texts` has the string of text nodes."""

    parent: list[int] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)

    def add(self, parent: int, features: list[int], text: str | None = None) -> int:
        self.parent.append(parent)
        self.features.append(features)
        self.texts.append(text)
        return len(self.parent) - 1


def _element(tag: str, attributes: str) -> list[int]:
    out = [FEATURES["bias"], FEATURES.get(f"tag {tag}", FEATURES["tag other"])]
    if attributes:
        words = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes))
        out += [FEATURES[k] for k, pattern in _WORDS.items() if words and pattern.search(words)]
        if _HIDDEN.search(attributes):
            out.append(FEATURES["hidden"])
    return out


def _leaf(text: str, linked: int) -> list[int]:
    n = len(text)
    out = [FEATURES["bias"], FEATURES["text"], FEATURES["short" if n < 40 else "medium" if n < 160 else "long"]]
    if 2 * linked > n:
        out.append(FEATURES["links"])
    if re.search(r"[.!?…]\W*$", text):
        out.append(FEATURES["sentence"])
    if "©" in text or "copyright" in text.lower():
        out.append(FEATURES["copyright"])
    if text.count(" ") > 4:
        out.append(FEATURES["words"])
    return out


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I)


class Tags:
    """The tags of a page in turn, in time linear in its length.

    A tag that is never closed is text, and would be read to the page's end from each "<". After the first one,
    what follows a place outside quotes is remembered, so that no part is read twice.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.careful = False
        self.ends: dict[int, int] = {}
        self.known: dict[re.Pattern, tuple[int, int]] = {}

    def following(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, name, attributes) of the first tag from `at`; comments and the like have no name."""
        while m := _START.search(self.page, at):
            found = _TOKEN.match(self.page, m.start()) if not self.careful or not m[2] and self._ends(m.start()) else None
            if found:
                return found.start(), found.end(), found[1] or "", found[2] or "", found[3] or ""
            self.careful = True
            if m[2]:
                name = self._next(_NAME_END, m.end())
                end = self._end(name)
                if end >= 0:
                    return m.start(), end + 1, m[1], self.page[m.start(2) : name], self.page[name:end]
            at = m.start() + 1
        return None

    def _ends(self, at: int) -> bool:
        return at < self.last or self.page.startswith(("<!--", "<![CDATA["), at)

    def _next(self, pattern: re.Pattern, at: int) -> int:
        low, found = self.known.get(pattern, (0, -1))
        if not low <= at <= found:
            m = pattern.search(self.page, at)
            found = m.start() if m else len(self.page)
            self.known[pattern] = at, found
        return found

    def _end(self, at: int) -> int:
        """Where the first ">" outside quotes is, or -1."""
        passed, at, end = [], self._next(_QUOTE_OR_END, at), -1
        while at < len(self.page):
            if at in self.ends:
                end = self.ends[at]
                break
            passed.append(at)
            if self.page[at] == ">":
                end = at
                break
            closed = self.page.find(self.page[at], at + 1)
            m = _QUOTE_OR_END.search(self.page, closed + 1) if closed >= 0 else None
            at = m.start() if m else len(self.page)
        self.ends.update(dict.fromkeys(passed, end))
        return end


def parse(page: str) -> Tree:
    tree = Tree()
    stack = [("", tree.add(-1, [FEATURES["bias"]]))]
    #: For each tag, where in the stack it is open.
    places: dict[str, list[int]] = defaultdict(list)
    tags = Tags(page)
    pending: list[str] = []
    linked = depth = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pending)).split())
        if text:
            tree.add(stack[-1][1], _leaf(text, linked), text)
        pending.clear()
        linked = 0

    def close(tag: str) -> None:
        flush()
        while len(stack) > 1:
            top = stack.pop()[0]
            places[top].pop()
            if top == tag:
                break

    @cache
    def last_end(tag: str) -> int:
        """Where the last end tag of this name starts, so that many unclosed elements do not search the rest of the page each."""
        return max((m.start() for m in _raw_end(tag).finditer(page)), default=-1)

    def after_raw(tag: str, attributes: str, at: int) -> int:
        """Where reading goes on after a raw start tag; without an end tag, right there, but for script and style."""
        if tag == "svg" and attributes.rstrip().endswith("/"):
            return at
        if tag == "option":
            end = _OPTION_ENDS.search(page, at)
            if end and end[0].lower() == "</option":
                return page.find(">", end.end()) + 1 or len(page)
            block = _BLOCK.search(page, at, end.start() if end else len(page))
            return block.start() if block else end.start() if end else at
        if last_end(tag) < at:
            return len(page) if tag in ("script", "style") else at
        return page.find(">", _raw_end(tag).search(page, at).end()) + 1 or len(page)

    while at < len(page):
        found = tags.following(at)
        gap = page[at : found[0] if found else len(page)]
        if gap:
            pending.append(gap)
            linked += len(gap) if depth else 0
        if not found:
            break
        _, at, slash, tag, attributes = found
        tag = tag.lower()
        if not tag:
            continue
        if slash:
            if tag == "a":
                depth = max(0, depth - 1)
            elif tag not in _INLINE and places[tag]:
                close(tag)
            continue
        if tag in _RAW:
            at = after_raw(tag, attributes, at)
        elif tag in ("br", "hr", "img", "wbr"):
            pending.append(" " if tag != "wbr" else "")
            if tag == "hr":
                flush()
        elif tag == "a":
            depth += 1
        elif tag not in _INLINE and tag not in _VOID:
            flush()
            depth = 0
            if places["p"]:
                close("p")
            if tag in _ENDS:
                inner = max((places[t][-1] for t in _ENDS[tag] if places[t]), default=0)
                if inner > max((places[t][-1] for t in _LISTS if places[t]), default=0):
                    close(stack[inner][0])
            if not attributes.rstrip().endswith("/") or tag not in ("div", "p"):
                places[tag].append(len(stack))
                stack.append((tag, tree.add(stack[-1][1], _element(tag, attributes))))
    flush()
    return tree


@dataclass
class Model:
    """`own` by feature, for content against not; `pair[k]` for a child element (0) or text (1), by parent and child."""

    own: list[float]
    pair: list[list[list[float]]]

    def marginals(self, tree: Tree):
        """P(content) of each node, and of each node with its parent as four numbers (of the root: None)."""
        n = len(tree.parent)
        pot = [[[exp(x) for x in row] for row in p] for p in self.pair]
        up = []
        for f in tree.features:
            s = max(-30.0, min(30.0, sum(self.own[k] for k in f)))
            p = 1 / (1 + exp(-s))
            up.append([1 - p, p])
        sent = [None] * n
        for i in range(n - 1, 0, -1):
            a, b = up[i]
            p = pot[tree.texts[i] is not None]
            m0, m1 = p[0][0] * a + p[0][1] * b, p[1][0] * a + p[1][1] * b
            z = m0 + m1
            sent[i] = (m0 / z, m1 / z)
            u = up[tree.parent[i]]
            u[0] *= m0 / z
            u[1] *= m1 / z
            z = u[0] + u[1]
            u[0] /= z
            u[1] /= z
        joint = [None] * n
        belief = [None] * n
        belief[0] = up[0]
        for i in range(1, n):
            q0, q1 = belief[tree.parent[i]]
            q0, q1 = q0 / max(sent[i][0], 1e-300), q1 / max(sent[i][1], 1e-300)
            a, b = up[i]
            p = pot[tree.texts[i] is not None]
            j = (q0 * p[0][0] * a, q0 * p[0][1] * b, q1 * p[1][0] * a, q1 * p[1][1] * b)
            z = sum(j)
            joint[i] = tuple(x / z for x in j)
            belief[i] = (joint[i][0] + joint[i][2], joint[i][1] + joint[i][3])
        return [b[1] for b in belief], joint


def made_page(rng: np.random.Generator) -> tuple[str, list[str]]:
    """An invented page and its content blocks."""
    pick = lambda *x: x[rng.integers(len(x))]
    word = lambda: "".join(rng.choice(list("aeinorstlhdu"), rng.integers(2, 9)))
    line = lambda lo, hi: " ".join(word() for _ in range(rng.integers(lo, hi)))
    sentence = lambda: line(3, 25).capitalize() + pick(".", ".", ".", "!", "?", "")
    links = lambda n: "".join(f"<li><a href='/x'>{line(1, 4)}</a></li>" for _ in range(n))
    blocks: list[str] = []
    tiny = rng.random() < 0.25

    def block(tag: str, text: str) -> str:
        blocks.append(text)
        return f"<{tag}>{text}" + pick(f"</{tag}>", f"</{tag}>", "" if tag in ("p", "li") else f"</{tag}>")

    def body() -> str:
        out = block("h1", line(2, 10).capitalize()) if rng.random() < 0.8 else ""
        for _ in range(rng.integers(1, 8)):
            kind = rng.random()
            if tiny:
                short = line(1, 5)
                out += block("p", pick(short, f"{short.capitalize()}.", f"{short.capitalize()} © {word()}."))
            elif kind < 0.7:
                out += block("p", " ".join(sentence() for _ in range(rng.integers(1, 5))))
            elif kind < 0.8:
                out += "</p><ul>" + "".join(block("li", line(2, 12)) for _ in range(3)) + "</ul>"
            elif kind < 0.87:
                out += block(pick("h2", "h3", "h4", "h5", "h6"), line(1, 6))
            elif kind < 0.9:
                out += "</p><table>" + "".join(f"<tr>{block('th', line(1, 3))}{block('td', line(1, 9))}</tr>" for _ in range(3)) + "</table>"
            elif kind < 0.92:
                out += f"</p><figure><img src='/i'>{block('figcaption', sentence())}</figure>"
            elif kind < 0.94:
                out += f"</p><dl>{block('dt', line(1, 3))}{block('dd', sentence())}</dl>"
            elif kind < 0.95:
                out += block("p", f"{sentence()} © {sentence()}")
            elif kind < 0.97:
                out += "</p>" + block("div", sentence())
            else:
                out += block(pick("blockquote", "pre"), sentence())
        return out

    noise = {
        "menu": lambda: pick("<nav>{}</nav>", "<div class='menu'>{}</div>", "<div id='navbar'>{}</div>").format(f"<ul>{links(5)}</ul>"),
        "head": lambda: pick("<header>{}</header>", "<div class='masthead'>{}</div>").format(f"<p>{line(1, 8)}</p>"),
        "ad": lambda: f"<div class='{pick('ad', 'advert', 'ad-slot', 'sponsored', 'promo')}'>{pick('', '<p>')}{sentence()}</div>",
        "note": lambda: f"<div class='{pick('cookie-notice', 'notice', 'banner', 'consent')}'><p>{sentence()}</p><button>{word()}</button></div>",
        "side": lambda: pick("<aside>{}</aside>", "<div class='sidebar'>{}</div>", "<div class='related'>{}</div>").format(
            f"<h3>{line(1, 3)}</h3><ul>{links(4)}</ul>" + (f"<p>{sentence()}</p>" if rng.random() < 0.5 else "")
        ),
        "form": lambda: f"<form><label>{line(1, 4)}</label><input><p>{sentence()}</p></form>",
        "comments": lambda: f"<{pick('div', 'section')} {pick('class', 'id')}='{pick('comments', 'comment-list', 'replies')}'><h3>{line(1, 3)}</h3>"
        + "".join(f"<div class='comment'><p>{sentence()} {sentence()}</p></div>" for _ in range(rng.integers(1, 4)))
        + "</div>",
        "hidden": lambda: f"<div {pick('hidden', 'style=\"display:none\"')}><p>{sentence()} {sentence()}</p></div>",
        "share": lambda: f"<div class='{pick('share', 'social', 'share-bar', 'follow-us')}'>{line(1, 3)} <a href='/x'>{word()}</a> <a href='/y'>{word()}</a></div>",
        "foot": lambda: pick("<footer>{}</footer>", "<div class='footer'>{}</div>").format(f"&copy; {line(2, 9)}."),
    }
    some = lambda *names: "".join(noise[n]() for n in names if rng.random() < 0.6)
    shell = pick("<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", "<div class='content'>{}</div>", "<div id='post-body'>{}</div>", "<div><div>{}</div></div>", "<div class='story'>{}</div>")
    inner = body()
    inside = some("ad", "side", "note", "share", "hidden") if rng.random() < 0.3 else ""
    page = some("menu", "head", "note", "ad") + shell.format(inner + "</p>" + inside) + some("side", "ad", "share", "comments", "form", "hidden", "note", "foot")
    return f"<html><body>{page}</body></html>", [" ".join(html.unescape(b).split()) for b in blocks]


def labels_of(tree: Tree, blocks: list[str]) -> list[int]:
    """Text nodes that are content blocks, and every element that holds one."""
    wanted = set(blocks)
    y = [int(t in wanted) if t is not None else 0 for t in tree.texts]
    for i in range(len(y) - 1, 0, -1):
        if y[i]:
            y[tree.parent[i]] = 1
    return y


@cache
def trained(pages: int = 240, rounds: int = 40, seed: int = 5) -> Model:
    """Weights by gradient ascent on the likelihood of made labelled pages (a bounded sample)."""
    rng = np.random.default_rng(seed)
    data = []
    for _ in range(pages):
        page, blocks = made_page(rng)
        tree = parse(page)
        data.append((tree, labels_of(tree, blocks)))
    own, pair = np.zeros(len(FEATURES)), np.zeros((2, 2, 2))
    sums_own, sums_pair = np.full(own.shape, 1e-8), np.full(pair.shape, 1e-8)
    for _ in range(rounds):
        g_own, g_pair = -0.02 * own, -0.02 * pair
        model = Model(own.tolist(), pair.tolist())
        for tree, y in data:
            node, joint = model.marginals(tree)
            for i, f in enumerate(tree.features):
                g_own[f] += (y[i] - node[i]) / pages
                if i:
                    kind = int(tree.texts[i] is not None)
                    g_pair[kind] -= np.reshape(joint[i], (2, 2)) / pages
                    g_pair[kind, y[tree.parent[i]], y[i]] += 1 / pages
        sums_own += g_own**2
        sums_pair += g_pair**2
        own += 0.6 * g_own / np.sqrt(sums_own)
        pair += 0.6 * g_pair / np.sqrt(sums_pair)
    return Model(own.tolist(), pair.tolist())


def main_text(page: str, model: Model) -> str:
    tree = parse(page)
    node, _ = model.marginals(tree)
    return "\n\n".join(t for t, p in zip(tree.texts, node) if t is not None and p > 0.5)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    model = pages.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = [main_text(h, model.value) if h else "" for h in part.column(2).to_pylist()]
                n = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), n], ["page_id", "url", "text", "n_chars"]
                )

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")

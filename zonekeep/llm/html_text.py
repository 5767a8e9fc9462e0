"""Main text of raw HTML by tree scoring.

The page becomes a tree with HTML's own rules for void elements, raw text and
implied end tags.  Each paragraph passes points for its length and commas to its
parent, and every ancestor gets half of what the one below it got (lists and
tables pass on all they get); a container's points are discounted by its share
of link text.  The best container is kept and, beside it and beside each of its
ancestors, the siblings that score like it, and headings.  No element counts as
the article because of its name.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are set aside before: by element and role always; by class or id
when a name consists of such words only (``comment-list``), or tells of
comments; when a name has such a word beside others (``page-side``) only while
the element holds less than half of the page's text.  Names that begin with has,
with, no and the like say nothing of the element itself.  What holds an article
or main element is not set aside by such a name, nor is anything when the
page has no other text.

Blocks are the runs of text between block elements; white space inside a block
becomes one space, character references are decoded after the tags are taken
away, and blocks are joined in page order by a newline.

Defined results: a page that is null or has no text gives an empty text; a page
without paragraphs gives all its text that is not set aside; a tag or comment
that is never closed ends with the page; a stray end tag is ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of the HTML standard by how they are treated here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
SET_ASIDE = frozenset("nav header footer aside form script style noscript template svg math canvas object iframe button select textarea input label fieldset datalist menu dialog head title audio video map".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead title tr".split()) | frozenset(["li", "dd", "dt"])
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
}
_SCOPE = frozenset("html body table td th caption article section div main aside nav header footer form ul ol li dl dd dt blockquote figure button template object".split())

#: Words of a class or id that mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted sidebar side aside nav navbar navigation menu breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus replies reply respond share sharing social related recommended recommendations widget widgets toolbar pagination pager paging skip hidden".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form toolbar".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: Words that say nothing about what an element holds, and words that make a name tell of something else.
NEUTRAL_WORDS = frozenset("list lists item items area box bar block blocks container wrapper wrap inner link links button buttons icon icons left right top bottom group panel zone slot unit".split())
OTHER_WORDS = frozenset("has with without no not hide show is".split())
#: How firmly an element is set aside: not, by a name among others, by a name, by its element or role.
NOT, LOOSELY, BY_NAME, ALWAYS = range(4)
PARAGRAPHS = frozenset(["p", "pre", "td", "blockquote", "li", "dd"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that pass on all their points and are no containers of their own.
PASSING = frozenset("ul ol dl table thead tbody tfoot tr".split())
#: Elements beside the best container that are kept when they read like text.
_LIKE = frozenset("p pre blockquote ul ol dl table figure".split())
#: A sibling is kept from these shares of the best container's value on: beside it, and beside its ancestors.
BESIDE, ABOVE = 0.2, 0.5

_TAG = re.compile(r"<(?:!--(?:.*?--!?>|.*\Z)|/?([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))|[!?/][^>]*+(?:>|\Z))", re.DOTALL)
_ATTR = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SENTENCE = re.compile(r"[.!?:;。！？…][\"'”’»)]*\s*\Z")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class _Node:
    __slots__ = ("aside", "commas", "heading_chars", "items", "link_chars", "parent", "passed", "peak", "tag", "text_chars")

    def __init__(self, tag: str, parent: _Node | None, aside: int):
        self.tag, self.parent, self.aside = tag, parent, aside
        self.items: list = []
        self.text_chars = self.link_chars = self.heading_chars = self.commas = 0
        self.passed = self.peak = 0.0

    @property
    def value(self) -> float:
        if self.tag in PASSING or not self.text_chars:
            return 0.0
        return self.passed * (1.0 - self.link_chars / self.text_chars)


def name_kind(name: str) -> int:
    """How firmly one class name or id sets its element aside."""
    words = [w.lower() for w in _WORDS.findall(name)]
    found = [w for w in words if w in ASIDE_WORDS]
    if not found or any(w in OTHER_WORDS for w in words):
        return NOT
    if any(w in COMMENT_WORDS for w in words) or all(w in ASIDE_WORDS or w in NEUTRAL_WORDS for w in words):
        return BY_NAME
    return LOOSELY


def _aside(tag: str, attributes: str) -> int:
    if tag in SET_ASIDE:
        return ALWAYS
    out = NOT
    if not attributes or tag in ("html", "body", "main"):
        return out
    for name, a, b, c in _ATTR.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            out = max([out, *map(name_kind, unescape(value).split())])
        elif name == "role" and value.strip().lower() in ASIDE_ROLES:
            return ALWAYS
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return ALWAYS
    return out


def parse(html: str) -> _Node:
    """The tree of a page: items of a node are its texts and child nodes in order."""
    root = _Node("#page", None, NOT)
    now, at, n = root, 0, len(html)
    open_tags: dict[str, int] = {}

    def close_to(node: _Node, now: _Node) -> _Node:
        """The parent of ``node`` after everything open down to it is closed."""
        while True:
            open_tags[now.tag] -= 1
            if now is node:
                return now.parent
            now = now.parent

    find = _TAG.search
    lower = None
    while at < n:
        m = find(html, at)
        if m is None:
            now.items.append(html[at:])
            break
        if m.start() > at:
            now.items.append(html[at : m.start()])
        at = m.end()
        if m[1] is None:
            continue
        tag = m[1].lower()
        if html[m.start() + 1] == "/":
            if open_tags.get(tag):  # a stray end tag is not looked for
                node = now
                while node.tag != tag:
                    node = node.parent
                now = close_to(node, now)
            continue
        attributes = m[2].rstrip("/>")
        if tag in CLOSES_P and open_tags.get("p"):
            node = now
            while node is not root and node.tag != "p" and node.tag not in _SCOPE:
                node = node.parent
            if node.tag == "p":
                now = close_to(node, now)
        if (ends := IMPLIED_END.get(tag)) and any(open_tags.get(x) for x in ends[0]):
            node, close = now, None
            while node is not root and node.tag not in ends[1]:
                if node.tag in ends[0]:
                    close = node
                node = node.parent
            if close is not None:
                now = close_to(close, now)
        node = _Node(tag, now, _aside(tag, attributes))
        now.items.append(node)
        if tag in RAW:
            if lower is None:
                lower = html.lower()
            end = lower.find(f"</{tag}", at)
            node.aside = ALWAYS
            if end < 0:
                break
            close = html.find(">", end)
            at = n if close < 0 else close + 1
        elif tag not in VOID:
            now = node
            open_tags[tag] = open_tags.get(tag, 0) + 1
    return root


def _measure(root: _Node, limit: int) -> list[_Node]:
    """Characters of every node, and the nodes in page order, without what is set aside more firmly than ``limit``."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        node.text_chars = node.link_chars = node.heading_chars = node.commas = 0
        stack.extend(reversed([x for x in node.items if isinstance(x, _Node) and x.aside <= limit]))
    for node in reversed(order):
        for x in node.items:
            if isinstance(x, str):
                node.text_chars += len(x.strip())
                node.commas += x.count(",") + x.count("，") + x.count("、")
        if node.tag == "a":
            node.link_chars = node.text_chars
        if node.tag in HEADINGS:
            node.heading_chars = node.text_chars
        if node.parent is not None:
            for k in ("text_chars", "link_chars", "heading_chars", "commas"):
                setattr(node.parent, k, getattr(node.parent, k) + getattr(node, k))
    return order


def _settle(root: _Node) -> None:
    """Decides what the names of classes set aside: ``aside`` is NOT or ALWAYS afterwards."""
    order = _measure(root, BY_NAME)
    if all(x.aside == NOT for x in order):
        return
    for node in reversed(order):  # what holds an article is not set aside by its name, except among comments
        if node.aside == NOT and node.tag in ("article", "main") and node.text_chars > node.link_chars:
            up = node.parent
            while up is not None and up.aside != BY_NAME:
                up.aside, up = NOT, up.parent
            if up is not None and not _in_comments(up):
                while up is not None:
                    up.aside, up = NOT, up.parent
    words = lambda x: x.text_chars - x.link_chars
    rest = _measure(root, LOOSELY)
    if words(root) <= 0:  # nothing else has text
        rest = _measure(root, BY_NAME)
        for node in rest:
            node.aside = NOT
    half = words(root) / 2
    for node in rest:
        if node.aside == LOOSELY and words(node) > half:
            node.aside = NOT
    for node in order:
        if node.aside != NOT:
            node.aside = ALWAYS


def _in_comments(node: _Node) -> bool:
    """Whether an element is, or is in, one of many of its kind: each comment of a list may be an article of its own."""
    count, stack = 0, [node]
    while stack and count < 2:
        x = stack.pop()
        count += x.tag == "article"
        stack.extend(y for y in x.items if isinstance(y, _Node))
    return count > 1


def _score(order: list[_Node]) -> None:
    for node in reversed(order):  # from the leaves up, each node once
        node.peak = max(node.peak, node.value)
        if node.parent is None:
            continue
        node.parent.peak = max(node.parent.peak, node.peak)
        given = node.passed if node.tag in PASSING else node.passed / 2
        direct = any(isinstance(x, str) and x.strip() for x in node.items)
        inline = direct and not any(isinstance(x, _Node) and x.tag in BLOCK and x.aside == NOT for x in node.items)
        if node.text_chars and (node.tag in PARAGRAPHS or node.tag in ("div", "section") and inline):
            given += 1.0 + node.commas + min(node.text_chars / 100.0, 3.0)
        if node.parent.tag not in ("#page", "html"):
            node.parent.passed += given


def _text(node: _Node) -> str:
    return "\n".join(blocks([node]))


def _reads_like_text(node: _Node) -> bool:
    if node.tag not in _LIKE or not node.text_chars:
        return False
    if node.text_chars > 80:
        return node.link_chars < 0.25 * node.text_chars
    return not node.link_chars and (node.tag != "p" or bool(_SENTENCE.search(_text(node))))


def choose(root: _Node) -> list[_Node]:
    """The best container and what belongs to it, in page order."""
    _settle(root)
    order = _measure(root, NOT)
    _score(order)
    best = max(order, key=lambda x: x.value)
    if best.value <= 0:
        return [root]
    if best.tag in ("body", "#page", "html"):
        return [best]
    kept, path, least = {id(best)}, best, BESIDE * best.value
    while path.parent is not None:
        after = False
        for x in path.parent.items:
            if x is path:
                after = True
            elif isinstance(x, _Node) and x.aside == NOT and x.text_chars:
                heading = x.heading_chars == x.text_chars and not x.link_chars
                if path is best:
                    keep = x.peak >= least or heading or _reads_like_text(x)
                else:  # a heading over the best container, or another part of the same weight
                    keep = x.peak >= ABOVE * best.value or heading and not after
                if keep:
                    kept.add(id(x))
        path = path.parent
    return [x for x in order if id(x) in kept]


def blocks(nodes: list[_Node]) -> list[str]:
    """Texts of the blocks under the nodes, decoded and with single spaces."""
    out: list[str] = []
    run: list[str] = []

    def cut() -> None:
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                out.append(text)
            run.clear()

    for top in nodes:
        stack: list = [top]
        while stack:
            x = stack.pop()
            if x is None:
                cut()
            elif isinstance(x, str):
                run.append(x)
            elif x.tag == "br":
                run.append("\n")
            elif x.aside == NOT:
                if x.tag in BLOCK:
                    cut()
                    stack.append(None)
                stack.extend(reversed(x.items))
        cut()
    return out


def main_text(html: str | None) -> str:
    return "\n".join(blocks(choose(parse(html)))) if html else ""


def extract_pages(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, text and n_chars (code points) of every page."""
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep) + ", text string, n_chars long"
    names = [*keep, "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                texts = [main_text(x.as_py()) for x in part.column(len(keep))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)

    return pages.select(*keep, html).mapInArrow(run, schema)

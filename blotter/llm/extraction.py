"""HTML extraction (operator 1): layout-aware rendering of a page's visible text.

``build_tree`` makes a tree of elements with implied end tags (paragraphs, list items, rows, cells, options, head), and
``render`` lays its visible text out: blocks on lines of their own with blank lines where a browser has margins, collapsed
white space (kept in ``pre``), bulleted and numbered lists, and tables whose cells are padded to their column's width.
Hidden are the head, scripts and other elements a browser doesn't draw, and whatever ``hidden``, ``display: none`` or
``visibility: hidden`` covers; a descendant's ``visibility: visible`` shows it again.

Both work with explicit stacks, so nesting may be as deep as the page. Null and empty pages give an empty text; broken
markup never fails (a tag that isn't closed before the end is dropped); every input row gives one output row, repeated
rows and rows with a null id included; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from html import unescape
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import ship

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NOT_DRAWN = frozenset(
    "head script style title template noscript iframe noembed noframes object svg math canvas audio video datalist"
    " select area base link meta param source track".split()
)
#: Blank lines around, then elements that only start and end a line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset menu".split())
BLOCK = SPACED | frozenset(
    "address article aside body center dd details div dt fieldset figcaption footer form header html legend li main nav"
    " section summary caption tr thead tbody tfoot option optgroup".split()
)
CLOSES_P = BLOCK - frozenset("tr thead tbody tfoot caption option optgroup".split())
#: A start tag ends these open elements, if they are open inside the nearest of the second set.
IMPLIED = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select datalist"),
    "optgroup": ("option optgroup", "select"), "tr": ("tr td th caption", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "thead": ("tr td th caption thead tbody tfoot", "table"),
    "tbody": ("tr td th caption thead tbody tfoot", "table"), "tfoot": ("tr td th caption thead tbody tfoot", "table"),
    "body": ("head", "html"),
}
IMPLIED = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}
SCOPE = frozenset("td th caption table button object template".split())
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
QUOTE_OR_END = re.compile(r"[\"'>]")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def tag_end(s: str, i: int) -> int:
    """Index of the ``>`` that ends the tag; one inside a quoted value doesn't. -1: there is none."""
    while m := QUOTE_OR_END.search(s, i):
        at = m.start()
        if s[at] == ">":
            return at
        close = s.find(s[at], at + 1) if s[i:at].rstrip().endswith("=") else -1
        i = close + 1 if close >= 0 else at + 1
    return -1


def tokens(s: str):
    """("text", data), ("start", name, attributes) and ("end", name)."""
    i = 0
    while i < len(s):
        at = s.find("<", i)
        if at < 0:
            yield "text", unescape(s[i:]), None
            return
        if at > i:
            yield "text", unescape(s[i:at]), None
        if s.startswith("<!--", at):
            end = s.find("-->", at + 2)
            i = len(s) if end < 0 else end + 3
        elif s[at + 1 : at + 2] in ("!", "?"):
            end = s.find(">", at)
            i = len(s) if end < 0 else end + 1
        elif m := NAME.match(s, at + 1 + s.startswith("/", at + 1)):
            end = tag_end(s, m.end())
            if end < 0:
                return
            name = m[0].lower()
            i = end + 1
            if s[at + 1] == "/":
                yield "end", name, None
                continue
            held = {k.lower(): unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(s[m.end() : end])}
            yield "start", name, held
            if name in RAW:
                close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(s, i)
                end = close.start() if close else len(s)
                yield "text", unescape(s[i:end]) if name in ("textarea", "title") else s[i:end], None
                i = end
        else:
            yield "text", "<", None
            i = at + 1


class OpenElements:
    """The stack of open elements, and where on it each tag stands, so that no step looks through the stack."""

    def __init__(self, root: Node):
        self.stack: list[Node] = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, k: int) -> None:
        for node in self.stack[k:]:
            self.places[node.tag].pop()
        del self.stack[k:]

    def nearest(self, tags: Iterable[str]) -> int:
        """The innermost open element with one of the tags; 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, tags: frozenset[str], until: frozenset[str]) -> None:
        k = self.nearest(tags)
        if k > self.nearest(until):
            # further outward ones of the same set end too: a row ends its cells and itself
            while k > 1 and self.stack[k - 1].tag in tags:
                k -= 1
            self.cut(k)


IN_TABLE = frozenset("td th tr thead tbody tfoot caption".split())
TABLE, PARAGRAPH = frozenset(["table"]), frozenset(["p"])


def build_tree(s: str) -> Node:
    """In time linear in the page: deep nesting and broken marks cost no more than others."""
    root = Node("#root", {})
    open_, nodes = OpenElements(root), [root]
    for kind, what, attributes in tokens(s):
        if kind == "text":
            open_.stack[-1].children.append(what)
        elif kind == "start":
            if what in CLOSES_P:
                open_.close(PARAGRAPH, SCOPE)
            if what in IMPLIED:
                open_.close(*IMPLIED[what])
            node = Node(what, attributes)
            nodes.append(node)
            open_.stack[-1].children.append(node)
            if what not in VOID:
                open_.push(node)
        elif what == "br":
            open_.stack[-1].children.append(Node("br", {}))
        else:
            k, bound = open_.nearest([what]), TABLE if what in IN_TABLE else frozenset() if what in SCOPE else SCOPE
            if k > open_.nearest(bound):
                open_.cut(k)
    for node in nodes:  # neighbouring texts are one
        runs = groupby(node.children, key=lambda c: isinstance(c, str))
        node.children = [c for is_text, run in runs for c in (["".join(run)] if is_text else run)]
    return root


def shown(node: Node, visible: bool) -> bool | None:
    """Whether the element's own text shows; None: nothing in it is drawn."""
    a = node.attributes
    style = a.get("style", "").lower().replace(" ", "")
    if node.tag in NOT_DRAWN or "hidden" in a or "display:none" in style:
        return None
    if node.tag == "input":
        return None
    if "visibility:hidden" in style or "visibility:collapse" in style:
        return False
    return True if "visibility:visible" in style else visible


class Page:
    """Lines under construction: collapsed inline text, pending line ends, and the indent of lists and quotes."""

    def __init__(self):
        self.parts: list[str] = []
        self.newlines, self.space, self.started = 0, False, False
        self.prefix, self.marker = "", ""

    def end_line(self, newlines: int) -> None:
        self.space = False
        if self.started:
            self.newlines = max(self.newlines, newlines)

    def add_break(self) -> None:
        self.space = False
        self.newlines += 1

    def write(self, text: str) -> None:
        if self.newlines or not self.started:
            self.parts.append("\n" * self.newlines * self.started + self.prefix + self.marker)
            if self.marker:
                self.prefix, self.marker = self.prefix + " " * len(self.marker), ""
        elif self.space:
            self.parts.append(" ")
        self.started, self.newlines, self.space = True, 0, False
        self.parts.append(text)

    def inline(self, text: str) -> None:
        words = [w for w in SPACE.split(text) if w]
        if not words:
            self.space = self.space or (bool(text) and not self.newlines)
            return
        self.space = self.space or text[0] in " \t\n\f\r"
        self.write(" ".join(words))
        self.space = text[-1] in " \t\n\f\r"

    def preformatted(self, text: str) -> None:
        for k, line in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                self.add_break()
            if line:
                self.write(line)

    def text(self) -> str:
        return "".join(self.parts)


def aligned(rows: list[list[tuple[str, int]]]) -> list[str]:
    """Table rows as lines: cells (text, columns spanned) padded to the width of their column."""
    widths: dict[int, int] = {}
    for row in rows:
        at = 0
        for text, span in row:
            if span == 1:
                widths[at] = max(widths.get(at, 0), len(text))
            at += span
    lines = []
    for row in rows:
        at, line = 0, []
        for text, span in row:
            line.append(text.ljust(sum(widths.get(at + j, 0) for j in range(span)) + 3 * (span - 1)))
            at += span
        lines.append(" | ".join(line).rstrip())
    return lines


def number(text: str, default: int, least: int = -(10**6), most: int = 10**6) -> int:
    try:
        return min(most, max(least, int(text)))
    except ValueError:
        return default


def render(root: Node) -> str:
    pages = [Page()]
    lists: list[list] = []  # [next number or None, prefix to restore]
    tables: list[list[list[tuple[str, int]]]] = []
    preformatted = 0
    stack: list[tuple] = [(root, True, False)]
    while stack:
        node, visible, leaving = stack.pop()
        page = pages[-1]
        if isinstance(node, str):
            if visible:
                (page.preformatted if preformatted else page.inline)(node)
            continue
        tag = node.tag
        if leaving:
            if tag == "pre":
                preformatted -= 1
            if tag in ("ul", "ol", "menu"):
                page.prefix, page.marker = lists.pop()[1], ""
            elif tag == "blockquote":
                page.prefix = page.prefix[:-2]
            elif tag == "li" and visible is not None and lists:
                page.prefix, page.marker = lists[-1][1], ""
            elif tag in ("td", "th", "caption") and tables and len(pages) > 1 and tag != "caption":
                cell = " ".join(pages.pop().text().split())
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append((cell, number(node.attributes.get("colspan", "1"), 1, 1, 1000)))
                continue
            elif tag == "table":
                for line in aligned([r for r in tables.pop() if any(t for t, _ in r)]):
                    page.end_line(1)
                    if line:
                        page.write(line)
            if tag in BLOCK:
                page.end_line(2 if tag in SPACED and not (tag in ("ul", "ol", "menu") and lists) else 1)
            continue
        own = shown(node, visible)
        if own is None:
            continue
        if tag == "br":
            page.add_break()
            continue
        if tag in ("td", "th") and not tables:
            page.end_line(1)
        elif tag in BLOCK and not (tag in ("tr", "thead", "tbody", "tfoot") and tables):
            page.end_line(2 if tag in SPACED and not (tag in ("ul", "ol", "menu") and lists) else 1)
        if tag == "hr":
            page.write("---")
            page.end_line(2)
            continue
        if tag == "pre":
            preformatted += 1
        if tag in ("ul", "ol", "menu"):
            lists.append([number(node.attributes.get("start", "1"), 1) if tag == "ol" else None, page.prefix])
        elif tag == "li":
            base = lists[-1] if lists else [None, page.prefix]
            page.prefix = base[1]
            if base[0] is None:
                page.marker = "- "
            else:
                base[0] = number(node.attributes.get("value", ""), base[0])
                page.marker = f"{base[0]}. "
                base[0] += 1
        elif tag == "blockquote":
            page.prefix += "> "
        elif tag == "table":
            tables.append([])
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in ("td", "th") and tables:
            pages.append(Page())
        if tag not in VOID:
            stack.append((node, own, True))
            stack.extend((child, own, False) for child in reversed(node.children))
    return pages[0].text()


def visible_text(html: str | None) -> str:
    return render(build_tree(html)) if html else ""


@F.pandas_udf(T.StringType())
def visible_texts(pages: pd.Series) -> pd.Series:
    return pd.Series([visible_text(p) for p in pages], dtype="object")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text of every page; one map over the pages, nothing is shuffled."""
    ship(pages.sparkSession)
    return pages.select("page_id", visible_texts("html").alias("text"))

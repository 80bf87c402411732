"""A small DOM for main-text extraction: lenient parsing, block nodes, node features."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Subtrees without readable text of the page.
SILENT = set("head script style noscript template title iframe object svg canvas select option textarea button input".split())
BLOCK = set(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot "
    "tr td th caption nav header footer aside form fieldset figure figcaption address details summary hr dialog".split()
)
# An opening tag ends an open one of these, up to the scope's border.
CLOSES = {t: {"p"} for t in BLOCK - {"html", "body", "td", "th", "tr", "caption", "thead", "tbody", "tfoot"}} | {
    "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "tr", "td", "th"},
    "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"},
    "tbody": {"p", "tr", "td", "th", "thead", "tbody"}, "tfoot": {"p", "tr", "td", "th", "thead", "tbody"},
}
# What may stand in a head; anything else ends one that is open.
IN_HEAD = set("head html base basefont bgsound link meta title noscript noframes style script template".split())
BORDER = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "tbody": {"table"}, "tfoot": {"table"}}
SCOPE = {"table", "td", "th", "caption", "button", "html", "body"}

# Groups of attribute words, by what they commonly name.
GROUPS = {
    "main": "article content main post entry story body text copy prose blog news".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs tabs toolbar pagination pager skip links toc".split(),
    "head": "header masthead banner top logo brand topbar".split(),
    "foot": "footer foot bottom copyright legal colophon".split(),
    "side": "sidebar side aside widget widgets rail related recommended trending popular secondary complementary".split(),
    "note": "notice cookie cookies consent gdpr alert popup modal overlay message privacy warning toast dialog".split(),
    "advert": "ad ads adv advert advertisement sponsor sponsored promo promotion banner adsense".split(),
    "form": "form search login signup subscribe newsletter register contact".split(),
    "talk": "comment comments reply replies discussion respond disqus reader responses thread feedback".split(),
    "share": "share social follow like tags meta byline author date tools print".split(),
}
_GROUP_OF: dict[str, list[int]] = {}
for _k, _words in enumerate(GROUPS.values()):
    for _w in _words:
        _GROUP_OF.setdefault(_w, []).append(_k)
_TAGS = [
    "article", "main", "section", "div", "p", "heading", "li", "list", "nav", "header", "footer", "aside", "form",
    "table", "quote", "body", "other",
]
_TAG_OF = {t: t for t in _TAGS} | {f"h{k}": "heading" for k in range(1, 7)} | {
    "ul": "list", "ol": "list", "dl": "list", "dt": "li", "dd": "li", "blockquote": "quote", "pre": "quote",
    "tr": "table", "td": "table", "th": "table", "fieldset": "form", "html": "body",
}
_TAG_AT = {t: k for k, t in enumerate(_TAGS)}
_MARKS = ["article", "main", "nav", "header", "footer", "aside", "form"]
N_FEATURES = len(_TAGS) + 2 * len(GROUPS) + len(_MARKS) + 14


class Node:
    __slots__ = ("tag", "parent", "items", "groups", "hidden", "depth", "number", "length", "linked", "tags", "stops",
                 "paragraphs", "before", "index", "siblings", "value")

    def __init__(self, tag: str, attrs: list, parent: "Node | None"):
        self.tag, self.parent, self.items = tag, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.groups: set[int] = set()
        self.hidden = tag in SILENT
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                for w in re.split(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
                    self.groups.update(_GROUP_OF.get(w, ()))
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                self.hidden = True
            elif name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                self.hidden = True


class _Parser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.top = Node("body", [], None)

    def _leave_head(self, deep: bool) -> None:
        """The head's end tag may be left out; ``deep``: also from an element open in it."""
        at = self.top
        while deep and at.parent is not None and at.tag not in ("head", "template"):
            at = at.parent
        if at.tag == "head":
            self.top = at.parent

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD:
            self._leave_head(tag == "body")
        ends = CLOSES.get(tag)
        if ends:
            border = BORDER.get(tag, SCOPE)
            at = self.top
            while at.parent is not None and at.tag not in border:
                if at.tag in ends:
                    self.top = at.parent
                at = at.parent
        node = Node(tag, attrs, self.top)
        self.top.items.append(node)
        if tag not in VOID:
            self.top = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.top.tag == tag:
            self.top = self.top.parent

    def handle_endtag(self, tag):
        at = self.top
        while at.parent is not None and at.tag != tag:
            if tag not in BLOCK and at.tag in BLOCK:
                return  # an inline end does not leave its block
            at = at.parent
        if at.parent is not None:
            self.top = at.parent

    def handle_data(self, data):
        if self.top.tag == "head" and data.strip():
            self._leave_head(False)
        self.top.items.append(data)


class Page:
    """Parsed page: block nodes in order and the texts between their borders."""

    def __init__(self, html: str):
        parser = _Parser()
        parser.feed(html)
        parser.close()
        self.nodes: list[Node] = []
        self.blocks: list[tuple[int, str]] = []  # (number of the owning block node, text)
        self._walk(parser.root)

    def _walk(self, root: Node) -> None:
        """Iterative, so that deeply nested pages do no harm."""
        text: list[str] = []
        linked = 0
        total = 0
        owner: list[Node] = []

        def flush() -> None:
            if text:
                joined = " ".join("".join(text).split())
                text.clear()
                if joined:
                    self.blocks.append((owner[-1].number, joined))

        def enter(node: Node) -> None:
            node.number = len(self.nodes)
            node.parent = owner[-1] if owner else None
            node.length = node.linked = node.tags = node.stops = node.paragraphs = 0
            node.before, node.index, node.siblings = total, 0, 0
            self.nodes.append(node)
            owner.append(node)

        enter(root)
        stack = [(root, iter(root.items), False)]
        while stack:
            node, items, link = stack[-1]
            item = next(items, None)
            if item is None:
                stack.pop()
                if owner[-1] is node:
                    flush()
                    owner.pop()
                    if owner:
                        up = owner[-1]
                        up.siblings += 1
                        node.index = up.siblings
                        for name in ("length", "linked", "tags", "stops", "paragraphs"):
                            setattr(up, name, getattr(up, name) + getattr(node, name))
                        up.tags += 1
                        up.paragraphs += node.tag == "p"
                continue
            own = owner[-1]
            if isinstance(item, str):
                text.append(item)
                n = len(item)
                total += n
                own.length += n
                own.stops += item.count(".") + item.count(",")
                if link:
                    own.linked += n
            elif item.tag == "br":
                text.append(" ")
            elif not item.hidden:
                if item.tag in BLOCK:
                    flush()
                    enter(item)
                else:
                    own.tags += 1
                stack.append((item, iter(item.items), link or item.tag == "a"))
        flush()
        self.total = max(1, total)

    def features(self) -> np.ndarray:
        x = np.zeros((len(self.nodes), N_FEATURES), np.float32)
        g0 = len(_TAGS)
        a0 = g0 + len(GROUPS)
        m0 = a0 + len(GROUPS)
        s0 = m0 + len(_MARKS)
        for k, node in enumerate(self.nodes):
            row = x[k]
            up = node.parent
            if up is not None:
                row[a0:s0] = x[up.number, a0:s0]
                row[a0 : a0 + len(GROUPS)] = np.maximum(row[a0 : a0 + len(GROUPS)], x[up.number, g0:a0])
            row[_TAG_AT[_TAG_OF.get(node.tag, "other")]] = 1
            for g in node.groups:
                row[g0 + g] = 1
            if node.tag in _MARKS:
                row[m0 + _MARKS.index(node.tag)] = 1
            n, whole = node.length, up or node
            row[s0:] = (
                node.depth, np.log1p(n), node.linked / (n + 1), node.stops * 20 / (n + 20), np.log1p(node.paragraphs),
                np.log1p(n / (node.tags + 1)), n / self.total, node.before / self.total, n / (whole.length + 1),
                node.index, whole.siblings, node.index / (whole.siblings + 1), whole.paragraphs, whole.linked / (whole.length + 1),
            )
        return x

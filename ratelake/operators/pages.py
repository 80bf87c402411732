"""Text, headings, tables and links of an HTML corpus.

A small tolerant parser runs once per page inside the tasks and emits one row
per page with nested arrays. Everything after it (filters, limits, outline text)
is native array work on that row, so no page job shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import fixed
from ratelake.functions.text import collapse_whitespace, truncate

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DROPPED = {"script", "style", "noscript", "svg", "head", "meta", "link", "title"}
HEADINGS = ("h1", "h2", "h3", "h4")
# Start tags that end an open element of the given kinds.
BLOCKS = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"},
    "body": {"head"}, **{b: {"p"} for b in BLOCKS},
}
# An implied end never reaches beyond these.
SCOPE = {"table", "ul", "ol", "dl", "html", "body", "td", "th", "caption", "button"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list = []

    def walk(self, skip=None) -> Iterator:
        """Nodes and texts below, in document order."""
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, Node):
                if skip and skip(item):
                    continue
                yield item
                stack.extend(reversed(item.children))
            else:
                yield item

    def text(self, skip=None) -> str:
        return "".join(x for x in self.walk(skip) if isinstance(x, str))

    def find(self, *tags: str) -> list["Node"]:
        return [x for x in self.walk() if isinstance(x, Node) and x.tag in tags]


class TreeParser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.top = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        ends = ENDS.get(tag, ())
        at = self.top
        while at.parent is not None:
            if at.tag in ends:
                self.top = at.parent
            elif at.tag in SCOPE:
                break
            at = at.parent
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.top)
        self.top.children.append(node)
        if tag not in VOID:
            self.top = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag == "svg":
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = self.top
        while at.parent is not None and at.tag != tag:
            at = at.parent
        if at.parent is not None:
            self.top = at.parent

    def handle_data(self, data):
        self.top.children.append(data)


def _hidden(node: Node) -> bool:
    style = node.attrs.get("style", "")
    return (
        node.tag in DROPPED
        or node.attrs.get("aria-hidden") == "true"
        or "hidden" in node.attrs
        or any(s in style for s in ("display:none", "display: none", "visibility:hidden", "visibility: hidden"))
    )


def _cells(row: Node) -> list[str]:
    return [c.text() for c in row.find("th", "td")]


class _Siblings:
    """Element siblings of each parent with the last heading before them, found once."""

    def __init__(self):
        self.known: dict[int, tuple[list[Node], dict[int, int], list[Node | None]]] = {}

    def of(self, node: Node) -> tuple[Node | None, Node | None, Node | None]:
        """Previous and next element of ``node`` and the nearest heading before it."""
        parent = node.parent
        if id(parent) not in self.known:
            nodes = [n for n in parent.children if isinstance(n, Node)]
            last, seen = None, []
            for n in nodes:
                seen.append(last)
                last = n if n.tag in HEADINGS else last
            self.known[id(parent)] = nodes, {id(n): i for i, n in enumerate(nodes)}, seen
        nodes, places, seen = self.known[id(parent)]
        at = places[id(node)]
        return nodes[at - 1] if at else None, nodes[at + 1] if at + 1 < len(nodes) else None, seen[at]


def _table(table: Node, siblings: _Siblings) -> dict:
    before, after, heading = siblings.of(table)
    rows = table.find("tr")
    heads = [r for t in table.find("thead") for r in t.find("tr")]
    head_cells = _cells(heads[0]) if heads else []
    if not head_cells and rows:
        head_cells = _cells(rows[0])
    skip_first = bool(rows) and bool(rows[0].find("th") or table.find("thead"))
    return {
        "near_heading": heading.text() if heading else "",
        "headers": head_cells,
        "rows": [_cells(r) for r in (rows[1:] if skip_first else rows)],
        "before_text": before.text() if before else "",
        "after_text": after.text() if after else "",
    }


def _tables(root: Node) -> list[dict]:
    siblings = _Siblings()
    return [_table(t, siblings) for t in root.find("table")]


def _title(root: Node) -> str:
    titles = root.find("title")
    return titles[0].text() if titles else ""


def _links(root: Node) -> tuple[list[dict], list[Node]]:
    """Links with the number of their parent, and the parents in order."""
    number: dict[int, int] = {}
    parents: list[Node] = []
    links = []
    for a in root.find("a"):
        if id(a.parent) not in number:
            number[id(a.parent)] = len(parents)
            parents.append(a.parent)
        links.append({"href": a.attrs.get("href", ""), "text": a.text(), "parent": number[id(a.parent)]})
    return links, parents


# How each part is built from the tree.
BUILD = {
    "title": _title,
    "text": lambda root: root.text(_hidden),
    "headings": lambda root: [{"level": h.tag.upper(), "text": h.text()} for h in root.find(*HEADINGS)],
    "tables": _tables,
    "links": lambda root: _links(root)[0],
    "parents": lambda root: [p.text() for p in _links(root)[1]],
}


def parse_page(html: str, parts: tuple[str, ...] = tuple(BUILD)) -> dict:
    """The wanted raw parts of one page; clean-up and limits are applied by Spark.

    A link names its parent by number; the text around all links of one parent is
    held once, in ``parents``.
    """
    parser = TreeParser()
    parser.feed(html or "")
    parser.close()
    return {part: BUILD[part](parser.root) for part in parts}


PAGES_AT_ONCE = 128  # parsed trees held in memory by one Python worker
_TEXT = pa.string()
PARTS = {
    "title": ("string", _TEXT),
    "text": ("string", _TEXT),
    "headings": (
        "array<struct<level:string,text:string>>",
        pa.list_(pa.struct([("level", _TEXT), ("text", _TEXT)])),
    ),
    "tables": (
        "array<struct<near_heading:string,headers:array<string>,rows:array<array<string>>,"
        "before_text:string,after_text:string>>",
        pa.list_(pa.struct([
            ("near_heading", _TEXT), ("headers", pa.list_(_TEXT)), ("rows", pa.list_(pa.list_(_TEXT))),
            ("before_text", _TEXT), ("after_text", _TEXT),
        ])),
    ),
    "links": (
        "array<struct<href:string,text:string,parent:int>>",
        pa.list_(pa.struct([("href", _TEXT), ("text", _TEXT), ("parent", pa.int32())])),
    ),
    "parents": ("array<string>", pa.list_(_TEXT)),
}


def parse_pages(
    pages: DataFrame, keep: tuple[str, ...] = ("page_id",), parts: tuple[str, ...] = tuple(PARTS)
) -> DataFrame:
    """One row per page with the wanted raw parts next to the ``keep`` columns.

    Reads only those columns and ``html``.
    """

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, PAGES_AT_ONCE):
                batch = whole.slice(start, PAGES_AT_ONCE)
                parsed = [parse_page(h, parts) for h in batch.column("html").to_pylist()]
                columns = {p: pa.array([row[p] for row in parsed], PARTS[p][1]) for p in parts}
                kept = {c: batch.column(c) for c in keep}
                yield pa.RecordBatch.from_pydict({**kept, **columns})

    kept = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join(kept + [f"{p} {PARTS[p][0]}" for p in parts])
    return pages.select(*keep, "html").mapInArrow(run, schema)


def _field(text: Column, limit: int | None = None) -> Column:
    clean = collapse_whitespace(text)
    return clean if limit is None else truncate(clean, limit)


def _first(items: Column, limit: int | None) -> Column:
    return items if limit is None else F.slice(items, F.lit(1), F.lit(limit))


def visible_text(raw: Column) -> Column:
    return collapse_whitespace(raw)


def title(raw: Column, chars: int | None = None) -> Column:
    return _field(raw, chars)


def headings(raw: Column, limit: int | None = None, chars: int | None = None) -> Column:
    """Headings with text; a limit counts empty ones, which are then dropped."""
    cleaned = F.transform(
        _first(raw, limit), lambda h: F.struct(h["level"].alias("level"), _field(h["text"], chars).alias("text"))
    )
    return F.filter(cleaned, lambda h: F.length(h["text"]) > 0)


def _cells_line(cells: Column, chars: int | None) -> Column:
    texts = F.filter(F.transform(cells, lambda t: _field(t, chars)), lambda t: F.length(t) > 0)
    return F.array_join(texts, " | ")


def tables(
    raw: Column, limit: int | None = None, rows: int | None = None, chars: int | None = None, near_chars: int | None = None
) -> Column:
    """Tables with their lines and the text next to them; all of them unless limited."""

    def one(t: Column) -> Column:
        before = collapse_whitespace(t["before_text"])
        near = F.when(before == "", collapse_whitespace(t["after_text"])).otherwise(before)
        lines = F.transform(_first(t["rows"], rows), lambda r: _cells_line(r, chars))
        return F.struct(
            _field(t["near_heading"], chars).alias("near_heading"),
            _cells_line(t["headers"], chars).alias("headers"),
            F.filter(lines, lambda r: F.length(r) > 0).alias("rows"),
            _field(near, near_chars).alias("near_text"),
        )

    return F.transform(_first(raw, limit), one)


def link_filter(text: Column, href: Column, words: list[str] = tuple(fixed.LINK_WORDS)) -> Column:
    """PDF link (query and fragment cut off) or a link text with one of the words."""
    base = F.get(F.split(F.lower(href), "[?#]"), F.lit(0))
    keep = F.endswith(base, F.lit(".pdf"))
    lowered = F.lower(text)
    for word in words:
        keep = keep | F.contains(lowered, F.lit(word))
    return keep


def _without_first(text: Column, part: Column) -> Column:
    at = F.position(part, text)
    cut = F.concat(
        F.left(text, at - 1), F.substring(text, at + F.length(part), F.length(text))
    )
    return F.when((part != "") & (at > 0), cut).otherwise(text)


def links(
    raw: Column, parents: Column, words: list[str] = tuple(fixed.LINK_WORDS), limit: int | None = None,
    chars: int | None = None, near_chars: int | None = None,
) -> Column:
    """Filtered links with their surrounding text; a limit applies after the filter,
    and surrounding texts are looked up for the links that are left."""

    def one(a: Column) -> Column:
        href, text = F.trim(a["href"]), _field(a["text"], chars)
        return F.struct(
            (href if chars is None else truncate(href, chars)).alias("href"),
            text.alias("text"), a["parent"].alias("parent"), (F.length(href) > 0).alias("_has"),
            link_filter(text, href, words).alias("_keep"),
        )

    def near(a: Column) -> Column:
        around = collapse_whitespace(_without_first(collapse_whitespace(F.get(parents, a["parent"])), a["text"]))
        around = F.when(around == "", a["text"]).otherwise(around)
        return F.struct(a["href"].alias("href"), a["text"].alias("text"), _field(around, near_chars).alias("near_text"))

    kept = F.filter(F.transform(raw, one), lambda a: a["_has"] & a["_keep"])
    return F.transform(_first(kept, limit), near)


def outline(title_: Column, headings_: Column, tables_: Column, links_: Column) -> Column:
    """Outline document of one page."""

    def table_lines(t: Column, i: Column) -> Column:
        return F.concat(
            F.array(
                F.concat(F.lit("- TABLE "), (i + 1).cast("string")),
                F.concat(F.lit("  NEAR_HEADING: "), t["near_heading"]),
                F.concat(F.lit("  HEADERS: "), t["headers"]),
                F.lit("  ROWS_SAMPLE:"),
            ),
            F.transform(t["rows"], lambda r: F.concat(F.lit("    - "), r)),
            F.array(F.concat(F.lit("  TEXT_NEAR_TABLE_SAMPLE: "), t["near_text"])),
        )

    def link_lines(a: Column) -> Column:
        return F.array(
            F.concat(F.lit("- TEXT: "), a["text"]),
            F.concat(F.lit("  HREF: "), a["href"]),
            F.concat(F.lit("  NEAR_TEXT: "), a["near_text"]),
        )

    lines = F.concat(
        F.array(F.concat(F.lit("PAGE_TITLE: "), title_), F.lit("HEADINGS:")),
        F.transform(
            headings_, lambda h: F.concat(F.lit("- "), h["level"], F.lit(": "), h["text"])
        ),
        F.array(F.lit("TABLES:")),
        F.flatten(F.transform(tables_, table_lines)),
        F.array(F.lit("LINKS:")),
        F.flatten(F.transform(links_, link_lines)),
    )
    return F.array_join(lines, "\n")


def page_outline(pages: DataFrame, key: str = "page_id", words: list[str] = tuple(fixed.LINK_WORDS)) -> DataFrame:
    """Outline and visible text of every page in one pass; the outline has fixed limits."""
    chars = fixed.FIELD_MAX
    parsed = parse_pages(pages, (key,))
    # Named step by step: each array is computed once.
    found = links(F.col("links"), F.col("parents"), words, fixed.MAX_LINKS, chars, fixed.LINK_TEXT_MAX)
    shown = tables(F.col("tables"), fixed.MAX_TABLES, fixed.MAX_SAMPLE_ROWS, chars, fixed.TABLE_TEXT_MAX)
    return (
        parsed.withColumn("_links", found)
        .withColumn("_tables", shown)
        .select(
            key,
            outline(
                title(F.col("title"), chars), headings(F.col("headings"), fixed.MAX_HEADINGS, chars),
                F.col("_tables"), F.col("_links"),
            ).alias("outline"),
            visible_text(F.col("text")).alias("visible_text"),
        )
    )

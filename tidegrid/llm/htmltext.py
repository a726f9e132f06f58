"""Visible text of web pages, laid out as a browser would.

A tree is built from the tags, with the end tags that HTML leaves out; rules on elements and attributes
decide what is visible; rendering keeps blocks apart, marks and indents list items, and aligns table
cells in columns. Nothing visible is judged or dropped. Trees are walked with explicit stacks, so the
depth of a page does not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head script style template noscript iframe object video audio canvas datalist rp title meta link".split())
SPACED = set("p ul ol menu dl table blockquote pre h1 h2 h3 h4 h5 h6 figure fieldset hr".split())
BLOCK = SPACED | set(
    "html body address article aside details dialog dd div dt figcaption footer form header hgroup legend li main nav "
    "option optgroup search section summary caption thead tbody tfoot tr center dir select textarea".split())
ENDS_PARAGRAPH = SPACED | set(
    "address article aside center details dialog dir div dd dt figcaption footer form header hgroup li main menu nav search "
    "section summary".split())
TABLE_PART = {"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}
# A start tag ends the open elements of the second set, unless one of the third stands in between.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}), "dt": ({"dt", "dd"}, {"dl", "table"}), "dd": ({"dt", "dd"}, {"dl", "table"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"optgroup"}, {"select"}), "body": ({"head"}, set()), "rt": ({"rt"}, {"ruby"}),
}
SCOPE = {"table", "td", "th", "caption", "template", "html"}
NO_DISPLAY, NO_VISIBILITY, VISIBILITY = (re.compile(rf"(?:^|;)\s*{p}\s*(?:!\s*important\s*)?(?:;|$)", re.I) for p in (
    r"display\s*:\s*none", r"visibility\s*:\s*(?:hidden|collapse)", r"visibility\s*:\s*visible"))
SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Builds a tree of ``Node`` and strings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]

    def _end(self, names: set[str], stop: set[str]) -> bool:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in names:
                del self.open[i:]
                return True
            if self.open[i].tag in stop:
                return False
        return False

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self._end({"p"}, SCOPE | {"button"})
        if tag in IMPLIED_ENDS:
            self._end(*IMPLIED_ENDS[tag])
        if self.open[-1].tag == "head" and tag not in HIDDEN | {"base", "basefont", "bgsound"}:
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash does not close an HTML element

    def handle_endtag(self, tag):
        if tag in ("br", "p") and not self._end({tag}, SCOPE | {"button"}):
            self.open[-1].children.append(Node(tag, {}))  # HTML reads a lone </p> or </br> as an element
        elif tag not in ("br", "p"):
            self._end({tag}, {"table"} if tag in TABLE_PART else set() if tag == "table" else SCOPE - {tag})

    def parse_marked_section(self, i, report=1):
        """``<![`` begins a comment that ends with the next ``>``, as everywhere outside of embedded XML."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)


def hidden(node: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attrs or (node.tag == "dialog" and "open" not in node.attrs):
        return True
    return bool(NO_DISPLAY.search(node.attrs.get("style", "")))


class Layout:
    """Collects lines; white space collapses, blocks begin lines, some keep a blank line around them."""

    def __init__(self):
        self.lines, self.text, self.space, self.gap, self.indent, self.marker = [], [], False, False, "", ""

    def words(self, data: str) -> None:
        for i, part in enumerate(SPACE.split(data)):
            if i:
                self.space = True
            if part:
                if self.space and self.text:
                    self.text.append(" ")
                self.text.append(part)
                self.space = False

    def raw(self, data: str) -> None:
        for i, part in enumerate(data.replace("\r\n", "\n").split("\n")):
            if i:
                self.line(True)
            if part:
                self.text.append(part)

    def line(self, keep_empty: bool = False) -> None:
        if self.text or keep_empty:
            if self.gap and self.lines:
                self.lines.append("")
            lead = self.indent[: len(self.indent) - len(self.marker)] + self.marker if self.marker else self.indent
            self.lines.append((lead + "".join(self.text)).rstrip())
            self.gap, self.marker = False, ""
        self.text, self.space = [], False

    def block(self, spaced: bool) -> None:
        self.line()
        self.gap = self.gap or spaced

    def put(self, lines: list[str]) -> None:
        """Whole lines that are laid out already."""
        for line in lines:
            self.text = [line] if line else []
            self.line(True)


def _marker(node: Node, parents: list[Node], counts: dict) -> str:
    """The bullet or number of a list item."""
    for i in range(len(parents) - 1, -1, -1):
        if parents[i].tag in ("ul", "menu", "dir"):
            break
        if parents[i].tag == "ol":
            key, start = id(parents[i]), parents[i].attrs.get("start", "")
            number = counts.get(key, int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0) + 1
            if re.fullmatch(r"-?\d{1,9}", value := node.attrs.get("value", "")):
                number = int(value)
            counts[key] = number
            return f"{number}. "
    return "- "


def _spaced(node: Node, parents: list[Node]) -> bool:
    """Whether blank lines stand around a block; a list inside of an item has none."""
    return node.tag in SPACED and not (node.tag in ("ul", "ol", "menu", "dir") and any(p.tag == "li" for p in parents))


def render(top: Node, nested: bool = False, visible: bool = True) -> list[str]:
    """Lines of a node's content. In a cell (``nested``) a table inside is read as plain blocks."""
    out, counts, parents, pre = Layout(), {}, [top], 0
    stack: list = [(child, visible) for child in reversed(top.children)]
    while stack:
        item, shown = stack.pop()
        if isinstance(item, str):
            if shown:
                out.raw(item) if pre else out.words(item)
            continue
        if isinstance(item, tuple):  # the end of an element
            node, indent = item
            parents.pop()
            if node.tag in ("pre", "textarea"):
                pre -= 1
            if node.tag in BLOCK:
                out.block(_spaced(node, parents))
            elif node.tag in ("td", "th"):
                out.space = True
            out.indent = indent
            continue
        node = item
        if hidden(node):
            continue
        style = node.attrs.get("style", "")
        shown = False if NO_VISIBILITY.search(style) else True if VISIBILITY.search(style) else shown
        if node.tag == "br":
            out.line(True)
            continue
        if node.tag in BLOCK:
            out.block(_spaced(node, parents))
        if node.tag == "table" and not nested:
            out.put(table_lines(node, shown))
            out.block(True)
            continue
        stack.append(((node, out.indent), shown))
        if node.tag == "li":
            out.marker = _marker(node, parents, counts)
            out.indent += " " * len(out.marker)
        elif node.tag in ("blockquote", "dd"):
            out.indent += "  "
        elif node.tag in ("pre", "textarea"):
            pre += 1
        parents.append(node)
        children = node.children
        if node.tag == "details" and "open" not in node.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        if node.tag == "pre" and children and isinstance(children[0], str):
            children = [children[0].removeprefix("\n"), *children[1:]]
        stack.extend((child, shown) for child in reversed(children))
    out.line()
    return out.lines


def table_lines(table: Node, shown: bool) -> list[str]:
    """A table's caption, then its rows with every column as wide as its widest cell; text outside of cells comes first."""
    loose, rows, stack = Node("#loose", {}), [], [(c, shown) for c in reversed(table.children)]
    captions: list[str] = []
    while stack:
        item, seen = stack.pop()
        if isinstance(item, str):
            if seen and item.strip():
                loose.children.append(item)
            continue
        if hidden(item):
            continue
        style = item.attrs.get("style", "")
        seen = False if NO_VISIBILITY.search(style) else True if VISIBILITY.search(style) else seen
        if item.tag == "caption":
            captions += render(item, True, seen)
        elif item.tag in ("td", "th"):
            span = item.attrs.get("colspan", "")
            if not rows:
                rows.append([])
            rows[-1].append((render(item, True, seen), max(1, min(int(span), 1000)) if re.fullmatch(r"\d{1,9}", span) else 1))
        elif item.tag in ("thead", "tbody", "tfoot", "tr"):
            if item.tag == "tr":
                rows.append([])
            stack.extend((c, seen) for c in reversed(item.children))
        elif item.tag not in ("col", "colgroup"):
            loose.children.append(item)
    widths: list[int] = []
    for row in rows:
        column = 0
        for lines, span in row:
            widths += [0] * (column + 1 - len(widths))
            if span == 1:
                widths[column] = max(widths[column], *map(len, lines), 0)
            column += span
    out = render(loose, True, shown) + captions
    for row in rows:
        for i in range(max((len(lines) for lines, _ in row), default=0)):
            line, column = "", 0
            for lines, span in row:
                width = sum(widths[column : column + span]) + 2 * (span - 1)
                line += (lines[i] if i < len(lines) else "").ljust(width) + "  "
                column += span
            out.append(line.rstrip())
    return out


def page_text(html: str | None) -> str:
    """The visible text of one page."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    lines = render(builder.root)
    while lines and not lines[-1]:
        lines.pop()
    return "\n".join(lines)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text) of every row of ``pages`` (page_id, html).

    A null or empty page has empty text; text without tags is itself with white space collapsed. Broken
    markup is read as far as HTML says how. Ids may be null or repeat; an empty table gives no rows.
    Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [page_text(html) for html in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["page_id", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(run, "page_id long, text string")

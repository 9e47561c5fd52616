"""HTML extraction (operator 7): the visible text of a page, laid out by lines.

A small tree builder puts in the end tags that authors leave out; a walk over the tree emits the text
of what a reader would see: blocks on lines of their own with blank lines around paragraphs, list
items with their marks, table cells in aligned columns, preformatted text as it is.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.arrowtext import steps

# Element classes of the HTML standard.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes"}
PLAIN = {"title", "textarea"}
HIDDEN = set("head script style template title meta link base datalist iframe noembed noframes "
             "object audio video canvas svg map param rp".split())
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure form fieldset hr "
                 "menu".split())
BLOCKS = PARAGRAPHS | set(
    "html body div section article aside header footer nav main address details summary dialog li "
    "dt dd tr caption thead tbody tfoot center figcaption legend option optgroup search "
    "hgroup textarea".split())
CLOSES_P = BLOCKS - {"html", "body", "li", "dt", "dd", "tr", "thead", "tbody", "tfoot", "caption",
                     "option", "optgroup", "legend", "textarea"} | {"li", "dt", "dd"}
#: A start tag ends the open elements of these names, looked for up to the bounds.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"optgroup", "option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: Content that ends an open head.
IN_HEAD = HIDDEN | {"html", "head", "noscript"}
#: Tables nested deeper than this are laid out as blocks.
MOST_NESTED = 40
#: Characters of a column beyond which a cell's text goes on in another line, and of a whole table
#: beyond which its cells are not aligned. Both keep a page's text in proportion to the page.
COLUMN_WIDTH, TABLE_WIDTH = 80, 400
#: The most columns and rows that a cell can span.
MOST_COLUMNS, MOST_ROWS = 1000, 65_534

# a quote opens a value only right after the equals sign; elsewhere it is a letter like others
_VALUE = (r"[ \t\n\r\f]*+=[ \t\n\r\f]*+"
          r"(?:\"{0}[^\"]*+{1}(?:\"|\Z)|'{0}[^']*+{1}(?:'|\Z)|{0}[^ \t\n\r\f>\"'][^ \t\n\r\f>]*+{1}|(?=>)|\Z)")
_NAME = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    rf"((?:[ \t\n\r\f/]++|{_NAME}(?:{_VALUE.format('', '')})?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:{_VALUE.format('(', ')')})?+")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_READ = re.compile(r"style|hidden|open|start|span", re.I)
_START = re.compile(r"\s*(-?\d{1,9})")
_SPAN = re.compile(r"\s*\+?(\d{1,9})")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []

    def values(self) -> dict[str, str]:
        """The attributes by name, the first of equals; none if none is one that is read."""
        found: dict[str, str] = {}
        if _READ.search(self.attrs):
            for name, *values in _ATTRIBUTE.findall(self.attrs):
                found.setdefault(name.lower(), "".join(values))
        return found

    def flag(self, name: str) -> bool:
        return name in self.values()

    def shown(self) -> bool:
        if self.tag in HIDDEN:
            return False
        if not self.attrs:
            return self.tag != "dialog"
        values = self.values()
        if _NOT_SHOWN.search(html.unescape(values.get("style", ""))):
            return False
        if self.tag == "input" or (self.tag == "dialog" and "open" not in values):
            return False
        return "hidden" not in values


class Builder:
    """The tree of a page; end tags that are left out are put in."""

    def __init__(self):
        self.root = Node("#page")
        self.path = [self.root]
        self.open = Counter()

    def pop_to(self, place: int) -> None:
        while len(self.path) > place:
            self.open[self.path.pop().tag] -= 1

    def end_nearest(self, names: set, bounds: set) -> None:
        """End the outermost element of ``names`` above the nearest of ``bounds``."""
        if not any(self.open[n] for n in names):
            return
        found = 0
        for place in range(len(self.path) - 1, 0, -1):
            tag = self.path[place].tag
            if tag in bounds:
                break
            if tag in names:
                found = place
        if found:
            self.pop_to(found)

    def start(self, tag: str, attrs: str) -> Node:
        if self.open["head"] and tag not in IN_HEAD:
            self.end_nearest({"head"}, {"html"})
        if tag in ENDS:
            self.end_nearest(*ENDS[tag])
        if tag in CLOSES_P and self.open["p"]:
            self.end_nearest({"p"}, {"table", "button", "td", "th", "caption", "object"})
        node = Node(tag, attrs)
        self.path[-1].children.append(node)
        if tag not in VOID:
            self.path.append(node)
            self.open[tag] += 1
        return node

    def end(self, tag: str) -> None:
        if tag in ("br", "p") and not self.open[tag]:
            self.start(tag, "")
        if self.open[tag]:
            bounded = tag not in ("table", "html", "body", "div", "section", "article")
            for place in range(len(self.path) - 1, 0, -1):
                if self.path[place].tag == tag:
                    self.pop_to(place)
                    return
                if bounded and self.path[place].tag in ("td", "th", "table"):
                    if tag not in ("td", "th", "tr", "thead", "tbody", "tfoot"):
                        return

    def text(self, value: str) -> None:
        if value:
            if self.open["head"] and not value.isspace() and self.path[-1].tag in ("head", "html"):
                self.end_nearest({"head"}, {"html"})
            self.path[-1].children.append(html.unescape(value) if "&" in value else value)

    def feed(self, page: str) -> Node:
        at = 0
        while True:
            mark = _TAG.search(page, at)
            if mark is None:
                self.text(page[at:])
                return self.root
            self.text(page[at:mark.start()])
            at = mark.end()
            if not mark[2]:
                continue
            tag = mark[2].lower()
            if mark[1]:
                self.end(tag)
                continue
            node = self.start(tag, mark[3].strip())
            if tag in RAW or tag in PLAIN:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                inside = page[at:close.start() if close else len(page)]
                node.children.append(html.unescape(inside) if tag in PLAIN else inside)
                self.pop_to(len(self.path) - 1)
                at = len(page)
                if close:
                    shut = page.find(">", close.end())
                    at = shut + 1 if shut >= 0 else len(page)


class Page:
    """Lines of text; asked-for breaks are put in only between pieces of text."""

    def __init__(self):
        self.parts: list[str] = []
        self.breaks, self.space, self.mark, self.indent = 0, False, "", 0

    def block(self, breaks: int) -> None:
        self.breaks, self.space = max(self.breaks, breaks), False

    def put(self, value: str) -> None:
        if self.breaks and self.parts:
            self.parts.append("\n" * self.breaks)
        if self.breaks or not self.parts:
            self.parts.append(" " * max(0, self.indent - len(self.mark)) + self.mark)
            self.mark = ""
        elif self.space:
            self.parts.append(" ")
        self.breaks, self.space = 0, False
        self.parts.append(value)

    def flow(self, value: str) -> None:
        words = _SPACES.sub(" ", value)
        bare = words.strip(" ")
        if not bare:
            self.space = self.space or bool(words)
            return
        self.space = self.space or words[0] == " "
        self.put(bare)
        self.space = words[-1] == " "

    def lines(self, value: str) -> None:
        for number, line in enumerate(value.split("\n")):
            if number:
                if not self.breaks:
                    self.breaks = 1
                elif self.parts:
                    self.breaks += 1
            if line.strip():
                self.put(line.rstrip())

    def __str__(self) -> str:
        return "".join(self.parts)


def _cells(table: Node) -> tuple[list[list[Node]], list]:
    """Rows of cells of a table, and all its other visible content (captions, stray text)."""
    rows, others, todo = [], [], list(reversed(table.children))
    while todo:
        node = todo.pop()
        if isinstance(node, str) or not node.shown():
            if isinstance(node, str) and node.strip():
                others.append(node)
        elif node.tag == "tr":
            rows.append([c for c in node.children if isinstance(c, Node)
                         and c.tag in ("td", "th") and c.shown()])
            others += [c for c in node.children if not (
                isinstance(c, Node) and c.tag in ("td", "th") or isinstance(c, str) and c.isspace())]
        elif node.tag in ("thead", "tbody", "tfoot"):
            todo += reversed(node.children)
        elif node.tag in ("td", "th"):
            if not rows:
                rows.append([])
            rows[-1].append(node)
        else:
            others.append(node)
    return rows, others


def _span(cell: Node, name: str, most: int, endless: int) -> int:
    found = _SPAN.match(cell.values().get(name, ""))
    return 1 if not found else min(int(found[1]), most) or endless


def _joined(spans: list[list[int]]) -> list[list[int]]:
    """Neighbouring or overlapping spans that reach down to the same row as one, in order."""
    out: list[list[int]] = []
    for start, end, down in sorted(spans):
        if out and out[-1][2] == down and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end, down])
    return out


def _grid(rows: list[list[Node]]) -> list[list[tuple[int, int, Node]]]:
    """The cells of each row with their first column and the column behind their last.

    A cell takes the first column that no cell above reaches down to.
    """
    out: list[list[tuple[int, int, Node]]] = []
    held: list[list[int]] = []  # columns taken from above: first, behind the last, last row
    for number, row in enumerate(rows):
        if any(down < number for _, _, down in held):
            held = _joined([span for span in held if span[2] >= number])
        cells, column, at, more = [], 0, 0, []
        for cell in row:
            while at < len(held) and held[at][0] <= column:
                column = max(column, held[at][1])
                at += 1
            end = column + _span(cell, "colspan", MOST_COLUMNS, 1)
            down = number + _span(cell, "rowspan", MOST_ROWS, MOST_ROWS) - 1
            if down > number:
                more.append([column, end, min(down, len(rows))])
            cells.append((column, end, cell))
            column = end
        if more:
            held = _joined(held + more)
        out.append(cells)
    return out


def _wrapped(text: str, width: int) -> list[str]:
    """The text in lines of at most ``width``; a longer word has a line of its own."""
    if len(text) <= width:
        return [text]
    lines, line, size = [], [], -1
    for word in text.split(" "):
        if line and size + 1 + len(word) > width:
            lines.append(" ".join(line))
            line, size = [], -1
        line.append(word)
        size += 1 + len(word)
    return [*lines, " ".join(line)]


def _widths(rows: list[list[tuple[int, int, str]]], starts: list[int]) -> list[int]:
    """How wide each column is; cells of several columns widen the last of them if need be."""
    widths, spanning = [0] * len(starts), []
    for row in rows:
        for start, end, text in row:
            first, last = bisect_left(starts, start), bisect_left(starts, end) - 1
            if first == last:
                widths[first] = max(widths[first], min(len(text), COLUMN_WIDTH))
            else:
                spanning.append((last - first, first, last, len(text)))
    for _, first, last, size in sorted(spanning):
        missing = size - sum(widths[first:last + 1]) - 2 * (last - first)
        widths[last] = max(widths[last], min(widths[last] + missing, COLUMN_WIDTH))
    return widths


def _lay_table(page: Page, table: Node, nested: int) -> None:
    """Cells of a column begin at the same place, two spaces after the widest one before.

    A table with a column in use for each start of a cell; columns that cells only span take no
    room. One that is wider than ``TABLE_WIDTH`` has its cells side by side, not aligned.
    """
    cells, others = _cells(table)
    page.block(2)
    for node in others:
        _walk(page, [node], nested)
        page.block(1)
    rows = [[(start, end, _SPACES.sub(" ", render(c.children, nested + 1)))
             for start, end, c in row] for row in _grid(cells)]
    starts = sorted({start for row in rows for start, _, _ in row})
    widths = _widths(rows, starts) if len(starts) <= TABLE_WIDTH else [TABLE_WIDTH]
    if sum(widths) + 2 * len(widths) > TABLE_WIDTH:
        lines = ["  ".join(text for _, _, text in row).rstrip() for row in rows]
    else:
        offsets = [sum(widths[:k]) + 2 * k for k in range(len(widths) + 1)]
        lines = [line for row in rows for line in _row_lines(row, starts, offsets)]
    for line in lines:
        if line.strip():
            page.block(1)
            page.put(line)
    page.block(2)


def _row_lines(row: list[tuple[int, int, str]], starts: list[int],
               offsets: list[int]) -> Iterator[str]:
    """The lines of a row, each cell's from the offset of its column."""
    placed = []
    for start, end, text in row:
        first, last = bisect_left(starts, start), bisect_left(starts, end)
        width = offsets[last] - 2 - offsets[first]
        placed.append((offsets[first], _wrapped(text, max(width, 1))))
    for number in range(max((len(lines) for _, lines in placed), default=0)):
        line = ""
        for offset, lines in placed:
            if number < len(lines) and lines[number]:
                if len(line) + 2 > offset and line:
                    line += "  "  # a word beyond its column
                line = line.ljust(offset) + lines[number]
        yield line


def _walk(page: Page, nodes: list, nested: int, pre: bool = False) -> None:
    """Emit the nodes in order; the path is a list of its own, so depth is not bounded."""
    todo: list = [("node", n, pre) for n in reversed(nodes)]
    lists: list[list] = []
    while todo:
        what, node, pre = todo.pop()
        if what == "done":
            if node in ("ul", "ol", "menu", "dd", "blockquote"):
                page.indent -= 2 if node in ("dd", "blockquote") else lists.pop()[1]
            page.block(2 if node in PARAGRAPHS and not (lists and node in ("ul", "ol", "menu")) else 1)
            continue
        if isinstance(node, str):
            (page.lines if pre else page.flow)(node)
            continue
        if not node.shown():
            continue
        tag = node.tag
        if tag == "table" and nested < MOST_NESTED:
            _lay_table(page, node, nested)
            continue
        if tag == "br":
            page.breaks, page.space = page.breaks + (1 if page.parts else 0), False
            continue
        if tag in ("td", "th"):
            page.space = True
        children = node.children
        if tag == "details" and not node.flag("open"):
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
        if tag in BLOCKS:
            page.block(1 if tag not in PARAGRAPHS or (lists and tag in ("ul", "ol", "menu")) else 2)
            if tag in ("ul", "ol", "menu"):
                begin = _START.match(node.values().get("start", ""))
                lists.append([int(begin[1]) if begin else 1, 4 if tag == "ol" else 2, tag])
                page.indent += lists[-1][1]
            elif tag == "li" and lists:
                count, _, kind = lists[-1]
                page.mark = f"{count}. " if kind == "ol" else "- "
                lists[-1][0] = count + 1
            elif tag in ("dd", "blockquote"):
                page.indent += 2
            if tag == "hr":
                continue
            todo.append(("done", tag, pre))
        within = pre or tag in ("pre", "textarea")
        if within and not pre and children and isinstance(children[0], str):
            children = [children[0].removeprefix("\n"), *children[1:]]
        todo += [("node", c, within) for c in reversed(children)]


def render(nodes: list, nested: int = 0) -> str:
    page = Page()
    _walk(page, nodes, nested)
    return str(page)


def visible_text(page: str | None) -> str:
    """All visible text of a page; empty for a null or empty page."""
    return render([Builder().feed(page)]) if page else ""


def extract(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """``page_id``, ``text`` and ``n_lines`` of every page; other columns are not read.

    Pages are independent: repeated rows get equal texts, null and empty pages an empty one. A very
    long page is read whole; its text is at most some tens of times as long as the page, where short
    rows stand far to the right in a table. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "html"):
            texts = [visible_text(p) for p in batch.column(1).to_pylist()]
            lines = [sum(1 for x in t.split("\n") if x) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(texts, type=pa.string()),
                 pa.array(lines, type=pa.int64())], names=["page_id", "text", "n_lines"])

    return pages.select(F.col(f"`{id_column}`").alias("page_id"),
                        F.col(f"`{html_column}`").alias("html")).mapInArrow(
        run, "page_id long, text string, n_lines long")

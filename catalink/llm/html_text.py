"""HTML to text by layout: a tree builder with implied tags, visibility rules, and a block renderer.

All visible text of a page is kept (menus and asides too): paragraphs and
headings are set off by empty lines, other blocks by line ends, list items get
markers and indents, table cells are aligned in columns, ``pre`` keeps its
spacing.  Scripts, styles, the document head and hidden elements are invisible;
formulas, the text of drawings (``svg``) and ``xmp`` are not.

Edge cases: a null page gives null text, an empty one gives the empty string;
broken markup never fails (unknown end tags are ignored, open elements end
with their parents); nesting of any depth is walked with an explicit stack;
cells that span rows push the cells below them aside (in a table whose cells lie
too thin for that, see ``GRID_PLACES``, they do not);
repeated rows are rendered each; an empty table gives an empty result.
Only the key and the page are read, so other columns cannot clash.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shipping import ship_package

# Fixed values of HTML: element classes.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset("head script style template title noscript iframe object audio video canvas datalist".split())
# Foreign elements: inside svg only text and embedded HTML show; what shows in neither.
SVG_TEXT = frozenset("text foreignobject".split())
FOREIGN_HIDDEN = {
    "svg": frozenset("desc defs symbol metadata clippath mask marker pattern".split()),
    "math": frozenset("annotation annotation-xml".split()),
}
FOREIGN = frozenset(FOREIGN_HIDDEN)
# HTML inside foreign elements is allowed in these; elsewhere these start tags end the foreign element.
FOREIGN_HTML = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre xmp blockquote figure hr".split())
BLOCK = PARAGRAPH | frozenset(
    "html body address article aside details dialog dd div dt fieldset figcaption footer form header hgroup "
    "legend li main menu nav section summary center caption tr thead tbody tfoot optgroup option search".split()
)
CLOSES_P = (BLOCK - frozenset("html body caption tr thead tbody tfoot option optgroup".split()))
# start tag: (open elements that it ends, elements that bar the search)
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
    "td": (frozenset("td th".split()), frozenset("table tr".split())),
    "th": (frozenset("td th".split()), frozenset("table tr".split())),
    "tr": (frozenset("tr caption colgroup".split()), frozenset(["table"])),
    "thead": (frozenset("thead tbody tfoot caption colgroup".split()), frozenset(["table"])),
    "tbody": (frozenset("thead tbody tfoot caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot caption colgroup".split()), frozenset(["table"])),
    "body": (frozenset(["head"]), frozenset()),
}
# Elements that an end tag of another element outside them cannot close over.
SCOPE = frozenset("table td th caption html body template".split())

# A quote groups only where it opens the value of an attribute, right after "="; any other is
# part of a name or of an unquoted value, and the tag ends at the next ">".  Possessive: linear.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTR = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*+)))?+")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attrs(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if raw and not raw.isspace():
        for m in _ATTR.finditer(raw):
            value = m[2] or m[3] or m[4] or ""
            out.setdefault(m[1].lower(), html.unescape(value) if "&" in value else value)
    return out


class OpenElements:
    """The stack of open elements, with the number of each kind, so that most searches need no walk."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.count: dict[str, int] = {}

    def push(self, node: Node) -> None:
        self.stack.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def cut(self, at: int) -> None:
        for node in self.stack[at:]:
            self.count[node.tag] -= 1
        del self.stack[at:]

    def holds(self, tags: frozenset[str]) -> bool:
        return any(self.count.get(t) for t in tags)

    def end_implied(self, ends: frozenset[str], bar: frozenset[str]) -> None:
        """Close the innermost of ``ends``, unless one of ``bar`` is open inside it."""
        if not self.holds(ends):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in ends:
                self.cut(i)
                return
            if self.stack[i].tag in bar:
                return


def build_tree(page: str) -> Node:
    """The element tree; children are nodes and strings."""
    root = Node("html", {})
    opened, at, end = OpenElements(root), 0, len(page)
    stack = opened.stack
    lowered = None

    def text(s: str) -> None:
        if s:
            stack[-1].children.append(html.unescape(s) if "&" in s else s)

    def push(tag: str, attrs: dict[str, str]) -> Node:
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        opened.push(node)
        return node

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing, raw = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if closing:
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
                continue
            if not opened.count.get(tag):
                if tag == "p":
                    stack[-1].children.append(Node("p", {}))
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    opened.cut(i)
                    break
                if stack[i].tag in SCOPE and tag not in SCOPE and tag not in ("tr", "thead", "tbody", "tfoot"):
                    break
            continue
        if tag in ("html", "body"):
            opened.end_implied(frozenset(["head"]), frozenset())
            if tag == "html":
                for k, v in _attrs(raw).items():
                    root.attrs.setdefault(k, v)
                continue
            if opened.count.get("body"):
                continue
        if stack[-1].tag == "head" and tag not in HIDDEN and tag not in ("meta", "link", "base"):
            opened.cut(len(stack) - 1)
        if tag in CLOSES_P:
            opened.end_implied(frozenset(["p"]), SCOPE)
        if tag in IMPLIED_END:
            opened.end_implied(*IMPLIED_END[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            push("tr", {})  # a cell without a row opens one
        foreign = opened.holds(FOREIGN) and not opened.holds(FOREIGN_HTML)
        if foreign and tag in ENDS_FOREIGN:
            while opened.holds(FOREIGN):
                opened.end_implied(FOREIGN, frozenset())
            foreign = False
        attrs = _attrs(raw)
        if tag in VOID or raw.endswith("/") and (foreign or tag in FOREIGN):
            stack[-1].children.append(Node(tag, attrs))
            continue
        push(tag, attrs)
        if tag in RAW:
            if lowered is None:
                lowered = page.lower()
                if len(lowered) != len(page):  # some letters grow in lower case
                    lowered = page
            stop = lowered.find(f"</{tag}", at)
            stop = end if stop < 0 else stop
            if tag in ("textarea", "title"):
                text(page[at:stop])
            elif tag == "xmp" and stop > at:  # as it stands, entities too
                stack[-1].children.append(page[at:stop])
            close = page.find(">", stop)
            at = end if close < 0 else close + 1
            opened.cut(len(stack) - 1)
    return root


def visible(node: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attrs:
        return False
    if node.tag == "input" and node.attrs.get("type", "").lower() == "hidden":
        return False
    style = node.attrs.get("style")
    if style:
        style = _SPACE.sub("", style.lower())
        if "display:none" in style or "visibility:hidden" in style or "visibility:collapse" in style:
            return False
    return True


# How far a cell spans at most (rowspan 0: as far as that).
MOST_COLUMNS, MOST_ROWS = 100, 65534
# A table with more places under hanging cells than these, and so many for each cell, is laid out without rowspans.
GRID_PLACES, GRID_FACTOR = 10_000, 100


class Flow:
    """Lines of one block context; ``gap`` is the pending break (0 none, 1 line, 2 empty line)."""

    __slots__ = ("lines", "line", "gap", "indent", "marker", "rows")

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.gap = 0
        self.indent: list[str] = []
        self.marker = ""
        self.rows: list | None = None

    def end_line(self) -> None:
        if self.line or self.marker:
            body = self.line.rstrip(" ")
            lead = "".join(self.indent)
            if self.marker:
                lead = lead[: max(0, len(lead) - len(self.marker))] + self.marker
                self.marker = ""
            self.lines.append((lead + body).rstrip(" "))
            self.line = ""

    def brk(self, level: int) -> None:
        if self.line:
            self.end_line()
        self.gap = max(self.gap, level)

    def _open(self) -> None:
        if not self.line and self.gap:
            if self.gap == 2 and self.lines and self.lines[-1] and not (self.marker and self.gap < 2):
                self.lines.append("")
            self.gap = 0

    def words(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if not self.line or self.line.endswith(" "):
            s = s.lstrip(" ")
        if s:
            self._open()
            self.line += s

    def verbatim(self, s: str) -> None:
        for k, part in enumerate(s.replace("\r\n", "\n").split("\n")):
            if k:
                self.newline()
            if part:
                self._open()
                self.line += part

    def newline(self) -> None:
        self._open()
        if self.line:
            self.end_line()
        else:
            self.lines.append("")

    def block(self, lines: list[str]) -> None:
        self.brk(1)
        self._open()
        lead = "".join(self.indent)
        self.lines.extend((lead + x).rstrip(" ") for x in lines)

    def text(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        start = 0
        while start < len(self.lines) and not self.lines[start]:
            start += 1
        return self.lines[start:]


def _span(node: Node, name: str, most: int) -> int:
    value = node.attrs.get(name, "1")
    if not (value.isascii() and value.isdigit()):
        return 1
    return most if name == "rowspan" and int(value[:9]) == 0 else min(max(int(value[:9]), 1), most)


Cell = tuple[list[str], int, int]  # its lines, columns and rows


def _place(rows: list[list[Cell]], spans: bool) -> list[list[tuple[int, list[str], int]]] | None:
    """``(column, lines, colspan)`` of every row's cells, right of what hangs over from above; None if they lie too thin."""
    covered: dict[int, int] = {}  # column -> the last row that a cell from above covers
    out = []
    room = GRID_PLACES + GRID_FACTOR * sum(map(len, rows))
    for r, row in enumerate(rows):
        at, placed = 0, []
        for lines, span, deep in row:
            while taken := [c for c in range(at, at + span) if covered.get(c, -1) >= r]:
                room -= taken[-1] + 1 - at
                at = taken[-1] + 1
                if room < 0:
                    return None
            placed.append((at, lines, span))
            if spans and deep > 1:
                covered.update(dict.fromkeys(range(at, at + span), r + deep - 1))
            at += span
        out.append(placed)
    return out


def _table(rows: list[list[Cell]]) -> list[str]:
    """Rows of cells as aligned text; a spanning cell does not widen its columns and shows in its first row."""
    grid = _place(rows, True) or _place(rows, False) or []
    widths: list[int] = []
    for row in grid:
        for at, lines, span in row:
            widths.extend([0] * (at + span - len(widths)))
            if span == 1:
                widths[at] = max(widths[at], max(map(len, lines), default=0))
    out = []
    for row in grid:
        for k in range(max((len(lines) for _, lines, _ in row), default=0)):
            cells, end = [], 0
            for at, lines, span in row:
                cells.extend(" " * w for w in widths[end:at])
                width = sum(widths[at : at + span]) + 3 * (span - 1)
                cells.append((lines[k] if k < len(lines) else "").ljust(width))
                end = at + span
            out.append(" | ".join(cells).rstrip(" "))
    return out


def render(root: Node) -> str:
    """All visible text of the tree, laid out."""
    flows = [Flow()]
    counters: list[list[int]] = []
    pre = 0
    inside: list[str] = []  # the open svg and math elements, and what shows its text in an svg
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        flow = flows[-1]
        where = inside[-1] if inside else ""
        if isinstance(node, str):
            if where == "svg":
                continue
            flow.verbatim(node) if pre else flow.words(node)
            continue
        tag = node.tag
        if not leaving:
            if not visible(node) or where in FOREIGN and tag in FOREIGN_HIDDEN[where]:
                continue
            if tag in FOREIGN or where == "svg" and tag in SVG_TEXT:
                inside.append(tag)
                if tag in SVG_TEXT:  # placed on its own
                    flow.words(" ")
            if tag == "br":
                flow.newline()
                continue
            if tag == "hr":
                flow.brk(2)
                flow.words("---")
                flow.brk(2)
                continue
            if tag == "img":
                if node.attrs.get("alt"):
                    flow.words(node.attrs["alt"])
                continue
            if tag == "input":
                if node.attrs.get("type", "").lower() in ("submit", "button", "reset") and node.attrs.get("value"):
                    flow.words(" " + node.attrs["value"] + " ")
                continue
            if tag in VOID:
                continue
            if tag in ("td", "th"):
                flows.append(Flow())
            elif tag == "table":
                flow.brk(2)
                table = Flow()
                table.rows = []
                flows.append(table)
            elif tag == "tr":
                if flow.rows is not None:
                    flow.rows.append([])
            elif tag in ("ul", "ol", "menu"):
                flow.brk(1 if counters else 2)
                start = node.attrs.get("start", "1")
                counters.append([int(start) if tag == "ol" and start.isascii() and start.isdigit() else 1, tag == "ol"])
            elif tag == "li":
                flow.brk(1)
                if flow.marker:
                    flow.end_line()
                mark = "- "
                if counters and counters[-1][1]:
                    mark = f"{counters[-1][0]}. "
                    counters[-1][0] += 1
                flow.indent.append(" " * len(mark))
                flow._open()
                flow.marker = mark
            elif tag == "dd" or tag == "blockquote":
                flow.brk(2 if tag == "blockquote" else 1)
                flow.indent.append("    " if tag == "dd" else "> ")
            elif tag in BLOCK:
                if not flow.marker:
                    flow.brk(2 if tag in PARAGRAPH else 1)
            if tag in ("pre", "xmp", "textarea"):
                pre += 1
            todo.append((node, True))
            todo.extend((c, False) for c in reversed(node.children))
            continue
        if inside and tag == inside[-1]:
            inside.pop()
            if tag in SVG_TEXT:
                flow.words(" ")
        if tag in ("pre", "xmp", "textarea"):
            pre -= 1
        if tag in ("td", "th"):
            cell = flows.pop()
            up = flows[-1]
            if up.rows is not None:
                if not up.rows:
                    up.rows.append([])
                up.rows[-1].append((cell.text(), _span(node, "colspan", MOST_COLUMNS), _span(node, "rowspan", MOST_ROWS)))
            else:  # a cell outside any table is a block
                up.block(cell.text())
                up.brk(1)
        elif tag == "table":
            table = flows.pop()
            up = flows[-1]
            outside = table.text()  # caption and stray text come before the rows
            up.block(outside + _table(table.rows or []))
            up.brk(2)
        elif tag in ("ul", "ol", "menu"):
            counters.pop()
            flow.brk(1 if counters else 2)
        elif tag == "li":
            flow.brk(1)
            flow.end_line()
            flow.indent.pop()
        elif tag in ("dd", "blockquote"):
            flow.brk(2 if tag == "blockquote" else 1)
            flow.indent.pop()
        elif tag in BLOCK:
            flow.brk(2 if tag in PARAGRAPH else 1)
    return "\n".join(flows[0].text())


def page_text(page: str | None) -> str | None:
    return None if page is None else render(build_tree(page))


def _render_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = pa.array([page_text(x) for x in part.column(1).to_pylist()], pa.large_string())
            yield pa.RecordBatch.from_arrays([part.column(0), texts.cast(pa.string())], names=["key", "text"])


def extract_text(pages: DataFrame, key: str = "page_id", page: str = "html") -> DataFrame:
    """``key, text, n_chars``: the visible text of every page; a map without a shuffle."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(key).alias("key"), F.col(page).alias("page"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(_render_batches, f"key {kind}, text string")
    return out.select(F.col("key").alias(key), "text", F.length("text").cast("long").alias("n_chars"))


def op8_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages: their visible text, laid out."""
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))

"""Layout-aware text of HTML pages.

A page is read into a tree the way browsers do it in outline: void elements have
no end, raw-text elements hold no tags, and an element's end is implied where the
next one can't stand inside it (a paragraph before a block, a list item before the
next, cells and rows of tables, options, terms). A cell outside a row gets one, and
a head ends where text or an element that can't stand in it begins. Elements that a
browser doesn't show are dropped with all they hold. The rest is laid out as text:
blocks on lines of their own, paragraphs and headings apart by an empty line, list
items with bullets or numbers and indented by level, table cells padded to the
width of their column, preformatted text as it is, and other white space as one
space.

Tasks take pages one by one, whole; nothing is shuffled.

Defined results: a null page is empty text; a page without tags is its text;
unclosed and stray tags, comments and attributes without quotes are read as
browsers read them; repeated rows give a row each; a null page_id is kept; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.llm.common import on_workers

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template title noscript iframe noembed noframes datalist object svg math audio video canvas map area base link meta param source track col colgroup".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul caption tbody thead tfoot tr td th option optgroup".split())
#: Blocks with an empty line around them.
APART = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl menu dir figure hr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: A start tag ends the open elements of the first set, unless one of the second stands between.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset("tr table".split())),
    "th": (frozenset(["td", "th"]), frozenset("tr table".split())),
    "tbody": (frozenset("tbody thead tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "thead": (frozenset("tbody thead tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset("select datalist optgroup".split())),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
}
#: Start tags that may stand in a head; any other ends it, as non-blank text does.
IN_HEAD = frozenset("html head title meta link base basefont bgsound style script noscript noframes template".split())
#: What a part of a table stands in: all that is open inside the innermost of these ends before it, as in browsers.
TAKES = {
    **dict.fromkeys(("td", "th"), frozenset("tr tbody thead tfoot table template".split())),
    "tr": frozenset("tbody thead tfoot table template".split()),
    **dict.fromkeys(("tbody", "thead", "tfoot"), frozenset("table template".split())),
}
#: Elements open at once (deeper ones become siblings, as in browsers), and lists and tables laid out inside each other.
MOST_OPEN, MOST_NESTED = 512, 60
#: End tags don't reach past these.
SCOPE = frozenset("table td th caption html template".split())

_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)|</[^A-Za-z>][^>]*>|</>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"'][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        """The value of an attribute, empty without one, None without the attribute."""
        if name not in self.attributes.lower():
            return None
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return html.unescape(next((g for g in m.groups()[1:] if g is not None), ""))
        return None

    def hidden(self) -> bool:
        if self.tag in HIDDEN:
            return True
        if not self.attributes:
            return False
        if self.attribute("hidden") is not None or _UNSEEN.search(self.attribute("style") or ""):
            return True
        return self.tag == "input" or self.tag == "dialog" and self.attribute("open") is None


def tree(page: str) -> Node:
    """The page's elements and texts (as plain strings, entities resolved) below a root."""
    root = Node("#root")
    open_ = [root]
    at, end = 0, len(page)
    headed = False  # whether a head may be open

    def close(tags: frozenset, until: frozenset) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in until:
                return
            if open_[i].tag in tags:
                del open_[i:]
                # a row's end also ends its cell, and so on up to the limit
                if any(n.tag in tags for n in open_[1:]) and not tags.isdisjoint(("tr", "dt")):
                    close(tags, until)
                return

    def close_head(always: bool) -> None:
        """Ends an open head, unless what comes stands in its hidden noscript or template."""
        nonlocal headed
        i = next((i for i, n in enumerate(open_) if n.tag == "head"), 0) if headed else 0
        headed = i > 0
        if i and (always or not any(n.tag in ("noscript", "template") for n in open_[i:])):
            del open_[i:]

    while at < end:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else end]
        if text:
            text = html.unescape(text)
            if text.strip(" \t\n\f\r"):
                close_head(False)
            open_[-1].children.append(text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not any(n.tag == "p" for n in open_):
                open_[-1].children.append(Node("p"))
            elif tag not in ("html", "body"):
                for i in range(len(open_) - 1, 0, -1):
                    if open_[i].tag == tag:
                        del open_[i:]
                        break
                    if open_[i].tag in SCOPE and tag not in ("table", "tr", "tbody", "thead", "tfoot", "template"):
                        break
            continue
        if tag not in IN_HEAD:
            close_head(tag == "body")
        if tag in CLOSES_P:
            close(frozenset(["p"]), SCOPE)
        if tag in TAKES and (i := next((i for i in range(len(open_) - 1, 0, -1) if open_[i].tag in TAKES[tag]), 0)):
            del open_[i + 1 :]
            if tag in ("td", "th") and open_[i].tag not in ("tr", "template") and len(open_) < MOST_OPEN:
                open_.append(Node("tr"))
                open_[i].children.append(open_[-1])
        elif tag in IMPLIED:
            close(*IMPLIED[tag])
        node = Node(tag, m[3])
        open_[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            raw = page[at : stop.start() if stop else end]
            node.children.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
            at = stop.end() if stop else end
        elif tag not in VOID and len(open_) < MOST_OPEN:
            open_.append(node)
            headed = headed or tag == "head"
    return root


class Lines:
    """Lines of text under construction. ``gap`` is the number of line ends that the next text needs before it."""

    def __init__(self, depth: int = 0, in_list: bool = False):
        self.depth, self.list_gap = depth, 1 if in_list else 2
        self.out: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0

    def text(self, s: str) -> None:
        if not s:
            return
        words = _SPACE.sub(" ", s)
        if words == " ":
            self.space = bool(self.line)
            return
        self._open()
        if (self.space or words[0] == " ") and self.line:
            self.line.append(" ")
        self.line.append(words.strip(" "))
        self.space = words[-1] == " "

    def _open(self) -> None:
        if self.gap and not self.line:
            if self.out:
                self.out.extend([""] * (self.gap - 1))
            self.gap = 0

    def end_line(self, gap: int = 1) -> None:
        if self.line:
            self.out.append("".join(self.line))
            self.line = []
        self.space = False
        self.gap = max(self.gap, gap)

    def break_line(self) -> None:
        """A forced break: an empty line if there is no text to end."""
        if self.line:
            self.end_line()
        elif self.out:
            self._open()
            self.out.append("")

    def lines(self, lines: list[str], gap: int) -> None:
        """Finished lines as a block."""
        self.end_line(gap)
        if lines:
            self._open()
            self.gap = 0
            self.out.extend(lines)
            self.gap = gap

    def done(self) -> list[str]:
        self.end_line()
        return self.out


def _block(node: Node, depth: int = 0, in_list: bool = False) -> list[str]:
    lines = Lines(depth, in_list)
    _flow(node, lines)
    return lines.done()


def _indent(lines: list[str], first: str) -> list[str]:
    """Lines behind a marker, the others aligned with the text after it."""
    pad = " " * len(first)
    return [(first if i == 0 else pad) + x if x or i == 0 else "" for i, x in enumerate(lines)]


def _list(node: Node, depth: int) -> list[str]:
    out: list[str] = []
    number = 1
    if node.tag == "ol" and (start := (node.attribute("start") or "").strip()).lstrip("-").isdecimal():
        number = int(start)
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                out.append(_SPACE.sub(" ", child).strip())
        elif not child.hidden():
            lines = _block(child, depth + 1, True)
            if child.tag == "li":
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += 1
                out.extend(_indent(lines or [""], mark))
            elif child.tag in ("ul", "ol", "menu", "dir") and depth < MOST_NESTED:
                out.extend(_indent(_list(child, depth + 1), "  "))
            else:
                out.extend(lines)
    return [x.rstrip() for x in out]


def _parts(node: Node) -> Iterator[tuple[Node | None, list]]:
    """The rows of a table and its sections in order, each with what stands loose before it; last, what is left over."""
    loose: list = []
    for child in node.children:
        if isinstance(child, Node) and child.tag in ("tbody", "thead", "tfoot"):
            for row, before in [] if child.hidden() else _parts(child):
                yield row, loose + before
                loose = []
        elif isinstance(child, Node) and child.tag == "tr":
            if not child.hidden():
                yield child, loose
                loose = []
        else:
            loose.append(child)
    yield None, loose


def _span(cell: Node, name: str) -> int:
    value = (cell.attribute(name) or "").strip()
    return min(max(int(value), 1), 1000) if value.isdecimal() else 1


def _loose(children: list, depth: int) -> list[str]:
    """What stands in a table outside of its cells; browsers show it before the table."""
    node = Node("#loose")
    node.children = children
    return _block(node, depth + 1)


def _table(node: Node, depth: int) -> list[str]:
    """Caption and all else outside the cells above, then the rows with cells padded to their column's width."""
    above, grid, widths = [], [], {}
    taken: dict[int, int] = {}  # columns that a cell of an earlier row reaches down into, and for how many rows
    for row, loose in _parts(node):
        above.extend(_loose(loose, depth))
        if row is None:
            continue
        cells, column = [], 0
        loose = []
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                loose.append(cell)
                continue
            if cell.hidden():
                continue
            while taken.get(column, 0) > 0:
                column += 1
            lines = _block(cell, depth + 1)
            wide, deep = _span(cell, "colspan"), _span(cell, "rowspan")
            cells.append((column, wide, lines))
            if wide == 1:
                widths[column] = max([widths.get(column, 0), *map(len, lines)])
            if deep > 1:
                for c in range(column, column + wide):
                    taken[c] = deep
            column += wide
        above.extend(_loose(loose, depth))
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        if cells:
            grid.append(cells)
    starts, at = {}, 0
    for c in range(max((c + w for cells in grid for c, w, _ in cells), default=0)):
        starts[c] = at
        at += widths[c] + 2 if c in widths else 0
    out = list(above)
    for cells in grid:
        for i in range(max(len(lines) for _, _, lines in cells)):
            line = ""
            for column, _, lines in cells:
                if i < len(lines) and lines[i]:
                    line = line.ljust(starts[column]) if len(line) <= starts[column] else line + "  "
                    line += lines[i]
            out.append(line.rstrip())
    return out


def _text_of(node: Node) -> str:
    out, stack = [], [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, str):
            out.append(child)
        elif child.tag == "br":
            out.append("\n")
        elif not child.hidden():
            stack.append(iter(child.children))
    return "".join(out)


def _flow(node: Node, lines: Lines) -> None:
    """Lays out what a node holds. The stack is explicit: pages nest deeper than Python calls may."""
    stack: list[tuple[Iterator, int]] = [(iter(node.children), 0)]
    while stack:
        children, gap = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if gap:
                lines.end_line(gap)
        elif isinstance(child, str):
            lines.text(child)
        elif child.hidden():
            continue
        elif child.tag == "br":
            lines.break_line()
        elif child.tag == "pre" or child.tag == "textarea" or child.tag == "xmp":
            raw = _text_of(child).replace("\r\n", "\n").expandtabs(8)
            lines.lines(raw.removeprefix("\n").rstrip("\n").split("\n"), 2 if child.tag == "pre" else 1)
        elif child.tag in ("ul", "ol", "menu", "dir") and lines.depth < MOST_NESTED:
            lines.lines(_list(child, lines.depth + 1), lines.list_gap)
        elif child.tag == "table" and lines.depth < MOST_NESTED:
            lines.lines(_table(child, lines.depth + 1), 2)
        elif child.tag == "img":
            lines.text(child.attribute("alt") or "")
        elif child.tag in BLOCK:
            own = 2 if child.tag in APART else 1
            lines.end_line(own)
            if child.tag == "dd" and lines.depth < MOST_NESTED:
                lines.lines(_indent(_block(child, lines.depth + 1), "    "), 1)
            else:
                stack.append((iter(child.children), own))
        else:
            stack.append((iter(child.children), 0))


def visible_text(page: str | None) -> str:
    """All text that a browser would show, laid out in lines."""
    return "\n".join(x.rstrip() for x in _block(tree(page or ""))).strip("\n")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text of each page."""
    on_workers(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([visible_text(x) for x in part.column(1).to_pylist()], pa.string())], names=["page_id", "text"])

    return pages.select(pages[id_col].cast("bigint").alias("page_id"), F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html")).mapInArrow(run, "page_id bigint, text string")

"""Visible text of HTML pages, laid out as a reader sees it.

A small tree builder closes tags that HTML lets authors leave open; a
renderer walks the tree, skips what is not displayed, and keeps the layout:
blank lines around blocks, bullets and numbers of lists (indented by depth),
preformatted text as it stands, and tables with aligned columns.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Generator, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_UNSEEN = {"head", "script", "style", "template", "noscript", "iframe", "object", "svg", "canvas", "audio", "video", "datalist",
           "title"}
#: these may stand in a head; any other tag and any text ends it
_METADATA = {"head", "base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
_PARAGRAPHS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "ul", "ol", "dl", "table", "figure", "fieldset"}
_BLOCKS = _PARAGRAPHS | {"address", "article", "aside", "body", "center", "dd", "details", "dialog", "div", "dt", "figcaption",
                         "footer", "form", "header", "hgroup", "html", "legend", "li", "main", "menu", "nav", "section", "summary",
                         "caption", "tr", "thead", "tbody", "tfoot"}
#: an opening tag closes these if they are open, up to the given boundary
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}), "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
           "td": ({"td", "th", "caption"}, {"tr", "table"}), "th": ({"td", "th", "caption"}, {"tr", "table"}),
           **{t: ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot")}}
#: declarations of an inline style that count; others are ignored, as browsers do
_DISPLAYS = re.compile(r"none|block|inline|(inline-)?(block|flex|grid|table)|contents|flow-root|list-item|run-in|ruby|table-[a-z-]+|inherit|initial|unset|revert(-layer)?")
_VISIBILITIES = {"visible": True, "initial": True, "hidden": False, "collapse": False}
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
_CAPTIONED = {"", "text", "search", "email", "url", "tel", "number", "submit", "reset", "button"}  # inputs that show their value
_SPACE = re.compile(r"[ \t\n\r\f\v]+")
_UNFINISHED = re.compile(r"<[A-Za-z/!?]")
#: lines that begin with it are not moved further to the right, and no gap in a
#: row of a table is wider: so the text stays in proportion to the page
_MAX_INDENT = " " * 400
_MAX_SPAN = 1000  # columns of a cell, as in browsers


def _run(call: Generator):
    """Result of a generator that yields other such generators to call them:
    recursion without Python's depth limit."""
    stack, value = [call], None
    while stack:
        try:
            called = stack[-1].send(value)
        except StopIteration as done:
            stack.pop()
            value = done.value
        else:
            stack.append(called)
            value = None
    return value


def _style(attrs: dict[str, str | None]) -> dict[str, str]:
    """``display`` and ``visibility`` of an inline style: the last valid
    declaration counts, an important one before any other."""
    found: dict[str, tuple[bool, str]] = {}
    for part in _COMMENT.sub("", attrs.get("style") or "").lower().split(";"):
        name, _, value = part.partition(":")
        name, important = name.strip(), "!" in value
        value = value.partition("!")[0].strip()
        if name == "display" and _DISPLAYS.fullmatch(value) or name == "visibility" and (value in _VISIBILITIES or value in ("inherit", "unset")):
            if important or name not in found or not found[name][0]:
                found[name] = important, value
    return {name: value for name, (_, value) in found.items()}


class Node:
    """Element; ``gone`` if it is not displayed with all it holds, ``shown``
    if its own text can be seen (``visibility`` is inherited, and a child may
    set it again)."""
    __slots__ = ("tag", "attrs", "children", "gone", "shown")

    def __init__(self, tag: str, attrs: dict[str, str | None] | None = None, shown: bool = True):
        self.tag, self.attrs, self.children = tag, attrs or {}, []
        style = _style(self.attrs) if "style" in self.attrs else {}
        self.shown = _VISIBILITIES.get(style.get("visibility", ""), shown)
        display = style.get("display")
        self.gone = tag in _UNSEEN or display == "none" or (
            display is None and ("hidden" in self.attrs or (tag == "dialog" and "open" not in self.attrs)))


class TreeBuilder(HTMLParser):
    """Element tree of a page; text nodes are plain strings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # where in ``open`` each tag stands

    def _push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)

    def _cut(self, at: int) -> None:
        for node in self.open[at:]:
            self.places[node.tag].pop()
        del self.open[at:]

    def _last(self, tags: set[str] | tuple[str, ...]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _close_until(self, tags: set[str], boundary: set[str]) -> None:
        edge = self._last(boundary)
        above = [places[bisect_right(places, edge)] for t in tags if (places := self.places.get(t)) and places[-1] > edge]
        if above:
            self._cut(min(above))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _CLOSES:
            self._close_until(*_CLOSES[tag])
        elif tag in _BLOCKS:
            self._close_until({"p"}, {"td", "th", "li", "div", "body", "button", "blockquote"})
        if tag not in _METADATA:
            self._end_head()
        node = Node(tag, dict(attrs), self.open[-1].shown)
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self._push(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.open[-1].tag == tag and tag not in _BLOCKS:
            self._cut(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        at = self._last((tag,))
        # a stray end tag does not reach out of its cell
        if at and (tag in ("table", "tr", "thead", "tbody", "tfoot", "body", "html") or at >= self._last(("td", "th", "table"))):
            self._cut(at)

    def _end_head(self) -> None:
        if self.open[-1].tag == "head":
            self._cut(len(self.open) - 1)  # the end of the head may be left out

    def handle_data(self, data: str) -> None:
        if data.strip(" \t\n\r\f"):
            self._end_head()
        self.open[-1].children.append(data)


class Renderer:
    """Lines of text with pending breaks: 1 for a new line, 2 for a blank one."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the line that is being written, none of them empty
        self.breaks = 0

    def block(self, breaks: int) -> None:
        line = "".join(self.parts).rstrip()
        if line:
            self.lines.append(line)
        self.parts = []
        self.breaks = max(self.breaks, breaks)

    def put(self, text: str) -> None:
        if not self.parts or self.parts[-1].endswith(" "):
            text = text.lstrip(" ")
        if not text:
            return
        if not self.parts:
            if self.breaks == 2 and self.lines:
                self.lines.append("")
            self.breaks = 0
        self.parts.append(text)

    def raw(self, lines: list[str]) -> None:
        self.block(1)
        if lines and self.breaks == 2 and self.lines:
            self.lines.append("")
        if lines:
            self.breaks = 0
        self.lines.extend(lines)

    def text(self) -> str:
        self.block(0)
        return "\n".join(self.lines)

    def render(self, node: Node) -> Generator:
        for child in node.children:
            if isinstance(child, str):
                if node.shown:
                    self.put(_SPACE.sub(" ", child))
            elif not child.gone:
                yield self.element(child)

    def element(self, node: Node) -> Generator:
        tag = node.tag
        if tag == "br":
            if self.parts:
                self.block(1)
            else:
                self.breaks = max(self.breaks, 2)
        elif tag == "hr":
            self.block(2)
        elif tag in ("img", "input"):
            if node.shown:
                self.put(_caption(node))
        elif tag == "textarea":
            lines = (yield _plain(node)).removeprefix("\n").expandtabs().split("\n")
            if len(lines) > 1:
                self.raw(lines)
            else:
                self.put(lines[0])
        elif tag == "select":
            shown = yield _shown_options(node)
            if len(shown) > 1:
                self.raw(shown)
            else:
                self.put("".join(shown))
        elif tag in ("td", "th"):  # a cell outside of any table
            self.put(" ")
            yield self.render(node)
            self.put(" ")
        elif tag in _BLOCKS:
            around = 2 if tag in _PARAGRAPHS else 1
            self.block(around)
            if tag in ("ul", "ol", "menu"):
                self.raw((yield _list(node)))
            elif tag == "table":
                self.raw((yield _table(node)))
            elif tag == "details" and "open" not in node.attrs:
                for child in node.children:  # only the first summary of a closed one
                    if not isinstance(child, str) and child.tag == "summary":
                        if not child.gone:
                            yield self.element(child)
                        break
            elif tag == "pre":
                self.raw((yield _plain(node)).strip("\n").expandtabs().split("\n"))
            elif tag == "li":
                if node.shown:
                    self.put("- ")
                yield self.render(node)
            elif tag == "dd":
                self.raw([_moved(line, "  ") if line else line for line in (yield _inner(node))])
            else:
                yield self.render(node)
            self.block(around)
        else:
            yield self.render(node)


def _caption(node: Node) -> str:
    """What a picture or an input shows instead of content."""
    kind = (node.attrs.get("type") or "").strip().lower() if node.tag == "input" else "image"
    text = node.attrs.get("alt" if kind == "image" else "value") if kind == "image" or kind in _CAPTIONED else None
    return _SPACE.sub(" ", text or "").strip()


def _moved(line: str, by: str) -> str:
    return line if line.startswith(_MAX_INDENT) else by + line


def _inner(node: Node) -> Generator:
    """Lines of an element's content."""
    out = Renderer()
    yield out.render(node)
    text = out.text()
    return text.split("\n") if text else []


def _plain(node: Node) -> Generator:
    """Text of a preformatted element, without any folding."""
    parts = []
    for child in node.children:
        if isinstance(child, str):
            parts.append(child if node.shown else "\n" * child.count("\n"))
        elif child.tag == "br":
            parts.append("\n")
        elif not child.gone:
            parts.append((yield _plain(child)))
    return "".join(parts)


def _shown_options(node: Node) -> Generator:
    """Texts of a select box that are shown: of a drop-down the selected
    option (the last one so marked, else the first that can be chosen), of a
    list box all of them with the names of their groups."""
    size = (node.attrs.get("size") or "").strip()
    drop_down = "multiple" not in node.attrs and not (re.fullmatch("[0-9]{1,9}", size) and int(size) > 1)
    texts: list[str] = []
    chosen = None
    first = None
    left = [(child, False) for child in reversed(node.children)]
    while left:
        child, disabled = left.pop()
        if isinstance(child, str) or child.gone:
            continue
        disabled = disabled or "disabled" in child.attrs
        label = _SPACE.sub(" ", child.attrs.get("label") or "").strip()
        if child.tag == "option":
            text = label or _SPACE.sub(" ", (yield _plain(child))).strip()
            if "selected" in child.attrs:
                chosen = text
            if first is None and not disabled:
                first = text
            texts.append(text)
        else:
            if child.tag == "optgroup" and label and child.shown and not drop_down:
                texts.append(label)
            left += [(c, disabled) for c in reversed(child.children)]
    if drop_down:
        texts = [text for text in (first if chosen is None else chosen,) if text is not None]
    return [text for text in texts if text]


def _list(node: Node) -> Generator:
    """Lines of a list."""
    lines: list[str] = []
    start = node.attrs.get("start") or ""
    number = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
    for child in node.children:
        if isinstance(child, str):
            if child.strip() and node.shown:
                lines.append(_SPACE.sub(" ", child).strip())
        elif not child.gone:
            inner = yield _inner(child)
            if child.tag == "li":
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += 1
                if not child.shown:  # nor is its mark
                    lines += [_moved(line, " " * len(mark)) for line in inner if line]
                    continue
                inner = [line for i, line in enumerate(inner) if line or i == 0] or [""]
                lines += [mark + line if i == 0 else _moved(line, " " * len(mark)) for i, line in enumerate(inner)]
            else:
                lines += [_moved(line, "  ") for line in inner]
    return [line.rstrip() for line in lines]


def _rows(node: Node, group: int = 0) -> Iterator[tuple[int, Node]]:
    """(number of the row group, row, cell or caption) of a table in order."""
    for k, child in enumerate(node.children, 1):
        if not isinstance(child, str) and not child.gone:
            if child.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(child, k)
            elif child.tag in ("tr", "td", "th", "caption"):
                yield group, child


def _misplaced(node: Node) -> Node:
    """What stands in a table but in no cell; browsers show it before the table."""
    out = Node("div")
    for child in node.children:
        if isinstance(child, str):
            if node.shown:
                out.children.append(child)
        elif child.tag in ("thead", "tbody", "tfoot", "tr"):
            if not child.gone:
                inner = _misplaced(child)
                out.children += inner.children if child.tag != "tr" else [c for c in inner.children if isinstance(c, str)]
        elif node.tag != "tr" and child.tag not in ("td", "th", "caption", "colgroup", "col"):
            out.children.append(child)
    return out


def _span(cell: Node, name: str) -> int:
    value = (cell.attrs.get(name) or "").strip()
    return int(value) if re.fullmatch("[0-9]{1,9}", value) else 1


class _Taken:
    """Columns that cells of earlier rows reach down into, as ranges that are
    neither overlapping nor adjacent."""

    def __init__(self):
        self.begin: list[int] = []
        self.end: list[int] = []
        self.until: dict[int, list[tuple[int, int]]] = {}  # row -> ranges that end before it

    def free(self, column: int) -> tuple[int, float]:
        """The first free column from here on, and where its gap ends."""
        at = bisect_right(self.begin, column)
        if at and self.end[at - 1] > column:
            column = self.end[at - 1]
        return column, self.begin[at] if at < len(self.begin) else float("inf")

    def take(self, begin: int, end: int, row: int) -> None:
        """Take a free range for all rows before ``row``."""
        self.until.setdefault(row, []).append((begin, end))
        at = bisect_left(self.begin, begin)
        right = at < len(self.begin) and self.begin[at] == end
        if at and self.end[at - 1] == begin:
            self.end[at - 1] = self.end[at] if right else end
            if right:
                del self.begin[at], self.end[at]
        elif right:
            self.begin[at] = begin
        else:
            self.begin.insert(at, begin)
            self.end.insert(at, end)

    def give_back(self, row: int) -> None:
        for begin, end in self.until.pop(row, ()):
            at = bisect_right(self.begin, begin) - 1
            first, last = self.begin[at], self.end[at]
            self.begin[at:at + 1] = [b for b, e in ((first, begin), (end, last)) if b < e]
            self.end[at:at + 1] = [e for b, e in ((first, begin), (end, last)) if b < e]


def _placed(rows: list[tuple[int, list[tuple[int, int, list[str]]]]]) -> list[list[tuple[int, int, list[str]]]]:
    """Rows of (group, cells of (columns, rows, lines)) -> rows of (column,
    end, lines): a cell is put into the first free column of its row.  Cells
    reach down no further than their group, and not over taken columns."""
    last = {group: r + 1 for r, (group, _) in enumerate(rows)}
    taken = _Taken()
    out = []
    for r, (group, cells) in enumerate(rows):
        taken.give_back(r)
        column, placed, down = 0, [], []
        for wide, deep, lines in cells:
            column, gap = taken.free(column)
            end = min(column + wide, gap)
            until = last[group] if deep == 0 else min(r + deep, last[group])
            if until > r + 1:
                down.append((column, end, until))
            placed.append((column, end, lines))
            column = end
        for begin, end, until in down:
            taken.take(begin, end, until)
        out.append(placed)
    return out


def _aligned(grid: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Lines of placed cells.  A column is as wide as the widest cell in it;
    a cell over several columns widens the last of them if it needs to.  Cells
    alone in their row, or wider than the widest gap, widen nothing."""
    starts = sorted({column for cells in grid for column, _, _ in cells})
    index = {column: i for i, column in enumerate(starts)}
    width = [0] * len(starts)
    spanning = []
    for cells in grid:
        for column, end, lines in cells:
            need = max(map(len, lines), default=0)
            if len(cells) == 1 or need > len(_MAX_INDENT):
                continue
            i, j = index[column], bisect_left(starts, end)
            if j - i > 1:
                spanning.append((j - i, i, j, need))
            else:
                width[i] = max(width[i], need)
    for _, i, j, need in sorted(spanning):
        width[j - 1] += max(0, need - sum(width[i:j]) - 2 * (j - i - 1))
    left = [0]
    for w in width:
        left.append(left[-1] + w + 2)
    out = []
    for cells in grid:
        live = [(left[index[column]], lines) for column, _, lines in cells if lines]
        k = 0
        while live:
            parts: list[str] = []
            size = 0
            for at, lines in live:
                if lines[k]:
                    gap = min(max(at - size, 2 if size else 0), len(_MAX_INDENT) + 2 if size else len(_MAX_INDENT))
                    parts += (" " * gap, lines[k])
                    size += gap + len(lines[k])
            out.append("".join(parts).rstrip())
            k += 1
            live = [(at, lines) for at, lines in live if len(lines) > k]
    return out


def _table(node: Node) -> Generator:
    """Rows of a table; cells of a column begin at one position, also beside
    and below cells over several columns or rows.  A cell of several lines (or
    a nested table) keeps them, below each other, in its first row."""
    lines: list[str] = yield _inner(_misplaced(node))
    rows = []
    for group, row in _rows(node):
        if row.tag == "caption":
            lines += yield _inner(row)
            continue
        texts = []
        for cell in [row] if row.tag in ("td", "th") else row.children:
            if not isinstance(cell, str) and not cell.gone:
                texts.append((min(max(_span(cell, "colspan"), 1), _MAX_SPAN), _span(cell, "rowspan"), (yield _inner(cell))))
        rows.append((group, texts))
    return lines + _aligned(_placed(rows))


def visible_text(html: str) -> str:
    """All text that a browser would show of a page, with its layout.

    Text that only a browser brings along (the default caption of a submit
    button or of closed details) is left out.  Lines are indented, and cells of
    a table moved to the right, by at most 400 spaces: without that bound deep
    lists and wide tables make texts of the square of the page's size."""
    builder = TreeBuilder()
    # after the last ">" no tag can end: an unfinished one hides the rest
    end = html.rfind(">") + 1
    rest = _UNFINISHED.split(html[end:], maxsplit=1)[0]
    builder.feed(html[:end] + rest)
    builder.close()
    out = Renderer()
    _run(out.render(builder.root))
    return out.text()


def extract_text(pages: DataFrame, html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (default: all but the page) of every row with
    ``text``, the page's visible text.

    A null page has null text; an empty one, or one without visible text, an
    empty text.  Broken markup never fails: unknown tags are inline, open tags
    end with their parent, and tags may nest to any depth (lines are indented
    by 400 spaces at most).  Repeated rows and null ids are rows like any
    other; an input column ``text`` is replaced."""
    carry = [c for c in ([c for c in pages.columns if c != html_col] if carry is None else carry) if c != "text"]
    schema = StructType([pages.schema[c] for c in carry] + [StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if page is None else visible_text(page) for page in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*carry, "text"])

    return pages.select(*[F.col(f"`{c}`") for c in carry], F.col(html_col).alias("__html")).mapInArrow(run, schema)

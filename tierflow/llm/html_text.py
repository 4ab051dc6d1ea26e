"""Layout-aware text of HTML pages (operator 6).

A tree builder turns tag soup into properly nested start and end events: it implies omitted
end tags (head, p, li, dt, dd, option, table parts) and rows, and ignores end tags without a
start.
A renderer keeps a frame for each open block and emits all visible text: blocks on lines of
their own, with a blank line around paragraphs, headings, lists and tables; list items with
bullets or numbers, indented by depth; table cells padded to the width of their column;
preformatted text as it stands. Cells that span columns or rows keep those after them in
their columns; one of several columns is as wide as these. Head, scripts, styles, comments
and elements hidden by attribute or inline style are invisible; what is visible again inside
an element of hidden visibility shows. Of an svg, only its text elements and foreign objects
show, each on lines of its own. A closed dialog is hidden; the body of closed details shows,
as a reader can open it. Nothing recurses, so nesting may be of any depth, and the scanner
never goes back but once a page, so that broken pages take no longer than sound ones.

Defined results: null and empty pages give an empty text; text without tags is itself, with
white space collapsed. Broken markup never fails: what is not a tag is text, and a tag that
the page ends in is dropped. Where the page ends in a quoted value, quotes mean nothing from
that tag on. Bounds keep the text of any page in proportion to it: elements nest to DEPTH and
indent to INDENTED levels, columns are padded to PADDED characters, and a cell of several rows
keeps its place below in the first SPANNED columns; no text is lost by them.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tierflow.llm.common import texts_of, with_columns

# Element names of the HTML standard by what they do here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head title script style template noscript noframes noembed iframe object audio video canvas datalist rp".split())
HIDDEN |= {"annotation", "annotation-xml"}
# Within an svg: what shows text, and what is drawn by reference or not at all.
SVG_SHOWN = {"text", "foreignobject"}
SVG_HIDDEN = set("defs desc metadata symbol clippath mask marker pattern".split())
# Elements of svg and math that hold HTML; HTML elements that end an svg or math elsewhere.
HTML_WITHIN = set("foreignobject desc mi mo mn ms mtext annotation-xml".split())
ENDS_FOREIGN = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
RAW = set("script style textarea title iframe noscript noframes noembed xmp".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre xmp blockquote figure form fieldset hr".split())
PRE = {"pre", "xmp"}
BLOCKS = SPACED | set(
    "html body address article aside center details dialog dd div dt figcaption footer header hgroup legend li main nav "
    "optgroup option search section summary caption thead tbody tfoot tr td th menu".split()
)
CELLS = {"td", "th"}
INDENTS = {"li", "blockquote", "dd"}
# Start tag -> open elements it closes, and the elements beyond which it does not look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
# What may stand in a head; any other start tag or text ends it.
IN_HEAD = set("title meta link style script base template noscript noframes".split())
# An open p ends where one of these starts.
ENDS_P = BLOCKS - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "option", "optgroup", "legend", "dialog"}
BREAKS_P = {"table", "td", "th", "caption", "button", "object", "foreignobject", "mi", "mo", "mn", "ms", "mtext"}

# Elements inside each other, beyond which they become neighbours, as browsers have it; and
# those of them that indent their text.
DEPTH = 512
INDENTED = 32
# Columns that a cell can span, and the first columns, where one of several rows takes place.
WIDEST = 1000
SPANNED = 64
# Columns are padded up to this many characters.
PADDED = 120
BLANK = " \t\n\r\f"
# Quantifiers are possessive: what is read once is not tried otherwise.
_NAME = re.compile(rf"[a-zA-Z][^{BLANK}/>]*+")
_QUOTED = re.compile(rf"""(?:[^>=]++|=[{BLANK}]*+(?:"[^"]*+"|'[^']*+'|[^{BLANK}>"'][^{BLANK}>]*+|(?=>)))*+>""")
_COMMENT_END = re.compile("--!?>")
_SPACE = re.compile(rf"[{BLANK}]+")
# A name and, if there is one, its value.
_ATTRIBUTE = re.compile(
    rf"""([^{BLANK}/=][^{BLANK}/=]*)(?:[{BLANK}]*=[{BLANK}]*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^{BLANK}"'][^{BLANK}]*))?"""
)
_MAY_HIDE = re.compile("hidden|style", re.I)
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
# A declaration: up to a semicolon outside of strings and brackets.
_DECLARATION = re.compile(
    r"""(?:[^;"'()\\]|\\.|"(?:[^"\\]|\\.)*+(?:"|\Z)|'(?:[^'\\]|\\.)*+(?:'|\Z)"""
    r"""|\((?:[^()"'\\]|\\.|"(?:[^"\\]|\\.)*+"|'(?:[^'\\]|\\.)*+')*+\))++""",
    re.S,
)
_COUNT = re.compile(r"\s*\+?(\d{1,9})")
_START = re.compile(r"\s*\+?(-?\d{1,9})")


def extract_text(pages: DataFrame, html_column: str = "html", text: str = "text") -> DataFrame:
    """`pages` with the visible text of each."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([render(h) for h in texts_of(batch, html_column)], pa.string())]

    return with_columns(pages, [T.StructField(text, T.StringType())], compute)


def render(source: str | None) -> str:
    """The visible text of one page."""
    frame = _Renderer()
    for kind, name, attributes in _events(source or ""):
        if kind == "text":
            frame.text(name)
        elif kind == "start":
            frame.start(name, attributes)
        else:
            frame.end(name)
    return frame.finish()


# --- attributes ----------------------------------------------------------


def _attributes(raw: str) -> dict[str, str]:
    """Values by lower-case name; of a repeated name, the first."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(value.strip(value[0]) if value[:1] in ('"', "'") else value))
    return found


def _look(attributes: str) -> tuple[bool, str]:
    """Whether an element with these attributes is not displayed, and its visibility if stated."""
    if not _MAY_HIDE.search(attributes):
        return False, ""
    found = _attributes(attributes)
    display, visibility = _styles(found.get("style", ""))
    return "hidden" in found or display == "none", visibility


def _styles(style: str) -> tuple[str, str]:
    """The last declarations of display and visibility, important ones first."""
    values: dict[str, tuple[bool, str]] = {}
    for declaration in _DECLARATION.findall(_CSS_COMMENT.sub(" ", style)):
        name, _, value = declaration.partition(":")
        name = name.strip().lower()
        if name in ("display", "visibility"):
            value, _, rank = value.partition("!")
            important = rank.strip().lower() == "important"
            if important or not values.get(name, (False, ""))[0]:
                values[name] = important, value.strip().lower()
    return values.get("display", (False, ""))[1], values.get("visibility", (False, ""))[1]


def _spans(attributes: str) -> tuple[int, int]:
    """Columns and rows of a cell; as many rows as there are if it says 0."""
    if "span" not in attributes.lower():
        return 1, 1
    found = _attributes(attributes)
    columns, rows = (_COUNT.match(found.get(n, "")) for n in ("colspan", "rowspan"))
    return min(max(int(columns[1]), 1), WIDEST) if columns else 1, (int(rows[1]) or 1 << 30) if rows else 1


def _closes_itself(attributes: str) -> bool:
    """Whether the slash at the end of a tag is not part of an unquoted value."""
    end = 0
    for attribute in _ATTRIBUTE.finditer(attributes):
        end = attribute.end()
    return end < len(attributes)


# --- scanner -------------------------------------------------------------


class _Scanner:
    """Finds the tags of a page; every character is read at most twice."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.quoted = True  # until the page turns out to end in a quoted value

    def tag(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """What comes next from `at` on: where it begins and ends, whether it is an end tag, its
        name and its attributes. Comments and the like have no name."""
        source = self.source
        while (begin := source.find("<", at)) >= 0:
            ends = source.startswith("/", begin + 1)
            name = _NAME.match(source, begin + 1 + ends)
            if name:
                end = self._end(name.end())
                if end < 0:
                    return begin, len(source), False, "", ""
                return begin, end + 1, ends, name[0], source[name.end() : end]
            if ends or source.startswith(("!", "?"), begin + 1):
                return begin, self._comment_end(begin), False, "", ""
            at = begin + 1
        return None

    def _end(self, at: int) -> int:
        """Where the tag ends whose name ends at `at`; -1 if the page does first."""
        if self.quoted:
            if found := _QUOTED.match(self.source, at):
                return found.end() - 1
            self.quoted = False
        return self.source.find(">", at)

    def _comment_end(self, begin: int) -> int:
        source = self.source
        if not source.startswith("<!--", begin):
            return source.find(">", begin) + 1 or len(source)
        for whole in ("<!-->", "<!--->"):
            if source.startswith(whole, begin):
                return begin + len(whole)
        found = _COMMENT_END.search(source, begin + 4)
        return found.end() if found else len(source)


# --- tree builder --------------------------------------------------------


def _events(source: str) -> Iterator[tuple[str, str, str]]:
    """Nested events: ("start", name, attributes), ("end", name, ""), ("text", text, "")."""
    open_: list[str] = []
    counts: Counter[str] = Counter()
    bounds: list[int] = []  # where svg, math and what holds HTML in them are open

    def close_to(depth: int) -> Iterator[tuple[str, str, str]]:
        while len(open_) > depth:
            counts[open_[-1]] -= 1
            name = open_.pop()
            if bounds and bounds[-1] == len(open_):
                bounds.pop()
            yield "end", name, ""

    def find(names: set[str], stop: set[str]) -> int:
        """Where the outermost of `names` above the nearest of `stop` is open; -1 if none."""
        found, left = -1, sum(counts[n] for n in names)
        for i in range(len(open_) - 1, -1, -1) if left else ():
            if open_[i] in names:
                found = i
            elif open_[i] in stop:
                break
        return found

    def foreign() -> int:
        """Where the svg or math is open that the place at hand belongs to; -1 if it is HTML."""
        return bounds[-1] if bounds and open_[bounds[-1]] in ("svg", "math") else -1

    def in_head() -> bool:
        return bool(open_) and open_[-1] == "head"

    scanner, at = _Scanner(source), 0
    while (tag := scanner.tag(at)) is not None:
        begin, end, ends, name, attributes = tag
        if begin > at:
            if in_head() and source[at:begin].strip(BLANK):
                yield from close_to(len(open_) - 1)
            yield "text", source[at:begin], ""
        at = end
        if not name:
            continue
        name = name.lower()
        if ends:
            if name == "br":
                if in_head():
                    yield from close_to(len(open_) - 1)
                yield "start", "br", ""
                yield "end", "br", ""
            elif name not in VOID:
                i = find({name}, BREAKS_P if name == "p" else {"table"} if name not in ("table", "body", "html") else set())
                if i >= 0:
                    # The innermost element of this name ends, with all in it.
                    i = len(open_) - 1 - open_[::-1].index(name)
                    yield from close_to(i)
            continue
        if name == "head" and open_ and open_ != ["html"]:
            continue
        if in_head() and name not in IN_HEAD:
            yield from close_to(len(open_) - 1)
        if name in ENDS_FOREIGN:
            while (i := foreign()) >= 0:
                yield from close_to(i)
        if name in CLOSES:
            i = find(*CLOSES[name])
            if i >= 0:
                yield from close_to(i)
        if name in ENDS_P:
            i = find({"p"}, BREAKS_P)
            if i >= 0:
                yield from close_to(i)
        if name in ("td", "th") and find({"tr"}, {"table"}) < 0 and "table" in open_:
            yield "start", "tr", ""
            open_.append("tr")
            counts["tr"] += 1
        if len(open_) >= DEPTH and name not in VOID:
            yield from close_to(DEPTH - 1)
        yield "start", name, attributes
        if name in VOID or (attributes[-1:] == "/" and (name in ("svg", "math") or foreign() >= 0) and _closes_itself(attributes)):
            yield "end", name, ""
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
            if name in ("textarea", "xmp"):
                inside = source[at : end.start() if end else len(source)]
                yield "text", html.escape(inside, quote=False) if name == "xmp" else inside, ""
            at = end.end() if end else len(source)
            yield "end", name, ""
            continue
        if name in ("svg", "math") or name in HTML_WITHIN:
            bounds.append(len(open_))
        open_.append(name)
        counts[name] += 1
    if at < len(source):
        if in_head() and source[at:].strip(BLANK):
            yield from close_to(len(open_) - 1)
        yield "text", source[at:], ""
    yield from close_to(0)


# --- renderer ------------------------------------------------------------


class _Frame:
    """A block under construction: finished lines, the line at hand, and what it is."""

    __slots__ = ("name", "lines", "line", "lead", "gap", "number", "rows", "spans", "pad")

    def __init__(self, name: str, number: int | None = None, spans: tuple[int, int] = (1, 1), pad: bool = True) -> None:
        self.name, self.lines, self.line = name, [], []
        self.spans, self.pad = spans, pad  # of a cell; whether its lines may be indented
        self.lead = self.gap = False  # whether blank lines are due around it
        self.number = number  # of the next item, in ordered lists
        # Cells of a row (text, columns, rows), or rows of a table.
        self.rows: list = []


class _Renderer:
    def __init__(self) -> None:
        self.frames = [_Frame("root")]
        self.hidden = 0
        self.pre = 0
        self.svgs = 0
        self.veiled = 0  # 1 in an svg, outside of what shows text there
        self.shown = True  # by visibility
        self.indents = 0
        # For each open element, what it adds to `hidden` and to `veiled`, and `shown` around it.
        self.depths: list[tuple[int, int, bool]] = []

    def start(self, name: str, attributes: str) -> None:
        off, visibility = _look(attributes) if attributes else (False, "")
        closed = name == "dialog" and "open" not in _attributes(attributes)
        hides = int(off or closed or name in HIDDEN or bool(self.svgs and name in SVG_HIDDEN))
        self.svgs += name == "svg"
        veils = 1 if name == "svg" and not self.veiled else -1 if name in SVG_SHOWN and self.veiled else 0
        self.veiled += veils
        self.hidden += hides + veils
        self.depths.append((hides + veils, veils, self.shown))
        if visibility in ("visible", "hidden", "collapse"):
            self.shown = visibility == "visible"
        if self.hidden:
            return
        if veils:
            self._break()
        if name == "br":
            self._break(force=self.shown)
        elif name in BLOCKS:
            self._break()
            self.pre += name in PRE
            first = _START.match(_attributes(attributes).get("start", "")) if name == "ol" and attributes else None
            number = int(first[1]) if first else 1 if name == "ol" else None
            self.frames.append(_Frame(name, number, _spans(attributes) if name in CELLS else (1, 1), self.indents < INDENTED))
            self.indents += name in INDENTS
            if name == "hr" and self.shown:
                self.frames[-1].lines.append("---")

    def end(self, name: str) -> None:
        hidden, (hides, veils, shown) = self.hidden, self.depths.pop()
        if veils and not hidden:
            self._break()
        self.hidden -= hides
        self.veiled -= veils
        self.svgs -= name == "svg"
        if hidden or name not in BLOCKS:
            self.shown = shown
            return
        self._break()
        self.shown = shown
        self.indents -= name in INDENTS
        self.pre -= name in PRE
        frame = self.frames.pop()
        self._merge(frame, self.frames[-1])

    def text(self, raw: str) -> None:
        if self.hidden or not self.shown:
            return
        text = html.unescape(raw) if "&" in raw else raw
        line = self.frames[-1].line
        if self.pre:
            first, *rest = text.split("\n")
            line.append(first)
            for more in rest:
                self._break(force=True)
                self.frames[-1].line.append(more)
            return
        line.append(text)

    def finish(self) -> str:
        self._break()
        return "\n".join(self.frames[0].lines).strip("\n")

    def _break(self, force: bool = False) -> None:
        """End the line at hand, if it has text or must."""
        frame = self.frames[-1]
        whole = "".join(frame.line)
        frame.line.clear()
        if not self.pre:
            whole = _SPACE.sub(" ", whole).strip(" ")
        elif not force:
            whole = whole.rstrip()
        if whole or (force and frame.lines and not frame.gap):
            self._append(frame, [whole])

    @staticmethod
    def _append(frame: _Frame, lines: list[str], before: bool = False, after: bool = False) -> None:
        if not frame.lines:
            frame.lead = before
        elif (before or frame.gap) and frame.lines[-1]:
            frame.lines.append("")
        frame.lines += lines
        frame.gap = after

    def _merge(self, frame: _Frame, parent: _Frame) -> None:
        """Put a finished block into the one around it."""
        name, lines = frame.name, frame.lines
        while lines and not lines[-1].strip():
            lines.pop()
        if name in CELLS:
            if parent.name == "tr":
                parent.rows.append((" ".join(x.strip() for x in lines if x.strip()), *frame.spans))
                return
        elif name == "tr":
            cells = [*frame.rows, *((line, 1, 1) for line in lines)]
            if parent.name in ("table", "thead", "tbody", "tfoot"):
                parent.rows.append(cells)
            elif cells:
                self._append(parent, [" ".join(text for text, _, _ in cells)])
            return
        elif name in ("thead", "tbody", "tfoot") and parent.name == "table":
            parent.rows += frame.rows
            if lines:
                self._append(parent, lines)
            return
        elif name == "table":
            lines = lines + _aligned(frame.rows)
        elif name == "li":
            mark = "- "
            if parent.number is not None:
                mark = f"{parent.number}. "
                parent.number += 1
            pad = " " * len(mark) if frame.pad else ""
            lines = [(mark if i == 0 else pad if x else "") + x for i, x in enumerate(lines)] or []
        elif name in ("blockquote", "dd"):
            lines = ["  " + x if x and frame.pad else x for x in lines]
        if lines:
            # A list in a list item or another list stands close.
            close = name == "li" or (name in ("ul", "ol") and parent.name in ("li", "ul", "ol"))
            spaced = name in SPACED
            self._append(parent, lines, not close and (spaced or frame.lead), not close and (spaced or frame.gap))


def _aligned(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """A table's rows with cells padded to the widest of their column, or to their columns."""
    placed = _placed(rows)
    # Columns in which no cell begins have no width of their own.
    begins = sorted({at for row in placed for at, _, _ in row})
    number = {at: i for i, at in enumerate(begins)}
    row_cells = [[(number[at], bisect_left(begins, at + wide), text) for at, wide, text in row] for row in placed]
    widths = [0] * len(begins)
    for row in row_cells:
        for i, j, text in row:
            if j == i + 1:
                widths[i] = max(widths[i], min(len(text), PADDED))
    edges = list(accumulate((w + 3 for w in widths), initial=0))
    for row in row_cells:
        for i, j, text in row:
            if j > i + 1 and (lack := min(len(text), PADDED) - (edges[j] - edges[i] - 3)) > 0:
                widths[j - 1] = max(widths[j - 1], edges[j] - edges[j - 1] - 3 + lack)
    edges = list(accumulate((w + 3 for w in widths), initial=0))
    out = []
    for row in row_cells:
        parts, column = [], 0
        for i, j, text in row:
            parts += [" " * w for w in widths[column:i]]
            parts.append(text.ljust(min(edges[j] - edges[i] - 3, PADDED)))
            column = j
        if row:
            out.append(" | ".join(parts).rstrip())
    return out


def _placed(rows: list[list[tuple[str, int, int]]]) -> list[list[tuple[int, int, str]]]:
    """First column, number of columns and text of the cells of each row, past those that
    cells of rows above hold."""
    held: dict[int, int] = {}  # column -> first row in which it is free again
    out = []
    for r, row in enumerate(rows):
        column, cells = 0, []
        for text, wide, high in row:
            while held.get(column, 0) > r:
                column += 1
            cells.append((column, wide, text))
            if high > 1:
                # A wide cell may run into one that hangs down further.
                held |= {c: max(held.get(c, 0), r + high) for c in range(column, min(column + wide, SPANNED))}
            column += wide
        out.append(cells)
    return out

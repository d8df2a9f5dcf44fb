"""HTML to text as a page would show it.

A tokenizer cuts the page into tags, text and comments.  A tree builder closes what HTML lets
stay open (paragraphs, list items, table cells and the like) and drops end tags that close
nothing, so that what it gives is nested.  The renderer leaves out what is not visible and keeps
the layout: blank lines between blocks, list markers with indent, line breaks, preformatted text,
and table cells aligned in columns.  Of drawings it keeps the labels, of formulas the characters.

Every page is rendered on its own, by a loop with explicit stacks, in time of the length of the
page and of its text: the places of the open elements are kept by name, and lines are lists of
pieces.  All columns of a table are aligned, so the text of a table is as long as its rows times
its width.

Visibility is told by the attributes of the elements: `hidden`, and `display` and `visibility` in
`style`.  Style sheets are not read, and what is inside a hidden element stays hidden even if it
is said to be visible.

Edge cases: a null page gives empty text; an unclosed comment, tag or script hides the rest of
the page, as in a browser; text without tags is one block; repeated rows are rendered alike; an
empty table gives no rows.  Further columns are not looked at.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Names from the HTML standard.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
HIDDEN = {"head", "script", "style", "template", "noscript", "title", "iframe", "noembed",
          "noframes", "object", "audio", "video", "canvas", "datalist",
          "math/annotation", "math/annotation-xml", "math/annotation-html", "math/mphantom",
          *(f"svg/{x}" for x in ("clippath", "defs", "desc", "filter", "lineargradient", "marker",
                                 "mask", "metadata", "pattern", "radialgradient", "script", "style",
                                 "symbol", "title"))}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog",
          "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1",
          "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li",
          "listing", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search",
          "section", "summary", "table", "ul", "caption", "tr", "xmp"}
# Blocks with a blank line around them.
SPACED = {"blockquote", "dl", "fieldset", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "listing",
          "menu", "ol", "p", "pre", "table", "ul"}
# A start tag of the key ends an open element of the value, unless one of LIMITS is between.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "optgroup": {"option", "optgroup"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "thead": {"tr", "td", "th", "thead", "tbody", "tfoot", "caption"},
    "tbody": {"tr", "td", "th", "thead", "tbody", "tfoot", "caption"},
    "tfoot": {"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, "body": {"head"},
}
LIMITS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"},
          "optgroup": {"select"}}
# What may stand in a head; all else ends it.
IN_HEAD = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noframes", "noscript",
           "script", "style", "template", "title"}
# Elements within svg and math are named svg/x and math/x.  Where HTML goes on inside of them, and
# the HTML tags that end them elsewhere.
FOREIGN = ("svg/", "math/")
HTML_INSIDE = {"svg/foreignobject", "svg/desc", "svg/title", "math/mi", "math/mo", "math/mn",
               "math/ms", "math/mtext", "math/annotation-html"}
NOT_FOREIGN = {"b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt",
               "em", "embed", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "i", "img", "li",
               "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small", "span",
               "strike", "strong", "sub", "sup", "table", "tt", "u", "ul", "var"}
# In a drawing only these show their text; in a formula blanks count only in some.
DRAWN = {"svg/svg": False, "svg/text": True, "svg/foreignobject": True}
APART = {"svg/text", "svg/foreignobject", "math/mtr", "math/mtd"}
# To the end of its group.
TO_THE_END = 1 << 40
MOST_ROWS = 65534
# Texts are handed on when so many characters are held.
HELD_CHARS = 1 << 24
NOT_IN_PARAGRAPH = BLOCKS - {"body", "html", "option", "optgroup", "legend", "caption", "tr"}

# A quote opens a value only right after the equals sign; elsewhere it is a character like others.
_ATTR_NAME, _EQUALS = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+", r"[ \t\n\r\f]*+=[ \t\n\r\f]*+"
_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^ \t\n\r\f/>]*+)"
    rf"(?P<attrs>(?:[ \t\n\r\f]++|/(?!>)|{_ATTR_NAME}(?:{_EQUALS}(?:\"[^\"]*+(?:\"|\Z)"
    r"|'[^']*+(?:'|\Z)|(?![\"'])[^ \t\n\r\f>]*+))?+)*+)(?P<close>/?>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(
    rf"({_ATTR_NAME})(?:{_EQUALS}(?:\"([^\"]*)\"|'([^']*)'|([^ \t\n\r\f>]*+)))?+")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b",
                     re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")

OPEN, TEXT, CLOSE = "open", "text", "close"


def tokens(page: str, above: list[str]) -> Iterator[tuple]:
    """(OPEN, tag, attributes, closes itself), (CLOSE, tag) and (TEXT, characters), in order.

    above: the open elements, which the reader of the tokens keeps.
    """
    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        start = found.start() if found else size
        if start > at:
            yield TEXT, html.unescape(page[at:start])
        if not found:
            return
        at = found.end()
        if above and above[-1].startswith(FOREIGN) and page.startswith("<![CDATA[", start):
            stop = page.find("]]>", start)
            stop = size if stop < 0 else stop
            yield TEXT, page[start + 9:stop]
            at = stop + 3
            continue
        if not found["tag"] or (found["close"] == "" and at == size):
            continue
        tag = found["tag"].lower()
        if found["end"]:
            yield CLOSE, tag
            continue
        attrs = {}
        for name, *values in _ATTR.findall(found["attrs"]) if found["attrs"].strip() else ():
            attrs.setdefault(name.lower(), html.unescape("".join(values)))
        yield OPEN, tag, attrs, found["close"] == "/>"
        if tag in RAW and above[-1:] == [tag]:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            stop = end.start() if end else size
            if tag in ("textarea", "title", "xmp"):
                yield TEXT, page[at:stop] if tag == "xmp" else html.unescape(page[at:stop])
            at = stop


def tree(page: str) -> Iterator[tuple]:
    """The same, nested: every OPEN has its CLOSE, in order, the implied ones too."""
    above: list[str] = []
    places: dict[str, list[int]] = {}  # of the open elements, by name

    def push(tag: str) -> None:
        places.setdefault(tag, []).append(len(above))
        above.append(tag)

    def pop() -> str:
        tag = above.pop()
        places[tag].pop()
        return tag

    def close_to(depth: int) -> Iterator[tuple]:
        while len(above) > depth:
            yield CLOSE, pop()

    def last(tags: set[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def innermost(tags: set[str], limits: set[str]) -> int:
        found = last(tags)
        return found if found >= 0 and found >= last(limits) else -1

    def foreign() -> bool:
        return bool(above) and above[-1].startswith(FOREIGN) and above[-1] not in HTML_INSIDE

    for event in tokens(page, above):
        if event[0] == TEXT:
            if above[-1:] == ["head"] and event[1].strip(" \t\n\r\f"):
                yield CLOSE, pop()
            yield event
            continue
        tag = event[1]
        if event[0] == OPEN:
            attrs = event[2]
            if foreign() and (tag in NOT_FOREIGN or tag == "font" and attrs.keys() & {
                    "color", "face", "size"}):
                while foreign():
                    yield CLOSE, pop()
            if above[-1:] == ["head"] and tag not in IN_HEAD:
                yield CLOSE, pop()
            if foreign() or tag in ("svg", "math"):
                kind = tag if tag in ("svg", "math") else above[-1].split("/")[0]
                if tag == "annotation-xml" and attrs.get("encoding", "").lower() in (
                        "text/html", "application/xhtml+xml"):
                    tag = "annotation-html"
                yield OPEN, f"{kind}/{tag}", attrs
                if event[3]:
                    yield CLOSE, f"{kind}/{tag}"
                else:
                    push(f"{kind}/{tag}")
                continue
            if tag in NOT_IN_PARAGRAPH and (p := innermost(
                    {"p"}, {"td", "th", "table", "button"} | HTML_INSIDE)) >= 0:
                yield from close_to(p)
            limits = LIMITS[tag] | HTML_INSIDE if tag in LIMITS else {"table"}
            while tag in CLOSES and (i := innermost(CLOSES[tag], limits)) >= 0:
                yield from close_to(i)
            yield OPEN, tag, attrs
            if tag in VOID:
                yield CLOSE, tag
            else:
                push(tag)
        elif tag == "br":  # as browsers take it
            while foreign():
                yield CLOSE, pop()
            if above[-1:] == ["head"]:
                yield CLOSE, pop()
            yield OPEN, "br", {}
            yield CLOSE, "br"
        elif tag not in VOID:
            limits = set() if tag in ("table", "body", "html") else {"table"}
            if tag in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption"):
                limits = {"table"}
            names = {tag, f"svg/{tag}", f"math/{tag}"}
            if tag == "annotation-xml":
                names.add("math/annotation-html")
            if limits:
                limits = limits | HTML_INSIDE
            if (i := innermost(names, limits - names)) >= 0:
                yield from close_to(i)
    yield from close_to(0)


def _width(text: str) -> int:
    """Columns on a screen: wide characters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF"
               else 1 for c in text)


class _Flow:
    """Lines of one block context: the page, or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.pieces: list[str] = []  # of the line at hand
        self.last = ""  # its last character
        self.gap = 0  # blank lines asked for before the next line
        self.indent = 0
        self.marker = ""

    def add(self, text: str) -> None:
        if text:
            self.pieces.append(text)
            self.last = text[-1]

    def write(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.add(first)
            for part in rest:
                self.break_line(True)
                self.add(part)
            return
        text = _SPACES.sub(" ", text)
        if self.last in ("", " "):
            text = text.lstrip(" ")
        self.add(text)

    def break_line(self, keep_empty: bool = False) -> None:
        line = "".join(self.pieces).rstrip(" ")
        if line or (keep_empty and (self.last or self.lines)):
            if self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            lead = "  " * self.indent
            if self.marker:
                lead = "  " * max(0, self.indent - 1) + self.marker
                self.marker = ""
            self.lines.append((lead + line).rstrip(" "))
        self.pieces, self.last = [], ""

    def space(self, blank: bool) -> None:
        self.break_line()
        self.gap = max(self.gap, int(blank))

    def text(self) -> str:
        self.break_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return "\n".join(self.lines)


def _number(text: str | None, most: int = 1000) -> int:
    return min(most, max(1, int(text))) if text and text.strip().isdecimal() else 1


# Blanks side by side, as a chain: those before the last one, its first column, the column behind.
_Run = tuple["_Run | None", int, int]


def _pieces(run: _Run | None) -> list[tuple[int, int]]:
    out = []
    while run:
        run, first, stop = run
        out.append((first, stop))
    return out[::-1]


def _chained(run: _Run | None, pieces: list[tuple[int, int]]) -> _Run | None:
    for first, stop in pieces:
        run = (run, first, stop)
    return run


def _from(run: _Run, first: int, at: int) -> _Run | None:
    """What is left of a run that begins at `first`, from column `at` on; before it, a gap belongs
    to the first blank."""
    if first == at:
        return run
    left = [p for p in _pieces(run) if p[1] > at]
    return _chained(None, [(at, left[0][1]), *left[1:]])


def _placed(rows: list[list | None]) -> list[list[tuple[int, int, str | None, _Run | None]]]:
    """(first column, column behind, text, blanks) of each row without gaps: blanks, then without
    a text, stand where cells from above reach down.  None is the border of a row group, where
    such cells end.

    Neighbours that end with the same row are one run, which rows share.
    """
    out, taken = [], []  # (first column, column behind, row behind, blanks)
    for number, row in enumerate(rows):
        if row is None:
            taken = []
            continue
        line, fresh, at, k = [], [], 0, 0
        for text, span, down in row:
            while k < len(taken) and taken[k][0] <= at:
                if taken[k][1] > at:
                    line.append((at, taken[k][1], None, _from(taken[k][3], taken[k][0], at)))
                    at = taken[k][1]
                k += 1
            line.append((at, at + span, text, None))
            if down > 1:
                end = down if down == TO_THE_END else number + down
                fresh.append((at, at + span, end, (None, at, at + span)))
            at += span
        for first, stop, _, run in taken[k:] if row else ():
            if stop > at:
                line.append((at, stop, None, _from(run, first, at)))
                at = stop
        taken = [t for t in taken if t[2] > number + 1]
        if fresh:
            taken = _joined(sorted(taken + fresh, key=lambda t: t[:3]))
        out.append(line)
    return out


def _joined(taken: list[tuple[int, int, int, _Run]]) -> list[tuple[int, int, int, _Run]]:
    out: list[tuple[int, int, int, _Run]] = []
    for first, stop, end, run in taken:
        if out and out[-1][1] == first and out[-1][2] == end:
            out[-1] = (out[-1][0], stop, end, _chained(out[-1][3], _pieces(run)))
        else:
            out.append((first, stop, end, run))
    return out


def _laid_out(rows: list[list[tuple[str, int, int]] | None]) -> list[str]:
    """The rows of a table with all columns aligned; cells of several lines take several lines.

    Columns in which no cell begins have no width.
    """
    placed = _placed(rows)
    starts = sorted({a for row in placed for a, _, text, _ in row if text is not None})
    widths = [0] * len(starts)
    table = []
    for row in placed:
        cells = []
        for first, stop, text, run in row:
            a, b = bisect_left(starts, first), bisect_left(starts, stop)
            if b > a:
                cells.append((text, run, a, b))
                if b == a + 1 and text:
                    widths[a] = max(widths[a], max(map(_width, text.split("\n"))))
        table.append(cells)
    upto = [0]
    for width in widths:
        upto.append(upto[-1] + width + 3)
    told: dict[int, str | None] = {}  # by the run's id

    def blanks(run: _Run) -> str | None:
        """A run as text; what a run goes on from is put together once."""
        todo, before = [], run
        while before and id(before) not in told:
            todo.append(before)
            before = before[0]
        text = told[id(before)] if before else None
        for part in reversed(todo):
            a, b = bisect_left(starts, part[1]), bisect_left(starts, part[2])
            if b > a:
                blank = " " * (upto[b] - upto[a] - 3)
                text = blank if text is None else f"{text} | {blank}"
            told[id(part)] = text
        return text

    lines = []
    for row in table:
        cells = [(blanks(run) if text is None else text.split("\n"), upto[b] - upto[a] - 3)
                 for text, run, a, b in row]
        for i in range(max((1 if isinstance(c, str) else len(c) for c, _ in cells), default=0)):
            line = []
            for cell, room in cells:
                if isinstance(cell, str):
                    line.append(cell)
                    continue
                part = cell[i] if i < len(cell) else ""
                line.append(part + " " * (room - _width(part)))
            lines.append(" | ".join(line).rstrip(" "))
    return lines


def render(page: str) -> dict:
    """text, and the number of blocks, list items and table cells shown."""
    flows, tables, lists, counts = [_Flow()], [], [], {"blocks": 0, "items": 0, "cells": 0}
    unseen, pre, kinds = 0, 0, []
    for event in tree(page):
        flow = flows[-1]
        if event[0] == TEXT:
            inside, _, drawn = kinds[-1] if kinds else ("", False, True)
            blank = inside.startswith("math/") and inside not in HTML_INSIDE and not event[1].strip()
            if not unseen and drawn and not blank:
                flow.write(event[1], pre > 0)
            continue
        tag = event[1]
        if event[0] == OPEN:
            attrs = event[2]
            hides = (tag in HIDDEN or "hidden" in attrs or bool(_UNSEEN.search(
                attrs.get("style", ""))) or (tag == "dialog" and "open" not in attrs)
                     or (tag.startswith("svg/") and (attrs.get("display") == "none" or attrs.get(
                         "visibility") in ("hidden", "collapse"))))
            kinds.append((tag, hides, DRAWN.get(tag, kinds[-1][2] if kinds else True)))
            unseen += hides
            if unseen:
                continue
            if tag in APART:
                flow.write(" ", False)
            elif tag == "br":
                flow.break_line(True)
            elif tag == "img" and attrs.get("alt", "").strip():
                flow.write(attrs["alt"], False)
            elif tag in ("td", "th") and tables:
                if not tables[-1] or tables[-1][-1] is None:
                    tables[-1].append([])
                down = attrs.get("rowspan", "").strip()
                tables[-1][-1].append(["", _number(attrs.get("colspan")),
                                       TO_THE_END if down == "0" else _number(down, MOST_ROWS)])
                flows.append(_Flow())
                counts["cells"] += 1
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("thead", "tbody", "tfoot") and tables:
                tables[-1].append(None)
            elif tag == "hr":
                flow.space(False)
                flow.add("---")
                flow.space(False)
            elif tag in BLOCKS:
                flow.space(tag in SPACED and not lists or tag in SPACED and tag not in (
                    "ul", "ol", "menu", "dl"))
                counts["blocks"] += 1
                if tag in ("ul", "ol", "menu", "dir"):
                    lists.append([tag, _number(attrs.get("start"), 10 ** 9)])
                    flow.indent += 1
                elif tag == "li":
                    counts["items"] += 1
                    flow.marker = "- "
                    if lists and lists[-1][0] == "ol":
                        flow.marker = f"{lists[-1][1]}. "
                        lists[-1][1] += 1
                elif tag in ("blockquote", "dd"):
                    flow.indent += 1
                elif tag == "table":
                    tables.append([])
                if tag in ("pre", "listing", "xmp"):
                    pre += 1
            elif tag == "textarea":
                pre += 1
            continue
        _, hid, _ = kinds.pop()
        seen, unseen = not unseen, unseen - hid
        if not seen or tag in VOID:
            continue
        if tag in APART:
            flow.write(" ", False)
        elif tag in ("td", "th") and tables:
            tables[-1][-1][-1][0] = flows.pop().text()
        elif tag == "tr" and tables:
            pass
        elif tag in BLOCKS:
            if tag == "li" and flow.marker and not flow.last:
                flow.marker = ""  # an item without text
            flow.space(tag in SPACED and not (tag in ("ul", "ol", "menu", "dl")
                                              and len(lists) > 1))
            if tag in ("ul", "ol", "menu", "dir") and lists:
                lists.pop()
                flow.indent -= 1
            elif tag in ("blockquote", "dd"):
                flow.indent -= 1
            elif tag == "table" and tables:
                for line in _laid_out(tables.pop()):
                    flow.add(line)
                    flow.break_line(True)
                flow.space(True)
            if tag in ("pre", "listing", "xmp"):
                pre -= 1
        elif tag == "textarea":
            pre -= 1
    return {"text": flows[0].text(), **counts}


RESULT = pa.schema([("page_id", pa.int64()), ("text", pa.string()), ("n_blocks", pa.int64()),
                    ("n_items", pa.int64()), ("n_cells", pa.int64())])


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(part: pa.RecordBatch, done: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([d["text"] for d in done], pa.string()),
             *(pa.array([d[k] for d in done], pa.int64())
               for k in ("blocks", "items", "cells"))], schema=RESULT)

    for batch in batches:
        done, held, first = [], 0, 0
        for at, page in enumerate(batch.column(1)):
            done.append(render(page.as_py() or ""))
            held += len(done[-1]["text"])
            if len(done) == 256 or held >= HELD_CHARS:
                yield rows(batch.slice(first, len(done)), done)
                done, held, first = [], 0, at + 1
        if done:
            yield rows(batch.slice(first, len(done)), done)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_blocks, n_items, n_cells for each row of `pages`."""
    return pages.selectExpr("cast(page_id as bigint) page_id", "html").mapInArrow(
        _rendered, "page_id long, text string, n_blocks long, n_items long, n_cells long")

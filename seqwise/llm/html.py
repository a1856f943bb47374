"""Layout-aware rendering of HTML: all visible text, laid out as plain lines.

A tag reader feeds a tree builder that keeps the stack of open elements: missing
end tags are implied (a paragraph ends before a block, an item before the next
item, a cell before the next cell or row), and stray end tags are ignored.
Elements that show nothing (head, script, templates ...), content that stands in
for what a browser shows otherwise (of video, object, canvas ...) and elements
hidden by attribute or style are skipped with all they hold; a closed ``details``
shows its summary only. Formulas show their text without annotations, drawings
(``svg``) their text elements, ``textarea`` and ``xmp`` their content as it is,
and ``select`` all its options, each on a line, unless ``options`` is off. Blocks stand on lines of their own, paragraphs, headings,
lists and tables with an empty line around; list items have a bullet or number
and are indented by depth; white space is collapsed except in ``pre``; the cells
of a table are aligned in columns, wide characters counting two: a cell over
several columns widens them if it must, one over several rows stands in the
first and keeps its columns free below.

Style sheets (``style`` elements, all or screen media) hide what their rules of
plain selectors (element, classes, id) say, from the sheet on; the last rule of
a selector counts, and a ``display`` or ``visibility`` of the element's own style goes before.
Rules with combinators or pseudo-classes, or inside at-rules, are passed over.

Everything works on an explicit stack with the places of its open elements by
tag, in one pass over the whole page: a tag costs the same at any depth.

Defined results: null or empty pages give empty text; repeated rows are rendered
row by row; extra columns stay (one named like an output is replaced).
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import batches_by_bytes

# comment, declaration, or a tag with its attributes; comments and declarations without an end run to the end.
# A quote opens a value only after the "=" of an attribute, and if another one closes it; elsewhere it is a
# character of a name or value
_ATTRIBUTE = r"""([^ \t\n\r\f/>][^ \t\n\r\f/>=]*)(?:[ \t\n\r\f]*=[ \t\n\r\f]*("[^"]*"|'[^']*'|[^ \t\n\r\f"'>][^ \t\n\r\f>]*)?)?"""
_INSIDE = _ATTRIBUTE.replace("([^", "(?:[^", 1).replace('("[', '(?:"[', 1)
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^ \t\n\r\f/>]*)((?:[ \t\n\r\f/]|{_INSIDE})*+)>", re.S)
UNTAGGED = re.compile(r"<!--.*|<[!?].*", re.S)     # where no ">" follows
ATTRIBUTE = re.compile(_ATTRIBUTE)
SPACE = re.compile(r"[ \t\n\r\f]+")
HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)

RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
SILENT = {"head", "script", "style", "title", "template", "noscript", "noembed", "noframes", "iframe", "object", "video",
          "audio", "canvas", "datalist"}
UNDRAWN = {"defs", "symbol", "clippath", "mask", "pattern", "marker", "metadata", "desc"}     # inside svg
DRAWN = {"text", "foreignobject"}                                                            # its text is in these
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
MARGIN = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "pre", "blockquote", "table", "figure", "hr", "menu"}
BLOCK = MARGIN | {"address", "article", "aside", "body", "center", "dd", "details", "dialog", "div", "dt", "fieldset",
                  "figcaption", "footer", "form", "header", "hgroup", "html", "legend", "li", "main", "nav", "option",
                  "search", "section", "summary", "caption", "tr", "td", "th", "thead", "tbody", "tfoot"}
CELLS, ROWS, SECTIONS = {"td", "th"}, {"tr"}, {"thead", "tbody", "tfoot", "caption", "colgroup"}
# a start tag ends the open elements of the first set, looked for up to one of the second
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "td": (CELLS, {"tr", "table"}), "th": (CELLS, {"tr", "table"}),
    "tr": (CELLS | ROWS | {"caption", "colgroup"}, {"table"}),
    **{s: (CELLS | ROWS | SECTIONS, {"table"}) for s in SECTIONS},
    "body": ({"head"}, {"html"}),
}
SCOPE = {"td", "th", "table", "caption", "html", "button"}

SHOWING = re.compile(r"(?:^|;)\s*(?:display|visibility)\s*:", re.I)
SELECTOR = re.compile(r"([a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)")
COLUMNS, ROWS_MOST = 1000, 65534                   # the bounds that HTML sets on spans


def width_of(line: str) -> int:
    """Columns that a line takes: wide characters two, combining marks none."""
    if line.isascii():
        return len(line)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in line)


def style_rules(css: str) -> Iterator[tuple[str, str]]:
    """(selector, declarations) of the rules of a sheet outside of at-rules."""
    css = re.sub(r"/\*.*?(?:\*/|\Z)", " ", css, flags=re.S)
    depth, begin, body = 0, 0, 0
    for m in re.finditer("[{};]", css):
        if m[0] == "{":
            if not depth:
                body = m.end()
            depth += 1
        elif m[0] == "}":
            depth = max(0, depth - 1)
            if not depth:
                head, _, _ = css[begin:body].rpartition("{")
                if head.strip() and not head.lstrip().startswith("@"):
                    for one in head.split(","):
                        yield one.strip(), css[body:m.start()]
                begin = body = m.end()
        elif not depth:
            begin = body = m.end()


class Lines:
    """Lines of one flow of text: the page or one table cell."""

    def __init__(self):
        self.done: list[str] = []
        self.now: list[str] = []
        self.blank = False                         # the current line ends with a space or is empty
        self.gap = 0                               # empty lines wanted before the next text
        self.indent = 0
        self.marker = ""

    def text(self, s: str) -> None:
        s = SPACE.sub(" ", s)
        if not self.now or self.blank:
            s = s.removeprefix(" ")
        if s:
            self.now.append(s)
            self.blank = s.endswith(" ")

    def newline(self, keep_empty: bool = False) -> None:
        line = "".join(self.now).rstrip(" ")
        self.now, self.blank = [], False
        if line or keep_empty:
            if self.gap and self.done:
                self.done += [""] * self.gap
            self.gap = 0
            lead = " " * (self.indent - len(self.marker)) + self.marker
            self.marker = ""
            self.done.append((lead + line).rstrip(" "))

    def margin(self, n: int) -> None:
        self.newline()
        self.gap = max(self.gap, n)

    def pre(self, s: str) -> None:
        first, *rest = s.replace("\r\n", "\n").split("\n")
        self.now.append(first)
        for line in rest:
            self.newline(keep_empty=True)
            self.now.append(line)

    def finished(self) -> list[str]:
        self.newline()
        return self.done


class Table:
    def __init__(self):
        self.rows: list[list[tuple[Lines, int, int]]] = []     # cells (content, columns, rows)
        self.sections: set[int] = set()            # rows that begin a section: no cell reaches into it from above
        self.caption = Lines()

    def placed(self) -> list[list[tuple[int, int, list[str]]]]:
        """Cells (first column, column after it, lines) of every row."""
        out = []
        taken: list[tuple[int, int, int]] = []     # columns [a, b) taken up to a row, in order
        for r, row in enumerate(self.rows):
            taken = [] if r in self.sections else [t for t in taken if t[2] > r]
            cells, more, at, k = [], [], 0, 0
            for flow, columns, rows in row:
                while k < len(taken) and taken[k][0] <= at:
                    at = max(at, taken[k][1])
                    k += 1
                cells.append((at, at + columns, flow.finished()))
                if rows != 1:
                    last = r + rows if rows else len(self.rows)
                    if more and more[-1][1] == at and more[-1][2] == last:
                        more[-1] = (more[-1][0], at + columns, last)
                    else:
                        more.append((at, at + columns, last))
                at += columns
            if more:
                taken = sorted(taken + more)
            out.append(cells)
        return out

    def rendered(self) -> list[str]:
        rows = self.placed()
        # only columns in which a cell begins take room
        begins = sorted({a for row in rows for a, _, _ in row})
        number = {a: k for k, a in enumerate(begins)}
        width = [0] * len(begins)
        wide = []
        for row in rows:
            for a, b, lines in row:
                need = max(map(width_of, lines), default=0)
                first, after = number[a], bisect_right(begins, b - 1)
                if after - first == 1:
                    width[first] = max(width[first], need)
                elif need:
                    wide.append((after - first, first, after, need))
        for _, first, after, need in sorted(wide):  # the last column makes up what is missing
            width[after - 1] += max(0, need - sum(width[first:after]) - 2 * (after - first - 1))
        start = [0]
        for w in width:
            start.append(start[-1] + w + 2)
        out = self.caption.finished()
        for row in rows:
            for i in range(max((len(lines) for _, _, lines in row), default=0)):
                parts, filled = [], 0
                for a, _, lines in row:
                    if i < len(lines) and lines[i]:
                        parts += [" " * (start[number[a]] - filled), lines[i]]
                        filled = max(filled, start[number[a]]) + width_of(lines[i])
                out.append("".join(parts).rstrip())
        return out


class Renderer:
    def __init__(self, options: bool = True):
        self.options = options
        self.drawings: list[int] = []              # open svg elements: open text elements of each
        self.formulas = 0
        self.stack: list[tuple[str, object]] = []  # open elements: (tag, what to restore)
        self.places: dict[str, list[int]] = {}     # places of the open elements of a tag, ascending
        self.sheet: dict[str, dict[tuple, bool]] = {}   # id, class or tag -> selectors with it: do they hide
        self.flows = [Lines()]
        self.tables: list[Table] = []
        self.hidden = 0                            # open elements that hide
        self.pres = 0
        self.lists: list[int | None] = []          # next number, or None for bullets

    # tree builder
    def close(self, to: int) -> None:
        """End the open elements from place ``to`` on."""
        while len(self.stack) > to:
            tag, kept = self.stack.pop()
            self.places[tag].pop()
            self.leave(tag, kept)

    def last(self, tags: set[str]) -> int:
        """Place of the innermost open element of ``tags``, or -1."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def outermost(self, tags: set[str], until: set[str]) -> int | None:
        """Place of the outermost of ``tags`` that is open inside ``until``."""
        limit = self.last(until)
        inside = [p[bisect_right(p, limit)] for t in tags if (p := self.places.get(t)) and p[-1] > limit]
        return min(inside, default=None)

    def start(self, tag: str, attributes: str) -> None:
        if tag in IMPLIED:
            at = self.outermost(*IMPLIED[tag])
            if at is not None:
                self.close(at)
        if tag in BLOCK:
            open_p = self.places.get("p")          # a block ends an open paragraph of its scope
            if open_p and open_p[-1] > self.last(SCOPE):
                self.close(open_p[-1])
        if tag in CELLS and self.tables and self.outermost(ROWS, {"table"}) is None:
            self.start("tr", "")                   # the row is implied
        hides = self.hides(tag, attributes)
        if tag in VOID:
            if not self.hidden and not hides:
                self.void(tag, attributes)
            return
        kept = self.enter(tag, attributes, hides)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, kept))
        if (self.drawings or self.formulas) and attributes.endswith("/"):
            self.close(len(self.stack) - 1)        # only foreign elements can end themselves

    def end(self, tag: str) -> None:
        until = set() if tag in ("table", "body", "html") else {"table"} if tag in CELLS | ROWS | SECTIONS else \
            SCOPE - {tag} if tag != "button" else {"table"}
        at = self.last({tag})
        if at > self.last(until):
            self.close(at)

    @staticmethod
    def attributes(s: str) -> dict[str, str]:
        out: dict[str, str] = {}
        for k, v in ATTRIBUTE.findall(s):
            out.setdefault(k.lower(), html.unescape(v[1:-1] if v[:1] in ("'", '"') else v))
        return out

    def hides(self, tag: str, attributes: str) -> bool:
        if tag in SILENT or tag == "select" and not self.options or self.drawings and tag in UNDRAWN \
                or self.formulas and tag in ("annotation", "annotation-xml"):
            return True
        if self.stack and self.stack[-1][0] == "details" and tag != "summary" and self.stack[-1][1] == "shut":
            return True
        if tag != "dialog" and tag not in self.sheet and not attributes.strip(" /"):
            return False
        a = self.attributes(attributes)
        style = a.get("style", "")
        return "hidden" in a or bool(HIDING.search(style)) or tag == "dialog" and "open" not in a \
            or bool(self.sheet) and not SHOWING.search(style) and self.hidden_by_sheet(tag, a)

    def hidden_by_sheet(self, tag: str, a: dict[str, str]) -> bool:
        own, classes = "#" + a.get("id", ""), {"." + c for c in a.get("class", "").split()}
        return any(hide and of in ("", tag) and parts <= classes | {own}
                   for key in (own, *classes, tag) for (of, parts), hide in self.sheet.get(key, {}).items())

    def read_sheet(self, attributes: str, css: str) -> None:
        """Rules of plain selectors that hide, or show again what an earlier one hid."""
        media = self.attributes(attributes).get("media", "all").strip().lower()
        if media not in ("", "all", "screen") or self.places.get("template") or self.places.get("noscript"):
            return
        for selector, declared in style_rules(css):
            m = SELECTOR.fullmatch(selector)
            if m is None or not selector or not SHOWING.search(declared):
                continue
            of, parts = (m[1] or "").lower(), frozenset(re.findall(r"[.#][\w-]+", m[2]))
            ids = sorted(x for x in parts if x[0] == "#")
            self.sheet.setdefault(ids[0] if ids else min(parts, default=of), {})[of, parts] = bool(HIDING.search(declared))

    # rendering
    def spans(self, attributes: str) -> tuple[int, int]:
        """(columns, rows) of a cell; no rows: to the end of its section."""
        if "span" not in attributes.lower():
            return 1, 1
        a = self.attributes(attributes)

        def number(name: str, least: int, most: int) -> int:
            m = re.match(r"[ \t\n\r\f]*\+?([0-9]{1,9})", a.get(name, ""))
            return 1 if m is None or int(m[1]) < least else min(int(m[1]), most)
        return number("colspan", 1, COLUMNS), number("rowspan", 0, ROWS_MOST)

    @property
    def flow(self) -> Lines:
        return self.flows[-1]

    def enter(self, tag: str, attributes: str, hides: bool) -> object:
        if hides or self.hidden:
            self.hidden += 1
            return "hidden"
        if tag == "svg":
            self.drawings.append(0)
            return "drawing"
        if tag in DRAWN and self.drawings:
            self.flow.text(" ")
            self.drawings[-1] += 1
            return "drawn"
        if tag == "math":
            self.formulas += 1
            return "formula"
        if tag == "select":
            self.flow.newline()
            return "select"
        if tag in ("textarea", "xmp"):
            self.flow.newline()
            self.pres += 1
            return "raw"
        if tag == "details":
            self.flow.newline()
            return None if "open" in self.attributes(attributes) else "shut"
        if tag == "table":
            self.flow.margin(1)
            self.tables.append(Table())
            return "table"
        if tag in CELLS and self.tables:
            if not self.tables[-1].rows:
                self.tables[-1].rows.append([])
            self.flows.append(Lines())
            self.tables[-1].rows[-1].append((self.flow, *self.spans(attributes)))
            return "flow"
        if tag in SECTIONS and tag not in ("caption", "colgroup") and self.tables:
            self.tables[-1].sections.add(len(self.tables[-1].rows))
            self.flow.newline()
            return None
        if tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
            return None
        if tag == "caption" and self.tables:
            self.flows.append(self.tables[-1].caption)
            return "flow"
        if tag in ("ul", "ol", "menu"):
            self.flow.margin(0 if self.lists else 1)
            begin = self.attributes(attributes).get("start", "1") if tag == "ol" else ""
            self.lists.append(int(begin) if re.fullmatch(r"-?\d{1,9}", begin) else 1 if tag == "ol" else None)
            return "list"
        if tag == "li":
            self.flow.newline()
            marker = "- "
            if self.lists and self.lists[-1] is not None:
                marker = f"{self.lists[-1]}. "
                self.lists[-1] += 1
            before = self.flow.indent
            self.flow.indent += len(marker)
            self.flow.marker = marker
            return ("indent", before)
        if tag in ("dd", "blockquote"):
            self.flow.margin(1 if tag in MARGIN else 0)
            before = self.flow.indent
            self.flow.indent += 2
            return ("indent", before)
        if tag == "pre":
            self.flow.margin(1)
            self.pres += 1
            return "pre"
        if tag in BLOCK:
            self.flow.margin(1 if tag in MARGIN else 0)
        return None

    def leave(self, tag: str, kept: object) -> None:
        if kept == "hidden":
            self.hidden -= 1
        elif kept == "table":
            lines = self.tables.pop().rendered()
            self.flow.margin(1)
            for line in lines:
                self.flow.now.append(line)
                self.flow.newline()
            self.flow.margin(1)
        elif kept == "flow":
            self.flows.pop()
        elif kept == "list":
            self.lists.pop()
            self.flow.margin(0 if self.lists else 1)
        elif kept == "pre":
            self.pres -= 1
            self.flow.margin(1)
        elif kept == "drawing":
            self.drawings.pop()
        elif kept == "drawn":
            self.drawings[-1] -= 1
            self.flow.text(" ")
        elif kept == "formula":
            self.formulas -= 1
        elif kept == "select":
            self.flow.newline()
        elif kept == "raw":
            self.pres -= 1
            self.flow.newline()
        else:
            if tag in BLOCK:
                self.flow.margin(1 if tag in MARGIN else 0)
            if isinstance(kept, tuple):
                self.flow.indent = kept[1]
                self.flow.marker = ""

    def void(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.flow.newline(keep_empty=bool(self.flow.now))
        elif tag == "hr":
            self.flow.margin(1)
            self.flow.now.append("---")
            self.flow.margin(1)
        elif tag == "img":
            self.flow.text(self.attributes(attributes).get("alt", ""))
        elif tag == "input":
            a = self.attributes(attributes)
            if a.get("type", "").lower() in ("button", "submit", "reset"):
                self.flow.text(a.get("value", ""))

    def text(self, s: str) -> None:
        if self.hidden or not s or self.drawings and not self.drawings[-1]:
            return
        top = self.stack[-1] if self.stack else ("", None)
        if top[1] == "shut" or top[0] in ("table", "tr", "tbody", "thead", "tfoot", "colgroup") and not s.strip():
            return
        s = html.unescape(s) if "&" in s else s
        if self.pres:
            self.flow.pre(s)
        else:
            self.flow.text(s)

    def raw(self, tag: str, s: str) -> None:
        """Content of a shown element that holds no markup."""
        if not (self.drawings and not self.drawings[-1]) and s:
            s = html.unescape(s) if tag == "textarea" else s
            self.flow.pre(re.sub(r"\A\r?\n", "", s) if tag == "textarea" else s)

    def page(self, source: str) -> str:
        at, last = 0, source.rfind(">")
        while True:
            m = (TAG if at <= last else UNTAGGED).search(source, at)
            if m is None:
                self.text(source[at:])
                break
            if m.start() > at:
                self.text(source[at:m.start()])
            at = m.end()
            if m.re is UNTAGGED or not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                self.end(tag)
                continue
            self.start(tag, m[3])
            if tag in RAW:                         # its content is no markup
                stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                begin, at = at, len(source) if stop is None else stop.start()
                if tag == "style":
                    self.read_sheet(m[3], source[begin:at])
                if self.stack and self.stack[-1] == (tag, "raw"):
                    self.raw(tag, source[begin:at])
                if stop is None:
                    break
        self.close(0)
        return "\n".join(self.flows[0].finished())


def render(source: str | None, options: bool = True) -> str:
    """Visible text of a page; ``options=False`` leaves out those of ``select``."""
    return Renderer(options).page(source) if source else ""


def extract(pages: DataFrame, source: str = "html", out: str = "text", keep: list[str] | None = None,
            options: bool = True) -> DataFrame:
    """``pages`` (columns ``keep``; all by default) with the rendered text ``out``."""
    keep = [c for c in (pages.columns if keep is None else keep) if c != out]
    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField(out, T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in batches_by_bytes(frame, "__html"):
                yield part.drop(columns="__html").assign(**{out: [render(x, options) for x in part["__html"]]})
    return pages.select(*keep, F.coalesce(F.col(source), F.lit("")).alias("__html")).mapInPandas(run, schema)

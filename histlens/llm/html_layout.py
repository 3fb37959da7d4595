"""HTML to text as it is laid out.

A tokenizer feeds a tree builder that knows void elements, implied start and end
tags (p, li, dt/dd, table parts, options, head/body) and raw text elements.  Elements that
are not displayed (scripts, styles, templates, the head, ``hidden``, display:none,
visibility:hidden ...) give no text.  What is left is rendered in document order: white space
collapses as in browsers, blocks start on new lines, paragraphs, headings, lists, tables and the like
stand apart by an empty line, list items get bullets or numbers and indents, table cells are
aligned in columns, preformatted text keeps its form.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlens.llm.common import slices

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes object datalist audio video canvas area param "
                   "desc defs metadata annotation annotation-xml".split())       # the last five: parts of drawings and formulas
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary ul xmp "
    "table caption thead tbody tfoot tr td th colgroup".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dir menu dl pre xmp blockquote table figure fieldset hr".split())
FORMATTING = frozenset("a abbr b big cite code del em font i ins label mark nobr q s small span strike strong sub sup tt u".split())
ENDS_P = (BLOCKS - frozenset("html body option optgroup td th tr thead tbody tfoot caption colgroup".split()))
HEAD_ONLY = frozenset("base basefont bgsound link meta title style script noscript template".split())
TABLE_PARTS = frozenset("table caption thead tbody tfoot tr td th colgroup".split())
# a start tag of the key closes open elements of the first set, not looking beyond the second
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset("ul ol dir menu table td th".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "dd": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "option": (frozenset(["option"]), frozenset("select datalist table".split())),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset("select table".split())),
    "td": (frozenset("td th caption colgroup".split()), frozenset(["tr", "table"])),
    "th": (frozenset("td th caption colgroup".split()), frozenset(["tr", "table"])),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset("table thead tbody tfoot".split())),
    "thead": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tbody": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "caption": (frozenset("caption thead tbody tfoot tr td th colgroup".split()), frozenset(["table"])),
    "colgroup": (frozenset("caption thead tbody tfoot tr td th colgroup".split()), frozenset(["table"])),
}

WIDE = 40                       # a column is padded to its widest cell up to this width
SPAN = 1000                     # largest colspan, as in browsers
DEPTH = 512                     # elements nested deeper are siblings, as in browsers

_NAME = re.compile(r"/?[a-zA-Z][^\s/>\x00]*")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_STYLE = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)")


def tokens(source: str) -> Iterator[tuple[str, str, str]]:
    """("text", data, ""), ("start", tag, attributes) and ("end", tag, "") in order; linear in the source."""
    i, n = 0, len(source)
    closed = {">": True, '"': True, "'": True}      # False: none is left in the rest
    low = None
    while i < n:
        j = source.find("<", i)
        if j < 0:
            yield "text", source[i:], ""
            return
        if j > i:
            yield "text", source[i:j], ""
        i = j
        if source.startswith("<!--", i):
            k = source.find("-->", i + 4) if not source.startswith(("<!-->", "<!--->"), i) else source.find(">", i) - 2
            i = n if k < 0 else k + 3
            continue
        m = _NAME.match(source, i + 1)
        if not m:
            if i + 1 < n and source[i + 1] in "!?/":
                k = source.find(">", i)
                i = n if k < 0 else k + 1
            else:
                yield "text", "<", ""
                i += 1
            continue
        name, k = m.group().lower(), m.end()
        while True:                                 # the tag's end outside quotes
            s = _STOP.search(source, k) if closed[">"] else None
            if not s:
                closed[">"], k = False, n
                break
            c = s.group()
            if c == ">":
                k = s.end()
                break
            q = source.find(c, s.end()) if closed[c] else -1
            if q < 0:                               # a lone quote: part of the tag
                closed[c] = False
                k = s.end()
            else:
                k = q + 1
        if name[0] == "/":
            yield "end", name[1:], ""
            i = k
            continue
        yield "start", name, source[m.end() : k - 1 if k <= n and source[k - 1 : k] == ">" else k]
        i = k
        if name in RAW:
            if name == "plaintext":
                yield "text", source[i:], ""
                return
            if low is None:
                low = source.lower() if len(source.lower()) == n else "".join(c.lower() if c < "\x80" else c for c in source)
            e = low.find("</" + name, i)
            yield "raw", source[i : n if e < 0 else e], name
            i = n if e < 0 else e


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        out.setdefault(m.group(1).lower(), _html.unescape(next((g for g in m.groups()[1:] if g is not None), "")))
    return out


class _Flow:
    """Lines of text of one block context (the page or a table cell)."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = 0                    # empty lines due before the next text
        self.space = False              # white space due before the next word
        self.indent: list[str] = []
        self.marker = ""                # list marker due before the next text

    def _start(self) -> None:
        if not self.now:
            if self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.now.append("".join(self.indent[:-1] if self.marker else self.indent) + self.marker)
            self.marker, self.space = "", False

    def text(self, data: str) -> None:
        words = _SPACES.sub(" ", data)
        if words == " " or not words:
            self.space = self.space or bool(words)
            return
        if words[0] == " ":
            self.space, words = True, words[1:]
        tail = words[-1] == " "
        fresh = not self.now
        self._start()
        if self.space and not fresh:
            self.now.append(" ")
        self.now.append(words[:-1] if tail else words)
        self.space = tail

    def verbatim(self, data: str) -> None:
        for k, line in enumerate(data.split("\n")):
            if k:
                self.end_line(force=True)
            if line:
                self._start()
                self.now.append(line)

    def end_line(self, force: bool = False) -> None:
        if self.now:
            self.lines.append("".join(self.now).rstrip(" "))
            self.now = []
        elif force:
            self.lines.append("")
        self.space = False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def take(self) -> list[str]:
        self.end_line()
        return self.lines


class _Table:
    def __init__(self):
        self.rows: list[list[tuple[int, _Flow, int]]] = []      # per row (column, text, columns covered)
        self.spans: dict[int, int] = {}                         # column: rows still covered from above

    def row(self) -> None:
        self.rows.append([])
        self.spans = {c: n - 1 for c, n in self.spans.items() if n > 1}

    def open_cell(self, colspan: int, rowspan: int) -> _Flow:
        if not self.rows:
            self.row()
        row = self.rows[-1]
        col = row[-1][0] + row[-1][2] if row else 0
        while col in self.spans:
            col += 1
        flow = _Flow()
        row.append((col, flow, colspan))
        if rowspan > 1:
            for c in range(col, col + colspan):
                self.spans[c] = rowspan
        return flow

    def render(self) -> list[str]:
        rows = [[(c, f.take(), w) for c, f, w in row] for row in self.rows]
        width: dict[int, int] = {}
        for row in rows:
            for c, lines, w in row:
                if w == 1:
                    width[c] = min(WIDE, max(width.get(c, 0), max(map(len, lines), default=0)))
        last = max((c for row in rows for c, _, _ in row), default=-1)
        at = [0]
        for c in range(last + 1):
            at.append(at[-1] + (width[c] + 2 if width.get(c) else 0))
        out = []
        for row in rows:
            for k in range(max((len(x) for _, x, _ in row), default=0)):
                line = ""
                for c, x, _ in row:
                    if k < len(x) and x[k]:
                        pad = at[c] - len(line)
                        line += " " * (pad if pad > 0 else 2 if line else 0) + x[k]
                out.append(line.rstrip(" "))
        return out


class Page:
    """Tree builder and renderer of one document."""

    def __init__(self):
        self.open: list[list] = []              # [tag, unseen, preformatted, visible, extra]
        self.flows = [_Flow()]
        self.tables: list[_Table] = []
        self.fresh_pre = False

    # --- builder
    def start(self, tag: str, attrs: str) -> None:
        names = [e[0] for e in self.open[-1:]]
        if names == ["head"] and tag not in HEAD_ONLY:
            self._pop_to(len(self.open) - 1)
        if tag in ("html", "body") and any(e[0] == tag for e in self.open):
            return
        if tag in ENDS_P:
            self._close(frozenset(["p"]), frozenset("td th table caption button object".split()))
        if tag in IMPLIED_END:
            self._close(*IMPLIED_END[tag])
        if tag in ("td", "th") and self._inside("tr", "table") is False:
            self.start("tr", "")
        if tag == "br":
            if self._shown():
                f = self.flows[-1]
                if f.now:
                    f.end_line()
                else:
                    f.gap = min(f.gap + 1, 1) if not f.lines else f.gap + 1
            return
        a = attributes(attrs) if attrs.strip(" /\t\n") else {}
        top = self.open[-1] if self.open else ["", False, False, True, None]
        style = dict(_STYLE.findall(a["style"].lower())) if "style" in a else {}
        unseen = (top[1] or tag in UNSEEN or "hidden" in a or style.get("display") == "none"
                  or (tag == "input") or (tag == "dialog" and "open" not in a))
        if top[0] == "details" and top[4] is None and tag != "summary":
            unseen = True
        seen = top[3] if "visibility" not in style else style["visibility"] not in ("hidden", "collapse")
        el = [tag, unseen, top[2] or tag in ("pre", "xmp", "textarea"), seen, None]
        if tag == "details":
            el[4] = "open" if "open" in a else None
        if not unseen:
            self._enter(el, a)
        if tag in VOID or (len(self.open) >= DEPTH and tag not in TABLE_PARTS and not unseen):
            if not unseen:
                self._leave(el)
            return
        if len(self.open) >= DEPTH:
            self._pop_to(DEPTH - 1)
        self.open.append(el)
        self.fresh_pre = tag == "pre"

    def end(self, tag: str) -> None:
        if tag == "p" and self._inside("p", "table") is not True:
            self.start("p", "")
        if tag == "br":
            self.start("br", "")
            return
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name == tag:
                if tag in FORMATTING and any(e[0] in BLOCKS for e in self.open[k + 1:]):
                    del self.open[k]            # a formatting tag closed inside a block: the block goes on
                else:
                    self._pop_to(k)
                return
            if name in ("td", "th", "caption") and tag not in TABLE_PARTS:
                return                          # nothing reaches out of a cell
            if name == "table" and tag in TABLE_PARTS:
                return

    def text(self, data: str) -> None:
        if self.open and self.open[-1][0] == "head" and data.strip():
            self._pop_to(len(self.open) - 1)        # text ends the head
        if not self._shown():
            return
        data = _html.unescape(data).replace("\xa0", " ") if "&" in data else data.replace("\xa0", " ")
        f, pre = self.flows[-1], bool(self.open) and self.open[-1][2]
        if pre:
            data = data.replace("\r\n", "\n").replace("\r", "\n")
            if self.fresh_pre and data.startswith("\n"):
                data = data[1:]
            self.fresh_pre = False
            f.verbatim(data)
        elif self.open and self.open[-1][0] in ("table", "thead", "tbody", "tfoot", "tr") and not data.strip():
            return
        else:
            f.text(data)

    def _shown(self) -> bool:
        if not self.open:
            return True
        top = self.open[-1]
        return not top[1] and top[3] and not (top[0] == "details" and top[4] is None)

    def _inside(self, tag: str, bound: str) -> bool | None:
        """True if tag is open above bound, False if bound comes first, None without either."""
        for e in reversed(self.open):
            if e[0] == tag:
                return True
            if e[0] == bound:
                return False
        return None

    def _close(self, tags: frozenset, bounds: frozenset) -> None:
        found = None
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                found = k
            elif self.open[k][0] in bounds:
                break
            elif found is not None and self.open[k][0] not in tags:
                break
        if found is not None:
            self._pop_to(found)

    def _pop_to(self, k: int) -> None:
        while len(self.open) > k:
            el = self.open.pop()
            if not el[1]:
                self._leave(el)

    # --- rendering
    def _enter(self, el: list, a: dict[str, str]) -> None:
        tag, f = el[0], self.flows[-1]
        if tag == "table":
            f.block(1)
            self.tables.append(_Table())
            el[4] = len(self.flows)
            return
        in_table = self.tables and any(e[0] == "table" for e in self.open)
        if tag == "tr" and in_table:
            self.tables[-1].row()
        elif tag in ("td", "th") and in_table:
            def number(name):
                m = re.match(r"\s*(\d{1,6})", a.get(name, ""))
                return min(SPAN, max(1, int(m.group(1)))) if m else 1
            self.flows.append(self.tables[-1].open_cell(number("colspan"), number("rowspan")))
            el[4] = len(self.flows)
        elif tag in BLOCKS:
            inner = tag in ("ul", "ol", "dir", "menu") and any(e[0] == "li" for e in self.open)
            f.block(1 if tag in APART and not inner else 0)
            if tag == "ol":
                m = re.match(r"\s*(-?\d{1,9})", a.get("start", ""))
                el[4] = int(m.group(1)) if m else 1
            elif tag == "li":
                home = next((e for e in reversed(self.open) if e[0] in ("ul", "ol", "dir", "menu")), None)
                mark = "- "
                if home is not None and home[0] == "ol":
                    m = re.match(r"\s*(-?\d{1,9})", a.get("value", ""))
                    home[4] = int(m.group(1)) if m else home[4]
                    mark = f"{home[4]}. "
                    home[4] += 1
                f.indent.append(" " * len(mark))
                f.marker, el[4] = mark, True
            elif tag in ("blockquote", "dd"):
                f.indent.append("  ")
                el[4] = True

    def _leave(self, el: list) -> None:
        tag = el[0]
        if tag == "table":
            del self.flows[el[4]:]
            t = self.tables.pop()
            f = self.flows[-1]
            f.block(1)
            for line in t.render():
                if line:
                    f._start()
                    f.now.append(line)
                f.end_line(force=True)
            f.block(1)
        elif tag in ("td", "th") and el[4]:
            del self.flows[el[4] - 1:]
        elif tag in BLOCKS:
            f = self.flows[-1]
            inner = tag in ("ul", "ol", "dir", "menu") and any(e[0] == "li" for e in self.open)
            f.block(1 if tag in APART and not inner else 0)
            if el[4] is True and f.indent:
                f.indent.pop()
                if tag == "li":
                    f.marker = ""

    def close(self) -> str:
        self._pop_to(0)
        lines = self.flows[0].take()
        return "\n".join(lines).strip("\n")


def render(source: str | None) -> str:
    """The visible text of an HTML document; null and empty give an empty text."""
    page = Page()
    for kind, data, extra in tokens((source or "").replace("\x00", "")):
        if kind == "text":
            page.text(data)
        elif kind == "start":
            page.start(data, extra)
        elif kind == "end":
            page.end(data)
        else:                           # raw text, with character references only in textarea and title
            page.text(data if extra == "textarea" else data.replace("&", "&amp;"))
    return page.close()


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep`` columns, text and n_chars: one row per page; null html gives an empty text,
    repeated rows are rendered each, other columns are ignored, an empty table gives an empty result."""
    src = pages.select(*[F.col(c) for c in keep], F.col(html_col).alias("_html"))
    out = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1]) + "text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            got = [render(x) for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.string()), pa.array([len(x) for x in got], pa.int64())],
                                             [*b.schema.names[:-1], "text", "n_chars"])
    return src.mapInArrow(run, out)

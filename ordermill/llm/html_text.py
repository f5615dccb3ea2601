"""Visible text of HTML pages, laid out as blocks, lists and tables.

A tokenizer splits a page into tags and text; a tree builder makes elements of it, closing what a
start tag implies to be closed (a paragraph by a block, a list item by the next, cells and rows by
their followers, options by theirs) and forgiving end tags without a start. Rendering walks the
tree: elements that are never shown (head, script, style, template, …), that
are hidden by the attribute ``hidden``, by ``aria-hidden="true"`` or by inline style, and comments are
left out; all other text is emitted. What ``visibility`` hides is left out but for what it shows again
further in. Of closed details the summary is shown, of form fields what they show: the chosen option of a
list (all options of one that is open), the text of text fields, the label of buttons. Block elements stand on lines of their own, paragraphs, headings,
lists, quotes and tables apart by an empty line; ``br`` breaks a line; list items have a bullet or
their number and are indented by their depth; table cells are padded to the width of their column;
``pre`` keeps its white space, elsewhere runs of it become one space.

Of an ``svg`` the text elements are shown, of dialogs the open ones.

Null and empty pages give an empty text; other columns, whatever their names, are not looked at. Repeated
rows are rendered alike. Elements are the same at any depth, and very long pages are rendered whole. Numbers
may have any length: a character reference beyond the last character is U+FFFD, a cell spans at most 1,000
columns, and columns in which no cell begins take no width. Of the layout alone two things stop at a width,
as they would grow with the square of the depth: indentation at ``MAX_INDENT`` columns, and padded columns in
tables within ``MAX_TABLES`` others, whose cells stand on lines of their own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm import text as X

MAX_INDENT = 400
MAX_TABLES = 100

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
#: Never shown.
HIDDEN = frozenset(
    "head script style template noscript title meta link iframe noembed noframes object audio video canvas "
    "datalist area map base param source track rp annotation annotation-xml".split()
)
#: Inputs that show no text.
TEXTLESS = frozenset("hidden checkbox radio file image password range color".split())
MAX_SPAN = 1_000
BLOCK = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul caption search".split()
)
#: Set apart by an empty line.
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr address dir menu".split())
CLOSES_P = BLOCK - frozenset("body html dd dt li td th tr tbody thead tfoot caption summary legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FORMATTING = frozenset("a b big code em font i s small strike strong tt u span".split())
#: What a start tag closes, and what keeps it from reaching further up.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "dir", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
    "rp": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
    "body": (frozenset(["head"]), frozenset()),
}
#: End tags don't reach beyond these.
SCOPE = frozenset("table td th caption html template".split())
#: Not shown inside an svg.
SVG_UNSHOWN = frozenset("defs desc metadata symbol clippath mask marker pattern".split())
#: Start tags that end an svg left open.
LEAVES_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
IN_HEAD = frozenset("base link meta title style script noscript template head html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)|"
    r"<([A-Za-z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_HIDDEN_STYLE = re.compile(r"(?<![\w-])(?:display\s*:\s*none|content-visibility\s*:\s*hidden)", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(visible|hidden|collapse)", re.I)
#: Character references by more digits than any character needs.
_LONG_REFERENCE = re.compile(r"&#(?:([0-9]{8,})|[xX]([0-9a-fA-F]{7,}));?")
_SPACES = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Element:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)
    #: Whether ``visibility`` shows the text in it.
    seen: bool = True


def _short_reference(m: re.Match) -> str:
    digits, base = (m[1], 10) if m[1] else (m[2], 16)
    digits = digits.lstrip("0") or "0"
    return f"&#{int(digits, base)};" if len(digits) <= 7 else "&#65533;"


def plain(source: str) -> str:
    """Text with its character references resolved."""
    if "&" not in source:
        return source
    return unescape(_LONG_REFERENCE.sub(_short_reference, source))


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        out.setdefault(name.lower(), plain(value))
    return out


class _Builder:
    """``open`` has the places in the stack of the open elements of each tag, and of all blocks
    and scopes, so that finding one takes as long at any depth."""

    def __init__(self):
        self.root = Element("#root")
        self.stack = [self.root]
        self.open: dict[str, list[int]] = {"#block": [], "#scope": []}

    def _push(self, element: Element) -> None:
        for name in self._names(element.tag):
            self.open.setdefault(name, []).append(len(self.stack))
        self.stack.append(element)

    def _cut(self, place: int) -> None:
        """Closes the element at a place and all inside it."""
        while len(self.stack) > place:
            for name in self._names(self.stack.pop().tag):
                self.open[name].pop()

    @staticmethod
    def _names(tag: str):
        yield tag
        if tag in BLOCK:
            yield "#block"
        if tag in SCOPE:
            yield "#scope"

    def _innermost(self, names) -> int:
        """Place of the innermost open element of these, else 0."""
        best = 0
        for name in names:
            places = self.open.get(name)
            if places and places[-1] > best:
                best = places[-1]
        return best

    def text(self, source: str) -> None:
        if source:
            if self.stack[-1].tag == "head" and not source.isspace():
                self._cut(len(self.stack) - 1)
            self.stack[-1].children.append(source)

    def start(self, tag: str, source: str) -> None:
        svg = self._innermost(("svg",))
        if svg < self._innermost(("foreignobject",)):
            svg = 0
        if svg and tag in LEAVES_SVG:
            self._cut(svg)
            svg = 0
        if self.stack[-1].tag == "head" and tag not in IN_HEAD:
            self._cut(len(self.stack) - 1)
        if tag in CLOSES_P:
            self._close(frozenset(["p"]), frozenset(["table", "td", "th", "li", "dd", "dt"]))
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self._cut(len(self.stack) - 1)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        element = Element(tag, attributes(source) if source and not source.isspace() else {})
        self.stack[-1].children.append(element)
        if tag not in VOID and not ((svg or tag == "svg") and source.endswith("/")):
            self._push(element)

    def _close(self, tags: frozenset, until: frozenset) -> None:
        """Closes the outermost open element of ``tags`` below the innermost of ``until``."""
        while (last := self._innermost(tags)) > self._innermost(until):
            while last > 1 and self.stack[last - 1].tag in tags:
                last -= 1
            self._cut(last)
            if len(tags) == 1:
                return

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
            return
        if tag == "p" and not self.open.get("p"):
            self.stack[-1].children.append(Element("p"))
            return
        # Inline end tags stay within their block; others within their cell or table.
        bounds = ["#block"] if tag in FORMATTING else []
        if tag not in ("table", "html", "body", "tr", "tbody", "thead", "tfoot"):
            bounds.append("#scope")
        place = self._innermost(HEADINGS if tag in HEADINGS else (tag,))
        if place and place >= self._innermost(bounds):
            self._cut(place)


def parse(html: str) -> Element:
    builder = _Builder()
    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            break
        begin = m.start()
        if begin > at:
            builder.text(plain(html[at:begin]))
        at = m.end()
        if m[1]:
            builder.end(m[1].lower())
        elif m[2]:
            tag = m[2].lower()
            builder.start(tag, m[3])
            if tag in RAW and builder.stack[-1].tag == tag:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                inside = html[at : close.start() if close else size]
                builder.text(plain(inside) if tag in ("title", "textarea") else inside)
                builder.end(tag)
                at = close.end() if close else size
    if at < size:
        builder.text(plain(html[at:]))
    return builder.root


def hidden(e: Element) -> bool:
    if e.tag in HIDDEN:
        return True
    a = e.attributes
    if e.tag == "dialog" and "open" not in a:
        return True
    if not a:
        return False
    return (
        "hidden" in a or a.get("aria-hidden", "").strip().lower() == "true"
        or (e.tag == "input" and a.get("type", "").lower() == "hidden")
        or ("style" in a and _HIDDEN_STYLE.search(a["style"]) is not None)
    )


class _Lines:
    """Text laid out in lines; breaks are made only when more text follows."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.gap = 0
        self.mark = ""
        self.indent = ""

    def text(self, source: str) -> None:
        words = _SPACES.sub(" ", source)
        if not words:
            return
        if words[0] == " ":
            self.space = True
        body = words.strip(" ")
        if not body:
            return
        self._begin()
        if self.space and self.now[-1:] and not self.now[-1].endswith(" "):
            self.now.append(" ")
        self.now.append(body)
        self.space = words[-1] == " "

    def _begin(self) -> None:
        if self.gap > 1 and self.lines:
            self.lines.append("")
        self.gap = 0
        if not self.now:
            self.space = False
            if self.indent or self.mark:
                lead = self.indent
                if self.mark:
                    lead = lead[: len(lead) - len(self.mark)] + self.mark
                    self.mark = ""
                if lead:
                    self.now.append(lead)

    def end_line(self) -> None:
        if self.now:
            self.lines.append("".join(self.now).rstrip(" "))
            self.now = []
        self.space = False

    def block(self, apart: bool = False) -> None:
        self.end_line()
        self.gap = max(self.gap, 2 if apart else 1)

    def raw(self, source: str) -> None:
        for k, line in enumerate(source.split("\n")):
            if k:
                if not self.now:
                    self.lines.append("")
                self.end_line()
            if line:
                if not line.isspace():
                    self._begin()
                self.now.append(line)

    def whole(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def _mark_seen(root: Element) -> None:
    waiting = [root]
    while waiting:
        e = waiting.pop()
        for child in e.children:
            if isinstance(child, Element):
                set_ = _VISIBILITY.findall(child.attributes.get("style", ""))
                child.seen = set_[-1].lower() == "visible" if set_ else e.seen
                waiting.append(child)


def render(e: Element) -> str:
    """Walks are generators that yield the walks inside them, so that depth needs no recursion."""
    _mark_seen(e)
    open_, value = [_rendered(e, 0)], None
    while open_:
        try:
            open_.append(open_[-1].send(value))
            value = None
        except StopIteration as end:
            open_.pop()
            value = end.value
    return value


def _rendered(e: Element, tables: int):
    out = _Lines()
    yield _walk(e, out, 0, False, tables)
    return out.whole()


def _walk(e: Element, out: _Lines, depth: int, pre: bool, tables: int):
    """``depth`` counts lists and ``tables`` tables around."""
    number = 0
    children = e.children
    if e.tag == "details" and "open" not in e.attributes:
        children = [c for c in children if isinstance(c, Element) and c.tag == "summary"][:1]
    for child in children:
        if isinstance(child, str):
            if not e.seen:
                continue
            if pre:
                out.raw(child)
            else:
                out.text(child)
            continue
        tag = child.tag
        if hidden(child):
            continue
        if tag in ("input", "select", "textarea"):
            if child.seen:
                _field(child, out)
            continue
        if tag == "br":
            if out.now:
                out.end_line()
            elif out.lines and out.gap < 2:
                out.gap = 2
            continue
        if tag == "hr":
            out.block(True)
            continue
        if tag == "img":
            if child.seen and child.attributes.get("alt", "").strip():
                out.text(child.attributes["alt"])
            continue
        if tag == "svg":
            yield _svg(child, out, depth, False, tables)
            continue
        if tag == "table" and tables < MAX_TABLES:
            yield _table(child, out, depth, tables + 1)
            continue
        if tag not in BLOCK:
            if child.children:
                yield _walk(child, out, depth, pre, tables)
            continue
        apart = tag in APART and not (tag in ("ul", "ol") and depth)
        if tag == "li":
            out.block()
            if e.tag == "ol":
                number = _number(child, number, e)
                mark = f"{number}. "
            else:
                mark = "- "
            indent = out.indent
            out.indent, out.mark = (indent + " " * len(mark))[:MAX_INDENT], mark
            yield _walk(child, out, depth + 1, pre, tables)
            out.block()
            out.indent, out.mark = indent, ""
            continue
        indent = out.indent
        out.block(apart)
        if tag in ("blockquote", "dd"):
            out.indent = (indent + "  ")[:MAX_INDENT]
        yield _walk(child, out, depth, pre or tag == "pre", tables)
        out.block(apart)
        out.indent = indent


def _svg(e: Element, out: _Lines, depth: int, shown: bool, tables: int):
    """The text elements of an svg, apart from each other."""
    for child in e.children:
        if isinstance(child, str):
            if shown and e.seen:
                out.text(child)
        elif hidden(child) or child.tag in SVG_UNSHOWN:
            continue
        elif child.tag == "foreignobject":
            yield _walk(child, out, depth, False, tables)
        elif child.tag == "text":
            out.space = True
            yield _svg(child, out, depth, True, tables)
            out.space = True
        else:
            yield _svg(child, out, depth, shown, tables)


def _field(e: Element, out: _Lines) -> None:
    """What a form field shows, apart from the text around it."""
    a = e.attributes
    if e.tag == "input":
        lines = [] if a.get("type", "").strip().lower() in TEXTLESS else [a.get("value") or a.get("placeholder", "")]
    elif e.tag == "textarea":
        lines = ("".join(c for c in e.children if isinstance(c, str)) or a.get("placeholder", "")).split("\n")
    else:
        lines = _options(e)
    out.space = True
    for n, line in enumerate(lines):
        if n:
            out.end_line()
        out.text(line)
    out.space = True


def _options(select: Element) -> list[str]:
    """The chosen option, or all options and group labels of a list that shows several."""
    a = select.attributes
    size = a.get("size", "").strip().lstrip("0")
    is_open = "multiple" in a or (size.isascii() and size.isdigit() and size != "1")
    found, waiting = [], [(c, False) for c in reversed(select.children)]
    while waiting:
        e, is_off = waiting.pop()
        if not isinstance(e, Element) or hidden(e):
            continue
        if e.tag == "option":
            text = e.attributes.get("label") or _text_of(e)
            found.append((text, "selected" in e.attributes, is_off or "disabled" in e.attributes))
        else:
            if e.tag == "optgroup" and is_open and e.attributes.get("label"):
                found.append((e.attributes["label"], False, True))
            is_off = is_off or "disabled" in e.attributes
            waiting += [(c, is_off) for c in reversed(e.children)]
    if is_open:
        return [text for text, _, _ in found]
    chosen = [text for text, is_chosen, _ in found if is_chosen][-1:]
    return chosen or [text for text, _, is_off in found if not is_off][:1]


def _text_of(e: Element) -> str:
    out, waiting = [], list(reversed(e.children))
    while waiting:
        child = waiting.pop()
        if isinstance(child, str):
            out.append(child)
        elif not hidden(child):
            waiting += reversed(child.children)
    return "".join(out)


def _number(item: Element, last: int, parent: Element) -> int:
    for source in (item.attributes.get("value"), None if last else parent.attributes.get("start")):
        if source is not None and re.fullmatch(r"\s*-?\d{1,9}\s*", source):
            return int(source)
    return last + 1


def _rows(e: Element):
    for child in e.children:
        if isinstance(child, Element) and not hidden(child):
            if child.tag == "tr":
                yield child
            elif child.tag in ("tbody", "thead", "tfoot"):
                yield from _rows(child)


def _table(table: Element, out: _Lines, depth: int, tables: int):
    """Rows on lines, cells padded to the widest of their column; what stands in a table outside its
    cells comes before it. A cell of several lines takes as many lines of the row."""
    out.block(True)
    yield _stray(table, out, depth, tables)
    grid: list[list[tuple[int, list[str]]]] = []
    for row in _rows(table):
        cells, column = [], 0
        for c in row.children:
            if isinstance(c, Element) and c.tag in ("td", "th") and not hidden(c):
                cells.append((column, (yield _rendered(c, tables)).split("\n")))
                column += _span(c)
        if any(any(lines) for _, lines in cells):
            grid.append(cells)
    width: dict[int, int] = {}
    for cells in grid:
        for k, lines in cells:
            width[k] = max(width.get(k, 0), max(map(len, lines)))
    # Where each column in which a cell begins stands.
    at, place = {}, 0
    for k in sorted(width):
        at[k] = place
        place += width[k] + 2
    for cells in grid:
        for n in range(max(len(lines) for _, lines in cells)):
            parts, end = [], 0
            for k, lines in cells:
                if n < len(lines) and lines[n]:
                    parts += [" " * (at[k] - end), lines[n]]
                    end = at[k] + len(lines[n])
            line = "".join(parts).rstrip()
            if line:
                out._begin()
                out.now.append(line)
                out.end_line()
            elif n:
                out.lines.append("")
    out.block(True)


def _span(cell: Element) -> int:
    span = cell.attributes.get("colspan", "").strip().lstrip("0")
    if not (span.isascii() and span.isdigit()):
        return 1
    return int(span) if len(span) < 5 and int(span) < MAX_SPAN else MAX_SPAN


def _stray(e: Element, out: _Lines, depth: int, tables: int):
    for child in e.children:
        if isinstance(child, str):
            if e.seen:
                out.text(child)
        elif hidden(child) or child.tag in ("td", "th"):
            continue
        elif child.tag in ("tr", "tbody", "thead", "tfoot"):
            yield _stray(child, out, depth, tables)
        else:
            yield _walk(Element("#part", {}, [child]), out, depth, False, tables)
            if child.tag == "caption":
                out.block()
    out.end_line()


def to_text(html: str | None) -> str:
    return render(parse(html)) if html else ""


def extract(pages: DataFrame, id_column: str = "page_id", html: str = "html") -> DataFrame:
    """The id and ``text`` of every page."""

    def run(batches):
        for batch in X.slices(batches, html):
            texts = [to_text(h) for h in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(texts, pa.string())], names=[id_column, "text"]
            )

    kind = pages.schema[id_column].dataType.simpleString()
    return pages.select(id_column, html).mapInArrow(run, f"`{id_column}` {kind}, text string")

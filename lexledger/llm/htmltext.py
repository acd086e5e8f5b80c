"""HTML to text as it is laid out: a tree with implied tags, visibility, block spacing, lists and aligned tables.

A page is read once from front to back, as the HTML standard reads it: a tag ends at the first ``>`` outside its
quoted values, a tag or comment that never ends takes the rest of the page. Elements may nest without bound; the tree
is built and walked with explicit stacks, so no page, however long, deep or malformed, takes more than time in
proportion to its length and its text.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*+(=?[^\s/>=]*+)(\s*+=\s*+)?")
_VALUE = re.compile(r"[^\s>]*")
#: A word; no-break spaces belong to words and become blanks that don't collapse.
_WORD = re.compile(r"[\S\xa0]+")
_BRACE = re.compile(r"[{}]")
#: Decimal references of so many digits name no character.
_HUGE = re.compile(r"&#0*[1-9][0-9]{7,};?")
_HIDES = re.compile(r"(?:^|;)\s*visibility\s*:\s*(?:hidden|collapse)", re.I)
_REMOVES = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_SHOWS = re.compile(r"(?:^|;)\s*visibility\s*:\s*visible", re.I)
#: A compound selector of tag, classes and ids.
_COMPOUND = re.compile(r"([\w-]*)((?:[.#][\w-]+)*)")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to their end tag; of the second kind with character references.
_RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
_ESCAPABLE = frozenset("textarea title".split())
_NEVER_SHOWN = frozenset("head script style template title noscript noembed noframes iframe datalist object audio video canvas svg math base link meta param source track area map rp".split())
#: Blocks with an empty line around them, and blocks that only start a new line.
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre figure fieldset hr xmp listing".split())
_LINED = frozenset(
    "address article aside body center details dialog dd div dt figcaption footer form header hgroup html legend li main nav optgroup option search section summary caption tr thead tbody tfoot td th colgroup".split()
)
_BLOCKS = _SPACED | _LINED
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSE_P = (_BLOCKS - frozenset("body html option optgroup caption tr thead tbody tfoot td th colgroup legend".split())) | {"hr"}
#: A start tag of the key closes open elements of the first set, looked for up to one of the second.
_LIST = frozenset("ul ol menu dir".split())
_IMPLIED = {
    "li": ({"li"}, _LIST | {"table", "body"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "body"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "body"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
}
#: End tags of these don't close what lies outside the nearest of the second.
_SCOPES = frozenset("table td th caption body html button".split())
_HEAD_ONLY = frozenset("head title meta link base script style noscript template".split())
_VALUED = frozenset("text submit button reset search email url tel number".split())
#: Layout only, no text is lost to any of these: columns that a line is indented at most and that cells are aligned
#: to at most, the widest column that cells are aligned to, rows or columns that a cell spans at most, and tables
#: inside each other that are laid out in columns (those inside them: cell under cell).
INDENT, ALIGNED, COLUMN, SPAN, TABLES = 200, 2000, 200, 100, 16


def unescape(text: str) -> str:
    return html.unescape(_HUGE.sub("\N{REPLACEMENT CHARACTER}", text)) if "&" in text else text


class Element:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []

    def attribute(self, name: str) -> str | None:
        value = self.attributes.get(name)
        return None if value is None else unescape(value)


def attributes_from(source: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes of a tag (the first of a name counts) and the place behind its ``>``, -1 if it never ends."""
    found: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(source, at)
        name, at = m[1].lower(), m.end()
        if not name:
            return found, at + 1 if at < len(source) else -1
        value = ""
        if m[2]:
            quote = source[at : at + 1]
            if quote == '"' or quote == "'":
                end = source.find(quote, at + 1)
                if end < 0:
                    return found, -1
                value, at = source[at + 1 : end], end + 1
            else:
                m = _VALUE.match(source, at)
                value, at = m[0], m.end()
        if name not in found:
            found[name] = value


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I)


class Builder:
    """The open elements, and for each tag the places of those that are open, the innermost last."""

    def __init__(self):
        self.root = Element("html")
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list)

    def push(self, element: Element) -> None:
        self.places[element.tag].append(len(self.open))
        self.open.append(element)

    def close_to(self, k: int) -> None:
        while len(self.open) > max(k, 1):
            self.places[self.open.pop().tag].pop()

    def find(self, tags, stops) -> int | None:
        """The innermost open element of ``tags``, if none of ``stops`` lies inside it."""
        k = max((p[-1] for t in tags if (p := self.places.get(t))), default=0)
        return k if k and all(p[-1] <= k for t in stops if (p := self.places.get(t))) else None

    def text(self, raw: str) -> None:
        if raw:
            if self.open[-1].tag == "head" and raw.strip():
                self.close_to(len(self.open) - 1)
            self.open[-1].children.append(unescape(raw))

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "html" or (tag == "body" and self.places.get("body")):
            return
        if tag not in _HEAD_ONLY and (heads := self.places.get("head")):
            self.close_to(heads[0])
        if tag in _CLOSE_P and (k := self.find(("p",), _SCOPES)) is not None:
            self.close_to(k)
        if tag in _IMPLIED:
            tags, stops = _IMPLIED[tag]
            while (k := self.find(tags, stops)) is not None:
                self.close_to(k)
            if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
                self.start("tr", {})
        if tag in _HEADINGS and self.open[-1].tag in _HEADINGS:
            self.close_to(len(self.open) - 1)
        if tag == "a" and (k := self.find(("a",), _SCOPES)) is not None:
            self.close_to(k)
        element = Element(tag, attributes)
        self.open[-1].children.append(element)
        if tag not in _VOID:
            self.push(element)

    def end(self, tag: str) -> None:
        if tag == "p" and self.find(("p",), _SCOPES) is None:
            self.start("p", {})
        if tag == "br":
            self.start("br", {})
            return
        if tag in ("body", "html"):
            return
        if tag == "table":
            stops = ()
        elif tag in ("tr", "td", "th", "thead", "tbody", "tfoot", "caption"):
            stops = ("table",)
        else:
            stops = _SCOPES - {tag}
        if (k := self.find((tag,), stops)) is not None:
            self.close_to(k)


def parse(source: str) -> Element:
    """The tree of a page; whatever is missing is implied, whatever is out of place is closed."""
    tree = Builder()
    at, n = 0, len(source)
    since, sections = 0, True  # where the text before the next tag starts; whether a CDATA section can still end
    while True:
        at = source.find("<", at)
        if at < 0 or at + 1 >= n:
            break
        following = source[at + 1]
        if following in "!?":
            tree.text(source[since:at])
            if source.startswith("<!--", at):
                end = source.find("-->", at + 2)
                at = n if end < 0 else end + 3
            else:
                end = -1
                if sections and source.startswith("<![CDATA[", at):
                    end = source.find("]]>", at)
                    sections = end >= 0
                end = end + 3 if end >= 0 else source.find(">", at) + 1
                at = end or n
            since = at
            continue
        closing = following == "/"
        m = _NAME.match(source, at + 1 + closing)
        if m is None:
            if not closing:  # a plain <
                at += 1
                continue
            tree.text(source[since:at])
            at = since = source.find(">", at) + 1 or n
            continue
        tree.text(source[since:at])
        tag, at = m[0].lower(), m.end()
        if source.startswith(">", at):
            attributes, at = {}, at + 1
        else:
            attributes, at = attributes_from(source, at)
        if at < 0:
            return tree.root
        since = at
        if closing:
            tree.end(tag)
            continue
        tree.start(tag, attributes)
        if tag == "plaintext":
            tree.text(source[at:])
            return tree.root
        if tag in _RAW or tag in _ESCAPABLE:
            end = _end_of(tag).search(source, at)
            raw = source[at : end.start()] if end else source[at:]
            tree.open[-1].children.append(unescape(raw) if tag in _ESCAPABLE else raw)
            tree.close_to(len(tree.open) - 1)
            at = since = end.end() if end else n
    tree.text(source[since:])
    return tree.root


def rules(sheet: str):
    """(selectors, declarations) of a style sheet, but for rules that only hold in print."""
    sheet = re.sub(r"/\*.*?(?:\*/|\Z)", "", sheet, flags=re.S)
    outer: list[str] = []
    since = 0
    for m in _BRACE.finditer(sheet):
        piece, since = sheet[since : m.start()], m.end()
        if m[0] == "{":
            outer.append(piece.rpartition(";")[2].strip().lower())
        elif outer:
            selectors = outer.pop()
            printed = any(x.startswith("@media") and "print" in x and "screen" not in x for x in outer[-3:])
            if not selectors.startswith("@") and not printed:
                yield selectors, piece


class Sheet:
    """The selectors by which a page's style sheets hide elements: compounds of tag, classes and ids, joined as
    descendants (blank) or children (>). Selectors with anything else (siblings, attributes, states) hide nothing.

    Every compound of every selector has a bit, those of one selector next to each other. What an element and those
    around it match is one number, and an element's own bits follow from its parent's by shifting the bits of those
    selectors whose next compound it matches: the work for an element does not grow with the number of elements around
    it.
    """

    def __init__(self, root: Element):
        self.bits, self.removes, self.hides = 0, 0, 0
        #: compounds by tag, class or id: (the others that they need, what starts here, what goes on after a
        #: descendant's and after a child's combinator)
        self.compounds: dict[str, dict[frozenset, list[int]]] = defaultdict(dict)
        stack = [root]
        while stack:
            e = stack.pop()
            if e.tag == "style":
                for selectors, body in rules("".join(c for c in e.children if isinstance(c, str))):
                    removed = bool(_REMOVES.search(body))
                    if removed or _HIDES.search(body):
                        for selector in selectors.split(","):
                            self._add(selector, removed)
            stack.extend(c for c in e.children if isinstance(c, Element))

    def _add(self, selector: str, removed: bool) -> None:
        parts = selector.replace(">", " > ").split()
        while len(parts) > 1 and parts[0] in ("html", "body") and parts[1] != ">":
            parts = parts[1:]  # everything is in these
        found, child = [], False
        for k, part in enumerate(parts):
            if part == ">":
                if child or k in (0, len(parts) - 1):
                    return
                child = True
                continue
            m = _COMPOUND.fullmatch(part)
            if not m or not part:
                return
            names = re.findall(r"[.#][\w-]+", m[2])
            key = next((x for x in names if x[0] == "#"), names[0] if names else m[1])
            found.append((key, frozenset({*names, *([m[1]] if m[1] else [])} - {key}), child))
            child = False
        for k, (key, needs, child) in enumerate(found):
            masks = self.compounds[key].setdefault(needs, [0, 0, 0])
            if k == 0:
                masks[0] |= 1 << self.bits
            else:
                masks[2 if child else 1] |= 1 << (self.bits - 1)
            self.bits += 1
        if found:
            last = 1 << (self.bits - 1)
            self.removes, self.hides = self.removes | (last if removed else 0), self.hides | last

    def match(self, e: Element, around: int, parent: int) -> int:
        """The element's own bits. around: the bits of all elements that it is in; parent: those of its parent."""
        names = {e.tag}
        if e.attributes:
            names.update(f".{c}" for c in (e.attribute("class") or "").lower().split())
            if i := (e.attribute("id") or "").lower():
                names.add(f"#{i}")
        own = 0
        for name in names & self.compounds.keys():
            for needs, (starts, within, below) in self.compounds[name].items():
                if needs <= names:
                    own |= starts | (around & within) << 1 | (parent & below) << 1
        return own


class Flow:
    """Lines of text; blocks ask for line ends and empty lines, which collapse. ``marker``: what stands before the
    next line, as a chain (what came before, string, length of both) that is put together when the line ends."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.shown = False  # whether the line has more than blanks
        self.gap = 0
        self.space = False
        self.marker: tuple | None = None
        self.indent = 0

    def mark(self, text: str) -> None:
        self.marker = (self.marker, text, len(text) + (self.marker[2] if self.marker else 0))

    def put(self, text: str) -> None:
        if text:
            self.line.append(text)
            self.shown = self.shown or not text.isspace()

    def block(self, gap: int) -> None:
        if self.shown:
            self._end()
        self.line, self.shown, self.space = [], False, False
        if self.lines:
            self.gap = max(self.gap, gap)

    def _end(self) -> None:
        if self.lines and self.gap > 1:
            self.lines.append("")
        marks, chain = [], self.marker
        while chain:
            marks.append(chain[1])
            chain = chain[0]
        self.lines.append(" " * min(self.indent, INDENT) + "".join(reversed(marks)) + "".join(self.line).rstrip(" "))
        self.indent += self.marker[2] if self.marker else 0
        self.marker, self.line, self.shown, self.gap, self.space = None, [], False, 1, False

    def words(self, text: str) -> None:
        first = text[:1].isspace()
        words = _WORD.findall(text) if "\xa0" in text else text.split()
        if not words:
            self.space |= bool(text)
            return
        glue = " " if self.line and (self.space or first) else ""
        self.put(glue + " ".join(words).replace("\xa0", " "))
        self.space = text[-1].isspace()

    def br(self) -> None:
        if self.shown:
            self._end()
        else:
            self.gap = 2 if self.lines else 0
        self.space = False

    def verbatim_end(self) -> None:
        """The line ends as it is; an empty one leaves an empty line."""
        if self.shown:
            self._end()
        elif self.lines:
            self.gap = 2
        self.line, self.shown = [], False

    def verbatim(self, lines: list[str]) -> None:
        for line in lines:
            self.line, self.shown = [line], bool(line.strip())
            self.verbatim_end()


#: What is known where an element stands: whether text is visible, and the bits of the sheet's selectors that match
#: elements around it and its parent.
Sight = tuple[bool, int, int]


def _shown(e: Element, sheet: Sheet, sight: Sight) -> tuple[bool, Sight]:
    """Whether an element is laid out, and the sight inside it. What is not laid out is gone with all that it holds;
    what is invisible may hold something visible."""
    if e.tag in _NEVER_SHOWN:
        return False, sight
    visible, around, parent = sight
    style = ""
    if e.attributes:
        style = e.attribute("style") or ""
        if "hidden" in e.attributes or _REMOVES.search(style) or (e.tag == "input" and (e.attribute("type") or "").lower() == "hidden"):
            return False, sight
    if sheet.bits:
        own = sheet.match(e, around, parent)
        if own & sheet.removes:
            return False, sight
        if own & sheet.hides:
            visible = False
        around, parent = around | own, own
    if _HIDES.search(style):
        visible = False
    elif _SHOWS.search(style):
        visible = True
    return True, (visible, around, parent)


def walked(task):
    """The result of a generator that yields the generators whose results it needs: recursion on a list, not the stack."""
    stack, value = [task], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def _render(e: Element, flow: Flow, sheet: Sheet, pre: bool, sight: Sight, tables: int):
    step = -1 if "reversed" in e.attributes else 1
    number = _start_number(e) if e.tag == "ol" else 0
    closed = e.tag == "details" and "open" not in e.attributes
    for c in e.children:
        if isinstance(c, str):
            if not sight[0] or closed:
                continue
            if pre:
                first, *more = c.replace("\r\n", "\n").split("\n")
                flow.put(first)
                for line in more:
                    flow.verbatim_end()
                    flow.put(line)
            else:
                flow.words(c)
            continue
        if closed and c.tag != "summary":
            continue
        shown, seen = _shown(c, sheet, sight)
        if not shown:
            continue
        if c.tag == "br":
            flow.br()
        elif c.tag == "table" and tables < TABLES:
            flow.block(2)
            flow.verbatim((yield _table(c, sheet, seen, tables + 1)))
            flow.block(2)
        elif c.tag in _BLOCKS:
            gap = 2 if c.tag in _SPACED and not (c.tag in _LIST and e.tag == "li") else 1
            flow.block(gap)
            if c.tag == "hr":
                flow.block(2)
                continue
            indent, marker = flow.indent, flow.marker
            if c.tag == "li":
                number = _integer(c, "value", number)
                flow.mark("- " if e.tag != "ol" else f"{number}. ")
                number += step
            elif c.tag in ("dd", "blockquote"):
                flow.mark("  ")
            yield _render(c, flow, sheet, pre or c.tag in ("pre", "xmp", "listing"), seen, tables)
            flow.block(gap)
            # what stands below the first line is indented as far as the markers before this block
            if flow.marker:
                flow.indent, flow.marker = indent, marker
            else:
                flow.indent, flow.marker = indent + (marker[2] if marker else 0), None
        else:
            if c.tag in ("input", "button") and seen[0] and (value := c.attribute("value")) and (c.attribute("type") or "text").lower() in _VALUED:
                flow.words(value)
            yield _render(c, flow, sheet, pre or c.tag == "textarea", seen, tables)


def _integer(e: Element, name: str, otherwise: int) -> int:
    value = (e.attribute(name) or "").strip()
    return int(value) if re.fullmatch(r"[-+]?[0-9]{1,9}", value) else otherwise


def _start_number(e: Element) -> int:
    return _integer(e, "start", sum(isinstance(c, Element) and c.tag == "li" for c in e.children) if "reversed" in e.attributes else 1)


def _span(e: Element, name: str) -> int:
    return min(max(_integer(e, name, 1), 1), SPAN)


def _lines(e: Element, sheet: Sheet, sight: Sight, tables: int):
    flow = Flow()
    yield _render(e, flow, sheet, False, sight, tables)
    flow.block(1)
    return flow.lines


def _table(table: Element, sheet: Sheet, sight: Sight, tables: int):
    """A table's lines, its cells padded to columns; captions and stray content come first."""
    out: list[str] = []
    rows: list[list[tuple[Element, Sight]]] = []
    stray = Element("div")
    todo = [(c, sight) for c in reversed(table.children)]
    while todo:
        c, seen = todo.pop()
        if isinstance(c, str):
            stray.children.append(c)
            continue
        shown, inner = _shown(c, sheet, seen)
        if not shown or c.tag in ("colgroup", "col"):
            continue
        if c.tag in ("thead", "tbody", "tfoot", "tr"):
            if c.tag == "tr":
                rows.append([])
            todo.extend((x, inner) for x in reversed(c.children))
        elif c.tag in ("td", "th") and rows:
            rows[-1].append((c, inner))
        elif c.tag == "caption":
            out.extend((yield _lines(c, sheet, inner, tables)))
        else:
            stray.children.append(c)
    out.extend((yield _lines(stray, sheet, sight, tables)))
    taken: list[tuple[int, int, int]] = []  # columns that cells from above reach into: first, behind the last, up to which row
    grid: list[list[tuple[int, int, list[str]]]] = []
    for r, row in enumerate(rows):
        taken = [x for x in taken if x[2] > r]
        at, cells, k, more = 0, [], 0, []
        for cell, seen in row:
            while k < len(taken) and taken[k][0] <= at:
                at = max(at, taken[k][1])
                k += 1
            wide, high = _span(cell, "colspan"), _span(cell, "rowspan")
            if high > 1:
                more.append((at, at + wide, r + high))
            cells.append((at, wide, (yield _lines(cell, sheet, seen, tables))))
            at += wide
        taken = sorted(taken + more) if more else taken
        grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for at, wide, lines in cells:
            if wide == 1:
                widths[at] = max(widths.get(at, 0), *(min(len(x), COLUMN) for x in lines), 0)
    left, x = {}, 0
    for c in sorted({at for cells in grid for at, _, _ in cells}):
        left[c] = min(x, ALIGNED)
        x += widths.get(c, 0) + 2 if widths.get(c, 0) else 0
    for cells in grid:
        open_ = [(left[at], lines) for at, _, lines in cells if lines]
        k = 0
        while open_:
            parts, size = [], 0
            for to, lines in open_:
                if lines[k]:
                    gap = max(to - size, 0) if size <= to or not size else 2
                    parts += [" " * gap, lines[k]]
                    size += gap + len(lines[k])
            out.append("".join(parts))
            k += 1
            open_ = [x for x in open_ if k < len(x[1])]
    return out


def to_text(source: str | None) -> str | None:
    """All visible text of a page. None: None; a page without visible text: empty."""
    if source is None:
        return None
    root = parse(source)
    flow = Flow()
    sheet = Sheet(root)
    own = sheet.match(root, 0, 0) | sheet.match(Element("body"), 0, 0) if sheet.bits else 0
    walked(_render(root, flow, sheet, False, (True, own, own), 0))
    flow.block(1)
    return "\n".join(flow.lines)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """pages, its HTML column replaced by ``text``. One row per input row; null HTML: null text; a column named text
    in the input is replaced. Repeated rows give repeated rows. Empty table: no rows.

    Not laid out: elements with ``hidden`` or display:none (inline or by a selector of the page's style sheets that is
    made of tags, classes, ids, descendants and children) with all that they hold. Invisible: visibility:hidden, but for
    elements inside that are made visible again. Layout only, no text is lost: lines are indented up to INDENT columns,
    cells are aligned up to ALIGNED columns and by widths up to COLUMN, cells span up to SPAN rows or columns, and
    tables more than TABLES deep in each other are laid out cell under cell.
    """
    names = [c for c in pages.columns if c not in (column, "text")]
    schema = T.StructType([*(pages.schema[c] for c in names), T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([to_text(x) for x in batch.column(column).to_pylist()], pa.string())], names=[*names, "text"])

    return pages.mapInArrow(run, schema)

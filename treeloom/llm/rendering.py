"""Visible text of HTML pages, laid out as a reader would see it.

Method. A tree is built from the tags with the usual implied ends (a new item ends the item
before it, a block ends an open paragraph, a row ends a cell, and so on) and unmatched ends
ignored. What is not shown is then taken out of the tree: head, scripts, styles, templates,
embedded media, descriptions and definitions in drawings, hidden attributes, closed details and
dialogs, and what inline styles or plain rules of the page's own style sheets (a tag, a class or
an id) hide. ``display: none`` takes an element out with all in it; ``visibility`` is inherited,
so parts of a hidden element can be visible. Of the rules for an element the more specific one
wins, then the later one; those for print do not count, and those that depend on the screen can
show but not hide. All else comes out, formulas and the text elements of drawings too: inline
text with white space collapsed, blocks on lines of their own with a blank line around those
that have margins, list items with their bullet or number and indentation, preformatted text as
it is, and tables as aligned columns. What is nested deeper than DEPTH is laid out plainly:
blocks and rows on lines of their own, without markers, indentation and alignment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Nested blocks, lists and cells up to which there is indentation and alignment.
DEPTH = 300
GAP = "  "

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "head title script style template noscript iframe object canvas audio video datalist desc metadata defs symbol "
    "annotation annotation-xml".split()
)
#: Parts of a drawing whose own text is not drawn; that of the text elements in them is.
DRAWING = frozenset(["svg", "g"])
BLOCK = frozenset(
    "address article aside body center details dialog div dd dl dt fieldset figcaption figure footer form header "
    "hgroup html legend li main menu nav ol option p pre search section summary table ul blockquote caption "
    "h1 h2 h3 h4 h5 h6 tr td th thead tbody tfoot hr textarea select optgroup".split()
)
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl pre blockquote figure table hr fieldset".split())
PARTS = frozenset("caption colgroup thead tbody tfoot".split())

#: What a start tag ends, up to the nearest element that bounds it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "body": ({"head"}, {"html"}),
} | {part: ({"tr", "td", "th", *PARTS}, {"table"}) for part in PARTS}
NO_PARAGRAPH = BLOCK - {"body", "html", "td", "th", "tr", "caption", "thead", "tbody", "tfoot", "option", "optgroup"}
BOUNDS = frozenset({"table", "td", "th", "caption", "template", "html"})

_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
_MARK = re.compile(r"""[{};]|"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'""", re.S)
_SHOWS = re.compile(r"\s*(display|visibility)\s*:\s*([\w-]+)[^!]*(!\s*important)?\s*\Z", re.I)
_SIMPLE = re.compile(r"[.#]?[A-Za-z_][\w-]*\Z")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """The element tree of one page. Whatever the markup is, it ends with a tree."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        #: Where elements of a tag, and blocks of any tag, stand among the open ones.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def _start(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        if node.tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(node)

    def _cut(self, at: int) -> None:
        """Ends the open elements from a place on."""
        while len(self.open) > at:
            tag = self.open.pop().tag
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def _last(self, tags) -> int:
        """The place of the innermost open element with one of the tags; 0 without any."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _last_block(self) -> int:
        return self.blocks[-1] if self.blocks else 0

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self.places.get(tag):
            return
        if tag in ENDS:
            ends, bounds = ENDS[tag]
            at = self._last(ends)
            if at > self._last(bounds):
                while self.open[at - 1].tag in ends:
                    at -= 1
                self._cut(at)
        elif tag in NO_PARAGRAPH:
            at = self._last(["p"])
            if at and at >= max(self._last(BOUNDS), self._last(["button"]), self._last_block()):
                self._cut(at)
        if self.open[-1].tag == "head" and tag not in UNSEEN and tag not in VOID:
            self._cut(len(self.open) - 1)  # a visible element ends the head
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self._start(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.places.get("svg") or self.places.get("math"):
            self.handle_endtag(tag)  # elsewhere the slash means nothing

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return  # what follows still belongs to the page
        at = self._last([tag])
        if not at:
            return
        if tag not in BLOCK and self._last_block() > at:
            return  # the end of bold or a link does not end the block inside it
        if tag not in ("table", "tr", "thead", "tbody", "tfoot") and self._last(BOUNDS) > at:
            return
        self._cut(at)

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._cut(len(self.open) - 1)
        self.open[-1].children.append(data)

    def parse_marked_section(self, i, report=1):
        """Read as a comment, whatever it is."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)


#: Whether rules apply to a reader's screen.
NO, MAYBE, YES = range(3)


def _applies(media: str) -> int:
    """Whether a list of media queries holds on a screen; MAYBE if that depends on the screen."""
    found = []
    for query in media.lower().split(","):
        words = query.split("(")[0].split()
        kind = [w for w in words if w not in ("only", "not", "and")]
        holds = NO if kind and kind[0] not in ("all", "screen") else MAYBE if "(" in query else YES
        if words[:1] == ["not"]:
            holds = YES - holds
        found.append(holds)
    return max(found)


def _inner(prelude: str) -> int:
    """Whether the rules inside an at-rule apply."""
    name, _, condition = prelude[1:].partition(" ")
    if "(" in name:
        name, condition = name[: name.index("(")], prelude[prelude.index("(") :]
    name = name.strip().lower()
    if name == "media":
        return _applies(condition)
    if name == "supports":
        return NO if condition.strip().lower().startswith("not") else YES
    return {"layer": YES, "container": MAYBE, "scope": MAYBE}.get(name, NO)


def _declarations(css: str, applies: int) -> Iterator[tuple[str, str, int]]:
    """Selectors, one declaration, and whether it applies, in order."""
    css = _COMMENT.sub(" ", css)
    blocks: list[tuple[str | None, int]] = [(None, applies)]  # selectors (None: holds rules), applies
    start = 0
    for mark in _MARK.finditer(css):
        if mark[0] not in "{};":
            continue
        text, start = css[start : mark.start()].strip(), mark.end()
        selectors, holds = blocks[-1]
        if mark[0] == "{":
            if selectors is not None:
                blocks.append((None, NO))  # a nested rule has no simple selector
            elif text.startswith("@"):
                blocks.append((None, min(holds, _inner(" ".join(text.split())))))
            else:
                blocks.append((text, holds))
            continue
        if selectors is not None and text:
            yield selectors, text, holds
        if mark[0] == "}" and len(blocks) > 1:
            blocks.pop()
    if blocks[-1][0] is not None:
        yield blocks[-1][0], css[start:], blocks[-1][1]


#: Of the rules that set a property the greatest wins: (important, kind of selector, order, hides).
Rule = tuple[bool, int, int, bool]


def _rule(text: str, kind: int, order: int) -> tuple[str, Rule] | None:
    """The property that a declaration sets, and its rule; None for other properties."""
    found = _SHOWS.match(text)
    if not found:
        return None
    name, value = found[1].lower(), found[2].lower()
    hides = value == "none" if name == "display" else value in ("hidden", "collapse")
    return name, (bool(found[3]), kind, order, hides)


def _sheets(root: Node) -> dict[tuple[str, str], Rule]:
    """What the page's style elements set for each simple selector and property."""
    rules: dict[tuple[str, str], Rule] = {}
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag == "style":
            css = "".join(c for c in node.children if isinstance(c, str))
            for selectors, text, holds in _declarations(css, _applies(node.attrs.get("media", ""))):
                for selector in map(str.strip, selectors.split(",")):
                    found = _rule(text, ".#".find(selector[:1]) + 1, len(rules))
                    if not found or not _SIMPLE.match(selector) or holds == NO or found[1][3] and holds == MAYBE:
                        continue
                    at, rule = (selector, found[0]), found[1]
                    if not rules.get(at, (False,))[0] or rule[0]:
                        rules.pop(at, None)
                        rules[at] = rule
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return {at: (rule[0], rule[1], order, rule[3]) for order, (at, rule) in enumerate(rules.items())}


def take_out_unseen(root: Node) -> None:
    """Leaves in the tree what is shown."""
    rules = _sheets(root)

    def hides(node: Node, name: str) -> bool | None:
        """Whether rules hide the element by a property; None if none sets it."""
        found = []
        if rules:
            classes = [f".{c}" for c in node.attrs.get("class", "").split()]
            selectors = (node.tag, f"#{node.attrs.get('id', '')}", *classes)
            found = [rules[at] for s in selectors if (at := (s, name)) in rules]
        if "style" in node.attrs:
            own = [_rule(text, 3, i) for i, text in enumerate(_COMMENT.sub(" ", node.attrs["style"]).split(";"))]
            found += [r[1] for r in own if r and r[0] == name]
        return max(found)[3] if found else None

    todo = [(root, True)]
    while todo:
        node, visible = todo.pop()
        closed = node.tag == "details" and "open" not in node.attrs
        shown = visible and not closed and node.tag not in DRAWING
        kept = []
        for child in node.children:
            if isinstance(child, str):
                if shown:
                    kept.append(child)
            elif child.tag in UNSEEN or "hidden" in child.attrs or closed and child.tag != "summary":
                continue
            elif not (child.tag == "dialog" and "open" not in child.attrs or hides(child, "display")):
                kept.append(child)
                hidden = hides(child, "visibility")
                todo.append((child, visible if hidden is None else not hidden))
        node.children = kept


class Lines:
    """Lines of a block; ``gap`` blank lines are due before the next one."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0

    def text(self, data: str) -> None:
        data = _SPACE.sub(" ", data)
        body = data.strip(" ")
        if not body:
            self.space = self.space or bool(data)
            return
        if self.line and (self.space or data[0] == " "):
            self.line.append(" ")
        self.line.append(body)
        self.space = data[-1] == " "

    def end_line(self) -> None:
        if self.line:
            self.add(["".join(self.line)])
        self.line, self.space = [], False

    def add(self, lines: list[str]) -> None:
        if lines:
            self.lines += [""] * (self.gap if self.lines else 0)
            self.lines += lines
            self.gap = 0

    def block(self, margin: bool) -> None:
        self.end_line()
        self.gap = max(self.gap, int(margin))

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


class Renderer:
    """Lays out a tree from which all that is not shown has been taken."""

    def __init__(self):
        self.depth = 0

    def lines(self, node: Node) -> list[str]:
        out = Lines()
        self.depth += 1
        self.children(node, out)
        self.depth -= 1
        return out.done()

    def children(self, node: Node, out: Lines) -> None:
        for child in node.children:
            if isinstance(child, str):
                out.text(child)
            elif self.depth < DEPTH:
                self.depth += 1
                self.element(child, out)
                self.depth -= 1
            else:
                self.plain(child, out)

    def plain(self, node: Node, out: Lines) -> None:
        """The text below an element, however deep, with its blocks on lines of their own."""
        todo: list[str | Node | bool] = [node]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                out.text(item)
            elif isinstance(item, bool):
                out.block(item)
            elif item.tag in ("br", "td", "th", "text"):
                out.block(False) if item.tag == "br" else out.text(" ")
                todo += reversed([*item.children, " "])
            elif item.tag in BLOCK:
                out.block(item.tag in MARGIN)
                todo.append(item.tag in MARGIN)
                todo += reversed(item.children)
            else:
                todo += reversed(item.children)

    def element(self, node: Node, out: Lines) -> None:
        tag = node.tag
        if tag == "br":
            if out.line:
                out.end_line()
            else:
                out.gap += bool(out.lines)
            return
        if tag not in BLOCK:
            apart = tag == "text"  # labels of a drawing stand apart
            out.space = out.space or apart
            self.children(node, out)
            out.space = out.space or apart
            return
        margin = tag in MARGIN
        out.block(margin)
        if tag in ("ul", "ol", "menu"):
            self.list_(node, out)
        elif tag == "table":
            out.add(self.table(node))
        elif tag in ("pre", "textarea"):
            out.add(self.preformatted(node))
        elif tag in ("blockquote", "dd"):
            out.add([GAP + line if line else "" for line in self.lines(node)])
        else:
            self.children(node, out)
        out.block(margin)

    def list_(self, node: Node, out: Lines) -> None:
        number = _int(node.attrs.get("start"), 1)
        nested = Lines()
        for child in node.children:
            if isinstance(child, str):
                nested.text(child)
            elif child.tag != "li":
                self.element(child, nested)
            else:
                nested.block(False)
                number = _int(child.attrs.get("value"), number)
                marker = f"{number}. " if node.tag == "ol" else "- "
                number += 1
                indent = " " * len(marker)
                lines = self.lines(child)
                nested.gap = 0
                nested.add([(indent if i else marker) + line if line else "" for i, line in enumerate(lines)])
        out.add(nested.done())

    def preformatted(self, node: Node) -> list[str]:
        parts, todo = [], [node]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                parts.append(item)
            elif item.tag == "br":
                parts.append("\n")
            else:
                todo += reversed(item.children)
        lines = [line.rstrip() for line in "".join(parts).replace("\r\n", "\n").expandtabs(8).split("\n")]
        while lines and not lines[0]:
            lines.pop(0)
        while lines and not lines[-1]:
            lines.pop()
        return lines

    def table(self, node: Node) -> list[str]:
        before, rows, loose = Lines(), [], []
        self.rows(node, rows, before, loose)
        grid: list[dict[int, tuple[int, list[str]]]] = []
        held: dict[int, int] = {}  # columns that a cell from above still takes, and for how many rows
        for row in rows:
            taken, column = {c for c, n in held.items() if n > 0}, 0
            held = {c: n - 1 for c, n in held.items() if n > 1}
            cells = {}
            for cell in row:
                while column in taken:
                    column += 1
                span = max(1, min(_int(cell.attrs.get("colspan"), 1), 1000))
                down = max(1, min(_int(cell.attrs.get("rowspan"), 1), 65534))
                cells[column] = (span, self.lines(cell))
                if down > 1:
                    held |= {c: max(held.get(c, 0), down - 1) for c in range(column, column + span)}
                column += span
            grid.append(cells)
        width: dict[int, int] = {}
        for cells in grid:
            for column, (span, lines) in cells.items():
                width.setdefault(column, 0)
                if span == 1:
                    width[column] = max(width[column], max(map(len, lines), default=0))
        columns = sorted(width)
        left, at = {}, 0
        for column in columns:
            left[column] = at
            at += width[column] + (len(GAP) if width[column] else 0)
        for cells in grid:
            for y in range(max((len(lines) for _, lines in cells.values()), default=0)):
                line = ""
                for column, (_, lines) in sorted(cells.items()):
                    if y < len(lines) and lines[y]:
                        # A cell that spans columns may reach over the next one's place.
                        line = (line + GAP if len(line) > left[column] else line.ljust(left[column])) + lines[y]
                before.add([line.rstrip()])
        for lines in loose:
            before.add(lines)
        return before.done()

    def rows(self, node: Node, rows: list[list[Node]], before: Lines, loose: list[list[str]]) -> None:
        """The rows of a table in order; captions go before it and stray contents after it."""
        stray = Node("", {})
        for child in node.children:
            if isinstance(child, str):
                stray.children.append(child)
            elif child.tag == "caption":
                before.add(self.lines(child))
            elif child.tag in ("thead", "tbody", "tfoot"):
                self.rows(child, rows, before, loose)
            elif child.tag == "tr":
                rows.append([c for c in child.children if isinstance(c, Node) and c.tag in ("td", "th")])
                other = Node("", {})
                other.children = [c for c in child.children if isinstance(c, str) or c.tag not in ("td", "th")]
                loose.append(self.lines(other))
            elif child.tag in ("td", "th"):
                rows.append([child])
            else:
                stray.children.append(child)
        loose.append(self.lines(stray))


def _int(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*-?\d{1,9}\s*", text) else default


def render(html: str | None) -> str:
    """The visible text of a page; null and empty pages have none."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    take_out_unseen(builder.root)
    lines = Renderer().lines(builder.root)
    return "\n".join(lines).replace("\xa0", " ")


def with_text(pages: DataFrame, name: str, html_col: str = "html") -> DataFrame:
    """``pages`` with the visible text of each; all rows and columns come back as they are."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for html in batches:
            yield pa.array([render(h.as_py()) for h in html], pa.string())

    return pages.withColumn(name, text(F.col(f"`{html_col}`").cast("string")))

"""HTML extraction by layout-aware rendering.

A tree builder makes elements of tags, adding those that HTML leaves out (a paragraph ends where a block begins, an item where
the next one does, rows and bodies of tables) and moving stray content of tables before them. Visibility rules then hide what a
browser would not show, and a renderer writes all the rest: blocks on lines of their own, with a blank line where paragraphs
and headings have margins, lists with their markers and indents, and tables with their cells in aligned columns.
Neither step recurses, so depth costs memory only.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = re.compile(r"[ \t\n\r\f]+")
_TAG = re.compile(r"<(/?)([a-zA-Z][^ \t\n\r\f/>]*)((?>[^>\"'=]+|=[ \t\n\r\f]*\"[^\"]*\"|=[ \t\n\r\f]*'[^']*'|[\"'=])*+)>")
_ATTRIBUTE = re.compile(r"([^ \t\n\r\f/>\"'=]+)(?:[ \t\n\r\f]*=[ \t\n\r\f]*(?:\"([^\"]*)\"|'([^']*)'|([^ \t\n\r\f>\"']+)))?")
#: Media queries that hold on a screen of any size.
_SCREEN = frozenset(("", "all", "screen", "only all", "only screen", "not print"))

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Never shown, with all that they hold. Scripts are taken to run, so noscript is not shown.
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes datalist audio video canvas object meta link base param source track area map".split())
#: May stand in the head; what else comes there ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title script style noscript template noframes".split())
#: Blocks that end an open paragraph.
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li listing main menu nav ol optgroup p plaintext pre search section summary table ul xmp legend option caption".split())
#: With a blank line before and after.
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre listing figure dl ol ul menu dir xmp table fieldset".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
TABLE_PART = frozenset("table tbody thead tfoot tr".split())
CELL = frozenset(("td", "th"))
#: Where the search for an open element ends.
LIMITS = frozenset("table td th caption html template button object marquee".split())
LISTS = frozenset("ul ol menu dir".split())
#: Lines of a table's cell are wrapped at spaces beyond this width, as a browser does; a longer word widens its column.
CELL_WIDTH = 60
#: A column is as wide as its longest line, but no wider than this, so that room stays in proportion to text; a longer line moves what follows it in its
#: own line only.
WIDEST = 240
#: Inputs that are buttons, with their value on them, and those that draw no text; all others show their value, or a placeholder.
PRESSED = frozenset(("submit", "button", "reset"))
UNDRAWN = frozenset("hidden checkbox radio password file image color range".split())


class Node:
    __slots__ = ("tag", "attributes", "children", "parent")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent, self.children = tag, attributes, parent, []


def attributes_of(node: Node) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(node.attributes):
        found.setdefault(name.lower(), _html.unescape(a or b or c))
    return found


def on_screen(media: str) -> bool:
    return any(SPACE.sub(" ", one).strip().lower() in _SCREEN for one in media.split(","))


def rules_of(sheet: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules that hold on a screen of any size; rules inside rules are left out."""
    sheet = re.sub(r"/\*.*?\*/", "", sheet, flags=re.S)
    open_, start = [], 0  # of each block: its selectors or None for an at-rule, where its body starts, whether it holds
    for m in re.finditer(r"[{};]", sheet):
        holds = not open_ or open_[-1][2]
        if m[0] == "{":
            before = sheet[start : m.start()].strip()
            if before.startswith("@"):
                name, _, rest = before[1:].replace("(", " (", 1).partition(" ")
                name, *more = SPACE.split(name.lower(), maxsplit=1)
                rest = " ".join([*more, rest])
                open_.append((None, m.end(), holds and (on_screen(rest) if name == "media" else name in ("supports", "layer"))))
            else:
                open_.append((before, m.end(), holds))
        elif m[0] == "}" and open_:
            selectors, body, holds = open_.pop()
            if holds and selectors and all(x[0] is None for x in open_):
                yield selectors, sheet[body : m.start()]
        start = m.end()


class Tree:
    """Builds the tree of a document; root is a node without a tag, sheets the texts of its style elements."""

    def __init__(self, source: str):
        self.root = Node("", "", None)
        self.open, self.sheets = [self.root], []
        self.count: dict[str, int] = {}  # open elements by tag, so that what is not open is not searched for
        self._parse(source)

    def _push(self, node: Node) -> None:
        self.open.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def _drop(self, start: int, end: int | None = None) -> None:
        for node in self.open[start:end]:
            self.count[node.tag] -= 1
        del self.open[start:end]

    def _parse(self, s: str) -> None:
        at = 0
        while True:
            lt = s.find("<", at)
            if lt != at:
                self.text(s[at : lt if lt >= 0 else len(s)])
            if lt < 0:
                return
            m = _TAG.match(s, lt)
            if m:
                at = m.end()
                name = m[2].lower()
                if m[1]:
                    self.end(name)
                else:
                    self.start(name, m[3])
                    if name in RAW:
                        at = self._raw(s, at, name)
                    elif name == "plaintext":
                        self.text(s[at:], entities=False)
                        return
            elif s.startswith("<!--", lt):
                end = s.find("-->", lt + 2)
                at = end + 3 if end >= 0 else len(s)
            elif s[lt + 1 : lt + 2] in ("!", "?") or s.startswith("</", lt) and lt + 2 < len(s):
                end = s.find(">", lt)
                at = end + 1 if end >= 0 else len(s)
            elif s[lt + 1 : lt + 2].isalpha() and s[lt + 1].isascii():
                return  # a tag that never ends
            else:
                self.text("<", entities=False)
                at = lt + 1

    def _raw(self, s: str, at: int, name: str) -> int:
        m = re.compile(rf"</{name}(?=[ \t\n\r\f/>])", re.I).search(s, at)
        end = m.start() if m else len(s)
        inner = s[at:end]
        if name == "style":
            if on_screen(attributes_of(self.open[-1]).get("media", "")):
                self.sheets.append(inner)
        if name in ("textarea", "xmp"):
            self.text(inner[1:] if inner[:1] == "\n" else inner, entities=name == "textarea")
        if self.open[-1].tag == name:
            self._drop(len(self.open) - 1)
        if not m:
            return len(s)
        close = s.find(">", end)
        return close + 1 if close >= 0 else len(s)

    def _within(self, names: frozenset[str] | tuple[str, ...], limits: frozenset[str]) -> int:
        """Index of the innermost open element of these names, before any limit; 0 if there is none."""
        if not any(map(self.count.get, names)):
            return 0
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in names:
                return i
            if tag in limits:
                return 0
        return 0

    def _close(self, names: frozenset[str] | tuple[str, ...], limits: frozenset[str] = LIMITS) -> bool:
        i = self._within(names, limits)
        if i:
            self._drop(i)
        return bool(i)

    def _append(self, child: Node | str) -> None:
        """Into the open element; content that stands between a table's parts goes before the table."""
        here = self.open[-1]
        if here.tag in TABLE_PART and not (isinstance(child, Node) and child.tag in TABLE_PART | CELL | {"caption", "colgroup", "col", "script", "style", "template"}):
            i = self._within(("table",), frozenset())
            table = self.open[i]
            family = table.parent.children
            family.insert(len(family) - 1, child)  # the open table is its parent's last child
            if isinstance(child, Node):
                child.parent = table.parent
            return
        here.children.append(child)
        if isinstance(child, Node):
            child.parent = here

    def text(self, data: str, entities: bool = True) -> None:
        if entities and "&" in data:
            data = _html.unescape(data)
        if self.open[-1].tag == "head" and data.strip(" \t\n\r\f"):
            self._drop(len(self.open) - 1)
        if self.open[-1].tag in TABLE_PART and not data.strip(" \t\n\r\f"):
            return
        self._append(data)

    def start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and self._within((name,), frozenset()):
            return
        if self.open[-1].tag == "head" and name not in IN_HEAD:
            self._drop(len(self.open) - 1)
        if name in BLOCK and name not in ("html", "body", "option", "optgroup", "caption", "legend"):
            if self._within(("head",), frozenset()):
                self._close(("head",), frozenset())
            self._close(("p",))
        if name in HEADING and self.open[-1].tag in HEADING:
            self._drop(len(self.open) - 1)
        elif name == "li":
            self._close(("li",), LIMITS | LISTS)
        elif name in ("dd", "dt"):
            self._close(("dd", "dt"), LIMITS | {"dl"})
        elif name in ("option", "optgroup"):
            self._close(("option",) if name == "option" else ("optgroup", "option"), LIMITS | {"select", "datalist"})
        elif name == "a":
            self._close(("a",), LIMITS)
        elif name in ("rt", "rp", "rb"):
            self._close(("rt", "rp", "rb"), LIMITS | {"ruby"})
        elif name == "button":
            self._close(("button",), LIMITS - {"button"})
        elif name == "body":
            self._close(("head",), frozenset())
        elif name in CELL or name in ("tr", "tbody", "thead", "tfoot", "caption", "colgroup", "col"):
            if not self._table_part(name):
                return
        elif name == "table":
            pass
        node = Node(name, attributes, None)
        self._append(node)
        if name not in VOID and not (attributes.endswith("/") and name in ("path", "circle", "rect", "line", "use", "g")):
            self._push(node)

    def _table_part(self, name: str) -> bool:
        """Make the open elements fit a table's part: close cells, rows and bodies, add a missing body or row."""
        i = self._within(("table",), frozenset({"template"}))
        if not i:
            return False  # outside tables these tags mean nothing
        tags = [n.tag for n in self.open[i:]]
        keep = 1
        if name in CELL or name == "tr":
            if len(tags) > 1 and tags[1] in ("tbody", "thead", "tfoot"):
                keep = 2
                if name in CELL and len(tags) > 2 and tags[2] == "tr":
                    keep = 3
        self._drop(i + keep)
        if name in CELL or name == "tr":
            for need, level in (("tbody", 1), ("tr", 2)):
                if keep == level and (need == "tbody" or name in CELL):
                    node = Node(need, "", None)
                    self._append(node)
                    self._push(node)
                    keep += 1
        return True

    def end(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br":
            self.start("br", "")
            return
        if name == "p":
            if not self._close(("p",)):
                self._append(Node("p", "", None))
            return
        if name in HEADING:
            self._close(HEADING)
            return
        if name in TABLE_PART or name in CELL:
            self._close((name,), frozenset({"template"}) if name == "table" else frozenset({"table", "template"}) - {name})
            return
        limits = LIMITS - {name} if name in LIMITS else LIMITS
        if name == "li":
            limits = limits | LISTS
        i = self._within((name,), limits)
        if i and name not in BLOCK and any(n.tag in BLOCK for n in self.open[i + 1 :]):
            self._drop(i, i + 1)  # the end of an inline element does not end the blocks in it
        elif i:
            self._drop(i)


_COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)")
#: What a rule or a style declares: (display is none, it is !important), (visibility, it is !important); None where it does not.
Declared = tuple[tuple[bool, bool] | None, tuple[str, bool] | None]


class Visibility:
    """Whether an element is shown: its tag, its attributes, its style, and the rules of the document's sheets.

    Selectors of tags, classes and ids, joined by descent or >, are known; rules with others are passed by. The parts of all
    selectors are numbered; of each open element a bit set tells up to which parts it ends a match, so that an element is
    matched against its parent's and its ancestors' bits, in time in proportion to the parts that name its tag, class or id.
    """

    def __init__(self, sheets: list[str]):
        self.parts: dict[str, list[int]] = {}  # by a tag, .class or #id that the part needs
        self.needs: list[tuple[str, frozenset[str], str | None]] = []  # (tag, classes, id) of each part
        self.joins: list[str] = []  # before each part: "" at a selector's start, " " or ">"
        self.rules: dict[int, tuple[tuple[int, ...], Declared]] = {}  # by last part: weight and what is declared
        for sheet in sheets:
            if "display" not in sheet and "visibility" not in sheet:
                continue
            for selectors, body in rules_of(sheet):
                found = self._declared(body)
                if found != (None, None):
                    for one in selectors.split(","):
                        self._add(one.strip(), found)

    def _add(self, selector: str, found: Declared) -> None:
        steps, join = [], ""
        for token in re.sub(r"[ \t\n\r\f]*>[ \t\n\r\f]*", " > ", selector).split():
            if token == ">":
                if not steps or join == ">":
                    return
                join = ">"
                continue
            m = _COMPOUND.fullmatch(token)
            if not m:
                return
            names = re.findall(r"[.#][\w-]+", m[2])
            ids = {n[1:] for n in names if n[0] == "#"}
            if len(ids) > 1:
                return
            steps.append((join or (" " if steps else ""), "" if m[1] in (None, "*") else m[1].lower(), frozenset(n[1:] for n in names if n[0] == "."), next(iter(ids), None)))
            join = ""
        if not steps or join:
            return
        for join, tag, classes, own_id in steps:
            number = len(self.needs)
            self.needs.append((tag, classes, own_id))
            self.joins.append(join)
            self.parts.setdefault(f"#{own_id}" if own_id else f".{min(classes)}" if classes else tag or "*", []).append(number)
        weight = (sum(s[3] is not None for s in steps), sum(len(s[2]) for s in steps), sum(s[1] != "" for s in steps), number)
        self.rules[number] = (weight, found)

    @staticmethod
    def _declared(style: str) -> Declared:
        none = visibility = None
        for part in style.lower().split(";"):
            name, _, value = part.partition(":")
            first = "!important" in value
            value = value.replace("!important", "").strip()
            if name.strip() == "display" and value and not (none and none[1] and not first):
                none = (value == "none", first)
            elif name.strip() == "visibility" and value in ("visible", "hidden", "collapse") and not (visibility and visibility[1] and not first):
                visibility = (value, first)
        return none, visibility

    def _matched(self, tag: str, found: dict[str, str], parent: int, above: int) -> int:
        """The parts of selectors of which the element ends a match, as bits."""
        classes = set(SPACE.split(found.get("class", "")))
        own_id, bits = found.get("id"), 0
        for name in [tag, "*", *(f".{c}" for c in classes), f"#{own_id}"]:
            for i in self.parts.get(name, ()):
                want, needed, want_id = self.needs[i]
                if (not want or want == tag) and needed <= classes and want_id in (None, own_id):
                    join = self.joins[i]
                    if not join or (above if join == " " else parent) >> (i - 1) & 1:
                        bits |= 1 << i
        return bits

    def of(self, node: Node, inherited: bool, parent: int = 0, above: int = 0) -> tuple[bool, bool, int]:
        """(not laid out at all, text is visible, the parts of selectors matched); parent: those of its parent, above: of all
        elements that it is in."""
        tag = node.tag
        if tag in UNSEEN:
            return True, False, 0
        visible, raw = inherited, node.attributes
        if not raw and not self.rules:
            return tag == "dialog", visible, 0
        found = attributes_of(node) if raw else {}
        if "hidden" in found or tag == "input" and found.get("type", "").strip().lower() in UNDRAWN:
            return True, False, 0
        none, bits = tag == "dialog" and "open" not in found, 0
        declared: list[tuple[tuple, Declared]] = []
        if self.rules:
            bits = self._matched(tag, found, parent, above)
            declared = [self.rules[i] for i in _ones(bits) if i in self.rules]
        if "style" in found:
            declared.append(((1 << 30,), self._declared(found["style"])))
        displays = [(d[0][1], weight, d[0][0]) for weight, d in declared if d[0]]
        shown = [(d[1][1], weight, d[1][0]) for weight, d in declared if d[1]]
        if displays:
            none = max(displays)[2]
        if shown:
            visible = max(shown)[2] == "visible"
        return none, visible, bits


def _ones(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def wrapped(line: str, width: int) -> Iterator[str]:
    """The line cut at spaces into lines of width at most, but for longer words; later ones keep the line's indent."""
    indent = len(line) - len(line.lstrip(" "))
    at = indent
    while len(line) - at > width - indent:
        cut = line.rfind(" ", at, at + width - indent + 1)
        if cut <= at:
            cut = line.find(" ", at)
        if cut < 0:
            break
        yield line[:indent] + line[at:cut].rstrip(" ")
        at = cut
        while at < len(line) and line[at] == " ":
            at += 1
    if at < len(line) or not line:
        yield line[:indent] + line[at:]


class Lines:
    """Lines of a block context: the page, or a table's cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # blank lines due before the next line
        self.broken = False  # whether a forced break has just ended a line
        self.marks: list[list[str]] = []  # for each list item or indent: [text for the next line, text for later ones]
        self.keeps = False  # whether the line has text whose white space is kept
        self.kept: set[int] = set()  # the lines that have

    def text(self, data: str, kept: bool) -> None:
        if kept:
            first, *more = data.replace("\r\n", "\n").split("\n")
            self.line += [first] if first else []
            self.keeps = self.keeps or bool(first)
            for one in more:
                self.forced()
                self.line += [one] if one else []
                self.keeps = bool(one)
            return
        data = SPACE.sub(" ", data)
        if not self.line or self.line[-1].endswith(" "):
            data = data.removeprefix(" ")
        if data:
            self.line.append(data)

    def _put(self, text: str) -> None:
        if self.lines and self.gap:
            self.lines += [""] * self.gap
        self.gap = 0
        prefix = "".join(m[0] for m in self.marks)
        for m in self.marks:
            m[0] = m[1]
        if self.keeps:
            self.kept.add(len(self.lines))
        self.lines.append((prefix + text).rstrip())

    def flush(self) -> None:
        text = "".join(self.line).rstrip(" ")
        self.line = []
        if text.strip():
            self._put(text)
        self.keeps = False

    def forced(self) -> None:
        if self.line:
            self.flush()
        elif self.lines and not self.gap:
            self.lines.append("")

    def block(self, margin: int) -> None:
        self.flush()
        self.gap = max(self.gap, margin)

    def whole(self, lines: list[str]) -> None:
        for one in lines:
            if one:
                self._put(one)
            else:
                self.lines.append("")

    def done(self) -> list[str]:
        self.flush()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        return lines


def _number(value: str | None, default: int, most: int = 10**9) -> int:
    m = re.match(r"[ \t\n\r\f]*([+-]?\d{1,9})", value or "")
    return max(-most, min(most, int(m[1]))) if m else default


def _roman(n: int) -> str:
    out = ""
    for value, sign in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += sign * (n // value)
        n %= value
    return out


def _letters(n: int) -> str:
    out = ""
    while n > 0:
        n, r = divmod(n - 1, 26)
        out = chr(97 + r) + out
    return out


def marker(kind: str, n: int) -> str:
    if kind in ("i", "I") and 0 < n < 4000:
        text = _roman(n)
    elif kind in ("a", "A") and n > 0:
        text = _letters(n)
    else:
        text = str(n)
    return (text.upper() if kind in ("I", "A") else text) + ". "


class Grid:
    """A table's cells by row, with the columns that spans take."""

    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.taken: dict[int, int] = {}  # rows still taken, by column
        self.column = 0

    def row(self) -> None:
        if self.rows:
            self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.rows.append([])
        self.column = 0

    def cell(self, columns: int, rows: int, lines: list[str], kept: set[int]) -> None:
        """kept: the lines whose white space is kept; they are never wrapped."""
        if not self.rows:
            self.row()
        while self.column in self.taken:
            self.column += 1
        lines = [part for i, line in enumerate(lines) for part in (wrapped(line, CELL_WIDTH) if len(line) > CELL_WIDTH and i not in kept else [line])]
        self.rows[-1].append((self.column, columns, lines))
        for c in range(self.column, self.column + columns):
            if rows > 1:
                self.taken[c] = rows
        self.column += columns

    def written(self) -> list[str]:
        width: dict[int, int] = {}
        spans: dict[tuple[int, int], int] = {}
        for row in self.rows:
            for column, columns, lines in row:
                if lines:
                    longest = min(max(map(len, lines)), WIDEST)
                    if columns == 1:
                        width[column] = max(width.get(column, 0), longest)
                    else:
                        span = column + columns - 1, column
                        spans[span] = max(spans.get(span, 0), longest)
        # what a spanning cell has beyond its columns is its last one's
        for (last, first), longest in sorted(spans.items()):
            inside = range(first, last + 1) if last - first < len(width) else (c for c in width if first <= c <= last)
            short = longest + 2 - sum(width[c] + 2 for c in inside if c in width)
            if short > 0:
                width[last] = width[last] + short if last in width else max(short - 2, 0)
        # where each column starts: columns that hold nothing of their own take no room
        starts, upto = {}, 0
        for column in sorted({*width, *(c for row in self.rows for c, _, _ in row)}):
            starts[column] = upto
            upto += width[column] + 2 if column in width else 0
        out = []
        for row in self.rows:
            pending = [cell for cell in row if cell[2]]
            for k in range(max((len(lines) for _, _, lines in pending), default=0)):
                parts, length = [], 0
                pending = [cell for cell in pending if k < len(cell[2])]
                for column, _, lines in pending:
                    if lines[k]:
                        pad = max(starts[column] - length, 2 if parts else 0)
                        parts += [" " * pad, lines[k]]
                        length += pad + len(lines[k])
                out.append("".join(parts).rstrip())
        return out


def render(source: str | None) -> str:
    """The visible text of a document, laid out. Null and empty documents give the empty text."""
    if not source:
        return ""
    tree = Tree(source)
    rules = Visibility(tree.sheets)
    contexts, grids, lists = [Lines()], [], []
    # (node, leaving, visible, white space kept, selectors' parts matched by its parent, by all elements that it is in)
    stack: list[tuple] = [(tree.root, False, True, False, 0, 0)]
    while stack:
        node, leaving, visible, kept, parent, above = stack.pop()
        out = contexts[-1]
        if isinstance(node, str):
            if visible:
                out.text(node.replace("\xa0", "\x1f"), kept)
            continue
        tag = node.tag
        if leaving:
            if tag in CELL:
                contexts.pop()
                found = attributes_of(node) if node.attributes else {}
                grids[-1].cell(max(1, _number(found.get("colspan"), 1, 1000)), max(1, _number(found.get("rowspan"), 1, 65534)), out.done(), out.kept)
            elif tag == "table":
                lines = grids.pop().written()
                out.block(1)
                out.whole(lines)
                out.block(1)
            elif tag == "li":
                out.block(0)
                out.marks.pop()
            elif tag in ("dd", "blockquote"):
                out.block(int(tag == "blockquote"))
                out.marks.pop()
            elif tag in LISTS:
                lists.pop()
                out.block(0 if lists else 1)
            elif tag in BLOCK or tag == "tr":
                out.block(int(tag in MARGIN))
            continue
        none, visible, matched = rules.of(node, visible, parent, above)
        if none:
            continue
        if tag == "br":
            out.forced()
            continue
        if tag == "input":
            if visible:
                found = attributes_of(node)
                value = found.get("value", "")
                if not value and found.get("type", "").strip().lower() not in PRESSED:
                    value = found.get("placeholder", "")
                out.text(f" {value} " if value else "", False)  # a box of its own
            continue
        if tag in CELL and grids:
            contexts.append(Lines())
        elif tag == "table":
            grids.append(Grid())
        elif tag == "tr" and grids:
            grids[-1].row()
        elif tag in LISTS:
            found = attributes_of(node) if node.attributes else {}
            items = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
            step = -1 if "reversed" in found else 1
            lists.append([tag == "ol", _number(found.get("start"), items if step < 0 else 1), step, found.get("type", "1")])
            out.block(0 if len(lists) > 1 else 1)
        elif tag == "li":
            out.block(0)
            mark = "- "
            if lists and lists[-1][0]:
                found = attributes_of(node) if node.attributes else {}
                lists[-1][1] = _number(found.get("value"), lists[-1][1])
                mark = marker(lists[-1][3], lists[-1][1])
                lists[-1][1] += lists[-1][2]
            out.marks.append([mark if visible else " " * len(mark), " " * len(mark)])
        elif tag in ("dd", "blockquote"):
            out.block(int(tag == "blockquote"))
            out.marks.append(["  ", "  "])
        elif tag in BLOCK:
            out.block(int(tag in MARGIN))
        kept = kept or tag in ("pre", "listing", "xmp", "plaintext", "textarea")
        children = node.children
        if tag in ("pre", "listing") and children and isinstance(children[0], str) and children[0][:1] == "\n":
            children = [children[0][1:], *children[1:]]
        if tag == "details" and "open" not in attributes_of(node):
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        elif tag == "select":
            options = [c for c in _options(node)]
            chosen = [c for c in options if "selected" in attributes_of(c)] or options[:1]
            children = [x for c in chosen for x in (*c.children, " ")]
        if tag in CELL and not grids:
            tag = "div"
        stack.append((node, True, visible, kept, 0, 0))
        stack += [(c, False, visible, kept, matched, above | matched) for c in reversed(children)]
    return "\n".join(contexts[0].done()).strip("\n").replace("\x1f", " ")


def _options(select: Node) -> Iterator[Node]:
    for c in select.children:
        if isinstance(c, Node):
            if c.tag == "option":
                yield c
            elif c.tag == "optgroup":
                yield from (x for x in c.children if isinstance(x, Node) and x.tag == "option")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row of pages: id_col, text (all visible text, laid out), n_chars, text_sha256.

    Null and empty documents give an empty text; repeated rows and null ids give a row each; an empty table stays empty; other
    columns are ignored. Documents of any length are rendered whole.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(html_col).cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [render(x.as_py()) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array((hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts), pa.string())], names=["_id", "text", "n_chars", "text_sha256"])

    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, text string, n_chars long, text_sha256 string").withColumnRenamed("_id", id_col)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))

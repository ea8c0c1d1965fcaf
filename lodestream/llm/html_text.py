"""HTML extraction by layout-aware rendering.

A small tree builder with implied tags and visibility rules, then a renderer that emits all visible text: blank lines
around paragraphs, headings, lists and tables, one line for other blocks, markers and indentation for list items, table
cells padded to the width of their column. Pages are independent, so one pass over the table with no shuffle does it.

Nulls and edge cases: a null page gives null text, an empty one an empty text. Broken markup (open tags, stray end tags, a
page cut off anywhere) is rendered as far as it goes; a quote that is never closed belongs to its tag's attributes as any
other character. Cells under a rowspan or colspan are empty cells; a column in which no cell begins takes no room. Columns
are padded to their widest cell of up to WIDEST characters; longer cells stick out. A table with a table inside is there for
layout: its cells are blocks, one below another, so that no line is laid out more than once. Indentation stops at DEEPEST
characters, padding at FARTHEST, and no more than MOST_SPANS runs of rowspans shift a row; past these, cells follow one another two blanks apart. Time and memory follow the page's size. Rows
that repeat are rendered alike. Other columns are kept.
"""

from __future__ import annotations

import html
import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame

from lodestream.llm.common import blocks, table

# HTML's element classes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
HIDDEN = {"head", "script", "style", "template", "noscript", "title", "datalist", "noembed", "noframes", "iframe", "object", "audio", "video", "canvas", "desc", "defs", "metadata", "annotation", "annotation-xml"}
FOREIGN = {"svg", "math"}
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "ul", "ol", "dl", "table", "figure", "fieldset", "hr"}
BLOCK = SPACED | {"html", "body", "address", "article", "aside", "center", "dd", "details", "dialog", "dir", "div", "dt", "figcaption", "footer", "form", "header", "hgroup", "legend", "li", "main", "menu", "nav", "search", "section", "summary", "caption", "thead", "tbody", "tfoot", "tr", "td", "th"}
LISTS = {"ul", "ol", "menu", "dir"}
CLOSED_BY = {"li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "caption"}, {"table"}), "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"})}
P_SCOPE = {"td", "th", "caption", "button", "table"}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
ATTR = re.compile(r"[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|(?![\"'])([^\s>]*+)))?")
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<(?:[!?]|/[^a-zA-Z])[^>]*+>?", re.S)
SPACE = re.compile(r"[ \t\n\r\f]+")
WIDEST, DEEPEST = 120, 120
FARTHEST, MOST_SPANS = 4000, 200
#: Attributes that say how text shows.
USED = frozenset("style hidden start value colspan rowspan open multiple size selected disabled".split())


def unescape(text: str) -> str:
    if "&#" in text:  # numbers too long to be a character's
        text = re.sub(r"&#(?:\d{8,}|[xX][0-9a-fA-F]{8,});?", "\ufffd", re.sub(r"&#([xX]?)0+(?=[0-9a-fA-F])", r"&#\1", text))
    return html.unescape(text) if "&" in text else text


def number(text: str, most: int) -> int:
    """The number a text begins with, 1 if none, at most `most`."""
    digits = re.match(r"\s*0*([0-9]*)", text)[1]
    return most if len(digits) > 9 else min(int(digits or "1"), most)


NONE: dict[str, str] = {}


class Node:
    """holds: of a table, whether another is inside."""

    __slots__ = ("tag", "attrs", "children", "holds")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children, self.holds = tag, attrs or NONE, [], False


class Stack:
    """The open elements, and where those of each tag and the blocks among them are."""

    def __init__(self, root: Node):
        self.nodes, self.at, self.blocks = [root], {}, []

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def pop_to(self, n: int) -> None:
        for node in self.nodes[n:]:
            self.at[node.tag].pop()
            if node.tag in BLOCK:
                self.blocks.pop()
        del self.nodes[n:]

    def last(self, tags: set[str]) -> int:
        if tags is BLOCK:
            return self.blocks[-1] if self.blocks else 0
        return max((at[-1] for t in tags if (at := self.at.get(t))), default=0)

    def close(self, tags: set[str], until: set[str]) -> None:
        """Up to the innermost element of `tags`, if none of `until` is within it."""
        if (n := self.last(tags)) and n >= self.last(until):
            self.pop_to(n)


def parse(source: str) -> Node:
    root = Node("html", {})
    stack, done, size, quotes = Stack(root), 0, len(source), True
    while done < size:
        at = source.find("<", done)
        m = None
        while at >= 0 and not (m := TAG.match(source, at) or COMMENT.match(source, at)):
            at = source.find("<", at + 1)
        if text := source[done : at if m else size]:
            stack.nodes[-1].children.append(unescape(text))
        if not m:
            break
        done = m.end()
        if m.re is COMMENT:
            continue
        tag, attrs, first = sys.intern(m[2].lower()), {}, source.find(">", done)
        if first < 0:  # cut off: shown as it is
            stack.nodes[-1].children.append(unescape(source[at:]))
            break
        stop = size if quotes else first
        while done < stop and source[done] != ">" and (a := ATTR.match(source, done, stop)):
            if (name := a[1].lower()) in USED:
                attrs.setdefault(name, unescape(a[2] or a[3] or a[4] or ""))
            done = a.end()
        end = source.find(">", done)
        if end < 0:  # the last ends of tags are within quotes: from here on quotes don't count
            quotes, end = False, first
        closed, done = source[end - 1] == "/", end + 1
        if tag == "html":
            continue
        if m[1]:
            if tag == "p" and not (stack.last({"p"}) > stack.last(P_SCOPE)):  # the end of none is an empty one
                stack.nodes[-1].children.append(Node("p", NONE))
            elif tag in BLOCK or tag in HIDDEN or tag in FOREIGN or tag == "select":
                stack.close({tag}, {"table"} if tag not in ("table", "body", "div") else set())
            else:
                stack.close({tag}, BLOCK)
            continue
        if tag == "select" and stack.at.get("select"):  # within another it ends that one
            stack.close({"select"}, set())
            continue
        if tag in BLOCK:
            if stack.nodes[-1].tag == "head":
                stack.pop_to(len(stack.nodes) - 1)
            stack.close({"p"}, P_SCOPE)
        if tag in CLOSED_BY:
            stack.close(*CLOSED_BY[tag])
        if tag in ("td", "th") and stack.nodes[-1].tag in ("table", "thead", "tbody", "tfoot"):
            row = Node("tr", {})
            stack.nodes[-1].children.append(row)
            stack.push(row)
        node = Node(tag, attrs)
        if tag == "table" and (outer := stack.last({"table"})):
            stack.nodes[outer].holds = True
        stack.nodes[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*+>?", re.I).search(source, done)
            body = source[done : end.start() if end else size]
            node.children.append(unescape(body) if tag == "textarea" else body)
            done = end.end() if end else size
        elif tag not in VOID and not (closed and (tag in FOREIGN or stack.last(FOREIGN))):
            stack.push(node)
    return root


def choose(select: Node) -> None:
    """Hide the options that a closed list does not show; an open list shows each on a line."""
    options, todo = [], [select]
    while todo:
        node = todo.pop()
        if node.tag == "option":
            options.append(node)
        else:
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    if "multiple" in select.attrs or re.fullmatch(r"0*([2-9]|[1-9]\d+)", select.attrs.get("size", "")):
        for o in options:
            o.tag = "div"
        return
    chosen = [o for o in options if "selected" in o.attrs][-1:] or [o for o in options if "disabled" not in o.attrs][:1]
    for o in options:
        if o not in chosen:
            o.attrs = {**o.attrs, "hidden": ""}


class Out:
    """Lines with collapsed white space; gaps between blocks are held back until text follows."""

    def __init__(self):
        self.parts: list[str] = []
        self.gap, self.space, self.prefix, self.mark = 0, False, "", ""

    def block(self, lines: int) -> None:
        self.gap, self.space = max(self.gap, lines), False

    def _start(self) -> None:
        if self.parts:
            self.parts.append("\n" * self.gap)
        if self.gap or not self.parts:
            self.parts.append(self.prefix[: max(len(self.prefix) - len(self.mark), 0)] + self.mark)
            self.mark, self.space = "", False
        self.gap = 0

    def text(self, text: str) -> None:
        words = SPACE.sub(" ", text)
        core = words.strip(" ")
        if not core:
            self.space |= bool(words)
            return
        if self.gap or not self.parts:
            self._start()
        elif self.space or words[0] == " ":
            self.parts.append(" ")
        self.parts.append(core)
        self.space = words[-1] == " "

    def lines(self, lines: list[str]) -> None:
        for line in lines:
            self.block(1)
            self._start()
            self.parts.append(line.rstrip())
        self.block(1)

    def indent(self, n: int) -> int:
        """How far it went in."""
        n = n if len(self.prefix) + n <= DEEPEST else 0
        self.prefix += " " * n
        return n

    def br(self) -> None:
        if self.gap or not self.parts:
            self._start()
        self.gap, self.space = 1, False

    def value(self) -> str:
        return "".join(self.parts)


def aligned(rows: list[list[tuple[int, str]]]) -> list[str]:
    """Cells, with the columns where they begin, padded to their columns' widths; a cell of several lines takes several. Columns in which no cell begins are left out."""
    place = {c: i for i, c in enumerate(sorted({c for row in rows for c, _ in row}))}
    widths, cells = [0] * len(place), [[(place[c], text.split("\n")) for c, text in row] for row in rows]
    for row in cells:
        for i, lines in row:
            widths[i] = max(widths[i], *(len(line) for line in lines if len(line) <= WIDEST), 0)
    upto = [0]
    for w in widths:
        upto.append(upto[-1] + w + 2)
    out = []
    for row in cells:
        for j in range(max((len(lines) for _, lines in row), default=0)):
            line, at = [], 0  # at: where the line stands if no cell sticks out
            for i, lines in row:
                if j < len(lines) and lines[j]:
                    line += [" " * max(min(upto[i], FARTHEST) - at, 2 * bool(line)), lines[j]]
                    at = min(upto[i], FARTHEST) + min(len(lines[j]), widths[i])
            out.append("".join(line))
    return out


def visible(node: Node, shown: bool) -> tuple[bool, bool]:
    """Whether the element is laid out, and whether its own text shows."""
    style = node.attrs.get("style", "").replace(" ", "").lower() if node.attrs else ""
    if node.tag in HIDDEN or (node.attrs and ("hidden" in node.attrs or "display:none" in style)):
        return False, False
    return True, False if "visibility:hidden" in style or "visibility:collapse" in style else True if "visibility:visible" in style else shown


class Grid:
    """A table's rows of (column, text), and the runs of columns that cells above still take: (first, end, up to which row)."""

    def __init__(self):
        self.rows: list[list[tuple[int, str]]] = []
        self.taken: list[list[int]] = []
        self.new: list[list[int]] = []
        self.at = self.run = 0

    def row(self) -> None:
        """Begins a row; what was taken up to it is free again."""
        self.rows.append([])
        self.taken = [t for t in sorted(self.taken + self.new) if t[2] >= len(self.rows)]
        self.new, self.at, self.run = [], 0, 0

    def put(self, row: int, text: str, across: int, down: int) -> None:
        if row == len(self.rows) - 1:  # a cell that ends later, in broken markup, keeps its row's last place
            while self.run < len(self.taken) and self.taken[self.run][0] <= self.at:
                self.at = max(self.at, self.taken[self.run][1])
                self.run += 1
            if down > 1 and len(self.taken) + len(self.new) < MOST_SPANS:
                last = self.new[-1] if self.new else None
                if last and last[1] == self.at and last[2] == row + down:
                    last[1] += across
                else:
                    self.new.append([self.at, self.at + across, row + down])
            self.rows[row].append((self.at, text))
            self.at += across
        else:
            self.rows[row].append((self.rows[row][-1][0] + 1 if self.rows[row] else 0, text))


def render(source: str) -> str:
    outs, lists, tables = [Out()], [], []
    todo: list = [("in", parse(source), True, False)]
    while todo:
        step, node, shown, pre = todo.pop()  # on the way out, pre: what the way in has left
        out = outs[-1]
        if isinstance(node, str):
            if shown and pre:
                for i, line in enumerate(node.split("\n")):
                    if i:
                        out.br()
                    if line.strip():
                        if out.gap or not out.parts:
                            out._start()
                        out.parts.append(line)
            elif shown:
                out.text(node)
            continue
        tag = node.tag
        if tag == "select" and step == "in":
            choose(node)
        gap = 2 if tag in SPACED and not (tag in LISTS and len(lists) > (step == "out")) else 1 if tag in BLOCK or tag in LISTS else 0
        if step == "in":
            there, shown = visible(node, shown)
            if not there:
                continue
            if tag == "br":
                out.br()
                continue
            if tag == "hr":
                out.block(2)
                out.lines(["-" * 8])
                out.block(2)
                continue
            if gap and tag not in ("td", "th"):
                out.block(gap)
            left = None
            if tag in LISTS:
                lists.append([tag == "ol", number(node.attrs.get("start", "1"), 10**9)])
            elif tag == "li":
                of = lists[-1] if lists else [False, 1]
                if value := re.match(r"\s*([+-]?\d{1,9})", node.attrs.get("value", "")):
                    of[1] = int(value[1])
                out.mark = f"{of[1]}. " if of[0] else "- "
                of[1] += 1
                left = out.indent(len(out.mark))
            elif tag in ("dd", "blockquote"):
                left = out.indent(2)
            elif tag == "table":
                tables.append(None if node.holds else Grid())
            elif tag == "tr" and tables and tables[-1]:
                tables[-1].row()
            elif tag in ("td", "th") and tables and not tables[-1]:
                out.block(1)
            elif tag in ("td", "th") and tables and tables[-1].rows:
                left = (tables[-1], len(tables[-1].rows) - 1)
                outs.append(Out())
                lists.append([False, 1])
            todo.append(("out", node, shown, left))
            children = node.children
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            inner = pre or tag in ("pre", "textarea")
            todo += [("in", c, shown, inner) for c in reversed(children)]
            continue
        left = pre
        if tag in LISTS:
            lists.pop()
        elif left and tag in ("li", "dd", "blockquote"):
            out.prefix = out.prefix[:-left]
        elif tag == "table":
            if grid := tables.pop():
                out.lines(aligned(grid.rows))
        elif left:
            lists.pop()
            grid, row = left
            grid.put(row, outs.pop().value(), number(node.attrs.get("colspan", "1"), 1000) or 1, number(node.attrs.get("rowspan", "1"), 65534) or 65534)
            continue
        if tag == "li":
            out.mark = ""
        if gap:
            out.block(gap)
    return outs[0].value()


def _rendered(batches):
    for batch in blocks(batches, "html", 4 << 20):
        texts = [None if t is None else render(t) for t in batch.column("html").to_pylist()]
        keep = [n for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(texts, pa.string())], [*keep, "text"])


def extract(pages: DataFrame) -> DataFrame:
    """The input's columns but `html` and `text`, and the visible `text`."""
    keep = [f for f in pages.schema if f.name not in ("html", "text")]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep)
    return pages.select(*(f"`{f.name}`" for f in keep), "html").mapInArrow(_rendered, f"{fields}text string")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


ORACLE = None

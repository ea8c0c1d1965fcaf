"""A page as a tree, simple selectors, and the article in it by node scores. Plain Python for Arrow batches; all passes are
loops over nodes in document order, so time and memory follow the page's length."""

from __future__ import annotations

import html as _html
import re

from lodestream.functions import fixed_values as fixed
from lodestream.functions.text import SPACES

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
SCOPES = frozenset("ul ol dl menu table td th caption button select object template".split())
#: For a start tag: open elements that it ends, and the scope in which they are looked for (None: the nearest).
ENDS = {"li": ("li", None), "dt": ("dt dd", None), "dd": ("dt dd", None), "option": ("option", None), "tr": ("tr", "table"), "td": ("td th", "table"), "th": ("td th", "table"), "thead": ("tr thead tbody tfoot", "table"), "tbody": ("tr thead tbody tfoot", "table"), "tfoot": ("tr thead tbody tfoot", "table")}
TRACKED = frozenset(["p", *ENDS])

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_IN_TAG = re.compile(r"""=\s*(["'])|>""")
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+)))?""")
_WS = f"[{SPACES}]"
_BLANKS = re.compile(f"[{SPACES.replace(chr(10), '')}]+")
_THREE = re.compile(f"\n{_WS}*\n{_WS}*\n")
_EDGES = re.compile(f"(?m)^{_WS}+|{_WS}+$")


class Node:
    __slots__ = ("attrs", "block", "commas", "gaps", "head", "imgs", "inputs", "kids", "lead", "length", "lis", "links", "parent", "ps", "score", "tag", "trail")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.kids, self.score = tag, attrs, parent, [], None

    def elements(self) -> list[Node]:
        return [k for k in self.kids if not isinstance(k, str)]


def parse(page: str) -> Node:
    """The root of a page's tree. Unclosed and stray tags are mended as browsers do in the common cases."""
    root = Node("#root", {}, None)
    stack, scopes, tables, opened = [root], [("", {})], [], {}
    no_quote, raw_end, at, size = set(), {}, 0, len(page)

    def known(tag: str) -> dict[str, int]:
        """Where the open elements are that a start tag like this one ends: by name their places in the stack."""
        return scopes[tables[-1] if tables and tag in ENDS and ENDS[tag][1] else -1][1]

    def cut(to: int) -> None:
        while len(stack) > to:
            gone = stack.pop()
            opened[gone.tag] -= 1
            if gone.tag in SCOPES:
                scopes.pop()
            if tables and tables[-1] >= len(scopes):
                tables.pop()
            if known(gone.tag).get(gone.tag) == len(stack):
                del known(gone.tag)[gone.tag]

    while at < size:
        lt = page.find("<", at)
        if lt < 0 or lt + 1 >= size:
            lt = size
        if lt > at:
            stack[-1].kids.append(_html.unescape(page[at:lt]))
        if lt == size:
            break
        if page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            at = size if close < 0 else close + 3
            continue
        closing = page[lt + 1] == "/"
        name = _NAME.match(page, lt + 1 + closing)
        if not name:
            if page[lt + 1] in "!?/":
                close = page.find(">", lt)
                at = size if close < 0 else close + 1
            else:
                stack[-1].kids.append("<")
                at = lt + 1
            continue
        tag, p = name[0].lower(), name.end()
        while True:  # quotes count after an equals sign only; one that nothing closes is a character like others
            m = _IN_TAG.search(page, p)
            if not m or m[0] == ">":
                break
            q = -1 if m[1] in no_quote else page.find(m[1], m.end())
            if q < 0:
                no_quote.add(m[1])
            p = m.end() if q < 0 else q + 1
        if not m:
            break  # a tag that never ends
        inside, at = page[name.end() : m.start()], m.end()
        if closing:
            if tag in ENDS and not ENDS[tag][1] or tag == "p":
                if tag in scopes[-1][1]:
                    cut(scopes[-1][1][tag])
            elif opened.get(tag):
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                cut(k)
            continue
        if tag in CLOSES_P and "p" in scopes[-1][1]:
            cut(scopes[-1][1]["p"])
        if tag in ENDS and (ENDS[tag][1] is None or tables):
            if places := [known(tag)[t] for t in ENDS[tag][0].split() if t in known(tag)]:
                cut(min(places))
        node = Node(tag, {a.lower(): _html.unescape(x or y or z) for a, x, y, z in reversed(_ATTR.findall(inside))} if inside.strip(" /") else {}, stack[-1])
        stack[-1].kids.append(node)
        if tag in VOID or inside.endswith("/") and tag in ("svg", "path", "g", "use"):
            continue
        if tag in RAW:
            if raw_end.get(tag) != -1:
                close = re.compile(f"</{tag}", re.I).search(page, at)
                raw_end[tag] = close.start() if close else -1
            stop = size if raw_end[tag] < 0 else raw_end[tag]
            if stop > at:
                node.kids.append(page[at:stop])
            gt = page.find(">", stop)
            at = size if gt < 0 else gt + 1
            continue
        if tag in TRACKED:
            known(tag)[tag] = len(stack)
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
        if tag in SCOPES:
            scopes.append((tag, {}))
            if tag == "table":
                tables.append(len(scopes) - 1)
    return root


def in_order(root: Node, gone=()) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if id(node) not in gone:
            out.append(node)
            todo.extend(reversed(node.elements()))
    return out


def text_of(node: Node, gone=()) -> str:
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif id(x) not in gone:
            todo.extend(reversed(x.kids))
    return "".join(out)


def clean(text: str) -> str:
    """Blanks collapsed, lines trimmed; what stands between two blank lines is joined, as the page scraper does it."""
    return _EDGES.sub("", _THREE.sub("\n\n", _BLANKS.sub(" ", text))).strip(SPACES)


_TO_BLANK = str.maketrans(SPACES, " " * len(SPACES))


def count_words(text: str) -> int:
    return sum(map(bool, text.translate(_TO_BLANK).split(" ")))


# --- selectors: compounds of tag, .class, #id, [name="value"] and [name^="value"], with descendants

_PART = re.compile(r"""^[\w-]+|\.[\w-]+|#[\w-]+|\[[\w-]+\^?="[^"]*"\]""")


def _compound(selector: str):
    tests = []
    for part in _PART.findall(selector):
        if part[0] == ".":
            tests.append(lambda n, v=part[1:]: v in n.attrs.get("class", "").split())
        elif part[0] == "#":
            tests.append(lambda n, v=part[1:]: n.attrs.get("id") == v)
        elif part[0] == "[":
            name, value = part[1:-2].split('="')
            begins = name.endswith("^")
            tests.append(lambda n, a=name.rstrip("^"), v=value, b=begins: n.attrs.get(a, "").startswith(v) if b else n.attrs.get(a) == v)
        else:
            tests.append(lambda n, v=part: n.tag == v)
    return lambda n: all(t(n) for t in tests)


def select(nodes: list[Node], selector: str) -> list[Node]:
    """Of nodes in document order those that match; each step but the last must match an ancestor."""
    *outer, last = map(_compound, selector.split())
    within: set[int] | None = None
    for test in outer:
        below = {id(n) for n in nodes if (within is None or id(n) in within) and test(n)}
        within = set()
        for n in nodes:  # parents come first
            if n.parent is not None and (id(n.parent) in below or id(n.parent) in within):
                within.add(id(n))
    return [n for n in nodes if (within is None or id(n) in within) and last(n)]


def spans(root: Node, gone=()) -> tuple[str, dict[int, tuple[int, int]]]:
    """All text, and of each node by id where its own begins and ends."""
    out, at, begun, todo = [], 0, {}, [(root, False)]
    while todo:
        x, done = todo.pop()
        if isinstance(x, str):
            out.append(x)
            at += len(x)
        elif done:
            begun[id(x)] = (begun[id(x)][0], at)
        elif id(x) not in gone:
            begun[id(x)] = (at, at)
            todo.append((x, True))
            todo.extend((k, False) for k in reversed(x.kids))
    return "".join(out), begun


def cms_text(root: Node) -> str:
    """The elements of the first content selector that gives 30 words, together; else the body's text. Noise is left out. Elements inside one another each count, as a selector has it."""
    nodes = in_order(root)
    gone = {id(n) for selector in fixed.lines(fixed.NOISE_SELECTORS) for n in select(nodes, selector)}
    nodes = in_order(root, gone)
    whole, at = spans(root, gone)
    for selector in fixed.lines(fixed.CMS_SELECTORS):
        texts = [t for n in select(nodes, selector) if len(t := whole[slice(*at[id(n)])].strip(SPACES)) > 20]
        if texts and count_words(out := clean("\n\n".join(texts))) >= 30:
            return out
    body = next((n for n in nodes if n.tag == "body"), root)
    return clean(whole[slice(*at[id(body)])])


# --- the article by node scores

_FIXED = {name: re.compile(pattern, re.I) for name, pattern in fixed.READABLE.items()}
_SCORED = frozenset("section h2 h3 h4 h5 h6 p td pre".split())
_BLOCKS = frozenset("blockquote dl div img ol p pre table ul".split())
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ALWAYS_GONE = frozenset("script style noscript template head link meta".split())
_NOT_IN_ARTICLE = frozenset("form fieldset object embed footer aside input textarea select button iframe".split())
_FIRST = {"div": 5, "pre": 3, "td": 3, "blockquote": 3} | dict.fromkeys("address ol ul dl dd dt li form".split(), -3) | dict.fromkeys("h1 h2 h3 h4 h5 h6 th".split(), -5)


def _names(node: Node) -> str:
    return f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}"


def weight(node: Node) -> int:
    """25 for each of class and id that speaks for content, less 25 for each that speaks against."""
    out = 0
    for name in (node.attrs.get("class", ""), node.attrs.get("id", "")):
        if name:
            out += 25 * bool(_FIXED["positive"].search(name)) - 25 * bool(_FIXED["negative"].search(name))
    return out


def _hidden(node: Node) -> bool:
    style = node.attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style


def pruned(root: Node, unlikely: bool) -> set[int]:
    """Ids of nodes that can't be of the article, subtrees without their root included once."""
    gone, kept = set(), {}
    for node in in_order(root):
        above = kept.get(id(node.parent), False)
        kept[id(node)] = above or node.tag in ("table", "code")
        if id(node.parent) in gone:
            gone.add(id(node))
        elif node.tag in _ALWAYS_GONE or node.tag not in ("html", "body", "#root") and _hidden(node):
            gone.add(id(node))
        elif unlikely and node.tag not in ("html", "body", "a", "#root"):
            names = _names(node)
            if _FIXED["unlikely"].search(names) and not _FIXED["maybe"].search(names) and not above or node.attrs.get("role") in fixed.UNLIKELY_ROLES:
                gone.add(id(node))
    return gone


def measure(root: Node, gone) -> list[Node]:
    """Nodes in document order, each with its length (white space collapsed), commas, link and heading lengths, and counts."""
    nodes = in_order(root, gone)
    for node in reversed(nodes):
        solid = gaps = commas = links = head = ps = imgs = lis = inputs = 0
        lead = trail = block = False
        for kid in node.kids:
            if isinstance(kid, str):
                words = kid.split()
                n, g, a, z, c = sum(map(len, words)), max(len(words) - 1, 0), kid[:1].isspace(), kid[-1:].isspace(), kid.count(",")
            elif id(kid) in gone:
                continue
            else:
                n, g, a, z, c = kid.length - kid.gaps, kid.gaps, kid.lead, kid.trail, kid.commas
                links, head, ps, imgs, lis, inputs = links + kid.links, head + kid.head, ps + kid.ps + (kid.tag == "p"), imgs + kid.imgs + (kid.tag == "img"), lis + kid.lis + (kid.tag == "li"), inputs + kid.inputs + (kid.tag == "input")
                block = block or kid.block or kid.tag in _BLOCKS
            if not n:
                if solid:
                    trail = trail or a or z
                else:
                    lead = lead or a or z
                continue
            if solid:
                gaps += trail or a
            else:
                lead = lead or a
            solid, gaps, trail, commas = solid + n, gaps + g, z, commas + c
        node.length, node.gaps, node.lead, node.trail, node.commas = solid + gaps, gaps, lead, trail, commas
        node.links = (0.3 if node.attrs.get("href", "").startswith("#") else 1.0) * node.length if node.tag == "a" else links
        node.head = node.length if node.tag in _HEADS else head
        node.ps, node.imgs, node.lis, node.inputs, node.block, node.score = ps, imgs, lis, inputs, block, None
    return nodes


def density(node: Node) -> float:
    return node.links / node.length if node.length else 0.0


def _credit(node: Node, length: int, commas: int, weights: bool) -> None:
    """A paragraph's points to the five ancestors from `node` on: whole, half, then a third of the level's number."""
    if length < 25:
        return
    points, level = 2 + commas + min(length // 100, 3), 0
    while node is not None and node.tag != "#root" and level < 5:
        if node.score is None:
            node.score = _FIRST.get(node.tag, 0) + (weight(node) if weights else 0)
        node.score += points / (1 if level == 0 else 2 if level == 1 else level * 3)
        node, level = node.parent, level + 1


def score(nodes: list[Node], gone, weights: bool) -> None:
    for node in nodes:
        if node.tag in _SCORED or node.tag == "div" and not node.block:
            _credit(node.parent, node.length, node.commas, weights)
        elif node.tag == "div":  # runs of text and phrases between blocks are paragraphs
            length = commas = 0
            for kid in node.kids:
                if isinstance(kid, str):
                    length, commas = length + len(" ".join(kid.split())), commas + kid.count(",")
                elif id(kid) in gone:
                    continue
                elif kid.tag in _BLOCKS or kid.block:
                    _credit(node, length, commas, weights)
                    length = commas = 0
                else:
                    length, commas = length + kid.length, commas + kid.commas
            _credit(node, length, commas, weights)
    for node in nodes:
        if node.score is not None:
            node.score *= 1 - density(node)


def _top(nodes: list[Node]) -> Node | None:
    ranked = sorted((n for n in nodes if n.score is not None), key=lambda n: -n.score)[:5]
    if not ranked or ranked[0].tag in ("body", "html"):
        return None
    top = ranked[0]

    def above(n: Node) -> list[Node]:
        out = []
        while n.parent is not None and n.parent.tag not in ("body", "html", "#root"):
            n = n.parent
            out.append(n)
        return out

    near = [{id(x) for x in above(n)} for n in ranked[1:] if top.score > 0 and n.score / top.score >= 0.75]
    if len(near) >= 3:
        top = next((x for x in above(top) if sum(id(x) in s for s in near) >= 3), top)
    last = top.score or 0.0
    least = last / 3
    for x in above(top):
        if x.score is None:
            continue
        if x.score < least:
            break
        if x.score > last:
            top = x
            break
        last = x.score
    for x in above(top):
        if len(x.elements()) != 1:
            break
        top = x
    return top


def _dropped(node: Node, weights: bool) -> bool:
    """Whether a list, table or division inside the article is not of its text."""
    if node.tag in _NOT_IN_ARTICLE:
        return True
    if node.tag not in ("table", "ul", "div"):
        return False
    w, listy = weight(node) if weights else 0, node.tag == "ul"
    if w < 0:
        return True
    if node.commas >= 10:
        return False
    heads = node.head / node.length if node.length else 0.0
    return (
        node.imgs > 1 and node.ps / node.imgs < 0.5
        or not listy and node.lis - 100 > node.ps
        or node.inputs > node.ps // 3
        or not listy and heads < 0.9 and node.length < 25 and (node.imgs == 0 or node.imgs > 2)
        or not listy and w < 25 and density(node) > 0.2
        or w >= 25 and density(node) > 0.5
    )


def article(root: Node) -> str:
    """The text of the part with the best score and of its fitting siblings. Where that is under 500 characters, once more without leaving out unlikely parts, then without weights of names, then without cleaning; the longest of all if none is enough."""
    best = ""
    for unlikely, weights, cleaning in ((True, True, True), (False, True, True), (False, False, True), (False, False, False)):
        gone = pruned(root, unlikely)
        nodes = measure(root, gone)
        score(nodes, gone, weights)
        top = _top(nodes)
        if top is None:
            parts = [next((n for n in nodes if n.tag == "body"), root)]
        else:
            parts, least = [], max(10.0, (top.score or 0.0) * 0.2)
            for x in top.parent.elements():
                if x is top:
                    parts.append(x)
                elif id(x) not in gone:
                    bonus = (top.score or 0.0) * 0.2 if x.attrs.get("class") and x.attrs.get("class") == top.attrs.get("class") else 0.0
                    if x.score is not None and x.score + bonus >= least:
                        parts.append(x)
                    elif x.tag == "p" and (x.length > 80 and density(x) < 0.25 or 0 < x.length < 80 and x.links == 0 and re.search(r"\.( |$)", " ".join(text_of(x, gone).split()))):
                        parts.append(x)
        if cleaning:
            inside = {id(p) for p in parts}
            gone = gone | {id(n) for p in parts for n in in_order(p, gone) if id(n) not in inside and _dropped(n, weights)}
        text = "".join(text_of(p, gone) for p in parts)
        size = len(" ".join(text.split()))
        if size >= 500:
            return text
        if size > len(" ".join(best.split())):
            best = text
    return best


def readable_text(root: Node) -> str:
    text = article(root)
    return clean(text) if len(text.strip(SPACES)) > 50 else ""

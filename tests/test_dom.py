"""The tree of a page, its selectors and node scores, against plain recursive versions, golden pages and odd input."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lodestream.functions import dom
from lodestream.functions import urls as U
from lodestream.operators import pages


def shape(node):
    return [k if isinstance(k, str) else (k.tag, shape(k)) for k in node.kids]


@pytest.mark.parametrize("page, want", [
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", [("ul", [("li", ["a"]), ("li", ["b", ("ul", [("li", ["c"])])]), ("li", ["d"])])]),
    ("<p>a<p>b<div>c</div>d", [("p", ["a"]), ("p", ["b"]), ("div", ["c"]), "d"]),
    ("<table><tr><td>a<td>b<tr><td><table><tr><td>x</table>y</table>z", [("table", [("tr", [("td", ["a"]), ("td", ["b"])]), ("tr", [("td", [("table", [("tr", [("td", ["x"])])]), "y"])])]), "z"]),
    ("a<br>b<img src=x>c</b>d", ["a", ("br", []), "b", ("img", []), "c", "d"]),
    ("<script>if (a<b) '</p>'</script>t<!-- <p> -->u<!doctype x>&amp;&#65;", [("script", ["if (a<b) '</p>'"]), "t", "u", "&A"]),
    ("<a title='it>s' x=y'z>q</a> 1 < 2 <", [("a", ["q"]), " 1 ", "<", " 2 <"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", [("dl", [("dt", ["a"]), ("dd", ["b"]), ("dt", ["c"])])]),
    ("<div><p>open<table><tr><td></p>in</table></div>e", [("div", [("p", ["open"]), ("table", [("tr", [("td", ["in"])])])]), "e"]),
    ("<a href=\"x>never closed", [("a", ["never closed"])]), ("<a href=x never closed", []), ("", []), ("<", []), ("<!-- x", []), ("<style>x", [("style", ["x"])]),
])
def test_trees(page, want):
    assert shape(dom.parse(page)) == want or want == [] and not dom.text_of(dom.parse(page)).strip("<")


def test_attributes():
    node = dom.parse("<DIV Class='a b' id=x data-k=\"1&amp;2\" hidden class=second>").kids[0]
    assert node.tag == "div" and node.attrs == {"class": "a b", "id": "x", "data-k": "1&2", "hidden": ""}


def test_selectors():
    page = '<div class="a b" id="c"><p role="main">1<span class="b">2</span></p></div><p class="b">3</p><i data-w="text-editor.x">4</i>'
    nodes = dom.in_order(dom.parse(page))
    found = {s: [dom.text_of(n) for n in dom.select(nodes, s)] for s in (".b", "p", "#c .b", "div p .b", 'p[role="main"]', '[data-w^="text"]', ".a.b", ".b p", "q")}
    assert found == {".b": ["12", "2", "3"], "p": ["12", "3"], "#c .b": ["2"], "div p .b": ["2"], 'p[role="main"]': ["12"], '[data-w^="text"]': ["4"], ".a.b": ["12"], ".b p": ["12"], "q": []}


def random_page(rnd, depth=0):
    out = []
    for _ in range(rnd.randrange(1, 5)):
        tag = rnd.choice(["div", "div", "p", "section", "a", "ul", "span", "h2", "td", "blockquote"]) if depth < 5 else "text"
        if tag == "text" or rnd.random() < 0.3:
            out.append(" " * rnd.randrange(3) + " ".join(rnd.choice(["some", "words,", "of, a", "text", "\n", "sentence."]) for _ in range(rnd.randrange(12))) + " " * rnd.randrange(2))
        else:
            name = rnd.choice(["", ' class="content"', ' class="sidebar"', ' id="ad-x promo"', ' class="main" id="footer"'])
            inner = f"<li>{random_page(rnd, depth + 1)}</li>" if tag == "ul" else random_page(rnd, depth + 1)
            if tag == "p":
                inner = "text, here " * rnd.randrange(9)
            out.append(f"<{tag}{name}{' href=x' if tag == 'a' else ''}>{inner}</{tag}>")
    return "".join(out)


def plain_scores(root, gone, weights):
    """Points by definition: for each paragraph, from its own text, up to five ancestors."""
    def text(n):
        return n if isinstance(n, str) else "" if id(n) in gone else "".join(map(text, n.kids))

    def flat(n):
        return " ".join(text(n).split())

    def linked(n):
        return 0 if isinstance(n, str) or id(n) in gone else len(flat(n)) * (0.3 if n.attrs.get("href", "").startswith("#") else 1) if n.tag == "a" else sum(map(linked, n.kids))

    def blocky(n):
        return any(not isinstance(k, str) and id(k) not in gone and (k.tag in dom._BLOCKS or blocky(k)) for k in n.kids)

    points = {}

    def give(node, length, commas):
        for level in range(5):
            if length < 25 or node is None or node.tag == "#root":
                return
            points.setdefault(id(node), dom._FIRST.get(node.tag, 0) + (dom.weight(node) if weights else 0))
            points[id(node)] += (2 + commas + min(length // 100, 3)) / (1, 2, 6, 9, 12)[level]
            node = node.parent

    def walk(n):
        if isinstance(n, str) or id(n) in gone:
            return
        if n.tag in dom._SCORED or n.tag == "div" and not blocky(n):
            give(n.parent, len(flat(n)), text(n).count(","))
        elif n.tag == "div":
            run = []
            for k in [*n.kids, None]:
                if k is not None and not isinstance(k, str) and id(k) in gone:
                    continue
                if k is None or not isinstance(k, str) and (k.tag in dom._BLOCKS or blocky(k)):
                    give(n, sum(len(flat(x)) for x in run), sum(text(x).count(",") for x in run))
                    run = []
                else:
                    run.append(k)
        for k in n.kids:
            walk(k)

    walk(root)
    out = {}
    for n in dom.in_order(root, gone):
        if id(n) in points:
            out[id(n)] = points[id(n)] * (1 - (linked(n) / len(flat(n)) if flat(n) else 0))
    return out, {id(n): (len(flat(n)), text(n).count(","), linked(n)) for n in dom.in_order(root, gone)}


@pytest.mark.parametrize("seed", range(30))
def test_scores_against_a_plain_scorer(seed):
    root = dom.parse(f"<body>{random_page(random.Random(seed))}</body>")
    for unlikely, weights in ((True, True), (False, False)):
        gone = dom.pruned(root, unlikely)
        nodes = dom.measure(root, gone)
        dom.score(nodes, gone, weights)
        want, sizes = plain_scores(root, gone, weights)
        assert {id(n): n.score for n in nodes if n.score is not None} == pytest.approx(want)
        assert {id(n): (n.length, n.commas, round(n.links, 6)) for n in nodes} == {k: (a, b, round(c, 6)) for k, (a, b, c) in sizes.items()}


SENTENCE = "This is a sentence of the article, with a comma, and it says something of interest. "


def page_with(article):
    links = "".join(f'<li><a href="/{i}">Link number {i} to somewhere</a></li>' for i in range(30))
    return f'<html><head><title>T</title><style>x</style></head><body><div class="menu"><ul>{links}</ul></div><div id="wrap">{article}</div><div class="sidebar"><p>{"Subscribe now, it is free. " * 20}</p></div><div class="footer"><p>{"All rights reserved, of course. " * 20}</p></div></body></html>'


def test_articles():
    paragraphs = "".join(f"<p>{SENTENCE * 3}{i}</p>" for i in range(6))
    text = dom.readable_text(dom.parse(page_with(f'<div class="post"><h2>Head</h2>{paragraphs}<div class="share"><a href=x>Share</a></div></div>')))
    assert text.count("This is a sentence") == 18 and "Link number" not in text and "Subscribe" not in text and "reserved" not in text and "Share" not in text
    plain = dom.readable_text(dom.parse(page_with("".join(SENTENCE * 2 + "<br><br>" for _ in range(6)))))
    assert plain.count("This is a sentence") == 12 and "Link number" not in plain
    hidden = dom.readable_text(dom.parse(page_with(f"{paragraphs}<p style='display: none'>secret {SENTENCE}</p><p hidden>secret too {SENTENCE}</p>")))
    assert "secret" not in hidden and hidden.count("This is a sentence") == 18
    inside_comment = dom.readable_text(dom.parse(f'<body><div class="comment">{paragraphs}</div></body>'))
    assert inside_comment.count("This is a sentence") == 18  # nothing else is there, so unlikely names count
    assert dom.readable_text(dom.parse("<p>short</p>")) == ""


def test_tiers(spark):
    words = "words of a region that say a thing each "
    rows = [
        (1, page_with("".join(f"<p>{SENTENCE * 3}</p>" for _ in range(6)))),
        (2, "<body>" + "".join(f'<div hidden class="et_pb_text_inner"><b>{words}</b><nav>{words}</nav></div>' for _ in range(4)) + "</body>"),
        (3, f"<body><header>{words * 9}</header></body>"), (4, "<header><main>" + words * 9 + "</main></header>"), (5, "<p>one two</p>"), (6, None), (7, ""),
    ]
    got = {r.page_id: r for r in pages.dom_text(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert [got[i].extraction_method for i in (1, 4, 6, 7)] == ["readability", "readability", "none", "none"]
    assert got[2].extraction_method == "cms_dom" and got[2].word_count == 33
    assert got[3].word_count == 81 and got[5].word_count == 2 and got[6].word_count == 0
    assert pages.dom_text(spark.createDataFrame(rows, "page_id long, html string").limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<table><tr><td>x" * 4000, "<table><ul>" + "<td>" * 40_000, "<div>" * 30_000 + "text", "<a " * 40_000 + '"', "<a b=\"<a c='" * 20_000, "<ul><li>" * 20_000, "<main>" * 3000 + "some words " * 100, "<p>some text, more " * 10_000, "<!--" * 50_000, " \n" * 100_000, "</div>" * 40_000, "<script>" * 30_000])
def test_odd_pages_take_linear_time(page):
    began = time.time()
    root = dom.parse(page)
    dom.readable_text(root), dom.cms_text(root)
    assert time.time() - began < 20


BASE = "http://a/b/c/d;p?q"
# The examples of RFC 3986, 5.4.1 and 5.4.2.
RFC = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
    "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s", "": "http://a/b/c/d;p?q",
    ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
    "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g",
    "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y",
    "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x",
}


def test_references_of_rfc_3986(spark):
    rows = spark.createDataFrame([(k,) for k in RFC], "href string")
    assert {r.href: r.url for r in rows.select("href", U.absolute(F.lit(BASE), F.col("href")).alias("url")).collect()} == RFC

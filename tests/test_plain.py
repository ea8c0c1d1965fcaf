"""Queries without SQL against plain Python over the whole smallest tables."""

import re
from urllib.parse import urljoin

import pyarrow.parquet as pq

from lodestream.functions import fixed_values as fixed
from lodestream.plans import catalog

ANCHOR = re.compile(r"""<a\s[^>]*href\s*=\s*["']([^"'#][^"']*)["'][^>]*>(.*?)</a>""", re.I | re.S)
SPACE = " \t\n\x0b\f\r                 　﻿"
W = r"[\s   -     　﻿]"


def table(sf_dir, name):
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


def host(url):
    m = re.match(r"[a-zA-Z]+://([^/?#:]+)", url)
    return re.sub(r"^www\.", "", m[1].lower()) if m else ""


def cleaned(url):
    url = re.sub(r"#.*$", "", url)
    path, _, query = url.partition("?")
    drop = {x.lower() for x in fixed.TRACKING_PARAMS}
    kept = [q for q in query.split("&") if q and q.partition("=")[0].lower() not in drop]
    return path + ("?" + "&".join(kept) if kept else "")


def links(piece, base):
    for m in ANCHOR.finditer(piece):
        if not re.match(r"\s*(mailto:|javascript:|tel:|ftp:|data:)", m[1], re.I):
            yield cleaned(urljoin(base, m[1].strip(SPACE))), re.sub(r"<[^>]*>", "", m[2]).strip(SPACE)[:200]


def test_page_links(spark, sf_dir):
    plain = []
    for p in table(sf_dir, "pages"):
        seen = {}
        for section in ("nav", "header", "footer", "body"):
            piece = p["html"] if section == "body" else "\n".join(m[0] for m in re.finditer(rf"<{section}[\s>].*?</{section}>", p["html"], re.I | re.S))
            for url, text in links(piece, p["url"]):
                seen.setdefault(url, (text, section))
        plain += [(p["page_id"], u, t, s) for u, (t, s) in seen.items() if host(u) == host(p["url"])]
    assert sorted(map(tuple, catalog.queries()["page_links"](spark, sf_dir).collect())) == sorted(plain)


def test_deep_links(spark, sf_dir):
    pages = table(sf_dir, "pages")
    known, seen = {p["url"] for p in pages}, {}
    for p in sorted(pages, key=lambda p: p["page_id"]):
        if "/en/" in re.sub(r"^[a-zA-Z]+://[^/?#]+([^?#]*).*$", r"\1", p["url"]).lower():
            for url, text in links(p["html"], p["url"]):
                path = re.sub(r"^[a-zA-Z]+://[^/?#]+([^?#]*).*$", r"\1", url).lower()
                junk = re.search(fixed.JUNK_EXTENSIONS, path) or any(j in path for j in fixed.JUNK_PATHS) or not re.match(r"https?://[^/?#\s@]+", url)
                if not junk and url not in known:
                    seen.setdefault(url, (p["url"], text))
    assert sorted(map(tuple, catalog.queries()["deep_links"](spark, sf_dir).collect())) == sorted((u, f, t) for u, (f, t) in seen.items())


def text_of(html):
    def first(p):
        m = re.search(p, html, re.I | re.S)
        return m[1] if m else None

    regions = [first("<main[^>]*>(.*?)</main>"), first("<article[^>]*>(.*?)</article>"), *(m if m and len(m) > 100 else None for m in (first(p.removeprefix("(?is)")) for p in fixed.REGIONS)), first("<body[^>]*>(.*?)</body>"), html]
    return cleaned_text(next(r for r in regions if r is not None))


def cleaned_text(out):
    for tag in ("script", "style", "nav", "footer", "header", "aside", "noscript"):
        out = re.sub(rf"<{tag}[^>]*>.*?</{tag}>", "", out, flags=re.I | re.S)
    blocks = "p|div|h[1-6]|li|tr|blockquote|section|article|figcaption"
    for p, by in ((r"<br\s*/?>", "\n"), (rf"</(?:{blocks})>", "\n\n"), (rf"<(?:{blocks})[^>]*>", ""), (r"</(?:ul|ol|table|dl)>", "\n"), (r"<(?:hr)[^>]*/?>", "\n---\n"), ("<[^>]+>", " ")):
        out = re.sub(p, by, out, flags=re.I)
    for entity, c in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'")):
        out = out.replace(entity, c)
    out = re.sub(r"&#(\d{1,7});", lambda m: chr(int(m[1])), out)
    out = re.sub(r"&#x([0-9a-fA-F]{1,6});", lambda m: chr(int(m[1], 16)), out).replace("&nbsp;", " ")
    out = re.sub(r"\n\s*\n", "\n\n", re.sub(r"[^\S\n]+", " ", out))
    return re.sub(r"^\s+|\s+$", "", out, flags=re.M).strip(SPACE)


def test_extract_text(spark, sf_dir):
    got = {r.page_id: (r.text_content, r.word_count) for r in catalog.queries()["extract_text"](spark, sf_dir).collect()}
    plain = {p["page_id"]: (t := text_of(p["html"]), len([w for w in re.split(f"{W}+", t) if w])) for p in table(sf_dir, "pages")}
    assert got == plain


def test_extraction_tiers(spark, sf_dir):
    got = {r.page_id: (r.text_content, r.word_count, r.extraction_method) for r in catalog.queries()["extraction_tiers"](spark, sf_dir).collect()}
    methods = set()
    for p in table(sf_dir, "pages"):
        k, words = p["page_id"], "some words of text " * (p["page_id"] % 13)
        html = ("<article><p>" + words + "</p></article>" if k % 3 == 0 else f'<div class="entry-content">{words}</div><div class="entry-content">more</div>' if k % 3 == 1 else "") + p["html"]
        article = re.search("<article[^>]*>(.*?)</article>", html, re.I | re.S) or re.search("<main[^>]*>(.*?)</main>", html, re.I | re.S)
        regions = [m[1] for r in fixed.REGIONS for m in re.finditer(r.removeprefix("(?is)"), html, re.I | re.S)]
        best = ("", 0, "none")
        for method, text in (("readability", cleaned_text(article[1]) if article else ""), ("cms_dom", cleaned_text("\n\n".join(regions))), ("regex_fallback", text_of(html))):
            n = len([w for w in re.split(f"{W}+", text) if w])
            if best[1] < 30 and n > best[1]:
                best = (text, n, method)
        assert got[k] == best
        methods.add(best[2])
    assert len(methods) >= 3


def test_split_sentences(spark, sf_dir):
    plain = []
    for d in table(sf_dir, "documents"):
        if d["text"] is None:
            continue
        text = d["text"]
        for _, p, by in fixed.MARKDOWN_MARKS:
            text = re.sub(p, by.replace("$1", r"\1"), text)
        for long, short in fixed.ABBREVIATIONS:
            text = re.sub(r"(?<![A-Za-z0-9_])" + re.escape(long), short + "\x01", text)
        parts = [s.replace("\x01", ".").strip(SPACE) for s in re.split(rf"(?<=[.!?]){W}+", text)]
        plain += [(d["doc_id"], i, s) for i, s in enumerate(s for s in parts if len(s) > 10)]
    assert sorted(map(tuple, catalog.queries()["split_sentences"](spark, sf_dir).collect())) == sorted(plain)


def test_html_output(spark, sf_dir):
    """Every article's page, put together by hand from its parts."""
    parts = {p["p_partkey"]: p for p in table(sf_dir, "part")}
    rows = {r.entity_name: r for r in catalog.queries()["html_output"](spark, sf_dir).collect()}
    assert len(rows) == len(parts)
    for k, p in parts.items():
        r = rows[f"{p['p_name']} {k}"]
        title = " ".join(w[:1].upper() + w[1:] for w in p["p_brand"].lower().replace("#", "-").split("-"))
        cite = lambda n: f'<sup><a href="#cite-{n}">[{n}]</a></sup>'
        body = [f"<h2>{title}</h2>", f"<p>The company was founded in 19{k % 90 + 10:02d} in a <strong>small</strong> town. It employs over {k} people now {cite(k % 5 + 1)}. Growth is steady and calm here. A share of {k % 100}% was sold {cite(1)}.</p>", "<ul><li>first point</li><li>second point</li></ul>", "<h2>Meta</h2>", "<p>Title: x</p>"]
        sources = "".join(f'<li id="cite-{i}"><a href="https://s{i}.org/{k}">Source {i}</a></li>' for i in (1, 2, 3))
        page = f'<!DOCTYPE html>\n<html lang="en"><head><meta charset="utf-8"><title>About {p["p_name"]}</title></head><body>\n' + "\n".join(body) + f"\n<ol>{sources}</ol>\n</body></html>"
        assert r.final_html == page and r.heading_count == 2

"""SQL of the queries that read pages and articles by patterns. Its patterns are those of RE2, which looks neither ahead nor behind."""

from __future__ import annotations

from lodestream.functions import fixed_values as fixed
from lodestream.plans import oracles

_WS = r"[\s\x{b}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _matched(text: str, pattern: str) -> str:
    """The first group of the first match, null without one."""
    return f"CASE WHEN regexp_matches({text}, {_text(pattern)}) THEN regexp_extract({text}, {_text(pattern)}, 1) END"


def _replaced(text: str, *rules: tuple[str, str]) -> str:
    for pattern, by in rules:
        text = f"regexp_replace({text}, {_text(pattern)}, {by if by.startswith('chr(') else _text(by)}, 'g')"
    return text


def _trimmed(text: str) -> str:
    return _replaced(text, (rf"\A{_WS}+|{_WS}+\z", ""))


def _words(text: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({text}, ''), {_text(_WS + '+')}), lambda w: w <> ''))::INT"


def _domain(url: str) -> str:
    return f"regexp_replace(lower(regexp_extract({url}, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\\.', '')"


def _path(url: str) -> str:
    return f"lower(regexp_extract({url}, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1))"


def _anchors(rows: str) -> str:
    """CTEs `each` and `found` of the links in the column part of `rows`: base, link, link_text and i. Links of these tables are whole or begin at the root."""
    target = "regexp_replace(CASE WHEN starts_with(h, '/') THEN regexp_extract(base, '^([a-zA-Z]+://[^/?#]+)', 1) || h ELSE h END, '#.*$', '')"
    return f"""each AS (SELECT * EXCLUDE (hs, ts), {_trimmed('hs[i]')} AS h, ts[i] AS t FROM (SELECT * EXCLUDE (part, hs), unnest(range(1, len(hs) + 1)) AS i, hs FROM (SELECT *, regexp_extract_all(part, {_text(fixed.ANCHOR)}, 1) AS hs, regexp_extract_all(part, {_text(fixed.ANCHOR)}, 2) AS ts FROM {rows}))),
      found AS (SELECT *, {target} AS link, left({_trimmed(_replaced('t', ('<[^>]*>', '')))}, 200) AS link_text FROM each WHERE NOT regexp_matches(h, '(?i)^({'|'.join(fixed.NO_LINKS)})') AND regexp_matches(h, '^(https?://|/[^/])'))"""


def _section(name: str) -> str:
    return f"array_to_string(regexp_extract_all(html, {_text(rf'(?is)<{name}[\s>].*?</{name}>')}), chr(10))"


_CHROME = [(rf"(?is)<{tag}[^>]*>.*?</{tag}>", "") for tag in fixed.CHROME_TAGS]
_BREAKS = [*fixed.TEXT_BREAKS, ("<[^>]+>", " ")]


def _cleaned(html: str) -> str:
    """The text of a piece of HTML; the tables' pages have no numeric references."""
    out = _replaced(html, *_CHROME, *_BREAKS)
    for entity, c in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " ")):
        out = f"replace({out}, {_text(entity)}, {_text(c)})"
    return _trimmed(_replaced(out, (r"[^\S\n]+", " "), (r"\n\s*\n", "chr(10) || chr(10)"), (r"(?m)^\s+|\s+$", "")))


def _main(html: str) -> str:
    """The main part of a page: by tag, by a content system's region of over 100 characters, the body, or all of it."""
    regions = (f"CASE WHEN length({_matched(html, p)}) > 100 THEN {_matched(html, p)} END" for p in fixed.REGIONS)
    return f"coalesce({_matched(html, '(?is)<main[^>]*>(.*?)</main>')}, {_matched(html, '(?is)<article[^>]*>(.*?)</article>')}, {', '.join(regions)}, {_matched(html, '(?is)<body[^>]*>(.*?)</body>')}, {html})"


_BLOCKED = " + ".join(f"contains(lower(t), {_text(m)})::INT" for m in fixed.lines(fixed.BLOCK_PAGE_MARKERS))
_REGIONS_OF = " || ".join(f"regexp_extract_all(html, {_text(p)}, 1)" for p in fixed.REGIONS)
_ARTICLE = f"coalesce({_matched('html', '(?is)<article[^>]*>(.*?)</article>')}, {_matched('html', '(?is)<main[^>]*>(.*?)</main>')})"


def _sentences(text: str) -> str:
    """A list of sentences; a mark before an abbreviation is kept by a group, and twice, for one that follows another."""
    rules = [(pattern, by.replace("$", "\\")) for _, pattern, by in fixed.MARKDOWN_MARKS]
    out = _replaced(text, *rules)
    same = "|".join(long[:-1] for long, short in fixed.ABBREVIATIONS if long == short + ".")
    for _ in range(2):
        out = _replaced(out, (rf"(^|[^A-Za-z0-9_])({same})\.", "\\1\\2\x01"))
    for long, short in fixed.ABBREVIATIONS:
        if long != short + ".":
            out = _replaced(out, (rf"(^|[^A-Za-z0-9_]){long.replace('.', '[.]')}", f"\\1{short}\x01"))
    parts = f"string_split({_replaced(out, (rf'([.!?]){_WS}+', '\\1' + chr(2)))}, chr(2))"
    return f"list_filter(list_transform({parts}, lambda s: {_trimmed('replace(s, chr(1), ' + _text('.') + ')')}), lambda s: length(s) > 10)"


ORACLES = {
    "page_links": f"""WITH s AS (SELECT page_id, url AS base, unnest([0, 1, 2, 3]) AS r, unnest([{_section('nav')}, {_section('header')}, {_section('footer')}, html]) AS part FROM pages), {_anchors('s')}
      SELECT page_id, link AS url, link_text, ['nav', 'header', 'footer', 'body'][r + 1] AS source_location FROM (SELECT *, row_number() OVER (PARTITION BY page_id, link ORDER BY r, i) AS n FROM found) WHERE n = 1 AND {_domain('link')} = {_domain('base')}""",
    "deep_links": f"""WITH s AS (SELECT page_id, url AS base, html AS part FROM pages WHERE contains({_path('url')}, '/en/')), {_anchors('s')},
      k AS (SELECT * FROM found WHERE NOT regexp_matches({_path('link')}, {_text(fixed.JUNK_EXTENSIONS)}) AND NOT ({' OR '.join(f"contains({_path('link')}, {_text(p)})" for p in fixed.JUNK_PATHS)}) AND link NOT IN (SELECT url FROM pages WHERE url IS NOT NULL))
      SELECT link AS url, base AS found_on, link_text FROM k QUALIFY row_number() OVER (PARTITION BY link ORDER BY page_id, i) = 1""",
    "extract_text": f"""WITH m AS MATERIALIZED (SELECT page_id, {_main('html')} AS part, {_matched('html', '''(?i)<meta[^>]+property=["']og:description["'][^>]+content=["']([^"']+)["']''')} AS og FROM pages), x AS MATERIALIZED (SELECT page_id, og, {_cleaned('part')} AS t FROM m)
      SELECT page_id, {_words('t')} AS word_count, CASE WHEN {_words('t')} < 50 OR {_BLOCKED} >= 2 OR coalesce(length(og) >= 100 AND length(t) <= length(og), FALSE) THEN 'low_content' ELSE 'success' END AS status, CASE WHEN length(t) > 150 THEN left(t, 150) || '...' ELSE t END AS text_preview, t AS text_content FROM x""",
    "extraction_tiers": f"""WITH p AS MATERIALIZED (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '<article><p>' || repeat('some words of text ', (page_id % 13)::INT) || '</p></article>' WHEN 1 THEN '<div class="entry-content">' || repeat('some words of text ', (page_id % 13)::INT) || '</div><div class="entry-content">more</div>' ELSE '' END || html AS html FROM pages),
      m AS MATERIALIZED (SELECT page_id, coalesce({_ARTICLE}, '') AS a, array_to_string({_REGIONS_OF}, chr(10) || chr(10)) AS b, {_main('html')} AS c FROM p), x AS MATERIALIZED (SELECT page_id, {_cleaned('a')} AS a, {_cleaned('b')} AS b, {_cleaned('c')} AS c FROM m),
      n AS (SELECT *, {_words('a')} AS na, {_words('b')} AS nb, {_words('c')} AS nc FROM x),
      k AS (SELECT *, CASE WHEN na >= 30 THEN 1 WHEN nb >= 30 THEN 2 WHEN greatest(na, nb, nc) = 0 THEN 0 WHEN na >= nb AND na >= nc THEN 1 WHEN nb >= nc THEN 2 ELSE 3 END AS tier FROM n)
      SELECT page_id, coalesce([a, b, c][tier], '') AS text_content, coalesce([na, nb, nc][tier], 0)::INT AS word_count, ['none', 'readability', 'cms_dom', 'regex_fallback'][tier + 1] AS extraction_method FROM k""",
    "html_output": f"""WITH {oracles._MD}, x AS (SELECT entity_name, concat_ws(chr(10), '<!DOCTYPE html>', '<html lang="en"><head><meta charset="utf-8"><title>About ' || p_name || '</title></head><body>', '<h2>' || replace(p_brand, '#', ' ') || '</h2>',
        '<p>' || regexp_replace(regexp_replace(para, '[*]{{2}}(.*?)[*]{{2}}', '<strong>\\1</strong>', 'g'), '\\[#(\\d+)\\]', '<sup><a href="#cite-\\1">[\\1]</a></sup>', 'g') || '</p>', '<ul><li>first point</li><li>second point</li></ul>', '<h2>Meta</h2>', '<p>Title: x</p>',
        '<ol>' || array_to_string(list_transform([1, 2, 3], lambda i: '<li id="cite-' || i || '"><a href="https://s' || i || '.org/' || k || '">Source ' || i || '</a></li>'), '') || '</ol>', '</body></html>') AS final_html FROM m)
      SELECT entity_name, final_html, floor(octet_length(encode(final_html)) / 1024 * 10 + 0.5) / 10 AS html_size_kb, 2 AS heading_count FROM x""",
    "split_sentences": f"WITH x AS (SELECT doc_id, {_sentences('text')} AS l FROM documents) SELECT doc_id, (i - 1)::INT AS pos, l[i] AS sentence FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM x)",
}

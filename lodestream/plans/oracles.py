"""The SQL that queries are checked against; see catalog.py for what each computes."""

from __future__ import annotations

from lodestream.functions import fixed_values as fixed

_DOMAIN = "regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\\.', '')"
_ITEMS = f"p AS (SELECT page_id, page_id AS pool_pos, url, {_DOMAIN} AS entity_name, html FROM pages)"
_VARIANTS = f"{_ITEMS}, v AS (SELECT pool_pos, url, entity_name FROM p UNION ALL SELECT pool_pos + 1000000000, upper(regexp_replace(url, '[?#].*$', '')) || '/#x', entity_name FROM p)"


def _norm(u: str) -> str:
    full = f"CASE WHEN starts_with({u}, 'http') THEN {u} ELSE 'https://' || {u} END"
    out = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({full}, '#.*$', ''), '\\?[^#]*', ''), '(?i)^([a-z]+://)www\\.', '\\1'), '/+$', '')"
    return f"lower(CASE WHEN regexp_matches({full}, '^https?://[^/?#\\s@]+') THEN {out} ELSE regexp_replace({u}, '/+$', '') END)"


_STOP = ", ".join(f"'{w}'" for w in fixed.STOP_WORDS)
_ENGLISH = f"len(list_filter(regexp_split_to_array(lower(left(coalesce(text, ''), 200)), '\\s+'), lambda w: w IN ({_STOP}))) >= 3"
_WORDS = "len(regexp_extract_all(coalesce(text, ''), '\\S+'))"
_TITLES = "\n".join(f"WHEN contains(lower(title), '{k}') THEN 'Title keyword: {k}'" for k in fixed.EXCLUDED_TITLES)
_URLS = "\n".join(f"WHEN contains(lower(url), '{k}') THEN 'URL pattern: {k}'" for k in fixed.EXCLUDED_URLS)
_DOCS = "d AS (SELECT doc_id, source AS entity_name, text, CASE WHEN doc_id % 50 = 0 THEN 'error' ELSE 'success' END AS status, 'https://x.org/' || source || CASE WHEN doc_id % 7 = 0 THEN '/tag/' ELSE '/p/' END || doc_id AS url, CASE WHEN doc_id % 11 = 0 THEN 'Cookie notice' ELSE 'Page' END AS title FROM documents)"
_TRIM = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_BLOCKS = f"b AS (SELECT entity_name, doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, block, {_TRIM.format('regexp_replace(lower(block), chr(92) || chr(115) || chr(43), chr(32), chr(103))')} AS norm FROM (SELECT entity_name, doc_id, i, {_TRIM.format('l[i]')} AS block FROM (SELECT *, string_split(coalesce(text, ''), chr(10)) AS l FROM d), unnest(range(1, len(l) + 1)) AS t(i)) WHERE block <> '')"
_FREQUENT = "f AS (SELECT entity_name, norm, n FROM (SELECT entity_name, norm, count(DISTINCT doc_id) AS n FROM b WHERE length(norm) >= 20 GROUP BY 1, 2) JOIN (SELECT entity_name, count(DISTINCT doc_id) AS pages FROM d GROUP BY 1) USING (entity_name) WHERE pages > 1 AND n >= CASE WHEN pages = 2 THEN 2 ELSE ceil(pages * 0.1) END)"
_KNOWN = " OR ".join(f"contains(norm, '{x}')" for x in fixed.lines(fixed.BOILERPLATE_PHRASES))
_MD = "m AS (SELECT p_partkey AS k, p_name || ' ' || p_partkey AS entity_name, p_name, p_brand, p_type, lower(replace(p_brand, '#', '-')) AS slug, 'The company was founded in 19' || lpad((p_partkey % 90 + 10)::VARCHAR, 2, '0') || ' in a **small** town. It employs over ' || p_partkey || ' people now [#' || (p_partkey % 5 + 1) || ']. Growth is steady and calm here. A share of ' || (p_partkey % 100) || '% was sold [#1].' AS para FROM part)"
_DESC = "CASE WHEN length(p_name || ' - ' || p_type || ' ') > p_partkey % 60 + 120 THEN left(p_name || ' - ' || p_type || ' ', (p_partkey % 60 + 120)::INT) ELSE rpad(p_name || ' - ' || p_type || ' ', (p_partkey % 60 + 120)::INT, 'x') END"
_META = f"m AS (SELECT p_partkey::VARCHAR AS entity_name, CASE WHEN p_partkey % 19 <> 0 THEN p_name || ' by ' || p_brand || ' in many sizes' || CASE WHEN p_partkey % 17 = 0 THEN chr(8230) ELSE '' END ELSE '' END AS title, CASE WHEN p_partkey % 23 <> 0 THEN {_DESC} ELSE '' END AS description, p_name AS keyword FROM part)"
_TYPES = "array_to_string(string_split(p_type, ' '), '\",\"')"
_PLAN = f"""'{{"meta":{{"title":"About ' || p_name || ' and more of the kind","description":"' || {_DESC} || '"}},"target_keywords":' || tk || CASE WHEN k % 3 = 0 THEN ',"faqs":' || faqs ELSE '' END || '}}'"""
_ANALYSIS = """'{"categories":{"primary":[' || CASE WHEN k % 2 = 0 THEN '{"slug":"' || br || '","why":"fits"},{"slug":"' || ty || '","why":"fits"}' ELSE '' END || '],"secondary":[{"slug":"' || ty || '","why":"fits"}]},"tags":{"existing":[' || array_to_string(list_transform(ws, lambda w: '{"slug":"' || lower(w) || '","why":"fits"}'), ',') || '],"suggested_new":[{"label":"new"},{"label":"newer"}]},"key_facts":' || facts || ',"source_citations":' || cites || '}'"""
_BUNDLES = f"""b0 AS (SELECT *, p_partkey AS k, p_name || ' ' || p_partkey AS entity_name, lower(p_brand) AS br, lower(p_type) AS ty, string_split(p_name, ' ') AS ws, p_partkey % 5 <> 0 AS hm, p_partkey % 7 <> 0 AS ha, p_partkey % 11 <> 0 AS hp,
    '{{"primary":"' || string_split(p_name, ' ')[1] || '","secondary":["' || {_TYPES} || '"],"long_tail":["long tail"]}}' AS tk, '[{{"question":"' || p_name || '?","answer":"' || lower(p_brand) || '"}}]' AS faqs,
    '{{"founded":' || (p_partkey % 100 + 1900) || CASE WHEN p_partkey % 4 = 0 THEN ',"headquarters":"Malta"' ELSE '' END || ',"key_people":[{{"name":"Ann","role":"CEO"}}],"licenses":["A1"]}}' AS facts, '[{{"index":1,"url":"https://a.org/","title":"A"}}]' AS cites FROM part),
b AS (SELECT *, {_PLAN} AS plan, {_ANALYSIS} AS analysis, '# ' || p_name || '\\n\\nText.' AS md FROM b0)"""
#: The articles of _MD with headings of three kinds, before and after brackets go, in h.
_MARKED = f"""{_MD}, h AS (SELECT k, '## [' || CASE k % 3 WHEN 0 THEN 'Primary Category: ' WHEN 1 THEN 'Tag: ' ELSE 'See: ' END || slug || ']' AS mark, '## ' || CASE WHEN k % 3 = 2 THEN 'See: ' || slug ELSE array_to_string(list_transform(string_split(slug, '-'), lambda w: upper(w[1]) || w[2:]), ' ') END AS heading FROM m),
x AS (SELECT k, entity_name, slug AS br, para, k % 4 <> 0 AS ha, CASE WHEN k % 5 = 0 THEN [1] ELSE [1, k % 5 + 1] END AS refs, mark || chr(10) || chr(10) || para || chr(10) || chr(10) || '- first point' || chr(10) || '- second point' || chr(10) || chr(10) || '### Metallurgy' || chr(10) || chr(10) || 'Ore.'
  || CASE WHEN k % 2 = 0 THEN chr(10) || chr(10) || '## [Meta]' WHEN k % 5 = 0 THEN '' ELSE chr(10) || chr(10) || '## Meta' END || chr(10) || chr(10) || 'Title: x' AS md FROM m JOIN h USING (k))"""
_HTML_ROWS = """o AS (SELECT x.*, CASE WHEN k % 2 = 1 AND k % 5 = 0 THEN 2 ELSE 3 END + 1 AS heads,
  '<h2>' || heading[4:] || '</h2>' || chr(10) || '<p>' || regexp_replace(replace(para, '**small**', '<strong>small</strong>'), '\\[#(\\d+)\\]', '<sup><a href="#source-\\1" id="ref-\\1">[\\1]</a></sup>', 'g') || '</p>' || chr(10) || '<ul>' || chr(10) || '<li>first point</li>' || chr(10) || '<li>second point</li>' || chr(10) || '</ul>' || chr(10) || '<h3>Metallurgy</h3>' || chr(10) || '<p>Ore.</p>' || chr(10)
  || CASE WHEN k % 2 = 1 AND k % 5 = 0 THEN '' ELSE '<h2>Meta</h2>' || chr(10) END || '<p>Title: x</p>' || chr(10) || chr(10) || '<section class="sources"><h2>Sources</h2><ol>'
  || array_to_string(list_transform(refs, lambda n: '<li id="source-' || n || '">' || CASE WHEN n <= 3 THEN '<a href="https://s' || n || '.org/' || k || '" target="_blank" rel="noopener">Source ' || n || '</a>' ELSE 'Source ' || n END || ' <a href="#ref-' || n || '">' || chr(8617) || '</a></li>'), '') || '</ol></section>' AS html,
  CASE WHEN ha THEN '<script type="application/ld+json">' || chr(10) || '{"@context":"https://schema.org","@type":"Organization","name":"' || entity_name || '","foundingDate":"' || (k % 100 + 1900) || '",' || CASE WHEN k % 8 = 0 THEN '"address":{"@type":"PostalAddress","addressLocality":"Malta"},' ELSE '' END || '"hasCredential":[{"@type":"EducationalOccupationalCredential","credentialCategory":"license","name":"A1"}],"description":"' || entity_name || ' is a company in the ' || array_to_string(list_transform(string_split(br, '-'), lambda w: upper(w[1]) || w[2:]), ' ') || ' industry."}' || chr(10) || '</script>' END AS data FROM x JOIN h USING (k))"""
_SEEN = "trim(regexp_replace(left(regexp_replace(final_html, '<[^>]+>', ' ', 'g'), 200), '\\s+', ' ', 'g'))"
_STATUS = f"s AS (SELECT doc_id, source AS entity_name, coalesce(text, '') AS text, {_WORDS} AS wc, CASE WHEN doc_id % 50 = 0 THEN 'error' WHEN doc_id % 9 = 0 THEN 'low_content' WHEN doc_id % 31 = 0 THEN 'skipped' ELSE 'success' END AS status FROM documents)"
_SUMMARY = "e AS (SELECT entity_name, count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'low_content') AS low_content, count(*) FILTER (status = 'error') AS errors, count(*) FILTER (status = 'skipped') AS skipped, sum(wc)::BIGINT AS total_words FROM s GROUP BY 1)"
_KB = "floor(octet_length(encode(final_json)) / 1024 * 10 + 0.5) / 10"
_FLAT = """SELECT entity_name, CASE WHEN k % 2 = 0 THEN br || ', ' || ty ELSE ty END AS primary_category, array_to_string(ws, ', ') || ', new, newer' AS tags_preview, 'Est. ' || (k % 100 + 1900) || CASE WHEN k % 4 = 0 THEN ' ' || chr(183) || ' Malta' ELSE '' END AS facts_preview,
    CASE WHEN k % 2 = 0 THEN 'Primary: ' || br || ' (fits), ' || ty || ' (fits)' || chr(10) || 'Secondary: ' || ty || ' (fits)' ELSE 'Primary: ' || ty || ' (fits)' END AS categories_text, 'Existing: ' || array_to_string(ws, ', ') || chr(10) || 'Suggested new: new, newer' AS tags_text,
    'Founded: ' || (k % 100 + 1900) || chr(10) || CASE WHEN k % 4 = 0 THEN 'Headquarters: Malta' || chr(10) ELSE '' END || 'Key People: Ann ' || chr(8212) || ' CEO' || chr(10) || 'Licenses: A1' AS key_facts_text, '[#1] https://a.org/ ' || chr(8212) || ' A' AS source_citations_text, * EXCLUDE (entity_name) FROM (SELECT * REPLACE (p_partkey::VARCHAR AS entity_name) FROM b)"""
_FLAT_COLS = "entity_name, primary_category, tags_preview, facts_preview, categories_text, tags_text, key_facts_text, source_citations_text"
_V = "(SELECT o_custkey::VARCHAR AS entity_name, floor(sum(CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'P' THEN 0.5 ELSE 0 END) / count(*) * 1000 + 0.5) / 1000 AS hallucination_score, count(*) FILTER (o_orderstatus = 'F') AS verified_claims, count(*) AS total_claims FROM orders GROUP BY 1)"
_PATHS = ", ".join(f"('{p}', '{t}')" for p, t in (x.split() for x in fixed.lines(fixed.SEED_PATHS)))
_TRACK = ", ".join(f"'{x.lower()}'" for x in fixed.TRACKING_PARAMS)

ORACLES = {
    "url_normalize": f"SELECT page_id, url, {_norm('url')} AS norm_url FROM pages",
    "url_dedup": f"WITH {_VARIANTS}, n AS (SELECT *, {_norm('url')} AS norm FROM v), w AS (SELECT *, row_number() OVER x AS i, first_value(url) OVER x AS f FROM n WINDOW x AS (PARTITION BY norm ORDER BY pool_pos)) SELECT norm AS url, url AS original_url, CASE WHEN i > 1 THEN f END AS duplicate_of, CASE WHEN i > 1 THEN 'duplicate' ELSE 'unique' END AS status, entity_name FROM w",
    "url_canonicalize": f"WITH {_VARIANTS}, r AS (SELECT url, CASE WHEN page_id % 3 = 0 THEN regexp_replace(url, '^http:', 'https:') ELSE url END AS final_url FROM p), j AS (SELECT v.*, coalesce(final_url, url) AS to_url FROM v LEFT JOIN r USING (url)), w AS (SELECT *, regexp_replace(to_url, '/+$', '') <> regexp_replace(url, '/+$', '') AS moved, row_number() OVER (PARTITION BY regexp_replace(lower(to_url), '/+$', '') ORDER BY pool_pos) AS i FROM j) SELECT CASE WHEN moved THEN to_url ELSE url END AS url, url AS original_url, CASE WHEN moved THEN 'redirected' ELSE 'unchanged' END AS status, CASE WHEN moved THEN url || ' -> ' || to_url END AS redirect_detail, entity_name FROM w WHERE i = 1",
    "url_filter": f"WITH {_ITEMS}, x AS (SELECT url, entity_name, CASE WHEN regexp_matches(url, '(?i)\\?page=') THEN '\\?page=' WHEN regexp_matches(url, '(?i)blog') THEN 'blog' WHEN NOT regexp_matches(url, '(?i)example') THEN 'not included' END AS matched_pattern FROM p) SELECT url, CASE WHEN matched_pattern IS NULL THEN 'kept' ELSE 'excluded' END AS status, matched_pattern, entity_name FROM x",
    "url_domain": f"SELECT page_id, {_DOMAIN} AS domain FROM pages",
    "resolve_url": f"WITH x AS (SELECT page_id, url, lower(regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1)) AS o, regexp_extract(url, '^([a-zA-Z]+:)', 1) AS s, regexp_replace(url, '#.*$', '') AS u FROM pages), y AS (SELECT *, list_filter(string_split(regexp_extract(u, '\\?(.*)$', 1), '&'), lambda q: q <> '' AND lower(regexp_extract(q, '^([^=]*)', 1)) NOT IN ({_TRACK})) AS q FROM x) SELECT page_id, o || '/a?page=2' AS rooted, s || '//cdn.org/x' AS schemeless, regexp_extract(u, '^([^?]*)', 1) || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS cleaned FROM y",
    "exclude_known_urls": "SELECT url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)",
    "extract_title": "SELECT page_id, replace(replace(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), chr(32) || chr(10)), '&amp;', '&'), '&quot;', '\"') AS title FROM pages",
    "seed_url_builder": f"WITH q AS (SELECT * FROM (VALUES {_PATHS}) t(path, path_type)), x AS (SELECT s_name AS entity_name, 'https://s' || s_suppkey || '.org' || path AS url, path_type, length(path) + s_suppkey AS n FROM supplier, q) SELECT entity_name, url, path_type, 200 AS status_code, CASE WHEN n % 2 = 0 THEN 'HEAD' ELSE 'GET' END AS found_via FROM x WHERE n % 3 <> 0",
    "sitemap_parser": f"WITH {_ITEMS} SELECT entity_name, trim(url) AS url, NULL::VARCHAR AS last_modified, NULL::VARCHAR AS change_frequency, nullif((page_id % 3)::DOUBLE / 10, 0) AS priority FROM p QUALIFY row_number() OVER (PARTITION BY entity_name ORDER BY page_id) <= 5",
    "rss_feeds": "SELECT p_partkey::VARCHAR AS url, CASE WHEN p_partkey % 3 = 0 THEN 'atom' ELSE 'rss' END AS feed_type, trim(p_name) AS title, (p_partkey % 4)::INT AS item_count FROM part WHERE p_partkey % 3 <> 2",
    "api_search": "SELECT event_id, event_type AS source, props->>'$.k' AS \"externalId\", event_type || ' at work' AS title FROM events WHERE contains(event_type, 'click') AND NOT contains(event_type, 'view')",
    "word_count": f"SELECT doc_id, {_WORDS}::INT AS word_count FROM documents",
    "english_detector": f"SELECT doc_id, {_ENGLISH} AS is_english FROM documents",
    "content_filter": f"WITH {_DOCS}, r AS (SELECT doc_id, CASE WHEN status IN ('error', 'skipped') THEN 'Scrape failed: ' || status WHEN {_WORDS} < 50 THEN 'Too short: ' || {_WORDS} || ' words (min 50)' WHEN NOT ({_ENGLISH}) THEN 'Non-English content' {_URLS} {_TITLES} END AS filter_reason FROM d) SELECT doc_id, CASE WHEN filter_reason IS NULL THEN 'kept' ELSE 'excluded' END AS filter_status, filter_reason FROM r",
    "split_blocks": f"WITH {_DOCS}, {_BLOCKS} SELECT doc_id, pos::INT AS pos, block FROM b",
    "boilerplate_frequency": f"WITH {_DOCS}, {_BLOCKS}, {_FREQUENT} SELECT * FROM f",
    "boilerplate_strip": f"WITH {_DOCS}, {_BLOCKS}, {_FREQUENT}, k AS (SELECT doc_id, string_agg(block, chr(10) || chr(10) ORDER BY pos) AS rest FROM b LEFT JOIN f USING (entity_name, norm) WHERE n IS NULL AND NOT (length(norm) <= 300 AND ({_KNOWN})) GROUP BY 1), x AS (SELECT entity_name, doc_id, text, coalesce(rest, '') AS rest, length(coalesce(rest, '')) < length(text) * 0.3 AS flagged, length(text) AS n FROM d LEFT JOIN k USING (doc_id)), y AS (SELECT *, CASE WHEN flagged THEN 0 ELSE greatest(n - length(rest), 0) END AS gone, CASE WHEN flagged THEN text ELSE rest END AS final FROM x) SELECT entity_name, doc_id, len(regexp_extract_all(final, '\\S+'))::INT AS word_count, gone::INT AS stripped_chars, CASE WHEN n = 0 THEN 0.0 ELSE floor(gone::DOUBLE / n * 100 + 0.5) / 100 END::DOUBLE AS boilerplate_ratio, flagged FROM y",
    "count_occurrences": "SELECT doc_id, len(regexp_extract_all(text, '(?i)\\bthe\\b'))::INT AS n FROM documents",
    "citation_join": f"WITH {_MD} SELECT entity_name, (k % 5 + 1)::INT AS ref FROM m WHERE k % 5 + 1 > 3",
    "citation_coverage": f"WITH {_MD}, x AS (SELECT entity_name, CASE WHEN k % 5 = 0 THEN 1 ELSE 2 END AS refs, CASE WHEN k % 5 + 1 > 3 THEN 1 ELSE 0 END AS broken, 1 AS uncited FROM m), y AS (SELECT *, floor((refs - broken)::DOUBLE / (refs + uncited) * 1000 + 0.5) / 1000 AS s FROM x) SELECT entity_name, s >= 0.7 AS qa_pass, s AS citation_score, refs AS citation_count, 3 AS source_count, uncited AS uncited_claims_count, broken AS broken_citations_count FROM y",
    "hallucination_score": f"SELECT entity_name, hallucination_score >= 0.9 AS qa_pass, hallucination_score, verified_claims, total_claims FROM {_V}",
    "average_score": f"SELECT floor(avg(hallucination_score) * 1000 + 0.5) / 1000 AS avg_score, count(*) AS n FROM {_V}",
    "route_decision": "WITH x AS (SELECT c_name AS e, c_custkey AS k, c_custkey % 5 <> 0 AS ran, c_custkey % 13 AS s, c_custkey % 6 AS l FROM customer), y AS (SELECT *, CASE WHEN ran THEN list_filter([CASE WHEN k % 3 = 0 THEN 'hallucination' END, CASE WHEN k % 4 = 0 THEN 'citation' END, CASE WHEN k % 7 = 0 THEN 'keyword' END, CASE WHEN k % 11 = 0 THEN 'meta' END], lambda z: z IS NOT NULL) ELSE [] END AS f FROM x) SELECT e AS entity_name, CASE WHEN s = 0 THEN 'failed' WHEN NOT ran THEN 'flag_manual' WHEN l >= 3 THEN 'failed' WHEN len(f) >= 2 THEN 'flag_manual' WHEN f[1] IN ('hallucination', 'citation') THEN CASE WHEN s < 8 THEN 'flag_manual' ELSE 'loop_discovery' END WHEN f[1] = 'keyword' THEN 'loop_tone' WHEN f[1] = 'meta' THEN 'loop_generation' ELSE 'approve' END AS decision, CASE WHEN s = 0 THEN 'dead_site' WHEN ran AND l >= 3 THEN 'max_loops_exceeded' END AS failure_reason, array_to_string(f, ',') AS failed_checks FROM y",
    "circuit_breaker": "WITH a AS (SELECT event_id, user_id, value > 40 AS ok, sum((value > 40)::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM events), b AS (SELECT *, sum((NOT ok)::INT) OVER (PARTITION BY user_id, run ORDER BY event_id) AS streak FROM a) SELECT event_id, user_id, ok, coalesce(max((streak >= 3)::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS aborted FROM b",
    "url_relevance": "SELECT url, CASE WHEN page_id % 4 = 0 THEN 'MAYBE' ELSE ['KEEP', 'DROP', 'MAYBE'][page_id % 3 + 1] END AS relevance FROM pages",
    "group_by_entity": f"WITH {_DOCS} SELECT entity_name, count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'error') AS error FROM d GROUP BY 1",
    "intent_breakdown": f"WITH {_DOCS}, g AS (SELECT entity_name, title, count(*) AS n FROM d GROUP BY 1, 2) SELECT entity_name, '{{' || string_agg('\"' || title || '\":' || n, ',' ORDER BY title) || '}}' AS counts FROM g GROUP BY 1",
    "origin_mode": f"WITH {_ITEMS}, g AS (SELECT entity_name, lower(regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1)) AS origin, count(*) AS n, min(pool_pos) AS q FROM p GROUP BY 1, 2) SELECT entity_name, origin FROM g QUALIFY row_number() OVER (PARTITION BY entity_name ORDER BY n DESC, q) = 1",
    "latest_wins": "SELECT conv_id, arg_max(text, turn) FILTER (role = 'user' AND text <> '') AS user_text, arg_max(text, turn) FILTER (role = 'assistant' AND text <> '') AS assistant_text FROM conversations GROUP BY 1",
    "slugify": "WITH x AS (SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || ' & Co. ' || p_brand), '[^\\w\\s-]', '', 'g'), '[\\s-]+', '-', 'g') AS slug, string_split(regexp_replace(regexp_replace(lower(p_type), '[^\\w\\s-]', '', 'g'), '[\\s-]+', '-', 'g'), '-') AS t FROM part) SELECT p_partkey, slug, array_to_string(list_transform(t, lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM x",
    "markdown_output": f"""WITH {_MARKED}, y AS (SELECT k, entity_name, ha, br, refs, regexp_replace(regexp_replace(md, '\n## \\[?Meta\\]?[\\s\\S]*$', ''), '\\s+$', '') AS body FROM x),
      z AS (SELECT *, replace(body, mark, heading) AS plain FROM y JOIN h USING (k)), w AS (SELECT *, CASE WHEN ha THEN chr(10) || 'categories:' || chr(10) || '  - ' || br || chr(10) || 'tags:' || chr(10) || '  - new one' ELSE '' END AS lists FROM z),
      f AS (SELECT entity_name, '---' || chr(10) || 'title: ' || entity_name || lists || chr(10) || '---' || chr(10) || chr(10) || regexp_replace(plain, '\\[#(\\d+)\\]', '[^\\1]', 'g') || chr(10) || chr(10) || '---' || chr(10) || chr(10) || array_to_string(list_transform(refs, lambda n: '[^' || n || ']: Source ' || n || CASE WHEN n <= 3 THEN ' ' || chr(8212) || ' https://s' || n || '.org/' || k ELSE '' END), chr(10)) AS final_markdown, len(refs)::INT AS citation_count FROM w)
      SELECT *, len(regexp_extract_all(final_markdown, '\\S+'))::INT AS word_count, len(regexp_extract_all(final_markdown, '(?m)^#{{2,3}}\\s+'))::INT AS section_count, replace(left(final_markdown, 200), chr(10), ' ') AS content_preview FROM f""",
    "markdown_output_plain": f"""WITH {_MARKED}, f AS (SELECT entity_name, regexp_replace(md, '\\s*\\[#\\d+\\]', '', 'g') AS final_markdown, len(refs)::INT AS citation_count FROM x)
      SELECT *, len(regexp_extract_all(final_markdown, '\\S+'))::INT AS word_count, len(regexp_extract_all(final_markdown, '(?m)^#{{2,3}}\\s+'))::INT AS section_count, replace(left(final_markdown, 200), chr(10), ' ') AS content_preview FROM f""",
    "html_documents": f"WITH {_MARKED}, {_HTML_ROWS} SELECT entity_name, final_html, floor(octet_length(encode(final_html)) / 1024 * 10 + 0.5) / 10 AS html_size_kb, ha AS has_schema_org, heads::INT AS heading_count, {_SEEN} AS content_preview FROM (SELECT *, concat_ws(chr(10), data, html) AS final_html FROM o)",
    "html_documents_wrapped": f"""WITH {_MARKED}, {_HTML_ROWS} SELECT entity_name, final_html, floor(octet_length(encode(final_html)) / 1024 * 10 + 0.5) / 10 AS html_size_kb, ha AS has_schema_org, heads::INT AS heading_count, {_SEEN} AS content_preview FROM (SELECT *, '<!DOCTYPE html>
<html lang="en">
<head>
<meta charset="UTF-8">
<meta name="viewport" content="width=device-width, initial-scale=1.0">
<title>' || entity_name || '</title>
<style>p {{ color: red }}</style>
' || coalesce(data, '') || '
</head>
<body>
' || html || '
</body>
</html>' AS final_html FROM o)""",
    "step_errors": """WITH e AS (SELECT source || ': failed at ' || min(doc_id) AS line FROM documents WHERE doc_id % 50 = 0 GROUP BY source), a AS (SELECT count(DISTINCT source) AS total_entities, count(*) FILTER (doc_id % 50 <> 0) AS total_items FROM documents), l AS (SELECT count(*) AS failed, string_agg(line, chr(10) ORDER BY line) AS errors FROM e)
      SELECT total_entities, total_items, failed, total_items || ' links from ' || CASE WHEN failed > 0 THEN total_entities - failed || ' of ' || total_entities || ' entities (' || failed || ' failed)' ELSE total_entities || ' entities' END AS description, errors FROM a, l""",
    "hallucination_detector": "WITH c AS (SELECT item_id AS claim_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark), g AS (SELECT DISTINCT claim_id, array_to_string(w[i:i + 4], ' ') AS g FROM c, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i)), d AS (SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents), e AS (SELECT DISTINCT array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i)), s AS (SELECT claim_id, count(e.g)::DOUBLE / count(*) AS share FROM g LEFT JOIN e ON g.g = e.g GROUP BY 1) SELECT claim_id, CASE WHEN share >= 0.8 THEN 'supported' WHEN share >= 0.4 THEN 'partial' ELSE 'unsupported' END AS verdict FROM s",
    "llm_json_parse": "SELECT event_id, replace(props, ' ', '') AS json FROM events",
    "event_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2",
    "relational_rollup": "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "relational_top_orders": "SELECT c_name, o_orderkey, o_totalprice, (row_number() OVER w)::INT AS r FROM orders JOIN customer ON o_custkey = c_custkey WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) QUALIFY row_number() OVER w <= 3",
    "relational_semi_anti": "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)",
    "url_liveness": "WITH x AS (SELECT url, [200, 301, 403, 404, 503, 200, 200][page_id % 7 + 1] AS h, page_id % 13 <> 0 AS looked, page_id % 5 = 0 AS challenge, CASE WHEN page_id % 11 = 0 THEN NULL WHEN length(url) % 2 = 0 THEN 200 ELSE 403 END AS b, length(left(html, length(url) * 30)) + CASE WHEN page_id % 5 = 0 THEN 31 ELSE 0 END AS size FROM pages), r AS (SELECT url, CASE WHEN h BETWEEN 200 AND 399 THEN NULL WHEN h NOT IN (403, 429, 503) THEN 'head ' || h WHEN NOT looked THEN NULL WHEN challenge THEN 'browser ' || coalesce(b::VARCHAR, 'failed') || ', challenge' WHEN b IS NULL THEN 'browser failed' WHEN b BETWEEN 200 AND 399 OR size > 1000 THEN NULL ELSE 'browser ' || b END AS reason FROM x) SELECT url, CASE WHEN reason IS NULL THEN 'kept' ELSE 'dead_link' END AS status, reason FROM r",
    "extract_meta_description": "SELECT page_id, CASE WHEN page_id % 3 < 2 THEN 'A & b ' || page_id ELSE nullif(regexp_extract(html, '(?i)<meta name=\"description\" content=\"([^\"]+)\"', 1), '') END AS meta_description FROM pages",
    "test_dummy": "WITH e AS (SELECT s_name AS n, contains(lower(s_name), '7') AS f FROM supplier), x AS (SELECT n, f, unnest(CASE WHEN f THEN [0] ELSE [1, 2, 3] END) AS i FROM e) SELECT n AS entity_name, CASE WHEN NOT f THEN 'https://' || regexp_replace(lower(n), '\\s+', '-', 'g') || '.example.com/page-' || i END AS url, CASE WHEN NOT f THEN n || ' ' || chr(8212) || ' Page ' || i END AS title, CASE WHEN f THEN 'Simulated failure for ' || n END AS error FROM x",
    "duplicate_text_demotion": f"WITH {_DOCS}, t AS (SELECT doc_id, status, CASE WHEN status = 'success' THEN {_TRIM.format('text')} END AS t FROM d) SELECT doc_id, CASE WHEN t <> '' AND count(*) OVER (PARTITION BY t) >= 3 THEN 'low_content' ELSE status END AS status FROM t",
    "duplicate_text_demotion_by_entity": f"WITH {_DOCS}, t AS (SELECT doc_id, entity_name, status, CASE WHEN status = 'success' THEN {_TRIM.format('text')} END AS t FROM d), o AS (SELECT DISTINCT t FROM t WHERE t <> '' GROUP BY t, entity_name HAVING count(*) >= 2) SELECT doc_id, CASE WHEN t IN (SELECT t FROM o) THEN 'low_content' ELSE status END AS status FROM t",
    "meta_compliance": f"WITH {_META}, x AS (SELECT *, (length(title) <= 60)::INT + (length(title) >= 30)::INT + (length(description) BETWEEN 150 AND 160)::INT + contains(lower(title), lower(keyword))::INT + contains(lower(description), lower(keyword))::INT + (NOT (ends_with(title, '...') OR ends_with(title, chr(8230)) OR ends_with(description, '...')))::INT + ((title = '' OR count(*) OVER (PARTITION BY lower(title)) = 1) AND (description = '' OR count(*) OVER (PARTITION BY lower(description)) = 1))::INT AS c, title <> '' OR description <> '' AS t FROM m) SELECT entity_name, CASE WHEN t THEN c ELSE 0 END AS checks_passed, CASE WHEN t THEN 7 ELSE 0 END AS checks_total, t AND c = 7 AS qa_pass FROM x",
    "intent_tagger": "WITH x AS (SELECT source AS entity_name, doc_id, CASE WHEN doc_id % 4 = 1 THEN 'unclassified' WHEN doc_id % 5 = 0 THEN 'other' ELSE ['about_us', 'news', 'other'][doc_id % 3 + 1] END AS page_intent FROM documents WHERE doc_id % 4 <> 2) SELECT entity_name, doc_id, page_intent, CASE WHEN page_intent IN ('other', 'unclassified') THEN 0.0 ELSE least((doc_id % 15)::DOUBLE / 10, 1.0) END::DOUBLE AS intent_confidence, CASE page_intent WHEN 'news' THEN 1 WHEN 'unclassified' THEN 5 ELSE 4 END AS rank FROM x",
    "content_analysis_flatten": f"WITH {_BUNDLES}, f AS ({_FLAT}) SELECT {_FLAT_COLS} FROM f",
    "content_analyzer": f"""WITH {_BUNDLES}, f AS ({_FLAT}) SELECT (k - (k % 10 = 1)::INT)::VARCHAR AS entity_name, 'analyzed' AS status, {_FLAT_COLS.split(', ', 1)[1]}, 7 AS word_count, 'p/m' AS model_used,
        '{{"categories":{{"primary":[' || CASE WHEN k % 2 = 0 THEN '{{"slug":"' || br || '","why":"fits"}},{{"slug":"' || ty || '","why":"fits"}}' ELSE '' END || '],"secondary":[{{"slug":"' || ty || '","why":"fits"}}]}},"key_facts":' || facts || ',"source_citations":[{{"index":1,"title":"A","url":"https://a.org/"}}],"tags":{{"existing":[' || array_to_string(list_transform(ws, lambda w: '{{"slug":"' || w || '","why":"fits"}}'), ',') || '],"suggested_new":[{{"label":"new"}},{{"label":"newer"}}]}}}}' AS analysis_json, NULL::VARCHAR AS error FROM f WHERE k % 9 <> 0
        UNION ALL SELECT (p_partkey - (p_partkey % 10 = 1)::INT)::VARCHAR, 'error', '', '', '', '', '', '', '', 0, 'p/m', NULL, 'no JSON object in the answer' FROM part WHERE p_partkey % 9 = 0""",
    "profile_completeness": "WITH x AS (SELECT c_custkey AS id, c_custkey AS k, 10 * (c_custkey % 2 = 0)::INT + 15 * (length(c_name) * (c_custkey % 6) > 50)::INT + 20 * (c_custkey % 4 <> 0)::INT + 10 * (c_custkey % 4 <> 0 AND length(c_name) * (c_custkey % 3) > 20)::INT + 15 * (c_custkey % 3 <> 0)::INT + 10 * (c_custkey % 7 <> 0)::INT + 5 * (c_custkey % 5 <> 0)::INT + 5 * (c_custkey % 3 <> 0)::INT + 5 * (c_custkey % 2 <> 0)::INT + 5 * (c_custkey % 11 = 0)::INT AS s FROM customer) SELECT id, s::INT AS completeness_score, CASE WHEN s < 50 THEN 'incomplete' ELSE 'success' END AS status FROM x",
    "seo_plan_flatten": f"WITH x AS (SELECT *, length('About ' || p_name || ' and more of the kind') AS n, length({_DESC}) AS m, string_split(p_name, ' ')[1] AS w FROM part) SELECT p_partkey::VARCHAR AS entity_name, w AS primary_keyword, 'Primary: ' || w || chr(10) || 'Secondary: ' || replace(p_type, ' ', ', ') || chr(10) || 'Long-tail: long tail' AS keywords_text, (p_partkey % 3 = 0)::INT AS faq_count, concat_ws('; ', CASE WHEN n > 60 THEN 'Meta title is ' || n || ' chars (recommended: ' || chr(8804) || '60)' END, CASE WHEN m NOT BETWEEN 150 AND 160 THEN 'Meta description is ' || m || ' chars (recommended: 150-160)' END) AS warnings FROM x",
    "meta_output": f"""WITH {_BUNDLES}, x AS (SELECT *, 'About ' || p_name || ' and more of the kind' AS t, {_DESC} AS d, CASE WHEN ha THEN (CASE WHEN k % 2 = 0 THEN [br, ty] ELSE [] END) || [ty] || ws || ['new', 'newer'] ELSE [] END || [ws[1]] || string_split(p_type, ' ') || ['long tail'] AS l FROM b WHERE hp), y AS (SELECT *, list_filter(l, lambda w, i: list_position(l, w) = i) AS kw, list_filter([CASE WHEN length(t) > 60 THEN 'Title too long: ' || length(t) || '/60' END, CASE WHEN length(d) < 150 THEN 'Description too short: ' || length(d) || '/150' END, CASE WHEN length(d) > 160 THEN 'Description too long: ' || length(d) || '/160' END], lambda z: z IS NOT NULL) AS w FROM x)
        SELECT entity_name, t AS meta_title, d AS meta_description, replace(entity_name, ' ', '-') AS slug, length(t)::INT AS title_length, length(d)::INT AS description_length, len(kw)::INT AS keyword_count, array_to_string(w, '; ') AS warnings, CASE WHEN len(w) > 0 THEN 'warning' ELSE 'ok' END AS status,
        '{{"title":"' || t || '","description":"' || d || '","slug":"' || replace(entity_name, ' ', '-') || '","keywords":["' || array_to_string(kw, '","') || '"],"og":{{"og:title":"' || t || '","og:description":"' || d || '","og:type":"article"}}' || CASE WHEN len(w) > 0 THEN ',"warnings":["' || array_to_string(w, '","') || '"]' ELSE '' END || '}}' AS meta_json FROM y""",
    "json_output": f"""WITH {_BUNDLES}, x AS (SELECT entity_name, hm AS has_markdown, ha AS has_analysis, hp AS has_seo_plan, k, '{{"name":"' || entity_name || '"' || CASE WHEN hm THEN ',"content":"' || md || '"' ELSE '' END
        || CASE WHEN ha THEN CASE WHEN k % 2 = 0 THEN ',"primary_category":"' || br || '","primary_category_slug":"' || br || '"' ELSE '' END || ',"secondary_category":"' || ty || '","secondary_category_slug":"' || ty || '","categories":[' || CASE WHEN k % 2 = 0 THEN '"' || br || '","' || ty || '",' ELSE '' END || '"' || ty || '"],"tags":["' || array_to_string(ws, '","') || '","new","newer"],"key_facts":' || facts || ',"sources":' || cites ELSE '' END
        || CASE WHEN hp THEN ',"seo":{{"meta_title":"About ' || p_name || ' and more of the kind","meta_description":"' || {_DESC} || '","target_keywords":' || tk || CASE WHEN k % 3 = 0 THEN ',"faqs":' || faqs ELSE '' END || '}}' ELSE '' END || '}}' AS final_json FROM b WHERE hm OR ha OR hp)
        SELECT entity_name, final_json, has_markdown, has_analysis, has_seo_plan, (1 + has_markdown::INT + has_analysis::INT * (2 * (k % 2 = 0)::INT + 8 + (k % 4 = 0)::INT + 1) + has_seo_plan::INT * (7 + (k % 3 = 0)::INT))::INT AS field_count, {_KB} AS json_size_kb FROM x""",
    "json_output_flat": f"""WITH {_BUNDLES}, x AS (SELECT entity_name, hm AS has_markdown, ha AS has_analysis, hp AS has_seo_plan, k, '{{"entity_name":"' || entity_name || '"' || CASE WHEN hm THEN ',"content_markdown":"' || md || '"' ELSE '' END || CASE WHEN ha THEN ',"analysis":' || analysis ELSE '' END || CASE WHEN hp THEN ',"seo_plan":' || plan ELSE '' END || '}}' AS final_json FROM b WHERE hm OR ha OR hp)
        SELECT entity_name, final_json, has_markdown, has_analysis, has_seo_plan, (1 + has_markdown::INT + has_analysis::INT * (12 + (k % 4 = 0)::INT) + has_seo_plan::INT * (8 + (k % 3 = 0)::INT))::INT AS field_count, {_KB} AS json_size_kb FROM x""",
    "schema_org_injector": f"""WITH {_BUNDLES}, x AS (SELECT *, CASE WHEN k % 3 = 0 THEN ',"url":"https://p' || k || '.org/"' ELSE '' END AS u, ha AND k % 2 = 0 AS cat, upper(br[1]) || br[2:] AS bt, upper(ty[1]) || ty[2:] AS tt FROM b),
        y AS (SELECT *, '{{"@type":"Organization","name":"' || entity_name || '"' || u || CASE WHEN cat THEN ',"description":"' || entity_name || ' is a company in the ' || bt || ' industry."' ELSE '' END || CASE WHEN ha THEN ',"hasCredential":[{{"@type":"EducationalOccupationalCredential","credentialCategory":"license","name":"A1"}}],"foundingDate":"' || (k % 100 + 1900) || '"' || CASE WHEN k % 4 = 0 THEN ',"address":{{"@type":"PostalAddress","addressLocality":"Malta"}}' ELSE '' END || ',"member":[{{"@type":"Person","name":"Ann"}}]' ELSE '' END || '}}' AS org,
            CASE WHEN cat THEN [bt, tt] ELSE [] END AS names, CASE WHEN hp AND k % 3 = 0 THEN ['{{"@type":"FAQPage","mainEntity":[{{"@type":"Question","name":"' || p_name || '?","acceptedAnswer":{{"@type":"Answer","text":"' || br || '"}}}}]}}'] ELSE [] END AS faq FROM x),
        z AS (SELECT *, [org] || list_transform(names, lambda n: '{{"@type":"Product","name":"' || n || '","brand":{{"@type":"Organization","name":"' || entity_name || '"}}' || u || ',"description":"fits"}}') || faq AS s, list_filter([CASE WHEN u = '' THEN 'Organization: missing recommended field "url"' END, CASE WHEN NOT cat THEN 'Organization: missing recommended field "description"' END], lambda e: e IS NOT NULL) AS e FROM y)
        SELECT entity_name, CASE WHEN len(s) = 1 THEN '{{"@context":"https://schema.org",' || s[1][2:] ELSE '{{"@context":"https://schema.org","@graph":[' || array_to_string(s, ',') || ']}}' END AS schema_json, len(s)::INT AS schema_count, array_to_string(e, '; ') AS validation_errors, len(e) > 0 AS has_validation_errors FROM z""",
    "company_media": "WITH i AS (SELECT *, p_partkey AS k, '/img/' || CASE WHEN p_partkey % 7 = 6 THEN 'favicon.ico' ELSE ['logo-', 'pic-', 'dark-logo-', 'white-logo-', 'icon-', 'wide-'][p_partkey % 7 + 1] || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '.svg' ELSE '.png' END END AS src FROM part), j AS (SELECT *, lower(src || ' ' || p_name || ' ' || CASE WHEN k % 5 = 0 THEN 'brand' ELSE 'x' END || CASE WHEN k % 6 = 0 THEN ' Logo' ELSE '' END) AS a FROM i), x AS (SELECT p_brand AS entity_name, k, src, 10 * contains(a, 'logo')::INT + 5 * contains(a, 'brand')::INT + 5 * contains(src, '.svg')::INT + 5 * regexp_matches(src, 'dark|black|primary|colored')::INT + 3 * regexp_matches(src, 'horizontal|wide|full')::INT - 5 * regexp_matches(src, 'white|light|reversed|inverted')::INT - 5 * regexp_matches(src, 'favicon\\.ico$')::INT - 3 * (contains(a, 'icon') AND NOT contains(a, 'logo'))::INT + 2 * (k % 500 > 100)::INT - 3 * (k % 500 BETWEEN 1 AND 31)::INT AS score FROM j) SELECT entity_name, (row_number() OVER w)::INT AS rank, src, score::INT AS score FROM x WINDOW w AS (PARTITION BY entity_name ORDER BY score DESC, k) QUALIFY row_number() OVER w <= 5",
    "keyword_sufficiency": "WITH x AS (SELECT p_partkey AS k, string_split(p_name, ' ') AS ws, string_split(lower(p_type), ' ') AS mid, 'it is ' || lower(p_name) || ' and ' || lower(p_type) || ' of ' || lower(p_brand) || ' . made to last and sold in many shops.' AS body FROM part), y AS (SELECT *, list_transform(ws[1:2], lambda w: 0.6 + 0.4 * (CASE WHEN len(regexp_extract_all(body, '\\b' || w || '\\b'))::DOUBLE / len(regexp_extract_all(body, '\\S+')) > 0.03 THEN 0.3 ELSE 1.0 END)) AS h FROM x), z AS (SELECT k, (list_sum(h) / len(h))::DOUBLE * 0.4 + 0.25 + 0.15 * 0.5 AS total, CASE WHEN k % 4 = 0 THEN 1.0 ELSE 0.8 END AS weight FROM y) SELECT k AS id, floor(total / weight * 100 + 0.5) / 100 >= 0.6 AS qa_pass, floor(total / weight * 100 + 0.5) / 100 AS keyword_score, 1 AS n_missing, (k % 4 = 0)::INT AS n_negatives FROM z",
    "markdown_sections": f"WITH {_MD}, x AS (SELECT *, regexp_replace(para, '\\[#\\d+\\]', '', 'g') AS q FROM m), y AS (SELECT *, q || ' - first point - second point Title: x' AS body FROM x) SELECT entity_name, 'One' AS h1, '[Category: ' || slug || ']|Meta' AS h2, '' AS h3, q || '|Title: x' AS first_paragraphs, body, 'A' AS title, 'b c' AS description, len(regexp_extract_all(body, '\\S+'))::INT AS word_count FROM y",
    "meta_resolution": f"SELECT p_partkey::VARCHAR AS entity_name, CASE WHEN p_partkey % 2 = 0 THEN 'Own ' || p_name WHEN p_partkey % 3 = 0 THEN 'Front' WHEN p_partkey % 5 = 0 THEN 'Head' ELSE 'About ' || p_name || ' and more of the kind' END AS title, CASE WHEN p_partkey % 7 = 0 THEN 'First line and second.' ELSE {_DESC} END AS description, array_to_string(list_filter([lower(string_split(p_name, ' ')[1])] || string_split(lower(p_type), ' '), lambda w, i: list_position([lower(string_split(p_name, ' ')[1])] || string_split(lower(p_type), ' '), w) = i), '|') AS head_terms FROM part",
    "source_assembly": "WITH d AS (SELECT source AS entity_name, doc_id, text, length(text) AS n, chr(10) || chr(10) || '---SOURCE BOUNDARY---' || chr(10) || chr(10) AS s FROM documents WHERE text <> ''), x AS (SELECT *, greatest(coalesce(sum(n + length(s)) OVER (PARTITION BY entity_name ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - length(s), 0) AS start FROM d), y AS (SELECT *, CASE WHEN start > 0 THEN s ELSE '' END || text AS w, 5000 - start AS room FROM x WHERE start <= 5000), z AS (SELECT entity_name, doc_id, CASE WHEN length(w) <= room THEN w WHEN room > 100 THEN left(w, room::BIGINT) || chr(10) || '[TRUNCATED]' ELSE '' END AS part FROM y) SELECT entity_name, string_agg(part, '' ORDER BY doc_id) AS source_text FROM z GROUP BY 1",
    "prompt_build": "WITH p AS (SELECT conv_id::VARCHAR AS entity_name, turn, role, '--- Page: ' || CASE WHEN turn > 0 THEN role ELSE 'Untitled' END || ' (u' || turn || ') ---' || chr(10) || coalesce(text, '') AS page FROM conversations), a AS (SELECT entity_name, string_agg(page, chr(10) || chr(10) ORDER BY turn) AS t, sum(length(role))::BIGINT AS word_count FROM p GROUP BY 1) SELECT entity_name, 'Read well : ' || CASE WHEN length(t) > 400 THEN left(t, 400) || chr(10) || chr(10) || '[Content truncated at 400 characters]' ELSE t END AS prompt, word_count FROM a",
    "claim_verdicts": f"""WITH {_MD}, n AS (SELECT entity_name, k, string_split(replace(regexp_replace(para, '\\[#\\d+\\]', '', 'g'), '**', ''), '. ') AS p FROM m), c AS (SELECT entity_name, k, unnest([0, 1, 2]) AS pos, unnest([p[1] || '.', p[2] || '.', p[4]]) AS claim FROM n)
      SELECT entity_name, pos, claim, CASE WHEN k % 3 = 1 AND pos = 0 THEN 'supported' WHEN k % 3 = 2 AND pos = 0 THEN 'partial' WHEN k % 3 = 2 AND pos = 1 THEN 'supported' ELSE 'unsupported' END AS verdict, CASE WHEN k % 3 = 2 AND pos = 1 THEN 'q' END AS quote, CASE WHEN k % 3 = 1 AND pos = 0 THEN 'low' ELSE 'medium' END AS severity FROM c""",
    "tone_editor": f"""WITH {_MD}, x AS (SELECT entity_name, k, '## [Category: ' || slug || ']' || chr(10) || chr(10) || para || chr(10) || chr(10) || '- first point' || chr(10) || '- second point' || chr(10) || chr(10) || '## Meta' || chr(10) || chr(10) || 'Title: x' AS o, ['people', 'point', 'Growth', 'person'] || CASE WHEN k % 2 = 0 THEN ['no such'] ELSE [] END AS kws FROM m),
      y AS (SELECT *, CASE k % 3 WHEN 0 THEN replace(o, 'Growth is steady', 'The growth is steady, as a salesperson says') WHEN 1 THEN replace(replace(o, '- first', '# people' || chr(10) || chr(10) || '- at first'), 'Title', 'Name') ELSE o END AS r FROM x),
      l AS (SELECT *, string_split(o, chr(10)) AS ol, string_split(r, chr(10)) AS rl, list_transform(string_split(r, chr(10)), lambda v: lower(trim(v))) AS ls FROM y),
      h AS (SELECT *, list_filter(ls, lambda v: regexp_matches(v, '^#{{1,2}}\\s+')) AS heads, list_filter(list_transform(range(1, len(ls) + 1), lambda i: CASE WHEN regexp_matches(ls[i], '^#{{1,2}}\\s+') THEN list_filter(ls[i + 1 :], lambda v: v <> '' AND NOT regexp_matches(v, '^#{{1,6}}\\s+'))[1] END), lambda v: v IS NOT NULL) AS firsts FROM l),
      q AS (SELECT *, list_filter(list_transform(kws, lambda w: [w] || CASE WHEN len(list_filter(heads, lambda v: contains(v, lower(w)))) > 0 THEN ['heading'] ELSE [] END || CASE WHEN len(list_filter(firsts, lambda v: contains(v, lower(w)))) > 0 THEN ['first_paragraph'] ELSE [] END || CASE WHEN len(list_filter(heads || firsts, lambda v: contains(v, lower(w)))) = 0 AND contains(lower(r), lower(w)) THEN ['body'] ELSE [] END), lambda p: len(p) > 1) AS placed,
        len(list_filter(range(1, greatest(len(ol), len(rl)) + 1), lambda i: trim(coalesce(ol[i], '')) <> trim(coalesce(rl[i], ''))))::INT AS lines_changed,
        list_sum(list_transform(kws, lambda w: (length(o) - length(replace(lower(o), lower(w), ''))) // length(w)))::INT AS keywords_before, list_sum(list_transform(kws, lambda w: (length(r) - length(replace(lower(r), lower(w), ''))) // length(w)))::INT AS keywords_after, len(regexp_extract_all(o, '\\S+'))::INT AS words_before, len(regexp_extract_all(r, '\\S+'))::INT AS words_after FROM h)
      SELECT entity_name, r AS revised, lines_changed, keywords_before, keywords_after, words_before, words_after, len(placed)::INT AS keywords_placed, CASE WHEN len(placed) = 0 THEN 'No keyword placements detected.' ELSE array_to_string(list_transform(placed, lambda p: p[1] || ': ' || array_to_string(p[2:], ', ')), chr(10)) END AS placements_text,
        lines_changed || ' lines changed | ' || len(placed) || '/' || len(kws) || ' target keywords placed | keyword occurrences: ' || keywords_before || ' -> ' || keywords_after || ' | word count: ' || words_before || ' -> ' || words_after || ' (' || CASE WHEN words_after >= words_before THEN '+' ELSE '' END || words_after - words_before || ') | tone style: professional' AS revision_summary, CASE WHEN length(r) > 300 THEN left(r, 300) || '...' ELSE r END AS content_preview FROM q""",
    "rescrape_partition": f"WITH {_STATUS}, u AS (SELECT *, CASE WHEN status = 'success' THEN nullif({_TRIM.format('text')}, '') END AS t FROM s), g AS (SELECT *, status = 'success' AND wc >= 50 AS good, t IS NOT NULL AND count(*) OVER (PARTITION BY t) >= 3 AS often FROM u) SELECT doc_id, NOT (good OR status = 'skipped') OR often AS by_browser, status IN ('error', 'low_content') OR (status = 'success' AND NOT good) AS by_api FROM g",
    "tier_fallback": "WITH x AS (SELECT doc_id, [CASE WHEN doc_id % 2 = 0 THEN left(text, 400) END, CASE WHEN doc_id % 3 = 0 THEN left(text, 900) END, CASE WHEN doc_id % 5 = 0 THEN text END] AS t FROM documents), y AS (SELECT doc_id, list_transform(t, lambda z: len(regexp_extract_all(coalesce(z, ''), '\\S+'))) AS n FROM x), z AS (SELECT doc_id, n, CASE WHEN n[1] >= 50 THEN 1 WHEN n[2] >= 50 THEN 2 WHEN n[3] >= 50 THEN 3 END AS i FROM y) SELECT doc_id, ['http', 'browser', 'archive'][i] AS scrape_method, coalesce(n[i], 0)::INT AS word_count, CASE WHEN i IS NULL THEN 'error' ELSE 'success' END AS status FROM z",
    "entity_summary": f"WITH {_STATUS}, {_SUMMARY} SELECT * FROM e",
    "run_summary": f"WITH {_STATUS}, {_SUMMARY}, r AS (SELECT count(*) AS total_entities, sum(total)::BIGINT AS total, sum(success)::BIGINT AS success, sum(low_content)::BIGINT AS low_content, sum(errors)::BIGINT AS errors, sum(skipped)::BIGINT AS skipped FROM e) SELECT *, CASE WHEN errors + skipped + low_content > 0 THEN success || ' scraped, ' || (errors + skipped + low_content) || ' issues (' || concat_ws(', ', CASE WHEN errors > 0 THEN errors || ' errors' END, CASE WHEN skipped > 0 THEN skipped || ' skipped' END, CASE WHEN low_content > 0 THEN low_content || ' low content' END) || ') of ' || total || ' total' ELSE total || ' URLs ' || chr(8212) || ' all scraped successfully' END AS description FROM r",
    "intent_breakdown_by_count": f"WITH {_DOCS}, g AS (SELECT entity_name, title || ' ' || doc_id % 3 AS kind, count(*) AS n FROM d GROUP BY 1, 2) SELECT entity_name, '{{' || string_agg('\"' || kind || '\":' || n, ',' ORDER BY n DESC, kind) || '}}' AS counts FROM g GROUP BY 1",
    "flagged_first": f"WITH {_STATUS} SELECT doc_id, status, (status <> 'low_content')::INT AS flag_rank FROM s",
    "meta_output_twitter": f"""WITH {_BUNDLES} SELECT entity_name, '{{"twitter:card":"summary","twitter:title":"About ' || p_name || ' and more of the kind","twitter:description":"' || {_DESC} || '"}}' AS twitter FROM b WHERE hp""",
    "error_rollup": "SELECT source AS entity_name, count(*) AS errors, 'failed at ' || min(doc_id) AS first_error, source || ': failed at ' || min(doc_id) AS error FROM documents WHERE doc_id % 50 = 0 GROUP BY 1",
    "status_sort": f"WITH {_STATUS} SELECT doc_id, status, CASE status WHEN 'error' THEN 0 WHEN 'skipped' THEN 1 WHEN 'low_content' THEN 2 ELSE 3 END AS status_rank FROM s",
    "top_of_category": "SELECT event_id, event_type, value, (row_number() OVER w)::INT AS rank FROM events WINDOW w AS (PARTITION BY event_type ORDER BY value DESC, event_id) QUALIFY row_number() OVER w <= 5",
    "sitemap_index": "WITH x AS (SELECT s_name AS entity_name, s_suppkey AS k FROM supplier) SELECT entity_name, 'https://s' || k || '.org/own' AS url FROM x WHERE k % 2 = 1 UNION ALL SELECT entity_name, 'https://s' || k || '.org/a1' FROM x WHERE k % 2 = 0 UNION ALL SELECT entity_name, 'https://s' || k || '.org/b1' FROM x WHERE k % 6 = 0",
    "feed_discovery": "SELECT page_id, lower(regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1)) || CASE WHEN page_id % 2 = 0 THEN '/feed' ELSE '/feed.xml' END AS url, CASE WHEN page_id % 3 = 0 THEN 'atom' ELSE 'rss' END AS feed_type, 'T' || page_id AS title FROM pages WHERE page_id % 3 < 2",
    "archive_scan": "SELECT url, 'text' AS body FROM pages WHERE page_id % 7 <> 0 AND page_id % 5 <> 0",
    "browser_crawler": "WITH x AS (SELECT n_name AS entity_name, 'https://n' || n_nationkey || '.org' AS b FROM nation) SELECT entity_name, b || p AS url, t AS link_text, b || f AS found_on FROM x, (VALUES ('/news/1', 'N', '/'), ('/other', 'O', '/'), ('/about', 'A', '/'), ('/team', 'T', '/about')) v(p, t, f)",
    "profile_source": "WITH x AS (SELECT *, c_custkey AS k, c_custkey % 5 + 2000 AS y, c_custkey % 13 AS m FROM customer), z AS (SELECT *, 'first/Firm/' || CASE WHEN m > 0 THEN ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'][m] || ' ' ELSE '' END || y AS a, 'second/Firm/Mar 2002' AS b FROM x) SELECT k AS id, c_name AS full_name, CASE WHEN k % 2 = 0 THEN c_mktsegment ELSE '' END AS headline, CASE WHEN y * 13 + m >= 2002 * 13 + 3 THEN a || '|' || b ELSE b || '|' || a END AS positions, 0 AS n_education, 'SQL' AS skills FROM z",
    "job_analyzer": "WITH x AS (SELECT p_partkey::VARCHAR AS entity_name, CASE WHEN p_partkey % 3 <> 0 THEN p_name || ' & Co.' END AS company_name, CASE WHEN p_partkey % 2 = 0 THEN 'cmo' ELSE 'generic' END AS v FROM part) SELECT entity_name, company_name, CASE WHEN company_name IS NOT NULL THEN v END AS base_variant, CASE WHEN company_name IS NULL THEN 'Missing company_name in AI response' END AS error, regexp_replace(regexp_replace(company_name, '[^a-zA-Z0-9_]', '_', 'g'), '_+', '_', 'g') || '_' || v || '.json' AS path FROM x",
    "rate_limiter": """WITH e AS (SELECT event_id, event_type, epoch_ms(date_trunc('hour', ts)) AS t FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY t, event_id) AS i FROM e), s AS (SELECT a.event_id, a.t, max(b.t + (a.i - b.i) * 8572) AS sent FROM n a JOIN n b ON a.event_type = b.event_type AND b.i <= a.i GROUP BY ALL)
      SELECT event_id, sent::BIGINT AS sent_ms, (sent - t)::BIGINT AS wait_ms FROM s""",
    "credits": "SELECT event_type AS entity_name, count(*) AS calls, count(*) FILTER (value <= 40) AS failed, sum(event_id % 7)::BIGINT AS credits FROM events GROUP BY 1",
    "api_requests": "SELECT s_name AS entity_name, provider, keyword FROM supplier, (VALUES ('a', 'CMO'), ('a', 'CEO'), ('b', NULL)) v(provider, keyword)",
    "profile_slug": "SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN replace(p_name, ' ', '-') END AS slug FROM part",
    "extraction_method_counts": "WITH x AS (SELECT doc_id, [CASE WHEN doc_id % 2 = 0 THEN left(text, 400) END, CASE WHEN doc_id % 3 = 0 THEN left(text, 900) END, CASE WHEN doc_id % 5 = 0 THEN text END] AS t FROM documents), y AS (SELECT doc_id, list_transform(t, lambda z: len(regexp_extract_all(coalesce(z, ''), '\\S+'))) AS n FROM x), z AS (SELECT doc_id, n, CASE WHEN n[1] >= 50 THEN 1 WHEN n[2] >= 50 THEN 2 WHEN n[3] >= 50 THEN 3 END AS i FROM y), g AS (SELECT CASE WHEN i IS NULL THEN 'error' ELSE 'success' END AS status, coalesce(['http', 'browser', 'archive'][i], 'none') AS m, count(*) AS n FROM z GROUP BY 1, 2) SELECT status, '{' || string_agg('\"' || m || '\":' || n, ',' ORDER BY m) || '}' AS counts FROM g GROUP BY 1",
    "seo_planner": f"WITH x AS (SELECT *, p_partkey % 9 = 0 AS bad, length('About ' || p_name || ' and more of the kind') AS n, length({_DESC}) AS m, string_split(p_name, ' ')[1] AS w FROM part) SELECT (p_partkey - (p_partkey % 10 = 1)::INT)::VARCHAR AS entity_name, CASE WHEN bad THEN 'error' ELSE 'planned' END AS status, CASE WHEN bad THEN '' ELSE w END AS primary_keyword, CASE WHEN bad THEN '' ELSE 'Primary: ' || w || chr(10) || 'Secondary: ' || replace(p_type, ' ', ', ') || chr(10) || 'Long-tail: long tail' END AS keywords_text, CASE WHEN bad THEN 0 ELSE (p_partkey % 3 = 0)::INT END AS faq_count, CASE WHEN bad THEN '' ELSE concat_ws('; ', CASE WHEN n > 60 THEN 'Meta title is ' || n || ' chars (recommended: ' || chr(8804) || '60)' END, CASE WHEN m NOT BETWEEN 150 AND 160 THEN 'Meta description is ' || m || ' chars (recommended: 150-160)' END) || CASE WHEN n > 60 OR m NOT BETWEEN 150 AND 160 THEN chr(10) ELSE '' END || 'a' || chr(10) || 'b' END AS warnings, CASE WHEN bad THEN 'no JSON object in the answer' ELSE '' END AS error FROM x",
    "content_writer": f"WITH {_MD}, x AS (SELECT *, k % 4 <> 0 AS there, '## [Category: ' || slug || ']' || chr(10) || chr(10) || para || chr(10) || chr(10) || '- first point' || chr(10) || '- second point' || chr(10) || chr(10) || '## Meta' || chr(10) || chr(10) || 'Title: x' || CASE WHEN k % 5 = 0 THEN '=== COMPANY ANALYSIS ===' || chr(10) || '{{}}' || chr(10) || chr(10) || '=== SEO CONTENT PLAN ===' || chr(10) || '{{}}' || chr(10) || chr(10) || '=== SOURCE CONTENT (scraped pages) ===' || chr(10) || p_name ELSE '' END AS t FROM m) SELECT entity_name, CASE WHEN there THEN 'written' ELSE 'error' END AS status, CASE WHEN there THEN len(regexp_extract_all(t, '\\S+')) ELSE 0 END::INT AS word_count, CASE WHEN there THEN 2 ELSE 0 END AS section_count, there AS has_citations, CASE WHEN NOT there THEN '' WHEN k % 3 = 0 THEN 'About ' || p_name ELSE entity_name END AS meta_title, CASE WHEN NOT there THEN '' WHEN length(t) > 300 THEN left(t, 300) || '...' ELSE t END AS content_preview, CASE WHEN there THEN t ELSE '' END AS content_markdown, CASE WHEN there THEN '' WHEN k % 8 = 0 THEN 'timed out' ELSE 'no answer' END AS error FROM x",
}

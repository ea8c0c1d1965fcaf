"""Rules of outputs and reports on single cases, and Markdown by cases of its public specification."""

import pytest
from pyspark.sql import functions as F

from lodestream.functions import markdown
from lodestream.functions import text as T
from lodestream.operators import bundle, generation, profiles, reports, site_media
from lodestream.sources import discovery


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


CITES = "array<struct<index: int, url: string, title: string>>"


def made(spark, md, cites="[]", analysis=None, name="Firm", **options):
    df = spark.createDataFrame([(name, md, analysis)], "entity_name string, markdown string, analysis string").withColumn("citations", F.from_json(F.lit(cites), CITES))
    return bundle.markdown_output(df, **options).first().final_markdown


def test_markdown_output(spark):
    assert made(spark, "# A\n\n### Metallurgy\n\nx\n## [Meta]\nTitle: y", front=False) == "# A\n\n### Metallurgy\n\nx"
    assert made(spark, "# A\n## Meta\nTitle: y", front=False) == "# A"
    assert made(spark, "## [Overview]\n### [Tag: live-dealer] x\n# [Secondary Category: on-line]\n## [a$1\\b.c]", front=False) == "## Overview\n### Live Dealer x\n# On Line\n## a$1\\b.c"
    assert made(spark, "x [#3] y [#1][#3]", '[{"index": 1, "url": "u", "title": "t"}]', front=False) == "x [^3] y [^1][^3]\n\n---\n\n[^1]: t — u\n[^3]: Source 3"
    assert made(spark, "x [#3] y", citations="strip", front=False) == "x y"
    assert made(spark, "x [#3] y", citations="inline", front=False) == "x [#3] y"
    analysis = '{"categories": {"primary": [{"slug": "a-b"}], "secondary": ["c: d"]}, "tags": {"existing": [{"slug": "t"}], "suggested_new": [{"label": "yes"}]}}'
    assert made(spark, "x", analysis=analysis, name="It's #1: x") == "---\ntitle: 'It''s #1: x'\ncategories:\n  - a-b\n  - 'c: d'\ntags:\n  - t\n  - 'yes'\n---\n\nx"
    assert spark.createDataFrame([("a", "", None)], "entity_name string, markdown string, analysis string").withColumn("citations", F.from_json(F.lit("[]"), CITES)).transform(bundle.markdown_output).count() == 0


def test_front_matter_reads_back(spark):
    yaml = pytest.importorskip("yaml")
    names = ["plain", "a: b", "- x", "#1", "it's", "12", "true", "null", "é ü", "x #y", " lead", "end ", "[a]", "{b}", '"q"', "@x", "a & b", "2020-01-01", "~", "1e3", "a:b", "100%", "* x", "? x", "! x"]
    for n in names:
        text = made(spark, "x", name=n)
        assert yaml.safe_load(text.split("---\n")[1]) == {"title": n}, text


def test_claims_to_look_up(spark):
    texts = spark.createDataFrame([("e", "It is powered by X now [#1]. It operates in 20 markets. In 2015. Over 500 games are there. It continues to grow since 2001. It is a popular firm since 2001. Growth is calm here.")], "entity_name string, markdown string")
    assert [r.claim for r in generation.claims(texts).orderBy("pos").collect()] == ["It is powered by X now .", "It operates in 20 markets.", "Over 500 games are there."]


def test_occurrences_inside_words(spark):
    assert one(spark, generation.occurrences(F.lit("A person, aperson; PERSONperson a.b aXb"), F.lit("person"))) == 4
    assert one(spark, generation.occurrences(F.lit("aaaa a.b aXb"), F.lit("aa"))) == 2
    assert one(spark, generation.occurrences(F.lit("a.b aXb"), F.lit("a.b"))) == 1
    assert one(spark, generation.occurrences(F.lit("x"), F.lit(""))) == 0


def test_placements(spark):
    md = "# Top word\n\n## Sub\nfirst Line\nother\n### Low\n\nbody here\n## End"
    got = one(spark, generation.placements(F.lit(md), F.array(*map(F.lit, ("word", "sub", "first line", "first", "LOW", "other", "none", "end")))))
    assert [(p.keyword, p.locations) for p in got] == [("word", ["heading"]), ("sub", ["heading"]), ("first line", ["first_paragraph"]), ("first", ["first_paragraph"]), ("LOW", ["body"]), ("other", ["body"]), ("end", ["heading"])]


def test_keywords_of_both_plan_shapes(spark):
    plan = '{"target_keywords": {"primary": "a", "secondary": ["b", "c"]}, "keywords_used": {"head_terms": ["d", "a"], "mid_tail": "e", "long_tail": ["f"]}}'
    assert one(spark, generation.target_keywords(F.lit(plan))) == ["a", "d", "b", "c", "e", "f"]
    assert one(spark, generation.target_keywords(F.lit("{}"))) == []


def test_a_row_for_each_answer(spark):
    rows = spark.createDataFrame([("e", '{"categories": {"primary": ["a"]}}', 1), ("e", '{"categories": {"primary": ["b"]}}', 2), ("e", "no", 3)], "entity_name string, text string, word_count int")
    assert sorted((r.primary_category, r.word_count, r.status) for r in generation.analyses(rows, "m").collect()) == [("", 0, "error"), ("a", 1, "analyzed"), ("b", 2, "analyzed")]
    assert generation.plans(rows.select("entity_name", "text")).count() == 3


def test_calls_are_spaced(spark):
    times = [0, 0, 100, 5000, 5100, 60_000, 60_000]
    calls = spark.createDataFrame([("k", i, t) for i, t in enumerate(times)], "k string, i long, t long").withColumn("ts", F.timestamp_millis("t"))
    got = [r.sent_ms for r in reports.rate_limited(calls, "k", "ts", "i", 30).orderBy("i").collect()]
    last, want = None, []
    for t in times:  # one after another
        last = t if last is None else max(t, last + 2000)
        want.append(last)
    assert got == want


def test_error_lists(spark):
    items = spark.createDataFrame([("b", 2, "late"), ("b", 1, "first"), ("a", 1, None), ("a", 2, "x"), ("c", 1, "")], "entity_name string, pool_pos long, error string")
    assert {(r.entity_name, r.errors, r.error) for r in reports.error_rollup(items).collect()} == {("b", 2, "b: first"), ("a", 1, "a: x")}
    row = reports.step_errors(items, items).first()
    assert (row.total_entities, row.total_items, row.failed, row.description, row.errors) == (3, 2, 2, "2 links from 1 of 3 entities (2 failed)", "a: x\nb: first")
    assert reports.step_errors(items.where("error is null"), items).first().description == "1 links from 3 entities"


def test_texts_on_three_pages_are_fetched_again(spark):
    long = "word " * 60
    rows = [(i, "success", 60, f" {long}" if i < 3 else f"{long} {min(i, 4)}", None) for i in range(6)] + [(9, "skipped", 0, long, None), (10, "error", 0, None, None)]
    got = {r.i: r.again for r in reports.rescrape(spark.createDataFrame(rows, "i int, status string, word_count int, text_content string, text_preview string")).collect()}
    assert got == {0: True, 1: True, 2: True, 3: False, 4: False, 5: False, 9: False, 10: True}


@pytest.mark.parametrize("href, want", [("/a/../b#c", "https://x.org/a/../b"), ("//c.org/p#q", "https://c.org/p"), ("data:image/png", None), ("javascript:x", None), ("  y.png ", "https://x.org/d/y.png"), ("../y.png", "https://x.org/y.png"), ("https://e.org#z", "https://e.org"), ("", None)])
def test_media_addresses(spark, href, want):
    assert one(spark, site_media.resolve_media(F.lit(href), F.lit("https://x.org/d/e?f"))) == want


def test_image_classes(spark):
    i = lambda src="s", alt="", cls="", id_="", width=0: F.struct(F.lit(src).alias("src"), F.lit(alt).alias("alt"), F.lit(cls).alias("cls"), F.lit(id_).alias("id"), F.lit(width).alias("width"))
    assert one(spark, site_media.is_person(i(alt="Ann Smith"))) and one(spark, site_media.is_person(i(cls="Avatar"))) and not one(spark, site_media.is_person(i(src="team.png", alt="ann Smith")))
    assert one(spark, site_media.is_product(i(width=401))) and one(spark, site_media.is_product(i())) and not one(spark, site_media.is_product(i(alt="arrow"))) and not one(spark, site_media.is_product(i(alt="Ann Smith"))) and not one(spark, site_media.is_product(i(width=40)))
    assert one(spark, site_media.is_award(i(src="SEAL.png"))) and not one(spark, site_media.is_award(i(alt="x")))


# Cases of the public CommonMark and GFM specifications, in their plain forms.
@pytest.mark.parametrize("text, html", [
    ("# foo\n###### foo\n####### foo", "<h1>foo</h1>\n<h6>foo</h6>\n<p>####### foo</p>\n"), ("## foo ##", "<h2>foo</h2>\n"), ("#hashtag", "<p>#hashtag</p>\n"), ("Foo *bar*\n===\nFoo\n---", "<h1>Foo <em>bar</em></h1>\n<h2>Foo</h2>\n"),
    ("***\n---\n___", "<hr>\n<hr>\n<hr>\n"), ("    a simple\n      indented", "<pre><code>a simple\n  indented\n</code></pre>\n"), ("```\n<\n >\n```", "<pre><code>&lt;\n &gt;\n</code></pre>\n"), ("~~~\naaa\n```\n~~~", "<pre><code>aaa\n```\n</code></pre>\n"), ("```ruby\ndef\n", "<pre><code class=\"language-ruby\">def\n\n</code></pre>\n"),
    ("> # Foo\n> bar\n> baz", "<blockquote>\n<h1>Foo</h1>\n<p>bar\nbaz</p>\n</blockquote>\n"), ("> a\nlazy\n\nb", "<blockquote>\n<p>a\nlazy</p>\n</blockquote>\n<p>b</p>\n"), ("> > deep", "<blockquote>\n<blockquote>\n<p>deep</p>\n</blockquote>\n</blockquote>\n"),
    ("- foo\n- bar\n+ baz", "<ul>\n<li>foo</li>\n<li>bar</li>\n</ul>\n<ul>\n<li>baz</li>\n</ul>\n"), ("1. foo\n2. bar\n3) baz", "<ol>\n<li>foo</li>\n<li>bar</li>\n</ol>\n<ol start=\"3\">\n<li>baz</li>\n</ol>\n"), ("- foo\n  - bar\n    - baz", "<ul>\n<li>foo\n<ul>\n<li>bar\n<ul>\n<li>baz</li>\n</ul></li>\n</ul></li>\n</ul>\n"),
    ("- a\n- b\n\n- c", "<ul>\n<li><p>a</p>\n</li>\n<li><p>b</p>\n</li>\n<li><p>c</p>\n</li>\n</ul>\n"), ("The number is\n14.  The number", "<p>The number is\n14.  The number</p>\n"), ("- foo\n\n  bar", "<ul>\n<li><p>foo</p>\n<p>bar</p>\n</li>\n</ul>\n"), ("- a\n  ```\n  b\n  ```\n- c", "<ul>\n<li>a\n<pre><code>b\n</code></pre></li>\n<li>c</li>\n</ul>\n"),
    ("| foo | bar |\n| --- | --- |\n| baz | bim |", "<table>\n<thead>\n<tr>\n<th>foo</th>\n<th>bar</th>\n</tr>\n</thead>\n<tbody><tr>\n<td>baz</td>\n<td>bim</td>\n</tr>\n</tbody></table>\n"), ("| abc | def |\n| --- |\n| bar |", "<p>| abc | def |\n| --- |\n| bar |</p>\n"), ("a | b\n:-:|-\nx\\|y |", "<table>\n<thead>\n<tr>\n<th align=\"center\">a</th>\n<th>b</th>\n</tr>\n</thead>\n<tbody><tr>\n<td align=\"center\">x|y</td>\n<td></td>\n</tr>\n</tbody></table>\n"),
    ("`` foo ` bar ``", "<p><code>foo ` bar</code></p>\n"), ("*foo`*`", "<p>*foo<code>*</code></p>\n"), ("**foo** __bar__ *a* _b_", "<p><strong>foo</strong> <strong>bar</strong> <em>a</em> <em>b</em></p>\n"), ("foo*bar* a * b* snake_case_word", "<p>foo<em>bar</em> a * b* snake_case_word</p>\n"), ("\\*not emphasized*", "<p>*not emphasized*</p>\n"), ("~~gone~~", "<p><del>gone</del></p>\n"),
    ('[link](/uri "title") [l](</a>)', '<p><a href="/uri" title="title">link</a> <a href="/a">l</a></p>\n'), ("![foo *b*](/url)", '<p><img src="/url" alt="foo b"></p>\n'), ("[a](/x(y)) [b]( )", '<p><a href="/x(y)">a</a> <a href="">b</a></p>\n'), ("<https://a.org/?b&c>", '<p><a href="https://a.org/?b&amp;c">https://a.org/?b&amp;c</a></p>\n'), ("see https://a.org/b.", '<p>see <a href="https://a.org/b">https://a.org/b</a>.</p>\n'),
    ("a &amp; b & c < d \" e", "<p>a &amp; b &amp; c &lt; d &quot; e</p>\n"), ("foo  \nbar\\\nbaz", "<p>foo<br>\nbar<br>\nbaz</p>\n"), ("a <b class=x>c</b>", "<p>a <b class=x>c</b></p>\n"), ("<div>\n*x*\n</div>\n\n*y*", "<div>\n*x*\n</div>\n<p><em>y</em></p>\n"), ("", ""), ("\x00\x01", "<p>��</p>\n"),
])
def test_markdown_by_its_specification(text, html):
    assert markdown.to_html(text) == html


@pytest.mark.parametrize("text", ["*" * 20_000, "**a " * 8000, "[" * 20_000, "`" * 20_000, "` `` " * 5000, "> " * 20_000, "- " * 8000, "<" * 20_000, "a*b" * 10_000, "_a " * 10_000, "![[" * 8000, "\n".join("  " * i + "- x" for i in range(300)), "[a](" * 8000, "| a " * 5000 + "\n" + "|-" * 5000])
def test_odd_markdown_ends_soon(text):
    import time

    began = time.time()
    markdown.to_html(text)
    assert time.time() - began < 10


def test_html_documents(spark):
    df = spark.createDataFrame([("A & B", "# [Overview]\n\nx [#2]\n\n- a\n  1. b", '{"key_facts": {"founded": 1999}}'), ("C", "y", None), ("D", None, None)], "entity_name string, markdown string, analysis string").withColumn("citations", F.from_json(F.lit('[{"index": 2, "url": "", "title": "T<"}]'), CITES))
    rows = {r.entity_name: r for r in bundle.html_documents(df).collect()}
    assert rows["A & B"].final_html == '<script type="application/ld+json">\n{"@context":"https://schema.org","@type":"Organization","name":"A & B","foundingDate":"1999"}\n</script>\n<h1>Overview</h1>\n<p>x <sup><a href="#source-2" id="ref-2">[2]</a></sup></p>\n<ul>\n<li>a\n<ol>\n<li>b</li>\n</ol></li>\n</ul>\n\n<section class="sources"><h2>Sources</h2><ol><li id="source-2">T&lt; <a href="#ref-2">↩</a></li></ol></section>'
    assert rows["C"].final_html == "<p>y</p>\n" and not rows["C"].has_schema_org and "D" not in rows
    whole = {r.entity_name: r.final_html for r in bundle.html_documents(df, wrap=True, css="<style></style>", sources=False).collect()}
    assert whole["A & B"].startswith("<!DOCTYPE html>\n") and "<title>A &amp; B</title>\n<style></style>\n<script" in whole["A & B"] and "Sources" not in whole["A & B"]


def test_flat_profiles(spark):
    bodies = [
        '{"success": true, "data": {"name": "A", "experience": [{"position": "P", "start_date": "", "start": "1999"}, {"title": "{x}"}], "positions": [{"title": "not this"}], "skills": ["{a", {"name": "b"}, {}, null, "{}"]}}',
        '{"full_name": "B", "name": "C", "positions": [{"title": "T"}], "languages": {"name": "x"}, "education": []}',
        "no JSON", None,
    ]
    rows = profiles.parse_flat(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")).orderBy("id").collect()
    assert [tuple(x) for x in rows[0].positions] == [("P", "", "", "1999", None, ""), ("{x}", "", "", None, None, "")] and rows[0].skills == ["{a", "b", "", "", ""]
    assert rows[1].full_name == "B" and [x.title for x in rows[1].positions] == ["T"] and rows[1].languages == [] and rows[1].education == []
    assert all(r.full_name == "" and r.positions == [] and r.skills == [] for r in rows[2:])


def test_a_session_stops_after_failures_in_a_row(spark):
    runs = {"a": "fgffgfffgf", "b": "ffgffg", "c": "ffffff", "d": "f", "e": "gggfff"}
    tries = spark.createDataFrame([(r, i, x == "f") for r, s in runs.items() for i, x in enumerate(s)], "entity_name string, _i long, failed boolean")
    assert {r.entity_name: r.stop for r in profiles.stopped_at(tries).collect()} == {"a": 7, "c": 2, "e": 5}
    assert {r.entity_name: r.stop for r in profiles.stopped_at(tries, 1).collect()} == {"a": 0, "b": 0, "c": 0, "d": 0, "e": 3}


def test_scraping_without_rows_or_answers(spark):
    wanted = spark.createDataFrame([(1, "r", 0, None, "u"), (2, None, 0, "n", None)], "id int, run string, pool_pos long, entity_name string, url string")
    first, second = spark.createDataFrame([], "id int, body string"), spark.createDataFrame([], "url string, http_status int, body string")
    assert sorted((r.id, r.status, r.error) for r in profiles.scraped(wanted, first, second).collect()) == [(1, "error", "All methods failed: no answer"), (2, "error", "All methods failed: no answer")]
    assert profiles.scraped(wanted.where("false"), first, second).count() == 0


def test_article_requests_of_odd_items(spark):
    rows = [
        ("x", 5, "content-analyzer", None, None, None, '{"a":1}', None), ("x", 1, "seo-planner", None, None, None, None, ""), ("x", 2, None, "", "", "first", None, None), ("x", 2, "other", "u", "t", "second", None, None), ("x", 3, "other", "u", "t", None, None, None),
        ("y", 1, "other", "u", "t", "text", None, None), ("z", 1, "content-analyzer", None, None, "ignored", None, None),
    ]
    items = spark.createDataFrame(rows, "entity_name string, pool_pos long, source_submodule string, url string, title string, text_content string, output string, meta_title string")
    got = {r.entity_name: r for r in generation.article_requests(items, "{entity_content}").collect()}
    assert got["x"].prompt == '=== COMPANY ANALYSIS ===\n{"a":1}\n\n=== SEO CONTENT PLAN ===\n{}\n\n=== SOURCE CONTENT (scraped pages) ===\n--- Page: Untitled (unknown) ---\nfirst\n\n--- Page: t (u) ---\nsecond' and got["x"].meta_title == "x" and got["x"].source_pages == 2
    assert got["y"].prompt is None and got["y"].error == "Missing upstream output: content-analyzer, seo-planner. Run these submodules first."
    assert got["z"].error == "Missing upstream output: seo-planner. Run these submodules first." and got["z"].source_pages == 0
    assert generation.article_requests(items.where("false"), "{entity_content}").count() == 0


def test_feeds_of_sites_broadcast_nothing_that_grows(spark, tmp_path):
    """Spark takes exploded and made texts for as small as the table that they come from, and would gather them on the driver."""
    sites = spark.createDataFrame([("a", "https://a.org"), ("b", "a.org/"), ("c", "https://c.org"), ("d", "")], "entity_name string, website string")
    home = '<link rel="alternate" type="application/rss+xml" href="/blog/feed" title="B"><link rel="alternate" type="application/atom+xml" href="/none">'
    rows = [("https://a.org", 200, home), ("https://a.org/blog/feed", 200, "<feed><entry >"), ("https://a.org/feed", 200, "<rss><title>T</title>"), ("https://a.org/rss", 404, "<rss>"), ("https://c.org/blog/feed", 200, "<rss>")]
    sites.write.parquet(f"{tmp_path}/sites")
    spark.createDataFrame(rows, "url string, http_status int, body string").write.parquet(f"{tmp_path}/answers")
    got = discovery.discover_feeds(spark.read.parquet(f"{tmp_path}/sites"), spark.read.parquet(f"{tmp_path}/answers"))
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    of_a = {("https://a.org/blog/feed", "atom", "B", 1), ("https://a.org/none", "atom", None, 0), ("https://a.org/feed", "rss", "T", 0)}
    assert {tuple(r) for r in got.collect()} == {(e, *r) for e in "ab" for r in of_a} | {("c", "https://c.org/blog/feed", "rss", None, 0)}


def test_pages_that_end_just_before_the_cut(spark):
    """A page of 399, 400 and 401 characters, with another behind it and without; a page has 25 besides its text."""
    rows = [(f"{n}{'+' * more}", pos, "u", "t" * 4, "x" * (n - 24) if pos == 0 else "y", 1) for n in (397, 398, 399, 400, 401) for more in (0, 1) for pos in range(more + 1)]
    pages = spark.createDataFrame(rows, "entity_name string, pool_pos int, url string, title string, text_content string, word_count int")
    got = {r.entity_name: r.entity_content for r in generation.assemble_pages(pages, 400).collect()}
    for name, content in got.items():
        whole = f"--- Page: tttt (u) ---\n{'x' * (int(name[:3]) - 24)}" + "\n\n--- Page: tttt (u) ---\ny" * name.endswith("+")
        assert content == (whole if len(whole) <= 400 else whole[:400] + "\n\n[Content truncated at 400 characters]"), name
    assert len(got) == 10


def test_repeated_positions_are_cut_in_the_order_of_their_pages(spark):
    rows = [("e", 1, "u", "t", c * 150, 0) for c in "dacb"] + [("e", 0, "u", "t", "z", 0)]
    pages = spark.createDataFrame(rows, "entity_name string, pool_pos int, url string, title string, text_content string, word_count int")
    whole = "\n\n".join(f"--- Page: t (u) ---\n{x}" for x in ("z", *(c * 150 for c in "abcd")))
    assert generation.assemble_pages(pages, 300).first().entity_content == whole[:300] + "\n\n[Content truncated at 300 characters]"
    assert generation.assemble_sources(pages, 400).first().source_text == generation.BOUNDARY.join(["z", "a" * 150, "b" * 150])


def test_company_media_reads_pictures_once_and_broadcasts_no_pages(spark, tmp_path):
    home = '<a href="/team">T</a><a href="/products">P</a><img src="/logo-a.png"><img src="/logo-b.svg"><img src="/logo-a.png"><img src="/award.png">'
    inner = '<img src="/p/ann.jpg" alt="Ann Smith"><img src="/p/ann.jpg" alt="Ann Smith"><img src="/p/wide.jpg" width="900">'
    spark.createDataFrame([("e", "https://e.org/", home)], "entity_name string, url string, html string").write.parquet(f"{tmp_path}/homes")
    spark.createDataFrame([("https://e.org/team", inner), ("https://e.org/products", inner), ("https://e.org/team", None)], "url string, html string").write.parquet(f"{tmp_path}/pages")
    got = site_media.company_media_of_pages(spark.read.parquet(f"{tmp_path}/homes"), spark.read.parquet(f"{tmp_path}/pages"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode(filter(transform(regexp_extract_all(html") == 1
    assert "strategy=merge" in plan
    r = got.first()
    assert (r.all_logos_json, r.team_photos_json, r.screenshots_json, r.awards_json) == ('["https://e.org/logo-b.svg","https://e.org/logo-a.png"]', '["https://e.org/p/ann.jpg"]', '["https://e.org/p/wide.jpg"]', '["https://e.org/award.png"]')

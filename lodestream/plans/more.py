"""Queries that read and write files, keyword tables, page trees; each with the SQL that it is checked against, where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestream.functions import docx
from lodestream.functions import fixed_values as fixed
from lodestream.functions import urls as U
from lodestream.operators import content, generation, keywords, pages, profiles, seo, site_media
from lodestream.plans.inputs import page_items, table
from lodestream.sources import discovery, files


def scratch(spark) -> str:
    """A folder of its own that the driver and all executors share: below spark.checkpoint.dir, or a temporary one in local mode."""
    import tempfile

    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-files-")
    return f"{folder}/{uuid.uuid4().hex}"


def _cluttered(s, d):
    """Pages as they are; within content systems; with nothing but links; with their article hidden."""
    k, html = F.col("page_id"), F.col("html")
    words = F.repeat(F.lit("some words, of a text "), (k % 13).cast("int"))
    wrapped = F.concat(F.lit('<body><div hidden class="entry-content"><p>'), words, F.lit('</p></div><div hidden class="entry-content"><nav>no</nav>more of the text</div></body>'))
    links = F.concat(F.lit("<body><div class=menu>"), F.repeat(F.lit("<a href=/x>a link of many</a> "), (k % 29).cast("int")), F.lit("</div><header>"), words, F.lit("</header></body>"))
    hidden = F.replace(html, F.lit("<article"), F.lit('<article style="display: none"'))
    return table(s, d, "pages").select("page_id", F.when(k % 4 == 0, html).when(k % 4 == 1, wrapped).when(k % 4 == 2, links).otherwise(hidden).alias("html"))


def _methods(s, d):
    tiers = pages.dom_text(_cluttered(s, d)).withColumn("kind", F.col("page_id") % 4)
    return content.histogram(tiers, "extraction_method", ["kind"]).select("kind", F.to_json("counts").alias("counts"))


_HREFS = ["../x/./y", "../../../..", "./a/../b?c=/../d", "g/.", "..", "a//../b", "/m/../n", "plain"]


def _dots(s, d):
    p = page_items(s, d)
    href = F.element_at(F.array(*map(F.lit, _HREFS)), (F.col("page_id") % len(_HREFS) + 1).cast("int"))
    base = F.concat(F.col("url"), F.when(F.col("page_id") % 3 == 0, "/one/two.html?q=/a/b").otherwise(""))
    return p.select("page_id", U.absolute(base, href).alias("url"))


def _configs(s, d):
    """An answer of the job analyzer for each supplier, as JSON; every seventh has none."""
    p, k = table(s, d, "supplier"), F.col("s_suppkey")
    need = F.struct(F.concat(F.lit("Skill "), k.cast("string")).alias("requirement"), F.lit("high").alias("priority"), (k % 3).cast("int").alias("frequency"))
    context = F.struct(F.when(k % 2 == 0, "8").alias("team_size"), F.lit("CEO").alias("reporting_to"), F.lit("").alias("scope"), F.lit("Malta").alias("location"))
    job = F.struct(F.array(need, need).alias("explicit_requirements"), F.array(F.lit("A & B")).alias("preferred_qualifications"), F.array(F.lit("x"), F.lit("<y>")).alias("industry_language"), context.alias("operational_context"), F.array(F.lit("fast")).alias("culture_signals"))
    item = F.struct(F.lit("edit").alias("type"), F.when(k % 2 == 1, "firm").alias("job"), F.lit("old").alias("current"), F.concat(F.lit("new "), "s_name").alias("suggested"), F.lit("need").alias("addresses"))
    gap = F.struct(F.lit("Gap").alias("requirement"), F.lit("low").alias("priority"), F.lit("near").alias("closest_match"), F.when(k % 2 == 0, "Why?").alias("question"))
    cv = F.struct(F.concat(F.lit("Summary of "), "s_name").alias("summary"), F.array(F.lit("one"), F.lit("two")).alias("highlights"), F.create_map(F.lit("firm"), F.struct(F.lit("CMO").alias("role"), F.lit("Intro").alias("intro"), F.array(F.lit("did")).alias("bullets"))).alias("jobs"))
    config = F.struct(F.concat("s_name", F.lit(" & Co.")).alias("company_name"), F.lit("cmo").alias("base_variant"), (k % 10 / 10).alias("fit_score"), F.when(k % 5 != 0, job).alias("job_analysis"), F.array(gap).alias("gaps"), F.struct(F.struct((k % 3 != 0).alias("has_suggestions"), F.array(item).alias("items")).alias("job_bullets")).alias("suggestions"), cv.alias("cv"))
    return p.select(F.col("s_name").alias("entity_name"), k.alias("pool_pos"), F.when(k % 7 != 0, F.to_json(config)).alias("config"))


def _applications(s, d):
    """Written, read back, and their texts."""
    folder = scratch(s)
    made = profiles.application_documents(_configs(s, d), F.lit("2026-01-31"))
    files.save_files(made, folder, folders=int(s.conf.get("spark.sql.shuffle.partitions")))
    text = F.when(F.col("name").endswith(".docx"), F.array_join(docx.document_texts("content"), "\n")).otherwise(F.get_json_object(F.decode("content", "UTF-8"), "$.company_name"))
    return files.load_files(s, folder).select("name", text.alias("text"))


def _application_rows(s, d):
    configs = _configs(s, d)
    return profiles.application_summary(configs, profiles.application_documents(configs, F.lit("2026-01-31"))).drop("cv_size_kb")


def _answers(s, d):
    """Pages by a prefix of their URL and by status, from recorded responses."""
    got = files.responses(s, f"{d}/pages.parquet", "url string, method string, http_status int, body string", body="html")
    wanted = page_items(s, d).select("page_id", F.when(F.col("page_id") % 5 == 0, F.concat("url", F.lit("/gone"))).otherwise(F.col("url")).alias("url"))
    return files.fetched(wanted, got.where(F.col("url").startswith("http"))).select("page_id", "http_status", F.length("body").alias("n_chars"), "error")


def _one_host(s, d):
    return files.responses(s, f"{d}/pages.parquet", "url string, body string", body="html").where(F.col("url").startswith("https://th")).select("url", F.length("body").alias("n_chars"))


def _cv(s, d):
    """Files written from nations: in the folder, in its part `cv`, in both or in none."""
    folder, n = scratch(s), table(s, d, "nation")
    k = F.col("n_nationkey")
    rows = n.select(F.concat("n_name", F.lit(".md")).alias("name"), k, "n_name")
    files.save_files(rows.where("n_nationkey % 4 in (0, 2)").select("name", F.encode(F.concat(F.lit("outer "), "n_name"), "UTF-8").alias("content")), folder)
    files.save_files(rows.where("n_nationkey % 4 in (1, 2)").select("name", F.encode(F.concat(F.lit("inner "), "n_name"), "UTF-8").alias("content")), f"{folder}/cv")
    names = [r.name for r in rows.select("name").orderBy("name").collect()]  # the documents of one CV
    found = files.cv_files(s, folder, names, tuple(x for x in names if x < "C"), {names[0]: "{}"})
    return found.select(F.url_decode("name").alias("name"), "place", "content")


def _keyword_table(s, d):
    """Words of parts' names and types, and some that no part has."""
    p = table(s, d, "part")
    return p.select(F.explode(F.concat(F.split("p_name", " "), F.array("p_type", "p_name"), F.array(F.lit("the"), F.lit("of the"), F.lit("on"), F.lit("t"), F.lit("."), F.lit("The"), F.lit("no such term")))).alias("keyword")).distinct()


def _keywords(s, d):
    return keywords.keyword_counts(table(s, d, "documents"), _keyword_table(s, d))


def _coverage(s, d):
    return keywords.keyword_coverage(_keywords(s, d), _keyword_table(s, d))


_LINKS = '<a href="/about#us">A</a><a href="/our-team/x">T</a><a href="/about">again</a><a href="https://www.e{k}.org/products/a">P</a><a href=\'/awards\'>W</a><a href="https://else.org/team">E</a><a href="/platform/../platform">F</a><a href="people">R</a><a href="#top">N</a><a href="/staff">S</a>'
_HOME_IMAGES = '<img src="/img/brand-dark.svg" alt="Firm" width="120"><img alt="x" src="data:image/png;base64,xx"><IMG SRC=\'//cdn.org/award-{k}.png#f\' class="badge"><img src="/img/icon-site.png" id="site-icon" width=16><img src="plain.jpg">'
_INNER_IMAGES = '<img src="/p/{k}-1.jpg" alt="Ann Smith"><img src="/p/{k}-2.jpg" alt="the ceo" width="39"><img src="/p/{k}-2.jpg" alt="the ceo" width="40"><img src="/p/wide.jpg" width="900"><img src="/p/spacer.gif" alt="Bob Jones"><img src="/p/logo.png" class="logo" width="200"><img src="pic-{k}.png"><img src="/p/seal.png" alt="winner"><img src="/p/button.png" alt="demo">'


def _site(s, d, template: str):
    return F.replace(F.lit(template), F.lit("{k}"), F.col("page_id").cast("string"))


def _media(s, d):
    """The pages table as homepages with links and pictures put in front, and the pages that they link to, some of them missing."""
    p, k = table(s, d, "pages"), F.col("page_id")
    base = F.concat(F.lit("https://e"), k.cast("string"), F.lit(".org"))
    head = F.concat(F.when(k % 3 == 0, "<meta content='/og.png' property='og:image'>").otherwise(""), F.lit('<link rel="shortcut icon" href="/fav.ico">'))
    images = F.when(k % 4 != 3, _site(s, d, _HOME_IMAGES)).otherwise("")
    homes = p.select(k.alias("entity_name"), F.concat(base, F.lit("/start/")).alias("url"), F.when(k % 17 != 5, F.concat(head, _site(s, d, _LINKS), images, "html")).alias("html"))
    paths = F.array(*map(F.lit, ("/about", "/our-team/x", "/products/a", "/awards", "/platform/../platform", "/start/people", "/staff")))
    host = F.when(F.col("path") == "/products/a", F.concat(F.lit("https://www.e"), k.cast("string"), F.lit(".org"))).otherwise(base)
    inner = p.select("page_id", F.posexplode(paths).alias("i", "path")).where("(page_id + i) % 5 != 0").select(F.concat(host, "path").alias("url"), F.repeat(_site(s, d, _INNER_IMAGES), (k % 4).cast("int")).alias("html"))
    checked = p.select(F.explode(F.array(F.concat(base, F.lit("/img/brand-dark.svg")), F.concat(base, F.lit("/p/logo.png")), F.concat(base, F.lit("/og.png")), F.concat(base, F.lit("/p/"), k.cast("string"), F.lit("-1.jpg")), F.concat(base, F.lit("/p/wide.jpg")), F.concat(F.lit("https://cdn.org/award-"), k.cast("string"), F.lit(".png")), F.concat(base, F.lit("/fav.ico")))).alias("url")).where("length(url) % 7 != 1")
    return homes, inner, checked


def _media_all(s, d):
    homes, inner, _ = _media(s, d)
    return site_media.company_media_of_pages(homes, inner)


def _media_checked(s, d):
    homes, inner, checked = _media(s, d)
    return site_media.company_media_of_pages(homes, inner, checked)


def _feeds(s, d):
    """Sites of customers: homepages that name feeds, some twice or of other kinds, and answers under known paths, some of them no feeds."""
    c, k = table(s, d, "customer"), F.col("c_custkey")
    base = F.concat(F.lit("https://c"), k.cast("string"), F.lit(".org"))
    link = lambda kind, href, title: F.lit(f"<link title='{title}' rel=\"alternate\" type=\"{kind}\" href=\"{href}\">")
    home = F.concat(F.when(k % 2 == 0, link("application/rss+xml", "/named", "Named")).otherwise(""), link("text/css", "/style", "no"), F.when(k % 3 == 0, link("application/atom+xml", "feed.xml", "")).otherwise(""), F.when(k % 6 == 0, link("application/xml", "/named", "again")).otherwise(""))
    rss = F.concat(F.lit("<?xml?><RSS><title> Own </title>"), F.repeat(F.lit("<item>i</item>"), (k % 4).cast("int")))
    answer = lambda path, status, body: c.select(F.concat(base, F.lit(path)).alias("url"), status.cast("int").alias("http_status"), body.alias("body"))
    answers = answer("", F.when(k % 7 == 0, 500).otherwise(200), home)
    for path, status, body in (("/feed", F.when(k % 5 == 0, 404).otherwise(200), F.lit("<feed><entry a=1>")), ("/rss", F.lit(200), F.when(k % 4 == 0, "<html>").otherwise(rss)), ("/feed.xml", F.lit(201), rss), ("/named", F.when(k % 4 == 0, 404).otherwise(200), F.lit("<rdf:RDF><item ><item>"))):
        answers = answers.unionByName(answer(path, status, body))
    sites = c.select(F.col("c_name").alias("entity_name"), F.when(k % 11 != 0, F.when(k % 2 == 0, F.concat(base, F.lit("/"))).otherwise(F.regexp_replace(base, "^https://", ""))).alias("website"))
    return discovery.discover_feeds(sites, answers, most=3)


def _seo_plans(s, d):
    """Plans of parts: with all places of keywords, with some, with an outline of an older kind, and with neither."""
    p, k = table(s, d, "part"), F.col("p_partkey")
    words = F.split("p_name", " ")
    whole = F.struct(
        F.struct(words.alias("headline_keywords"), F.array(F.lit("a"), F.lit("b")).alias("body_keywords")).alias("overview"), F.array(F.struct(F.lower("p_type").alias("category_slug"), F.lit("primary").alias("category_tier"), words.alias("heading_keywords"), F.array(F.lit("c")).alias("body_keywords")), F.struct(F.lit("other").alias("category_slug"), F.lit(None).cast("string").alias("category_tier"), F.lit(None).cast("array<string>").alias("heading_keywords"), F.lit(None).cast("array<string>").alias("body_keywords"))).alias("categories"),
        F.array(F.struct(F.lit("t").alias("tag_slug"), F.array("p_brand").alias("keywords")), F.struct(F.lit("none").alias("tag_slug"), F.array().cast("array<string>").alias("keywords"))).alias("tags"), F.struct(F.array(F.lit("iso")).alias("keywords")).alias("credentials"), F.struct(F.array(F.lit("why"), F.lit("how")).alias("keywords")).alias("faq"),
    )
    some = F.struct(F.array(F.struct(F.lit("t").alias("tag_slug"), F.array(F.lit("x"), F.lit("x")).alias("keywords"))).alias("tags"))
    section = lambda i: F.struct(F.concat(F.lit(f"S{i} "), "p_name").alias("heading"), F.lit("intro" if i % 2 else None).cast("string").alias("type"), F.lit(100 * i or None).cast("int").alias("word_target"), (F.array(F.lit("kw")) if i == 1 else F.lit(None).cast("array<string>")).alias("keywords"), (F.array(F.struct(F.lit("sub").alias("heading"), F.lit(50).alias("word_target"))) if i == 2 else F.lit(None).cast("array<struct<heading: string, word_target: int>>")).alias("subsections"))
    meta = F.struct(F.when(k % 3 != 0, F.col("p_name")).alias("title"), F.lit("What it is").alias("description"), F.when(k % 2 == 0, 7).alias("description_chars"))
    faq = F.struct(F.lit("Why?").alias("question"), F.when(k % 2 == 0, "brief").alias("answer_brief"), F.lit("answer").alias("answer"), F.when(k % 5 == 0, "kw").alias("target_keyword"))
    json = lambda *more: F.to_json(F.struct(F.struct(F.get(words, F.lit(0)).alias("primary"), F.slice(words, 2, 9).alias("secondary")).alias("target_keywords"), meta.alias("meta"), F.when(k % 7 != 0, F.array(faq, faq)).alias("faqs"), F.when(k % 2 == 1, "calm").alias("tone_notes"), *more))
    plan = F.when(k % 4 == 0, json(whole.alias("keyword_distribution"))).when(k % 4 == 1, json(some.alias("keyword_distribution"))).when(k % 4 == 2, json(F.array(*map(section, range(6))).alias("content_outline"))).otherwise(json())
    return seo.seo_plan_texts(p.select(k.cast("string").alias("entity_name"), plan.alias("plan")))


_FLAT_UNDER_DATA = '{"success": true, "data": {"name": "N{k}", "title": "T", "about": "A", "positions": [{"position": "P", "company_name": "C", "start": "2001", "end_date": "Jan 2003"}, {"title": "Q", "start_date": "2020"}], "skills": "none", "certifications": [{"name": "X"}, {}]}}'
_FLAT_BARE = '{"success": true, "full_name": "F{k}", "headline": "H", "location": "L", "summary": "a summary that is a little longer than fifty characters", "experience": [], "positions": [{"title": "no"}], "education": [{"institution": "I", "degree_name": "MA", "field": "F", "end": "1999", "description": "E"}], "skills": ["a", {"name": "b"}], "languages": ["x"]}'


def _scrape_inputs(s, d):
    """Customers as profiles, their nations as sessions. The first service answers in full, with an empty list or not at all; the second in both flat shapes, with errors or not at all."""
    c, k = table(s, d, "customer"), F.col("c_custkey")
    url = F.concat(F.lit("https://x.org/in/"), k.cast("string"))
    some = lambda of, **fields: F.struct(F.array(F.struct(*(v.alias(n) for n, v in fields.items()))).alias(of))
    date = F.struct(F.struct(F.lit(3).alias("month"), F.lit(2001).alias("year")).alias("start"))
    job = some("elements", title=F.lit("Head"), locationName=F.when(k % 3 == 0, "Rome"), dateRange=date, description=F.repeat(F.lit("d"), (k % 40).cast("int")))
    group = some("elements", company=F.struct(F.lit("Firm").alias("name")), profilePositionInPositionGroup=job)
    school = some("elements", schoolName=F.lit("School"), degreeName=F.when(k % 5 == 0, "BA"), fieldOfStudy=F.when(k % 2 == 1, "Art"))
    help_ = some("elements", role=F.lit("Guide"), companyName=F.when(k % 2 == 0, "Club"))
    full = some("elements", firstName=F.col("c_name"), headline=F.when(k % 2 == 0, F.col("c_mktsegment")), summary=F.repeat(F.lit("s"), (k % 100).cast("int")), geoLocation=F.struct(F.struct(F.when(k % 4 != 0, "Malta").alias("defaultLocalizedName")).alias("geo")), profilePositionGroups=group, profileEducations=school, profileVolunteerExperiences=F.when(k % 7 == 0, help_))
    wanted = c.select(k.alias("id"), F.col("c_nationkey").alias("run"), k.alias("pool_pos"), F.col("c_name").alias("entity_name"), url.alias("url"))
    first = c.where("c_acctbal >= 5000 or c_custkey % 2 = 0").select(k.alias("id"), F.when(F.col("c_acctbal") < 5000, '{"elements": []}').otherwise(F.to_json(full)).alias("body"))
    of = lambda t: F.replace(F.lit(t), F.lit("{k}"), k.cast("string"))
    body = F.when(k % 4 == 0, of(_FLAT_UNDER_DATA)).when(k % 4 == 1, of(_FLAT_BARE)).when(k % 4 == 2, '{"success": false, "error": "no such profile"}').otherwise('{"message": "slow down"}')
    second = c.where("c_custkey % 9 <> 4").select(url.alias("url"), F.when(k % 8 == 1, 500).otherwise(200).alias("http_status"), body.alias("body"))
    return wanted, first, second


def _article_requests(s, d):
    """Turns of conversations as pages, and for most conversations two analyses and one or two plans."""
    t = table(s, d, "conversations")
    k = F.col("conv_id")
    none = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    sources = t.select(k.cast("string").alias("entity_name"), F.col("turn").cast("long").alias("pool_pos"), F.when(F.col("turn") == 1, "page-scraper").alias("source_submodule"), F.when(F.col("turn") % 3 != 2, F.concat(F.lit("u"), "turn")).alias("url"), F.when(F.col("turn") > 0, F.col("role")).alias("title"), F.when(F.col("turn") != 3, F.col("text")).alias("text_content"), *none("output", "meta_title"))
    made = t.select("conv_id").distinct()
    n = k.cast("string")

    def answers(rows, name: str, pos: int, output, title=None):
        return rows.select(n.alias("entity_name"), F.lit(pos).cast("long").alias("pool_pos"), F.lit(name).alias("source_submodule"), *none("url", "title"), F.lit("an answer").alias("text_content"), output.alias("output"), (F.lit(None).cast("string") if title is None else title).alias("meta_title"))

    parts = [
        answers(made.where(k % 5 != 0), "content-analyzer", 1000, F.lit('{"a": 0}')), answers(made.where(k % 5 != 0), "content-analyzer", 1001, F.concat(F.lit('{"a": '), n, F.lit("}"))),
        answers(made.where(k % 7 != 0), "seo-planner", 1002, F.when(k % 3 == 0, F.concat(F.lit('{"meta":{"title":"Plan '), n, F.lit('"}}'))).otherwise("{}"), F.when(k % 4 == 0, F.concat(F.lit("Title "), n))), answers(made.where(k % 14 == 1), "seo-planner", 1003, F.lit('{"last":1}')),
    ]
    for part in parts:
        sources = sources.unionByName(part)
    return generation.article_requests(sources, "Write {doc:rules}{doc:none}: {entity_content}", {"rules": "well"}, 300)


def queries() -> dict:
    return {
        "dom_tiers": lambda s, d: pages.dom_text(_cluttered(s, d), longest=None),
        "dom_tier_methods": _methods,
        "resolve_dot_segments": _dots,
        "application_documents": _applications,
        "application_summary": _application_rows,
        "response_source": _answers,
        "response_source_by_host": _one_host,
        "cv_files": _cv,
        "keyword_documents": _keywords,
        "keyword_coverage": _coverage,
        "discover_feeds": _feeds,
        "seo_plan_texts": _seo_plans,
        "company_media_of_pages": _media_all,
        "company_media_checked": _media_checked,
        "profile_fallback": lambda s, d: profiles.scraped(*_scrape_inputs(s, d)),
        "profile_no_fallback": lambda s, d: profiles.scraped(*_scrape_inputs(s, d), fallback=False).select("id", "scrape_method", "status", "error", "completeness_score"),
        "profile_scrape_summary": lambda s, d: profiles.scrape_summary(profiles.scraped(*_scrape_inputs(s, d))),
        "article_requests": _article_requests,
    }


_CONFIGS = """c AS (SELECT s_name, s_suppkey AS k, regexp_replace(regexp_replace(s_name || ' & Co.', '[^a-zA-Z0-9_]', '_', 'g'), '_+', '_', 'g') AS slug FROM supplier)"""
_TIMES = "'  [high] Skill ' || k || CASE WHEN k % 3 > 1 THEN ' (mentioned ' || k % 3 || 'x)' ELSE '' END"
_WORDS_OF = "SELECT DISTINCT unnest(string_split(p_name, ' ') || [p_type, p_name, 'the', 'of the', 'on', 't', '.', 'The', 'no such term']) AS keyword FROM part"
_FOUND = r"f AS (SELECT doc_id, keyword, len(regexp_extract_all(text, '(?i)\b' || regexp_replace(keyword, '([.])', '\\\1', 'g') || '\b'))::BIGINT AS n FROM documents, k WHERE contains(lower(text), lower(keyword)))"

def _media_sql(checked: bool) -> str:
    of = lambda t: "'" + t.replace("'", "''").replace("{k}", "' || k || '") + "'"
    resolve = lambda h: f"regexp_replace(CASE WHEN {h} = '' OR starts_with({h}, 'data:') OR starts_with({h}, 'javascript:') THEN NULL WHEN regexp_matches({h}, '^https?://') THEN {h} WHEN starts_with({h}, '//') THEN 'https:' || {h} WHEN starts_with({h}, '/') THEN regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || {h} ELSE regexp_replace(regexp_extract(url, '^(.*/)[^/]*$', 1) || {h}, '/[^/]+/[.][.]/', '/') END, '#.*$', '')"
    domain = lambda u: f"regexp_replace(lower(regexp_extract({u}, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\\.', '')"
    path = lambda u: f"regexp_extract({u}, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1)"
    kinds = " UNION ALL ".join(f"SELECT * FROM (SELECT entity_name, '{kind}' AS type, {i} AS o, n, u, row_number() OVER (PARTITION BY entity_name ORDER BY n) AS c FROM own WHERE {' OR '.join(f"contains(lower({path('u')}), '{x}')" for x in parts)}) WHERE c <= {most}" for i, (kind, (parts, most)) in enumerate(fixed.MEDIA_PAGES.items()))
    attr = lambda name: f"regexp_extract(tag, '(?i){name}\\s*=\\s*[\"'']([^\"'']*?)[\"'']', 1)"
    num = lambda name: f"coalesce(TRY_CAST(regexp_extract(tag, '(?i){name}\\s*=\\s*[\"'']?(\\d{{1,9}})', 1) AS INT), 0)"
    has = lambda c, words: f"regexp_matches({c}, '(?i){words}')"
    score = " + ".join(f"{n} * {has('a' if place == 'any' else 'src', pattern)}::INT" for place, pattern, n in fixed.LOGO_SIGNS)
    classes = {"team": "type = 'team' AND large AND person", "products": f"type = 'products' AND large AND ({has('a', fixed.PRODUCT_WORDS)} OR width > 400 OR (width = 0 AND NOT person AND NOT {has('a', fixed.NO_PRODUCT_WORDS)}))", "awards": f"(type = 'awards' AND large OR type = 'home') AND {has('a', fixed.AWARD_WORDS)}"}
    capped = " UNION ALL ".join(f"SELECT entity_name, '{c}' AS class, src, min(n) AS n FROM (SELECT entity_name, src, row_number() OVER (PARTITION BY entity_name ORDER BY type = 'home', page, pos) AS n FROM j WHERE {cond}) WHERE n <= {fixed.MEDIA_CAPS[c]} GROUP BY 1, 3" for c, cond in classes.items())
    ok = "src IN (SELECT url FROM checked)" if checked else "true"
    listed = lambda c: f"coalesce(list(src ORDER BY n) FILTER (class = '{c}' AND ok), [])"
    json = lambda c: f"'[' || array_to_string(list_transform({c}, lambda v: '\"' || v || '\"'), ',') || ']'"
    return f"""WITH b AS (SELECT page_id AS k, page_id AS entity_name, 'https://e' || page_id || '.org' AS base, 'https://e' || page_id || '.org/start/' AS url, html AS h FROM pages),
      homes AS (SELECT entity_name, k, base, url, CASE WHEN k % 17 <> 5 THEN CASE WHEN k % 3 = 0 THEN '<meta content=''/og.png'' property=''og:image''>' ELSE '' END || '<link rel="shortcut icon" href="/fav.ico">' || {of(_LINKS)} || CASE WHEN k % 4 <> 3 THEN {of(_HOME_IMAGES)} ELSE '' END || h END AS html FROM b),
      checked AS (SELECT url FROM (SELECT unnest([base || '/img/brand-dark.svg', base || '/p/logo.png', base || '/og.png', base || '/p/' || k || '-1.jpg', base || '/p/wide.jpg', 'https://cdn.org/award-' || k || '.png', base || '/fav.ico']) AS url FROM b) WHERE length(url) % 7 <> 1),
      paths AS (SELECT k, base, unnest(['/about', '/our-team/x', '/products/a', '/awards', '/platform/../platform', '/start/people', '/staff']) AS p, unnest([0, 1, 2, 3, 4, 5, 6]) AS i FROM b),
      snapshot AS (SELECT CASE WHEN p = '/products/a' THEN 'https://www.e' || k || '.org' ELSE base END || p AS url, repeat({of(_INNER_IMAGES)}, (k % 4)::INT) AS html FROM paths WHERE (k + i) % 5 <> 0),
      links AS (SELECT entity_name, url, regexp_extract_all(html, '(?i)<a\\s[^>]*href\\s*=\\s*["'']([^"''#][^"'']*)["'']', 1) AS l FROM homes WHERE html <> ''),
      each AS (SELECT entity_name, url, trim(l[n]) AS h, n FROM links, unnest(range(1, len(l) + 1)) t(n)),
      own AS (SELECT entity_name, u, min(n) AS n FROM (SELECT entity_name, url, n, {resolve('h')} AS u FROM each) WHERE u IS NOT NULL AND {domain('u')} = {domain('url')} GROUP BY 1, 2),
      kinds AS ({kinds}), wanted AS (SELECT * FROM (SELECT entity_name, type, u AS url, row_number() OVER (PARTITION BY entity_name ORDER BY o, n) AS page FROM kinds) WHERE page <= 7),
      all_pages AS (SELECT entity_name, 'home' AS type, 0 AS page, url, html FROM homes WHERE html <> '' UNION ALL SELECT entity_name, type, page, f.url, s.html FROM wanted f JOIN snapshot s ON f.url = s.url),
      tags AS (SELECT entity_name, type, page, url, regexp_extract_all(html, '(?i)<img[^>]*>') AS l FROM all_pages), t AS (SELECT entity_name, type, page, url, n AS pos, l[n] AS tag FROM tags, unnest(range(1, len(l) + 1)) x(n)),
      i0 AS (SELECT *, regexp_extract(tag, '(?i)src\\s*=\\s*["'']([^"'']+)["'']', 1) AS s, {attr('alt')} AS alt, {attr('class')} AS cls, {attr('id')} AS id, {num('width')} AS width FROM t),
      i1 AS (SELECT *, {resolve('s')} AS src FROM i0), i AS (SELECT *, src || ' ' || alt || ' ' || cls || ' ' || id AS a FROM i1 WHERE src IS NOT NULL),
      j AS (SELECT *, NOT (width BETWEEN 1 AND 39 OR {has('src', fixed.SPACER_WORDS)}) AS large, {has("alt || ' ' || cls || ' ' || id", fixed.PERSON_WORDS)} OR regexp_matches(alt, '^[A-Z][a-z]+ [A-Z][a-z]+') AS person, {score} - 3 * ({has('a', 'icon')} AND NOT {has('a', 'logo')})::INT + 2 * (width > 100)::INT - 3 * (width BETWEEN 1 AND 31)::INT AS score FROM i),
      logos AS (SELECT entity_name, 'logo' AS class, src, n FROM (SELECT entity_name, src, row_number() OVER (PARTITION BY entity_name ORDER BY k) AS n FROM (SELECT entity_name, src, min((-score, page, pos)) AS k FROM j WHERE {has('a', 'logo|brand')} OR type = 'home' AND {has('a', fixed.LOGO_WORDS)} GROUP BY 1, 2)) WHERE n <= 5),
      extra AS (SELECT entity_name, 'og' AS class, base || '/og.png' AS src, 1 AS n FROM homes WHERE html <> '' AND k % 3 = 0 UNION ALL SELECT entity_name, 'icon', base || '/fav.ico', 1 FROM homes WHERE html <> ''),
      kept AS (SELECT *, {ok} AS ok FROM ({capped} UNION ALL SELECT * FROM logos UNION ALL SELECT * FROM extra)),
      g AS (SELECT entity_name, {listed('logo')} AS logos, {listed('team')} AS team, {listed('products')} AS products, {listed('awards')} AS awards, {listed('og')} AS og, {listed('icon')} AS icon, count(*) FILTER (class = 'logo') AS every FROM kept GROUP BY 1),
      f AS (SELECT entity_name, count(*) AS n, array_to_string(list({path('url')} ORDER BY page) FILTER (type = 'team'), ', ') AS team_pages, array_to_string(list({path('url')} ORDER BY page) FILTER (type = 'products'), ', ') AS product_pages FROM wanted GROUP BY 1),
      r AS (SELECT h.entity_name, h.url, coalesce(h.html, '') <> '' AS there, coalesce(logos, []) AS logos, coalesce(g.team, []) AS team, coalesce(g.products, []) AS products, coalesce(g.awards, []) AS awards, coalesce(og, [])[1] AS og, CASE WHEN every > 0 THEN logos[1] ELSE icon[1] END AS logo, coalesce(f.n, 0) AS n, team_pages, product_pages FROM homes h LEFT JOIN g USING (entity_name) LEFT JOIN f USING (entity_name))
      SELECT entity_name, coalesce(logo, '') AS logo_url, coalesce(og, '') AS og_image_url, len(team)::INT AS team_photo_count, len(products)::INT AS screenshot_count, len(awards)::INT AS award_count, {json('team')} AS team_photos_json, {json('products')} AS screenshots_json, {json('awards')} AS awards_json, {json('logos')} AS all_logos_json,
        CASE WHEN there THEN concat_ws(chr(10), 'Fetched ' || n + 1 || ' pages from ' || {domain('url')}, 'Logo: ' || logo, 'OG Image: ' || og, CASE WHEN len(team) > 0 THEN 'Team photos: ' || len(team) END, CASE WHEN len(products) > 0 THEN 'Product screenshots: ' || len(products) END, CASE WHEN len(awards) > 0 THEN 'Award images: ' || len(awards) END, CASE WHEN len(logos) > 0 THEN 'Logo variants: ' || len(logos) END, 'Team pages found: ' || team_pages, 'Product pages found: ' || product_pages) ELSE 'No homepage URL available' END AS media_summary,
        CASE WHEN logo IS NOT NULL THEN 'ok' WHEN og IS NOT NULL OR len(team) + len(products) + len(awards) > 0 THEN 'partial' ELSE 'no_media' END AS status FROM r"""


#: Profiles, numbered within their session; `last` is where a session stops asking the first service.
_SCRAPED = """c AS (SELECT *, c_custkey AS k, c_acctbal < 5000 AS bad, row_number() OVER w AS i, count_if(c_acctbal < 5000) OVER (w ROWS 2 PRECEDING) AS run3 FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_custkey)),
      a AS (SELECT *, coalesce(min(CASE WHEN run3 = 3 THEN i END) OVER (PARTITION BY c_nationkey), 1000000000) AS last FROM c),
      b AS (SELECT *, CASE WHEN NOT bad AND i <= last THEN 'voyager' WHEN k % 9 <> 4 AND k % 8 <> 1 AND k % 4 < 2 THEN 'scrapelinkedin' ELSE 'none' END AS m FROM a)"""
_FULL_SCORE = "(CASE WHEN k % 2 = 0 THEN 10 ELSE 0 END + CASE WHEN k % 100 > 50 THEN 15 ELSE 0 END + 20 + CASE WHEN k % 40 > 20 THEN 10 ELSE 0 END + 15 + CASE WHEN k % 4 <> 0 THEN 5 ELSE 0 END + CASE WHEN k % 7 = 0 THEN 5 ELSE 0 END)"
_API_ERROR = "CASE WHEN k % 9 = 4 THEN 'All methods failed: no answer' ELSE 'All methods failed: ScrapeLinkedIn API error: HTTP ' || CASE WHEN k % 8 = 1 THEN 500 ELSE 200 END || ' ' || chr(8212) || ' ' || CASE k % 4 WHEN 2 THEN 'no such profile' WHEN 3 THEN 'slow down' ELSE 'Unknown error' END END"


def _by_method(full: str, data: str, bare: str, none: str = "NULL") -> str:
    return f"CASE WHEN m = 'voyager' THEN {full} WHEN m = 'none' THEN {none} WHEN k % 4 = 0 THEN {data} ELSE {bare} END"


ORACLES = {
    "profile_fallback": f"""WITH {_SCRAPED}, x AS (SELECT *, chr(10) AS nl, ' ' || chr(8212) || ' ' AS dash, {_by_method(_FULL_SCORE, '35', '60', '0')} AS score FROM b)
      SELECT k AS id, c_name AS entity_name, 'https://x.org/in/' || k AS url, m AS scrape_method, CASE WHEN m = 'none' THEN {_API_ERROR} END AS error, {_by_method('c_name', "'N' || k", "'F' || k", 'c_name')} AS full_name,
        {_by_method("CASE WHEN k % 2 = 0 THEN c_mktsegment ELSE '' END", "'T'", "'H'")} AS headline, {_by_method("CASE WHEN k % 4 <> 0 THEN 'Malta' ELSE '' END", "''", "'L'")} AS location, {_by_method("repeat('s', (k % 100)::INT)", "'A'", "'a summary that is a little longer than fifty characters'")} AS summary,
        {_by_method('1', '2', '0')} AS experience_count, {_by_method('1', '0', '1')} AS education_count, {_by_method('0', '0', '2')} AS skills_count, score AS completeness_score,
        {_by_method("concat_ws(nl, 'Head @ Firm', 'Mar 2001' || dash || 'Present', CASE WHEN k % 3 = 0 THEN 'Rome' END, CASE WHEN k % 40 > 0 THEN nl || repeat('d', (k % 40)::INT) END)", "concat_ws(nl, 'P @ C', '2001' || dash || 'Jan 2003', '', '---', '', 'Q', '2020' || dash || 'Present')", "''")} AS experience_text,
        {_by_method("concat_ws(nl, 'School', CASE WHEN k % 2 = 1 OR k % 5 = 0 THEN concat_ws(', ', CASE WHEN k % 5 = 0 THEN 'BA' END, CASE WHEN k % 2 = 1 THEN 'Art' END) END)", "''", "concat_ws(nl, 'I', 'MA, F', '1999', '', 'E')")} AS education_text,
        {_by_method("''", "''", "'a, b'")} AS skills_text, {_by_method("''", "''", "'x'")} AS languages_text, {_by_method("''", "'X, '", "''")} AS certifications_text, {_by_method("CASE WHEN k % 7 = 0 THEN concat_ws(nl, 'Guide', CASE WHEN k % 2 = 0 THEN '@ Club' END) ELSE '' END", "''", "''")} AS volunteer_text,
        CASE WHEN m = 'none' THEN 'error' WHEN score < 50 THEN 'incomplete' ELSE 'success' END AS status FROM x""",
    "profile_no_fallback": f"""WITH {_SCRAPED}, x AS (SELECT k, m = 'voyager' AS got, {_FULL_SCORE} AS score FROM b)
      SELECT k AS id, CASE WHEN got THEN 'voyager' ELSE 'none' END AS scrape_method, CASE WHEN NOT got THEN 'error' WHEN score < 50 THEN 'incomplete' ELSE 'success' END AS status, CASE WHEN NOT got THEN 'Voyager failed, fallback disabled' END AS error, CASE WHEN got THEN score ELSE 0 END AS completeness_score FROM x""",
    "profile_scrape_summary": f"""WITH {_SCRAPED}, x AS (SELECT m, {_by_method(_FULL_SCORE, '35', '60')} AS score FROM b)
      SELECT count(*) AS total, count(*) FILTER (m = 'voyager') AS first_service, count(*) FILTER (m = 'scrapelinkedin') AS second_service, count(*) FILTER (m = 'none') AS failed, count(*) FILTER (score < 50) AS incomplete, round(count(*) FILTER (m = 'scrapelinkedin') * 0.01::DOUBLE, 2) AS cost_usd FROM x""",
    "article_requests": """WITH c AS (SELECT conv_id AS k, chr(10) AS nl, turn, turn <> 3 AND text <> '' AS source, '--- Page: ' || CASE WHEN turn > 0 AND role <> '' THEN role ELSE 'Untitled' END || ' (' || CASE WHEN turn % 3 <> 2 THEN 'u' || turn ELSE 'unknown' END || ') ---' || chr(10) || text AS page FROM conversations),
      g AS (SELECT k, any_value(nl) AS nl, count(*) FILTER (source) AS source_pages, coalesce(string_agg(page, chr(10) || chr(10) ORDER BY turn) FILTER (source), '') AS pages FROM c GROUP BY 1),
      p AS (SELECT *, k % 5 <> 0 AS analyzed, k % 7 <> 0 AS planned, CASE WHEN k % 14 = 1 THEN '{"last":1}' WHEN k % 3 = 0 THEN '{"meta":{"title":"Plan ' || k || '"}}' ELSE '{}' END AS plan FROM g)
      SELECT k::VARCHAR AS entity_name, CASE WHEN analyzed AND planned THEN 'Write well: === COMPANY ANALYSIS ===' || nl || '{"a": ' || k || '}' || nl || nl || '=== SEO CONTENT PLAN ===' || nl || plan || nl || nl || '=== SOURCE CONTENT (scraped pages) ===' || nl || CASE WHEN length(pages) > 300 THEN left(pages, 300) || nl || nl || '[Source content truncated at 300 characters]' ELSE pages END END AS prompt,
        CASE WHEN NOT (analyzed AND planned) THEN '' WHEN starts_with(plan, '{"meta') THEN 'Plan ' || k WHEN k % 4 = 0 AND k % 14 <> 1 THEN 'Title ' || k ELSE k::VARCHAR END AS meta_title, source_pages,
        CASE WHEN analyzed AND planned THEN '' ELSE 'Missing upstream output: ' || concat_ws(', ', CASE WHEN NOT analyzed THEN 'content-analyzer' END, CASE WHEN NOT planned THEN 'seo-planner' END) || '. Run these submodules first.' END AS error FROM p""",
    "seo_plan_texts": """WITH x AS (SELECT *, p_partkey AS k, chr(10) AS nl, string_split(p_name, ' ') AS w FROM part),
      f AS (SELECT *, 'Q1: Why?' || nl || 'Direction: ' || CASE WHEN k % 2 = 0 THEN 'brief' ELSE 'answer' END || CASE WHEN k % 5 = 0 THEN nl || 'Keyword: kw' ELSE '' END AS q FROM x)
      SELECT k::VARCHAR AS entity_name, w[1] AS primary_keyword, CASE k % 4 WHEN 0 THEN '2 categories, 2 tags, ' || len(list_distinct(w || ['a', 'b', 'c', p_brand])) || ' unique keywords' WHEN 1 THEN '0 categories, 1 tags, 1 unique keywords' WHEN 2 THEN array_to_string(list_transform(range(4), lambda i: 'S' || i || ' ' || p_name || CASE WHEN i % 2 = 1 THEN ' [intro]' ELSE '' END), ', ') || ' (+2)' ELSE '' END AS keyword_plan_preview,
        CASE WHEN k % 3 <> 0 THEN p_name ELSE '' END AS meta_title, CASE WHEN k % 7 <> 0 THEN 2 ELSE 0 END AS faq_count, 'Primary: ' || w[1] || CASE WHEN len(w) > 1 THEN nl || 'Secondary: ' || array_to_string(w[2:], ', ') ELSE '' END AS keywords_text,
        CASE k % 4 WHEN 0 THEN concat_ws(nl, 'Overview:', '  Headline: ' || array_to_string(w, ', '), '  Body: a, b', '', 'Categories:', '  ' || lower(p_type) || ' (primary):', '    Heading: ' || array_to_string(w, ', '), '    Body: c', '  other (?):', '', 'Tags:', '  t: ' || p_brand, '', 'Credentials: iso', '', 'FAQ: why, how') WHEN 1 THEN concat_ws(nl, '', 'Tags:', '  t: x, x')
          WHEN 2 THEN array_to_string(list_transform(range(6), lambda i: 'S' || i || ' ' || p_name || CASE WHEN i % 2 = 1 THEN ' [intro]' ELSE '' END || ' (' || CASE WHEN i = 0 THEN '?' ELSE (100 * i)::VARCHAR END || ' words)' || CASE WHEN i = 1 THEN ' ' || chr(8212) || ' kw: kw' WHEN i = 2 THEN nl || '  ' || chr(9492) || ' sub (50 words)' ELSE '' END), chr(10)) ELSE '' END AS keyword_distribution_text,
        'Title: ' || CASE WHEN k % 3 <> 0 THEN p_name || ' (' || length(p_name) ELSE 'Not generated (0' END || ' chars)' || nl || 'Description: What it is (' || CASE WHEN k % 2 = 0 THEN 7 ELSE 10 END || ' chars)' AS meta_text, CASE WHEN k % 7 <> 0 THEN q || nl || nl || 'Q2' || substr(q, 3) ELSE 'No FAQs generated' END AS faqs_text, CASE WHEN k % 2 = 1 THEN 'calm' ELSE '' END AS tone_notes FROM f""",
    "discover_feeds": """WITH c AS (SELECT c_name AS entity_name, c_custkey AS k, 'https://c' || c_custkey || '.org' AS base FROM customer WHERE c_custkey % 11 <> 0),
      body AS (SELECT base || '/feed' AS url, 'atom' AS feed_type, NULL AS title, 1 AS item_count FROM c WHERE k % 5 <> 0 UNION ALL SELECT base || '/rss', 'rss', 'Own', k % 4 FROM c WHERE k % 4 <> 0 UNION ALL SELECT base || '/feed.xml', 'rss', 'Own', k % 4 FROM c UNION ALL SELECT base || '/named', 'rdf', NULL, 2 FROM c WHERE k % 4 <> 0),
      named AS (SELECT entity_name, base || '/named' AS url, 0 AS o, 'rss' AS kind, 'Named' AS name FROM c WHERE k % 7 <> 0 AND k % 2 = 0 UNION ALL SELECT entity_name, base || '/feed.xml', 1, 'atom', NULL FROM c WHERE k % 7 <> 0 AND k % 3 = 0),
      probed AS (SELECT entity_name, base || p AS url, 2 + i AS o, NULL AS kind, NULL AS name FROM c, (VALUES (0, '/feed'), (1, '/rss'), (2, '/feed.xml'), (3, '/rss.xml'), (4, '/atom.xml'), (5, '/blog/feed'), (6, '/news/feed'), (7, '/feed/rss'), (8, '/feed/atom')) t(i, p) WHERE base || p IN (SELECT url FROM body) AND (entity_name, base || p) NOT IN (SELECT (entity_name, url) FROM named)),
      f AS (SELECT * FROM named UNION ALL SELECT * FROM probed)
      SELECT entity_name, f.url, coalesce(feed_type, kind, 'unknown') AS feed_type, coalesce(name, title) AS title, coalesce(item_count, 0)::INT AS item_count FROM f LEFT JOIN body USING (url) QUALIFY row_number() OVER (PARTITION BY entity_name ORDER BY o) <= 3""",
    "company_media_of_pages": _media_sql(checked=False),
    "company_media_checked": _media_sql(checked=True),
    "resolve_dot_segments": f"""WITH h AS (SELECT page_id, url || CASE WHEN page_id % 3 = 0 THEN '/one/two.html?q=/a/b' ELSE '' END AS base, {_HREFS}[page_id % {len(_HREFS)} + 1] AS href FROM pages),
      b AS (SELECT *, regexp_extract(base, '^([a-zA-Z]+://[^/?#]+)', 1) AS site, regexp_replace(base, '[?#].*$', '') AS bare FROM h),
      f AS (SELECT *, CASE WHEN starts_with(href, '/') THEN href ELSE regexp_extract(CASE WHEN bare = site THEN '/' ELSE substr(bare, length(site) + 1) END, '^(.*/)', 1) || href END AS whole FROM b),
      q AS (SELECT *, regexp_extract(whole, '^([^?]*)', 1) AS path, regexp_extract(whole, '([?].*)$', 1) AS query FROM f),
      s AS (SELECT *, string_split(substr(path, 2), '/') AS seg FROM q),
      r AS (SELECT *, list_reduce([[]::VARCHAR[]] || list_transform(seg, lambda x: [x]), lambda a, x: CASE WHEN x = ['..'] THEN a[1 : len(a) - 1] WHEN x = ['.'] THEN a ELSE a || x END) AS kept FROM s)
      SELECT page_id, site || CASE WHEN len(list_filter(seg, lambda x: x IN ('.', '..'))) = 0 THEN path ELSE '/' || array_to_string(CASE WHEN seg[-1] IN ('.', '..') THEN kept || [''] ELSE kept END, '/') END || query AS url FROM r""",
    "application_documents": f"""WITH {_CONFIGS}, g AS (SELECT * FROM c WHERE k % 7 <> 0)
      SELECT 'RESPONSE_' || slug || '.json' AS name, s_name || ' & Co.' AS text FROM g
      UNION ALL SELECT 'CV_' || slug || '_tailored.docx', concat_ws(chr(10), 'Summary', '', 'Summary of ' || s_name, 'Highlights', '', '  - one', '  - two', 'Experience', '', 'CMO, firm', 'Intro', '  - did') FROM g
      UNION ALL SELECT 'SUGGESTIONS_' || slug || '.docx', array_to_string(['CV Analysis & Suggestions - ' || s_name || ' & Co.', 'Generated 2026-01-31. Review each suggestion and approve/reject.']
        || CASE WHEN k % 5 <> 0 THEN ['5-Layer Job Ad Analysis', '', 'Layer 1: Explicit Requirements', {_TIMES}, {_TIMES}, 'Layer 2: Preferred Qualifications', '  - A & B', 'Layer 3: Industry Language & Keywords', '  x, <y>', 'Layer 4: Operational Context']
          || CASE WHEN k % 2 = 0 THEN ['Team: 8'] ELSE [] END || ['Reports to: CEO', 'Location: Malta', 'Layer 5: Culture Signals', '  - fast'] ELSE [] END
        || ['Content Gaps', '', '1. Gap [low]', 'Closest existing content: near'] || CASE WHEN k % 2 = 0 THEN ['Question for the applicant: Why?'] ELSE [] END
        || CASE WHEN k % 3 <> 0 THEN ['Job Bullet Suggestions', '', '1. [edit]' || CASE WHEN k % 2 = 1 THEN ' (firm)' ELSE '' END, 'CURRENT: old', 'SUGGESTED: new ' || s_name, 'ADDRESSES: need'] ELSE [] END, chr(10)) FROM g""",
    "application_summary": f"""WITH {_CONFIGS} SELECT s_name AS entity_name, CASE WHEN k % 7 <> 0 THEN 'CV_' || slug || '_tailored.docx' END AS cv_filename, CASE WHEN k % 7 <> 0 THEN 'SUGGESTIONS_' || slug || '.docx' END AS suggestions_filename, CASE WHEN k % 7 <> 0 THEN 'RESPONSE_' || slug || '.json' END AS response_filename,
      CASE WHEN k % 7 <> 0 THEN 'cmo' END AS variant, CASE WHEN k % 7 <> 0 THEN (k % 10) / 10 END AS fit_score, CASE WHEN k % 7 <> 0 THEN 'success' ELSE 'error' END AS status, CASE WHEN k % 7 = 0 THEN 'No analysis data from job-analyzer' END AS error FROM c""",
    "response_source": """WITH a AS (SELECT url, min(html) AS body FROM pages WHERE starts_with(url, 'http') GROUP BY 1), w AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN url || '/gone' ELSE url END AS url FROM pages)
      SELECT page_id, CASE WHEN body IS NOT NULL THEN 200 END AS http_status, length(body)::INT AS n_chars, CASE WHEN body IS NULL THEN 'no answer' END AS error FROM w LEFT JOIN a USING (url)""",
    "response_source_by_host": "SELECT url, length(html)::INT AS n_chars FROM pages WHERE starts_with(url, 'https://th')",
    "cv_files": """WITH n AS (SELECT n_name || '.md' AS name, n_name, n_nationkey % 4 AS k, n_name = min(n_name) OVER () AS first FROM nation),
      p AS (SELECT *, k IN (0, 2) AS outside, k IN (1, 2) AS inside, (n_name || '.md') < 'C' AS turned FROM n)
      SELECT name, CASE WHEN outside AND NOT (turned AND inside) THEN name WHEN inside THEN 'cv/' || name END AS place, CASE WHEN outside AND NOT (turned AND inside) THEN 'outer ' || n_name WHEN inside THEN 'inner ' || n_name WHEN first THEN '{}' ELSE '' END AS content FROM p""",
    "keyword_documents": f"WITH k AS ({_WORDS_OF}), {_FOUND} SELECT * FROM f",
    "keyword_coverage": f"WITH k AS ({_WORDS_OF}), {_FOUND} SELECT keyword, count(doc_id) AS documents, coalesce(sum(n), 0)::BIGINT AS occurrences FROM k LEFT JOIN f USING (keyword) GROUP BY 1",
}

"""All queries of the library by name, and the SQL that each is checked against."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestream.functions import text as T
from lodestream.functions import urls as U
from lodestream.operators import bundle, content, generation, pages, profiles, qa, reports, urls
from lodestream.plans import inputs, more, oracles, page_oracles
from lodestream.plans.inputs import articles, documents, page_items, table, url_variants
from lodestream.sources import discovery
from lodestream.streaming import incremental

SEP = "\n"  # the test documents have no blank lines


def _heads(s, d):
    p = page_items(s, d)
    return p.select("url", F.element_at(F.array(*map(F.lit, (200, 301, 403, 404, 503, 200, 200))), (F.col("page_id") % 7 + 1).cast("int")).alias("http_status"), "html", "page_id")


def _liveness(s, d):
    h, k = _heads(s, d), F.col("page_id")
    status = F.when(k % 11 == 0, F.lit(None)).when(F.length("url") % 2 == 0, 200).otherwise(403).cast("int")
    body = F.concat(F.left("html", F.length("url") * 30), F.when(k % 5 == 0, "<title>Just a moment...</title>").otherwise(""))
    return urls.liveness(page_items(s, d).select("page_id", "url"), h.select("page_id", "http_status"), h.where(k % 13 != 0).select("page_id", status.alias("http_status"), body.alias("body")), by="page_id")


def _redirects(s, d):
    return page_items(s, d).select("url", F.when(F.col("page_id") % 3 == 0, F.regexp_replace("url", "^http:", "https:")).otherwise(F.col("url")).alias("final_url"))


def _description():
    return F.rpad(F.concat("p_name", F.lit(" - "), "p_type", F.lit(" ")), (F.col("p_partkey") % 60 + 120).cast("int"), "x")


def _meta(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    title = F.concat("p_name", F.lit(" by "), "p_brand", F.lit(" in many sizes"), F.when(k % 17 == 0, "\u2026").otherwise(""))
    return p.select(k.cast("string").alias("entity_name"), F.when(k % 19 != 0, title).alias("title"), F.when(k % 23 != 0, _description()).alias("description"), F.array(F.lit("no such term"), F.lower("p_name")).alias("head_terms"))


def _plan(k):
    """An SEO plan of a part, as JSON."""
    target = F.struct(F.get(F.split("p_name", " "), F.lit(0)).alias("primary"), F.split("p_type", " ").alias("secondary"), F.array(F.lit("long tail")).alias("long_tail"))
    meta = F.struct(F.concat(F.lit("About "), "p_name", F.lit(" and more of the kind")).alias("title"), _description().alias("description"))
    faqs = F.when(k % 3 == 0, F.array(F.struct(F.concat("p_name", F.lit("?")).alias("question"), F.lower("p_brand").alias("answer"))))
    return F.to_json(F.struct(meta.alias("meta"), target.alias("target_keywords"), faqs.alias("faqs")))


def _analysis_json(k):
    """An analysis of a part, as JSON; every second one has a secondary category alone."""
    slug = lambda x: F.struct(F.lower(x).alias("slug"), F.lit("fits").alias("why"))
    none = F.array().cast("array<struct<slug: string, why: string>>")
    facts = F.struct((k % 100 + 1900).alias("founded"), F.when(k % 4 == 0, "Malta").alias("headquarters"), F.array(F.struct(F.lit("Ann").alias("name"), F.lit("CEO").alias("role"))).alias("key_people"), F.array(F.lit("A1")).alias("licenses"))
    return F.to_json(F.struct(F.struct(F.when(k % 2 == 0, F.array(slug("p_brand"), slug("p_type"))).otherwise(none).alias("primary"), F.array(slug("p_type")).alias("secondary")).alias("categories"), F.struct(F.transform(F.split("p_name", " "), slug).alias("existing"), F.array(F.struct(F.lit("new").alias("label")), F.struct(F.lit("newer").alias("label"))).alias("suggested_new")).alias("tags"), facts.alias("key_facts"), F.array(F.struct(F.lit(1).alias("index"), F.lit("https://a.org/").alias("url"), F.lit("A").alias("title"))).alias("source_citations")))


def _bundles(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    return p.select(F.concat("p_name", F.lit(" "), k.cast("string")).alias("entity_name"), F.when(k % 5 != 0, F.concat(F.lit("# "), "p_name", F.lit("\n\nText."))).alias("markdown"), F.when(k % 7 != 0, _analysis_json(k)).alias("analysis"), F.when(k % 11 != 0, _plan(k)).alias("seo_plan"), F.when(k % 3 == 0, F.concat(F.lit("https://p"), k.cast("string"), F.lit(".org/"))).alias("url"), k.alias("k"))


def _keywords(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    ws = F.split("p_name", " ")
    md = F.concat(F.lit("---\ntitle: "), F.get(ws, F.lit(1)), F.lit("\n---\n# Top\n\n## "), F.get(ws, F.lit(0)), F.lit("\n\nIt is "), "p_name", F.lit(" and "), F.lower("p_type"), F.lit(" of "), F.lower("p_brand"), F.lit(" [#1].\nMade to last and sold in many shops.\n\n### Last"))
    used = F.struct(F.slice(ws, 1, 2).alias("head_terms"), F.split(F.lower("p_type"), " ").alias("mid_tail"), F.array(F.lower("p_brand"), F.lit("missing one")).alias("entities"), F.when(k % 4 == 0, F.array(F.lit("Shops"))).alias("negatives"))
    return qa.keyword_sufficiency(p.select(k.alias("id"), md.alias("markdown"), F.to_json(F.struct(used.alias("keywords_used"))).alias("plan")))


def _sections(s, d):
    a = articles(s, d).select("entity_name", F.concat(F.lit("---\ntitle: \"A\"\ndescription: 'b c'\n---\n# One\n\n"), "markdown").alias("m")).select("entity_name", T.markdown_sections(F.col("m")).alias("s"))
    return a.select("entity_name", *(F.array_join(f"s.{c}", "|").alias(c) for c in ("h1", "h2", "h3", "first_paragraphs")), "s.body", "s.title", "s.description", "s.word_count")


def _pool_meta(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    rows = p.select(k.cast("string").alias("entity_name"), k.alias("pool_pos"), F.when(k % 2 == 0, F.concat(F.lit("Own "), "p_name")).alias("meta_title"), F.lit(None).cast("string").alias("meta_description"), F.concat(F.when(k % 3 == 0, "---\ntitle: \"Front\"\n---\n").otherwise(""), F.when(k % 5 == 0, "# Head\n\n").otherwise(""), F.when(k % 7 == 0, "First line\nand second.\n\nMore.").otherwise("")).alias("content_markdown"), F.lit(None).cast("string").alias("seo_plan"))
    plans = p.select(k.cast("string").alias("entity_name"), (k + 1_000_000_000).alias("pool_pos"), *(F.lit(None).cast("string").alias(c) for c in ("meta_title", "meta_description", "content_markdown")), _plan(k).alias("seo_plan"))
    return qa.resolve_meta(rows.union(plans)).withColumn("head_terms", F.array_join("head_terms", "|"))


def _sources(s, d):
    return generation.assemble_sources(documents(s, d), 5_000)


def _prompts(s, d):
    t = table(s, d, "conversations")
    pages = t.select(F.col("conv_id").cast("string").alias("entity_name"), F.col("turn").alias("pool_pos"), "role", F.concat(F.lit("u"), "turn").alias("url"), F.col("text").alias("text_content"), F.when(F.col("turn") > 0, F.col("role")).alias("title"), F.length("role").alias("word_count"))
    return generation.assemble_pages(pages, 400).select("entity_name", generation.build_prompt("Read {doc:rules} {doc:none}: {entity_content}", F.col("entity_content"), {"rules": "well"}).alias("prompt"), "word_count")


def _analyzed(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    answer = F.when(k % 9 == 0, "I can't.").otherwise(F.concat(F.lit("Here:\n```json\n"), _analysis_json(k), F.lit("\n```")))
    return generation.analyses(p.select((k - (k % 10 == 1).cast("int")).cast("string").alias("entity_name"), answer.alias("text"), F.lit(7).alias("word_count")), "p/m")


def _planned(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    answer = F.when(k % 9 == 0, "I can't.").otherwise(F.concat(F.lit("```json\n"), F.regexp_replace(_plan(k), "^\\{", '{"warnings": ["a", "b"], '), F.lit("\n```")))
    return generation.plans(p.select((k - (k % 10 == 1).cast("int")).cast("string").alias("entity_name"), answer.alias("text"))).drop("seo_plan_json")


def _written(s, d):
    a, k = articles(s, d), F.col("k")
    content = generation.writer_content(F.lit("{}"), F.lit("{}"), F.col("p_name"))
    return generation.written(a.select("entity_name", F.when(k % 4 != 0, F.concat("markdown", F.when(k % 5 == 0, content).otherwise(""))).alias("text"), F.when(k % 3 == 0, F.col("title")).alias("meta_title"), F.when(k % 8 == 0, "timed out").alias("error")))


def _zipped(s, d):
    c = generation.claims(articles(s, d), 2)
    k = F.element_at(F.split("entity_name", " "), -1).cast("int")
    answers = c.where("batch = 0").groupBy("entity_name", "batch").count().where(k % 3 != 0)
    text = F.when(k % 3 == 1, '```json\n[{"verdict": "supported", "severity": "low"}]\n```').otherwise('Verdicts: [{"verdict": "partial"}, {"verdict": "supported", "quote": "q"}]')
    return generation.zip_verdicts(c, answers.select("entity_name", "batch", text.alias("text")))


def _marked(s, d):
    """Articles with headings of each kind, a section that only begins like Meta, Meta in brackets, sources that are missing, and analyses."""
    a, k = articles(s, d), F.col("k")
    head = F.when(k % 3 == 0, "## [Primary Category: ").when(k % 3 == 1, "## [Tag: ").otherwise("## [See: ")
    md = F.replace("markdown", F.lit("## [Category: "), head)
    md = F.replace(md, F.lit("\n\n## Meta"), F.concat(F.lit("\n\n### Metallurgy\n\nOre."), F.when(k % 2 == 0, "\n\n## [Meta]").when(k % 5 == 0, "").otherwise("\n\n## Meta")))
    facts = F.struct((k % 100 + 1900).alias("founded"), F.array(F.lit("A1")).alias("licenses"), F.when(k % 8 == 0, "Malta").alias("headquarters"))
    slug = lambda x: F.array(F.struct(F.lower(F.replace(x, F.lit("#"), F.lit("-"))).alias("slug")))
    analysis = F.to_json(F.struct(F.struct(slug(F.col("p_brand")).alias("primary")).alias("categories"), F.struct(F.array(F.struct(F.lit("new one").alias("label"))).alias("suggested_new")).alias("tags"), facts.alias("key_facts")))
    return a.withColumn("markdown", md).withColumn("analysis", F.when(k % 4 != 0, analysis))


def _html_documents(s, d, wrap=False):
    return bundle.html_documents(_marked(s, d), css="<style>p { color: red }</style>" if wrap else "", wrap=wrap)


def _revisions(s, d):
    """Articles revised in one line, two or none; keywords inside other words, in headings and nowhere."""
    a, k = articles(s, d), F.col("k")
    answer = F.when(k % 3 == 0, F.replace("markdown", F.lit("Growth is steady"), F.lit("The growth is steady, as a salesperson says"))).when(k % 3 == 1, F.replace(F.replace("markdown", F.lit("- first"), F.lit("# people\n\n- at first")), F.lit("Title"), F.lit("Name"))).otherwise(F.col("markdown"))
    plan = F.to_json(F.struct(F.struct(F.lit("people").alias("primary"), F.array(F.lit("Growth"), F.lit("person")).alias("secondary")).alias("target_keywords"), F.struct(F.array(F.lit("point"), F.lit("people")).alias("head_terms"), F.when(k % 2 == 0, F.array(F.lit("no such"))).alias("long_tail")).alias("keywords_used")))
    return generation.revised(a.select("entity_name", F.col("markdown").alias("original"), F.concat(F.lit("```markdown\n"), answer, F.lit("\n```")).alias("answer"), generation.target_keywords(plan).alias("keywords")))


def _statuses(s, d):
    k = F.col("doc_id")
    return documents(s, d).withColumn("status", F.when(k % 50 == 0, "error").when(k % 9 == 0, "low_content").when(k % 31 == 0, "skipped").otherwise("success")).withColumn("word_count", T.word_count(F.col("text_content"))).withColumn("text_preview", T.preview(F.col("text_content")))


def _errors(s, d):
    return reports.error_rollup(documents(s, d).select("entity_name", "pool_pos", F.when(F.col("status") == "error", F.concat(F.lit("failed at "), "pool_pos")).alias("error")))


def _tiers(s, d):
    x, k = documents(s, d), F.col("doc_id")
    return reports.first_good(x.select("doc_id", "url"), [("http", x.where(k % 2 == 0).select("url", F.left("text_content", F.lit(400)).alias("text_content"))), ("browser", x.where(k % 3 == 0).select("url", F.left("text_content", F.lit(900)).alias("text_content"))), ("archive", x.where(k % 5 == 0).select("url", "text_content"))]).select("doc_id", "scrape_method", "word_count", "status")


def _verdicts(s, d):
    o = table(s, d, "orders")
    return qa.hallucination_score(o.select(F.col("o_custkey").cast("string").alias("entity_name"), F.when(F.col("o_orderstatus") == "F", "supported").when(F.col("o_orderstatus") == "P", "partial").otherwise("unsupported").alias("verdict")))


def _routes(s, d):
    c, k = table(s, d, "customer"), F.col("c_custkey")
    return qa.route(c.select(F.col("c_name").alias("entity_name"), F.when(k % 5 != 0, k % 3 != 0).alias("hallucination_ok"), F.when(k % 5 != 0, k % 4 != 0).alias("citation_ok"), F.when(k % 5 != 0, k % 7 != 0).alias("keyword_ok"), F.when(k % 5 != 0, k % 11 != 0).alias("meta_ok"), (k % 13).alias("source_count"), (k % 6).cast("int").alias("loop_count")))


def _seeds(s, d):
    e = table(s, d, "supplier").select(F.col("s_name").alias("entity_name"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit(".org/")).alias("website"), "s_suppkey")
    r = e.crossJoin(F.broadcast(discovery.seed_paths(s))).select(F.concat(F.lit("https://s"), F.col("s_suppkey").cast("string"), F.lit(".org"), "path").alias("url"), (F.length("path") + F.col("s_suppkey")).alias("n"))
    return discovery.seed_urls(e, r.select("url", F.when(F.col("n") % 2 == 0, "HEAD").otherwise("GET").alias("method"), F.when(F.col("n") % 3 == 0, 404).otherwise(200).alias("status_code")))


def _relevance(s, d):
    p = page_items(s, d).select("pool_pos", "url", "entity_name")
    n = p.withColumn("i", F.row_number().over(Window.partitionBy("entity_name").orderBy("pool_pos")) - 1)
    line = F.concat((F.col("i") % 20 + 1).cast("string"), F.lit(". "), F.element_at(F.array(*map(F.lit, ("KEEP", "drop", "maybe"))), (F.col("pool_pos") % 3 + 1).cast("int")))
    text = n.where("pool_pos % 4 != 0").groupBy("entity_name", F.floor(F.col("i") / 20).cast("int").alias("batch")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))
    return content.relevance(p, text, 20)


def _intents(s, d):
    docs = documents(s, d).withColumn("relevance", F.element_at(F.array(*map(F.lit, ("KEEP", "MAYBE", "DROP", ""))), (F.col("doc_id") % 4 + 1).cast("int")))
    n = docs.where("relevance in ('KEEP', '')").withColumn("i", F.row_number().over(Window.partitionBy("entity_name").orderBy("pool_pos")) - 1)
    kind = F.element_at(F.array(*map(F.lit, ("About Us", "news", "unheard of"))), (F.col("doc_id") % 3 + 1).cast("int"))
    answer = n.where("doc_id % 5 != 0").groupBy("entity_name", F.floor(F.col("i") / 10).cast("int").alias("batch")).agg(F.to_json(F.array_sort(F.collect_list(F.struct((F.col("i") % 10 + 1).alias("index"), kind.alias("intent"), ((F.col("doc_id") % 15) / 10).alias("confidence"))))).alias("text"))
    return content.tag_intents(docs, answer, ["about_us", "news"])


def _dom(s, d):
    return table(s, d, "pages")


def _images(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    stem = F.element_at(F.array(*map(F.lit, ("logo-", "pic-", "dark-logo-", "white-logo-", "icon-", "wide-", "favicon."))), (k % 7 + 1).cast("int"))
    src = F.concat(F.lit("/img/"), F.when(k % 7 == 6, "favicon.ico").otherwise(F.concat(stem, k.cast("string"), F.when(k % 2 == 0, ".svg").otherwise(".png"))))
    return bundle.company_media(p.select(F.col("p_brand").alias("entity_name"), k.alias("pos"), src.alias("src"), F.lower("p_name").alias("alt"), F.when(k % 5 == 0, "brand").otherwise("x").alias("cls"), F.when(k % 6 == 0, "Logo").alias("id"), (k % 500).cast("int").alias("width")))


def _claims(s, d):
    claims = table(s, d, "benchmark").select(F.col("item_id").alias("claim_id"), F.col("text").alias("claim"))
    return qa.verify_claims(claims, table(s, d, "documents").where("text is not null").select("text"))


def _profiles(s, d):
    c, k = table(s, d, "customer"), F.col("c_custkey")
    some = lambda n: F.when(k % n == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("x")))
    positions = F.when(k % 4 == 0, F.array().cast("array<struct<description: string>>")).otherwise(F.array(F.struct(F.lit("").alias("description")), F.struct(F.repeat("c_name", (k % 3).cast("int")).alias("description"))))
    return bundle.profile_completeness(c.select(k.alias("id"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("headline"), F.repeat("c_name", (k % 6).cast("int")).alias("summary"), positions.alias("positions"), some(3).alias("education"), some(7).alias("skills"), some(5).alias("languages"), F.when(k % 3 == 0, "").otherwise("Malta").alias("location"), some(2).alias("certifications"), F.when(k % 11 == 0, F.array(F.lit("x"))).alias("volunteer")))


def _breaker(s, d):
    e = table(s, d, "events").select("event_id", "user_id", (F.col("value") > 40).alias("ok"))
    return qa.circuit_breaker(e, "user_id", "event_id", "ok")


def _sitemaps(s, d):
    p = page_items(s, d)
    one = F.concat(F.lit("<url><loc>"), "url", F.lit("</loc><priority>"), (F.col("page_id") % 3 / 10).cast("string"), F.lit("</priority></url>"))
    x = p.groupBy("entity_name").agg(F.concat(F.lit("<urlset>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", one.alias("x")))), lambda r: r["x"]), "")).alias("xml"))
    return discovery.sitemap_urls(x, most=5)


def _tiered_pages(s, d):
    """Pages of three kinds: with an article, with two regions of a content system, and as they are."""
    k = F.col("page_id")
    words = F.repeat(F.lit("some words of text "), (k % 13).cast("int"))
    made = F.when(k % 3 == 0, F.concat(F.lit("<article><p>"), words, F.lit("</p></article>"))).when(k % 3 == 1, F.concat(F.lit('<div class="entry-content">'), words, F.lit('</div><div class="entry-content">more</div>'))).otherwise("")
    return table(s, d, "pages").select("page_id", F.concat(made, "html").alias("html"))


def _sitemap_index(s, d):
    p, k = table(s, d, "supplier"), F.col("s_suppkey")
    one = lambda n: F.concat(F.lit("<urlset><url><loc>https://s"), k.cast("string"), F.lit(f".org/{n}</loc></url></urlset>"))
    child = lambda n: F.concat(F.lit("https://s"), k.cast("string"), F.lit(f".org/{n}.xml"))
    index = F.concat(F.lit("<sitemapindex><sitemap><loc> "), child("a"), F.lit("</loc></sitemap><sitemap><loc>"), child("b"), F.lit("</loc></sitemap></sitemapindex>"))
    roots = p.select(F.col("s_name").alias("entity_name"), F.when(k % 2 == 0, index).otherwise(one("own")).alias("xml"))
    answers = p.select(child("a").alias("url"), one("a1").alias("xml")).union(p.where(k % 3 == 0).select(child("b"), one("b1")))
    return discovery.sitemap_urls(discovery.sitemap_pages(roots, answers)).select("entity_name", "url")


def _feed_links(s, d):
    k = F.col("page_id")
    link = F.concat(F.lit("<link rel='alternate' title='T"), k.cast("string"), F.lit("' type='application/"), F.when(k % 3 == 0, "atom+xml").when(k % 3 == 1, "rss+xml").otherwise("json"), F.lit("' href='"), F.when(k % 2 == 0, "/feed").otherwise("feed.xml"), F.lit("'>"))
    return discovery.feed_links(table(s, d, "pages").select("page_id", "url", F.concat(link, "html").alias("html")))


def _archive(s, d):
    k = F.col("page_id")
    url = F.concat(F.lit("https://web.archive.org/web/2020id_/"), "url")
    body = F.when(k % 5 == 0, "Sorry. The Wayback Machine has not archived that URL.").otherwise("text")
    return discovery.archived(page_items(s, d).select(F.when(k % 2 == 0, url).otherwise(F.col("url")).alias("url"), F.when(k % 7 == 0, 404).otherwise(200).alias("http_status"), body.alias("body")))


def _crawl(s, d):
    n, k = table(s, d, "nation"), F.col("n_nationkey").cast("string")
    base = F.concat(F.lit("https://n"), k, F.lit(".org"))
    home = F.concat(F.lit("<a href='/news/1'>N</a><a href='/other'>O</a><a href='https://else.org/news'>E</a><a href='/about'>A</a><a href='/news/1'>again</a>"))
    homes = n.select(F.col("n_name").alias("entity_name"), F.concat(base, F.lit("/")).alias("url"), home.alias("html"))
    inner = n.select(F.concat(base, F.lit("/about")).alias("url"), F.lit("<a href='/team'>T</a><a href='/other'>O2</a>").alias("html"))
    return pages.crawl(homes, inner)


def _profile_json(s, d):
    c, k = table(s, d, "customer"), F.col("c_custkey")
    span = lambda y, m: F.struct(F.struct(m.cast("int").alias("month"), y.cast("int").alias("year")).alias("start"), F.lit(None).cast("struct<month: int, year: int>").alias("end"))
    job = lambda t, y, m: F.struct(F.lit(t).alias("title"), span(y, m).alias("dateRange"))
    group = F.struct(F.lit("Firm").alias("name"), F.struct(F.array(job("first", k % 5 + 2000, k % 13), job("second", F.lit(2002), F.lit(3)))).alias("g"))
    group = F.struct(group["name"].alias("name"), F.struct(group["g"]["col1"].alias("elements")).alias("profilePositionInPositionGroup"))
    p = F.struct(F.col("c_name").alias("firstName"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("headline"), F.struct(F.array(group).alias("elements")).alias("profilePositionGroups"), F.struct(F.array(F.struct(F.lit("SQL").alias("name")), F.struct(F.lit("").alias("name"))).alias("elements")).alias("profileSkills"))
    out = profiles.parse(c.select(k.alias("id"), F.to_json(F.struct(F.array(p).alias("elements"))).alias("body")))
    return out.select("id", "full_name", "headline", F.array_join(F.transform("positions", lambda x: F.concat_ws("/", x["title"], x["company"], x["start"])), "|").alias("positions"), F.size("education").alias("n_education"), F.array_join("skills", "|").alias("skills"))


def _jobs(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    answer = F.concat(F.lit('{"base_variant": "'), F.when(k % 2 == 0, "cmo").otherwise("pilot"), F.lit('", "note": "a\u2014b"'), F.when(k % 3 != 0, F.concat(F.lit(', "company_name": "'), "p_name", F.lit(' & Co."'))).otherwise(""), F.lit("}"))
    made = profiles.job_configs(p.select(k.cast("string").alias("entity_name"), answer.alias("text")))
    return made.join(profiles.application_files(made).select("path", F.col("content").alias("config")).distinct(), "config", "left").select("entity_name", "company_name", "base_variant", "error", "path").distinct()


def _waits(s, d):
    e = table(s, d, "events").select("event_id", "event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts"))
    return reports.rate_limited(e, "event_type", "ts", "event_id", 7).select("event_id", "sent_ms", "wait_ms")


def _credits(s, d):
    e = table(s, d, "events")
    return reports.credits(e.select(F.col("event_type").alias("entity_name"), (F.col("value") > 40).alias("ok"), (F.col("event_id") % 7).alias("credits")))


def _feeds(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    body = F.concat(F.lit('<?xml version="1.0"?><'), F.when(k % 3 == 0, "feed").when(k % 3 == 1, "rss").otherwise("html"), F.lit("><title> "), "p_name", F.lit(" </title>"), F.repeat(F.lit("<item >a</item>"), (k % 4).cast("int")))
    return discovery.feeds(p.select(k.cast("string").alias("url"), body.alias("body")))


def _analysis(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    return bundle.analysis_flat(p.select(k.cast("string").alias("entity_name"), _analysis_json(k).alias("analysis")))


def _plans(s, d):
    p, k = table(s, d, "part"), F.col("p_partkey")
    return bundle.seo_plan_flat(p.select(k.cast("string").alias("entity_name"), _plan(k).alias("plan")))


def _described(s, d):
    k = F.col("page_id")
    text = F.concat(F.lit("A &amp; b "), k.cast("string"))
    by_name = F.concat(F.lit('<meta name="description" content="'), text, F.lit('">'))
    by_content = F.concat(F.lit("<meta content='"), text, F.lit("' data-x=1 name='description'>"))
    html = F.concat(F.when(k % 3 == 0, by_name).when(k % 3 == 1, by_content).otherwise(""), "html")
    return table(s, d, "pages").select("page_id", pages.meta(html, "name", "description").alias("meta_description"))


def _known(s, d):
    p = page_items(s, d)
    return urls.exclude_known(p.select("url"), p.where("page_id % 3 = 0"))


def queries() -> dict:
    q = {
        "url_normalize": lambda s, d: table(s, d, "pages").select("page_id", "url", U.normalize(F.col("url")).alias("norm_url")),
        "url_dedup": lambda s, d: urls.dedup(url_variants(s, d)),
        "url_canonicalize": lambda s, d: urls.canonicalize(url_variants(s, d), _redirects(s, d)),
        "url_filter": lambda s, d: urls.filter_patterns(page_items(s, d), [r"\?page=", "blog"], ["example"]),
        "url_liveness": _liveness,
        "url_domain": lambda s, d: table(s, d, "pages").select("page_id", U.domain(F.col("url")).alias("domain")),
        "resolve_url": lambda s, d: table(s, d, "pages").select("page_id", U.resolve(F.col("url"), F.lit("/a?utm_source=x&page=2&Ref=1#f")).alias("rooted"), U.resolve(F.col("url"), F.lit("//cdn.org/x")).alias("schemeless"), U.strip_tracking(F.col("url")).alias("cleaned")),
        "exclude_known_urls": _known,
        "page_links": lambda s, d: pages.page_links(table(s, d, "pages"), most=None, body=True),
        "deep_links": lambda s, d: pages.deep_links(page_items(s, d), ["/en/"], max_pages=None, per_page=None),
        "extract_title": lambda s, d: _dom(s, d).select("page_id", pages.title(F.col("html")).alias("title")),
        "extract_meta_description": _described,
        "extract_text": lambda s, d: pages.page_items(_dom(s, d), longest=None).select("page_id", "word_count", "status", "text_preview", "text_content"),
        "sitemap_parser": _sitemaps,
        "rss_feeds": _feeds,
        "seed_url_builder": _seeds,
        "api_search": lambda s, d: discovery.api_items(table(s, d, "events").select("event_id", F.col("event_type").alias("source"), F.concat(F.lit('{"job": '), "props", F.lit(', "title": "'), "event_type", F.lit(' at work"}')).alias("body")), {"externalId": ["$.id", "$.job.k"], "title": ["$.name", "$.title"]}, ["click", "view"], ["view"], ("title",)).select("event_id", "source", "externalId", "title"),
        "test_dummy": lambda s, d: discovery.synthetic_items(table(s, d, "supplier").select(F.col("s_name").alias("entity_name")), 3, "7"),
        "word_count": lambda s, d: table(s, d, "documents").select("doc_id", T.word_count(F.col("text")).alias("word_count")),
        "english_detector": lambda s, d: table(s, d, "documents").select("doc_id", T.is_english(F.col("text")).alias("is_english")),
        "content_filter": lambda s, d: content.content_filter(documents(s, d)),
        "duplicate_text_demotion": lambda s, d: content.demote_duplicates(documents(s, d)),
        "duplicate_text_demotion_by_entity": lambda s, d: content.demote_duplicates(documents(s, d), 2, "entity_name"),
        "split_blocks": lambda s, d: content.blocks(documents(s, d), SEP).select("doc_id", "pos", "block"),
        "boilerplate_frequency": lambda s, d: content.boilerplate_frequency(documents(s, d), SEP, 0.1),
        "boilerplate_strip": lambda s, d: content.boilerplate_strip(documents(s, d), SEP, 0.1),
        "split_sentences": lambda s, d: table(s, d, "documents").select("doc_id", F.posexplode_outer(T.split_sentences(F.col("text"))).alias("pos", "sentence")).where("pos is not null"),
        "count_occurrences": lambda s, d: table(s, d, "documents").select("doc_id", T.count_occurrences(F.col("text"), F.lit("the")).alias("n")),
        "citation_join": lambda s, d: qa.broken_citations(articles(s, d)),
        "citation_coverage": lambda s, d: qa.citation_coverage(articles(s, d)),
        "keyword_sufficiency": _keywords,
        "meta_compliance": lambda s, d: qa.meta_compliance(_meta(s, d)),
        "hallucination_score": _verdicts,
        "hallucination_detector": _claims,
        "route_decision": _routes,
        "circuit_breaker": _breaker,
        "url_relevance": _relevance,
        "intent_tagger": _intents,
        "content_analysis_flatten": _analysis,
        "profile_completeness": _profiles,
        "seo_plan_flatten": _plans,
        "markdown_sections": _sections,
        "meta_resolution": _pool_meta,
        "source_assembly": _sources,
        "prompt_build": _prompts,
        "content_analyzer": _analyzed,
        "seo_planner": _planned,
        "content_writer": _written,
        "claim_verdicts": _zipped,
        "tone_editor": _revisions,
        "rescrape_partition": lambda s, d: reports.rescrape(_statuses(s, d)).select("doc_id", F.col("again").alias("by_browser"), reports.needs_rescrape(_statuses(s, d), known_only=True).alias("by_api")),
        "tier_fallback": _tiers,
        "entity_summary": lambda s, d: reports.entity_summary(_statuses(s, d)),
        "run_summary": lambda s, d: reports.run_summary(reports.entity_summary(_statuses(s, d))),
        "error_rollup": _errors,
        "status_sort": lambda s, d: reports.by_status(_statuses(s, d).select("doc_id", "status"), "doc_id"),
        "sitemap_index": _sitemap_index,
        "feed_discovery": _feed_links,
        "archive_scan": _archive,
        "browser_crawler": _crawl,
        "profile_source": _profile_json,
        "job_analyzer": _jobs,
        "rate_limiter": _waits,
        "credits": _credits,
        "api_requests": lambda s, d: discovery.api_requests(table(s, d, "supplier").select(F.col("s_name").alias("entity_name")), [("a", "search"), ("b", "feed")], ["CMO", "CEO"]),
        "profile_slug": lambda s, d: table(s, d, "part").select("p_partkey", U.profile_slug(F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("https://x.org/in/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/?a=1"))).when(F.col("p_partkey") % 3 == 1, F.replace("p_name", F.lit(" "), F.lit("-"))).otherwise(F.col("p_name"))).alias("slug")),
        "extraction_method_counts": lambda s, d: content.histogram(_tiers(s, d).withColumn("scrape_method", F.coalesce("scrape_method", F.lit("none"))), "scrape_method", ["status"]).select("status", F.to_json("counts").alias("counts")),
        "extraction_tiers": lambda s, d: pages.tiered_text(_tiered_pages(s, d), longest=None),
        "top_of_category": lambda s, d: reports.top_of_each(table(s, d, "events").select("event_id", "event_type", "value"), "event_type", [F.desc("value"), "event_id"], 5),
        "group_by_entity": lambda s, d: content.by_entity(documents(s, d), F.col("status"), ["success", "error"]),
        "intent_breakdown": lambda s, d: content.histogram(documents(s, d), "title", ["entity_name"]).select("entity_name", F.to_json("counts").alias("counts")),
        "intent_breakdown_by_count": lambda s, d: content.histogram(documents(s, d).withColumn("kind", F.concat("title", F.lit(" "), F.col("doc_id") % 3)), "kind", ["entity_name"], by_count=True).select("entity_name", F.to_json("counts").alias("counts")),
        "flagged_first": lambda s, d: reports.flagged_first(_statuses(s, d).select("doc_id", "status"), F.col("status") == "low_content", "doc_id"),
        "meta_output_twitter": lambda s, d: bundle.meta_output(_bundles(s, d), twitter=True).select("entity_name", F.get_json_object("meta_json", "$.twitter").alias("twitter")),
        "average_score": lambda s, d: _verdicts(s, d).agg(T.js_round(F.avg("hallucination_score"), 3).cast("double").alias("avg_score"), F.count("*").alias("n")),
        "origin_mode": lambda s, d: page_items(s, d).groupBy("entity_name", U.origin(F.col("url")).alias("origin")).agg(F.count("*").alias("n"), F.min("pool_pos").alias("p")).groupBy("entity_name").agg(F.max_by("origin", F.struct("n", -F.col("p"))).alias("origin")),
        "latest_wins": lambda s, d: content.latest(table(s, d, "conversations").select("conv_id", F.col("turn").alias("pool_pos"), F.when(F.col("role") == "user", F.col("text")).alias("user_text"), F.when(F.col("role") == "assistant", F.col("text")).alias("assistant_text")), ["user_text", "assistant_text"], "conv_id"),
        "slugify": lambda s, d: table(s, d, "part").select("p_partkey", T.slugify(F.concat("p_name", F.lit(" & Co. "), "p_brand")).alias("slug"), T.slug_to_title(T.slugify(F.col("p_type"))).alias("title")),
        "meta_output": lambda s, d: bundle.meta_output(_bundles(s, d)),
        "markdown_output": lambda s, d: bundle.markdown_output(_marked(s, d)),
        "markdown_output_plain": lambda s, d: bundle.markdown_output(_marked(s, d), "strip", markers=True, front=False, meta=True),
        "html_documents": _html_documents,
        "html_documents_wrapped": lambda s, d: _html_documents(s, d, wrap=True),
        "step_errors": lambda s, d: reports.step_errors(documents(s, d).select("entity_name", "pool_pos", F.when(F.col("status") == "error", F.concat(F.lit("failed at "), "pool_pos")).alias("error")), documents(s, d)),
        "html_output": lambda s, d: bundle.html_output(articles(s, d)),
        "json_output": lambda s, d: bundle.json_output(_bundles(s, d)),
        "json_output_flat": lambda s, d: bundle.json_output(_bundles(s, d), "flat"),
        "schema_org_injector": lambda s, d: bundle.schema_org(_bundles(s, d).withColumn("json", F.lit(None).cast("string"))),
        "company_media": _images,
        "llm_json_parse": lambda s, d: table(s, d, "events").select("event_id", T.model_json(F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```"))).alias("json")),
        "event_windows": lambda s, d: incremental.windowed_counts(table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))).select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 2).alias("total")),
        "relational_rollup": lambda s, d: table(s, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")),
        "relational_top_orders": lambda s, d: table(s, d, "orders").withColumn("r", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))).where("r <= 3").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_orderkey", "o_totalprice", "r"),
        "relational_semi_anti": lambda s, d: table(s, d, "part").join(table(s, d, "lineitem").where("l_quantity > 49"), F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey"),
    }
    return q | more.queries()


def oracle_sql() -> dict[str, str]:
    return oracles.ORACLES | more.ORACLES | page_oracles.ORACLES

"""Output documents per entity: Markdown, HTML, JSON, meta tags, schema.org, media."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from lodestream.functions import fixed_values as fixed
from lodestream.functions import text as T

_MARKER = r"(?m)^(#{1,6})\s+\[([^\]]+)\]"
_OLD_MARKER = r"(?m)^(#{1,6})\s+\[[A-Za-z]+:\s*([a-z0-9-]+)\]\s*"


def strip_markers(markdown: Column) -> Column:
    """Headings `## [Type: some-slug]` become `## Some Slug`: distinct slugs are replaced one by one."""
    slugs = F.array_distinct(F.regexp_extract_all(markdown, F.lit(_OLD_MARKER), F.lit(2)))
    return F.aggregate(slugs, markdown, lambda t, s: F.regexp_replace(t, F.concat(F.lit(r"(?m)^(#{1,6})\s+\[[A-Za-z]+:\s*"), s, F.lit(r"\][^\S\n]*")), F.concat(F.lit("$1 "), T.slug_to_title(s))))


def plain_headings(markdown: Column) -> Column:
    """Headings without their brackets: the slug of a category or tag as a title, other texts as they are. Distinct texts are replaced one by one."""
    def one(t: Column, x: Column) -> Column:
        slug = F.nullif(F.regexp_extract(x, r"^(?:(?:Primary|Secondary) Category|Tag): \s*(.*)$", 1), F.lit(""))
        by = F.coalesce(T.slug_to_title(slug), x)
        return F.regexp_replace(t, F.concat(F.lit(r"(?m)^(#{1,6})\s+\["), T.escape_regex(x), F.lit(r"\]")), F.concat(F.lit("$1 "), F.regexp_replace(by, r"([\\$])", r"\\$1")))

    return F.aggregate(F.array_distinct(F.regexp_extract_all(markdown, F.lit(_MARKER), F.lit(2))), markdown, one)


def _yaml(text: Column) -> Column:
    """A text as a YAML scalar: bare where that is safe, else in single quotes."""
    bare = text.rlike(r"^[\p{L}\p{N}_/(.+][\p{L}\p{N}_ .,()/+&#'’–—;=$%@!?*^~-]*$") & ~text.rlike(r"\s$|\s#|^[+.-]?[0-9]|^[.~]") & ~F.lower(text).isin("true", "false", "null", "yes", "no", "on", "off", "y", "n")
    return F.when(bare, text).otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'")))


def front_matter(name: Column, analysis: Column) -> Column:
    """Title, categories and tags between lines of ---; lists only where the analysis has them."""
    def listed(head: str, xs: Column) -> Column:
        return F.when(F.size(xs) > 0, F.concat(F.lit(f"\n{head}:"), F.array_join(F.transform(xs, lambda x: F.concat(F.lit("\n  - "), _yaml(x))), ""))).otherwise("")

    get = lambda path, *fields: F.transform(as_list(F.get_json_object(analysis, f"$.{path}")), lambda e: F.coalesce(label(e, *fields), e))
    categories = F.concat(get("categories.primary", "slug", "name"), get("categories.secondary", "slug", "name"))
    tags = F.concat(get("tags.existing", "slug", "name"), get("tags.suggested_new", "label", "slug"))
    return F.concat(F.lit("---\ntitle: "), _yaml(name), listed("categories", categories), listed("tags", tags), F.lit("\n---\n\n"))


def _source(n: Column) -> Column:
    return F.get(F.filter("citations", lambda c: c["index"] == n), F.lit(0))


def footnotes(markdown: Column) -> Column:
    """[#n] as [^n], with a note for each number below a rule; a number without source says so. Uses the column citations."""
    def note(n: Column) -> Column:
        known = F.concat(F.coalesce(_source(n)["title"], F.lit("")), F.lit(" — "), F.coalesce(_source(n)["url"], F.lit("")))
        return F.concat(F.lit("[^"), n.cast("string"), F.lit("]: "), F.coalesce(F.when(_source(n).isNotNull(), known), F.concat(F.lit("Source "), n.cast("string"))))

    ref = T.refs(markdown)
    return F.when(F.size(ref) > 0, F.concat(F.regexp_replace(markdown, r"\[#(\d+)\]", "[^$1]"), F.lit("\n\n---\n\n"), F.array_join(F.transform(ref, note), "\n"))).otherwise(markdown)


def markdown_output(articles: DataFrame, citations: str = "footnotes", markers: bool = False, front: bool = True, meta: bool = False) -> DataFrame:
    """articles: (entity_name, markdown, citations array<struct<index,url,title>>, analysis JSON or null). citations: `footnotes`, `inline` (as they are) or `strip`; markers: keep the brackets of headings; front: front matter; meta: keep the section Meta. Words and sections of the whole."""
    body = F.col("markdown") if meta else T.trim_ws(F.regexp_replace("markdown", r"\n## \[?Meta\]?[\s\S]*$", ""))
    body = body if markers else plain_headings(body)
    body = {"footnotes": footnotes, "strip": lambda t: F.regexp_replace(t, r"\s*\[#\d+\]", "")}.get(citations, lambda t: t)(body)
    whole = F.concat(front_matter(F.col("entity_name"), F.col("analysis")) if front else F.lit(""), T.trim_ws(body))
    out = articles.where("markdown != ''").select("entity_name", "markdown", whole.alias("final_markdown"))
    return out.select("entity_name", "final_markdown", T.word_count(F.col("final_markdown")).alias("word_count"), F.regexp_count("final_markdown", F.lit(r"(?m)^#{2,3}\s+")).alias("section_count"), F.size(T.refs(F.col("markdown"))).alias("citation_count"), F.replace(F.left("final_markdown", F.lit(200)), F.lit("\n"), F.lit(" ")).alias("content_preview"))


def _inline(line: Column) -> Column:
    for p, by in ((r"\*\*([^*]+)\*\*", "<strong>$1</strong>"), (r"\*([^*]+)\*", "<em>$1</em>"), (r"`([^`]+)`", "<code>$1</code>"), (r"\[([^\]]+)\]\(([^)\s]+)\)", '<a href="$2">$1</a>'), (r"\[#(\d+)\]", '<sup><a href="#cite-$1">[$1]</a></sup>')):
        line = F.regexp_replace(line, p, by)
    return line


def markdown_to_html(markdown: Column) -> Column:
    """Headings, lists, quotes, rules and paragraphs; blocks are separated by blank lines."""
    def item(block: Column, mark: str, tag: str) -> Column:
        lines = F.split(F.regexp_replace(block, rf"(?m)^{mark}\s+", ""), "\n")
        return F.concat(F.lit(f"<{tag}>"), F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<li>"), _inline(x), F.lit("</li>"))), ""), F.lit(f"</{tag}>"))

    def block(b: Column) -> Column:
        level = F.length(F.regexp_extract(b, r"^(#{1,6})\s", 1)).cast("string")
        return (
            F.when(b.rlike(r"^#{1,6}\s"), F.concat(F.lit("<h"), level, F.lit(">"), _inline(F.regexp_replace(b, r"^#{1,6}\s+", "")), F.lit("</h"), level, F.lit(">")))
            .when(b.rlike(r"^-{3,}$"), F.lit("<hr>")).when(b.rlike(r"^[-*]\s"), item(b, "[-*]", "ul")).when(b.rlike(r"^\d+\.\s"), item(b, r"\d+\.", "ol"))
            .when(b.startswith("&gt; "), F.concat(F.lit("<blockquote>"), _inline(F.regexp_replace(b, "(?m)^&gt; ", "")), F.lit("</blockquote>")))
            .otherwise(F.concat(F.lit("<p>"), _inline(b), F.lit("</p>")))
        )

    headed = F.regexp_replace(T.escape_html(markdown), r"(?m)^(#{1,6}\s.*)$", "\n$1\n")
    return F.array_join(F.transform(T.split_blocks(headed), block), "\n")


def html_output(articles: DataFrame) -> DataFrame:
    """articles as for markdown_output: an HTML document with anchored sources."""
    sources = F.array_join(F.transform(F.array_sort("citations"), lambda c: F.concat(F.lit('<li id="cite-'), c["index"].cast("string"), F.lit('"><a href="'), T.escape_html(c["url"]), F.lit('">'), T.escape_html(c["title"]), F.lit("</a></li>"))), "")
    body = markdown_to_html(strip_markers(F.col("markdown")))
    page = F.concat(F.lit('<!DOCTYPE html>\n<html lang="en"><head><meta charset="utf-8"><title>'), T.escape_html(F.col("title")), F.lit("</title></head><body>\n"), body, F.when(F.size("citations") > 0, F.concat(F.lit("\n<ol>"), sources, F.lit("</ol>"))).otherwise(""), F.lit("\n</body></html>"))
    return articles.select("entity_name", page.alias("final_html"), T.kb_size(page).alias("html_size_kb"), F.regexp_count(body, F.lit("<h[1-6]>")).alias("heading_count"))


@pandas_udf(StringType())
def _rendered(markdown: pd.Series) -> pd.Series:
    from lodestream.functions.markdown import to_html

    return markdown.map(lambda x: None if x is None else to_html(x))


def _cited(markdown: Column) -> Column:
    return F.regexp_replace(markdown, r"\[#(\d+)\]", '<sup><a href="#source-$1" id="ref-$1">[$1]</a></sup>')


def _sources_section(markdown: Column) -> Column:
    """The sources of a text's numbers, each with a link back."""
    def item(n: Column) -> Column:
        number, source = n.cast("string"), _source(n)
        name = F.coalesce(T.or_else(source["title"]), T.or_else(source["url"]), F.concat(F.lit("Source "), number))
        linked = F.concat(F.lit('<a href="'), T.escape_html(source["url"]), F.lit('" target="_blank" rel="noopener">'), T.escape_html(name), F.lit("</a>"))
        shown = F.when(F.coalesce(source["url"], F.lit("")) != "", linked).otherwise(T.escape_html(name))
        return F.concat(F.lit('<li id="source-'), number, F.lit('">'), shown, F.lit(' <a href="#ref-'), number, F.lit('">↩</a></li>'))

    ref = T.refs(markdown)
    return F.when(F.size(ref) > 0, F.concat(F.lit('\n<section class="sources"><h2>Sources</h2><ol>'), F.array_join(F.transform(ref, item), ""), F.lit("</ol></section>"))).otherwise("")


def _organization(name: Column, analysis: Column) -> Column:
    """schema.org data of an analysis as JSON, without blanks; absent facts are left out."""
    fact = lambda k: T.or_else(F.get_json_object(analysis, f"$.key_facts.{k}"))
    some = lambda xs: F.when(F.size(xs) > 0, xs)
    typed = lambda kind, *more: F.struct(F.lit(kind).alias("@type"), *more)
    slug = F.get(F.transform(as_list(F.get_json_object(analysis, "$.categories.primary")), lambda e: label(e, "slug")), F.lit(0))
    listed = lambda k, *fields: F.transform(as_list(fact(k)), lambda e: label(e, *fields))
    return F.to_json(F.struct(
        F.lit("https://schema.org").alias("@context"), F.lit("Organization").alias("@type"), name.alias("name"), fact("founded").alias("foundingDate"),
        F.when(fact("headquarters").isNotNull(), typed("PostalAddress", fact("headquarters").alias("addressLocality"))).alias("address"), F.when(fact("employees").isNotNull(), typed("QuantitativeValue", fact("employees").alias("value"))).alias("numberOfEmployees"),
        some(listed("awards", "detail")).alias("award"), some(F.transform(listed("licenses", "detail", "name"), lambda x: typed("EducationalOccupationalCredential", F.lit("license").alias("credentialCategory"), x.alias("name")))).alias("hasCredential"),
        some(F.transform(listed("key_people", "name"), lambda x: typed("Person", x.alias("name")))).alias("member"), fact("contact.email").alias("email"), fact("contact.phone").alias("telephone"),
        F.concat(name, F.lit(" is a company in the "), T.slug_to_title(slug), F.lit(" industry.")).alias("description"),
    ))


def html_documents(articles: DataFrame, schema_org_data: bool = True, css: str = "", sources: bool = True, wrap: bool = False) -> DataFrame:
    """articles: (entity_name, markdown, citations, analysis JSON or null). The article as HTML with numbered sources, data for search engines and a style; wrap: as a whole document. css: a style element or nothing."""
    rows = articles.where("markdown != ''").withColumn("html", _rendered(_cited(plain_headings(F.col("markdown")))))
    html = F.concat("html", _sources_section(F.col("markdown"))) if sources else F.col("html")
    has = F.col("analysis").isNotNull() if schema_org_data else F.lit(False)
    data = F.when(has, F.concat(F.lit('<script type="application/ld+json">\n'), _organization(F.col("entity_name"), F.col("analysis")), F.lit("\n</script>")))
    style = F.lit(css or None).cast("string")
    if wrap:
        whole = F.concat(F.lit('<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="UTF-8">\n<meta name="viewport" content="width=device-width, initial-scale=1.0">\n<title>'), T.escape_html(F.col("entity_name")), F.lit("</title>\n"), F.coalesce(style, F.lit("")), F.lit("\n"), F.coalesce(data, F.lit("")), F.lit("\n</head>\n<body>\n"), html, F.lit("\n</body>\n</html>"))
    else:
        whole = F.concat_ws("\n", style, data, html)
    out = rows.select("entity_name", html.alias("html"), whole.alias("final_html"), has.alias("has_schema_org"))
    return out.select("entity_name", "final_html", T.kb_size(F.col("final_html")).alias("html_size_kb"), "has_schema_org", F.regexp_count("html", F.lit("<h[1-6]")).alias("heading_count"), T.trim_ws(T.collapse_ws(F.left(T.strip_tags(F.col("final_html")), F.lit(200)))).alias("content_preview"))


def as_list(json: Column) -> Column:
    """The entries of a JSON array as texts (objects as JSON), of one value as an array of it, of null as an empty one."""
    value = F.coalesce(F.trim(json), F.lit(""))
    return F.when(value == "", F.array().cast("array<string>")).when(value.startswith("["), F.coalesce(F.from_json(value, "array<string>"), F.array().cast("array<string>"))).otherwise(F.array(value))


def label(entry: Column, *fields: str) -> Column:
    """A text itself; of an object the first field that has a value."""
    return F.when(entry.startswith("{"), T.or_else(*(F.get_json_object(entry, f"$.{f}") for f in fields))).otherwise(entry)


def _at(json: str, path: str) -> Column:
    return F.get_json_object(json, f"$.{path}")


def _labels(json: str, path: str, *fields: str) -> Column:
    return F.transform(as_list(_at(json, path)), lambda e: label(e, *fields))


def _quoted(text: Column) -> Column:
    """A text as JSON; null stays null."""
    whole = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substr(whole, F.lit(2), F.length(whole) - 2))


def _object(*members: tuple[str, Column]) -> Column:
    """A JSON object of the members whose JSON is not null."""
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*(F.concat(F.lit(f'"{k}":'), v) for k, v in members))), ","), F.lit("}"))


def count_fields(json: Column) -> Column:
    """The keys of a JSON object and of the objects in it, but not of those in arrays."""
    bare = F.regexp_replace(json, r'"(?:[^"\\]|\\.)*+"', "s")
    depth = F.least(F.length(bare) - F.length(F.replace(bare, F.lit("["))), F.lit(100))
    flat = F.aggregate(F.sequence(F.lit(0), depth), bare, lambda t, _: F.regexp_replace(t, r"\[[^\[\]]*\]", "a"))
    return F.length(flat) - F.length(F.replace(flat, F.lit(":")))


def json_output(artefacts: DataFrame, output_format: str = "strapi", flatten_key_facts: bool = False) -> DataFrame:
    """artefacts: (entity_name, markdown, analysis JSON, seo_plan JSON), any of them null. One JSON text each, without blanks; its keys counted outside arrays."""
    name, markdown = _quoted(F.col("entity_name")), _quoted(F.nullif("markdown", F.lit("")))
    if output_format == "flat":
        doc = _object(("entity_name", name), ("content_markdown", markdown), ("analysis", F.col("analysis")), ("seo_plan", F.col("seo_plan")))
    else:
        primary, secondary = _labels("analysis", "categories.primary", "slug"), _labels("analysis", "categories.secondary", "slug")
        first = lambda c: _quoted(F.get(c, F.lit(0)))
        tags = F.concat(_labels("analysis", "tags.existing", "slug"), _labels("analysis", "tags.suggested_new", "label", "slug"))
        facts = _at("analysis", "key_facts")
        inner = F.nullif(F.substr(facts, F.lit(2), F.length(facts) - 2), F.lit(""))
        seo = F.when(F.col("seo_plan").isNotNull(), _object(("meta_title", _quoted(_at("seo_plan", "meta.title"))), ("meta_description", _quoted(_at("seo_plan", "meta.description"))), ("target_keywords", _at("seo_plan", "target_keywords")), ("faqs", _at("seo_plan", "faqs"))))
        members = [("name", name), ("content", markdown), ("primary_category", first(primary)), ("primary_category_slug", first(primary)), ("secondary_category", first(secondary)), ("secondary_category_slug", first(secondary)), ("categories", F.when(_at("analysis", "categories").isNotNull(), F.to_json(F.concat(primary, secondary)))), ("tags", F.when(_at("analysis", "tags").isNotNull(), F.to_json(tags)))]
        doc = _object(*members, *([] if flatten_key_facts else [("key_facts", facts)]), ("sources", _at("analysis", "source_citations")), ("seo", seo))
        doc = F.concat(F.substr(doc, F.lit(1), F.length(doc) - 1), F.when(inner.isNotNull(), F.concat(F.lit(","), inner)).otherwise(""), F.lit("}")) if flatten_key_facts else doc
    out = artefacts.where("markdown is not null or analysis is not null or seo_plan is not null").select("entity_name", doc.alias("final_json"), *(F.col(c).isNotNull().alias(n) for c, n in (("markdown", "has_markdown"), ("analysis", "has_analysis"), ("seo_plan", "has_seo_plan"))))
    return out.withColumns({"field_count": count_fields(F.col("final_json")), "json_size_kb": T.kb_size(F.col("final_json"))})


def meta_output(items: DataFrame, title_max: int = 60, desc_min: int = 150, desc_max: int = 160, twitter: bool = False) -> DataFrame:
    """twitter: also the tags of that site. items: (entity_name, seo_plan JSON, analysis JSON or null). Keywords of both; a plan without title has the entity's name."""
    title, description = F.coalesce(F.nullif(_at("seo_plan", "meta.title"), F.lit("")), "entity_name"), F.coalesce(_at("seo_plan", "meta.description"), F.lit(""))
    keywords = F.array_distinct(F.filter(F.concat(_labels("analysis", "categories.primary", "slug"), _labels("analysis", "categories.secondary", "slug"), _labels("analysis", "tags.existing", "slug"), _labels("analysis", "tags.suggested_new", "label", "slug"), as_list(_at("seo_plan", "target_keywords.primary")), as_list(_at("seo_plan", "target_keywords.secondary")), as_list(_at("seo_plan", "target_keywords.long_tail"))), lambda k: k.isNotNull()))
    out = items.where("seo_plan is not null").select("entity_name", title.alias("meta_title"), description.alias("meta_description"), T.slugify(F.col("entity_name")).alias("slug"), keywords.alias("k"))
    n, m = F.length("meta_title"), F.length("meta_description")
    text = lambda what, x, most: F.concat(F.lit(f"{what}: "), x.cast("string"), F.lit(f"/{most}"))
    warn = F.array_compact(F.array(F.when(n > title_max, text("Title too long", n, title_max)), F.when(m < desc_min, text("Description too short", m, desc_min)), F.when(m > desc_max, text("Description too long", m, desc_max))))
    og = F.struct(F.col("meta_title").alias("og:title"), F.col("meta_description").alias("og:description"), F.lit("article").alias("og:type"))
    card = F.struct(F.lit("summary").alias("twitter:card"), F.col("meta_title").alias("twitter:title"), F.col("meta_description").alias("twitter:description"))
    doc = F.to_json(F.struct(F.col("meta_title").alias("title"), F.col("meta_description").alias("description"), "slug", F.col("k").alias("keywords"), og.alias("og"), *([card.alias("twitter")] if twitter else []), F.when(F.size(warn) > 0, warn).alias("warnings")))
    return out.select("entity_name", "meta_title", "meta_description", "slug", n.alias("title_length"), m.alias("description_length"), F.size("k").alias("keyword_count"), F.array_join(warn, "; ").alias("warnings"), F.when(F.size(warn) > 0, "warning").otherwise("ok").alias("status"), doc.alias("meta_json"))


def _title_case(slug: Column) -> Column:
    return F.array_join(F.transform(F.split(slug, "[-_]"), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 30))), " ")


def schema_org(items: DataFrame) -> DataFrame:
    """items: (entity_name, url, json: an output document's JSON, analysis JSON, seo_plan JSON; all but the name may be null). An Organization, a Product for each category and a FAQPage; alone or as an @graph. Absent fields are left out."""
    facts = lambda k: T.or_else(_at("analysis", f"key_facts.{k}"))
    some = lambda a: F.when(F.size(a) > 0, a)
    credential = lambda e: F.struct(F.lit("EducationalOccupationalCredential").alias("@type"), F.lit("license").alias("credentialCategory"), label(e, "detail", "name").alias("name"))
    overview = T.or_else(_at("json", "overview"))
    sentence = T.or_else(T.trim_ws(F.regexp_extract(overview, r"^[^.!?]+[.!?]", 0)), T.trim_ws(F.left(overview, F.lit(200))))
    slug = F.get(_labels("analysis", "categories.primary", "slug"), F.lit(0))
    described = F.coalesce(sentence, F.concat("entity_name", F.lit(" is a company in the "), F.array_join(F.transform(F.split(slug, "-"), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 30))), " "), F.lit(" industry.")))
    own = F.transform(as_list(_at("json", "credentials")), lambda e: F.struct(F.lit("EducationalOccupationalCredential").alias("@type"), F.lit("license").alias("credentialCategory"), label(e, "name", "detail").alias("name")))
    links = F.array_compact(F.array(*(T.or_else(_at("json", f"meta.{k}")) for k in ("linkedin", "twitter", "facebook", "instagram", "youtube"))))
    mail = T.or_else(_at("json", "contact.email"))
    org = F.struct(
        F.lit("Organization").alias("@type"), F.col("entity_name").alias("name"), F.nullif("url", F.lit("")).alias("url"), described.alias("description"),
        F.coalesce(mail, facts("contact.email")).alias("email"), F.coalesce(T.or_else(_at("json", "contact.phone")), F.when(mail.isNull(), facts("contact.phone"))).alias("telephone"),
        F.coalesce(some(own), some(F.transform(as_list(facts("licenses")), credential))).alias("hasCredential"), some(links).alias("sameAs"), T.or_else(_at("json", "meta.logo")).alias("logo"), facts("founded").alias("foundingDate"),
        F.when(facts("headquarters").isNotNull(), F.struct(F.lit("PostalAddress").alias("@type"), facts("headquarters").alias("addressLocality"))).alias("address"),
        F.when(facts("employees").isNotNull(), F.struct(F.lit("QuantitativeValue").alias("@type"), facts("employees").alias("value"))).alias("numberOfEmployees"),
        some(F.transform(as_list(facts("awards")), lambda e: label(e, "detail", "name"))).alias("award"), some(F.transform(as_list(facts("key_people")), lambda e: F.struct(F.lit("Person").alias("@type"), label(e, "name").alias("name")))).alias("member"),
    )
    ours, theirs = as_list(_at("json", "categories")), as_list(_at("analysis", "categories.primary"))

    def product(e: Column, description: Column, *fields: str) -> Column:
        brand = F.struct(F.lit("Organization").alias("@type"), F.col("entity_name").alias("name"))
        return F.struct(F.lit("Product").alias("@type"), _title_case(label(e, *fields)).alias("name"), brand.alias("brand"), F.nullif("url", F.lit("")).alias("url"), description.alias("description"))

    named = lambda es, *fields: F.filter(es, lambda e: F.coalesce(label(e, *fields), F.lit("")) != "")
    field = lambda e, k: F.when(e.startswith("{"), T.or_else(F.get_json_object(e, f"$.{k}")))
    mine = F.transform(named(ours, "name", "slug", "label"), lambda e: product(e, field(e, "description"), "name", "slug", "label"))
    products = F.when(F.size(mine) > 0, mine).otherwise(F.transform(named(theirs, "slug", "name"), lambda e: product(e, field(e, "why"), "slug", "name")))
    asked = lambda json: F.filter(F.transform(as_list(json), lambda e: F.struct(T.or_else(F.get_json_object(e, "$.question"), F.get_json_object(e, "$.q")).alias("q"), T.or_else(F.get_json_object(e, "$.answer"), F.get_json_object(e, "$.a")).alias("a"))), lambda x: x["q"].isNotNull() & x["a"].isNotNull())
    faqs = T.let(asked(_at("json", "faq")), lambda x: F.when(F.size(x) > 0, x).otherwise(asked(_at("seo_plan", "faqs"))))
    entries = F.transform(faqs, lambda x: F.struct(F.lit("Question").alias("@type"), x["q"].alias("name"), F.struct(F.lit("Answer").alias("@type"), x["a"].alias("text")).alias("acceptedAnswer")))
    out = items.select("entity_name", "url", org.alias("org"), products.alias("products"), entries.alias("entries"))
    page = F.when(F.size("entries") > 0, F.to_json(F.struct(F.lit("FAQPage").alias("@type"), F.col("entries").alias("mainEntity"))))
    schemas = F.filter(F.concat(F.array(F.to_json("org")), F.transform("products", lambda x: F.to_json(x)), F.array(page)), lambda x: x.isNotNull())
    out = out.withColumn("schemas", schemas)
    context = F.lit('{"@context":"https://schema.org",')
    only = F.get("schemas", F.lit(0))
    whole = F.when(F.size("schemas") == 1, F.concat(context, F.substr(only, F.lit(2), F.length(only)))).otherwise(F.concat(context, F.lit('"@graph":['), F.array_join("schemas", ","), F.lit("]}")))
    absent = lambda c, text: F.when(F.coalesce(F.nullif(c, F.lit("")), F.lit("")) == "", F.lit(text))
    dated = F.col("org.foundingDate")
    errors = F.array_compact(F.array(absent(F.col("org.url"), 'Organization: missing recommended field "url"'), absent(F.col("org.description"), 'Organization: missing recommended field "description"'), F.when(~dated.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), F.concat(F.lit('Organization: foundingDate "'), dated, F.lit('" is not a valid ISO date format')))))
    return out.select("entity_name", whole.alias("schema_json"), F.size("schemas").alias("schema_count"), F.array_join(errors, "; ").alias("validation_errors"), (F.size(errors) > 0).alias("has_validation_errors"))


def logo_score(src: Column, alt: Column, cls: Column, id_: Column, width: Column) -> Column:
    """Points of an image for being a logo that shows on a light ground; may be negative."""
    where = {"src": src, "any": F.concat_ws(" ", src, alt, cls, id_)}
    found = lambda place, pattern: F.coalesce(where[place].rlike(f"(?i){pattern}"), F.lit(False))
    points = [F.when(found(place, pattern), n).otherwise(0) for place, pattern, n in fixed.LOGO_SIGNS]
    points += [F.when(found("any", "icon") & ~found("any", "logo"), -3).otherwise(0), F.when(width > 100, 2).otherwise(0), F.when((width > 0) & (width < 32), -3).otherwise(0)]
    return sum(points, F.lit(0))


def company_media(images: DataFrame, top: int = 5) -> DataFrame:
    """The best logo candidates of each entity. images: (entity_name, pos, src, alt, cls, id, width)."""
    scored = images.withColumn("score", logo_score(F.col("src"), F.col("alt"), F.col("cls"), F.col("id"), F.col("width")))
    n = F.row_number().over(Window.partitionBy("entity_name").orderBy(F.desc("score"), "pos"))
    return scored.withColumn("rank", n).where(F.col("rank") <= top).select("entity_name", "rank", "src", "score")


def analysis_flat(items: DataFrame, *also: str) -> DataFrame:
    """also: columns that are kept. items: (entity_name, analysis JSON of any of the three schemas: texts, {slug, why}, {detail, source}). A lone secondary list counts as primary."""
    dash = " \u2014 "
    lists = {"p0": as_list(_at("analysis", "categories.primary")), "s0": as_list(_at("analysis", "categories.secondary")), "old": _labels("analysis", "tags.existing", "slug", "label"), "new": F.transform(as_list(F.coalesce(_at("analysis", "tags.suggested_new"), _at("analysis", "tags.suggested"))), lambda e: label(e, "slug", "label")), "cites": as_list(_at("analysis", "source_citations"))}
    out = items.select("entity_name", *also, *(c.alias(k) for k, c in lists.items()), *(T.or_else(_at("analysis", f"key_facts.{k}")).alias(k.replace(".", "_")) for k in ("founded", "headquarters", "hq", "employees", "key_people", "licenses", "awards", "partnerships", "offices", "contact.email", "contact.phone", "contact.website")))
    lone = (F.size("p0") == 0) & (F.size("s0") > 0)
    out = out.withColumn("primary", F.when(lone, F.col("s0")).otherwise(F.col("p0"))).withColumn("secondary", F.when(lone, F.array().cast("array<string>")).otherwise(F.col("s0")))
    slug = lambda e: label(e, "slug", "label")
    why = lambda e: F.when(e.startswith("{"), F.concat(F.coalesce(F.get_json_object(e, "$.slug"), F.lit("undefined")), F.lit(" ("), F.coalesce(F.get_json_object(e, "$.why"), F.lit("undefined")), F.lit(")"))).otherwise(e)
    line = lambda head, xs: F.when(F.size(xs) > 0, F.concat(F.lit(head), F.array_join(xs, ", ")))
    joined = lambda by, none, *parts: F.coalesce(F.nullif(F.concat_ws(by, *parts), F.lit("")), F.lit(none))
    tags = F.concat("old", "new")
    tags_preview = F.concat(F.array_join(F.slice(tags, 1, 5), ", "), F.when(F.size(tags) > 5, F.concat(F.lit(" (+"), (F.size(tags) - 5).cast("string"), F.lit(")"))).otherwise(""))
    place = F.coalesce("headquarters", "hq")
    people = F.transform(as_list(F.col("key_people")), lambda e: F.when(e.startswith("{"), F.concat(F.coalesce(F.get_json_object(e, "$.name"), F.lit("undefined")), F.lit(dash), F.coalesce(F.get_json_object(e, "$.role"), F.lit("undefined")))).otherwise(e))
    detail = lambda c: F.transform(as_list(F.col(c)), lambda e: label(e, "detail"))
    fact = lambda head, c: F.concat(F.lit(head), c)
    offices = F.filter(as_list(F.col("offices")), lambda o: o.isNotNull() & (o != ""))
    contact = F.nullif(F.concat_ws(", ", fact("Email: ", F.col("contact_email")), fact("Phone: ", F.col("contact_phone")), fact("Website: ", F.col("contact_website"))), F.lit(""))
    facts_text = joined("\n", "No facts extracted", fact("Founded: ", F.col("founded")), fact("Headquarters: ", place), fact("Employees: ", F.col("employees")), line("Key People: ", people), line("Licenses: ", detail("licenses")), line("Awards: ", detail("awards")), line("Partnerships: ", detail("partnerships")), line("Offices: ", offices), contact)
    number = lambda i: (i + 1).cast("string")
    get = F.get_json_object
    cite = lambda e, i: F.when(~e.startswith("{"), F.concat(number(i), F.lit(". "), e)).when(get(e, "$.index").isNotNull(), F.concat(F.lit("[#"), get(e, "$.index"), F.lit("] "), F.coalesce(get(e, "$.url"), F.lit("undefined")), F.coalesce(F.concat(F.lit(dash), T.or_else(get(e, "$.title"))), F.lit("")))).otherwise(F.concat(number(i), F.lit(". "), F.coalesce(get(e, "$.claim"), F.lit("undefined")), F.lit(dash), F.array_join(as_list(get(e, "$.sources")), ", ")))
    return out.select(
        "entity_name", *also, F.coalesce(F.nullif(F.array_join(F.transform("primary", slug), ", "), F.lit("")), F.lit("Unknown")).alias("primary_category"), tags_preview.alias("tags_preview"),
        joined(" \u00b7 ", "No facts extracted", fact("Est. ", F.col("founded")), place, F.concat(F.lit("~"), F.col("employees"), F.lit(" employees"))).alias("facts_preview"),
        joined("\n", "No categories assigned", line("Primary: ", F.transform("primary", why)), line("Secondary: ", F.transform("secondary", why))).alias("categories_text"),
        joined("\n", "No tags extracted", line("Existing: ", F.col("old")), line("Suggested new: ", F.col("new"))).alias("tags_text"), facts_text.alias("key_facts_text"),
        F.when(F.size("cites") > 0, F.array_join(F.transform("cites", cite), "\n")).otherwise("No citations").alias("source_citations_text"),
    )


def seo_plan_flat(items: DataFrame, *also: str) -> DataFrame:
    """also: columns that are kept. items: (entity_name, plan JSON). Keywords by tier, FAQ count, warnings on the lengths of title and description."""
    tier = lambda head, k: T.let(as_list(_at("plan", f"target_keywords.{k}")), lambda xs: F.when(F.size(xs) > 0, F.concat(F.lit(head), F.array_join(xs, ", "))))
    primary = F.coalesce(T.or_else(_at("plan", "target_keywords.primary")), F.lit("Not specified"))
    n, m = F.length(T.or_else(_at("plan", "meta.title"))), F.length(T.or_else(_at("plan", "meta.description")))
    warn = F.concat_ws("; ", F.when(n > 60, F.concat(F.lit("Meta title is "), n.cast("string"), F.lit(" chars (recommended: \u226460)"))), F.when(~m.between(150, 160), F.concat(F.lit("Meta description is "), m.cast("string"), F.lit(" chars (recommended: 150-160)"))))
    return items.select("entity_name", *also, primary.alias("primary_keyword"), F.concat_ws("\n", F.concat(F.lit("Primary: "), primary), tier("Secondary: ", "secondary"), tier("Long-tail: ", "long_tail")).alias("keywords_text"), F.size(as_list(_at("plan", "faqs"))).alias("faq_count"), warn.alias("warnings"))


def completeness() -> Column:
    """The points of a profile's columns; all weights sum to 100."""
    text = lambda c: F.coalesce(F.length(c), F.lit(0)) > 0
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    told = F.coalesce(F.exists("positions", lambda p: F.coalesce(F.length(p["description"]), F.lit(0)) > 20), F.lit(False))
    rules = [(text("headline"), 10), (F.coalesce(F.length("summary"), F.lit(0)) > 50, 15), (some("positions"), 20), (told, 10), (some("education"), 15), (some("skills"), 10), (some("languages"), 5), (text("location"), 5), (some("certifications"), 5), (some("volunteer"), 5)]
    return sum((F.when(c, w).otherwise(0) for c, w in rules), F.lit(0))


def profile_completeness(profiles: DataFrame) -> DataFrame:
    """profiles: (id, headline, summary, positions array<struct<description>>, education, skills, languages, location, certifications, volunteer: arrays). Weights sum to 100; under 50 is incomplete."""
    score = completeness()
    return profiles.select("id", score.alias("completeness_score"), F.when(score < 50, "incomplete").otherwise("success").alias("status"))

"""Links and text of HTML pages by regular expressions, all in the JVM."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import fixed_values as fixed
from lodestream.functions import text as T
from lodestream.functions import urls

# explode_outer and a filter: for a plain explode Catalyst would work the array out once more, for a filter on its size
SECTIONS = ("nav", "header", "footer", "body")


def _first(html: Column, *patterns: str) -> Column:
    """What the first pattern that matches holds; each is tried once."""
    one = lambda p: T.let(F.regexp_extract(html, p, 0), lambda m: F.when(m != "", F.regexp_extract(m, p, 1)))
    return F.coalesce(*map(one, patterns))


def title(html: Column) -> Column:
    """<title>, even if empty, else og:title, else the first heading."""
    og = _first(html, *(p.format(attribute="property", name="og:title") for p in (fixed.META_BEFORE, fixed.META_AFTER)))
    return T.decode_entities(F.coalesce(T.trim_ws(_first(html, fixed.TITLE)), T.trim_ws(og), T.trim_ws(T.strip_tags(_first(html, fixed.FIRST_HEADING)))))


def meta(html: Column, attribute: str, name: str) -> Column:
    return T.decode_entities(T.trim_ws(_first(html, *(p.format(attribute=attribute, name=name) for p in (fixed.META_BEFORE, fixed.META_AFTER)))))


def _cleaned(out: Column) -> Column:
    """The text of a piece of HTML without chrome, paragraphs apart. Blank lines between them are then deleted, as the page scraper does."""
    for tag in fixed.CHROME_TAGS:
        out = F.regexp_replace(out, rf"(?is)<{tag}[^>]*>.*?</{tag}>", "")
    for p, by in fixed.TEXT_BREAKS:
        out = F.regexp_replace(out, p, by)
    out = T.decode_entities(T.strip_tags(out))
    out = F.regexp_replace(F.regexp_replace(out, r"[^\S\n]+", " "), r"\n\s*\n", "\n\n")
    return T.trim_ws(F.regexp_replace(out, r"(?m)^\s+|\s+$", ""))


def extract_text(html: Column, longest: int | None = 50_000) -> Column:
    """The main region's text; longest: characters kept, None for all."""
    cms = [T.let(_first(html, p), lambda m: F.when(F.length(m) > 100, m)) for p in fixed.REGIONS]
    out = _cleaned(F.coalesce(*(_first(html, p) for p in fixed.MAIN_PARTS), *cms, _first(html, fixed.BODY), html))
    return out if longest is None else F.left(out, F.lit(longest))


def tiered_text(pages: DataFrame, enough: int = 30, longest: int | None = 50_000) -> DataFrame:
    """(page_id, text_content, word_count, extraction_method). The first tier that has `enough` words, or the longest tried: `readability`, here the article's or main part's own text; `cms_dom`, all regions of known content systems together; `regex_fallback`, extract_text. `none` without any word."""
    article = F.coalesce(*(_first(F.col("html"), p) for p in reversed(fixed.MAIN_PARTS)))
    regions = F.array_join(F.concat(*(F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in fixed.REGIONS)), "\n\n")

    def tried(method: str, text: Column) -> Column:
        return T.let(text, lambda t: F.struct(t.alias("text"), T.word_count(t).alias("n"), F.lit(method).alias("method")))

    def better(best: Column, next_: Column) -> Column:
        return T.let(best, lambda b: F.when(b["n"] >= enough, b).otherwise(T.let(next_, lambda x: F.when(x["n"] > b["n"], x).otherwise(b))))

    best = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"), F.lit("none").alias("method"))
    for method, text in (("readability", F.coalesce(_cleaned(article), F.lit(""))), ("cms_dom", _cleaned(regions)), ("regex_fallback", extract_text(F.col("html"), None))):
        best = better(best, tried(method, text))
    out = pages.select("page_id", best.alias("b"))
    text = F.col("b.text") if longest is None else F.left("b.text", F.lit(longest))
    return out.select("page_id", text.alias("text_content"), T.word_count(text).alias("word_count"), F.col("b.method").alias("extraction_method"))


DOM_TEXT = "page_id {id}, text string, n int, method string"


def _dom_text(enough: int):
    """Of each page the text of the first tree tier that has `enough` words, or of the longer one."""
    from lodestream.functions import dom

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 64):  # a page's tree is some times its size
                some, rows = batch.slice(lo, 64), []
                for html in some.column("html").to_pylist():
                    root, best = dom.parse(html or ""), ("", 0, "none")
                    for method, read in (("readability", dom.readable_text), ("cms_dom", dom.cms_text)):
                        text = read(root) if best[1] < enough else ""
                        if (n := dom.count_words(text)) > best[1]:
                            best = (text, n, method if method != "readability" or n >= enough else "none")
                    rows.append(best)
                texts, counts, methods = (pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.string())))
                yield pa.RecordBatch.from_arrays([some.column("page_id"), texts, counts, methods], ["page_id", "text", "n", "method"])

    return run


def dom_text(pages: DataFrame, enough: int = 30, longest: int | None = 50_000) -> DataFrame:
    """(page_id, text_content, word_count, extraction_method): the article by node scores (`readability`), then the elements of content systems (`cms_dom`), both on one tree of the page; then extract_text (`regex_fallback`), which runs only for pages whose tree gave less than `enough` words. A shorter text of an article is kept, as `none`, where nothing else gives more. Null pages have no text. The tree is left whole by each tier, so that none depends on what an earlier one took out."""
    of_tree = pages.select("page_id", "html").mapInArrow(_dom_text(enough), DOM_TEXT.format(id=pages.schema["page_id"].dataType.simpleString()))
    few = of_tree.where(F.col("n") < enough).select("page_id")
    by_pattern = pages.join(few, "page_id", "left_semi").select("page_id", extract_text(F.col("html"), None).alias("other"))
    both = of_tree.join(by_pattern, "page_id", "left").withColumn("more", (F.col("n") < enough) & (T.word_count(F.col("other")) > F.col("n")))
    text = F.when(F.col("more"), F.col("other")).otherwise(F.col("text"))
    text = text if longest is None else F.left(text, F.lit(longest))
    method = F.when(F.col("more"), "regex_fallback").otherwise(F.col("method"))
    return both.select("page_id", text.alias("text_content"), T.word_count(text).alias("word_count"), method.alias("extraction_method"))


def page_items(pages: DataFrame, min_words: int = 50, longest: int | None = 50_000) -> DataFrame:
    """Scraped pages: title, text, counts, status. A bot wall or a text no longer than the page's own summary is low content."""
    out = pages.withColumn("text_content", extract_text(F.col("html"), longest)).withColumn("og", meta(F.col("html"), "property", "og:description"))
    low = (T.word_count(F.col("text_content")) < min_words) | T.is_block_page(F.col("text_content")) | T.is_truncated(F.col("text_content"), F.col("og"))
    return out.select("page_id", "url", title(F.col("html")).alias("title"), T.word_count(F.col("text_content")).alias("word_count"), F.when(low, "low_content").otherwise("success").alias("status"), T.preview(F.col("text_content")).alias("text_preview"), "text_content")


def _links(section: Column, base: Column) -> Column:
    """array of (url, link_text) of a piece of HTML."""
    whole = F.transform(F.regexp_extract_all(section, F.lit(fixed.ANCHOR), F.lit(0)), lambda a: F.struct(F.regexp_extract(a, fixed.ANCHOR, 1).alias("h"), F.regexp_extract(a, fixed.ANCHOR, 2).alias("t")))
    pairs = F.filter(whole, lambda p: ~p["h"].rlike(rf"(?i)^\s*({'|'.join(fixed.NO_LINKS)})"))
    return F.transform(pairs, lambda p: F.struct(urls.resolve(base, T.trim_ws(p["h"])).alias("url"), F.left(T.trim_ws(F.regexp_replace(p["t"], "<[^>]*>", "")), F.lit(200)).alias("link_text")))


def _placed(section: str, rank: int):
    return lambda x, i: F.struct(x["url"].alias("link"), x["link_text"], F.lit(section).alias("source_location"), (F.lit(rank * 100_000) + i).alias("rank"))


def page_links(pages: DataFrame, most: int | None = 200, footer: bool = True, body: bool = False, same_domain: bool = True) -> DataFrame:
    """Links by section, the first of each URL on a page; nav before header before footer before body. most: links of a page, None for all."""
    chosen = [s for s in SECTIONS if (s != "footer" or footer) and (s != "body" or body)]
    parts = []
    for rank, s in enumerate(SECTIONS):
        whole = F.col("html") if s == "body" else F.array_join(F.regexp_extract_all("html", F.lit(rf"(?is)<{s}[\s>].*?</{s}>"), F.lit(0)), "\n")
        parts.append(F.transform(_links(whole, F.col("url")), _placed(s, rank)))
    out = pages.select("page_id", F.col("url").alias("found_on"), F.explode_outer(F.concat(*parts)).alias("x")).select("page_id", "found_on", "x.*").where("link is not null")
    out = out.withColumn("_n", F.row_number().over(Window.partitionBy("page_id", "link").orderBy("rank"))).where("_n = 1").where(F.col("source_location").isin(chosen))
    out = out.where(urls.domain(F.col("link")) == urls.domain(F.col("found_on"))) if same_domain else out
    if most is not None:
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy("page_id").orderBy("rank"))).where(F.col("_n") <= most)
    return out.select("page_id", F.col("link").alias("url"), "link_text", "source_location")


def deep_links(pool: DataFrame, patterns: list[str], max_pages: int | None = 30, per_page: int | None = 50) -> DataFrame:
    """Links of the entity's first pages whose path has a pattern; no junk, none known, first occurrence of each. max_pages, per_page: None for all."""
    path = F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1))
    chosen = pool.where(T.has_any(path, patterns))
    if max_pages is not None:
        chosen = chosen.withColumn("_n", F.row_number().over(Window.partitionBy("entity_name").orderBy("page_id"))).where(F.col("_n") <= max_pages)
    out = chosen.select("page_id", F.col("url").alias("found_on"), F.posexplode_outer(_links(F.col("html"), F.col("url"))).alias("pos", "x")).select("page_id", "found_on", "pos", "x.*").where("url is not null")
    out = out.where(~urls.is_junk(F.col("url"))).join(pool.select("url").distinct(), "url", "left_anti")
    if per_page is not None:
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))).where(F.col("_n") <= per_page)
    out = out.withColumn("_n", F.row_number().over(Window.partitionBy("url").orderBy("page_id", "pos"))).where("_n = 1")
    return out.select("url", "found_on", "link_text")


def crawl(homes: DataFrame, snapshot: DataFrame, max_pages: int | None = 10, most: int | None = 1000, same_domain: bool = True) -> DataFrame:
    """(entity_name, url, link_text, found_on): the links of each entity's homepage, then of the key pages that it links to; first occurrences. homes: (entity_name, url, html); snapshot: (url, html). max_pages, most: key pages and links of an entity, None for all."""
    def links_of(pages: DataFrame, depth: int) -> DataFrame:
        out = pages.select("entity_name", "home", "page_pos", F.col("url").alias("found_on"), F.posexplode_outer(_links(F.col("html"), F.col("url"))).alias("pos", "x")).where("pos is not null")
        return out.select("entity_name", "home", F.struct(F.lit(depth).alias("d"), "page_pos", "pos").alias("at"), F.coalesce(urls.unwrap_archive(F.col("x.url")), "x.url").alias("url"), "x.link_text", "found_on")

    first = links_of(homes.select("entity_name", F.col("url").alias("home"), F.lit(0).alias("page_pos"), "url", "html"), 0)
    path = F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1))
    keys = first.where((urls.domain(F.col("url")) == urls.domain(F.col("home"))) & T.has_any(path, fixed.KEY_PAGES)).groupBy("entity_name", "home", "url").agg(F.min("at").alias("at"))
    keys = keys.withColumn("page_pos", F.row_number().over(Window.partitionBy("entity_name").orderBy("at")))
    keys = keys if max_pages is None else keys.where(F.col("page_pos") <= max_pages)
    found = first.unionByName(links_of(keys.join(snapshot.select("url", "html"), "url").select("entity_name", "home", "page_pos", "url", "html"), 1))
    found = found.where(urls.domain(F.col("url")) == urls.domain(F.col("home"))) if same_domain else found
    out = found.groupBy("entity_name", "url").agg(F.min("at").alias("at"), F.min_by("link_text", "at").alias("link_text"), F.min_by("found_on", "at").alias("found_on"))
    if most is not None:
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy("entity_name").orderBy("at"))).where(F.col("_n") <= most)
    return out.select("entity_name", "url", "link_text", "found_on")

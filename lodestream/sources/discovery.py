"""Sources of candidate URLs and items. What the network says is a table of recorded responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.functions import fixed_values as fixed
from lodestream.functions import text as T
from lodestream.functions import urls as U


def entity_items(grouped: DataFrame | None, flat: DataFrame | None) -> DataFrame:
    """The two input layouts as rows (entity_name, url); rows without url go, names fall back to `unknown`."""
    parts = []
    if grouped is not None:
        item = grouped.select("name", F.explode("items").alias("i"))
        parts.append(item.select(T.or_else(F.col("name"), F.col("i.entity_name"), F.lit("unknown")).alias("entity_name"), F.col("i.url").alias("url")))
    if flat is not None:
        parts.append(flat.select(T.or_else(F.col("entity_name"), F.col("name"), F.lit("unknown")).alias("entity_name"), "url"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.where("url is not null and url != ''")


def seed_paths(spark, custom: str = "") -> DataFrame:
    rows = [tuple(x.split()) for x in fixed.lines(fixed.SEED_PATHS)]
    mine = [x.strip() for x in custom.split("\n")]
    rows += [(x if x.startswith("/") else f"/{x}", "custom") for x in mine if x and not x.startswith("#")]
    return spark.createDataFrame(rows, "path string, path_type string")


def seed_urls(entities: DataFrame, responses: DataFrame, custom: str = "") -> DataFrame:
    """Known paths under each website that answered 2xx; HEAD before GET. entities: (entity_name, website); responses: (url, method, status_code). The path list is a few rows of the program's own."""
    site = F.trim("website")
    base = F.regexp_replace(F.when(site.rlike("^https?://"), site).otherwise(F.concat(F.lit("https://"), site)), "/+$", "")
    urls = entities.crossJoin(F.broadcast(seed_paths(entities.sparkSession, custom))).select("entity_name", F.concat(base, "path").alias("url"), "path_type")
    good = responses.where(F.col("status_code").between(200, 299)).groupBy("url").agg(F.max_by(F.struct("method", "status_code"), F.col("method") == "HEAD").alias("r"))
    return urls.join(good, "url").select("entity_name", "url", "path_type", F.col("r.status_code").alias("status_code"), F.col("r.method").alias("found_via"))


def sitemap_urls(sitemaps: DataFrame, most: int = 10_000, include: str = "", exclude: list[str] = ()) -> DataFrame:
    """sitemaps: (entity_name, xml). A priority of 0 is null, as one that is no number."""
    out = sitemaps.select("entity_name", F.posexplode(F.slice(F.split("xml", "<url>"), 2, 1 << 30)).alias("pos", "b"))
    tag = lambda t: F.nullif(T.trim_ws(F.regexp_extract("b", f"(?is)<{t}[^>]*>(.*?)</{t}>", 1)), F.lit(""))
    priority = F.nullif(F.regexp_extract(tag("priority"), r"^[-+]?\d*\.?\d+", 0), F.lit("")).try_cast("double")
    out = out.select("entity_name", "pos", tag("loc").alias("url"), tag("lastmod").alias("last_modified"), tag("changefreq").alias("change_frequency"), F.nullif(priority, F.lit(0.0)).alias("priority")).where("url is not null")
    for p in exclude:
        out = out.where(~F.col("url").rlike(f"(?i){p}"))
    out = out.where(F.col("url").rlike(f"(?i){include}")) if include else out
    from pyspark.sql import Window

    return out.withColumn("_n", F.row_number().over(Window.partitionBy("entity_name").orderBy("pos"))).where(F.col("_n") <= most).drop("_n", "pos")


def sitemap_pages(roots: DataFrame, responses: DataFrame) -> DataFrame:
    """(entity_name, xml): the sitemaps of each root; an index is replaced by its children, one level deep, in its order. roots: (entity_name, xml); responses: (url, xml)."""
    index = F.contains("xml", F.lit("<sitemapindex"))
    locs = F.transform(F.regexp_extract_all("xml", F.lit(r"(?is)<loc[^>]*>(.*?)</loc>"), F.lit(1)), T.trim_ws)
    children = roots.where(index).select("entity_name", F.explode(locs).alias("url")).join(responses.select("url", "xml"), "url").where(~F.contains("xml", F.lit("<sitemapindex")))
    return roots.where(~index).select("entity_name", "xml").unionByName(children.select("entity_name", "xml"))


def feed_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, feed_type, title): the feeds that pages name in their heads. pages: (page_id, url, html)."""
    tags = F.regexp_extract_all("html", F.lit(r"""(?i)<link[^>]+rel=["']alternate["'][^>]*>"""), F.lit(0))
    of = lambda name: F.nullif(F.regexp_extract("tag", rf"""(?i){name}=["']([^"']+)["']""", 1), F.lit(""))
    out = pages.select("page_id", U.origin(F.col("url")).alias("base"), F.explode_outer(tags).alias("tag")).where("tag is not null")
    kind, href = F.lower(of("type")), of("href")
    out = out.where(T.has_any(kind, ["rss", "atom", "xml"]) & href.isNotNull())
    url = F.when(href.startswith("/"), F.concat("base", href)).when(href.startswith("http"), href).otherwise(F.concat(F.col("base"), F.lit("/"), href))
    return out.select("page_id", url.alias("url"), F.when(F.contains(kind, F.lit("atom")), "atom").otherwise("rss").alias("feed_type"), of("title").alias("title"))


def api_requests(entities: DataFrame, providers: list[tuple[str, str]], keywords: list[str]) -> DataFrame:
    """(entity_name, provider, keyword): the calls to make: one for each keyword of a `search` provider, one for a `feed`. Both lists are the program's own."""
    calls = [(p, k) for p, mode in providers for k in (keywords if mode == "search" else [None])]
    each = F.array(*(F.struct(F.lit(p).alias("provider"), F.lit(k).cast("string").alias("keyword")) for p, k in calls))
    return entities.select("entity_name", F.inline(each))


def archived(snapshots: DataFrame) -> DataFrame:
    """Usable answers of an archive, under the original URL. snapshots: (url, http_status, body)."""
    good = (F.col("http_status") < 400) & ~T.has_any(F.col("body"), fixed.lines(fixed.NOT_ARCHIVED))
    return snapshots.where(good).select(F.coalesce(U.unwrap_archive(F.col("url")), "url").alias("url"), "body")


def feeds(bodies: DataFrame) -> DataFrame:
    """bodies: (url, body). Those that are feeds, with type, title and item count."""
    start = F.lower(F.left("body", F.lit(500)))
    has = lambda x: F.contains(start, F.lit(x))
    title = F.regexp_extract("body", "(?i)<title[^>]*>([^<]+)</title>", 1)
    return bodies.where(has("<rss") | has("<feed") | has("<rdf:rdf")).select("url", F.when(has("<feed"), "atom").when(has("<rdf:rdf"), "rdf").otherwise("rss").alias("feed_type"), F.nullif(T.trim_ws(title), F.lit("")).alias("title"), (F.regexp_count("body", F.lit(r"(?i)<item[\s>]")) + F.regexp_count("body", F.lit(r"(?i)<entry[\s>]"))).alias("item_count"))


def site_base(website):
    """A website's address without a slash at its end."""
    site = F.trim(website)
    return F.regexp_replace(F.when(site.startswith("http"), site).otherwise(F.concat(F.lit("https://"), site)), "/$", "")


def discover_feeds(entities: DataFrame, responses: DataFrame, most: int | None = 10, probe: bool = True) -> DataFrame:
    """(entity_name, url, feed_type, title, item_count): feeds that a homepage names, in its order, then known paths that hold one; `most` of each entity, None for all. What a named feed's own answer says goes before what the link says, but for its title. entities: (entity_name, website), one row each; responses: (url, http_status, body). An entity without website has none.

    Known paths are looked for at the ends of the answers' URLs, so that no entity is multiplied by them. The size of texts that are made or exploded is not known to Spark before they are there, so that it would broadcast all of them: both sides of each join are shuffled.
    """
    bases = entities.where("website != ''").select("entity_name", site_base(F.col("website")).alias("base"))
    good = responses.where(F.col("http_status").between(200, 299)).groupBy("url").agg(F.min("body").alias("body"))
    homes = bases.join(good.withColumnRenamed("url", "base").hint("merge"), "base")
    named = homes.select("entity_name", F.posexplode(_feed_tags(F.col("body"), F.col("base"))).alias("pos", "f"))
    named = named.select("entity_name", "f.url", F.struct(F.lit(0).alias("tier"), "pos").alias("at"), F.col("f.feed_type").alias("link_type"), F.col("f.title").alias("link_title"))
    content = feeds(good)
    found = named.join(content.hint("merge"), "url", "left").select(*named.columns, "feed_type", "title", "item_count")
    if probe:
        paths = F.array(*(F.struct(F.lit(n).alias("pos"), F.lit(path).alias("path")) for n, path in enumerate(fixed.FEED_PATHS)))
        held = content.withColumn("p", F.explode(F.filter(paths, lambda x: F.endswith("url", x["path"]))))
        held = held.withColumn("base", F.left("url", F.length("url") - F.length("p.path")))
        none = F.lit(None).cast("string")
        probed = bases.join(held.hint("merge"), "base").select("entity_name", "url", F.struct(F.lit(1).alias("tier"), "p.pos").alias("at"), none.alias("link_type"), none.alias("link_title"), "feed_type", "title", "item_count")
        found = found.unionByName(probed)
    found = found.groupBy("entity_name", "url").agg(F.min(F.struct("at", "link_type", "link_title", "feed_type", "title", "item_count")).alias("f")).select("entity_name", "url", "f.*")
    out = found.select("entity_name", "at", "url", F.coalesce("feed_type", "link_type", F.lit("unknown")).alias("feed_type"), T.or_else(F.col("link_title"), F.col("title")).alias("title"), F.coalesce("item_count", F.lit(0)).alias("item_count"))
    if most is not None:
        from pyspark.sql import Window

        out = out.withColumn("_n", F.row_number().over(Window.partitionBy("entity_name").orderBy("at", "url"))).where(F.col("_n") <= most)
    return out.select("entity_name", "url", "feed_type", "title", "item_count")


def _feed_tags(html, base):
    """array of (url, feed_type, title) of the feeds that a page names."""
    of = lambda tag, name: F.nullif(F.regexp_extract(tag, rf"""(?i){name}=["']([^"']+)["']""", 1), F.lit(""))

    def one(tag):
        kind, href = F.lower(of(tag, "type")), of(tag, "href")
        url = F.when(href.startswith("/"), F.concat(base, href)).when(href.startswith("http"), href).otherwise(F.concat(base, F.lit("/"), href))
        return F.struct(F.when(T.has_any(kind, ["rss", "atom", "xml"]), url).alias("url"), F.when(F.contains(kind, F.lit("atom")), "atom").otherwise("rss").alias("feed_type"), of(tag, "title").alias("title"))

    tags = F.regexp_extract_all(html, F.lit(r"""(?i)<link[^>]+rel=["']alternate["'][^>]*>"""), F.lit(0))
    return F.filter(F.transform(tags, one), lambda x: x["url"].isNotNull())


def api_items(payloads: DataFrame, fields: dict[str, list[str]], keywords: list[str] = (), exclude: list[str] = (), search_in: tuple = ("title", "snippet")) -> DataFrame:
    """payloads: (source, body JSON). Each field takes the first path that has a value; keywords must, exclusions mustn't be found."""
    out = payloads.select("*", *(T.or_else(*(F.get_json_object("body", p) for p in paths)).alias(f) for f, paths in fields.items()))
    if keywords:
        out = out.where(T.has_any(F.lower(T.strip_html(F.concat_ws(" ", *search_in))), [k.lower() for k in keywords]))
    return out.where(~T.has_any(F.lower("title"), [k.lower() for k in exclude])) if exclude else out


def synthetic_items(entities: DataFrame, n: int = 3, fail_entity: str = "") -> DataFrame:
    """n rows for each entity, or one error row for those whose name has fail_entity."""
    fails = F.contains(F.lower("entity_name"), F.lit(fail_entity.lower())) if fail_entity else F.lit(False)
    i = F.explode(F.when(fails, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.lit(n))))
    out = entities.select("entity_name", fails.alias("fails"), i.alias("i"))
    return out.select("entity_name", F.when(~F.col("fails"), F.concat(F.lit("https://"), F.regexp_replace(F.lower("entity_name"), f"{T.WS}+", "-"), F.lit(".example.com/page-"), F.col("i").cast("string"))).alias("url"), F.when(~F.col("fails"), F.concat("entity_name", F.lit(" \u2014 Page "), F.col("i").cast("string"))).alias("title"), F.when(F.col("fails"), F.concat(F.lit("Simulated failure for "), "entity_name")).alias("error"))

"""A company's pictures from its own pages: logo, team, products, awards. Several classes with caps in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import fixed_values as fixed
from lodestream.functions import text as T
from lodestream.functions import urls as U
from lodestream.operators.bundle import logo_score

_LINK = r"""(?i)<a\s[^>]*href\s*=\s*["']([^"'#][^"']*)["']"""


def resolve_media(href: Column, base: Column) -> Column:
    """A picture's or page's address without fragment; null for data and scripts. A root-relative one keeps its dots."""
    href = T.trim_ws(href)
    site = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+)", 1)
    out = (
        F.when((href == "") | href.startswith("data:") | href.startswith("javascript:"), F.lit(None)).when(href.rlike("^https?://"), href)
        .when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat(site, href)).otherwise(U.absolute(base, href))
    )
    return F.regexp_replace(out, "#.*$", "")


def _first(html: Column, *patterns: str) -> Column:
    return F.coalesce(*(F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in patterns))


def meta_content(html: Column, name: str) -> Column:
    a, b = rf"""property\s*=\s*["']{name}["']""", r"""content\s*=\s*["']([^"']+)["']"""
    return _first(html, f"(?i)<meta[^>]*{a}[^>]*{b}", f"(?i)<meta[^>]*{b}[^>]*{a}")


def link_href(html: Column, rel: str) -> Column:
    a, b = rf"""rel\s*=\s*["']{rel}["']""", r"""href\s*=\s*["']([^"']+)["']"""
    return _first(html, f"(?i)<link[^>]*{a}[^>]*{b}", f"(?i)<link[^>]*{b}[^>]*{a}")


def image_tags(html: Column, base: Column) -> Column:
    """array of (src, alt, cls, id, width, height) of a page's pictures that have an address."""
    of = lambda tag, name: F.regexp_extract(tag, rf"""(?i){name}\s*=\s*["']([^"']*?)["']""", 1)
    size = lambda tag, name: F.coalesce(F.nullif(F.regexp_extract(tag, rf"""(?i){name}\s*=\s*["']?(\d{{1,9}})""", 1), F.lit("")).cast("int"), F.lit(0))
    src = lambda tag: resolve_media(F.nullif(F.regexp_extract(tag, r"""(?i)src\s*=\s*["']([^"']+)["']""", 1), F.lit("")), base)
    one = lambda tag: F.struct(src(tag).alias("src"), of(tag, "alt").alias("alt"), of(tag, "class").alias("cls"), of(tag, "id").alias("id"), size(tag, "width").alias("width"), size(tag, "height").alias("height"))
    return F.filter(F.transform(F.regexp_extract_all(html, F.lit("(?i)<img[^>]*>"), F.lit(0)), one), lambda i: i["src"].isNotNull())


def _has(text: Column, words: str) -> Column:
    return text.rlike(f"(?i){words}")


def is_person(i: Column) -> Column:
    """By words of its texts, or an alternative text that begins with two capitalised words."""
    return _has(F.concat_ws(" ", i["alt"], i["cls"], i["id"]), fixed.PERSON_WORDS) | i["alt"].rlike("^[A-Z][a-z]+ [A-Z][a-z]+")


def _all(i: Column) -> Column:
    return F.concat_ws(" ", i["src"], i["alt"], i["cls"], i["id"])


def is_product(i: Column) -> Column:
    """By words, by width, or if nothing speaks against it where no width is given."""
    return _has(_all(i), fixed.PRODUCT_WORDS) | (i["width"] > 400) | ((i["width"] == 0) & ~is_person(i) & ~_has(_all(i), fixed.NO_PRODUCT_WORDS))


def is_award(i: Column) -> Column:
    return _has(_all(i), fixed.AWARD_WORDS)


def pages_to_fetch(homes: DataFrame, most: int = 8) -> DataFrame:
    """(entity_name, type, page, url): pages of the own domain that the homepage links to, by parts of their paths: so many of each type, `most` with the homepage. page: their order, from 1."""
    links = F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)), lambda h: resolve_media(h, F.col("url")))
    own = F.array_distinct(F.filter(links, lambda u: u.isNotNull() & (U.domain(u) == U.domain(F.col("url")))))
    path = lambda u: F.lower(F.regexp_extract(u, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1))

    def of(kind: str, parts: list[str], n: int) -> Column:
        chosen = F.slice(F.filter("own", lambda u: T.has_any(path(u), parts)), 1, n)
        return F.transform(chosen, lambda u: F.struct(F.lit(kind).alias("type"), u.alias("url")))

    typed = F.concat(*(of(kind, *x) for kind, x in fixed.MEDIA_PAGES.items()))
    out = homes.where("html != ''").withColumn("own", own).select("entity_name", F.posexplode(F.slice(typed, 1, most - 1)).alias("page", "p"))
    return out.select("entity_name", "p.type", (F.col("page") + 1).alias("page"), "p.url")


def company_media_of_pages(homes: DataFrame, snapshot: DataFrame, checked: DataFrame | None = None, most: int = 8) -> DataFrame:
    """(entity_name, logo_url, og_image_url, team_photo_count, screenshot_count, award_count, team_photos_json, screenshots_json, awards_json, all_logos_json, media_summary, status) of each company.

    homes: (entity_name, url, html); snapshot: (url, html), the pages that could be fetched; checked: (url), addresses that answered (None: all count). A null or empty homepage gives an empty row. Caps count repeated pictures, which are then left out; ties of logos go to the first. Both sides of the joins with pages and addresses are shuffled: their size is not known to Spark before they are there, so that it would broadcast them.
    """
    fetch = pages_to_fetch(homes, most)
    there = snapshot.where("html is not null").groupBy("url").agg(F.min("html").alias("html"))
    pages = fetch.join(there.hint("merge"), "url").select("entity_name", "type", "page", "url", "html")
    home = homes.where("html != ''").select("entity_name", F.lit("home").alias("type"), F.lit(0).alias("page"), "url", "html")
    images = home.unionByName(pages).select("entity_name", "type", "page", F.posexplode(image_tags(F.col("html"), F.col("url"))).alias("pos", "i"))
    i, on, sub = F.col("i"), lambda t: F.col("type") == t, F.col("type") != "home"
    large = ~(i["width"].between(1, 39) | _has(i["src"], fixed.SPACER_WORDS))
    logo = F.when(sub, _has(_all(i), "logo|brand")).otherwise(_has(_all(i), fixed.LOGO_WORDS))
    late = F.struct((F.col("type") == "home").alias("home"), "page", "pos")  # the homepage's awards come last
    classes = [("logo", logo, F.struct(F.lit(False).alias("home"), "page", "pos")), ("team", on("team") & large & is_person(i), late), ("products", on("products") & large & is_product(i), late), ("awards", (on("awards") & large | on("home")) & is_award(i), late)]
    score = logo_score(i["src"], i["alt"], i["cls"], i["id"], i["width"])
    found = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(k).alias("class"), o.alias("at"))) for k, c, o in classes)))
    rows = images.select("entity_name", F.explode(found).alias("f"), i["src"].alias("src"), score.alias("score")).select("entity_name", "f.class", "f.at", "src", "score")

    # one pass over the pictures for all classes: logos by score and each address once, the others by place
    cap = F.coalesce(*(F.when(F.col("class") == k, m) for k, m in fixed.MEDIA_CAPS.items()), F.lit(5))
    rows = rows.select("entity_name", "class", "src", F.struct(F.when(F.col("class") == "logo", -F.col("score")).otherwise(0).alias("s"), "at").alias("k")).repartition("entity_name", "class")
    again = F.row_number().over(Window.partitionBy("entity_name", "class", "src").orderBy("k"))
    n = F.row_number().over(Window.partitionBy("entity_name", "class").orderBy("k"))
    some = rows.withColumn("again", again).where("class != 'logo' or again = 1").withColumn("n", n).where(F.col("n") <= cap)
    some = some.groupBy("entity_name", "class", "src").agg(F.min("n").alias("n"))
    icon = F.coalesce(link_href(F.col("html"), "(?:shortcut )?icon"), link_href(F.col("html"), "apple-touch-icon"))
    extra = home.select("entity_name", F.inline(F.array(F.struct(F.lit("og").alias("class"), resolve_media(meta_content(F.col("html"), "og:image"), F.col("url")).alias("src")), F.struct(F.lit("icon").alias("class"), resolve_media(icon, F.col("url")).alias("src"))))).where("src is not null")
    kept = some.unionByName(extra.withColumn("n", F.lit(1)))
    ok = F.lit(True)
    if checked is not None:
        kept = kept.join(checked.select(F.col("url").alias("src")).distinct().withColumn("ok", F.lit(True)).hint("merge"), "src", "left")
        ok = F.coalesce("ok", F.lit(False))
    lists = F.array_sort(F.collect_list(F.struct("class", "n", "src", ok.alias("ok"))))  # 32 at most
    of = kept.groupBy("entity_name").agg(lists.alias("all"))
    fetched = fetch.groupBy("entity_name").agg(F.count("*").alias("fetched"), *(F.array_sort(F.collect_list(F.when(on(t), F.struct("page", "url")))).alias(t) for t in ("team", "products")))
    out = homes.select("entity_name", "url", (F.coalesce(F.col("html"), F.lit("")) != "").alias("there")).join(of, "entity_name", "left").join(fetched, "entity_name", "left")
    of_class = lambda k, good=True: F.coalesce(F.transform(F.filter("all", lambda x: (x["class"] == k) & (x["ok"] if good else F.lit(True))), lambda x: x["src"]), F.array().cast("array<string>"))
    first = lambda xs: F.get(xs, F.lit(0))
    out = out.select("entity_name", "url", "there", "fetched", "team", "products", *(of_class(k).alias(f"_{k}") for k in ("logo", "team", "products", "awards", "og", "icon")), of_class("logo", False).alias("_every"), F.when(F.size(of_class("logo", False)) > 0, first(of_class("logo"))).otherwise(first(of_class("icon"))).alias("logo"))
    paths = lambda c: F.array_join(F.transform(c, lambda x: F.regexp_extract(x["url"], r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1)), ", ")
    counted = lambda text, c: F.when(F.size(c) > 0, F.concat(F.lit(f"{text}: "), F.size(c).cast("string")))
    said = F.concat_ws("\n", F.concat(F.lit("Fetched "), (F.coalesce("fetched", F.lit(0)) + 1).cast("string"), F.lit(" pages from "), U.domain(F.col("url"))), F.concat(F.lit("Logo: "), "logo"), F.concat(F.lit("OG Image: "), first(F.col("_og"))), counted("Team photos", "_team"), counted("Product screenshots", "_products"), counted("Award images", "_awards"), counted("Logo variants", "_logo"), F.when(F.size("team") > 0, F.concat(F.lit("Team pages found: "), paths(F.col("team")))), F.when(F.size("products") > 0, F.concat(F.lit("Product pages found: "), paths(F.col("products")))))
    any_ = F.col("logo").isNotNull() | (F.size("_og") > 0) | (F.size("_team") > 0) | (F.size("_products") > 0) | (F.size("_awards") > 0)
    return out.select(
        "entity_name", F.coalesce("logo", F.lit("")).alias("logo_url"), F.coalesce(first(F.col("_og")), F.lit("")).alias("og_image_url"), F.size("_team").alias("team_photo_count"), F.size("_products").alias("screenshot_count"), F.size("_awards").alias("award_count"),
        F.to_json("_team").alias("team_photos_json"), F.to_json("_products").alias("screenshots_json"), F.to_json("_awards").alias("awards_json"), F.to_json("_logo").alias("all_logos_json"),
        F.when(F.col("there"), said).otherwise("No homepage URL available").alias("media_summary"), F.when(~any_, "no_media").when(F.col("logo").isNotNull(), "ok").otherwise("partial").alias("status"),
    )

"""The texts of an SEO plan: where its keywords go, its outline, meta data and questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions import text as T
from lodestream.operators.bundle import as_list

_WORDS = "array<string>"
_SECTION = f"heading: string, type: string, word_target: string, keywords: {_WORDS}"
_SUB = "array<struct<heading: string, word_target: string>>"
PLAN = (
    f"keyword_distribution struct<overview: struct<headline_keywords: {_WORDS}, body_keywords: {_WORDS}>, categories: array<struct<category_slug: string, category_tier: string, heading_keywords: {_WORDS}, body_keywords: {_WORDS}>>, "
    f"tags: array<struct<tag_slug: string, keywords: {_WORDS}>>, credentials: struct<keywords: {_WORDS}>, faq: struct<keywords: {_WORDS}>>, "
    f"content_outline array<struct<{_SECTION}, subheadings: {_SUB}, subsections: {_SUB}>>, "
    "meta struct<title: string, description: string, title_chars: int, description_chars: int>, "
    "faqs array<struct<question: string, answer: string, answer_brief: string, target_keyword: string>>, tone_notes string"
)


def _some(xs: Column) -> Column:
    return F.coalesce(F.size(xs) > 0, F.lit(False))


def _when(there: Column, *lines: Column) -> Column:
    return F.when(there, F.array(*lines)).otherwise(F.array().cast(_WORDS))


def _listed(head: str, xs: Column) -> Column:
    """A line of the words, if there are any, as an array."""
    return _when(_some(xs), F.concat(F.lit(head), F.array_join(xs, ", ")))


def _or(x: Column, other: str) -> Column:
    return F.coalesce(T.or_else(x), F.lit(other))


def distribution_text(d: Column) -> Column:
    """Keywords by place: overview, categories, tags, credentials and questions, those that are given."""
    category = lambda c: F.concat(F.array(F.concat(F.lit("  "), F.coalesce(c["category_slug"], F.lit("undefined")), F.lit(" ("), _or(c["category_tier"], "?"), F.lit("):"))), _listed("    Heading: ", c["heading_keywords"]), _listed("    Body: ", c["body_keywords"]))
    tag = lambda t: _when(_some(t["keywords"]), F.concat(F.lit("  "), F.coalesce(t["tag_slug"], F.lit("undefined")), F.lit(": "), F.array_join(t["keywords"], ", ")))
    part = lambda head, xs, make: F.when(_some(xs), F.concat(F.array(F.lit(""), F.lit(head)), F.flatten(F.transform(xs, make)))).otherwise(F.array().cast(_WORDS))
    end = lambda head, xs: F.when(_some(xs), F.concat(F.array(F.lit("")), _listed(head, xs))).otherwise(F.array().cast(_WORDS))
    overview = F.when(d["overview"].isNotNull(), F.concat(F.array(F.lit("Overview:")), _listed("  Headline: ", d["overview"]["headline_keywords"]), _listed("  Body: ", d["overview"]["body_keywords"]))).otherwise(F.array().cast(_WORDS))
    lines = F.concat(overview, part("Categories:", d["categories"], category), part("Tags:", d["tags"], tag), end("Credentials: ", d["credentials"]["keywords"]), end("FAQ: ", d["faq"]["keywords"]))
    return _or(F.array_join(lines, "\n"), "No keyword distribution generated")


def distribution_preview(d: Column) -> Column:
    """How many categories, tags and different keywords; those of credentials and questions don't count."""
    words = lambda xs: F.coalesce(xs, F.array().cast(_WORDS))
    every = F.concat(
        words(d["overview"]["headline_keywords"]), words(d["overview"]["body_keywords"]), words(F.flatten(F.transform(d["categories"], lambda c: F.concat(words(c["heading_keywords"]), words(c["body_keywords"]))))),
        words(F.flatten(F.transform(d["tags"], lambda t: words(t["keywords"])))),
    )
    count = lambda xs: F.greatest(F.coalesce(F.size(xs), F.lit(0)), F.lit(0)).cast("string")
    return F.concat(count(d["categories"]), F.lit(" categories, "), count(d["tags"]), F.lit(" tags, "), count(F.array_distinct(every)), F.lit(" unique keywords"))


def outline_text(outline: Column) -> Column:
    """A line for each section with its type, length and keywords, and one for each part of it."""
    subs = lambda s: F.coalesce(s["subheadings"], s["subsections"])
    sub = lambda x: F.concat(F.lit("  └ "), F.coalesce(x["heading"], F.lit("undefined")), F.lit(" ("), _or(x["word_target"], "?"), F.lit(" words)"))
    words = lambda s: F.when(_some(s["keywords"]), F.concat(F.lit(" — kw: "), F.array_join(s["keywords"], ", "))).otherwise("")
    kind = lambda s: F.coalesce(F.concat(F.lit(" ["), T.or_else(s["type"]), F.lit("]")), F.lit(""))
    line = lambda s: F.concat(F.coalesce(s["heading"], F.lit("undefined")), kind(s), F.lit(" ("), _or(s["word_target"], "?"), F.lit(" words)"), words(s))
    return _or(F.array_join(F.flatten(F.transform(outline, lambda s: F.concat(F.array(line(s)), F.coalesce(F.transform(subs(s), sub), F.array().cast(_WORDS))))), "\n"), "No outline generated")


def outline_preview(outline: Column, most: int = 4) -> Column:
    head = lambda s: T.trim_ws(F.concat(F.coalesce(s["heading"], F.lit("undefined")), F.lit(" "), F.coalesce(F.concat(F.lit("["), T.or_else(s["type"]), F.lit("]")), F.lit(""))))
    more = F.when(F.size(outline) > most, F.concat(F.lit(" (+"), (F.size(outline) - most).cast("string"), F.lit(")"))).otherwise("")
    return F.concat(F.array_join(F.slice(F.transform(outline, head), 1, most), ", "), more)


def seo_plan_texts(items: DataFrame) -> DataFrame:
    """items: (entity_name, plan JSON). A row each: the primary keyword and tiers, the distribution of keywords (or, of older plans, the outline) in full and in short, meta data with lengths, questions with what to answer, notes on tone."""
    p = items.select("entity_name", "plan", F.from_json("plan", PLAN).alias("p"))
    tier = lambda head, k: T.let(as_list(F.get_json_object("plan", f"$.target_keywords.{k}")), lambda xs: F.when(F.size(xs) > 0, F.concat(F.lit(head), F.array_join(xs, ", "))))
    primary = _or(F.get_json_object("plan", "$.target_keywords.primary"), "Not specified")
    d, outline, meta, faqs = F.col("p.keyword_distribution"), F.col("p.content_outline"), F.col("p.meta"), F.col("p.faqs")
    chosen = lambda of_d, of_outline: F.when(d.isNotNull(), of_d).when(outline.isNotNull(), of_outline).otherwise("")
    chars = lambda k: F.coalesce(F.nullif(meta[f"{k}_chars"], F.lit(0)), F.length(meta[k]), F.lit(0)).cast("string")
    line = lambda head, k: F.concat(F.lit(f"{head}: "), _or(meta[k], "Not generated"), F.lit(" ("), chars(k), F.lit(" chars)"))

    def asked(q: Column, i: Column) -> Column:
        keyword = F.coalesce(F.concat(F.lit("\nKeyword: "), T.or_else(q["target_keyword"])), F.lit(""))
        return F.concat(F.lit("Q"), (i + 1).cast("string"), F.lit(": "), F.coalesce(q["question"], F.lit("undefined")), F.lit("\nDirection: "), F.coalesce(T.or_else(q["answer_brief"], q["answer"]), F.lit("")), keyword)

    return p.select(
        "entity_name", primary.alias("primary_keyword"), chosen(distribution_preview(d), outline_preview(outline)).alias("keyword_plan_preview"), F.coalesce(meta["title"], F.lit("")).alias("meta_title"), F.coalesce(F.greatest(F.size(faqs), F.lit(0)), F.lit(0)).alias("faq_count"),
        F.concat_ws("\n", F.concat(F.lit("Primary: "), primary), tier("Secondary: ", "secondary"), tier("Long-tail: ", "long_tail")).alias("keywords_text"), chosen(distribution_text(d), outline_text(outline)).alias("keyword_distribution_text"),
        F.concat(line("Title", "title"), F.lit("\n"), line("Description", "description")).alias("meta_text"), _or(F.array_join(F.transform(faqs, asked), "\n\n"), "No FAQs generated").alias("faqs_text"), F.coalesce("p.tone_notes", F.lit("")).alias("tone_notes"),
    )

"""Around a model's calls: what is asked, and rows of what is answered. Answers are rows of a response table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import fixed_values as fixed
from lodestream.functions import text as T
from lodestream.operators import bundle

BOUNDARY = "\n\n---SOURCE BOUNDARY---\n\n"


def _before(size: Column, *order: str) -> Column:
    """The running total of what stands before a row of its entity."""
    return F.coalesce(F.sum(size).over(Window.partitionBy("entity_name").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _soonest(rows: DataFrame, most: int, *order: str) -> DataFrame:
    """The first `most` rows of each entity: no more can come before the cut, so the running total is over few rows however many an entity has. Up to spark.sql.optimizer.windowGroupLimitThreshold rows (1,000 unless set) Spark takes them in each task before the shuffle."""
    n = F.row_number().over(Window.partitionBy("entity_name").orderBy(*order))
    return rows.withColumn("_n", n).where(F.col("_n") <= most).drop("_n")


def assemble_sources(items: DataFrame, most: int = 100_000, least: int = 100) -> DataFrame:
    """(entity_name, source_text): texts in pool order with boundaries between them, up to `most` characters; of the first that doesn't fit the beginning, if more than `least` characters are left. Rows beyond the limit go before anything is gathered."""
    rows = items.where("text_content != ''").select("entity_name", "pool_pos", "text_content", F.length("text_content").alias("n"))
    order = "pool_pos", "text_content"
    rows = _soonest(rows, most // (len(BOUNDARY) + 1) + 2, *order)  # a text has a character at least
    before = _before(F.col("n") + len(BOUNDARY), *order)
    rows = rows.withColumn("start", F.greatest(before - len(BOUNDARY), F.lit(0))).where(F.col("start") <= most)
    whole = F.concat(F.when(F.col("start") > 0, BOUNDARY).otherwise(""), "text_content")
    left = F.lit(most) - F.col("start")
    part = F.when(F.length(whole) <= left, whole).when(left > least, F.concat(F.left(whole, left.cast("int")), F.lit("\n[TRUNCATED]"))).otherwise("")
    rows = rows.select("entity_name", "start", part.alias("part"))
    return rows.groupBy("entity_name").agg(F.array_join(F.array_sort(F.collect_list(F.struct("start", "part")))["part"], "").alias("source_text"))


def assemble_pages(items: DataFrame, most: int = 100_000, what: str = "Content") -> DataFrame:
    """(entity_name, entity_content, word_count): each page under a header, cut at `most` characters with a note; pages whose separator begins beyond the cut go before anything is gathered. Repeated positions stand in the order of their pages."""
    page = F.concat(F.lit("--- Page: "), F.coalesce(F.nullif("title", F.lit("")), F.lit("Untitled")), F.lit(" ("), F.coalesce(F.nullif("url", F.lit("")), F.lit("unknown")), F.lit(") ---\n"), F.coalesce("text_content", F.lit("")))
    rows = items.select("entity_name", "pool_pos", page.alias("page"), F.coalesce("word_count", F.lit(0)).alias("word_count"))
    words = rows.groupBy("entity_name").agg(F.sum("word_count").alias("word_count"))
    order = "pool_pos", "page"
    rows = _soonest(rows, most // (len("--- Page: Untitled () ---") + 2) * 2 + 2, *order)  # a page has its header at least
    rows = rows.withColumn("start", _before(F.length("page") + 2, *order)).where(F.col("start") - 2 <= most)  # one that begins just behind the cut shows that there is more
    out = rows.groupBy("entity_name").agg(F.array_join(F.array_sort(F.collect_list(F.struct("pool_pos", "page")))["page"], "\n\n").alias("all"))
    cut = F.when(F.length("all") > most, F.concat(F.left("all", F.lit(most)), F.lit(f"\n\n[{what} truncated at {most} characters]"))).otherwise(F.col("all"))
    return out.select("entity_name", cut.alias("entity_content")).join(words, "entity_name")


def build_prompt(template: str, content: Column, docs: dict[str, str] | None = None) -> Column:
    """The template with the content and the named documents put in; other {doc:...} marks go."""
    out = F.replace(F.lit(template), F.lit("{entity_content}"), content)
    for name, text in (docs or {}).items():
        out = F.replace(out, F.lit(f"{{doc:{name}}}"), F.lit(text))
    return F.regexp_replace(out, r"\{doc:[^}]+\}", "")


def analyses(responses: DataFrame, model: str) -> DataFrame:
    """responses: (entity_name, text, word_count). A row for each answer, however many an entity has: the analysis, flat and as JSON, or an error where the answer holds no JSON object."""
    parsed = responses.withColumn("analysis", T.model_json(F.col("text")))
    good = bundle.analysis_flat(parsed.where("analysis is not null"), "analysis", "word_count")
    texts = [c for c in good.columns if c not in ("entity_name", "analysis", "word_count")]
    good = good.select("entity_name", F.lit("analyzed").alias("status"), *texts, F.col("word_count").cast("bigint").alias("word_count"), F.lit(model).alias("model_used"), F.col("analysis").alias("analysis_json"), F.lit(None).cast("string").alias("error"))
    bad = parsed.where("analysis is null").select("entity_name", F.lit("error").alias("status"), *(F.lit("").alias(c) for c in texts), F.lit(0).cast("bigint").alias("word_count"), F.lit(model).alias("model_used"), F.lit(None).cast("string").alias("analysis_json"), F.lit("no JSON object in the answer").alias("error"))
    return good.unionByName(bad)


def plans(responses: DataFrame) -> DataFrame:
    """responses: (entity_name, text). A row for each answer, however many an entity has: the SEO plan, flat and as JSON, with warnings on its meta lengths and its own, or an error where the answer holds no JSON object."""
    parsed = responses.select("entity_name", T.model_json(F.col("text")).alias("plan"))
    good = bundle.seo_plan_flat(parsed.where("plan is not null"), "plan")
    own = F.array_join(bundle.as_list(F.get_json_object("plan", "$.warnings")), "\n")
    good = good.withColumn("warnings", F.concat_ws("\n", F.nullif("warnings", F.lit("")), F.nullif(own, F.lit(""))))
    good = good.select("entity_name", F.lit("planned").alias("status"), "primary_keyword", "keywords_text", "faq_count", "warnings", F.lit("").alias("error"), F.col("plan").alias("seo_plan_json"))
    empty = [F.lit("").alias(c) for c in ("primary_keyword", "keywords_text")]
    return good.unionByName(parsed.where("plan is null").select("entity_name", F.lit("error").alias("status"), *empty, F.lit(0).alias("faq_count"), F.lit("").alias("warnings"), F.lit("no JSON object in the answer").alias("error"), F.lit(None).cast("string").alias("seo_plan_json")))


def writer_content(analysis: Column, plan: Column, sources: Column) -> Column:
    """What an article is written from: the analysis and the plan as JSON, and the sources' text."""
    heads = fixed.WRITER_SECTIONS
    return F.concat(F.lit(f"{heads[0]}\n"), analysis, F.lit(f"\n\n{heads[1]}\n"), plan, F.lit(f"\n\n{heads[2]}\n"), sources)


def article_requests(items: DataFrame, template: str, docs: dict[str, str] | None = None, most: int = 100_000) -> DataFrame:
    """(entity_name, prompt, meta_title, source_pages, error) of each entity: the prompt of its article, or an error that names what is missing.

    items: (entity_name, pool_pos, source_submodule, url, title, text_content, output JSON, meta_title). The last analysis and
    the last plan count; all other rows with a text are sources, in pool order under their headers and cut at `most`
    characters. Sources are not needed. Repeated pool positions stand in the order of their pages' texts.
    """
    analyzer, planner = fixed.WRITER_NEEDS
    by = F.coalesce("source_submodule", F.lit(""))
    last = lambda m: F.max_by(F.struct("output", "meta_title"), F.when(by == m, F.struct("pool_pos", "output")))
    is_source = ~by.isin(analyzer, planner) & (F.col("text_content") != "")
    told = items.groupBy("entity_name").agg(F.max(by == analyzer).alias("analyzed"), last(analyzer)["output"].alias("analysis"), F.max(by == planner).alias("planned"), last(planner).alias("plan"), F.count_if(is_source).alias("source_pages"))
    sources = assemble_pages(items.where(is_source).select("entity_name", "pool_pos", "url", "title", "text_content", F.lit(0).alias("word_count")), most, "Source content").drop("word_count")
    missing = F.array_compact(F.array(F.when(~F.col("analyzed"), analyzer), F.when(~F.col("planned"), planner)))
    error = F.when(F.size(missing) > 0, F.format_string(fixed.WRITER_MISSING, F.array_join(missing, ", ")))
    rows = told.withColumn("error", error).join(sources, "entity_name", "left")
    text = writer_content(F.coalesce("analysis", F.lit("{}")), F.coalesce("plan.output", F.lit("{}")), F.coalesce("entity_content", F.lit("")))
    title = F.coalesce(T.or_else(F.get_json_object("plan.output", "$.meta.title"), F.col("plan.meta_title")), F.col("entity_name"))
    return rows.select("entity_name", F.when(F.col("error").isNull(), build_prompt(template, text, docs)).alias("prompt"), F.when(F.col("error").isNull(), title).otherwise("").alias("meta_title"), "source_pages", F.coalesce("error", F.lit("")).alias("error"))


def written(responses: DataFrame) -> DataFrame:
    """responses: (entity_name, text, meta_title, error). A row for each article: its counts, whether it cites, a preview; an error row where there is no text."""
    text = F.coalesce("text", F.lit(""))
    cites = text.rlike(r"\[#\d+\]") | text.rlike(r"\[.*?\]\(https?://.*?\)") | F.contains(text, F.lit("(Source:"))
    there = F.col("text").isNotNull()
    return responses.select(
        "entity_name", F.when(there, "written").otherwise("error").alias("status"), T.word_count(text).alias("word_count"), F.regexp_count(text, F.lit(r"(?m)^#{2,3}\s+")).alias("section_count"), cites.alias("has_citations"),
        F.when(there, F.coalesce(F.nullif("meta_title", F.lit("")), "entity_name")).otherwise("").alias("meta_title"), T.preview(text, 300).alias("content_preview"), text.alias("content_markdown"), F.when(there, "").otherwise(F.coalesce("error", F.lit("no answer"))).alias("error"),
    )


def claims(articles: DataFrame, batch: int = 10, longest: int = 200) -> DataFrame:
    """(entity_name, pos, batch, idx, claim): factual claims in the order of the text, in batches; long ones are cut."""
    found = F.filter(T.split_sentences(F.col("markdown"), 15, citations=False), T.is_fact)
    short = F.when(F.length("claim") > longest, F.concat(F.left("claim", F.lit(longest - 3)), F.lit("..."))).otherwise(F.col("claim"))
    out = articles.select("entity_name", F.posexplode_outer(found).alias("pos", "claim")).where("pos is not null")
    return out.select("entity_name", "pos", F.floor(F.col("pos") / batch).cast("int").alias("batch"), (F.col("pos") % batch).cast("int").alias("idx"), short.alias("claim"))


def zip_verdicts(claims: DataFrame, responses: DataFrame) -> DataFrame:
    """Verdicts matched to claims by their position in the batch's answer, a JSON array, bare, fenced or within other text. A claim without one is unsupported. responses: (entity_name, batch, text)."""
    body = F.regexp_extract("text", r"(?s)(\[.*\])", 1)
    given = responses.select("entity_name", "batch", F.posexplode_outer(F.from_json(body, "array<struct<verdict: string, quote: string, severity: string>>")).alias("idx", "v")).where("idx is not null")
    out = claims.join(given, ["entity_name", "batch", "idx"], "left")
    return out.select("entity_name", "pos", "claim", F.coalesce(F.nullif("v.verdict", F.lit("")), F.lit("unsupported")).alias("verdict"), F.col("v.quote").alias("quote"), F.coalesce(F.nullif("v.severity", F.lit("")), F.lit("medium")).alias("severity"))


def occurrences(text: Column, needle: Column) -> Column:
    """How often a text stands in another, in any case and inside words too, without overlaps."""
    low, part = F.lower(text), F.lower(needle)
    return F.when(part == "", 0).otherwise(F.size(F.split(low, T.escape_regex(part))) - 1)


def placements(markdown: Column, keywords: Column) -> Column:
    """array of (keyword, locations): whether each stands in a heading of level 1 or 2, in the first line below such a heading that is none itself, or else in the text. Those that stand nowhere are left out."""
    lines = F.transform(F.split(markdown, "\n"), lambda x: F.lower(T.trim_ws(x)))

    def of(ls: Column) -> Column:
        is_head = lambda x: x.rlike(r"^#{1,2}\s+")
        plain = lambda x: (x != "") & ~x.rlike(r"^#{1,6}\s+")
        # backwards, the next plain line of each line
        back = F.aggregate(F.reverse(ls), F.struct(F.lit("").alias("next"), F.array().cast("array<string>").alias("first")), lambda s, x: F.struct(F.when(plain(x), x).otherwise(s["next"]).alias("next"), F.when(is_head(x) & (s["next"] != ""), F.concat(s["first"], F.array(s["next"]))).otherwise(s["first"]).alias("first")))
        heads = F.array_join(F.filter(ls, is_head), "\n")
        firsts = F.array_join(back["first"], "\n")

        def one(k: Column) -> Column:
            low = F.lower(k)
            head, first = F.contains(heads, low), F.contains(firsts, low)
            places = F.array_compact(F.array(F.when(head, "heading"), F.when(first, "first_paragraph"), F.when(~head & ~first & F.contains(F.lower(markdown), low), "body")))
            return F.struct(k.alias("keyword"), places.alias("locations"))

        return F.filter(F.transform(keywords, one), lambda x: F.size(x["locations"]) > 0)

    return T.let(lines, of)


def target_keywords(plan: Column) -> Column:
    """All keywords of a plan of either shape, in order and once each: primary, secondary, long tail. plan: JSON."""
    get = lambda path: bundle.as_list(F.get_json_object(plan, f"$.{path}"))
    return F.array_distinct(F.concat(*(get(f"{a}.{b}") for b, c in (("primary", "head_terms"), ("secondary", "mid_tail"), ("long_tail", "long_tail")) for a, b in (("target_keywords", b), ("keywords_used", c)))))


def revised(texts: DataFrame, style: str = "professional") -> DataFrame:
    """texts: (entity_name, original, answer, keywords array<string>). The answer without fences; changed lines; keyword occurrences, also inside words, and word counts before and after; where the keywords stand now; a summary and a preview."""
    text = F.regexp_replace(F.regexp_replace("answer", r"^```(?:markdown|md)?\s*\n?", ""), r"\n?```\s*$", "")
    out = texts.withColumn("revised", text).withColumn("o", F.split("original", "\n")).withColumn("r", F.split("revised", "\n"))
    changed = F.size(F.filter(F.sequence(F.lit(0), F.greatest(F.size("o"), F.size("r")) - 1), lambda i: ~T.trim_ws(F.coalesce(F.get("o", i), F.lit(""))).eqNullSafe(T.trim_ws(F.coalesce(F.get("r", i), F.lit(""))))))
    times = lambda c: F.aggregate(F.transform("keywords", lambda k: occurrences(F.col(c), k)), F.lit(0), lambda a, x: a + x)
    out = out.select("entity_name", "revised", changed.alias("lines_changed"), times("original").alias("keywords_before"), times("revised").alias("keywords_after"), T.word_count(F.col("original")).alias("words_before"), T.word_count(F.col("revised")).alias("words_after"), F.size("keywords").alias("n"), placements(F.col("revised"), F.col("keywords")).alias("placed"))
    text_of = F.array_join(F.transform("placed", lambda p: F.concat(p["keyword"], F.lit(": "), F.array_join(p["locations"], ", "))), "\n")
    more = F.col("words_after") - F.col("words_before")
    said = F.format_string(f"%d lines changed | %d/%d target keywords placed | keyword occurrences: %d -> %d | word count: %d -> %d (%s%d) | tone style: {style}", "lines_changed", F.size("placed"), "n", "keywords_before", "keywords_after", "words_before", "words_after", F.when(more >= 0, "+").otherwise(""), more)
    return out.select("entity_name", "revised", "lines_changed", "keywords_before", "keywords_after", "words_before", "words_after", F.size("placed").alias("keywords_placed"), F.when(F.size("placed") == 0, "No keyword placements detected.").otherwise(text_of).alias("placements_text"), said.alias("revision_summary"), T.preview(F.col("revised"), 300).alias("content_preview"))


def plain_dashes(text: Column) -> Column:
    """Long dashes as hyphens; on JSON text it reaches all of its strings."""
    return F.translate(text, "\u2013\u2014", "--")

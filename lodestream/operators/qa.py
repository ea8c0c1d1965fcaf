"""Quality checks of written articles, and routing by their verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import text as T


def citation_coverage(articles: DataFrame, threshold: float = 0.7) -> DataFrame:
    """articles: (entity_name, markdown, sources array<int>). valid / (valid + uncited claims + broken)."""
    found = T.refs(F.col("markdown"))
    uncited = F.filter(T.split_sentences(F.col("markdown")), lambda s: T.is_claim(s) & ~s.rlike(r"\[#\d+\]"))
    out = articles.select("entity_name", found.alias("refs"), F.array_distinct("sources").alias("sources"), F.coalesce(F.size(uncited), F.lit(0)).alias("uncited_claims_count"), (F.trim("markdown") != "").alias("there"))
    valid, broken = F.size(F.array_intersect("refs", "sources")), F.size(F.array_except("refs", "sources"))
    total = valid + broken + F.col("uncited_claims_count")
    score = F.when((F.size("refs") == 0) | ~F.coalesce("there", F.lit(False)), 0.0).otherwise(T.js_round(valid / total, 3)).cast("double")
    return out.select("entity_name", (score >= threshold).alias("qa_pass"), score.alias("citation_score"), F.size("refs").alias("citation_count"), F.size("sources").alias("source_count"), "uncited_claims_count", broken.alias("broken_citations_count"))


def broken_citations(articles: DataFrame) -> DataFrame:
    """References without a source, one a row."""
    return articles.select("entity_name", F.explode(F.array_except(T.refs(F.col("markdown")), F.col("sources"))).alias("ref"))


PLAN = (
    "meta struct<title string, description string>, faqs array<struct<question string, answer string, q string, a string>>, keywords array<string>, head_terms array<string>, negatives array<string>, "
    "target_keywords struct<primary string, secondary array<string>, long_tail array<string>>, "
    "keywords_used struct<head_terms array<string>, mid_tail array<string>, entities array<string>, negatives array<string>>, "
    "keyword_distribution struct<overview struct<headline_keywords array<string>, body_keywords array<string>>, categories array<struct<heading_keywords array<string>, body_keywords array<string>>>>"
)


def _terms(*lists) -> F.Column:
    """Distinct terms of the lists in order, trimmed and lower; null lists and empty terms are left out."""
    some = F.flatten(F.filter(F.array(*lists), lambda x: x.isNotNull()))
    return F.array_distinct(F.filter(F.transform(some, lambda k: F.lower(T.trim_ws(k))), lambda k: k.isNotNull() & (k != "")))


def plan_keywords(plan) -> F.Column:
    """head, mid, entities and negatives of an SEO plan (a struct of PLAN), whatever its shape."""
    used, target, spread = plan["keywords_used"], plan["target_keywords"], plan["keyword_distribution"]
    of_categories = F.flatten(F.transform(spread["categories"], lambda c: F.concat(F.coalesce(c["heading_keywords"], F.array().cast("array<string>")), F.coalesce(c["body_keywords"], F.array().cast("array<string>")))))
    head = _terms(used["head_terms"], F.array(target["primary"]), spread["overview"]["headline_keywords"], plan["head_terms"])
    mid = _terms(used["mid_tail"], target["secondary"], target["long_tail"], spread["overview"]["body_keywords"], of_categories)
    return F.struct(head.alias("head"), mid.alias("mid"), _terms(used["entities"]).alias("entities"), _terms(used["negatives"], plan["negatives"]).alias("negatives"))


def keyword_sufficiency(articles: DataFrame, low: float = 0.01, high: float = 0.03, threshold: float = 0.6) -> DataFrame:
    """articles: (id, markdown, plan JSON). Head terms by place (H1, H2, first paragraphs, title) and density, mid-tail by H2, H3 and body, entities by body, negatives anywhere. Weights 0.4, 0.25, 0.15 and 0.2 over the tiers that are there."""
    out = articles.select("id", T.markdown_sections(F.col("markdown")).alias("s"), plan_keywords(F.from_json("plan", PLAN)).alias("k"))
    join = lambda by, *parts: F.lower(F.concat_ws(by, *parts))
    out = out.select("id", "k.*", F.col("s.body").alias("text"), F.col("s.word_count").alias("words"), F.lower("s.body").alias("body"), join("\n", "s.h1", "s.h2", "s.first_paragraphs", "s.title").alias("prominent"), join("\n", "s.h2", "s.h3", "s.body").alias("below"), join(" ", "s.h1", "s.h2", "s.h3", "s.body", "s.title", "s.description").alias("whole"))
    has = lambda where: lambda k: F.contains(where, k)

    def head_score(k):
        place = F.when(F.contains("prominent", k), 1.0).when(F.contains("body", k), 0.5).otherwise(0.0)
        density = T.count_occurrences(F.col("text"), k) / F.col("words")
        return place * 0.6 + T.let(density, lambda d: F.when((F.col("words") == 0) | (d == 0), 0.0).when(d < low, 0.5).when(d <= high, 1.0).otherwise(0.3)) * 0.4

    mean = lambda scores: F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores)
    found, need = F.size(F.filter("mid", has("below"))), F.least(F.lit(2), F.size("mid"))
    mid = F.when(found >= need, found / F.size("mid")).otherwise(found / need * 0.5)
    share = F.size(F.filter("entities", has("body"))) / F.size("entities")
    tiers = [("head", 0.4, mean(F.transform("head", head_score))), ("mid", 0.25, mid), ("entities", 0.15, share), ("negatives", 0.2, F.when(F.exists("negatives", has("whole")), 0.0).otherwise(1.0))]
    weight = sum((F.when(F.size(c) > 0, w).otherwise(0.0) for c, w, _ in tiers), F.lit(0.0))
    total = sum((F.when(F.size(c) > 0, s * w).otherwise(0.0) for c, w, s in tiers), F.lit(0.0))
    score = F.when(weight == 0, 1.0).otherwise(T.js_round(total / weight, 2)).cast("double")
    missing = F.size(F.filter("head", lambda k: ~F.contains("prominent", k) & ~F.contains("body", k))) + F.size(F.filter("mid", lambda k: ~F.contains("below", k))) + F.size(F.filter("entities", lambda k: ~F.contains("body", k)))
    return out.select("id", score.alias("keyword_score"), missing.alias("n_missing"), F.size(F.filter("negatives", has("whole"))).alias("n_negatives")).select("id", (F.col("keyword_score") >= threshold).alias("qa_pass"), "keyword_score", "n_missing", "n_negatives")


def resolve_meta(pool: DataFrame) -> DataFrame:
    """(entity_name, title, description, head_terms). Of an entity's rows in pool order: fields of their own, front matter, the first H1 or paragraph, the SEO plan. pool: (entity_name, pool_pos, meta_title, meta_description, content_markdown, seo_plan JSON)."""
    plan, md = F.from_json("seo_plan", PLAN), F.col("content_markdown")
    front = T.front_matter(md)
    levels = {
        "title": [F.col("meta_title"), T.front_field(front, "title"), T.first_h1(md), F.col("p.meta.title")],
        "description": [F.col("meta_description"), T.front_field(front, "description"), T.first_paragraph(md), F.col("p.meta.description")],
    }
    rows = pool.withColumn("p", plan)
    terms = _terms(F.col("p.head_terms"), F.array("p.target_keywords.primary"), F.col("p.target_keywords.secondary"), F.col("p.keywords"))
    rows = rows.select("entity_name", "pool_pos", F.when(F.size(terms) > 0, terms).alias("terms"), *(F.nullif(c, F.lit("")).alias(f"{name}{i}") for name, cs in levels.items() for i, c in enumerate(cs)))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("pool_pos")))
    return rows.groupBy("entity_name").agg(*(F.coalesce(*(first(f"{name}{i}") for i in range(4))).alias(name) for name in levels), F.coalesce(first("terms"), F.array().cast("array<string>")).alias("head_terms"))


def meta_compliance(items: DataFrame, title_max: int = 60, title_min: int = 30, desc_min: int = 150, desc_max: int = 160, threshold: float = 1.0) -> DataFrame:
    """items: (entity_name, title, description, head_terms). Seven checks; titles and descriptions must differ from other entities'. Without either text nothing is checked."""
    out = items.withColumns({c: F.coalesce(c, F.lit("")) for c in ("title", "description")})
    for c in ("title", "description"):  # by the least and greatest name, not by all names of a text
        many = out.where(F.col(c) != "").groupBy(F.lower(c).alias(f"_{c}")).agg(F.min("entity_name").alias("_lo"), F.max("entity_name").alias("_hi")).where("_lo != _hi").select(f"_{c}", F.lit(True).alias(f"{c}_again"))
        out = out.withColumn(f"_{c}", F.lower(c)).join(many, f"_{c}", "left")
    has = lambda c: F.exists("head_terms", lambda k: F.contains(F.lower(c), k))
    cut = lambda c: F.col(c).endswith("...") | F.col(c).endswith("\u2026")
    checks = [F.length("title") <= title_max, F.length("title") >= title_min, F.length("description").between(desc_min, desc_max), has("title"), has("description"), ~(cut("title") | cut("description")), F.col("title_again").isNull() & F.col("description_again").isNull()]
    there = (F.col("title") != "") | (F.col("description") != "")
    passed = F.when(there, sum((F.coalesce(c, F.lit(False)).cast("int") for c in checks), F.lit(0))).otherwise(0)
    return out.select("entity_name", passed.alias("checks_passed"), F.when(there, len(checks)).otherwise(0).alias("checks_total"), (there & (passed / len(checks) >= threshold)).alias("qa_pass"))


def hallucination_score(verdicts: DataFrame, threshold: float = 0.9) -> DataFrame:
    """verdicts: (entity_name, verdict). (supported + partial / 2) / total."""
    points = F.sum(F.when(F.col("verdict") == "supported", 1.0).when(F.col("verdict") == "partial", 0.5).otherwise(0.0))
    out = verdicts.groupBy("entity_name").agg(F.count("*").alias("total_claims"), F.count_if(F.col("verdict") == "supported").alias("verified_claims"), points.alias("points"))
    score = T.js_round(F.col("points") / F.col("total_claims"), 3).cast("double")
    return out.select("entity_name", (score >= threshold).alias("qa_pass"), score.alias("hallucination_score"), "verified_claims", "total_claims")


def verify_claims(claims: DataFrame, sources: DataFrame, n: int = 5, full: float = 0.8, part: float = 0.4) -> DataFrame:
    """A model-free verifier: the share of a claim's n-grams that stand in some source. claims: (claim_id, claim); sources: (text). Joined by n-gram."""
    def grams(c: str):
        at = lambda w: F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1)))
        words = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
        return T.let(words, lambda w: F.array_distinct(F.transform(at(w), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))))

    of = claims.select("claim_id", F.explode(grams("claim")).alias("g"))
    there = sources.select(F.explode(grams("text")).alias("g")).join(of.select("g").distinct(), "g", "left_semi").distinct().withColumn("hit", F.lit(1))
    out = of.join(there, "g", "left").groupBy("claim_id").agg((F.count("hit") / F.count("*")).alias("share"))
    return out.select("claim_id", F.when(F.col("share") >= full, "supported").when(F.col("share") >= part, "partial").otherwise("unsupported").alias("verdict"))


def route(verdicts: DataFrame, max_loops: int = 3, min_sources: int = 8, without_checks: str = "flag_manual") -> DataFrame:
    """verdicts: (entity_name, hallucination_ok, citation_ok, keyword_ok, meta_ok, source_count, loop_count). The first rule that holds decides."""
    names = ["hallucination", "citation", "keyword", "meta"]
    failed = F.filter(F.array(*(F.when(~F.col(f"{n}_ok"), n) for n in names)), lambda x: x.isNotNull())
    ran = F.coalesce(*(F.col(f"{n}_ok") for n in names)).isNotNull()
    few = F.when(F.col("source_count") < min_sources, "flag_manual").otherwise("loop_discovery")
    one = lambda n: F.array_contains(failed, n)
    decision = (
        F.when(F.col("source_count") == 0, "failed").when(~ran, without_checks).when(F.col("loop_count") >= max_loops, "failed").when(F.size(failed) >= 2, "flag_manual")
        .when(one("hallucination") | one("citation"), few).when(one("keyword"), "loop_tone").when(one("meta"), "loop_generation").otherwise("approve")
    )
    reason = F.when(F.col("source_count") == 0, "dead_site").when(ran & (F.col("loop_count") >= max_loops), "max_loops_exceeded")
    return verdicts.select("entity_name", decision.alias("decision"), reason.alias("failure_reason"), F.array_join(failed, ",").alias("failed_checks"))


def circuit_breaker(calls: DataFrame, by: str, order: str, ok: str, limit: int = 3) -> DataFrame:
    """Marks what follows `limit` failures in a row as aborted: gaps and islands within each `by`."""
    seq = Window.partitionBy(by).orderBy(order)
    out = calls.withColumn("_run", F.sum(F.col(ok).cast("int")).over(seq))
    out = out.withColumn("_streak", F.sum((~F.col(ok)).cast("int")).over(Window.partitionBy(by, "_run").orderBy(order)))
    opened = F.max(F.when(F.col("_streak") >= limit, 1).otherwise(0)).over(seq.rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("aborted", F.coalesce(opened, F.lit(0)) == 1).drop("_run", "_streak")

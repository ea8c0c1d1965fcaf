"""Filtering of page texts: one CASE per row where a row decides, windows and grouped counts where others do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import fixed_values as fixed
from lodestream.functions import text as T


def content_filter(items: DataFrame, min_words: int = 50, drop_errors: bool = True, english: bool = True) -> DataFrame:
    """filter_status and filter_reason; the first rule that hits decides. items: (doc_id, text_content, status, url, title)."""
    words = T.word_count(F.col("text_content"))
    rules = []
    if drop_errors:
        rules.append((F.col("status").isin("error", "skipped"), F.concat(F.lit("Scrape failed: "), F.col("status"))))
    rules.append((words < min_words, F.concat(F.lit("Too short: "), words.cast("string"), F.lit(f" words (min {min_words})"))))
    if english:
        rules.append((~T.is_english(F.col("text_content")), F.lit("Non-English content")))
    rules += [(F.contains(F.lower("url"), F.lit(p)), F.lit(f"URL pattern: {p}")) for p in fixed.EXCLUDED_URLS]
    rules += [(F.contains(F.lower("title"), F.lit(k)), F.lit(f"Title keyword: {k}")) for k in fixed.EXCLUDED_TITLES]
    reason = F.coalesce(*(F.when(F.coalesce(c, F.lit(False)), r) for c, r in rules))
    return items.select("doc_id", F.when(reason.isNull(), "kept").otherwise("excluded").alias("filter_status"), reason.alias("filter_reason"))


def demote_duplicates(items: DataFrame, least: int = 3, scope: str | None = None) -> DataFrame:
    """Successful pages whose text stands on `least` or more, in all or within one scope, are low content wherever they stand; other statuses stay as they are. Grouped by digest, so that no text is shuffled."""
    text = T.trim_ws(F.col("text_content"))
    keyed = items.withColumn("h", F.when((F.col("status") == "success") & (text != ""), F.sha2(text, 256)))
    often = keyed.where("h is not null").groupBy("h", *([scope] if scope else [])).agg(F.count("*").alias("n")).where(F.col("n") >= least).select("h").distinct().withColumn("often", F.lit(True))
    out = keyed.select("doc_id", "status", "h").join(often, "h", "left")
    return out.select("doc_id", F.when(F.col("often"), "low_content").otherwise(F.col("status")).alias("status"))


def blocks(items: DataFrame, separator: str = r"\n\s*\n") -> DataFrame:
    """(entity_name, doc_id, pos, block, norm)."""
    out = items.select("entity_name", "doc_id", F.posexplode_outer(T.split_blocks(F.col("text_content"), separator)).alias("pos", "block")).where("pos is not null")
    return out.withColumn("norm", T.normalize_block(F.col("block")))


def _pages_of_blocks(items: DataFrame, separator: str) -> DataFrame:
    """items with `bs`: each block, its normal form, and that one's 64-bit hash."""
    both = F.transform(T.split_blocks(F.col("text_content"), separator), lambda b: F.struct(b.alias("block"), T.normalize_block(b).alias("norm")))
    return items.withColumn("bs", F.transform(both, lambda x: F.struct(x["block"].alias("block"), x["norm"].alias("norm"), F.xxhash64(x["norm"]).alias("h"))))


def _frequent(pages: DataFrame, threshold: float, min_block: int) -> DataFrame:
    """(entity_name, h, n, norm): by hash; distinct on a page before anything is shuffled."""
    n_pages = pages.groupBy("entity_name").agg(F.countDistinct("doc_id").alias("pages")).where("pages > 1")
    long = F.array_distinct(F.transform(F.filter("bs", lambda x: F.length(x["norm"]) >= min_block), lambda x: F.struct(x["h"].alias("h"), x["norm"].alias("norm"))))
    n = pages.select("entity_name", F.explode(long).alias("x")).groupBy("entity_name", F.col("x.h").alias("h")).agg(F.count("*").alias("n"), F.first("x.norm").alias("norm"))
    return n.join(n_pages, "entity_name").where(F.col("n") >= F.when(F.col("pages") == 2, 2).otherwise(F.ceil(F.col("pages") * threshold))).select("entity_name", "h", "n", "norm")


def boilerplate_frequency(items: DataFrame, separator: str = r"\n\s*\n", threshold: float = 0.5, min_block: int = 20) -> DataFrame:
    """(entity_name, norm, n): blocks on at least the threshold's share of an entity's pages; on both, if it has two. doc_id is a page's key."""
    return _frequent(_pages_of_blocks(items, separator), threshold, min_block).select("entity_name", "norm", "n")


def boilerplate_strip(items: DataFrame, separator: str = r"\n\s*\n", threshold: float = 0.5, min_block: int = 20, min_ratio: float = 0.3, known: bool = True) -> DataFrame:
    """Texts without frequent and known blocks; what would keep too little is restored and flagged. An entity's frequent blocks are at most its blocks a page / threshold, as hashes of one row, so each page is filtered where it is."""
    frequent = _frequent(_pages_of_blocks(items, separator), threshold, min_block).groupBy("entity_name").agg(F.collect_set("h").alias("frequent"))
    out = items.join(frequent, "entity_name", "left").withColumn("frequent", F.coalesce("frequent", F.array().cast("array<bigint>")))
    out = _pages_of_blocks(out, separator)  # after the join, so that it moves texts alone
    kept = F.filter("bs", lambda x: ~((F.length(x["norm"]) >= min_block) & F.array_contains("frequent", x["h"])) & (~T.is_known_boilerplate(x["norm"]) if known else F.lit(True)))
    out = out.withColumn("rest", F.array_join(F.transform(kept, lambda x: x["block"]), "\n\n")).drop("bs", "frequent")
    size, gone = F.length("text_content"), F.greatest(F.length("text_content") - F.length("rest"), F.lit(0))
    flagged = F.length("rest") < size * min_ratio
    text = F.when(flagged, F.col("text_content")).otherwise(F.col("rest"))
    return out.select("entity_name", "doc_id", T.word_count(text).alias("word_count"), F.when(flagged, 0).otherwise(gone).alias("stripped_chars"), F.when(size == 0, 0.0).otherwise(T.js_round(F.when(flagged, 0).otherwise(gone) / size, 2)).cast("double").alias("boilerplate_ratio"), F.coalesce(flagged, F.lit(False)).alias("flagged"))


def numbered(items: DataFrame, order: str = "pool_pos", step: int = 100_000) -> DataFrame:
    """items with `_i`, the rows of each entity numbered from 0 by a whole-number order: within ranges of it, whose first numbers are sums of counts, so a large entity isn't sorted in one task."""
    ranged = items.withColumn("_r", F.floor(F.col(order) / step))
    counts = ranged.groupBy("entity_name", "_r").agg(F.count("*").alias("_n"))
    first = counts.select("entity_name", "_r", (F.sum("_n").over(Window.partitionBy("entity_name").orderBy("_r")) - F.col("_n")).alias("_first"))
    within = F.row_number().over(Window.partitionBy("entity_name", "_r").orderBy(order)) - 1
    return ranged.withColumn("_i", within).join(first, ["entity_name", "_r"]).withColumn("_i", F.col("_i") + F.col("_first")).drop("_r", "_first")


def assign_by_index(items: DataFrame, answers: DataFrame, batch: int, order: str = "pool_pos") -> DataFrame:
    """Model answers (batch, idx, value...) joined to the rows of their batch; of several for a row the last counts."""
    rows = numbered(items, order)
    rows = rows.withColumn("batch", F.floor(F.col("_i") / batch).cast("int")).withColumn("idx", (F.col("_i") % batch + 1).cast("int"))
    values = [c for c in answers.columns if c not in ("entity_name", "batch", "idx", "answer_pos")]
    last = answers.groupBy("entity_name", "batch", "idx").agg(*(F.max_by(c, "answer_pos").alias(c) for c in values))
    return rows.join(last, ["entity_name", "batch", "idx"], "left").drop("_i", "batch", "idx")


def relevance(items: DataFrame, responses: DataFrame, batch: int = 200) -> DataFrame:
    """KEEP, MAYBE or DROP by line of the batch's answer; MAYBE where there is none. responses: (entity_name, batch, text)."""
    lines = F.regexp_extract_all("text", F.lit(r"(?im)^\s*(\d+)\.\s*(?:KEEP|MAYBE|DROP)"), F.lit(1))
    words = F.regexp_extract_all("text", F.lit(r"(?im)^\s*\d+\.\s*(KEEP|MAYBE|DROP)"), F.lit(1))
    answers = responses.select("entity_name", "batch", F.posexplode(F.arrays_zip(lines.alias("n"), words.alias("w"))).alias("answer_pos", "x")).select("entity_name", "batch", F.col("x.n").cast("int").alias("idx"), F.upper("x.w").alias("relevance"), "answer_pos")
    return assign_by_index(items, answers, batch).select("url", F.coalesce("relevance", F.lit("MAYBE")).alias("relevance"))


def split_relevance(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What goes on (KEEP, or no verdict) and what is passed by (MAYBE); DROP is in neither."""
    kept = F.coalesce(F.col("relevance"), F.lit("")).isin("", "KEEP")
    return items.where(kept), items.where("relevance = 'MAYBE'")


def tag_intents(items: DataFrame, responses: DataFrame, intents: list[str], batch: int = 10, first: tuple = ("news", "product_info", "review")) -> DataFrame:
    """page_intent and intent_confidence (0 to 1) from JSON answers; unknown intents and failed batches are `other`, MAYBE pages `unclassified`. rank: order by it within an entity, then by falling confidence: the `first` intents in their order, others, unclassified. items: (entity_name, doc_id, pool_pos, relevance)."""
    found = F.from_json("text", "array<struct<index: int, intent: string, confidence: double>>")
    answers = responses.select("entity_name", "batch", F.posexplode(found).alias("answer_pos", "x")).select("entity_name", "batch", F.col("x.index").alias("idx"), "x.intent", "x.confidence", "answer_pos")
    slug = F.regexp_replace(F.lower(T.trim_ws(F.col("intent"))), r"\s+", "_")
    kept, maybe = split_relevance(items)
    tagged = assign_by_index(kept, answers, batch).select("entity_name", "doc_id", F.when(slug.isin(intents), slug).otherwise("other").alias("page_intent"), F.when(slug.isin(intents), F.least(F.greatest(F.coalesce("confidence", F.lit(0.0)), F.lit(0.0)), F.lit(1.0))).otherwise(0.0).alias("intent_confidence"))
    out = tagged.unionByName(maybe.select("entity_name", "doc_id", F.lit("unclassified").alias("page_intent"), F.lit(0.0).alias("intent_confidence")))
    rank = F.array_position(F.array(*map(F.lit, first)), F.col("page_intent"))
    return out.withColumn("rank", F.when(F.col("page_intent") == "unclassified", len(first) + 2).when(rank > 0, rank).otherwise(len(first) + 1).cast("int"))


def by_entity(items: DataFrame, status: Column, kinds: list[str]) -> DataFrame:
    """Counts of each status by entity."""
    return items.groupBy("entity_name").agg(F.count("*").alias("total"), *(F.count_if(status == k).alias(k) for k in kinds))


def histogram(items: DataFrame, key: str, by: list[str], by_count: bool = False) -> DataFrame:
    """A map of counts by value of `key`, for each group; in the order of the values, or by falling count and then by value."""
    counts = items.groupBy(*by, key).agg(F.count("*").alias("n"))
    if by_count:
        ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), key, "n")))
        return counts.groupBy(*by).agg(F.map_from_entries(F.transform(ranked, lambda x: F.struct(x[key], x["n"]))).alias("counts"))
    return counts.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias("counts"))


def latest(pool: DataFrame, fields: list[str], by: str = "entity_name", order: str = "pool_pos") -> DataFrame:
    """The last value of each field that is neither null nor empty."""
    return pool.groupBy(by).agg(*(F.max_by(c, F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.col(order))).alias(c) for c in fields))

"""Orders and summaries of a step's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import text as T

#: Order in which a reader should see statuses.
STATUS_ORDER = ["error", "skipped", "low_content", "success"]


def status_rank(status: Column) -> Column:
    """0 for what needs a look first; unknown statuses come with the last."""
    at = F.array_position(F.array(*map(F.lit, STATUS_ORDER)), status)
    return F.coalesce(F.when(at > 0, at - 1), F.lit(len(STATUS_ORDER) - 1)).cast("int")


def by_status(items: DataFrame, *then: str) -> DataFrame:
    """Rows by status, then by the given columns; a range partitioned sort."""
    return items.withColumn("status_rank", status_rank(F.col("status"))).orderBy("status_rank", *then)


def flagged_first(items: DataFrame, flag: Column, *then: str) -> DataFrame:
    return items.withColumn("flag_rank", F.when(flag, 0).otherwise(1)).orderBy("flag_rank", *then)


def entity_summary(items: DataFrame) -> DataFrame:
    """Counts of each status and the words of an entity's pages. items: (entity_name, status, word_count)."""
    of = lambda k: F.count_if(F.col("status") == k)
    return items.groupBy("entity_name").agg(F.count("*").alias("total"), of("success").alias("success"), of("low_content").alias("low_content"), of("error").alias("errors"), of("skipped").alias("skipped"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("total_words"))


def run_summary(entities: DataFrame) -> DataFrame:
    """One row of a run, from entity_summary: totals and a sentence that names what went wrong."""
    out = entities.agg(F.count("*").alias("total_entities"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "success", "low_content", "errors", "skipped")))
    part = lambda c, word: F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" {word}")))
    problems = F.col("errors") + F.col("skipped") + F.col("low_content")
    said = F.concat(F.col("success").cast("string"), F.lit(" scraped, "), problems.cast("string"), F.lit(" issues ("), F.concat_ws(", ", part("errors", "errors"), part("skipped", "skipped"), part("low_content", "low content")), F.lit(") of "), F.col("total").cast("string"), F.lit(" total"))
    return out.withColumn("description", F.when(problems > 0, said).otherwise(F.concat(F.col("total").cast("string"), F.lit(" URLs \u2014 all scraped successfully"))))


def error_rollup(items: DataFrame) -> DataFrame:
    """(entity_name, errors, first_error, error): entities with failures, how many, the message of the first, and the line `entity: message` that a run's summary lists. items: (entity_name, pool_pos, error)."""
    out = items.where("error is not null and error != ''").groupBy("entity_name").agg(F.count("*").alias("errors"), F.min_by("error", "pool_pos").alias("first_error"))
    return out.withColumn("error", F.concat("entity_name", F.lit(": "), "first_error"))


def step_errors(items: DataFrame, entities: DataFrame, what: str = "links") -> DataFrame:
    """One row of a step: what was found of how many entities, how many failed, and their errors as `entity: message` in the order of names. entities: (entity_name). Only failed entities are gathered: a line each."""
    failed = error_rollup(items)
    found = items.agg(F.count_if(F.col("error").isNull() | (F.col("error") == "")).alias("total_items"))
    lines = failed.agg(F.count("*").alias("failed"), F.array_sort(F.collect_list("error")).alias("errors"))
    all_ = entities.select("entity_name").distinct().agg(F.count("*").alias("total_entities"))
    out = all_.crossJoin(found).crossJoin(lines)  # a row each
    good = F.col("total_entities") - F.col("failed")
    said = F.when(F.col("failed") > 0, F.format_string(f"%d {what} from %d of %d entities (%d failed)", "total_items", good, "total_entities", "failed")).otherwise(F.format_string(f"%d {what} from %d entities", "total_items", "total_entities"))
    return out.select("total_entities", "total_items", "failed", said.alias("description"), F.array_join("errors", "\n").alias("errors"))


def top_of_each(items: DataFrame, by: str, order: list, most: int) -> DataFrame:
    """The first `most` rows of each group. order: columns, the last of which should be unique."""
    return items.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= most)


def credits(calls: DataFrame) -> DataFrame:
    """(entity_name, calls, failed, credits): what the calls to a paid service came to. calls: (entity_name, ok, credits)."""
    return calls.groupBy("entity_name").agg(F.count("*").alias("calls"), F.count_if(~F.col("ok")).alias("failed"), F.coalesce(F.sum("credits"), F.lit(0)).alias("credits"))


def rate_limited(calls: DataFrame, by: str, ts: str, order: str, per_minute: int) -> DataFrame:
    """calls with sent_ms, when a queue that spaces calls by 60000 / per_minute milliseconds (rounded up) lets each go, and wait_ms until then. Of calls in the order of ts and `order`, call i goes at i * d + max(t_j - j * d for j up to i): one running maximum for each `by`."""
    spacing = -(-60_000 // per_minute)
    w = Window.partitionBy(by).orderBy(ts, order)
    turn = (F.row_number().over(w) - 1) * F.lit(spacing).cast("bigint")
    asked = F.unix_millis(F.col(ts).cast("timestamp"))
    out = calls.withColumn("_turn", turn).withColumn("_asked", asked)
    sent = F.max(F.col("_asked") - F.col("_turn")).over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_turn")
    return out.withColumn("sent_ms", sent).withColumn("wait_ms", F.col("sent_ms") - F.col("_asked")).drop("_turn", "_asked")


def needs_rescrape(items: DataFrame, min_words: int = 50, known_only: bool = False) -> Column:
    """Whether a page is fetched once more by the next tier: all but good successes and what no browser can read. known_only: unknown statuses are passed through, as the paid tier does."""
    status, text = F.coalesce("status", F.lit("")), F.coalesce(F.nullif("text_content", F.lit("")), F.col("text_preview"), F.lit(""))
    good = (status == "success") & (F.coalesce("word_count", F.lit(0)) >= min_words) & ~T.is_block_page(text)
    if known_only:
        return status.isin("", "error", "dead_link", "low_content") | ((status == "success") & ~good)
    return ~(good | (status == "skipped"))


def rescrape(items: DataFrame, min_words: int = 50, known_only: bool = False, copies: int = 3) -> DataFrame:
    """items with `again`: needs_rescrape, and also good pages whose trimmed text stands on `copies` pages or more, which is boilerplate. Counted by hash and length of the text. Counts are a row for each text that repeats, never one for each page."""
    text = T.trim_ws(F.col("text_content"))
    keyed = items.withColumn("_t", F.when((F.col("status") == "success") & (text != ""), F.sha2(text, 256)))
    often = keyed.where("_t is not null").groupBy("_t").agg(F.count("*").alias("_n")).where(F.col("_n") >= copies).drop("_n")
    marked = keyed.join(often.withColumn("_often", F.lit(True)), "_t", "left")
    return marked.withColumn("again", needs_rescrape(items, min_words, known_only) | F.coalesce(F.col("_often"), F.lit(False))).drop("_t", "_often")


def first_good(items: DataFrame, tiers: list[tuple[str, DataFrame]], min_words: int = 50) -> DataFrame:
    """Each page with the text of the first tier that gave enough words and no bot wall; `error` where none did. tiers: name and (url, text_content), in the order in which they are tried."""
    out = items
    for name, found in tiers:
        out = out.join(found.select("url", F.col("text_content").alias(f"_{name}")), "url", "left")
    good = lambda c: (T.word_count(F.col(c)) >= min_words) & ~T.is_block_page(F.col(c))
    text = F.coalesce(*(F.when(good(f"_{n}"), F.col(f"_{n}")) for n, _ in tiers))
    method = F.coalesce(*(F.when(good(f"_{n}"), F.lit(n)) for n, _ in tiers))
    out = out.select(*items.columns, text.alias("text_content"), method.alias("scrape_method"))
    return out.withColumn("word_count", T.word_count(F.col("text_content"))).withColumn("status", F.when(F.col("scrape_method").isNull(), "error").otherwise("success"))

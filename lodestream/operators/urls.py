"""URL validation: first occurrences, redirects, patterns and liveness. Network answers are rows of a response table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.functions import fixed_values as fixed
from lodestream.functions import text as T
from lodestream.functions import urls


def dedup(items: DataFrame, key=None, order: str = "pool_pos") -> DataFrame:
    """Flags what repeats an earlier row of the same key. The first row of each key comes from a partial aggregate, and only keys that repeat are joined back, in a stage of its own where Spark can split a key that very many rows have: no window holds such a key in one task. `order` is unique within a key."""
    out = items.withColumn("norm_url", key if key is not None else urls.normalize(F.col("url")))
    firsts = out.groupBy("norm_url").agg(F.min(F.struct(order, "url")).alias("_f"), F.count("*").alias("_n")).where("_n > 1").select("norm_url", "_f")
    out = out.join(firsts, "norm_url", "left")
    again = F.col(order) != F.col(f"_f.{order}")
    return out.select(F.col("norm_url").alias("url"), F.col("url").alias("original_url"), F.when(again, F.col("_f.url")).alias("duplicate_of"), F.when(again, "duplicate").otherwise("unique").alias("status"), "entity_name")


def canonicalize(items: DataFrame, responses: DataFrame) -> DataFrame:
    """Final URLs, first of each over all entities, by a partial aggregate. responses: (url, final_url)."""
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    out = items.join(responses.select("url", "final_url"), "url", "left").withColumn("to", F.coalesce("final_url", "url"))
    first = F.min(F.struct("pool_pos", "url", "to", "entity_name")).alias("f")
    out = out.groupBy(bare(F.lower("to")).alias("_k")).agg(first).select("f.url", "f.to", "f.entity_name")
    moved = bare(F.col("to")) != bare(F.col("url"))
    return out.select(F.when(moved, F.col("to")).otherwise(F.col("url")).alias("url"), F.col("url").alias("original_url"), F.when(moved, "redirected").otherwise("unchanged").alias("status"), F.when(moved, F.concat_ws(" -> ", "url", "to")).alias("redirect_detail"), "entity_name")


def filter_patterns(items: DataFrame, exclude: list[str], include: list[str] = ()) -> DataFrame:
    """Excluded rows are kept and marked with the first pattern that hit; drop them with status = 'kept'."""
    hit = F.lit(None).cast("string")
    for p in reversed(exclude):
        hit = F.when(F.col("url").rlike(f"(?i){p}"), F.lit(p)).otherwise(hit)
    if include:
        hit = F.when(hit.isNull() & ~F.col("url").rlike("(?i)" + "|".join(f"(?:{p})" for p in include)), F.lit("not included")).otherwise(hit)
    return items.select("url", F.when(hit.isNull(), "kept").otherwise("excluded").alias("status"), hit.alias("matched_pattern"), "entity_name")


def liveness(items: DataFrame, head: DataFrame, browser: DataFrame, by: str = "url") -> DataFrame:
    """HEAD 200-399 lives; 403, 429 and 503 get a second look by browser, where a bot check is dead whatever its status. Each response: (url, http_status, body); a browser row without status is a failed fetch, a URL without browser row was not looked at and is kept.

    by: the column that joins responses to items; `url`, or a row's id where each row was asked for by itself and rows repeat URLs. Of several responses for one key the one with the least status counts, so that an item stays one row.
    """
    one = lambda df, *columns: df.groupBy(by).agg(F.min(F.struct(F.isnull(columns[0]).alias("failed"), *columns)).alias("r"))
    h = one(head.select(by, F.col("http_status").alias("h")), "h").select(by, "r.h")
    seen = browser.select(by, F.col("http_status").alias("b"), F.coalesce(F.length("body"), F.lit(0)).alias("size"), T.has_any(F.coalesce("body", F.lit("")), fixed.lines(fixed.CHALLENGE_MARKERS)).alias("challenge"))
    b = one(seen, "b", "size", "challenge").select(by, F.lit(True).alias("looked"), "r.b", "r.size", "r.challenge")
    out = items.join(h, by, "left").join(b, by, "left")
    status = F.coalesce(F.col("b").cast("string"), F.lit("failed"))
    reason = (
        F.when(F.col("h").between(200, 399), F.lit(None)).when(~F.coalesce(F.col("h").isin(403, 429, 503), F.lit(False)), F.concat(F.lit("head "), F.coalesce(F.col("h").cast("string"), F.lit("failed"))))
        .when(F.col("looked").isNull(), F.lit(None)).when(F.col("challenge"), F.concat(F.lit("browser "), status, F.lit(", challenge")))
        .when(F.col("b").between(200, 399) | (F.col("b").isNotNull() & (F.col("size") > 1000)), F.lit(None)).otherwise(F.concat(F.lit("browser "), status))
    )
    return out.select("url", F.when(reason.isNull(), "kept").otherwise("dead_link").alias("status"), reason.alias("reason"))


def exclude_known(links: DataFrame, pool: DataFrame) -> DataFrame:
    return links.join(pool.select("url").distinct(), "url", "left_anti")

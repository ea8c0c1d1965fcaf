"""Structured Streaming: incremental URL dedup, event-time windows, rework counters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestream.functions import urls


def dedup_stream(items: DataFrame, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """The first row of each normalised URL; state is kept for `delay`."""
    return items.withColumn("norm_url", urls.normalize(F.col("url"))).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["norm_url"])


def windowed_counts(events: DataFrame, size: str = "1 day", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Counts and sums by event type and window; a batch frame gives the same rows."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", delay).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


#: Decisions after which an entity is not sent back any more.
FINAL = ("approve", "failed")


class _Loops(StatefulProcessor):
    """How often each entity was sent back so far. What is known of an entity goes with its last decision, and in any case when it was not heard of for `keep_ms`."""

    def __init__(self, max_loops: int, keep_ms: int | None):
        self.max_loops, self.keep_ms = max_loops, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.n = handle.getValueState("n", "n long", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues):
        n, over = self.n.get()[0] if self.n.exists() else 0, False
        for b in rows:
            n += int(b["decision"].str.startswith("loop_").sum())
            over = over or bool(b["decision"].isin(FINAL).any())
        if over:
            self.n.clear()
        else:
            self.n.update((n,))
        yield pd.DataFrame({"entity_name": [key[0]], "loop_count": [n], "exhausted": [n >= self.max_loops]})


class _Breaker(StatefulProcessor):
    """Failures in a row; once `limit` of them came, later calls are aborted. A key that was not called for `keep_ms` begins anew."""

    def __init__(self, order: str, limit: int, keep_ms: int | None):
        self.order, self.limit, self.keep_ms = order, limit, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.streak = handle.getValueState("streak", "n long", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues):
        streak, calls = self.streak.get()[0] if self.streak.exists() else 0, pd.concat(list(rows)).sort_values(self.order)
        aborted = []
        for ok in calls["ok"]:
            aborted.append(streak >= self.limit)
            streak = streak if streak >= self.limit else 0 if ok else streak + 1
        if streak:
            self.streak.update((streak,))
        else:  # a key whose last call went well needs no state
            self.streak.clear()
        yield pd.DataFrame({"key": [key[0]] * len(calls), "call": calls[self.order].to_numpy(), "aborted": aborted})


def loop_counts(decisions: DataFrame, max_loops: int = 3, keep_ms: int | None = None) -> DataFrame:
    """decisions: (entity_name, decision). How often each entity was sent back, and whether it may be again. State ends with a final decision and, where keep_ms is given, that long after the last one; by the clock, so such a query runs on batches without rows too and wants a processing-time trigger. Needs the RocksDB state store."""
    mode = "none" if keep_ms is None else "processingTime"
    return decisions.groupBy("entity_name").transformWithStateInPandas(_Loops(max_loops, keep_ms), "entity_name string, loop_count long, exhausted boolean", "update", mode)


def breaker_stream(calls: DataFrame, by: str, order: str, limit: int = 3, keep_ms: int | None = None) -> DataFrame:
    """(key, call, aborted) for calls with a column `ok`, in the order of whole numbers `order` within each batch. State is kept for keys that fail only, and where keep_ms is given no longer than that after their last call, with a processing-time trigger. Needs the RocksDB state store."""
    mode = "none" if keep_ms is None else "processingTime"
    return calls.groupBy(by).transformWithStateInPandas(_Breaker(order, limit, keep_ms), f"key {calls.schema[by].dataType.simpleString()}, call long, aborted boolean", "append", mode)


def pool_growth(items: DataFrame) -> DataFrame:
    """(entity_name, items): an entity's pool as it grows, in update mode."""
    return items.groupBy("entity_name").agg(F.count("*").alias("items"))


def new_to_pool(links: DataFrame, pool: DataFrame) -> DataFrame:
    """Links whose URL the entity's pool doesn't have, the first by `found_on` and text of each. links, pool: (entity_name, url, ...); a link of an entity without any pool row counts for nothing."""
    started = pool.select("entity_name").distinct()
    fresh = links.join(started, "entity_name", "left_semi").join(pool.select("entity_name", "url"), ["entity_name", "url"], "left_anti")
    rest = [c for c in links.columns if c not in ("entity_name", "url")]
    return fresh.groupBy("entity_name", "url").agg(F.min(F.struct(*rest)).alias("r")).select("entity_name", "url", "r.*")


def grow_pool(links: DataFrame, pool_path: str, checkpoint: str):
    """A writer that adds each batch's new links to the pool below pool_path, one folder `batch=n` for each batch. A batch joins with the pool as it was before: folders of other batches. A batch that is run again, after a restart, replaces its own folder, so nothing is added twice."""
    schema = links.schema

    def add(batch: DataFrame, n: int) -> None:
        pool = batch.sparkSession.read.schema(schema.add("batch", "long")).option("basePath", pool_path).parquet(pool_path).where(F.col("batch") < n)
        new_to_pool(batch, pool).write.mode("overwrite").parquet(f"{pool_path}/batch={n}")

    return links.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)


def write_partial(items: DataFrame, path: str, checkpoint: str):
    """Appends each batch's rows to Parquet as soon as it is done; a run that breaks off goes on from there, and nothing is written twice."""
    return items.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")

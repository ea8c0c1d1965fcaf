"""Streams: a pool that grows over batches and a restart, state that ends, incremental dedup over a restart."""

import time

import pytest
from pyspark.sql import functions as F

from lodestream.streaming import incremental

LINKS = "entity_name string, url string, found_on string"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(name)


def feed(spark, folder, n, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{n}")


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def test_a_pool_grows_over_batches_and_a_restart(spark, tmp_path):
    source, pool, checkpoint = (str(tmp_path / x) for x in ("source", "pool", "checkpoint"))
    spark.createDataFrame([("a", "u0", "seed"), ("b", "v0", "seed")], LINKS).write.parquet(f"{pool}/batch=-1")
    stream = lambda: spark.readStream.schema(LINKS).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    now = lambda: sorted((r.entity_name, r.url, r.found_on) for r in spark.read.parquet(pool).collect())
    feed(spark, source, 1, [("a", "u1", "u0"), ("a", "u0", "x"), ("a", "u1", "t"), ("c", "w1", "w0")], LINKS)
    run(incremental.grow_pool(stream(), pool, checkpoint))
    first = [("a", "u0", "seed"), ("a", "u1", "t"), ("b", "v0", "seed")]
    assert now() == first  # c has no pool
    feed(spark, source, 2, [("a", "u1", "y"), ("b", "u1", "v0"), ("a", "u2", "u1")], LINKS)
    run(incremental.grow_pool(stream(), pool, checkpoint))  # a new query on the old checkpoint
    second = sorted([*first, ("b", "u1", "v0"), ("a", "u2", "u1")])
    assert now() == second
    feed(spark, source, 3, [("a", "u2", "z")], LINKS)
    run(incremental.grow_pool(stream(), pool, checkpoint))
    assert now() == second
    # a batch that is run again, as after a crash before it was recorded, replaces what it wrote
    import shutil

    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    for n in range(1, last + 1):
        (tmp_path / "checkpoint" / "commits" / str(n)).unlink()
        for crc in (tmp_path / "checkpoint" / "commits").glob(f".{n}.crc"):
            crc.unlink()
    shutil.rmtree(f"{pool}/batch={last}")
    run(incremental.grow_pool(stream(), pool, checkpoint))
    assert now() == second


def collect(df, mode, checkpoint):
    """Rows of what is there so far. State with an end by the clock asks for batches for ever, so the query is stopped."""
    out = []
    query = df.writeStream.foreachBatch(lambda b, n: out.extend(tuple(r) for r in b.collect())).outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime="1 second").start()
    try:
        for _ in range(240):
            if query.exception() or any(p.numInputRows for p in query.recentProgress):
                break
            time.sleep(0.25)
        assert query.exception() is None
    finally:
        query.stop()
    return sorted(out)


def test_loop_counts_end(rocks, tmp_path):
    spark, schema = rocks, "entity_name string, decision string"
    source, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")
    counts = lambda keep: incremental.loop_counts(spark.readStream.schema(schema).parquet(f"{source}/*"), 2, keep)
    feed(spark, source, 1, [("a", "loop_tone"), ("b", "loop_tone"), ("b", "approve")], schema)
    assert collect(counts(20_000), "update", checkpoint) == [("a", 1, False), ("b", 1, False)]
    feed(spark, source, 2, [("a", "loop_tone"), ("b", "loop_tone")], schema)
    assert collect(counts(20_000), "update", checkpoint) == [("a", 2, True), ("b", 1, False)]  # b was done: it begins anew
    time.sleep(21)
    feed(spark, source, 3, [("a", "loop_tone")], schema)
    assert collect(counts(20_000), "update", checkpoint) == [("a", 1, False)]  # not heard of for too long


def test_breaker_state_ends(rocks, tmp_path):
    spark, schema = rocks, "k string, n long, ok boolean"
    source, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")
    calls = lambda: incremental.breaker_stream(spark.readStream.schema(schema).parquet(f"{source}/*"), "k", "n", 2, 20_000)
    feed(spark, source, 1, [("a", 1, False), ("a", 2, False), ("b", 1, True), ("b", 2, False)], schema)
    assert collect(calls(), "append", checkpoint) == [("a", 1, False), ("a", 2, False), ("b", 1, False), ("b", 2, False)]
    feed(spark, source, 2, [("a", 3, True), ("b", 3, True)], schema)
    assert collect(calls(), "append", checkpoint) == [("a", 3, True), ("b", 3, False)]
    time.sleep(21)
    feed(spark, source, 3, [("a", 4, True)], schema)
    assert collect(calls(), "append", checkpoint) == [("a", 4, False)]


def test_state_can_be_kept(rocks, tmp_path):
    spark, schema = rocks, "entity_name string, decision string"
    feed(spark, str(tmp_path / "s"), 1, [("a", "loop_tone")], schema)
    df = incremental.loop_counts(spark.readStream.schema(schema).parquet(f"{tmp_path}/s/*"), 2, None)
    assert collect(df, "update", str(tmp_path / "c")) == [("a", 1, False)]


def test_dedup_goes_on_after_a_restart(spark, tmp_path):
    schema = "url string, ts timestamp"
    source, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")
    items = lambda: incremental.dedup_stream(spark.readStream.schema(schema).parquet(f"{source}/*")).select("url")
    row = lambda u: spark.range(1).select(F.lit(u).alias("url"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"))
    row("https://a.org/x").write.parquet(f"{source}/1")
    assert collect(items(), "append", checkpoint) == [("https://a.org/x",)]
    row("https://www.a.org/x/").union(row("https://a.org/y")).coalesce(1).write.parquet(f"{source}/2")
    assert collect(items(), "append", checkpoint) == [("https://a.org/y",)]

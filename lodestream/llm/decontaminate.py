"""Benchmark decontamination by winnowing.

A window of SPAN words holds SPAN - K + 1 k-grams; the one with the least hash, the first of equal ones, is selected. Windows
that follow each other mostly select the same k-gram, which is kept once, with its position. Equal windows select the same
k-gram of theirs, so a join of training and test fingerprints meets every shared span of SPAN words or more. Each hit is
extended word by word to both sides, as far as a window that selected it can reach, and counts if SPAN words or more agree;
the extended hits of a longer shared span overlap and cover it. Items of fewer words are one window, of which the whole must
agree; its k-gram has all its words if it has fewer than K.

Before the join, a bitmap of fixed size tells which training fingerprints can have a partner. It prunes only: the join
compares fingerprint and words, so the bitmap's false hits, or a bitmap filled by a huge benchmark, change no result.

Nulls and edge cases: a null or empty text has no words (n_words 0, nothing hit). Items with null id or without words have
no windows. Rows of the same doc_id are separate documents. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm.common import Words, blocks, byte_class, fixed_bitmap, grams, in_bitmap, table

K, SPAN = 5, 10
FILTER_BITS = 24
WORD = byte_class("".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])))


def selected(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k-grams that windows of n words select, each once, and their fingerprints."""
    g = grams(hashes, min(K, n))
    span = n - min(K, n) + 1
    m = max(len(g) - span + 1, 0)
    least, at = g[:m].copy(), np.arange(m)
    for j in range(1, span):
        less = g[j : j + m] < least
        least[less], at[less] = g[j : j + m][less], np.flatnonzero(less) + j
    at = np.unique(at)
    return at, g[at] ^ np.uint64(n)


def _surrounded(words: Words, at: int, n: int, lo: int, hi: int) -> tuple[str, list[str], list[str]]:
    """A k-gram's text, and the words before it, nearest first, and after it that a window of n words can hold."""
    k = min(K, n)
    before = [words.text(i, i + 1) for i in range(at - 1, max(at - (n - k), lo) - 1, -1)]
    return words.text(at, at + k), before, [words.text(i, i + 1) for i in range(at + k, min(at + n, hi))]


STRINGS = pa.list_(pa.string())


def _item_fingerprints(batches):
    for batch in blocks(batches, "text"):
        words, ids = Words(batch.column("text"), WORD), batch.column("item_id")
        rows: list[tuple] = []
        for i, (lo, hi) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())):
            if hi > lo:
                n = min(SPAN, hi - lo)
                at, f = selected(words.hashes[lo:hi], n)
                rows += [(i, v, n, *_surrounded(words, lo + j, n, lo, hi)) for j, v in zip(at.tolist(), f.view(np.int64).tolist())]
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), STRINGS, STRINGS)
        at, *rest = (pa.array(c, t) for c, t in zip(columns, kinds))
        yield pa.RecordBatch.from_arrays([ids.take(at).cast(pa.string()), *rest], ["item", "f", "n", "gram", "before", "after"])


def item_fingerprints(items: DataFrame) -> DataFrame:
    """(item, f, n, gram, before, after): the selected k-grams of each item."""
    kept = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null")
    return kept.mapInArrow(_item_fingerprints, "item string, f bigint, n int, gram string, before array<string>, after array<string>").distinct()


def _candidates(bitmap, lengths: list[int]):
    def scan(batches):
        for batch in blocks(batches, "text"):
            words = Words(batch.column("text"), WORD)
            bounds = words.bounds
            rows: list[tuple] = []
            for n in lengths:
                at, f = selected(words.hashes, n)
                there = in_bitmap(bitmap.value, f >> np.uint64(64 - FILTER_BITS))
                at, f = at[there], f[there].view(np.int64)
                doc = np.searchsorted(bounds, at, "right") - 1
                ok = at + min(K, n) <= bounds[doc + 1]
                rows += [(d, p - int(bounds[d]), n, v, *_surrounded(words, p, n, int(bounds[d]), int(bounds[d + 1]))) for d, p, v in zip(doc[ok].tolist(), at[ok].tolist(), f[ok].tolist())]
            without = np.setdiff1d(np.arange(batch.num_rows), [r[0] for r in rows]).tolist()
            docs, *rest = zip(*rows, *((d, None, None, None, None, None, None) for d in without))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), STRINGS, STRINGS)
            counts, docs = np.diff(bounds), np.array(docs, np.int64)
            columns = [batch.column("rid").take(pa.array(docs)), batch.column("doc_id").take(pa.array(docs)), pa.array(counts[docs], pa.int64()), *(pa.array(c, t) for c, t in zip(rest, kinds))]
            yield pa.RecordBatch.from_arrays(columns, ["rid", "doc_id", "n_words", "at", "n", "f", "gram", "before", "after"])

    return scan


def _agreeing(x: str, y: str):
    """How many first words of two arrays are equal."""
    same = F.zip_with(x, y, lambda a, b: F.coalesce(a == b, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(rid, doc_id, n_words, n_hit, items, contaminated) for each document; items: sorted ids, as strings, with a window in it."""
    spark = docs.sparkSession
    prints = item_fingerprints(items)
    lengths = [r.n for r in prints.select("n").distinct().collect()]  # at most SPAN of them
    bits = F.shiftrightunsigned("f", 64 - FILTER_BITS)
    bitmap = spark.sparkContext.broadcast(fixed_bitmap(prints.select(bits.alias("p")), FILTER_BITS))
    docs = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    found = docs.mapInArrow(_candidates(bitmap, lengths), f"rid bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, at int, n int, f bigint, gram string, before array<string>, after array<string>")
    # rows without a fingerprint get keys of their own, which match nothing and spread over the tasks
    found = found.withColumn("f", F.coalesce("f", "rid")).withColumn("gram", F.coalesce("gram", F.concat(F.lit("\n"), F.col("rid").cast("string"))))
    theirs = prints.select("item", "f", "gram", F.col("before").alias("item_before"), F.col("after").alias("item_after"))
    hits = found.join(theirs, ["f", "gram"], "left")
    k = F.least(F.lit(K), F.col("n"))
    hits = hits.withColumn("left_", _agreeing("before", "item_before")).withColumn("right_", _agreeing("after", "item_after"))
    hits = hits.withColumn("hit", F.coalesce(F.col("item").isNotNull() & (F.col("left_") + k + F.col("right_") >= F.col("n")), F.lit(False)))
    span = F.struct((F.col("at") - F.col("left_")).alias("start"), (F.col("at") + k + F.col("right_")).alias("end"))
    hits = hits.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("hit"), span))).alias("spans"),
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("item")))).alias("items"),
    )
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("to"), F.lit(0).cast("bigint").alias("n")),
        lambda a, x: F.struct(F.greatest(a["to"], x["end"]).alias("to"), (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["to"]))).alias("n")),
        lambda a: a["n"],
    )
    return hits.withColumn("n_hit", covered).select("rid", "doc_id", "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"))


def query(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[s:s + least(len(ws), 10) - 1], ' ') AS win FROM i, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS t(s) WHERE len(ws) > 0),
ln AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, s, n, array_to_string(ws[s:s + n - 1], ' ') AS win FROM w, ln, unnest(range(1, len(ws) - n + 2)) AS t(s)),
h AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN iw USING (win, n)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, unnest(range(s, s + n)) AS t(p) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

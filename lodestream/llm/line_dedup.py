"""Line deduplication over a suffix array of line ids, native.

The documents' lines are an alphabet of ids, the ids in order a text, and its suffixes are sorted by distributed prefix
doubling: after round r suffixes are ranked by their first 2**r lines, and the rank pair at i and i + 2**r gives the next
rank. Suffixes whose rank nobody shares are done and leave, so a round handles only lines that still repeat. Ranks are
dealt by a range sort of the distinct pairs, not by one task, and the ranks of the commonest lines and runs, under a thousand,
are broadcast, so no task gets all copies of one.

A repeated run is worth deleting from `min_words` words on. Every line of such a run lies in a shortest window of
min_words words that opens or closes inside the run, so the LCP intervals at the depths of these windows (suffixes that
share the window's lines: equal ranks at its start and at its end) hold all maximal repeated runs: the union of an
interval's later windows is the later copies. A line is deleted if a run of min_words words or more around it stood
earlier, in the order of doc_id and line. Copies inside one document count, overlapping ones too.

Nulls and edge cases: a null text stays null (no lines), an empty one is one empty line and stays. Rows that repeat doc_id
and text are one document and share its result; equal ids with different texts are different documents. Null ids come
first in the order. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.common import cut_lineage, join_counted, table

MIN_WORDS = 50
M = 1 << 28  # more than the lines of a document


def _keyed(docs: DataFrame) -> DataFrame:
    th = F.xxhash64("text")
    return docs.select(F.struct("*").alias("_row"), th.alias("_th"), F.xxhash64("doc_id", th).alias("_k"))


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(k, th, doc_id, pos, h, g, fw, bw): fw and bw are the lines of the shortest windows that open and close here, null if none."""
    keyed = _keyed(docs).where(F.col("_row.text").isNotNull())
    lines = keyed.select(F.col("_k").alias("k"), F.col("_th").alias("th"), F.col("_row.doc_id").alias("doc_id"), F.posexplode(F.split("_row.text", "\n", -1)).alias("pos", "line"))
    lines = lines.select("k", "th", "doc_id", "pos", F.xxhash64("line").alias("h"), F.hash("line").alias("g"), F.regexp_count("line", F.lit(r"\S+")).alias("w"))
    doc = Window.partitionBy("k", "th")
    lines = lines.repartition("k", "th").dropDuplicates(["k", "th", "pos"]).withColumn("upto", F.sum("w").over(doc.orderBy("pos")))
    lines = lines.withColumn("total", F.max("upto").over(doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    before = F.col("upto") - F.col("w")
    ahead = F.count("*").over(doc.orderBy(before * M + F.col("pos")).rangeBetween(0, min_words * M - 1))
    behind = F.count("*").over(doc.orderBy(F.col("upto") * M + F.col("pos")).rangeBetween(1 - min_words * M, 0))
    return lines.select("k", "th", "doc_id", "pos", "h", "g", F.when(F.col("total") - before >= min_words, ahead).cast("int").alias("fw"), F.when(F.col("upto") >= min_words, behind).cast("int").alias("bw"))


def _ranked(pairs: DataFrame) -> DataFrame:
    """(k, th, pos, c) for the rows whose pair (a, b) repeats; c is in the order of the pairs."""
    repeated = pairs.groupBy("a", "b").count().where("count > 1")
    ranks = cut_lineage(repeated.orderBy("a", "b").select("a", "b", F.monotonically_increasing_id().alias("c"), "count"))
    total = ranks.agg(F.sum("count")).first()[0] or 0
    return cut_lineage(join_counted(pairs, ranks, ["a", "b"], "count", total).select("k", "th", "pos", "c"))


def later_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(k, th, s, n): windows of n lines from line s on that stood earlier."""
    lines = cut_lineage(_lines(docs, min_words))
    longest = lines.agg(F.max(F.greatest("fw", "bw"))).first()[0] or 0
    # the windows whose two ends are lines that repeat; others cannot repeat
    ranks = _ranked(lines.select("k", "th", "pos", F.col("h").alias("a"), F.col("g").cast("bigint").alias("b")))
    both = F.array(F.struct(F.col("pos").alias("s"), F.col("fw").alias("n")), F.struct((F.col("pos") - F.col("bw") + 1).alias("s"), F.col("bw").alias("n")))
    windows = cut_lineage(lines.join(ranks.select("k", "th", "pos"), ["k", "th", "pos"]).select("k", "th", "doc_id", F.inline(both)).where("n is not null").distinct())
    found, size = None, 1
    while size <= longest:
        here = windows.where((F.col("n") >= size) & (F.col("n") < 2 * size)).withColumn("e", F.col("s") + F.col("n") - size)
        here = here.join(ranks.select("k", "th", F.col("pos").alias("s"), F.col("c").alias("c1")), ["k", "th", "s"])
        here = here.join(ranks.select("k", "th", F.col("pos").alias("e"), F.col("c").alias("c2")), ["k", "th", "e"]).withColumn("size", F.lit(size))
        found = here if found is None else found.unionByName(here)
        size *= 2
        if size <= longest:
            step = Window.partitionBy("k", "th").orderBy("pos").rangeBetween(size // 2, size // 2)
            ranks = _ranked(ranks.select("k", "th", "pos", F.col("c").alias("a"), F.max("c").over(step).alias("b")).where("b is not null"))
            if ranks.isEmpty():
                break
    if found is None:
        return lines.select("k", "th", F.col("pos").alias("s"), F.col("fw").alias("n")).limit(0)
    at = F.struct(F.col("doc_id"), "k", "th", "s")
    found = cut_lineage(found.select("k", "th", "s", "n", "size", "c1", "c2", at.alias("at")))
    interval = ["size", "n", "c1", "c2"]
    first = cut_lineage(found.groupBy(*interval).agg(F.min("at").alias("first"), F.count("*").alias("m")).where("m > 1"))
    total = first.agg(F.sum("m")).first()[0] or 0
    return join_counted(found, first, interval, "m", total).where("at != first").select("k", "th", "s", "n")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The input's columns, text without later copies, and n_lines and n_deleted."""
    gone = later_windows(docs, min_words).select("k", "th", F.explode(F.sequence("s", F.col("s") + F.col("n") - 1)).alias("i")).groupBy("k", "th").agg(F.collect_set("i").alias("_gone"))
    out = _keyed(docs).join(gone.withColumnsRenamed({"k": "_k", "th": "_th"}), ["_k", "_th"], "left")
    lines = F.split("_row.text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    columns = [text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_deleted")]
    return out.select(*columns, F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).alias("n_deleted"))


def query(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_deleted", "text")


def oracle(documents: str = "documents") -> str:
    """The same over any table of documents, by comparing the windows' texts."""
    return rf"""
WITH l AS (SELECT doc_id, text, CASE WHEN text IS NOT NULL THEN string_split(text, chr(10)) ELSE [] END AS ls FROM {documents}),
e AS (SELECT doc_id, i, len(regexp_extract_all(ls[i], '\S+')) AS w FROM l, unnest(range(1, len(ls) + 1)) AS t(i)),
c AS (SELECT doc_id, i, w, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS a FROM e),
x AS (SELECT doc_id, i AS s, (SELECT min(d.i) FROM c d WHERE d.doc_id = c.doc_id AND d.i >= c.i AND d.a - (c.a - c.w) >= {MIN_WORDS}) AS z FROM c
      UNION SELECT doc_id, (SELECT max(d.i) FROM c d WHERE d.doc_id = c.doc_id AND d.i <= c.i AND c.a - (d.a - d.w) >= {MIN_WORDS}) AS s, i AS z FROM c),
y AS (SELECT doc_id, s, z, row_number() OVER (PARTITION BY array_to_string(ls[s:z], chr(10)) ORDER BY doc_id, s) AS nth FROM x JOIN l USING (doc_id) WHERE s IS NOT NULL AND z IS NOT NULL),
g AS (SELECT DISTINCT doc_id, i FROM y, unnest(range(s, z + 1)) AS t(i) WHERE nth > 1),
k AS (SELECT doc_id, string_agg(ls[e.i], chr(10) ORDER BY e.i) AS kept, count(*) AS n FROM l JOIN e USING (doc_id) ANTI JOIN g ON g.doc_id = l.doc_id AND g.i = e.i GROUP BY 1)
SELECT l.doc_id, len(ls)::INTEGER AS n_lines, (len(ls) - coalesce(n, 0))::INTEGER AS n_deleted, CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text FROM l LEFT JOIN k USING (doc_id)
"""


ORACLE = oracle()

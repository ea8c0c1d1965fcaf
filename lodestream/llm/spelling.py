"""Spelling variant grouping without pairs.

Words that differ by one replaced code point share exactly one wildcard: the word with that position blanked. Words that
differ by an inserted or deleted one meet where the longer, with that code point deleted, is the shorter. So each word is
sent under its wildcards, its distinct deletions, and itself, and all that lie under one key are looked at together: a group
keeps its size and its two commonest words, which is all that a member needs to know about the others (a word's commonest
neighbour in a group is the first, and for the first itself the second). What each word hears from its groups is added up.
No pair is ever made, and a group has as many members as an alphabet has letters, or that times the length plus one for
deletions: nothing can make one large.

Words come from a pass over all texts, counted in each task before they are sent. The rows under keys are about twice the
length of a word times the vocabulary, whatever the corpus. Roots come by pointer doubling over the words that have a form:
their counts grow at least fivefold with each step, so chains are short.

Nulls and edge cases: a null text has no words; a null id reads as the empty string. Rows that repeat are counted as often
as they occur. Ties go to the smallest word in code-point order. Very long texts are cut at white space. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.common import Tables, blocks, table
from lodestream.llm.token_counts import slices

LEAST_LENGTH = 6
LEAST_COUNT = 5
FACTOR = 5
DAMAGE = 199
FLUSH = 1 << 18

RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")


def _words(batches):
    counts: Counter = Counter()

    def rows():
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return batch

    for batch in blocks(batches, "text"):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            begun = crc32(f"{'' if doc_id is None else doc_id}:".encode())
            found: Counter = Counter()
            for part in slices(text or ""):
                found.update(RUN.findall(part.encode().lower().decode()))  # of bytes only A-Z are lowered
            for word, n in found.items():
                h = crc32(word.encode(), begun)
                if h % DAMAGE == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < LEAST_LENGTH:
                        continue
                counts[word] += n
            if len(counts) > FLUSH:
                yield rows()
    if counts:
        yield rows()


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur `least` times or more."""
    counted = docs.select("doc_id", "text").mapInArrow(_words, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, n_near, near_word, near_n): how many words are one code point away, and the commonest of them."""
    places = "sequence(1, char_length(word))"
    wild = f"transform({places}, i -> struct(2 AS kind, concat(substr(word, 1, i - 1), '_', substr(word, i + 1)) AS key))"
    less = f"array_distinct(transform({places}, i -> concat(substr(word, 1, i - 1), substr(word, i + 1))))"
    less = f"if(char_length(word) > 1, transform({less}, k -> struct(1 AS kind, k AS key)), array())"
    sent = words.select("word", "n", F.expr(f"inline(concat(array(struct(0 AS kind, word AS key)), {less}, {wild}))"))

    group = Window.partitionBy("key")
    order = group.orderBy("kind", F.desc("n"), "word")
    seen = sent.select(
        "kind", "word", "n",
        F.count("*").over(group).alias("m"),
        F.row_number().over(order).alias("i"),
        F.first(F.struct("kind", "n", "word")).over(order).alias("first"),
        F.lead(F.struct("n", "word")).over(order).alias("next"),
    ).where("m > 1 OR kind = 0")
    first = F.struct(F.col("first.n").alias("n"), F.col("first.word").alias("word"))
    longer = F.col("kind") == 1  # a deletion: near the word that stands first, if that is a word itself
    others = F.when(~longer, F.col("m") - 1).when(F.col("first.kind") == 0, 1).otherwise(0)
    best = F.when(longer, F.when(F.col("first.kind") == 0, first)).when(F.col("i") == 1, F.col("next")).otherwise(first)
    told = seen.select("word", "n", others.alias("others"), best.alias("best"))
    rank = F.when(F.col("best").isNotNull(), F.struct((-F.col("best.n")).alias("less"), F.col("best.word").alias("word")))
    out = told.groupBy("word").agg(F.max("n").alias("n"), F.sum("others").alias("n_near"), F.min(rank).alias("b"))
    return out.select("word", "n", "n_near", F.col("b.word").alias("near_word"), (-F.col("b.less")).alias("near_n"))


def roots(forms: DataFrame, tables: Tables) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, twice as far in each round."""
    now = tables.keep(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        then = tables.keep(now.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")))
        tables.drop(now)
        now = then.select("word", "root")
        if then.where("moved").isEmpty():
            return now


def group_variants(docs: DataFrame, factor: int = FACTOR, least: int = LEAST_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row for each word."""
    tables = Tables(docs.sparkSession)
    taken = F.col("near_n") >= factor * F.col("n")
    found = neighbours(vocabulary(docs, least)).withColumn("form", F.when(taken, F.col("near_word"))).withColumn("form_n", F.when(taken, F.col("near_n")))
    found = tables.keep(found.select("word", "form", "n", "n_near", "form_n"))
    ends = roots(found.where("form IS NOT NULL"), tables)
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS crc),
d AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{6,}')) AS run FROM documents),
r AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM d GROUP BY ALL),
h AS (SELECT run, n, xor(list_reduce([4294967295::BIGINT] || list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT), lambda v, b: xor(v >> 8, crc[xor(v & 255, b) + 1])), 4294967295) AS h FROM r, t),
f AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM f WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
p AS (SELECT word, n, unnest(range(length(word))) AS i FROM v),
k AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS z FROM p),
-- pairs: equal but for one position; the longer with one position left out
e AS (SELECT x.word, y.word AS near, y.n AS m FROM k x JOIN k y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT k.word, v.word, v.n FROM k JOIN v ON v.word = k.a || k.z
  UNION SELECT v.word, k.word, k.n FROM k JOIN v ON v.word = k.a || k.z),
b AS (SELECT word, count(*) AS n_near, arg_min(near, (-m, near)) AS near, max(m) AS m FROM e GROUP BY 1),
o AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN near END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM v LEFT JOIN b USING (word)),
c AS (SELECT word, word AS root FROM o UNION ALL SELECT c.word, o.form FROM c JOIN o ON o.word = c.root WHERE o.form IS NOT NULL)
SELECT o.word, o.form, c.root, o.n, o.n_near::BIGINT AS n_near, o.form_n::BIGINT AS form_n FROM o JOIN c USING (word) JOIN o q ON q.word = c.root AND q.form IS NULL
"""

"""Phrase collocation mining by Apriori's level-wise passes.

Level k counts phrases of k words over all texts. A phrase can reach the least count only if both phrases of k - 1 words
inside it do, so from level 2 on each task emits only those whose two overlapping parts are frequent. The frequent phrases of
the level before are broadcast as a bitmap of their hashes: 16 bits a phrase and 2 ** MOST_BITS bits at most, so its size is
bounded whatever the corpus. A foreign phrase that the bitmap lets through costs a row and no more, since its own count then
stays under the least count. Phrases are told apart by their text, in the tasks by exact codes of words.

Cuts are scored from the level tables: every part of every candidate is looked up once, all levels in one join, in which the
rows of parts with more than a thousandth of all occurrences (fewer than a thousand parts a level) are joined by broadcast and
stay where they are. Candidates inside longer ones that keep at least half of their count are dropped. The first phrases of
each language are taken in slices by hash first, so that no task sorts a whole language.

Nulls and edge cases: a null text is empty, a null language is `und`; a language with no candidate has no rows. Repeated rows
count as often as they occur; ids play no part. Long texts are cut at piece boundaries, over which no phrase goes; equal
scores and counts are ordered by the phrase's bytes. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import re
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.common import LOWER, Tables, Words, blocks, byte_class, fixed_bitmap, grams, in_bitmap, join_counted, mix, table

MAX_WORDS = 3
LEAST = 10
SHARE = 50
TOP = 2000
MOST_BITS = 28
SLICES = 64
BLOCK = 2 << 20

BREAKS = ".,;:!?\n\x0b\x0c\r"
WORD = byte_class(BREAKS + " \t")
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in BREAKS]] = True
BREAK_IN = re.compile("[.,;:!?\x0a-\x0d]")


def _parts(text: str, size: int = BLOCK):
    """The text cut after the first break from each `size` characters on."""
    lo = 0
    while lo < len(text):
        at = BREAK_IN.search(text, lo + size)
        hi = at.end() if at else len(text)
        yield text[lo:hi]
        lo = hi


def _of_lang(names: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x) for x in names], np.uint64)


def _places(hashes: np.ndarray, k: int, langs: np.ndarray, bits: int) -> np.ndarray:
    """Places in the bitmap of the phrases of k words that begin at each word."""
    h = grams(hashes, k)
    return mix(h ^ langs[: len(h)]) >> np.uint64(64 - bits)


def _positions(k: int, bits: int):
    """Places in the bitmap of the rows of a level's table."""

    def run(batches):
        for batch in batches:
            names = batch.column("lang").dictionary_encode()
            words = Words(batch.column("phrase"), WORD)
            langs = np.repeat(_of_lang(names.dictionary.to_pylist())[np.asarray(names.indices)], k) if len(batch) else np.zeros(0, np.uint64)
            p = _places(words.hashes, k, langs, bits)[::k] if len(batch) else langs
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int64))], ["p"])

    return run


def _counted(texts: pa.Array, names: list[str], lang: np.ndarray, k: int, known):
    """A batch (lang, phrase, n) of the phrases of k words of some texts. lang: of each text, an index into names."""
    words = Words(texts, WORD)
    n = len(words.starts)
    of_text = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
    piece = np.searchsorted(np.flatnonzero(BREAK[words.data]), words.starts)
    at = np.arange(max(n - k + 1, 0))
    if k > 1:
        at = at[(piece[at] == piece[at + k - 1]) & (of_text[at] == of_text[at + k - 1])]
        bitmap, bits = known
        frequent = in_bitmap(bitmap, _places(words.hashes, k - 1, _of_lang(names)[lang[of_text]], bits))
        at = at[frequent[at] & frequent[at + 1]]
    # exact codes: of words by their bytes, of phrases by the codes of all but the last word and of the last
    inside = WORD[words.data]
    offsets = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    spelled = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(LOWER[words.data[inside]])).dictionary_encode()
    code, size = np.asarray(spelled.indices).astype(np.int64), len(spelled.dictionary) + 1
    ids = lang[of_text[at]].astype(np.int64)
    for j in range(k):
        ids, _ = pd.factorize(ids * size + code[at + j])
    counts = np.bincount(ids)
    first = np.zeros(len(counts), np.int64)
    first[ids[::-1]] = at[::-1]
    parts = [spelled.dictionary.take(pa.array(code[first + j])) for j in range(k)]
    phrase = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
    of = pa.array(names, pa.string()).take(pa.array(lang[of_text[first]]))
    return pa.RecordBatch.from_arrays([of, phrase.cast(pa.string()), pa.array(counts)], ["lang", "phrase", "n"])


def _level(k: int, known):
    def run(batches):
        bitmap = known and (known[0].value, known[1])
        for batch in blocks(batches, "text", BLOCK):
            coded = batch.column("lang").fill_null("und").dictionary_encode()
            names, lang = coded.dictionary.to_pylist(), np.asarray(coded.indices)
            texts = batch.column("text").fill_null("")
            for some in ([texts] if len(batch) > 1 or texts.nbytes < 2 * BLOCK else map(pa.array, ([x] for x in _parts(texts[0].as_py())))):
                out = _counted(some, names, lang, k, bitmap)
                yield out
                if k == 1 and len(out):  # all words of a language, as the empty phrase
                    sums = pa.Table.from_batches([out]).group_by("lang").aggregate([("n", "sum")])
                    yield from sums.select([sums.column_names.index("lang"), sums.column_names.index("n_sum")]).rename_columns(["lang", "n"]).add_column(1, "phrase", pa.array([""] * len(sums))).combine_chunks().to_batches()

    return run


def levels(docs: DataFrame, tables: Tables, max_words: int = MAX_WORDS, least: int = LEAST) -> list[DataFrame]:
    """For k from 1 on (lang, phrase, n) of phrases of k words with n >= least; the first also has each language's number of words under the empty phrase."""
    spark, out, known = docs.sparkSession, [], None
    for k in range(1, max_words + 1):
        counted = docs.select("lang", "text").mapInArrow(_level(k, known), "lang string, phrase string, n bigint")
        out.append(tables.keep(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)))
        if k < max_words:
            frequent = out[-1].where("phrase != ''")
            bits = min(max((16 * frequent.count()).bit_length(), 20), MOST_BITS)
            bitmap = fixed_bitmap(frequent.select("lang", "phrase").mapInArrow(_positions(k, bits), "p bigint"), bits)
            known = (spark.sparkContext.broadcast(bitmap), bits)
    return out


def _some(first: str, length: str) -> str:
    return f"array_join(slice(words, {first}, {length}), ' ')"


def scored(of_size: list[DataFrame], total: int, share: int = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, score, cover): the lowest-scoring cut of each phrase of two words or more, and the largest count of a longer phrase that holds it."""
    most = len(of_size)
    every = of_size[0].where("phrase != ''").withColumn("k", F.lit(1))
    for k, df in enumerate(of_size[1:], 2):
        every = every.unionByName(df.withColumn("k", F.lit(k)))
    candidates = every.where("k > 1").withColumn("words", F.split("phrase", " "))
    cuts = "transform(sequence(1, k - 1), j -> array(struct(j AS cut, true AS front, " + _some("1", "j") + " AS part), struct(j AS cut, false AS front, " + _some("j + 1", "k - j") + " AS part)))"
    asked = candidates.select("lang", "phrase", F.col("n").alias("a"), F.expr(f"inline(flatten({cuts}))"))
    table_ = every.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"), F.col("n").alias("m"))
    answers = join_counted(asked, table_, ["lang", "part"], "m", total).select("lang", "phrase", "a", "cut", "front", "f", F.lit(None).cast("bigint").alias("cover"))
    shorter = "flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), i -> " + _some("i", "s") + ")))"
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("a", "bigint"), ("cut", "int"), ("front", "boolean"), ("f", "bigint"))]
    covers = candidates.where("k > 2").select("lang", F.explode(F.expr(shorter)).alias("phrase"), *nothing, F.col("n").alias("cover"))
    sides = [F.max(F.when((F.col("cut") == j) & (F.col("front") == side), F.col("f"))).alias(f"{'l' if side else 'r'}{j}") for j in range(1, most) for side in (True, False)]
    met = answers.unionByName(covers).groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("cover").alias("cover"), *sides)
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products of counts pass 64 bits
    million = F.lit(1_000_000).cast("decimal(7,0)")

    def cut(j):
        score = F.call_function("div", million * (wide("a") * wide("a")), wide(f"l{j}") * wide(f"r{j}"))
        return F.when(F.col(f"l{j}").isNotNull(), F.struct(score.alias("score"), F.lit(j).alias("cut"), F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r")))

    best = F.least(*(cut(j) for j in range(1, most))) if most > 2 else cut(1)
    return met.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score", "cover")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language."""
    tables = Tables(docs.sparkSession)
    of_size = levels(docs, tables, max_words, least)
    words = of_size[0].where("phrase = ''").select("lang", "n")
    total = words.agg(F.sum("n")).first()[0] or 0
    kept = scored(of_size, total, share).where(F.col("cover").isNull() | (100 * F.col("cover").cast("decimal(19,0)") < share * F.col("a").cast("decimal(19,0)")))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SLICES))
    near = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    first = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return first.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS phrase FROM w, range(1, 4) t(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
x AS (SELECT c.*, j, array_to_string(ws[1 : j], ' ') AS front, array_to_string(ws[j + 1 : k], ' ') AS rest FROM c, range(1, 3) t(j) WHERE j < k),
s AS (SELECT x.*, l.f AS l, r.f AS r, 1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f) AS score FROM x JOIN f l ON l.lang = x.lang AND l.phrase = front AND l.k = j JOIN f r ON r.lang = x.lang AND r.phrase = rest AND r.k = x.k - j),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT lang, array_to_string(ws[i : i + 1], ' ') AS phrase, max(a) AS cover FROM c, range(1, 3) t(i) WHERE k = 3 GROUP BY ALL),
r AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase AND b.k = 2 WHERE cover IS NULL OR 100 * cover < 50 * a)
SELECT r.lang, rank, phrase, a, l, r.r, n.n::BIGINT AS n, score::BIGINT AS score FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""

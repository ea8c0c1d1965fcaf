"""Language identification by word-first backoff.

A known word scores by its log frequency in each language; an unseen one falls back to its character n-grams, longest
first: the longest n for which one of its n-grams is known gives the mean log frequency of those known. A text's languages
are compared by the summed scores of all its words.

The tables are learned from a bounded sample of labelled rows, TRAIN_DOCS documents in expectation, dealt by a hash of the
id over the whole table; words seen fewer than MIN_COUNT times in it are left to the n-grams. The model that is broadcast
is bounded by the sample. Everything else reads whole texts.

Nulls and edge cases: a null text, or one without a letter, is `und` with score 0. Without labelled rows everything with a
letter is `und` too. Ties go to the language that is first in order. Rows that repeat are scored alike. Other columns are
kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm.common import blocks, held_out, table

TRAIN_DOCS = 4000
MIN_COUNT = 3
LONGEST = 4
CACHE = 100_000
LETTERS = re.compile(r"[^\W\d_]+")


def ngrams(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _counted(batches):
    """Counts by language of words (size 0) and of their n-grams (size n), summed over a partition."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            counts[lang].update(LETTERS.findall(text.lower()))
    for lang, words in counts.items():
        for size in range(LONGEST + 1):
            keys = words
            if size:
                keys = Counter()
                for w, n in words.items():
                    for g in ngrams(w, size):
                        keys[g] += n
            rows = list(keys.items())
            for lo in range(0, len(rows), 100_000):
                k, n = zip(*rows[lo : lo + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array([size] * len(k), pa.int32()), pa.array(k), pa.array(n, pa.int64())], ["lang", "size", "key", "n"])


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> dict:
    """{"langs": [...], 0: (words, scores), n: (n-grams, scores)} from rows that are not held out and have a language: words as an Arrow array, scores as a matrix of them by languages. The counts come to the driver as Arrow columns, so it never holds an object for each."""
    labelled = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null").where(~held_out("doc_id"))
    scale = 1 << 20
    keep = math.ceil(scale * min(1.0, train_docs / max(labelled.count(), 1)))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < keep).select("text", "lang")
    counted = sample.mapInArrow(_counted, "lang string, size int, key string, n bigint").groupBy("lang", "size", "key").agg(F.sum("n").alias("n"))
    rows = counted.where(f"size > 0 or n >= {MIN_COUNT}").toArrow()  # of the bounded sample; rarer words count for the n-grams only
    langs = sorted(rows.column("lang").unique().to_pylist())
    lang = np.asarray(pa.compute.index_in(rows.column("lang").combine_chunks(), pa.array(langs, pa.string())), np.int64) if langs else np.zeros(0, np.int64)
    size, model = np.asarray(rows.column("size")), {"langs": langs}
    for k in range(LONGEST + 1):
        of = np.flatnonzero(size == k)
        coded = rows.column("key").take(pa.array(of)).combine_chunks().dictionary_encode()
        x = np.full((len(coded.dictionary), max(len(langs), 1)), 0.1)
        np.add.at(x, (np.asarray(coded.indices, np.int64), lang[of]), np.asarray(rows.column("n"))[of])
        model[k] = (coded.dictionary, np.log(x / x.sum(axis=0)))
    return model


class Scores(dict):
    """word -> row of `rows`, a matrix of words by languages; rows of unseen words are worked out once and forgotten when there are too many. No object is kept for a score: a worker keeps its memory for the stages that follow."""

    def __init__(self, model: dict):
        self.model, self.known = model, len(model[0][0])
        self.grams = {n: dict(zip(model[n][0].to_pylist(), range(len(model[n][0])))) for n in range(1, LONGEST + 1)}
        self.rows = np.concatenate([model[0][1], np.zeros((1024, model[0][1].shape[1]))])
        self.reset()

    def reset(self):
        self.clear()
        self.update(zip(self.model[0][0].to_pylist(), range(self.known)))

    def __missing__(self, word: str) -> int:
        row, at = self.backoff(word), len(self)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((at - self.known, self.rows.shape[1]))])
        self[word], self.rows[at] = at, row
        return at

    def backoff(self, word: str) -> tuple[float, ...]:
        for n in range(LONGEST, 0, -1):
            known = [i for i in map(self.grams[n].get, ngrams(word, n)) if i is not None]
            if known:
                return tuple(sum(x) / len(known) for x in zip(*self.model[n][1][known].tolist()))
        return (0.0,) * self.rows.shape[1]

    def of(self, text: str) -> tuple[str, float]:
        words = LETTERS.findall(text.lower())
        langs = self.model["langs"]
        if not words or not langs:
            return "und", 0.0
        if len(self) > self.known + CACHE:
            self.reset()
        at, times = np.unique(np.fromiter(map(self.__getitem__, words), np.int64, len(words)), return_counts=True)
        sums = times @ self.rows[at]
        best = int(sums.argmax())
        return langs[best], float(1 / np.exp(np.minimum(sums - sums[best], 0)).sum())


def _predicted(model):
    def run(batches):
        scores = Scores(model.value)
        for batch in blocks(batches, "text"):
            found = [scores.of(t or "") for t in batch.column("text").to_pylist()]
            keep = [n for n in batch.schema.names if n not in ("lang_pred", "score")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*keep, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """The input's columns, and lang_pred and score; inputs of these names are replaced. Only text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name not in ("lang_pred", "score"))
    return docs.mapInArrow(_predicted(shared), f"{fields}lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs.select("doc_id", "text"), fit(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


ORACLE = None

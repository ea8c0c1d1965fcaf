"""Keywords in documents: one automaton over a keyword table."""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of keywords in one automaton. A larger table takes a pass over the documents for each so many.
MOST_CHARS = 4 << 20

_WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


class _Fold(dict):
    """Lower case of single characters; none but ASCII letters become ASCII, none become two."""

    def __missing__(self, code: int) -> int:
        low = chr(code).lower()
        out = ord(low) if len(low) == 1 and (code < 128) == (ord(low) < 128) else code
        self[code] = out
        return out


_fold = _Fold()


def fold(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_fold)


class Matcher:
    """All keywords in one pass over a text, by Aho and Corasick's automaton."""

    def __init__(self, keywords: list[str]):
        import ahocorasick

        self.forms = sorted({fold(k) for k in keywords} - {""})
        self.spelled: dict[str, list[str]] = {}
        for k in keywords:
            self.spelled.setdefault(fold(k), []).append(k)
        self.automaton = ahocorasick.Automaton()
        for i, form in enumerate(self.forms):
            self.automaton.add_word(form, i)
        if self.forms:
            self.automaton.make_automaton()

    def counts(self, text: str) -> list[tuple[str, int]]:
        """(keyword, n) of the keywords that stand in the text: how often, without overlaps, between word boundaries."""
        if not self.forms:
            return []
        text, free, n = fold(text), {}, Counter()
        for end, i in self.automaton.iter(text):
            start, end = end + 1 - len(self.forms[i]), end + 1
            n[i] += 0
            before = start > 0 and text[start - 1] in _WORD
            after = end < len(text) and text[end] in _WORD
            if before != (text[start] in _WORD) and after != (text[end - 1] in _WORD) and free.get(i, 0) <= start:
                n[i] += 1
                free[i] = end
        return [(k, c) for i, c in sorted(n.items()) for k in self.spelled[self.forms[i]]]


_made: dict[str, Matcher] = {}


def _matched(name: str, shared):
    def run(batches):
        if name not in _made:
            _made.clear()
            _made[name] = Matcher(shared.value)
        for batch in batches:
            ids, rows = batch.column("doc_id"), []
            for i, text in enumerate(batch.column("text").to_pylist()):
                rows += [(i, *x) for x in _made[name].counts(text or "")]
            at, keys, n = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(keys, pa.string()), pa.array(n, pa.int64())], ["doc_id", "keyword", "n"])

    return run


def _parts(keywords: DataFrame, most: int):
    """Lists of keywords with `most` characters together at most, in order; the driver holds one at a time."""
    part, size = [], 0
    for r in keywords.select("keyword").where("keyword != ''").distinct().orderBy("keyword").toLocalIterator():
        if part and size + len(r.keyword) > most:
            yield part
            part, size = [], 0
        part.append(r.keyword)
        size += len(r.keyword)
    yield part


def keyword_counts(docs: DataFrame, keywords: DataFrame, most: int = MOST_CHARS) -> DataFrame:
    """(doc_id, keyword, n) for each keyword that stands in a document, in any case: n counts its occurrences between word boundaries and may be 0. docs: (doc_id, text); keywords: (keyword). The keywords are broadcast, `most` characters at a time; no row of documents is shuffled, and no pair is made that doesn't match."""
    out = None
    for part in _parts(keywords, most):
        shared = docs.sparkSession.sparkContext.broadcast(part)
        kind = docs.schema["doc_id"].dataType.simpleString()
        found = docs.select("doc_id", "text").mapInArrow(_matched(uuid.uuid4().hex, shared), f"doc_id {kind}, keyword string, n bigint")
        out = found if out is None else out.unionByName(found)
    return out


def keyword_coverage(found: DataFrame, keywords: DataFrame) -> DataFrame:
    """(keyword, documents, occurrences) of every keyword, also of those that stand nowhere. found: of keyword_counts."""
    sums = found.groupBy("keyword").agg(F.count("*").alias("documents"), F.sum("n").alias("occurrences"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", "occurrences")]
    return keywords.select("keyword").where("keyword != ''").distinct().join(sums, "keyword", "left").select("keyword", *zero)

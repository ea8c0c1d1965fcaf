"""Token counts of whole texts under a BPE tokenizer with word ends, without a shuffle of pre-tokens.

A text's tokens are the sum over its pre-tokens (runs of letters, single digits, runs of other signs, English endings), so
each task looks lengths up in two tiers. The first is a broadcast table of the FREQUENT commonest pre-tokens: packed strings
and one length each, the same size whatever the corpus. The second is a cache in each Python worker, kept from task to task;
only what is in neither is encoded by the library. A cache that is full starts anew.

The commonest pre-tokens come from all texts: each task keeps a summary of at most FREQUENT counts (the rarest are forgotten
when it overflows), and summaries are merged in a tree of fan-in FAN, each again to FREQUENT counts. What moves is one row a
task, never pre-tokens. The table decides only how often the library is asked, not what a text counts.

Cutting a text into pre-tokens must be the library's own. Inside PLAIN (ASCII, Latin-1 and general punctuation, which
composition leaves alone) one pattern does it. A run without white space that holds any other character, or a special
token, is one key and goes to the library whole; white space separates pre-tokens always.

Nulls and edge cases: a null or empty text has no bytes and no tokens; so has one of white space alone. The strings of
special tokens inside texts count as the library has it by default: as one token each. Very long texts are cut at white
space; one without any is a single key. Repeated rows give repeated results, null and repeated ids included. Other columns
are ignored; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm.common import blocks, table

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
FREQUENT = 1 << 13
CACHE = 1 << 18
LONG = 256  # longer keys are encoded whenever they come
FAN = 64
SLICE = 1 << 20

PLAIN = "\t\n\r -~¡-ÿ‐-‧‰-⁞€"
ODD = re.compile(rf"[^{PLAIN}]|<\|(?:start|end)oftext\|>")
# Fixed value: the pre-tokens of the tokenizer, for characters of PLAIN in lower case.
PRE_TOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
SPACE = re.compile("[ \t\n\r]")
SOLID = re.compile("[^ \t\n\r]+")


def slices(text: str, size: int = SLICE):
    """The text, cut at white space after each `size` characters."""
    lo = 0
    while lo < len(text):
        cut = SPACE.search(text, lo + size)
        hi = cut.start() if cut else len(text)
        yield text[lo:hi]
        lo = hi


def pre_tokens(text: str):
    """Lists of keys whose token counts add up to the text's."""
    for piece in slices(text):
        if ODD.search(piece):
            plain = []
            odd = [x for x in SOLID.findall(piece) if ODD.search(x) or plain.append(x)]
            yield odd
            piece = " ".join(plain)
        yield PRE_TOKEN.findall(piece.lower())


class Lengths(dict):
    """Tokens of a key: the frequent ones are its items, others come from a bounded cache, then from the library."""

    def __init__(self, frequent: dict[str, int], tokenizer, size: int = CACHE):
        super().__init__(frequent)
        self.tokenizer, self.size, self.cache, self.asked = tokenizer, size, {}, 0

    def __missing__(self, key: str) -> int:
        n = self.cache.get(key)
        if n is None:
            n = len(self.tokenizer.encode(key, add_special_tokens=False).ids)
            self.asked += 1
            if len(self.cache) >= self.size:
                self.cache.clear()
            if len(key) < LONG:
                self.cache[key] = n
        return n

    def tokens(self, text: str) -> int:
        return sum(sum(map(self.__getitem__, keys)) for keys in pre_tokens(text))


def commonest(counts: Counter, most: int) -> list[tuple[str, int]]:
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]


def _packed(task: int, counts: Counter, most: int) -> pa.RecordBatch:
    top = [x for x in commonest(counts, most) if len(x[0]) < LONG]
    columns = [[task], [[k for k, _ in top]], [[n for _, n in top]]]
    kinds = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], ["task", "keys", "ns"])


def _unpacked(rows) -> Counter:
    counts: Counter = Counter()
    for keys, ns in rows:
        for k, n in zip(keys, ns):
            counts[k] += n
    return counts


def _summary(most: int):
    def run(batches):
        counts: Counter = Counter()
        for batch in blocks(batches, "text"):
            for text in batch.column("text").to_pylist():
                for keys in pre_tokens(text or ""):
                    counts.update(keys)
                if len(counts) > 8 * most:
                    counts = Counter(dict(commonest(counts, most)))
        yield _packed(TaskContext.get().partitionId(), counts, most)

    return run


def _merged(most: int):
    def run(rows: pa.Table) -> pa.Table:
        counts: Counter = Counter()
        for batch in rows.to_batches(max_chunksize=8):
            counts.update(_unpacked(zip(batch.column("keys").to_pylist(), batch.column("ns").to_pylist())))
            if len(counts) > 8 * most:
                counts = Counter(dict(commonest(counts, most)))
        return pa.Table.from_batches([_packed(rows.column("task")[0].as_py() // FAN, counts, most)])

    return run


def frequent_keys(docs: DataFrame, most: int = FREQUENT) -> list[str]:
    """About the `most` commonest keys of all texts."""
    kinds, tasks = "task int, keys array<string>, ns array<bigint>", docs.rdd.getNumPartitions()
    rows = docs.select("text").mapInArrow(_summary(most), kinds)
    while tasks > FAN:
        rows, tasks = rows.groupBy(F.floor(F.col("task") / FAN)).applyInArrow(_merged(most), kinds), -(-tasks // FAN)
    counts = _unpacked((r["keys"], r["ns"]) for r in rows.collect())  # FAN rows at most
    return [k for k, _ in commonest(counts, most)]


_made: dict[object, Lengths] = {}  # of this Python worker, by broadcast


def _lengths(shared) -> Lengths:
    """Kept by the worker as long as it works on the same broadcast."""
    from tokenizers import Tokenizer

    if shared.id not in _made:
        _made.clear()
        _made[shared.id] = Lengths(dict(zip(shared.value["keys"].split(" "), shared.value["lengths"])), Tokenizer.from_str(shared.value["tokenizer"]))
    return _made[shared.id]


class _Shared:
    """A broadcast with a name that workers can keep its contents by."""

    def __init__(self, spark, value: dict):
        import uuid

        self.id, self.broadcast = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    @property
    def value(self) -> dict:
        return self.broadcast.value


def _counted(shared, limit: int):
    def run(batches):
        lengths = _lengths(shared)
        for batch in blocks(batches, "text", 4 << 20):
            texts = batch.column("text")
            n_bytes = pa.compute.binary_length(texts).cast(pa.int64()).fill_null(0)
            n = pa.array([lengths.tokens(t or "") for t in texts.to_pylist()], pa.int64())
            columns = [batch.column("doc_id"), n_bytes, n, pa.compute.greater(n, limit)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row, in one stage without a shuffle."""
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    tokenizer, keys = Tokenizer.from_str(model), frequent_keys(docs, frequent)
    lengths = [len(x.ids) for x in tokenizer.encode_batch(keys, add_special_tokens=False)]
    small = bytes(lengths) if max(lengths, default=0) < 256 else lengths
    shared = _Shared(docs.sparkSession, {"keys": " ".join(keys), "lengths": small if keys else [], "tokenizer": model})
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(_counted(shared, limit), schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


ORACLE = None

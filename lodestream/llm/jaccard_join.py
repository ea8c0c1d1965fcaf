"""N-gram Jaccard self-join by multiple global orders.

A text's set is its distinct shingles of N words. Two sets of Jaccard similarity 3/4 or more share a token among their
first n - ceil(3n/4) + 1 tokens under any global order. Here a pair must do so under three before its sets are fetched:

- A: rarest first, by the number of classes that have a token, then by its hash. Classes are dealt to groups, and a group
  sends each of its tokens once, with a count, packed, to the token's bucket; the bucket replies with the sum's logarithm.
  Tokens that only one class has go no further, so what goes on is in proportion to what texts share, at every size. The
  tokens of one half of all hashes come first in the order and only they are counted: a prefix rarely needs others.
- B: by another hash; C: B reversed. Their prefixes are fetched for the pairs that order A and the bounds below leave.

Those bounds, which no similar pair fails, are of sizes, of positions under A, and of parity bitmaps (two bits a token).
Last, the sets of pairs that passed all orders are fetched and their intersection is counted.

Documents of equal sets are one class. In round one each class is a candidate of the least class of its rarest shared
token, in round two of those of its other tokens where they are not connected yet, then of those that share a token and the
first token under one of some more orders, so a group of near copies gives candidates in proportion to its size; in round three, pairs of one token that are still not connected are candidates, if
their sizes and smaller parity bitmaps allow it. So every link that joins components is found, and a group of n near copies
needs no n * n pairs.

Order A works on 48 bits of a shingle's hash, B and C on 32, the intersection on 64: equal tokens are equal in each. Groups
and buckets are of GROUP tokens, about, and their number follows the input. Sets are recomputed from the texts of
candidates; a bitmap of fixed size picks those before any shuffle.

Nulls and edge cases: null, empty and blank texts have empty sets and are linked with nothing. Texts of fewer than N words
have their whole sequence as one token. Rows of the same doc_id are linked by their texts only; a null doc_id takes part,
and its row's component is the least id that is not null. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.common import Tables, Words, blocks, byte_class, fixed_bitmap, grams, in_bitmap, mix, table

N = 5
TOKEN_BYTES, COUNTED = 6, 1 << 47  # of a token under order A; tokens below COUNTED come first
BITMAP_BITS = 24
SEEN = 100_000
FOLDED = 8  # longs of the smaller bitmap of round three
MINS = 3
GROUP = 1 << 19
WORD = byte_class(" \t\n\x0b\x0c\r")


def prefix_size(n):
    """How many first tokens of a set of n must be looked at: n - ceil(3n / 4) + 1."""
    return n - (3 * n + 3) // 4 + 1


def sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, WORD)
    all_grams, out = grams(words.hashes, N), []
    for lo, hi in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        tokens = all_grams[lo : hi - N + 1] if hi - lo >= N else grams(words.hashes[lo:hi], hi - lo) if hi > lo else all_grams[:0]
        out.append(np.unique(tokens))
    return out


def signature(tokens: np.ndarray) -> int:
    """A hash of the whole set."""
    return int(np.bitwise_xor.reduce(mix(tokens + np.uint64(0x632BE59BD9B4E019)), initial=np.uint64(0)).view(np.int64)) if len(tokens) else 0


def parity(tokens: np.ndarray, bits: int = 0) -> bytes:
    """A bitmap, of 2 bits a token or more if its size isn't given, that tells of each cell whether an odd number of tokens fell into it. Two sets differ in at least as many tokens as their bitmaps in bits."""
    bits = bits or 1 << max(6, int(2 * len(tokens) - 1).bit_length())
    return np.packbits((np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def first_half(tokens: np.ndarray) -> np.ndarray:
    """What order A needs of a set: the counted tokens, and of the others as many first ones as a prefix may need."""
    tokens = np.sort(tokens & np.uint64((1 << 8 * TOKEN_BYTES) - 1))
    counted = int(np.searchsorted(tokens, COUNTED))
    return tokens[: max(counted, prefix_size(len(tokens)))]


def pack(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // TOKEN_BYTES, 8), np.uint8)
    out[:, :TOKEN_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BYTES)
    return out.view("<u8").ravel()


def _signed(batches):
    """Each document's set size, signature and parity bitmap, and what order A needs of the set, where the task hasn't given it for an equal one."""
    seen: set[int] = set()
    for batch in blocks(batches, "text"):
        found = sets(batch.column("text"))
        sigs, firsts = [signature(s) for s in found], []
        if len(seen) > SEEN:
            seen.clear()
        for s, sig in zip(found, sigs):
            firsts.append(pack(first_half(s)) if len(s) and sig not in seen else None)
            seen.add(sig)
        maps = [parity(s) for s in found]
        offsets = np.concatenate([[0], np.cumsum([len(m) // 8 for m in maps])]).astype(np.int32)
        maps = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(maps), np.int64)))
        folded = pa.FixedSizeListArray.from_arrays(pa.array(np.frombuffer(b"".join(parity(s, 64 * FOLDED) for s in found), np.int64)), FOLDED).cast(pa.list_(pa.int64()))
        mins = _lists([np.array([mix(s ^ np.uint64(i)).min() if len(s) else 0 for i in range(1, MINS + 1)], np.uint64).view(np.int64) for s in found])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in found], pa.int64()), pa.array(sigs, pa.int64()), maps, folded, mins, pa.array(firsts, pa.binary())], ["doc_id", "n", "sig", "bits", "folded", "mins", "firsts"])


class Group:
    """The classes of a group, their tokens, and its distinct counted tokens in the order of buckets."""

    def __init__(self, rows: pa.Table, buckets: int):
        sig, at = np.unique(rows["sig"].to_numpy(), return_index=True)
        firsts, n = rows["firsts"].take(pa.array(at)).to_pylist(), rows["n"].to_numpy()[at]
        self.sig, self.n, self.tokens = sig, n, unpack(b"".join(firsts))
        self.of = np.repeat(np.arange(len(sig)), [len(x) // TOKEN_BYTES for x in firsts])
        counted = self.tokens < COUNTED
        self.distinct, n_classes = np.unique(self.tokens[counted], return_counts=True)
        bucket = (mix(self.distinct) % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.bucket, self.n_classes = bucket[self.order], n_classes[self.order].astype(np.uint32)

    def by_bucket(self) -> pa.Table:
        cuts = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        tokens = [pack(self.distinct[o]) for o in np.split(self.order, cuts[1:])] if len(cuts) else []
        counts = [x.tobytes() for x in np.split(self.n_classes, cuts[1:])] if len(cuts) else []
        return pa.table({"bucket": pa.array(self.bucket[cuts], pa.int64()), "tokens": pa.array(tokens, pa.binary()), "counts": pa.array(counts, pa.binary())})

    def entries(self, replies: pa.Table) -> pa.Table:
        """(token, sig, n, pos) of the prefix tokens that more than one class has or that aren't counted."""
        at = np.argsort(replies["bucket"].to_numpy())
        levels = np.zeros(len(self.distinct), np.uint64)
        levels[self.order] = np.frombuffer(b"".join(zlib.decompress(x) for x in replies["levels"].take(pa.array(at)).to_pylist()), np.uint8)
        level = np.full(len(self.tokens), 255, np.uint64)
        counted = self.tokens < COUNTED
        level[counted] = levels[np.searchsorted(self.distinct, self.tokens[counted])]
        order = np.lexsort((self.tokens | (level << np.uint64(8 * TOKEN_BYTES)), self.of))
        of = self.of[order]
        pos = np.arange(len(of)) - np.searchsorted(of, of, "left") + 1
        kept = (pos <= prefix_size(self.n)[of]) & (level[order] > 0)
        return pa.table({"token": self.tokens[order][kept].view(np.int64), "sig": self.sig[of[kept]], "n": self.n[of[kept]].astype(np.int32), "pos": pos[kept].astype(np.int32)})


def _to_buckets(buckets: int):
    def run(key, rows):
        out = Group(rows, buckets).by_bucket()
        return out.add_column(0, "grp", pa.array([key[0].as_py()] * len(out), pa.int64()))

    return run


def _levels(bucket):
    """Replies: for each group's tokens the logarithm of the number of classes, rounded up; 0 for one class."""
    tokens = [unpack(x) for x in bucket["tokens"].to_pylist()]
    counts = [np.frombuffer(x, np.uint32) for x in bucket["counts"].to_pylist()]
    distinct, at = np.unique(np.concatenate(tokens), return_inverse=True)
    total = np.bincount(at, np.concatenate(counts), len(distinct))
    levels, ends = np.ceil(np.log2(total)).astype(np.uint8)[at], np.cumsum([len(x) for x in tokens])
    packed = [zlib.compress(x.tobytes(), 1) for x in np.split(levels, ends[:-1])]
    return pa.table({"grp": bucket["grp"], "bucket": bucket["bucket"], "levels": pa.array(packed, pa.binary())})


def _entries(buckets: int):
    def run(rows, replies):
        return Group(rows, buckets).entries(replies)

    return run


def _order_b(tokens: np.ndarray) -> np.ndarray:
    return np.sort(mix(tokens ^ np.uint64(0x5A5A5A5A)))


def _ends(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit fingerprints of the prefix tokens under B and C."""
    ranks, p = _order_b(tokens), prefix_size(len(tokens))
    return ranks[:p].astype(np.uint32).view(np.int32), ranks[len(ranks) - p :].astype(np.uint32).view(np.int32)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)), pa.array(np.concatenate(parts)))


def _chosen(bitmap, whole: bool):
    """Of the texts whose bit is set: the whole sets, or the prefixes under B and C."""

    def run(batches):
        for batch in blocks(batches, "text"):
            chosen = batch.filter(pa.array(in_bitmap(bitmap.value, batch.column("p").to_numpy(zero_copy_only=False).astype(np.uint64))))
            found = [s for s in sets(chosen.column("text")) if len(s)] if chosen.num_rows else []
            if found:
                sig = pa.array([signature(s) for s in found], pa.int64())
                if whole:
                    yield pa.RecordBatch.from_arrays([sig, _lists([s.view(np.int64) for s in found])], ["sig", "tokens"])
                else:
                    yield pa.RecordBatch.from_arrays([sig, *map(_lists, zip(*map(_ends, found)))], ["sig", "b_tokens", "c_tokens"])

    return run


def fetched(ids: DataFrame, classes: DataFrame, docs: DataFrame, whole: bool) -> DataFrame:
    """Whole sets (sig, tokens), or prefixes (sig, b_tokens, c_tokens), of the classes in ids(sig), from the texts of their least documents."""
    ids = ids.join(classes.select("sig", "rep"), "sig")
    bitmap = docs.sparkSession.sparkContext.broadcast(fixed_bitmap(ids.select(_bit("rep").alias("p")), BITMAP_BITS))
    kind = "tokens array<bigint>" if whole else "b_tokens array<int>, c_tokens array<int>"
    return docs.where("text is not null").mapInArrow(_chosen(bitmap, whole), f"sig bigint, {kind}").join(ids.select("sig"), "sig", "left_semi").dropDuplicates(["sig"])


def _both_ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, tables: Tables) -> DataFrame:
    """The pairs (a, b) of classes that link. classes: (sig, n, rep, bits); docs: (doc_id, text, p)."""

    def sides(pairs: DataFrame, of: DataFrame) -> DataFrame:
        for c in "ba":
            pairs = pairs.join(of.select(*(F.col(x).alias(c if x == "sig" else f"{x}_{c}") for x in of.columns)), c)
        return pairs

    near = sides(pairs, classes.select("sig", "n", "bits")).where(F.least("n_a", "n_b") * 4 >= F.greatest("n_a", "n_b") * 3)
    near = tables.keep(near.where(_differing(F.col("bits_a"), F.col("bits_b")) * 7 <= F.col("n_a") + F.col("n_b")).select("a", "b"))
    both = sides(near, fetched(_both_ends(near), classes, docs, whole=False))
    both = tables.keep(both.where(F.arrays_overlap("b_tokens_a", "b_tokens_b") & F.arrays_overlap("c_tokens_a", "c_tokens_b")).select("a", "b"))
    tables.drop(near)
    shared, total = F.size(F.array_intersect("tokens_a", "tokens_b")), F.size("tokens_a") + F.size("tokens_b")
    links = tables.keep(sides(both, fetched(_both_ends(both), classes, docs, whole=True)).where(100 * shared >= 75 * (total - shared)).select("a", "b"))
    tables.drop(both)
    return links


def _differing(x, y):
    """In how many bits two parity bitmaps differ, the longer one folded; lengths are powers of two and differ once at most."""
    half = lambda c: F.zip_with(F.slice(c, F.lit(1), (F.size(c) / 2).cast("int")), F.slice(c, (F.size(c) / 2).cast("int") + 1, (F.size(c) / 2).cast("int")), lambda p, q: p.bitwiseXOR(q))
    a = F.when(F.size(x) > F.size(y), half(x)).otherwise(x)
    b = F.when(F.size(y) > F.size(x), half(y)).otherwise(y)
    return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, k: n + k)


def _bit(column: str):
    return F.pmod(F.xxhash64(column), F.lit(1 << BITMAP_BITS))


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """(v, c): the least vertex c that v is connected with, for the vertices of edges (a, b); by large and small stars."""
    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = tables.keep(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        last, edges = edges, tables.keep(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(least.select("a", F.col("m").alias("b"))).distinct())
        tables.drop(last)
        now = state(edges)
        if now == before:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("c"))
        before = now


def _possible(n, pos, m, at):
    """Whether similar sets of n and m tokens can have their first common token under A at these positions: all that they share comes from there on."""
    n, pos, m, at = map(F.col, (n, pos, m, at))
    return (F.least(n, m) * 4 >= F.greatest(n, m) * 3) & ((F.least(n - pos, m - at) + 1) * 7 >= (n + m) * 3)


def link(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id). doc_id may be of any type that has an order."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    tables = Tables(spark)
    docs = docs.select("doc_id", "text", _bit("doc_id").alias("p"))
    signed = tables.keep(docs.select("doc_id", "text").mapInArrow(_signed, f"doc_id {kind}, n bigint, sig bigint, bits array<bigint>, folded array<bigint>, mins array<bigint>, firsts binary"))
    rows = signed.select("doc_id", "n", "sig")
    classes = tables.keep(signed.where("n > 0").groupBy("sig", "n").agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits"), F.first("folded").alias("folded"), F.first("mins").alias("mins")))

    n_groups = 1 + (signed.agg(F.sum(F.length("firsts"))).first()[0] or 0) // (TOKEN_BYTES * GROUP)
    grouped = signed.where("firsts is not null").select(F.pmod(F.xxhash64("sig"), F.lit(n_groups)).alias("grp"), "sig", "n", "firsts").groupBy("grp")
    replies = grouped.applyInArrow(_to_buckets(n_groups), "grp bigint, bucket bigint, tokens binary, counts binary").groupBy("bucket").applyInArrow(_levels, "grp bigint, bucket bigint, levels binary")
    of_token = tables.keep(grouped.cogroup(replies.groupBy("grp")).applyInArrow(_entries(n_groups), "token bigint, sig bigint, n int, pos int"))
    lead = of_token.groupBy("token").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi"), F.min(F.struct("pos", "sig", "n")).alias("lead"), F.count("*").alias("k"))
    lead = lead.where("lo != hi").select("token", "k", *(F.col(f"lead.{c}").alias(f"lead_{c}") for c in ("pos", "sig", "n")))
    near = tables.keep(of_token.join(lead, "token").where("sig != lead_sig"))
    tables.drop(of_token)

    # round one: each class with the leads of its rarest and of its commonest shared token
    may = near.where(_possible("n", "pos", "lead_n", "lead_pos"))
    firsts = may.groupBy(F.col("sig").alias("b")).agg(F.array_distinct(F.array(F.min_by("lead_sig", "pos"), F.min_by("lead_sig", F.struct(-F.col("k"), "pos")))).alias("as"))
    firsts = tables.keep(firsts.select(F.explode("as").alias("a"), "b"))
    connected = components(verified(firsts, classes, docs, tables), tables)

    def labelled(rows: DataFrame, of_: str, name: str) -> DataFrame:
        return rows.join(connected.select(F.col("v").alias(of_), F.col("c").alias(name)), of_, "left").withColumn(name, F.coalesce(name, of_))

    def with_links(more: DataFrame) -> DataFrame:
        """The components with more links: those between the same two components count once, and only components that have some are worked on."""
        ends = labelled(labelled(more, "a", "c"), "b", "d").select(F.col("c").alias("a"), F.col("d").alias("b")).distinct()
        joined = components(ends, tables)
        new = connected.join(joined.select(F.col("v").alias("c"), F.col("c").alias("m")), "c", "left").select("v", F.coalesce("m", "c").alias("c")).unionByName(joined)
        new = tables.keep(new)
        tables.drop(connected, joined, more)
        return new

    # round two: with the leads of its other tokens, where they are not connected yet
    stars = labelled(labelled(may.select("lead_sig", "sig").distinct(), "sig", "c"), "lead_sig", "d").where("c != d").select(F.col("lead_sig").alias("a"), F.col("sig").alias("b"))
    more = verified(stars.join(firsts, ["a", "b"], "left_anti"), classes, docs, tables)
    if not more.isEmpty():
        connected = with_links(more)
    tables.drop(firsts)

    def unconnected(rows: DataFrame) -> DataFrame:
        """The rows, labelled anew, of tokens that classes of more than one component have."""
        at = labelled(rows, "sig", "c")
        return at.join(at.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("token"), "token")

    # still round two: with the leads of those that share a token and the first token under one of MINS more orders, as near copies of each other mostly do
    left = tables.keep(unconnected(near.select("token", "sig", "n", "pos")).join(classes.select("sig", "folded", "mins"), "sig"))
    tables.drop(near)
    by_min = left.select("token", "sig", "n", "pos", "c", F.explode("mins").alias("first"))
    heads = by_min.groupBy("token", "first").agg(F.min(F.struct("pos", "sig", "n", "c")).alias("h"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi")
    heads = heads.select("token", "first", *(F.col(f"h.{c}").alias(f"lead_{c}") for c in ("pos", "sig", "n", "c")))
    stars = by_min.join(heads, ["token", "first"]).where("c != lead_c").where(_possible("n", "pos", "lead_n", "lead_pos"))
    more = verified(stars.select(F.least("sig", "lead_sig").alias("a"), F.greatest("sig", "lead_sig").alias("b")).distinct(), classes, docs, tables)
    if not more.isEmpty():
        connected = with_links(more)

    # round three: pairs of one token that are not connected yet; leads have been compared with all
    prev = F.lag("token").over(Window.partitionBy("sig").orderBy("pos"))
    before, left = left, tables.keep(unconnected(left.drop("c", "mins")).withColumn("prev", prev))
    tables.drop(before)
    size = F.floor(F.log(F.col("n") + 0.5) / F.log(F.lit(4 / 3)))  # similar sets are at most one step apart
    y = left.withColumn("size", size).alias("y")
    x = left.withColumn("size", F.explode(F.array(size, size + 1))).withColumn("up", F.col("size") - size).alias("x")
    ordered = (F.col("up") == 1) | (F.col("x.c") < F.col("y.c"))
    differing = sum(F.bit_count(F.get("x.folded", F.lit(i)).bitwiseXOR(F.get("y.folded", F.lit(i)))) for i in range(FOLDED))
    begins = F.coalesce(F.col("x.prev") != F.col("y.prev"), F.lit(True))  # else the pair has met at the token before
    apart = ordered & begins & (F.col("x.c") != F.col("y.c")) & _possible("x.n", "x.pos", "y.n", "y.pos") & (differing * 7 <= F.col("x.n") + F.col("y.n"))
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.size") == F.col("y.size")) & apart)
    pairs = tables.keep(pairs.select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b")).distinct())
    tables.drop(left)
    if not pairs.isEmpty():
        more = verified(pairs, classes, docs, tables)
        if not more.isEmpty():
            connected = with_links(more)
    tables.drop(pairs)

    known = classes.join(connected.select(F.col("v").alias("sig"), "c"), "sig", "left").withColumn("c", F.coalesce("c", "sig"))
    known = known.join(known.groupBy("c").agg(F.min("rep").alias("component_id")), "c").select("sig", "n", "component_id")
    out = rows.join(known, ["sig", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a, b FROM f UNION SELECT r.a, f.b FROM r JOIN f ON f.a = r.b),
c AS (SELECT a, min(b) AS b FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(c.b, w.doc_id)) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = w.doc_id
"""

"""Sharding by minimax contiguous partition, native.

Groups of equal text are atomic and stand in the order of md5(text), which is even whatever the ids look like. The smallest
capacity for which a greedy walk over the group sizes needs no more than `shards` shards is found by binary search, and the
order is cut where that walk cuts. The driver never sees all groups: it holds sums by prefix of the order key (4,096 rows),
and single groups only near the places where a cut can fall, which finer prefixes narrow until few remain.

Nulls and edge cases: null texts are one group of their own, of size 1 a row, with text_crc32 0. One group larger than the
rest bounds the capacity from below. An empty table gives no rows. Rows of the same doc_id are separate documents. Other
columns of the input are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.common import cut_lineage, table

SHARDS = 16
DRIVER_GROUPS = 200_000
SPLIT_NODES = 512


def smallest_capacity(sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """The least capacity for which greedy filling needs at most `shards` shards, and the index after the last item of each shard."""
    upto = np.cumsum(np.array(sizes, dtype=np.int64))

    def cuts(capacity: int) -> list[int]:
        out, done = [], 0
        while done < upto[-1] and len(out) <= shards:
            i = int(np.searchsorted(upto, done + capacity, "right"))
            out.append(i)
            done = int(upto[i - 1])
        return out

    lo, hi = max(max(sizes), -(-int(upto[-1]) // shards)), int(upto[-1])
    while lo < hi:
        mid = (lo + hi) // 2
        if len(cuts(mid)) <= shards:
            hi = mid
        else:
            lo = mid + 1
    return lo, cuts(lo)


def _undecided(nodes: list[tuple], shards: int) -> list[tuple]:
    """Of nodes (prefix, size, largest group, groups) in order, those of several groups in which a cut of the least capacity can fall.

    A walk that cuts at ends of nodes only never gets further than the true one, a walk that cuts nodes of several groups
    anywhere never less far; so the least capacities for which they need no more than `shards` shards enclose the true one.
    """
    ends = np.cumsum(np.array([n[1] for n in nodes], dtype=np.int64)).tolist()
    starts, total, several = [0, *ends[:-1]], ends[-1], [n[3] > 1 for n in nodes]

    def behind(x: int) -> int:
        i = bisect.bisect_right(starts, x) - 1
        return total if x >= total else starts[i]

    def ahead(x: int) -> int:
        return min(x, total) if x >= total or several[bisect.bisect_right(starts, x) - 1] else behind(x)

    def least(step, low: int) -> int:
        high = total
        while low < high:
            mid, at = (low + high) // 2, 0
            for _ in range(shards):
                at = step(at + mid)
            low, high = (low, mid) if at == total else (mid + 1, high)
        return low

    low = least(ahead, max(max(n[2] for n in nodes), -(-total // shards)))
    high = least(behind, low)
    near, lo, hi = set(), 0, 0
    for _ in range(shards):
        if lo + low >= total:
            break
        near.update(range(bisect.bisect_right(starts, lo + low) - 1, bisect.bisect_right(starts, hi + high)))
        lo, hi = behind(lo + low), ahead(hi + high)
    return [nodes[i] for i in sorted(near) if several[i]]


def cut_keys(groups: DataFrame, shards: int) -> list[str]:
    """Upper bounds of all shards but the last, for groups (g: order key of hex digits, size)."""

    def sums(p) -> list[tuple[str, int, int, int]]:
        rows = groups.select(p.alias("p"), "size").where("p is not null").groupBy("p").agg(F.sum("size"), F.max("size"), F.count("*")).collect()
        return [tuple(r) for r in rows]

    nodes = sorted(sums(F.substring("g", 1, 3)))
    if not nodes:
        return []
    while split := _undecided(nodes, shards):
        longer = 32
        if sum(n[3] for n in split) > DRIVER_GROUPS:  # large nodes first: what is cut out of them narrows all later places
            most = max(n[1] for n in split)
            split = sorted((n for n in split if n[1] * 16 >= most), key=lambda n: (-n[1], n[0]))[:SPLIT_NODES]
            longer = 2 if len(split) * 16 <= SPLIT_NODES else 1
        inside: dict[int, list[str]] = {}
        for n in split:
            inside.setdefault(len(n[0]), []).append(n[0])
        finer = sums(F.coalesce(*(F.when(F.substring("g", 1, w).isin(ps), F.substring("g", 1, w + longer)) for w, ps in inside.items())))
        gone = {n[0] for n in split}
        nodes = sorted([n for n in nodes if n[0] not in gone] + finer)
    _, cuts = smallest_capacity([n[1] for n in nodes], shards)
    return [nodes[i - 1][0] + "~" * (len(nodes[i - 1][0]) < 32) for i in cuts[:-1]]


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): slots are gapless in each shard."""
    text = F.coalesce("text", F.lit(""))
    base = cut_lineage(docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("f" * 32)).alias("g")))
    keys = cut_keys(base.groupBy("g").agg(F.sum("size").alias("size")), shards)
    shard = sum((F.when(F.col("g") > k, 1).otherwise(0) for k in keys), F.lit(0)).cast("int")
    # slots: rows are numbered within small blocks of the order, whose first numbers are running sums over 256 x 256 blocks;
    # the second part comes from the id, so copies of one text are in many blocks
    of_id = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 2)
    dealt = base.withColumn("shard", shard).withColumn("b", F.substring("g", 1, 2)).withColumn("u", of_id)
    firsts = dealt.groupBy("shard", "b", "u").count().withColumn("first", F.sum("count").over(Window.partitionBy("shard").orderBy("b", "u")) - F.col("count")).drop("count")
    number = F.row_number().over(Window.partitionBy("shard", "b", "u").orderBy("g", "doc_id"))
    return dealt.withColumn("i", number).join(firsts, ["shard", "b", "u"]).select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("i") - 1).alias("slot"))


def query(spark, sf_dir: str) -> DataFrame:
    out = assign_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(md5(text), repeat('f', 32)) AS g, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS x, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2) AS u FROM documents),
g AS (SELECT g, sum(size)::BIGINT AS n FROM d GROUP BY 1),
p AS (SELECT g, n, (sum(n) OVER (ORDER BY g))::BIGINT AS upto FROM g),
l AS (SELECT list(upto ORDER BY upto) AS us, max(upto) AS total, max(n) AS most FROM p),
-- the least capacity by bisection; each step fills one shard, as far as half way between the bounds
r AS (SELECT greatest(most, (total + 15) // 16) AS lo, total AS hi, 0::BIGINT AS done, 0 AS k FROM l
  UNION ALL SELECT CASE WHEN k = 15 AND e < total THEN (lo + hi) // 2 + 1 ELSE lo END, CASE WHEN e = total THEN (lo + hi) // 2 ELSE hi END, CASE WHEN e = total OR k = 15 THEN 0 ELSE e END, CASE WHEN e = total OR k = 15 THEN 0 ELSE k + 1 END
  FROM (SELECT lo, hi, k, total, list_last(list_filter(us, lambda v: v <= done + (lo + hi) // 2)) AS e FROM r, l WHERE lo < hi)),
c AS (SELECT min(lo) AS capacity FROM r WHERE lo = hi),
q AS (SELECT 0::BIGINT AS done UNION ALL SELECT list_last(list_filter(us, lambda v: v <= done + capacity)) FROM q, l, c WHERE done < total),
s AS (SELECT g, (SELECT count(*) FROM q WHERE done > 0 AND done <= upto - n)::INT AS shard FROM p),
t AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS crc),
z AS (SELECT doc_id, g, u, size, xor(list_reduce([4294967295::BIGINT] || list_transform(list_filter(string_split(regexp_replace(x, '(..)', '\1,', 'g'), ','), lambda h: h <> ''), lambda h: ('0x' || h)::BIGINT), lambda v, b: xor(v >> 8, crc[xor(v & 255, b) + 1])), 4294967295) AS text_crc32 FROM d, t)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY substr(g, 1, 2), u, g, doc_id NULLS FIRST) - 1 AS slot, NULL::INT AS grown_shard FROM z JOIN s USING (g)
"""

"""Helpers shared by the training-data operators: tables, checkpoints and vectorised word hashing over Arrow text."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where none is named, one of its own in local mode, as in tests, and an error on a cluster."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


class Tables:
    """Intermediate tables, as Parquet in the shared folder: columns are read as needed and files are deleted as soon as nobody reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n = spark, f"{shared_dir(spark)}/{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
                if self.folder.rpartition("/")[2] in path:
                    hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                    hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def join_counted(rows: DataFrame, keyed: DataFrame, on: list[str], m: str, total: int) -> DataFrame:
    """rows joined with a table of one row a key, whose column m says how many rows the key has. Keys of more than a thousandth of all rows are fewer than a thousand: they are broadcast, and their rows stay where they are."""
    most = max(total // 1000, 1000)
    values = [c for c in keyed.columns if c not in (*on, m)]
    hot = F.broadcast(keyed.where(F.col(m) > most).drop(m).withColumn("_hot", F.lit(True)))
    tagged = rows.join(hot, on, "left")
    rest = tagged.where("_hot is null").drop("_hot", *values).join(keyed.where(F.col(m) <= most).drop(m), on)
    return tagged.where("_hot").drop("_hot").unionByName(rest)


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fixed_bitmap(positions: DataFrame, bits: int) -> np.ndarray:
    """A packed bitmap of 2**bits bits with those set that column `p` (0-based) names: built by partial aggregation, and 2**bits / 8 bytes whatever the input."""
    n = F.col("p") + 1
    rows = positions.select(F.bitmap_bucket_number(n).alias("b"), F.bitmap_bit_position(n).alias("q")).groupBy("b").agg(F.bitmap_construct_agg("q").alias("m")).collect()
    out = np.zeros(max((1 << bits) // 8, 4096), np.uint8)
    for r in rows:
        out[(r.b - 1) * 4096 : r.b * 4096] = np.frombuffer(bytes(r.m), np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values (murmur3's fmix64)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def byte_class(excluded: str) -> np.ndarray:
    """True for the bytes of words: all but the given ASCII characters. Bytes of longer UTF-8 sequences are always of words."""
    out = np.ones(256, bool)
    out[[ord(c) for c in excluded]] = False
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, 2 * BLOCK_BYTES)
        one = np.ones(1, np.uint64)
        _powers[:] = [np.cumprod(np.concatenate([one, np.full(n, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers


def _hashed(data: np.ndarray, first: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    w = word[data]
    start, last = w.copy(), w.copy()
    start[1:] &= ~w[:-1] | first[1:]
    last[:-1] &= ~w[1:] | first[1:]
    s, e = np.flatnonzero(start), np.flatnonzero(last) + 1
    up, down = _tables(len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return s, e, mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))


class Words:
    """The words of some texts: byte spans, 64-bit hashes of the words with A-Z lowered, and for text i the range bounds[i]:bounds[i + 1]."""

    def __init__(self, texts: pa.Array, word: np.ndarray):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, values = texts.buffers()
        offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.data = data = np.frombuffer(values, np.uint8)[offs[0] : offs[-1]] if values is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
        self.offs = offs = offs - offs[0]
        first = np.zeros(len(data), bool)
        first[offs[:-1][offs[:-1] < len(data)]] = True
        parts, lo = [], 0
        while lo < len(data):  # in blocks, so that a very long text needs little more memory than its words
            hi = len(data)
            if hi - lo > 2 * BLOCK_BYTES:
                hi = lo + BLOCK_BYTES
                while hi < len(data) and not first[hi] and word[data[hi]]:
                    step = np.flatnonzero(first[hi : hi + BLOCK_BYTES] | ~word[data[hi : hi + BLOCK_BYTES]])
                    hi += int(step[0]) if len(step) else BLOCK_BYTES
                hi = min(hi, len(data))
            s, e, h = _hashed(data[lo:hi], first[lo:hi], word)
            parts.append((s + lo, e + lo, h))
            lo = hi
        self.starts, self.ends, self.hashes = (np.concatenate(x) if parts else np.zeros(0, t) for x, t in zip(zip(*parts) if parts else [(), (), ()], (np.int64, np.int64, np.uint64)))
        self.bounds = np.searchsorted(self.starts, offs)

    def text(self, lo: int, hi: int) -> str:
        return b" ".join(LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes() for i in range(lo, hi)).decode()


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n consecutive words."""
    m = max(len(hashes) - n + 1, 0)
    out = np.full(m, n, np.uint64)
    for j in range(n):
        out = out * np.uint64(0x100000001B3) + hashes[j : j + m]
    return mix(out)


def blocks(batches, column: str, limit: int = BLOCK_BYTES):
    """The batches cut into runs of rows with about `limit` bytes of text at most; a longer text comes alone."""
    for batch in batches:
        sizes = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        upto, lo = np.cumsum(sizes), 0
        while lo < len(sizes):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + limit, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi

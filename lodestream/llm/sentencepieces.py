"""SentencePiece encoding and decoding by a max-plus parallel scan.

The encoding is the segmentation of the largest total piece score (the unigram search). Scores are the model's log
probabilities; a model trained by merges has ranks instead, which stand for probabilities by Zipf's law, 1 / ((1 + rank) H_n). All sums are of fixed-point integers, so
they are the same in any order.

Where no piece has a space mark after another character, a text's best segmentation is that of its words one by one, so
each distinct word is searched once, thousands side by side as rows of an array. Texts of more than GIANT characters are
cut into chunks of CHUNK that different tasks can take. A chunk yields a max-plus transfer matrix: entry [e, x] is the best
score of going from e characters into the chunk (where a piece from the chunk before ended) to x characters into the next.
Matrices are combined associatively, in segments and then within each; the argmax at a chunk's borders gives its own entry
and exit, from which it is backtraced independently. A text's matrices take less memory than the text: 2 KB for CHUNK
characters. Characters that no piece holds become their UTF-8 bytes' pieces.

Of equally good segmentations the one with the longest last piece counts, then with the longest last but one, and so on.
Matrices carry, below the score, each entry's rank by this rule, so the ids are the same wherever a text is cut.

Decoding joins the pieces' bytes. It returns the text, but for U+2581, which the model cannot tell from a space.

Nulls and edge cases: a null text gives null ids and an empty one no ids, and so back. Rows that repeat give equal rows;
equal ids with different texts stay apart. Other columns are kept by `encode` and `decode`.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm.common import Tables, blocks, mix, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT, CHUNK, SEGMENT = 65_536, 4096, 256
CACHE = 100_000
MARK = "▁"
NONE = -(1 << 60)
LOW = 64  # the low bits of a packed score hold a length
PRIME = 0x100000001B3


def _fields(data: bytes):
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at : at + n]
            at += n


class Model:
    """Pieces of a model file, as arrays for lookup. Small (its file's size) and picklable."""

    def __init__(self, proto: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        top = dict(_fields(proto))
        trainer, normalizer = dict(_fields(top[2])), dict(_fields(top[3]))
        if normalizer.get(2) or normalizer.get(4, 1):
            raise ValueError("only models that leave the text as it is are supported")
        self.prefix = MARK if normalizer.get(3, 1) else ""
        merges = trainer.get(3, 1) == 2
        pieces = [sp.id_to_piece(i) for i in range(n)]
        score = np.array([sp.get_score(i) for i in range(n)], np.float64)
        score = -np.log1p(np.maximum(-score, 0)) - np.log(np.log(n) + 0.5772) if merges else score
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.unk = self._packed(float(score[plain].min()) - 10, 1)
        self.longest = max(len(pieces[i]) for i in plain)
        if self.longest >= LOW:
            raise ValueError(f"only pieces of fewer than {LOW} characters are supported")
        self.by_word = all(MARK not in pieces[i].lstrip(MARK) for i in plain)
        self.byte_ids = [0] * 256
        self.bytes = []
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
            self.bytes.append(bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else p.replace(MARK, " ").encode())
        entries: dict[int, tuple[int, int]] = {}  # of all beginnings of pieces, with id -1 where they aren't pieces
        for i in plain:
            key = 0
            for n, c in enumerate(pieces[i], 1):
                key = (key * PRIME + ord(c) + 1) & (1 << 64) - 1
                if n < len(pieces[i]):
                    entries.setdefault(key, (-1, NONE))
            entries[key] = (i, self._packed(float(score[i]), n))
        bits = max(int(np.ceil(np.log2(len(entries)))) + 2, 4)
        self.shift = np.uint64(64 - bits)
        self.keys, self.ids, self.scores, self.used = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32), np.full(1 << bits, NONE), np.zeros(1 << bits, bool)
        for key, (i, packed) in zip(mix(np.array(list(entries), np.uint64)).tolist(), entries.values()):
            slot = key >> int(self.shift)
            while self.used[slot]:
                slot = (slot + 1) % len(self.ids)
            self.keys[slot], self.ids[slot], self.scores[slot], self.used[slot] = key, i, packed, True

    @staticmethod
    def _packed(score: float, n: int) -> int:
        """A fixed-point score with the piece's length in its low bits, so that sums compare by score, then by length."""
        return round(score * (1 << 20)) * LOW + n

    def lookup(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots of these hashes, and whether they are there."""
        key = mix(raw)
        slot = (key >> self.shift).astype(np.int64)
        there = self.used[slot] & (self.keys[slot] == key)
        other = np.flatnonzero(self.used[slot] & ~there)
        while len(other):
            slot[other] = (slot[other] + 1) % len(self.ids)
            there[other] = self.used[slot[other]] & (self.keys[slot[other]] == key[other])
            other = other[self.used[slot[other]] & ~there[other]]
        return slot, there

    def lattice(self, codes: np.ndarray, m: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """ids, packed scores [position, length - 1, lane] of the pieces that start before m; codes: [position, lane], see coded(). A lone unknown has id -1 and the score unk."""
        n = codes.shape[1]
        flat = np.concatenate([codes.ravel(), np.zeros((m + most) * n, np.uint64)])
        ids, scores = np.full(m * most * n, -1, np.int32), np.full(m * most * n, NONE)
        at, h = np.arange(m * n), np.zeros(m * n, np.uint64)
        for k in range(most):
            h = h * np.uint64(PRIME) + flat[at + k * n]
            slot, there = self.lookup(h)
            target = (at // n * most + k) * n + at % n
            if k == 0:
                scores[target[flat[at] > 0]] = self.unk
            piece = there & (self.ids[slot] >= 0)
            ids[target[piece]], scores[target[piece]] = self.ids[slot[piece]], self.scores[slot[piece]]
            at, h = at[there], h[there]
            if not len(at):
                break
        return ids.reshape(m, most, n), scores.reshape(m, most, n)


def coded(texts: list[str]) -> np.ndarray:
    """[position, lane]: code points + 1, and 0 past the end."""
    sizes = np.array([len(t) for t in texts])
    out = np.zeros((len(texts), int(sizes.max())), np.uint64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat.astype(np.uint64) + np.uint64(1)
    return np.ascontiguousarray(out.T)


def _emit(model: Model, text: str, cuts: list[int], ids) -> bytes:
    """ids: of the piece that starts at each cut but the last."""
    out: list[int] = []
    for lo, hi, i in zip(cuts[:-1], cuts[1:], ids):
        out += [i] if i >= 0 else [model.byte_ids[b] for b in text[lo:hi].encode()]
    return np.array(out, np.int32).tobytes()


def best_words(model: Model, words: list[str]) -> list[bytes]:
    """Ids of the best segmentation of words of one length, as int32 bytes."""
    m, n = len(words[0]), len(words)
    most = min(model.longest, m)
    ids, scores = model.lattice(coded(words), m, most)
    best, back = np.full((m + 1, n), NONE), np.zeros((m + 1, n), np.int64)
    best[0] = 0
    for end in range(1, m + 1):
        for k in range(1, min(most, end) + 1):
            np.maximum(best[end], best[end - k] + scores[end - k, k - 1], out=best[end])
        back[end] = best[end] & (LOW - 1)
        best[end] -= back[end]
    at, rows = np.full(n, m), np.arange(n)
    piece = np.full((n, m), -2, np.int32)
    while len(rows):
        k = back[at[rows], rows]
        at[rows] -= k
        piece[rows, at[rows]] = ids[at[rows], k - 1, rows]
        rows = rows[at[rows] > 0]
    starts = piece != -2
    ends, data = (np.cumsum(starts.sum(axis=1)) * 4).tolist(), piece[starts].tobytes()
    out = [data[lo:hi] for lo, hi in zip([0, *ends[:-1]], ends)]
    for j in np.flatnonzero((piece == -1).any(axis=1)).tolist():
        out[j] = _emit(model, words[j], [*np.flatnonzero(starts[j]).tolist(), m], data_ids(out[j]))
    return out


def data_ids(data: bytes) -> list[int]:
    return np.frombuffer(data, np.int32).tolist()


class Encoder:
    WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def __init__(self, model: Model):
        self.model, self.seen = model, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.WORDS.findall(self.model.prefix + t.replace(" ", MARK)) if self.model.by_word else [self.model.prefix + t.replace(" ", MARK)] if t else [] for t in texts]
        split = [w if t else [] for w, t in zip(split, texts)]
        if len(self.seen) > CACHE:
            self.seen.clear()
        new: dict[int, list[str]] = {}
        found = [list(map(self.seen.get, ws)) for ws in split]
        for w in {w for ws, ids in zip(split, found) if None in ids for w, i in zip(ws, ids) if i is None}:
            new.setdefault(len(w), []).append(w)
        for n, words in new.items():
            step = max(1, 50_000 // n)
            for lo in range(0, len(words), step):
                self.seen.update(zip(words[lo : lo + step], best_words(self.model, words[lo : lo + step])))
        return [b"".join([self.seen[w] if i is None else i for w, i in zip(ws, ids)] if None in ids else ids) for ws, ids in zip(split, found)]


def maxplus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus products of stacks of matrices."""
    return (a[..., :, :, None] + b[..., None, :, :]).max(axis=-2)


def scan(matrices: np.ndarray) -> np.ndarray:
    """Inclusive prefix products, by doubling."""
    out, step = matrices.copy(), 1
    while step < len(out):
        out[step:] = np.maximum(maxplus(out[:-step], out[step:]), NONE)
        step *= 2
    return out


def transfers(model: Model, chunks: list[str], sizes: list[int]) -> np.ndarray:
    """[chunk, entry, exit]; chunks come with longest - 1 characters of what follows, sizes without. The low bits rank the entries of an exit by the tie rule."""
    n, width = model.longest, max(sizes)
    _, scores = model.lattice(coded(chunks), width, n)
    scores = np.ascontiguousarray(scores.transpose(0, 2, 1))
    best = np.full((len(chunks), n, width + 2 * n), NONE)
    best[:, range(n), range(n)] = 0
    ranks = np.zeros((width + n, len(chunks), n), np.int8)
    live, of_chunk, entries = np.array(sizes)[:, None], np.arange(len(chunks))[:, None], np.arange(n)[None, :]
    for at in range(width + n):
        last = best[:, :, at] & (LOW - 1)  # the last piece's length; what a piece of the chunk before brings is longer than any
        if at:
            order = np.argsort(last * LOW + ranks[at - last, of_chunk, entries] + (entries == at) * (LOW * LOW), axis=1)
            np.put_along_axis(ranks[at], order, entries.astype(np.int8), axis=1)
        if at < width:
            here = np.where(at < live, best[:, :, at] & -LOW, NONE)
            ahead = best[:, :, at + 1 : at + n + 1]
            np.maximum(ahead, here[:, :, None] + scores[at][:, None, :], out=ahead)
    out = np.stack([(best[i, :, s : s + n] & -LOW) | ranks[s : s + n, i].T for i, s in enumerate(sizes)])
    return np.where(out < NONE // 2, NONE, out)


def backtrace(model: Model, chunk: str, entry: int, leave: int, size: int) -> bytes:
    """Ids of the best way through one chunk from its entry to its exit."""
    text, last = chunk[entry : size + leave], size - entry  # pieces start before `last`
    if not text:
        return b""
    ids, scores = model.lattice(coded([text]), len(text), model.longest)
    ids, scores = ids[:, :, 0], scores[:, :, 0]
    best = np.full(len(text) + model.longest + 1, NONE)
    best[0] = 0
    for at in range(min(last, len(text))):
        ahead = best[at + 1 : at + model.longest + 1]
        np.maximum(ahead, (best[at] & ~(LOW - 1)) + scores[at], out=ahead)
    cuts = [len(text)]
    while cuts[-1] > 0:
        cuts.append(cuts[-1] - int(best[cuts[-1]] & (LOW - 1)))
    cuts.reverse()
    return _emit(model, text, cuts, [int(ids[lo, hi - lo - 1]) for lo, hi in zip(cuts[:-1], cuts[1:])])


def boundary_states(matrices: np.ndarray) -> list[tuple[int, int]]:
    """Entry and exit of each chunk on the best path that starts at 0 and ends at the end."""
    scores = matrices & -LOW
    parts = [scores[i : i + SEGMENT] for i in range(0, len(scores), SEGMENT)]
    start = np.where(np.arange(scores.shape[1]) == 0, 0, NONE)
    wholes = scan(np.stack([product(x) for x in parts]))
    arrived, out, leave = [], [], 0  # the best scores of coming to each entry of each chunk
    for x, before in zip(parts, [start, *(w[0] for w in wholes[:-1])]):
        inner = scan(x[:-1]) if len(x) > 1 else x[:0]
        arrived += [before, *np.maximum((before[None, :, None] + inner).max(axis=1), NONE)]
    for before, m in zip(arrived[::-1], matrices[::-1]):
        entry = int((before + m[:, leave]).argmax())
        out.append((entry, leave))
        leave = entry
    return out[::-1]


def product(matrices: np.ndarray) -> np.ndarray:
    """The max-plus product of a stack of matrices, pairwise by levels."""
    while len(matrices) > 1:
        pairs = np.maximum(maxplus(matrices[: len(matrices) // 2 * 2 : 2], matrices[1::2]), NONE)
        matrices = np.concatenate([pairs, matrices[-1:]]) if len(matrices) % 2 else pairs
    return matrices[0]


LIST = pa.list_(pa.int32())


def _lists(data: list[bytes | None]) -> pa.Array:
    sizes = [len(d) // 4 if d else 0 for d in data]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    mask = pa.array([d is None for d in data])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(d for d in data if d), np.int32)), mask=mask)


def _encode_words(model):
    def run(batches):
        encoder = Encoder(model.value)
        for batch in blocks(batches, "text"):
            texts = batch.column("text").to_pylist()
            data = encoder.encode([t or "" for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column("row"), _lists([None if t is None else d for t, d in zip(texts, data)])], ["row", "ids"])

    return run


def _cut(prefix: str, chunk: int, ahead: int):
    """Chunks of a text, each with what `ahead` characters follow; in batches of few."""

    def run(batches):
        for batch in blocks(batches, "text"):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                text = prefix + text.replace(" ", MARK)
                for first in range(0, len(text), 64 * chunk):
                    at = range(first, min(len(text), first + 64 * chunk), chunk)
                    columns = [pa.array([key] * len(at)), pa.array([i // chunk for i in at], pa.int32()), pa.array([min(chunk, len(text) - i) for i in at], pa.int32()), pa.array([text[i : i + chunk + ahead] for i in at])]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "i", "size", "chunk"])

    return run


def _transfers(model):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 8):
                part = batch.slice(lo, 8)
                t = transfers(model.value, part.column("chunk").to_pylist(), part.column("size").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("i"), pa.array([x.tobytes() for x in t], pa.binary())], ["key", "i", "t"])

    return run


def _states(of: pa.Table) -> pa.Table:
    of = of.sort_by("i")
    n = int((len(of["t"][0].as_py()) // 8) ** 0.5)
    states = boundary_states(np.stack([np.frombuffer(t, np.int64).reshape(n, n) for t in of["t"].to_pylist()]))
    return pa.table({"key": of["key"], "i": of["i"], "entry": pa.array([s[0] for s in states], pa.int32()), "leave": pa.array([s[1] for s in states], pa.int32())})


def _backtraced(model):
    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("chunk", "entry", "leave", "size")))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("i"), _lists([backtrace(model.value, *r) for r in rows])], ["key", "i", "ids"])

    return run


def load(spark, path: str = MODEL):
    """The broadcast model; its file is read on the driver."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(Model(f.read()))


def encode(docs: DataFrame, model, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """The input's columns but text (and ids), and ids."""
    m: Model = model.value
    keep = [c for c in docs.columns if c not in ("text", "ids")]
    rows = docs.select(F.struct(*keep).alias("row"), "text") if keep else docs.select(F.struct(F.lit(0)).alias("row"), "text")
    large = F.coalesce(F.char_length("text") > giant, F.lit(False))
    row = rows.schema["row"].dataType.simpleString()
    few = rows.where(~large).mapInArrow(_encode_words(model), f"row {row}, ids array<int>")
    # giants: equal texts share their chunks
    tables = Tables(docs.sparkSession)
    giants = tables.keep(rows.where(large).withColumn("key", F.sha2("text", 256)))
    texts = giants.select("key", "text").dropDuplicates(["key"])
    chunks = tables.keep(texts.mapInArrow(_cut(m.prefix, chunk, m.longest - 1), "key string, i int, size int, chunk string").repartition("key", "i"))
    matrices = chunks.mapInArrow(_transfers(model), "key string, i int, t binary")
    states = matrices.groupBy("key").applyInArrow(_states, "key string, i int, entry int, leave int")
    traced = chunks.join(states, ["key", "i"]).mapInArrow(_backtraced(model), "key string, i int, ids array<int>")
    whole = traced.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "ids"))).alias("parts")).select("key", F.flatten(F.col("parts.ids")).alias("ids"))
    out = few.unionByName(giants.select("key", "row").join(whole, "key").select("row", "ids"))
    return out.select(*(F.col("row")[c].alias(c) for c in keep), "ids")


def _decoded(model):
    def run(batches):
        table_, strip = model.value.bytes, bool(model.value.prefix)
        for batch in batches:
            texts = []
            for lo in range(0, batch.num_rows, 256):
                for ids in batch.column("ids").slice(lo, 256):
                    ids = ids.values.to_numpy().tolist() if ids.is_valid else None
                    data = None if ids is None else b"".join(map(table_.__getitem__, ids))
                    texts.append(None if data is None else (data[1:] if strip and data[:1] == b" " else data).decode("utf-8", "replace"))
            keep = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(texts, pa.string())], [*keep, "text"])

    return run


def decode(encoded: DataFrame, model) -> DataFrame:
    """The input's columns but ids (and text), and text."""
    keep = [f for f in encoded.schema if f.name not in ("ids", "text")]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep)
    return encoded.select(*(f"`{f.name}`" for f in keep), "ids").mapInArrow(_decoded(model), f"{fields}text string")


def query(spark, sf_dir: str) -> DataFrame:
    model = load(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.xxhash64(F.replace("text", F.lit(MARK), F.lit(" "))).alias("h"), "text")
    encoded = encode(docs, model)
    decoded = decode(encoded.withColumn("kept", F.col("ids")), model)
    return decoded.select("doc_id", F.size("kept").alias("n_tokens"), F.col("kept").alias("ids"), (F.xxhash64("text") == F.col("h")).alias("round_trip"))


ORACLE = None

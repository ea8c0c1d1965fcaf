"""Media columns: ISO base media files are stored and read by walking their boxes and decoding their sample tables.

`store` writes a payload as 8-bit mono audio samples ('raw ') in one track. `probe` reads such files, or others, and gives
for each track the codec, the duration and the keyframes' byte ranges, in the file's order; and, if asked, the payload of the
first track put together from its sample table. No payload is decoded: ranges come from stsz, stsc, stco/co64 and stss alone.
Of a fragmented file only what its moov says is read.

Nulls and edge cases: a null or empty text is a payload of 192 spaces. A null or damaged file, one whose counts exceed its
boxes or whose samples exceed the file, gives null columns; a timescale of 0 gives a null duration. Rows that repeat give
equal rows. Other columns of the input are kept by `probe`.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm.common import blocks, table

UNIT = 192  # bytes of a stored sample
RATE = 8000  # units of time a second
PER_CHUNK = 8
KEY_EVERY = 16
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf"}


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def write_media(payload: bytes) -> bytes:
    """An ISO media file whose one track holds the payload in samples of UNIT bytes; every KEY_EVERY-th is a sync sample."""
    n = len(payload) // UNIT
    chunks = -(-n // PER_CHUNK)
    ticks, rest = n * UNIT, n - (chunks - 1) * PER_CHUNK
    runs = [(1, PER_CHUNK, 1)] if rest == PER_CHUNK else [(1, rest, 1)] if chunks == 1 else [(1, PER_CHUNK, 1), (chunks, rest, 1)]
    sync = np.arange(1, n + 1, KEY_EVERY, dtype=">u4")
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    matrix = struct.pack(">9I", 65536, 0, 0, 0, 65536, 0, 0, 0, 0x40000000)

    def moov(start: int) -> bytes:
        offsets = start + np.arange(chunks, dtype=np.int64) * (PER_CHUNK * UNIT)
        wide = bool(len(offsets)) and offsets[-1] >= 1 << 32
        entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, RATE << 16))
        stbl = _box(
            b"stbl", _full(b"stsd", struct.pack(">I", 1), entry), _full(b"stts", struct.pack(">III", 1, n, UNIT)),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)), _full(b"stsz", struct.pack(">II", UNIT, n)),
            _full(b"stss", struct.pack(">I", len(sync)), sync.tobytes()),
            _full(b"co64" if wide else b"stco", struct.pack(">I", chunks), offsets.astype(">u8" if wide else ">u4").tobytes()),
        )
        minf = _box(b"minf", _full(b"smhd", bytes(4)), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), stbl)
        mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, ticks, 0x55C4, 0)), _full(b"hdlr", bytes(4), b"soun", bytes(12), b"\0"), minf)
        tkhd = _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, ticks), bytes(8), struct.pack(">HHHH", 0, 0, 256, 0), matrix, bytes(8), flags=3)
        mvhd = _full(b"mvhd", struct.pack(">IIII", 0, 0, RATE, ticks), struct.pack(">IH", 65536, 256), bytes(10), matrix, bytes(24), struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    head = len(ftyp) + len(moov(0)) + 8
    if head + len(payload) >= 1 << 32:
        raise ValueError("a payload of 4 GiB or more does not fit a row")
    return b"".join((ftyp, moov(head), struct.pack(">I4s", 8 + len(payload), b"mdat"), payload))


def walk(data, lo: int, hi: int):
    """(path, start, end) of each box's body, nested ones included, in the file's order."""
    todo = [(lo, hi, ())]
    while todo:
        lo, hi, path = todo.pop()
        if lo + 8 > hi:
            continue
        size, kind = struct.unpack_from(">I4s", data, lo)
        head = 8
        if size == 1:
            size, head = struct.unpack_from(">Q", data, lo + 8)[0], 16
        size = hi - lo if size == 0 else size
        if size < head or lo + size > hi:
            raise ValueError(f"box {kind!r} at {lo} exceeds its parent")
        yield (*path[-8:], kind), lo + head, lo + size
        todo.append((lo + size, hi, path))
        if kind in CONTAINERS:
            todo.append((lo + head, lo + size, (*path[-8:], kind)))


def _ints(data, at: int, n: int, end: int, kind: str = ">u4") -> np.ndarray:
    if n * int(kind[-1]) > end - at:
        raise ValueError(f"{n} entries exceed their box")
    return np.frombuffer(data, kind, n, at).astype(np.int64)


def read_media(data: bytes) -> list[dict]:
    """For each track: codec, timescale, duration (ticks), stts, for each sample its offset and size, for each sync sample its index."""
    tracks: list[dict] = []
    for path, lo, hi in walk(data, 0, len(data)):
        kind = path[-1]
        if kind == b"trak":
            tracks.append({"sync": None})
        if b"trak" not in path:
            continue
        out, count = tracks[-1], lambda: struct.unpack_from(">I", data, lo + 4)[0]  # noqa: E731, B023
        if kind == b"mdhd":
            version = data[lo]
            out["timescale"], out["duration"] = struct.unpack_from(">IQ" if version else ">II", data, lo + (20 if version else 12))
        elif kind == b"stsd":
            out["codec"] = bytes(data[lo + 12 : lo + 16]).decode("latin-1")
        elif kind == b"stts":
            out["stts"] = _ints(data, lo + 8, 2 * count(), hi).reshape(-1, 2)
        elif kind == b"stsz":
            size, n = struct.unpack_from(">II", data, lo + 4)
            if size * n > len(data):
                raise ValueError(f"{n} samples of {size} bytes exceed the file")
            out["sizes"] = np.full(n, size, np.int64) if size else _ints(data, lo + 12, n, hi)
        elif kind == b"stsc":
            out["runs"] = _ints(data, lo + 8, 3 * count(), hi).reshape(-1, 3)
        elif kind in (b"stco", b"co64"):
            out["chunks"] = _ints(data, lo + 8, count(), hi, ">u4" if kind == b"stco" else ">u8")
        elif kind == b"stss":
            out["sync"] = _ints(data, lo + 8, count(), hi) - 1
    for out in tracks:
        locate(out, len(data))
    return tracks


def locate(track: dict, size: int) -> None:
    """Adds the samples' offsets; sizes and offsets must lie within the file."""
    sizes, chunks, runs = track["sizes"], track["chunks"], track["runs"]
    n = np.diff(np.append(runs[:, 0], len(chunks) + 1))
    if (len(n) and (n.min() < 0 or runs[0, 0] != 1)) or float(n.astype(float) @ runs[:, 1].astype(float)) != len(sizes):
        raise ValueError("chunks and samples don't match")
    per_chunk = np.repeat(runs[:, 1], n)
    chunk_of = np.repeat(np.arange(len(chunks)), per_chunk)
    before = np.concatenate([[0], np.cumsum(sizes)])
    first_of = np.concatenate([[0], np.cumsum(per_chunk)])[:-1]
    track["offsets"] = chunks[chunk_of] + before[:-1] - before[first_of[chunk_of]]
    if before[-1] > size or (len(sizes) and ((track["offsets"] < 0).any() or (track["offsets"] + sizes > size).any())):
        raise ValueError("samples exceed the file")
    sync = track["sync"]
    if sync is None:
        track["sync"] = np.arange(len(sizes))
    elif len(sync) and (sync.min() < 0 or sync.max() >= len(sizes)):
        raise ValueError("a sync sample is none of the track's")


def payload_of(data: bytes, media: dict) -> bytes:
    """The samples in order; adjacent ones are copied together."""
    offsets, ends = media["offsets"], media["offsets"] + media["sizes"]
    breaks = np.flatnonzero(offsets[1:] != ends[:-1]) + 1
    return b"".join(data[offsets[lo] : ends[hi - 1]] for lo, hi in zip([0, *breaks], [*breaks, len(offsets)]))


def _store(batches):
    for batch in blocks(batches, "text", 4 << 20):
        files = []
        for text in batch.column("text").fill_null("").cast(pa.large_binary()).to_pylist():
            files.append(write_media(text + b" " * (-len(text) % UNIT if text else UNIT)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(files, pa.binary())], ["doc_id", "n_bytes", "media"])


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as the payload of an ISO media file."""
    docs = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), "text")
    return docs.mapInArrow(_store, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, media binary")


TRACK = "codec string, duration_s double, n_samples bigint, keyframes array<struct<start: bigint, end: bigint>>"
FILE = "payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string"
RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
TRACKS = pa.list_(pa.struct([("codec", pa.string()), ("duration_s", pa.float64()), ("n_samples", pa.int64()), ("keyframes", RANGES)]))


def summary(track: dict) -> dict:
    at = track["offsets"][track["sync"]]
    ticks = float(track["stts"][:, 0].astype(float) @ track["stts"][:, 1].astype(float))
    ranges = [{"start": s, "end": e} for s, e in zip(at.tolist(), (at + track["sizes"][track["sync"]]).tolist())]
    return {"codec": track["codec"], "duration_s": ticks / track["timescale"] if track["timescale"] else None, "n_samples": len(track["sizes"]), "keyframes": ranges}


def _probe(payload: bool):
    kinds = [TRACKS, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column("media"):
                data = data.as_py()
                try:
                    tracks = read_media(data)
                    body = payload_of(data, tracks[0]) if payload and tracks else None
                    of_body = (None, None, None) if body is None else (len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-16:]))
                    rows.append(([summary(t) for t in tracks], *of_body, len(data), hashlib.sha256(data).hexdigest()))
                except (TypeError, LookupError, ValueError, ArithmeticError, struct.error):
                    rows.append((None,) * len(kinds))
            keep = [n for n in batch.schema.names if n != "media"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], [*keep, "tracks", *(x.split()[0] for x in FILE.split(", "))])

    return run


def probe(media: DataFrame, payload: bool = False) -> DataFrame:
    """The input's columns but `media`; tracks; the first one's codec, duration_s, n_samples and keyframes; and those of FILE, of which payload's are null unless asked for. Columns of these names are replaced."""
    made = {x.split()[0] for x in f"{TRACK.split(', keyframes')[0]}, {FILE}".split(", ")} | {"keyframes", "tracks"}
    names = [f for f in media.schema if f.name != "media" and f.name not in made]
    keep = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in names)
    out = media.select(*(f"`{f.name}`" for f in names), "media").mapInArrow(_probe(payload), f"{keep}tracks array<struct<{TRACK.replace(' string', ': string').replace(' double', ': double').replace('n_samples bigint', 'n_samples: bigint').replace('keyframes array', 'keyframes: array')}>>, {FILE}")
    first = F.get("tracks", F.lit(0))
    return out.withColumns({c: first[c] for c in ("codec", "duration_s", "n_samples", "keyframes")})


def query(spark, sf_dir: str) -> DataFrame:
    out = probe(store(table(spark, sf_dir, "documents")), payload=True)
    first, last = F.col("keyframes")[0], F.element_at("keyframes", -1)
    feature = F.format_string("codec=%s;duration=%.4f;samples=%d;keyframes=%d;first=%d-%d;last=%d-%d", F.trim("codec"), "duration_s", "n_samples", F.size("keyframes"), first["start"], first["end"], last["start"], last["end"])
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


ORACLE = None

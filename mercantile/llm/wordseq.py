"""Word sequences as arrays, slices of documents and packets (inside tasks).

Documents are packed into slices of a few megabytes, one compressed row each,
written once.  What a slice asks of the corpus ("which of these keys does
anyone else hold?") travels as packets: per (bucket, slice) one row with the
sorted keys, so a key costs a few bytes in the shuffle and a key that a slice
holds many times is sent once.  A bucket holds a fixed share of the text, and
of one hot key at most an entry per slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .shingles import U, mix, text_slices

#: Bytes of text in a slice (one text at least) and of all text behind a bucket.
SLICE_BYTES = 2 << 20
BUCKET_BYTES = 32 << 20
#: Two byte values of word hashes that keep the case of letters.
PLAIN = mix(np.arange(1, 257, dtype=U) * U(0x9FB21C651E98DF25))
SECOND = mix(PLAIN ^ U(0xA24BAED4963EE407))
SLICE_SCHEMA = "slice long, ids array<long>, sizes array<long>, raw long, data binary"


def _pack(batches):
    part, made = TaskContext.get().partitionId(), 0
    codec = pa.Codec("zstd", compression_level=3)
    for batch in batches:
        for at, to, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
            packed = codec.compress(data.tobytes(), asbytes=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made]), pa.array([batch.column(0).slice(at, to - at).to_pylist()],
                                                           pa.list_(pa.int64())),
                 pa.array([np.diff(offsets)], pa.list_(pa.int64())), pa.array([len(data)]),
                 pa.array([packed], pa.binary())],
                ["slice", "ids", "sizes", "raw", "data"])
            made += 1


def write_slices(docs: DataFrame, id_col: str, text_col: str, name: str) -> tuple[DataFrame, int]:
    """(slices of whole documents, written; number of buckets).  Slices are
    numbered by the task that packed them and written once, so every later pass
    sees the same ones."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    slices = materialise(texts.mapInArrow(_pack, SLICE_SCHEMA), name)
    total = slices.agg(F.sum("raw")).first()[0] or 0
    return slices, max(1, -(-total // BUCKET_BYTES))


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a slice row."""
    raw = pa.Codec("zstd").decompress(row["data"], row["raw"], asbytes=True) if row["raw"] else b""
    return np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(row["sizes"], dtype=np.int64)])


def window_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, from runs of dyadic length."""
    m = max(len(words) - width + 1, 0)
    out, at, level, size = None, 0, words, 1
    while True:
        if width & size:
            piece = level[at:at + m]
            out = piece + U(size) if out is None else mix(out * U(0x2545F4914F6CDD1D) + piece)
            at += size
        size *= 2
        if size > width:
            return mix(out)
        level = twice(level, size // 2)


def twice(level: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of 2 * ``size`` words from those of ``size`` words."""
    return mix(level[:-size] * U(0xD1342543DE82EF95) + level[size:]) if len(level) > size else level[:0]


def bucket_keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket number in the upper, 32 other bits in the lower half."""
    return (((hashes >> U(32)) * U(buckets)) >> U(32) << U(32)) | (hashes & U(0xFFFFFFFF))


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as differences, byte plane by byte plane (the
    upper planes are nearly constant and compress away)."""
    return np.diff(x.astype(np.uint32), prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_sorted(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, doc_of: np.ndarray, docs: int,
           step: int = 400_000) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of each document's words joined by one space."""
    parts, sizes = [], np.zeros(docs, np.int64)
    for lo in range(0, len(start), step):
        s, e, d = start[lo:lo + step], end[lo:lo + step], doc_of[lo:lo + step]
        lens = e - s + 1
        at = np.cumsum(lens) - lens
        src = np.repeat(s - at, lens) + np.arange(int(lens.sum()))
        buf = data[np.minimum(src, len(data) - 1)]
        buf[at + lens - 1] = 32
        follows = np.r_[d[1:], doc_of[lo + step] if lo + step < len(start) else -1]
        last = d != follows
        keep = np.ones(len(buf), bool)
        keep[(at + lens - 1)[last]] = False
        parts.append(buf[keep])
        sizes += np.bincount(d, weights=lens - last, minlength=docs).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint8)), np.concatenate([[0], np.cumsum(sizes)])


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())])


def seen_packets(slice_id: int, keys: np.ndarray, buckets: int, blocks: np.ndarray | None = None,
                 refs: np.ndarray | None = None) -> Iterator[dict]:
    """Per bucket a packet of a slice: ``seen`` its distinct keys, ``many``
    flags those it holds more than once, ``asked`` the places in ``seen`` of the
    keys in ``blocks`` and ``refs`` what the slice calls them.  Without
    ``blocks`` the slice asks for all its keys, by their places."""
    values, count, cut = distinct_keys(keys, buckets)
    if blocks is not None:
        order = np.argsort(blocks, kind="stable")
        place, refs = np.searchsorted(values, blocks[order]), refs[order]
        asked = np.searchsorted(place, cut)
    for b in range(buckets):
        lo, hi = cut[b], cut[b + 1]
        if lo < hi:
            row = {"bucket": b, "slice": slice_id, "seen": pack_sorted(values[lo:hi] & U(0xFFFFFFFF)),
                   "many": np.packbits(count[lo:hi] > 1).tobytes()}
            if blocks is not None:
                i, j = asked[b], asked[b + 1]
                row |= {"asked": pack_sorted(place[i:j] - lo), "refs": refs[i:j].astype(np.uint32).tobytes()}
            yield row


def distinct_keys(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct bucket keys, how often, where each bucket starts)."""
    values, count = np.unique(keys, return_counts=True)
    return values, count, np.searchsorted(values, np.arange(buckets + 1, dtype=U) << U(32))


PACKET_SCHEMA = "bucket int, slice long, seen binary, many binary, asked binary, refs binary"
PACKET = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), ("seen", pa.binary()), ("many", pa.binary()),
                    ("asked", pa.binary()), ("refs", pa.binary())])
REFS_SCHEMA = "slice long, refs binary"


PLACES_SCHEMA = "slice long, bucket int, places binary"


def _packets(rows):
    """(keys of each packet, those that two packets hold or one holds twice)."""
    seen = [unpack_sorted(x) for x in rows.column("seen").to_pylist()]
    many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(s)).astype(bool)
            for x, s in zip(rows.column("many").to_pylist(), seen, strict=True)]
    every = np.sort(np.concatenate(seen))
    hot = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]],
                                    *[s[m] for s, m in zip(seen, many, strict=True)]]))
    return seen, hot


def _is_in(values, hot):
    if not len(hot):
        return np.zeros(len(values), bool)
    return hot[np.minimum(np.searchsorted(hot, values), len(hot) - 1)] == values


def shared_refs(key, rows):
    """What the slices asked of a bucket: refs whose key occurs twice or more."""
    seen, hot = _packets(rows)
    out, slices = [], []
    for s, asked, refs, no in zip(seen, rows.column("asked").to_pylist(), rows.column("refs").to_pylist(),
                                  rows.column("slice").to_pylist(), strict=True):
        found = np.frombuffer(refs, np.uint32)[_is_in(s[unpack_sorted(asked)], hot)]
        if len(found):
            slices.append(no)
            out.append(found.tobytes())
    return pa.table({"slice": pa.array(slices, pa.int64()), "refs": pa.array(out, pa.binary())})


def shared_places(key, rows):
    """Places, in every slice's distinct keys of a bucket, of those that occur twice or more."""
    seen, hot = _packets(rows)
    found = [np.flatnonzero(_is_in(s, hot)) for s in seen]
    some = [i for i, f in enumerate(found) if len(f)]
    slices, bucket = rows.column("slice").to_pylist(), rows.column("bucket").to_pylist()
    return pa.table({"slice": pa.array([slices[i] for i in some], pa.int64()),
                     "bucket": pa.array([bucket[i] for i in some], pa.int32()),
                     "places": pa.array([pack_sorted(found[i]) for i in some], pa.binary())})


def keys_at_places(values: np.ndarray, cut: np.ndarray, answers) -> np.ndarray:
    """The distinct keys of a slice that :func:`shared_places` names, ascending."""
    at = [cut[b] + unpack_sorted(p) for b, p in zip(answers.column("bucket").to_pylist(),
                                                    answers.column("places").to_pylist(), strict=True)]
    return values[np.sort(np.concatenate(at))] if at else values[:0]

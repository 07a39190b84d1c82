"""Substring dedup by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of half a window;
the blocks are indexed by hash.  A window always holds a whole block, so of two
equal windows each covers a block that the other meets as a rolling run of
words.  Every rolling run of block length probes the index; a block that meets
a run elsewhere is an anchor.  Anchors are extended by exact comparison: the
windows around an anchor are compared over the whole corpus by 96 bits and a
bucket, and the windows found twice together are the maximal exact repeats.

Probes carry no place and few bits (a false meeting only costs an extension);
a passage that many documents share is extended once per place and never pair
by pair.  The text travels once, for both the extension and the cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import register, table
from .shingles import U, word_spans
from .wordseq import (PACKET, PACKET_SCHEMA, PLAIN, REFS_SCHEMA, SECOND, bucket_keys, joined, pack_sorted, seen_packets,
                      shared_refs, string_array, unpack, unpack_sorted, window_hash, write_slices)


def _ends(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of its document and the word after the last, per word."""
    ends = np.cumsum(counts)
    return np.repeat(ends - counts, counts), np.repeat(ends, counts)


def _probe(window, block, buckets):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets = unpack(row)
                _, _, words, counts = word_spans(data, offsets, letters=PLAIN)
                runs = window_hash(words, block)
                first, end = (x[:len(runs)] for x in _ends(counts))
                at = np.arange(len(runs))
                fits = (at + block <= end) & (end - first >= window)
                keys = bucket_keys(runs, buckets)
                anchor = np.flatnonzero(fits & ((at - first) % block == 0))
                packets = list(seen_packets(row["slice"], keys[fits], buckets, keys[anchor], anchor))
                yield pa.RecordBatch.from_pylist(packets, PACKET)
    return run


WINDOW_SCHEMA = "bucket int, slice long, a binary, b binary, at binary"
WINDOW = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), ("a", pa.binary()), ("b", pa.binary()),
                    ("at", pa.binary())])


def _extend(window, block, buckets):
    def run(key, texts, anchors):
        if not len(anchors) or not len(texts):
            return pa.Table.from_pylist([], WINDOW)
        row = texts.to_pylist()[0]
        data, offsets = unpack(row)
        _, _, words, counts = word_spans(data, offsets, letters=PLAIN)
        first, end = _ends(counts)
        refs = np.concatenate([np.frombuffer(x, np.uint32) for x in anchors.column("refs").to_pylist()]).astype(np.int64)
        # The windows that hold an anchor, inside its document.
        lo, hi = np.maximum(refs + block - window, first[refs]), np.minimum(refs, end[refs] - window) + 1
        step = np.bincount(lo, minlength=len(words) + 1) - np.bincount(hi, minlength=len(words) + 1)
        at = np.flatnonzero(np.cumsum(step)[:len(words)] > 0)
        a = window_hash(words, window)[at]
        b = (window_hash(word_spans(data, offsets, letters=SECOND)[2], window)[at] >> U(32)).astype(np.uint32)
        order = np.lexsort((b, a))
        a, b, at = a[order], b[order], at[order]
        same = np.r_[False, (a[1:] == a[:-1]) & (b[1:] == b[:-1])]
        repeated = same | np.r_[same[1:], False]
        known = np.sort(at[repeated])
        a, b, at = a[~same], b[~same], at[~same]
        home = ((a >> U(32)) * U(buckets)) >> U(32)
        cut = np.searchsorted(home, np.arange(buckets + 1, dtype=U))
        out = [{"bucket": row["slice"] % buckets, "slice": row["slice"], "a": b"", "b": b"", "at": pack_sorted(known)}]
        for i in range(buckets):
            mine = slice(cut[i], cut[i + 1])
            if cut[i] < cut[i + 1]:
                by = np.argsort(at[mine])
                out.append({"bucket": i, "slice": row["slice"], "a": a[mine][by].tobytes(), "b": b[mine][by].tobytes(),
                            "at": pack_sorted(at[mine][by])})
        return pa.Table.from_pylist(out, WINDOW)
    return run


def _repeats(key, rows):
    """Windows that two slices hold, and those a slice knows to repeat."""
    a = [np.frombuffer(x, U) for x in rows.column("a").to_pylist()]
    b = [np.frombuffer(x, np.uint32) for x in rows.column("b").to_pylist()]
    size = np.array([len(x) for x in a])
    first, second = np.concatenate(a), np.concatenate(b)
    order = np.lexsort((second, first))
    x, y = first[order], second[order]
    same = np.r_[False, (x[1:] == x[:-1]) & (y[1:] == y[:-1])][:len(x)]
    twice = np.zeros(len(x), bool)
    twice[order] = same | np.r_[same[1:], False][:len(x)]
    ends = np.cumsum(size)
    slices, out = [], []
    for i, (no, at) in enumerate(zip(rows.column("slice").to_pylist(), rows.column("at").to_pylist(), strict=True)):
        at = unpack_sorted(at)
        if size[i]:
            at = at[twice[ends[i] - size[i]:ends[i]]]
        if len(at):
            slices.append(no)
            out.append(pack_sorted(at))
    return pa.table({"slice": pa.array(slices, pa.int64()), "refs": pa.array(out, pa.binary())})


CUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                 ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                 ("kept_text", pa.string())])
CUT_SCHEMA = ("doc_id long, n_words long, n_removed long, spans array<struct<start:long,length:long>>, kept_text string")


def _cut(window):
    def run(key, texts, found):
        if not len(texts):
            return pa.Table.from_pylist([], CUT)
        row = texts.to_pylist()[0]
        data, offsets = unpack(row)
        start, end, _, counts = word_spans(data, offsets, letters=PLAIN)
        docs, n = len(counts), len(start)
        at = np.concatenate([np.zeros(0, np.uint32), *[unpack_sorted(x) for x in found.column("refs").to_pylist()]]).astype(np.int64)
        step = np.bincount(at, minlength=n + 1) - np.bincount(at + window, minlength=n + 1)
        gone = np.cumsum(step)[:n] > 0
        doc_of = np.repeat(np.arange(docs), counts)
        first = np.cumsum(counts) - counts
        kept, cuts = joined(data, start[~gone], end[~gone], doc_of[~gone], docs)
        before = np.r_[False, gone[:-1] & (doc_of[1:] == doc_of[:-1])] if n else gone
        after = np.r_[gone[1:] & (doc_of[1:] == doc_of[:-1]), False] if n else gone
        head, tail = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
        spans = pa.StructArray.from_arrays([pa.array(head - first[doc_of[head]]), pa.array(tail - head + 1)],
                                           ["start", "length"])
        list_at = np.searchsorted(doc_of[head], np.arange(docs + 1)).astype(np.int32)
        return pa.Table.from_arrays(
            [pa.array(row["ids"], pa.int64()), pa.array(counts.astype(np.int64)),
             pa.array(np.bincount(doc_of[gone], minlength=docs).astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(list_at), spans), string_array(kept, cuts).cast(pa.string())], CUT.names)
    return run


def substring_dedup(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a window of ``window`` consecutive words
    whose word sequence also starts anywhere else, same document included.

    Returns one row per input row: doc_id, n_words, n_removed, spans (removed
    stretches: word number, words) and kept_text (kept words joined by one
    space).  Words are cut at ASCII white space and compared unchanged; windows
    are judged on the input.  NULL and empty text have no words; texts shorter
    than a window keep all; a repeated row repeats all its windows; NULL ids are
    documents like others; rows sharing an id stay apart; an empty table gives
    an empty result; other columns are ignored.  A text of any length is one
    row of a slice and is worked on whole, about 150 bytes of a task's memory
    a word.  There are no ties: every place of a repeat is removed."""
    block = (window + 1) // 2
    slices, buckets = write_slices(docs, id_col, text_col, "substring-slices")
    anchors = (slices.mapInArrow(_probe(window, block, buckets), PACKET_SCHEMA)
               .groupBy("bucket").applyInArrow(shared_refs, REFS_SCHEMA))
    by_slice = slices.groupBy("slice")
    windows = by_slice.cogroup(anchors.groupBy("slice")).applyInArrow(_extend(window, block, buckets), WINDOW_SCHEMA)
    repeats = windows.groupBy("bucket").applyInArrow(_repeats, REFS_SCHEMA)
    return by_slice.cogroup(repeats.groupBy("slice")).applyInArrow(_cut(window), CUT_SCHEMA)


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
           FROM documents),
w AS (SELECT r, unnest(range(len(ws) - 34)) AS i,
             unnest(list_transform(range(1, len(ws) - 33), lambda j: array_to_string(ws[j:j + 34], ' '))) AS k
      FROM d WHERE len(ws) >= 35),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS c FROM w) WHERE c > 1),
t AS (SELECT r, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM d),
m AS (SELECT t.r, t.i, t.word, coalesce(max(CASE WHEN dup.r IS NOT NULL THEN 1 ELSE 0 END)
        OVER (PARTITION BY t.r ORDER BY t.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
      FROM t LEFT JOIN dup ON t.r = dup.r AND t.i = dup.i),
s AS (SELECT r, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept
      FROM m GROUP BY r)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(s.n_removed, 0) AS n_removed,
       sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.r = s.r
"""


@register("op11_substring_dedup", OP11_SQL)
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))

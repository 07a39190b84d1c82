"""Periodic run detection by string synchronising sets.

A run is a stretch of words with smallest period q and a length of at least
3 q that no neighbouring word extends.  Runs are found scale by scale, every
scale t (a power of two) being in charge of the periods 2 t <= q < 4 t:

* The synchronising set of scale t holds the positions where the least hash of
  the t-word windows starting in [i, i + t] stands at an end of that range.  It
  is locally consistent: equal contexts of 2 t words are selected alike.
  Windows inside a highly periodic region (period at most t / 3) do not compete,
  so the set stays sparse; such regions are the runs of smaller scales.
* In a run of period q >= 2 t some selected position i of the first period has
  its copy i + q selected too, with an equal context.  Pairs of equal contexts
  2 t to 4 t words apart therefore propose every period; equal contexts are more
  than t / 3 apart, so a position has at most a dozen partners.
* A proposal is extended to the left and right by comparing dyadic hashes, and
  the stretch found is compared word by word.
* Periods below 8, the bottom of the scales, come from the highly periodic
  regions themselves, found by comparing the words with their shifted copy.

Of the periods proposed for a stretch the smallest counts (the others are its
multiples).  Documents are independent; there is no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, register, table
from .mixing import WORD
from .shingles import U, mix, text_slices, word_spans
from .wordseq import PLAIN, joined, string_array, twice

#: Least scale; periods below twice of it are found by shifting.
BASE = 4
TOP = U(0xFFFFFFFFFFFFFFFF)


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[i : i + width] for every i, from doubled ranges; beyond the end there is nothing."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x, np.concatenate([x[size:], np.full(min(size, len(x)), TOP)]))
        size *= 2
    rest = width - size
    return np.minimum(x, np.concatenate([x[rest:], np.full(min(rest, len(x)), TOP)])) if rest else x


def _shifted(t: np.ndarray, doc: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches [l, r) of period q and length 3 q or more."""
    if len(t) <= q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.concatenate([[False], (t[:-q] == t[q:]) & (doc[:-q] == doc[q:]), [False]])
    edge = np.flatnonzero(same[1:] != same[:-1])
    l, r = edge[0::2], edge[1::2] + q
    # Equal words of one document only: a stretch never crosses documents.
    long = r - l >= 3 * q
    return l[long], r[long]


def _common(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
    """Words that agree after (or before) the positions i and j, at most ``room``."""
    got = np.zeros(len(i), np.int64)
    for k in reversed(range(len(levels))):
        size, level = 1 << k, levels[k]
        fits = got + size <= room
        x = (i - got - size) if back else (i + got)
        y = (j - got - size) if back else (j + got)
        x, y = np.where(fits, x, 0), np.where(fits, y, 0)
        got += np.where(fits & (level[x] == level[y]), size, 0)
    return got


def _exact(t: np.ndarray, i: int, q: int, lo: int, hi: int) -> tuple[int, int]:
    """Stretch of period q around i and i + q by comparing words."""
    differ = np.flatnonzero(t[lo:hi - q] != t[lo + q:hi]) + lo
    at = int(np.searchsorted(differ, i))
    if at < len(differ) and differ[at] == i:
        return i, i
    return (int(differ[at - 1]) + 1 if at else lo), (int(differ[at]) if at < len(differ) else hi - q) + q


def find_runs(t: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first word, end, period) of every maximal stretch of exponent 3 or
    more, at places of ``t``: word numbers of documents one after the other."""
    n = len(t)
    doc = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    first, end = np.repeat(ends - counts, counts), np.repeat(ends, counts)
    longest = int(counts.max()) if len(counts) else 0
    found: dict[tuple[int, int], int] = {}

    def add(l, r, q):
        for a, b, p in zip(l.tolist(), r.tolist(), q.tolist(), strict=True):
            if p < found.get((a, b), 1 << 62):
                found[a, b] = p

    for q in range(1, 2 * BASE):
        l, r = _shifted(t, doc, q)
        add(l, r, np.full(len(l), q))
    # levels[k]: hashes of runs of 2 ** k words, by start.
    levels = [mix(t.astype(U) + U(0x632BE59BD9B4E019))]
    while 2 << (len(levels) - 1) <= longest:
        levels.append(twice(levels[-1], 1 << (len(levels) - 1)))
    k = BASE.bit_length() - 1
    while 6 << k <= longest:
        scale = 1 << k
        # Windows inside a document and outside highly periodic regions compete.
        value = np.full(n, TOP)
        inside = np.arange(n) + scale <= end
        value[:len(levels[k])] = levels[k]
        value[~inside] = TOP
        small = [(a, b) for (a, b), p in found.items() if 3 * p <= scale and b - a >= scale]
        if small:
            a, b = np.array(small).T
            step = np.bincount(a, minlength=n + 1) - np.bincount(b - scale + 1, minlength=n + 1)
            value[np.cumsum(step)[:n] > 0] = TOP
        least = _window_min(value, scale + 1)
        far = np.concatenate([value[scale:], np.full(min(scale, n), TOP)])
        at = np.flatnonzero((least != TOP) & ((value == least) | (far == least)) & (np.arange(n) + 2 * scale <= end))
        at = at[at < len(levels[k + 1])]
        context = levels[k + 1][at]
        order = np.lexsort((at, context))
        at, context = at[order], context[order]
        i, j, s = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        pairs = []
        while s < len(at):
            near = ((context[s:] == context[:-s]) & (at[s:] - at[:-s] < 4 * scale) & (doc[at[s:]] == doc[at[:-s]]))
            if not near.any():
                break
            use = near & (at[s:] - at[:-s] >= 2 * scale)
            pairs.append((at[:-s][use], at[s:][use]))
            s += 1
        if pairs:
            i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
        if len(i):
            q = j - i
            l = i - _common(levels, i, j, i - first[i], True)
            r = j + _common(levels, i, j, end[i] - j, False)
            long = r - l >= 3 * q
            stretch, which = np.unique(np.stack([l[long], r[long], q[long]], 1), axis=0, return_index=True)
            anchor = i[long][which]
            for m, (a, b, p) in enumerate(stretch.tolist()):
                if not np.array_equal(t[a:b - p], t[a + p:b]):  # a hash that lied
                    a, b = _exact(t, int(anchor[m]), p, int(first[anchor[m]]), int(end[anchor[m]]))
                    if b - a < 3 * p:
                        continue
                if p < found.get((a, b), 1 << 62):
                    found[a, b] = p
        k += 1
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    rows = np.array([(a, p, b) for (a, b), p in found.items()], np.int64)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    return rows[:, 0], rows[:, 2], rows[:, 1]


def _runs_by_length(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """``find_runs`` over documents of about equal length at a time, so that
    short ones do not take part in the scales of long ones."""
    begin = np.cumsum(counts) - counts
    group = np.where(counts >= 3, np.log2(np.maximum(counts, 1)).astype(np.int64), -1)
    parts = []
    for g in np.unique(group[group >= 0]):
        docs = np.flatnonzero(group == g)
        size = counts[docs]
        base = np.cumsum(size) - size
        at = np.repeat(begin[docs] - base, size) + np.arange(int(size.sum()))
        l, r, q = find_runs(words[at], size)
        parts.append((at[l], at[l] + (r - l), q))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    l, r, q = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((q, l))
    return l[order], r[order], q[order]


OUT = ["doc_id", "n_words", "runs", "collapsed_text"]
OUT_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string"


def _detect(least, slice_bytes):
    def run(batches):
        for batch in batches:
            for row, to, data, offsets in text_slices(batch.column(1), slice_bytes):
                start, end, _, counts = word_spans(data, offsets, letters=PLAIN)
                docs, n = len(counts), len(start)
                doc_of = np.repeat(np.arange(docs), counts)
                # Exact word numbers: equal numbers are equal words.
                packed, cuts = joined(data, start, end, np.arange(n), n)
                words = string_array(packed, cuts).dictionary_encode().indices.to_numpy() if n else np.zeros(0, np.int32)
                l, r, q = _runs_by_length(words, counts)
                keep = r - l >= np.maximum(least, 3 * q)
                l, r, q = l[keep], r[keep], q[keep]
                step = np.bincount(l + q, minlength=n + 1) - np.bincount(r, minlength=n + 1)
                left = np.cumsum(step)[:n] == 0
                text, at = joined(data, start[left], end[left], doc_of[left], docs)
                first = np.cumsum(counts) - counts
                runs = pa.StructArray.from_arrays(
                    [pa.array(l - first[doc_of[l]]), pa.array(r - l), pa.array(q)], ["start", "length", "period"])
                lists = np.searchsorted(doc_of[l], np.arange(docs + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, to - row), pa.array(counts.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(lists), runs), string_array(text, at).cast(pa.string())], OUT)
    return run


def periodic_runs(docs: DataFrame, least: int = 24, id_col: str = "doc_id", text_col: str = "text",
                  slice_bytes: int = 1 << 20) -> DataFrame:
    """Every run of at least ``least`` words and exponent 3 of every text.

    Returns one row per input row: doc_id, n_words, runs (start, length,
    period; by start, then period) and collapsed_text: the words, joined by one
    space, that no run contains after its first period.  NULL and empty text
    have no words and no runs; repeated rows and NULL ids are rows like others;
    an empty table gives an empty result; other columns are ignored.  Runs that
    tie are all returned.  A text of any length is worked on whole inside one
    task (8 bytes a word for each doubling of its length)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_detect(least, slice_bytes), OUT_SCHEMA)


def with_tandem(doc_id: Column, text: Column) -> Column:
    """The contract's input: texts whose crc32(doc_id) ends in 0 repeat a
    stretch of their words up to the end; the others stay."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    return F.when((h % 10 == 0) & F.regexp_like(text, F.lit(WORD)),
                  _tandem(F.floor(h / 10).cast("long"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))).otherwise(text)


def _tandem(g: Column, words: Column) -> Column:
    # transform binds words, a and p once per row.
    bound = F.transform(F.array(words), lambda w: F.struct(
        w.alias("w"), F.pmod(g, F.size(w).cast("long")).alias("a")))
    bound = F.transform(bound, lambda x: F.struct(
        x["w"].alias("w"), x["a"].alias("a"),
        (F.floor((F.size(x["w"]).cast("long") - x["a"]) / (3 + F.pmod(g, F.lit(8)))) + 1).alias("p")))
    return F.transform(bound, lambda x: F.array_join(F.transform(
        F.sequence(F.lit(0).cast("long"), F.size(x["w"]).cast("long") - 1),
        lambda i: F.get(x["w"], F.when(i < x["a"], i).otherwise(x["a"] + F.pmod(i - x["a"], x["p"])).cast("int"))), " "))[0]


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", with_tandem(F.col("doc_id"), clean_text("text")).alias("text"))
    out = periodic_runs(rows)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, x: F.when(
        x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))
    listed = F.array_join(F.transform("runs", lambda x: F.concat_ws(
        ",", *[x[c].cast("string") for c in ("start", "length", "period")])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    digest = lambda x: F.sha2(F.encode(x, "UTF-8"), 256)
    return (out.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                    digest(listed).alias("runs_sha256"), digest(F.col("collapsed_text")).alias("collapsed_sha256")))

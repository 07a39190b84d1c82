"""Substring dedup, embedding whitening and periodic runs against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from mercantile.llm import periodic_runs as runs
from mercantile.llm import substring_dedup as sub
from mercantile.llm import whitening, wordseq
from mercantile.llm.common import QUERIES

from . import cases
from .test_vectors_and_models import VECTORS, hard_vectors, vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- op11 ------------------------------------------------------------------
def brute_substrings(some, window):
    where = collections.Counter()
    lists = [words_of(t) for _, t, *_ in some]
    for ws in lists:
        where.update(tuple(ws[i:i + window]) for i in range(len(ws) - window + 1))
    out = []
    for (i, *_), ws in zip(some, lists, strict=True):
        gone = [False] * len(ws)
        for s in range(len(ws) - window + 1):
            if where[tuple(ws[s:s + window])] > 1:
                gone[s:s + window] = [True] * window
        out.append((i, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone, strict=True) if not g)))
    return out


def key(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])




@pytest.mark.parametrize("window", [1, 2, 35])
def test_substrings_of_hard_rows(spark, window):
    out = sub.substring_dedup(cases.frame(spark), window=window).collect()
    assert key([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out]) == key(brute_substrings(cases.rows(), window))
    for r in out:
        assert sum(s.length for s in r.spans) == r.n_removed
        assert all(a.start + a.length < b.start for a, b in zip(r.spans, r.spans[1:]))


def planted_texts(seed, docs=60):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(200))
    passages = [[word() for _ in range(rng.randrange(30, 90))] for _ in range(5)]
    out = []
    for i in range(docs):
        ws = [word() for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) - 20)
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = p[a:] if rng.random() < 0.7 else p
        if i % 9 == 0:
            ws = [rng.choice("xy") for _ in range(rng.randrange(100))]
        if i % 11 == 0:
            ws = [word() for _ in range(7)] * 12
        out.append((i, rng.choice([" ", "\n", "\t "]).join(ws), "a"))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_substrings_share_across_slices(spark, seed, monkeypatch):
    """Small slices and buckets: the passages meet over many packets."""
    some = planted_texts(seed)
    monkeypatch.setattr(wordseq, "BUCKET_BYTES", 4000)
    docs = cases.frame(spark, some).repartition(13)
    out = sub.substring_dedup(docs).collect()
    assert key([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out]) == key(brute_substrings(some, 35))


def test_substrings_of_an_empty_table(spark):
    assert sub.substring_dedup(cases.empty(spark)).collect() == []
    assert sub.substring_dedup(cases.frame(spark, [(1, None, "a"), (None, "", None)])).count() == 2


def test_packets_round_trip():
    rng = np.random.default_rng(0)
    x = np.sort(rng.integers(0, 1 << 32, 1000, dtype=np.uint64)).astype(np.uint32)
    assert (wordseq.unpack_sorted(wordseq.pack_sorted(x)) == x).all()
    assert len(wordseq.unpack_sorted(wordseq.pack_sorted(x[:0]))) == 0
    words = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    words[100:140] = words[20:60]
    h = wordseq.window_hash(words, 35)
    assert (h[100:106] == h[20:26]).all() and len(np.unique(h)) == len(h) - 6


# ---- op12 ------------------------------------------------------------------
def brute_whitening(some, components=4):
    ok = [(i, v) for i, v, _ in some if v and all(c is not None and np.isfinite(c) for c in v)
          and all(abs(c * 256) < 2 ** 53 for c in v)]
    dims = max(collections.Counter(len(v) for _, v in ok).items(), key=lambda x: (x[1], x[0]))[0]
    ok = [(i, np.floor(np.array(v, np.float64) * 256).astype(np.int64)) for i, v in ok if len(v) == dims]
    fit = np.array(sorted({tuple(x.tolist()) for _, x in ok}), np.int64)
    n, total = len(fit), fit.sum(0)
    centred = (n * fit - total) / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    out = []
    for i, x in ok:
        y = [n * int(a) - int(s) for a, s in zip(x, total, strict=True)]
        for c in range(min(components, dims)):
            out.append((i, c + 1, n, sum(a * a for a in y), float((np.array(y) / n) @ vector[:, c] / np.sqrt(value[c])),
                        value[c] / value.sum()))
    return out


@pytest.mark.parametrize("block", [1 << 19, 64 * 8])
def test_whitening_of_hard_vectors(spark, block, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", block)
    monkeypatch.setattr(whitening, "SPLIT", 2)
    some = hard_vectors(300, 8)
    out = whitening.whiten_embeddings(vectors(spark, some)).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got, want = sorted((tuple(r) for r in out), key=order), sorted(brute_whitening(some), key=order)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for c in range(1, 5):
        a = np.array([r[4] for r in got if r[1] == c])
        b = np.array([r[4] for r in want if r[1] == c])
        assert np.allclose(a, b if a @ b > 0 else -b, atol=1e-8)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert {r[6] for r in got} and max(r[6] for r in got) < 1e-9


def test_whitening_without_variance(spark):
    same = [(i, [1.0, 2.0, 3.0], 1) for i in range(5)]
    out = whitening.whiten_embeddings(vectors(spark, same)).collect()
    assert len(out) == 15 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in out} == {(1, 0, 0.0, 0.0, 0.0)}
    line = [(i, [float(i), 2.0 * i], 1) for i in range(6)]
    out = whitening.whiten_embeddings(vectors(spark, line)).collect()
    assert {r.whitened for r in out if r.component == 2} == {0.0}
    assert np.isclose(np.var([r.whitened for r in out if r.component == 1]), 1)
    assert whitening.whiten_embeddings(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whiten_embeddings(vectors(spark, [(1, None, 1), (2, [], 1)])).collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    out = whitening.whiten_embeddings(vectors(spark, [(1, [1e12, 0.0], 1), (2, [-1e12, 1.0], 1), (3, [0.0, 0.0], 1)]))
    assert out.where("deviation IS NULL").count() == 4 and out.count() == 6


# ---- op13 ------------------------------------------------------------------
def brute_runs(ws, least=24):
    n, found = len(ws), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            if j + q - i >= 3 * q and (i, j + q) not in found:
                found[i, j + q] = q
            i = j + 1
    return sorted((l, r - l, q) for (l, r), q in found.items() if r - l >= max(least, 3 * q))


def collapse(ws, found):
    gone = set()
    for l, size, q in found:
        gone.update(range(l + q, l + size))
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def periodic_texts(seed, docs=40):
    rng = random.Random(seed)
    out = [(i, t, s) for i, t, s in cases.rows() if t is None or len(t) < 20_000]
    for i in range(100, 100 + docs):
        kinds = rng.choice([1, 2, 3, 40])
        ws = [str(rng.randrange(kinds)) for _ in range(rng.randrange(300))]
        for _ in range(rng.randrange(4)):
            if len(ws) < 4:
                break
            s = rng.randrange(len(ws))
            p = 1 + rng.randrange(max(1, (len(ws) - s) // 3))
            for j in range(s, min(len(ws), s + int(p * rng.uniform(2.5, 7)))):
                ws[j] = ws[s + (j - s) % p]
        out.append((i, " ".join(ws), "a"))
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    out += [(900, " ".join(fibonacci[-1]), "a"), (901, " ".join(bin(i).count("1") % 2 * "b" or "a" for i in range(256)) * 3, "a"),
            (902, "x " * 700, "b"), (903, "ab " * 23, "b"), (904, "ab " * 24, "b")]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_periodic_runs(spark, seed):
    some = periodic_texts(seed)
    out = runs.periodic_runs(cases.frame(spark, some), slice_bytes=3000).collect()
    want = []
    for i, t, _ in some:
        ws = words_of(t)
        found = brute_runs(ws)
        want.append((i, len(ws), found, collapse(ws, found)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text) for r in out]
    assert key(got) == key(want)


def test_runs_of_a_long_text(spark):
    rng = random.Random(1)
    root = [str(rng.randrange(5)) for _ in range(9000)]
    ws = root * 3 + root[:77] + ["end"] + ["a", "b"] * 40
    r = runs.periodic_runs(cases.frame(spark, [(1, " ".join(ws), "a")])).first()
    found = [tuple(x) for x in r.runs]
    assert (0, 27077, 9000) in found and (27078, 80, 2) in found


def test_a_hash_that_lies_is_found_out(monkeypatch):
    """With colliding hashes every stretch is still compared word by word."""
    monkeypatch.setattr(runs, "mix", lambda x: x % np.uint64(3))
    ws = np.array(([1, 2, 3, 4, 5, 6, 7, 8, 9] * 4 + list(range(10, 40))) * 2, np.int32)
    l, r, q = runs.find_runs(ws, np.array([len(ws)]))
    for a, b, p in zip(l, r, q, strict=True):
        assert (ws[a:b - p] == ws[a + p:b]).all()


def test_no_runs_in_an_empty_table(spark):
    assert runs.periodic_runs(cases.empty(spark)).collect() == []


def test_op13_contract(spark, tmp_path):
    some = periodic_texts(7)
    cases.frame(spark, some, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    want, changed = [], 0
    for i, t, _ in some:
        ws = words_of(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        g, n = h // 10, len(ws)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [w if j < a else ws[a + (j - a) % p] for j, w in enumerate(ws)]
            changed += 1
        found = brute_runs(ws)
        best = min(found, key=lambda x: (-x[1] * 10 ** 9 // x[2], x[0], x[2])) if found else None
        listed = "".join(f"{l},{s},{q}\n" for l, s, q in found)
        want.append((i, len(found), *(best or (None,) * 3), best[1] * 1000 // best[2] if best else None,
                     sha(listed), sha(collapse(ws, found))))
    assert changed > 2
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    assert key(got) == key(want)

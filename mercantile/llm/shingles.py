"""Vectorised word shingles over Arrow text columns (runs inside tasks).

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  A word's hash is a
polynomial over its bytes taken from prefix sums modulo 2**64, so a whole
batch is hashed without a loop over words; a shingle's hash mixes the hashes of
its words.  Sets are compared by these 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
CHUNK = 2 << 20
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), element by element, modulo 2**64."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


LETTER = mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))
LETTER[65:91] = LETTER[97:123]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, kept for the worker's life."""
    if not _powers or len(_powers["p"]) < n:
        n = max(n, CHUNK + 4096)
        for name, base in (("p", _BASE), ("i", _INVERSE)):
            steps = np.full(n, base, U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["p"], _powers["i"]


def _chunk_words(data: np.ndarray, first: np.ndarray, gap: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends and hashes of the words of a piece that no word crosses."""
    solid = ~gap[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | first[1:]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(letters[data] * power[:len(data)], out=sums[1:])
    return s, e, mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U))


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _SPACE,
               letters: np.ndarray = LETTER) -> tuple[np.ndarray, ...]:
    """(start, end and hash of every word, words per document) of concatenated
    UTF-8 texts; ``offsets`` start at 0, ``gap`` tells the bytes between words,
    ``letters`` the value of a byte in the hash.
    Long input is cut where no word is."""
    n = len(data)
    first = np.zeros(n, bool)
    inner = offsets[:-1]
    first[inner[inner < n]] = True
    parts, at = [], 0
    while at < n:
        to = min(n, at + CHUNK)
        while to < n:
            free = np.flatnonzero(gap[data[to:to + CHUNK]] | first[to:to + CHUNK])
            if len(free):
                to += int(free[0])
                break
            to = min(n, to + CHUNK)
        s, e, h = _chunk_words(data[at:to], first[at:to], gap, letters)
        parts.append((s + at, e + at, h))
        at = to
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U))
    s, e, h = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else none
    return s, e, h, np.diff(np.searchsorted(s, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per document)."""
    return word_spans(data, offsets)[2:]


def sequence_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    m = len(words) - width + 1
    acc = np.full(max(m, 0), width, U)
    for t in range(width):
        acc = mix(acc * U(0x2545F4914F6CDD1D) + words[t:t + max(m, 0)])
    return acc


def shingle_sets(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document: (hashes, set sizes), documents one
    after the other, hashes ascending.  Fewer than ``width`` words give the
    whole sequence as one shingle, no words the empty set."""
    ends = np.cumsum(counts)
    doc_of = np.repeat(np.arange(len(counts)), counts)
    every = sequence_hash(words, width)
    same = doc_of[:len(every)] == doc_of[width - 1:] if len(every) else np.zeros(0, bool)
    hashes, docs = every[same], doc_of[:len(every)][same]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.array([sequence_hash(words[ends[d] - counts[d]:ends[d]], counts[d])[0] for d in short], U)
        hashes, docs = np.concatenate([hashes, extra]), np.concatenate([docs, short])
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    return hashes[keep], np.bincount(docs[keep], minlength=len(counts))


def text_slices(text: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of about ``most`` bytes,
    whole texts each; NULL is empty text."""
    text = pc.fill_null(text, "")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string())
    _, off, buf = text.buffers()
    offsets = np.frombuffer(off, np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        to = min(to, len(text))
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to

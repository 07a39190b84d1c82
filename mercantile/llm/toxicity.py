"""Toxicity: a bidirectional gated recurrent network with attention pooling,
over character and word inputs, written and trained in numpy.

A word enters as the sum of an embedding of the word and embeddings of its
character n-grams (hashed).  Windows of ``WINDOW`` words, each starting
``STRIDE`` after the one before, run through a GRU in both directions;
attention pools the states of a window into one logit.  A document's logit is
the largest over all its windows.  Training sees document labels only: the
gradient reaches windows through a smooth maximum.

Fitting is bounded (``FIT_DOCS`` documents a class, each of at most
``FIT_CHARS`` characters), scoring is not: every window of every whole text.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, register, table
from .shingles import LETTER, U, mix, powers, text_slices, word_spans

WINDOW, STRIDE = 48, 24
DIM, HIDDEN = 16, 8
WORD_ROWS, GRAM_ROWS = 1 << 15, 1 << 17
GRAMS = (3, 4, 5)  # ascending, and no longer than ^x$ allows for the first
#: Labelled documents of either class that are fitted at most, their most
#: characters, and the most windows of one that a step looks at.
FIT_DOCS, FIT_CHARS, FIT_WINDOWS = 3000, 12_000, 24
EPOCHS, BATCH = 6, 48
MIN_STEPS = 500  # few documents are seen more often
#: Words and n-grams of fewer fitted documents stay neutral, and training
#: leaves out this share of the inputs at random.
MIN_DOCS, DROP = 3, 0.3
SCORE_BYTES = 2 << 20

# Words are runs of ASCII letters, digits and non-ASCII bytes.
_GAP = np.ones(256, bool)
_GAP[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _GAP[_a:_b] = False


@dataclass
class Words:
    """Distinct words of some texts with their input rows, and the texts as
    numbers of these words."""
    word: np.ndarray      # row in the word table
    gram: np.ndarray      # rows in the n-gram table, word after word
    bounds: np.ndarray    # where a word's n-grams begin
    text: np.ndarray      # word number of every position
    counts: np.ndarray    # positions per document


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    s, e, h, counts = word_spans(data, offsets, _GAP)
    distinct, at, text = np.unique(h, return_index=True, return_inverse=True)
    text, s, e = text.astype(np.int32), s[at], e[at]
    # ^word$ of every distinct word, one after the other.
    size = (e - s + 2).astype(np.int32)
    end = np.cumsum(size)
    begin = end - size
    total = int(end[-1]) if len(end) else 0
    left = np.repeat(end, size).astype(np.int32) - np.arange(total, dtype=np.int32)  # bytes to the word's end
    flat = data[np.minimum(np.repeat(e + 1, size) - left, max(len(data) - 1, 0))] if total else np.zeros(0, np.uint8)
    flat[begin] = 94
    flat[end - 1] = 36
    power, inverse = powers(total + 1)
    sums = np.zeros(total + 1, U)
    np.cumsum(LETTER[flat] * power[:total], out=sums[1:])
    # A place starts one n-gram of each length that ends in the word.
    starts = sum((left >= n).astype(np.int8) for n in GRAMS)
    after = np.cumsum(starts, dtype=np.int64)
    gram = np.zeros(int(after[-1]) if total else 0, np.int32)
    for k, n in enumerate(GRAMS):
        i = np.flatnonzero(left >= n)
        g = mix((sums[i + n] - sums[i]) * inverse[i] + U(n))
        gram[after[i] - starts[i] + k] = (g >> U(13)) % U(GRAM_ROWS)
    bounds = after[begin] - starts[begin]
    return Words(((distinct >> U(11)) % U(WORD_ROWS)).astype(np.int32), gram, bounds, text, counts)


def window_table(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first position, length, document) of every overlapping window; a
    document without words has one empty window."""
    number = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    base = np.repeat(np.cumsum(counts) - counts, number)
    return base + nth * STRIDE, np.clip(counts[doc] - nth * STRIDE, 0, WINDOW), doc


def new_model(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    f = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    zero = lambda *shape: np.zeros(shape, np.float32)
    # Inputs start at zero, so words never seen in training stay neutral.
    return {"word": zero(WORD_ROWS, DIM), "gram": zero(GRAM_ROWS, DIM),
            "wf": f(DIM, 3 * HIDDEN), "uf": f(HIDDEN, 3 * HIDDEN), "bf": zero(3 * HIDDEN),
            "wb": f(DIM, 3 * HIDDEN), "ub": f(HIDDEN, 3 * HIDDEN), "bb": zero(3 * HIDDEN),
            "att": f(2 * HIDDEN), "out": f(2 * HIDDEN), "bias": np.full(1, -1.0, np.float32)}


def embed(m, words: Words, step: int = 8192) -> np.ndarray:
    """Inputs by word number, some words at a time."""
    out = m["word"][words.word]
    ends = np.append(words.bounds[1:], len(words.gram))
    for at in range(0, len(out), step):
        lo, hi = words.bounds[at], ends[min(at + step, len(out)) - 1]
        out[at:at + step] += np.add.reduceat(m["gram"][words.gram[lo:hi]], words.bounds[at:at + step] - lo, axis=0)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gru(x, place, length, u, back, keep):
    """States (windows, WINDOW, HIDDEN) of one direction.  ``x`` has projected
    inputs by word number, ``place`` the word numbers of the windows."""
    n = len(place)
    h = np.zeros((n, HIDDEN), np.float32)
    states = np.zeros((WINDOW, n, HIDDEN), np.float32)
    saved = []
    for t in range(WINDOW - 1, -1, -1) if back else range(WINDOW):
        inside = (t < length)[:, None]
        a = x[place[:, t]]
        b = h @ u
        gates = _sigmoid(a[:, :2 * HIDDEN] + b[:, :2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        c = np.tanh(a[:, 2 * HIDDEN:] + r * b[:, 2 * HIDDEN:])
        new = np.where(inside, c + z * (h - c), h)
        if keep:
            saved.append((t, inside, h, z, r, c, b[:, 2 * HIDDEN:]))
        h = new
        states[t] = np.where(inside, h, 0)
    return states, saved


def _gru_back(d_states, saved, u, place, words):
    """Gradients of the projected inputs by word number, and of ``u``."""
    n = d_states.shape[1]
    dh = np.zeros((n, HIDDEN), np.float32)
    du = np.zeros_like(u)
    dx = np.zeros((words, 3 * HIDDEN), np.float32)
    for t, inside, h, z, r, c, bn in reversed(saved):
        dh = dh + np.where(inside, d_states[t], 0)
        g = np.where(inside, dh, 0)
        dc = g * (1 - z) * (1 - c * c)
        dz = g * (h - c) * z * (1 - z)
        dr = dc * bn * r * (1 - r)
        da = np.concatenate([dz, dr, dc], axis=1)
        db = np.concatenate([dz, dr, dc * r], axis=1)
        du += h.T @ db
        dh = np.where(inside, g * z + db @ u.T, dh)
        np.add.at(dx, place[:, t], np.where(inside, da, 0))
    return dx, du


def _forward(m, x, place, length, keep=False):
    """Logits of windows."""
    sf, kf = _gru(x @ m["wf"] + m["bf"], place, length, m["uf"], False, keep)
    sb, kb = _gru(x @ m["wb"] + m["bb"], place, length, m["ub"], True, keep)
    states = np.concatenate([sf, sb], axis=2)
    inside = (np.arange(WINDOW)[:, None] < length[None, :])
    weight = np.where(inside, states @ m["att"], -1e9)
    weight = np.exp(weight - weight.max(axis=0)) * inside
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    pooled = (weight[:, :, None] * states).sum(axis=0)
    return pooled @ m["out"] + m["bias"][0], (states, weight, pooled, kf, kb)


def _backward(m, x, place, length, kept, d_logit):
    states, weight, pooled, kf, kb = kept
    g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
    d_pooled = d_logit[:, None] * m["out"]
    d_states = weight[:, :, None] * d_pooled[None]
    d_weight = (states * d_pooled[None]).sum(axis=2)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["att"] = (states * d_score[:, :, None]).sum(axis=(0, 1))
    d_states = d_states + d_score[:, :, None] * m["att"]
    dx = 0
    for side, saved, part in (("f", kf, slice(0, HIDDEN)), ("b", kb, slice(HIDDEN, None))):
        d_proj, g["u" + side] = _gru_back(d_states[:, :, part], saved, m["u" + side], place, len(x))
        g["w" + side], g["b" + side] = x.T @ d_proj, d_proj.sum(axis=0)
        dx = dx + d_proj @ m["w" + side].T
    return g, dx


def _places(words: Words, first, length) -> np.ndarray:
    at = first[:, None] + np.arange(WINDOW)[None, :]
    at = np.where(np.arange(WINDOW)[None, :] < length[:, None], at, 0)
    return words.text[at] if len(words.text) else np.zeros_like(at)


def document_logits(m, words: Words, step: int = 2048) -> np.ndarray:
    """Largest window logit of every document, over all its windows."""
    x = embed(m, words)
    if not len(x):
        x = np.zeros((1, DIM), np.float32)
    first, length, doc = window_table(words.counts)
    logits = np.empty(len(first), np.float32)
    for at in range(0, len(first), step):
        p = slice(at, at + step)
        logits[p] = _forward(m, x, _places(words, first[p], length[p]), length[p])[0]
    return np.maximum.reduceat(logits, np.searchsorted(doc, np.arange(len(words.counts))))


def _subset(words: Words, used: np.ndarray) -> tuple[Words, np.ndarray]:
    """The input rows of some words, and their number by old number."""
    ends = np.append(words.bounds[1:], len(words.gram))
    size = (ends - words.bounds)[used]
    begin = np.cumsum(size) - size
    at = np.repeat(words.bounds[used] - begin, size) + np.arange(int(size.sum()))
    return Words(words.word[used], words.gram[at], begin, words.text, words.counts), size


def _known(words: Words) -> dict[str, np.ndarray]:
    """Which input rows occur in at least ``MIN_DOCS`` documents (n-grams: in
    as many pairs of document and word)."""
    n = max(1, len(words.word))
    doc = np.repeat(np.arange(len(words.counts)), words.counts)
    docs = np.bincount(np.unique(doc * n + words.text) % n, minlength=n)[:len(words.word)]  # LONG keys
    size = np.diff(np.append(words.bounds, len(words.gram)))
    return {"word": np.bincount(words.word, docs, WORD_ROWS) >= MIN_DOCS,
            "gram": np.bincount(words.gram, np.repeat(docs, size), GRAM_ROWS) >= MIN_DOCS}


def fit(texts: list[str], labels: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
    """Train on documents; a fifth of them sets the decision point."""
    rng = np.random.default_rng(seed)
    m = new_model(seed)
    labels = labels.astype(np.float32)
    if len(texts) == 0 or labels.min() == labels.max():
        m["shift"] = np.array([30.0 if len(texts) == 0 or labels.max() < 1 else -30.0], np.float32)
        return m
    _, _, data, offsets = next(text_slices(pa.array(texts), 1 << 62))
    words = read_words(data, offsets)
    first, length, doc = window_table(words.counts)
    held = rng.random(len(texts)) < 0.2
    known = _known(words)
    dense = [k for k in m if k not in ("word", "gram")]
    one, two = {k: np.zeros_like(m[k]) for k in dense}, {k: np.zeros_like(m[k]) for k in dense}
    seen = {"word": np.full(WORD_ROWS, 1e-3, np.float32), "gram": np.full(GRAM_ROWS, 1e-3, np.float32)}
    window_of = np.searchsorted(doc, np.arange(len(texts) + 1))
    step = 0
    epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // max(1, int((~held).sum()))))
    for epoch in range(epochs):
        order = rng.permutation(np.flatnonzero(~held))
        rate = 0.6 ** (EPOCHS * epoch / epochs)
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            picked = []
            for d in batch:
                own = np.arange(window_of[d], window_of[d + 1])
                picked.append(own if len(own) <= FIT_WINDOWS else rng.choice(own, FIT_WINDOWS, replace=False)
                              if labels[d] == 0 else own)
            size = np.array([len(p) for p in picked])
            w = np.concatenate(picked)
            place = _places(words, first[w], length[w])
            used, place = np.unique(place, return_inverse=True)
            place = place.reshape(len(w), WINDOW)
            part, grams = _subset(words, used)
            x = embed(m, part)
            alive = rng.random((len(x), 1)) >= DROP
            x = np.where(alive, x, 0)
            logit, kept = _forward(m, x, place, length[w], keep=True)
            # Smooth maximum over a document's windows.
            begin = np.cumsum(size) - size
            owner = np.repeat(np.arange(len(batch)), size)
            top = np.maximum.reduceat(logit, begin)
            soft = np.exp(2 * (logit - top[owner]))
            share = soft / np.add.reduceat(soft, begin)[owner]
            whole = np.add.reduceat(share * logit, begin)
            d_doc = (_sigmoid(whole) - labels[batch]) / len(batch)
            d_logit = (d_doc[owner] * share * (1 + 2 * (logit - whole[owner]))).astype(np.float32)
            g, dx = _backward(m, x, place, length[w], kept, d_logit)
            dx = np.where(alive, dx, 0)
            step += 1
            for k in dense:
                one[k] += 0.1 * (g[k] - one[k])
                two[k] += 0.001 * (g[k] ** 2 - two[k])
                m[k] -= (0.01 * rate * one[k] / (1 - 0.9 ** step)
                         / (np.sqrt(two[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            for k, rows, grad in (("word", part.word, dx), ("gram", part.gram, np.repeat(dx, grams, axis=0))):
                rows, grad = rows[known[k][rows]], grad[known[k][rows]]
                distinct, back = np.unique(rows, return_inverse=True)
                total = np.zeros((len(distinct), DIM), np.float32)
                np.add.at(total, back, grad)
                seen[k][distinct] += (total ** 2).mean(axis=1)
                m[k][distinct] -= 0.1 * total / np.sqrt(seen[k][distinct])[:, None]
    logits = document_logits(m, words)
    judge = held if labels[held].sum() >= 10 and (1 - labels[held]).sum() >= 10 else np.ones(len(texts), bool)
    m["shift"] = np.array([_decision(logits[judge], labels[judge])], np.float32)
    return m


def _decision(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit that splits best (F1); the middle of the best gap."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    k = int(np.argmax(f1))
    above = logits[order[k]]
    below = logits[order[k + 1]] if k + 1 < len(order) else above - 1
    return float((above + below) / 2)


POINT = 0.3  # scores from here on are predicted toxic


def _score(model):
    def run(batches):
        for batch in batches:
            for at, to, score in _scores(model.value, batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(score, pa.float64())], ["doc_id", "score"])
    return run


def _scores(model, text):
    """(first row, end row, scores) of slices of a text column."""
    for at, to, data, offsets in text_slices(text, SCORE_BYTES):
        logits = document_logits(model, read_words(data, offsets)).astype(np.float64)
        yield at, to, _sigmoid(logits - float(model["shift"][0]) + np.log(POINT / (1 - POINT)))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS, seed: int = 11):
    """Fit on at most ``fit_docs`` labelled documents of either class that are
    not held out, first in hash order of the id.  Rows of ``labels`` without an
    id or a label are ignored; of several the largest label counts.  Without
    both classes the model gives every document the one label (0 if none)."""
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("y"))
             .where(~held_out("doc_id")).withColumn("turn", F.xxhash64(F.lit("fit"), "doc_id")))
    texts = docs.select(F.col(id_col).alias("doc_id"), clean_text(text_col).alias("text")).where(
        F.length("text") <= fit_chars)
    # Ids are chosen first, so that only the texts of the sample move.
    fits = texts.select("doc_id").distinct()
    chosen = [marks.where(F.col("y") == y).join(fits, "doc_id", "left_semi").orderBy("turn", "doc_id").limit(fit_docs)
              for y in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * fit_docs rows
    picked = texts.join(ids, "doc_id").groupBy("y", "turn", "doc_id").agg(F.min("text").alias("text"))

    def task(batches):
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by([(c, "ascending") for c in ("y", "turn", "doc_id", "text")])
        model = fit(rows.column("text").to_pylist(), rows.column("y").to_numpy().astype(np.float32), seed)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # One task by design: the sample is bounded, the model has a fixed size.
    fitted = picked.repartition(1).mapInArrow(task, "model binary").collect()
    return pickle.loads(fitted[0]["model"]) if fitted else fit([], np.zeros(0, np.float32), seed)


def score_documents(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from ``POINT`` on), one
    row per input row.

    Every overlapping window of every whole text is scored; NULL and empty
    text have one empty window.  NULL ids are not held out; repeated rows get
    equal scores; an empty table gives an empty result; other columns are
    ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _score(shared), "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= POINT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays below ``POINT``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    where = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for at, to, score in _scores(shared.value, batch.column(where)):
                yield batch.slice(at, to - at).filter(pa.array(score < POINT))
    return docs.mapInArrow(run, docs.schema)


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))

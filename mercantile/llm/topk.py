"""Exact top-k search by the threshold algorithm.

Rows are cut into stripes; a stripe keeps one list per dimension, sorted by
that component.  For a block of queries the lists are read from the end that
the sign of the query's component favours, a deeper round at a time; rows seen
first in a round are scored in full (random access), and a query stops when
its bound, the score a row would have that sits exactly at the current depth
of every list, cannot reach its k-th score.  Stripes and query blocks meet in
tiles, so neither side has to fit in one task; the tiles' results are merged
per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import register, table

STRIPE = 16_384
BLOCK = 512
FIRST_DEPTH = 32
_LIMIT = 1 << 62


def _quantise(scale):
    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            keep, blobs = [], []
            for i, v in enumerate(batch.column("vec")):
                if not v.is_valid or not ids[i].is_valid or v.values.null_count or not len(v.values):
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(x * scale), -_LIMIT, _LIMIT)
                keep.append(i)
                blobs.append(x.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keep, pa.int64())), pa.array([len(b) // 8 for b in blobs], pa.int64()),
                 pa.array(blobs, pa.binary())], ["vec_id", "dims", "vec"])
    return run


def threshold_search(ids, v, query_ids, q, k):
    """Exact k best rows of one stripe for every query: (query row, row, score).

    ``ids`` ascend, so of equal scores the smaller row number wins."""
    m, dims = v.shape
    widest = float(np.abs(v).max(initial=0)) * float(np.abs(q).max(initial=0)) * dims
    kind = np.float64 if widest < 2.0 ** 53 else np.int64  # both exact
    v, q = v.astype(kind), q.astype(kind)
    order = np.argsort(v, axis=0, kind="stable")
    lists = np.take_along_axis(v, order, axis=0)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    low = -_LIMIT  # can be negated
    best = np.full((len(q), k), low, np.int64)
    rows = np.full((len(q), k), m, np.int64)
    active = np.arange(len(q))
    seen = np.zeros(m, bool)
    depth = FIRST_DEPTH
    while len(active):
        depth = min(depth, m)
        new = np.zeros(m, bool)
        new[order[m - depth:, (up[active] > 0).any(axis=0)]] = True
        new[order[:depth, (down[active] < 0).any(axis=0)]] = True
        if depth == m:
            new[:] = True  # all-zero queries read no list
        fresh = np.flatnonzero(new & ~seen)
        seen |= new
        if len(fresh):
            score = (q[active] @ v[fresh].T).astype(np.int64)
            own = query_ids[active][:, None] == ids[fresh][None, :]
            score[own] = low
            both = np.concatenate([best[active], score], axis=1)
            at = np.concatenate([rows[active], np.broadcast_to(fresh, score.shape)], axis=1)
            if both.shape[1] > 4 * k:  # all scores that reach the k-th, ties included
                kth = -np.partition(-both, k - 1, axis=1)[:, k - 1:k]
                width = int((both >= kth).sum(axis=1).max())
                pick = np.argsort(both < kth, axis=1, kind="stable")[:, :max(width, k)]
                both, at = np.take_along_axis(both, pick, 1), np.take_along_axis(at, pick, 1)
            sort = np.lexsort((at, -both), axis=1)[:, :k]
            best[active] = np.take_along_axis(both, sort, 1)
            rows[active] = np.take_along_axis(at, sort, 1)
        if depth == m:
            break
        bound = up[active] @ lists[m - depth] + down[active] @ lists[depth - 1]
        active = active[best[active, k - 1] <= bound]
        depth *= 4
    some = (rows < m) & (best > low)
    at = np.nonzero(some)
    return at[0], rows[some], best[some]


def _search(k):
    def run(key, rows):
        dims = key[2].as_py()
        asked = rows.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        ids = rows.column("vec_id").to_numpy()
        v = np.frombuffer(b"".join(rows.column("vec").to_pylist()), np.int64).reshape(len(ids), dims)
        if asked.all() or not asked.any():
            q_at, r_at, score, qid, vid = [np.zeros(0, np.int64)] * 3 + [ids[:0]] * 2
        else:
            by_id = np.argsort(ids[~asked], kind="stable")
            vid, qid = ids[~asked][by_id], ids[asked]
            q_at, r_at, score = threshold_search(vid, v[~asked][by_id], qid, v[asked], k)
        return pa.table({"query_id": pa.array(qid[q_at], pa.int64()), "vec_id": pa.array(vid[r_at], pa.int64()),
                         "score": pa.array(score, pa.int64())})
    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 64.0,
                id_col: str = "vec_id", vec_col: str = "embedding",
                stripe: int = STRIPE, block: int = BLOCK) -> DataFrame:
    """The ``k`` rows of largest integer inner product for every query:
    query_id, rank (from 1), vec_id, score; ties go to the smaller id.

    Components become floor(scale * x).  Rows whose id or vector is NULL, or
    whose vector is empty or holds NULL or non-finite components, take no
    part; a query meets only vectors of its own length and not the rows that
    share its id.  Repeated candidate rows rank one after the other, repeated
    queries are one query.  Fewer than ``k`` candidates give all of them.
    Other columns are ignored."""
    def packed(df):
        return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
                .mapInArrow(_quantise(scale), "vec_id long, dims long, vec binary"))
    data, asked = packed(vectors), packed(queries).dropDuplicates(["vec_id", "dims", "vec"])
    n = vectors.select(id_col).count()
    stripes = max(1, -(-n // stripe))
    blocks = max(1, -(-queries.select(id_col).count() // block))
    # Stripe x block tiles: rows are copied to every block, queries to every stripe.
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n: F.pmod(F.xxhash64(F.lit("ta"), "vec_id", "vec"), F.lit(n)).cast("int")
    tiles = (data.withColumn("s", place(stripes)).withColumn("b", spread(blocks)).withColumn("asked", F.lit(0))
             .unionByName(asked.withColumn("b", place(blocks)).withColumn("s", spread(stripes))
                          .withColumn("asked", F.lit(1))))
    part = tiles.groupBy("s", "b", "dims").applyInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


OP2_SQL = """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@register("op2_topk", OP2_SQL)
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)

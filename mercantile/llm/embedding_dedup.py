"""Embedding near-dedup: random-hyperplane signs in several tables, exact
cosine verification, distributed connected components.

Every vector is hashed in each table to the signs of a few random hyperplanes.
Vectors of one label that fall into one bucket of some table are compared
exactly.  A pair that meets in several tables counts in the first one only, so
link counts are exact for the pairs found; pairs never leave a task.  Buckets
beyond ``TILE`` vectors are cut into parts that meet part by part, and equal
vectors are one class, so neither hot buckets nor copies reach one task whole.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, register, table
from .components import attach, connected_components

#: Vectors of a bucket that are compared at once.
TILE = 1024
#: Expected vectors in a bucket of the largest label; sets the bits by size.
BUCKET = 96


def plan_tables(largest: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, tables): bits grow with the logarithm of the largest label; enough
    tables for a pair just at the threshold to meet with chance ``recall``."""
    bits = max(3, ceil(log2(max(largest, 2) / BUCKET))) if largest > BUCKET else 3
    meet = (1 - acos(min(threshold, 1.0)) / pi) ** bits
    return bits, max(1, ceil(log(1 - recall) / log(1 - meet)) if meet < 1 else 1)


def _valid(vec, label):
    value = lambda x: x.cast("double")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(value(x))
                      & (F.abs(value(x)) < F.lit(float("inf"))))
    some = F.exists(vec, lambda x: value(x) != 0)
    return F.col(label).isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(finite & some, F.lit(False))


def _hash(bits, tables, seed):
    def planes(dims):
        return np.random.default_rng([seed, dims]).standard_normal((dims, bits * tables))

    def run(batches):
        kept: dict[int, np.ndarray] = {}
        power = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            size = batch.column("dims").to_numpy(zero_copy_only=False)
            for dims in np.unique(size):
                rows = batch.filter(pa.array(size == dims))
                flat = rows.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = flat.reshape(len(rows), dims)
                x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps norms finite
                if int(dims) not in kept:
                    kept[int(dims)] = planes(int(dims))
                sign = (x @ kept[int(dims)] >= 0).reshape(len(rows), tables, bits)
                bucket = (sign * power).sum(axis=2)
                unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                blob = pa.array([r.tobytes() for r in unit], pa.binary())
                sigs = pa.array(list(bucket), pa.list_(pa.int64()))
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("cls"), rows.column("label"), rows.column("dims"),
                         pa.array(np.full(len(rows), t)), pa.array(bucket[:, t]),
                         rows.column("copies"), sigs, blob],
                        ["cls", "label", "dims", "tab", "bucket", "copies", "sigs", "unit"])
    return run


def _verify(threshold):
    def run(key, rows):
        cls = rows.column("cls").to_numpy()
        side = rows.column("side").to_numpy()
        copies = rows.column("copies").to_numpy()
        dims, tab = key[1].as_py(), key[2].as_py()
        x = np.frombuffer(b"".join(rows.column("unit").to_pylist()), np.float64).reshape(len(cls), dims)
        sigs = np.array(rows.column("sigs").to_pylist(), np.int64)
        near = np.triu(x @ x.T >= threshold, 1)
        if not rows.column("diagonal")[0].as_py():  # only across the parts, also where one is empty
            near &= side[:, None] != side[None, :]
        i, j = np.nonzero(near)
        if tab:  # counted where they first meet
            new = np.ones(len(i), bool)
            for at in range(0, len(i), 200_000):
                p = slice(at, at + 200_000)
                new[p] = ~(sigs[i[p], :tab] == sigs[j[p], :tab]).any(axis=1)
            i, j = i[new], j[new]
        links = np.zeros(len(cls), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = np.arange(len(cls))
        while len(i):
            low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
            open_ = low != high
            if not open_.any():
                break
            i, j = i[open_], j[open_]
            np.minimum.at(root, high[open_], low[open_])
            while not (root[root] == root).all():
                root = root[root]
        some = links > 0
        return pa.table({"cls": cls[some], "links": links[some], "root": cls[root][some]})
    return run


def embedding_near_dedup(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.999, seed: int = 7,
                         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Link vectors of equal label whose cosine is at least ``threshold``.

    Returns one row per input row: vec_id, n_links, component_id, kept.
    Vectors that are NULL, empty, zero or hold NULL or non-finite components,
    and rows without a label, link with nothing; vectors of different length
    never link; repeated rows link with each other; a NULL id counts as a link
    and is a component's id only where no other is.  ``recall`` is the chance
    that a pair just at the threshold is found; nearer pairs are surer.  Other
    columns are ignored."""
    vec = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"),
                          F.col(label_col).alias("label"))
    rows = rows.withColumn("ok", _valid(vec, "label"))
    rows = rows.withColumn("cls", F.when(F.col("ok"), F.xxhash64("label", "vec")))
    classes = materialise(
        rows.where("ok").groupBy("cls").agg(F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
                                            F.first("vec").alias("vec"))
        .withColumn("label", F.xxhash64("label")).withColumn("dims", F.size("vec").cast("long")), "vector-classes")
    largest = classes.groupBy("label", "dims").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(largest, threshold, recall)
    key = ["label", "dims", "tab", "bucket"]
    hashed = classes.mapInArrow(
        _hash(bits, tables, seed),
        "cls long, label long, dims long, tab long, bucket long, copies long, sigs array<long>, unit binary")
    hot = (hashed.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > TILE)
           .select(*key, F.ceil(F.col("m") / TILE).cast("int").alias("parts")))
    hot = materialise(hot, "hot-buckets")
    dealt = (hashed.join(hot, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
             .withColumn("part", F.pmod(F.xxhash64(F.lit("tile"), "cls"), F.col("parts")).cast("int")))
    tiles = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
             .withColumn("side", (F.col("part") > F.col("other")).cast("long"))
             .withColumn("diagonal", F.col("part") == F.col("other")))
    found = materialise(
        tiles.select(F.xxhash64(*key, "i", "j").alias("tile"), "dims", "tab", "side", "diagonal", "cls", "copies", "sigs", "unit")
        .groupBy("tile", "dims", "tab").applyInArrow(_verify(threshold), "cls long, links long, root long"), "vector-links")
    roots = connected_components(found.select(F.col("cls").alias("u"), F.col("root").alias("v")), "vector-components")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    merged = materialise(
        classes.select("cls", "copies").join(counts, "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("root", "cls").alias("component"), F.col("copies").alias("c")), "vector-results")
    known = materialise(attach(rows.where("ok").select("vec_id", "cls"), merged, "cls"), "vectors-joined")
    least = materialise(known.groupBy("component").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("c")),
                        "least-vectors")
    none = rows.where(~F.col("ok")).select("vec_id", F.lit(0).alias("n_links"), F.lit(None).cast("long").alias("least"))
    out = (attach(known, least, "component").select("vec_id", "n_links", "least").unionAll(none)
           .select("vec_id", F.col("n_links").cast("long").alias("n_links"),
                   F.coalesce("least", "vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


OP10_SQL = r"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, 
                    list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
g AS (SELECT r, vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
      WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)
        AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.r AS u, b.r AS v FROM g a JOIN g b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
          WHERE list_dot_product(a.e, b.e) >= 0.93 * a.norm * b.norm),
reach AS (SELECT r AS u, r AS v FROM g UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
root AS (SELECT reach.u AS r, min(g.vec_id) AS component FROM reach JOIN g ON reach.v = g.r GROUP BY reach.u),
n AS (SELECT u AS r, count(*) AS n_links FROM links GROUP BY u)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, coalesce(root.component, v.vec_id) AS component_id,
       v.vec_id IS NOT DISTINCT FROM coalesce(root.component, v.vec_id) AS kept
FROM v LEFT JOIN n ON v.r = n.r LEFT JOIN root ON v.r = root.r
"""


@register("op10_embedding_dedup", OP10_SQL)
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"))

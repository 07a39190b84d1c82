"""Distributed connected components: alternating large-star / small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


#: Edges that one task contracts; bounds its memory.
EDGES = 250_000
#: A node of more than one in so many edges is hot.
HOT = 1_000


def _contract(batches):
    """Forest of a partition's edges: same components, fewer rows."""
    import numpy as np
    import pyarrow as pa
    held = list(batches)
    if not held:
        return
    rows = pa.Table.from_batches(held)
    u, v = (rows.column(i).to_numpy() for i in (0, 1))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        if not open_.any():
            break
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    keep = root != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(nodes[root[keep]])], ["u", "v"])


def attach(rows: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Inner join of rows with a written table of one row per key, whose column
    ``c`` counts the rows of the key.  Keys of more than one in ``HOT`` rows,
    fewer than ``HOT`` of them, are broadcast; the rows of the others are
    shuffled, so no key fills a task."""
    values = [c for c in small.columns if c not in (key, "c")]
    most = (small.agg(F.sum("c")).first()[0] or 0) // HOT
    hot = F.broadcast(small.where((F.col("c") > most) & F.lit(most > 0)).select(F.col(key).alias("_hot"), *values))
    apart = rows.join(hot, rows[key] == hot["_hot"]).select(*rows.columns, *values)
    rest = rows.join(hot.select("_hot"), rows[key] == F.col("_hot"), "left_anti")
    return apart.unionAll(rest.join(small.drop("c"), key).select(*rows.columns, *values))


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable node of every node that has an edge: (node, root).

    ``edges`` has long columns u, v.  Each round is two aggregations with
    map-side combine and two joins that take hot nodes apart (:func:`attach`);
    rounds grow with the logarithm of the longest chain.  Every round is written
    to the shared scratch folder and goes after the next.  Before the first,
    tasks contract about ``EDGES`` edges each to forests."""
    every = materialise(edges.select("u", "v").where("u <> v").distinct(), name)
    e = every.repartition(max(1, -(-every.count() // EDGES))).mapInArrow(_contract, "u long, v long")
    e = materialise(e, name)
    discard(every)
    before = None
    while True:
        # Large star: every larger neighbour of u hangs on the least neighbour of u (or u).
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"),
                                                  F.count(F.lit(1)).alias("c")), name)
        big = materialise(attach(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .where("u <> v").distinct(), name)
        discard(e, least)
        # Small star: u and its smaller neighbours hang on the least of them (edges point down now).
        least = materialise(big.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c")), name)
        moved = attach(big, least, "u")
        small = (moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = materialise(small, name)
        discard(big, least)
        # Order-free state of the edge set: unchanged means every node hangs on its root.
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

"""N-gram Jaccard self join, size-aware: subsets for small sets, lists for large.

For sets of sizes a and b a Jaccard similarity of p percent needs an overlap of
at least o(a, b) = ceil(p (a + b) / (100 + p)).

* Small sets enumerate their subsets of the fixed size o(a, b) for every
  partner size b; two small sets are similar exactly when they share a subset
  key.  The size boundary is the largest one at which the subset keys of every
  small set cost no more than its lists.
* Large sets go into inverted lists.  A list on a single shingle would hold
  every document of a shared passage, so the lists are keyed by blocks of the
  shingle space: similar sets of a size class differ in at most k shingles, so
  of k + 1 + s blocks cut by hash at least s + 1 agree.  A key is (class,
  block, content of the block).  A pair needs s + 1 common lists, less the
  blocks that may be empty in both.  Empty blocks are in no list: the list of
  an empty block would connect unrelated sets.  A set with more empty blocks
  than there are to spare is cut once more, by another hash; of two sets that
  end at different cuts the earlier end has the lists for both.
* Lists are scanned pair by pair up to ``LONG_LIST`` entries.  Longer lists
  (popular passages, large groups of near copies) are left out where that loses
  nothing: a set with h long lists still shares s + 1 - h others with every
  similar set.  Only sets with more long lists than that are connected through
  the long lists themselves, each to the least set of the list.

Sets connected by enough common lists form families; families are verified
exactly, in tiles of bounded size, by counting overlaps; links become
connected components.  Equal sets are one class throughout, however many
copies there are.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, register, table
from .components import attach, connected_components
from .shingles import U, mix, shingle_sets, word_hashes
from .wordseq import (PACKET, PACKET_SCHEMA, PLACES_SCHEMA, bucket_keys, distinct_keys, keys_at_places, seen_packets,
                      shared_places, unpack, write_slices)

#: A list key also costs the scan of its list; one subset key counts 1.
LIST_COST = 4
#: Shingles and sets of one tile: bounds a task's memory.
TILE_SHINGLES = 400_000
TILE_SETS = 1_000
#: Entries of a list up to which its pairs are scanned.
LONG_LIST = 64
#: Cuts of the shingle space a set may go through.
CUTS = 8


def overlap_needed(a: int, b: int, percent: int) -> int:
    return -(-percent * (a + b) // (100 + percent))


def size_class(n: int) -> int:
    """Classes [1, 2), [2, 3), [3, 4), [4, 6), [6, 9), ... growing by half."""
    return _classes(max(n, 1))[0]


@lru_cache(maxsize=None)
def _bounds() -> list[int]:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return out


@lru_cache(maxsize=65536)
def _classes(n: int) -> tuple[int, int]:
    b = _bounds()
    j = int(np.searchsorted(b, n, "right")) - 1
    return j, b[j + 1] - 1


@lru_cache(maxsize=4096)
def blocks_of_class(j: int, percent: int) -> tuple[int, int, int]:
    """(number of blocks, how many of them may be empty in a set, number of
    cuts).  The smallest set of a class seldom has more empty blocks than there
    are to spare; where only its shingles are too few for that, one cut has to do."""
    most = _bounds()[j + 1] - 1
    least = max(1, -(-_bounds()[j] * percent // 100))
    differ = 2 * most * (100 - percent) // (100 + percent)
    spare = 3 + differ // 8
    while spare <= 3 + differ:
        blocks = differ + 1 + spare
        full = least / blocks
        empty, var = blocks * exp(-full), blocks * (exp(-full) - (1 + full) * exp(-2 * full))
        if empty + 2 * var ** 0.5 <= spare:
            return blocks, spare, CUTS
        spare += max(1, spare // 16)
    spare = 3 + differ // 8
    return differ + 1 + spare, spare, 1


@lru_cache(maxsize=65536)
def subset_plan(n: int, percent: int, top: int) -> tuple[tuple[int, int, int], ...]:
    """(partner size, subset size, left out) for partners of at most ``top``."""
    least, most = -(-percent * n // 100), min(top, n * 100 // percent)
    plan = []
    for t in range(max(least, 1), most + 1):
        o = overlap_needed(n, t, percent)
        if o <= min(n, t):
            plan.append((t, o, n - o))
    return tuple(plan)


@lru_cache(maxsize=64)
def boundary(percent: int) -> int:
    """Largest size up to which subsets cost no more than lists."""
    n = 0
    while n < 200:
        plan = subset_plan(n + 1, percent, 1 << 30)
        if any(left > 2 for _, _, left in plan):
            break
        subsets = sum(comb(n + 1, left) for _, _, left in plan)
        if subsets > LIST_COST * blocks_of_class(size_class(n + 1), percent)[0]:
            break
        n += 1
    return n


def subset_keys(parts: np.ndarray, percent: int, top: int) -> np.ndarray:
    """Keys of the fixed-size subsets of one set; ``parts`` are its mixed
    hashes, a subset is the sum of the parts it keeps."""
    n, total = len(parts), parts.sum(dtype=U)
    keys = []
    for t, o, left in subset_plan(n, percent, top):
        if left == 0:
            sums = np.array([total], U)
        elif left == 1:
            sums = total - parts
        else:
            i, j = np.triu_indices(n, 1)
            sums = total - parts[i] - parts[j]
        tag = U((min(n, t) << 40) | (max(n, t) << 20) | o)
        keys.append(mix(sums ^ mix(np.full(1, tag, U))))
    return np.concatenate(keys) if keys else np.zeros(0, U)


def block_keys(hashes: np.ndarray, sizes: np.ndarray, percent: int, top: int) -> tuple[np.ndarray, ...]:
    """(key, set number, class and cut, common lists needed) of the inverted
    lists every set belongs to: its own class and every larger one that a
    similar set may be in (above 66 percent at most the next one).  A set that
    goes on to the next cut needs no list of this one, so 0 or less."""
    parts = []
    where = np.repeat(np.arange(len(sizes)), sizes)
    content = mix(hashes + U(0x5851F42D4C957F2D))
    least = np.array([_classes(int(n))[0] if n else -1 for n in sizes])
    most = np.array([_classes(int(n))[0] if n else -1 for n in sizes * 100 // percent])
    listed = (sizes > 0) & (sizes * 100 // percent > top)
    for step in range(int((most - least).max()) + 1 if len(sizes) else 0):
        cls = least + step
        use = listed & (cls <= most)
        shape = {int(c): blocks_of_class(int(c), percent) for c in np.unique(cls[use])}
        cut = 0
        while use.any():
            blocks, spare, cuts = (np.array([shape[int(c)][i] if u else 0 for c, u in zip(cls, use, strict=True)])
                                   for i in range(3))
            base = np.cumsum(blocks) - blocks
            mine = use[where]
            w = where[mine]
            dealt = mix(content[mine] ^ U(cut)) if cut else content[mine]
            slot = (dealt >> U(20)) % blocks[w].astype(U)
            at = base[w] + slot.astype(np.int64)
            sums = np.zeros(int(blocks.sum()), U)
            np.add.at(sums, at, content[mine])
            filled = np.zeros(len(sums), bool)
            filled[at] = True
            owner = np.repeat(np.arange(len(sizes)), blocks)
            nth = np.arange(len(sums)) - base[owner]
            empty = np.bincount(owner[~filled], minlength=len(sizes))
            poor = use & (empty > spare)
            # At its last cut a set with too many empty blocks lists them too.
            lists_all = poor & (cut + 1 >= cuts)
            show = filled | lists_all[owner]
            tag = mix((cls[owner].astype(U) << U(32)) ^ nth.astype(U) ^ U((0xB10C << 48) ^ (cut << 40)))
            need = np.where(lists_all, 1, spare + 1 - empty)
            parts.append((mix(sums ^ tag)[show], owner[show], (cls[owner] | cut << 16)[show], need[owner][show]))
            use, cut = poor & ~lists_all, cut + 1
    if not parts:
        return np.zeros(0, U), *[np.zeros(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _sets(row, width):
    """(hashes, sizes, set fingerprints) of the documents of a slice."""
    data, offsets = unpack(row)
    hashes, sizes = shingle_sets(*word_hashes(data, offsets), width)
    ends = np.cumsum(sizes)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(hashes))])
    return hashes, sizes, mix(sums[ends] - sums[ends - sizes] + sizes.astype(U)).view(np.int64)


def _keys(hashes, sizes, percent):
    """(key, set number, class and cut, common lists needed); subset keys are
    class -1 and one of them is enough."""
    top = boundary(percent)
    keys, sets, cls, need = block_keys(hashes, sizes, percent, top)
    ends = np.cumsum(sizes)
    small = np.flatnonzero((sizes > 0) & (sizes <= top))
    if len(small):
        parts = [subset_keys(mix(hashes[ends[i] - sizes[i]:ends[i]] + U(0x5851F42D4C957F2D)), percent, top)
                 for i in small]
        count = [len(p) for p in parts]
        keys = np.concatenate([keys, *parts])
        sets = np.concatenate([sets, np.repeat(small, count)])
        cls = np.concatenate([cls, np.full(sum(count), -1)])
        need = np.concatenate([need, np.ones(sum(count), np.int64)])
    return keys, sets, cls, need


def _slice_keys(row, width, percent):
    """The keys of a slice's different sets: (key, fingerprint, size, class,
    common lists needed).  Copies within a slice list theirs once."""
    hashes, sizes, prints = _sets(row, width)
    _, once = np.unique(prints, return_index=True)
    keep = np.zeros(len(sizes), bool)
    keep[once] = True
    hashes, prints, sizes = hashes[np.repeat(keep, sizes)], prints[keep], sizes[keep]
    keys, sets, cls, need = _keys(hashes, sizes, percent)
    return keys, prints[sets], sizes[sets], cls, need


def _probe_keys(width, percent, buckets):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = bucket_keys(_slice_keys(row, width, percent)[0], buckets)
                yield pa.RecordBatch.from_pylist(list(seen_packets(row["slice"], keys, buckets)), PACKET)
    return run


LISTED = pa.schema([("key", pa.int64()), ("print", pa.int64()), ("n", pa.int64()), ("cls", pa.int32()), ("need", pa.int32())])
LISTED_SCHEMA = "key long, print long, n long, cls int, need int"


def _emit_keys(width, percent, buckets):
    """The keys of a slice that any other set may hold too."""
    def run(key, texts, answers):
        if not len(texts) or not len(answers):
            return pa.Table.from_pylist([], LISTED)
        found = _slice_keys(texts.to_pylist()[0], width, percent)
        short = bucket_keys(found[0], buckets)
        values, _, cut = distinct_keys(short, buckets)
        shared = keys_at_places(values, cut, answers)
        keep = shared[np.minimum(np.searchsorted(shared, short), len(shared) - 1)] == short
        keys, prints, sizes, cls, need = (x[keep] for x in found)
        return pa.Table.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(prints), pa.array(sizes.astype(np.int64)),
             pa.array(cls.astype(np.int32)), pa.array(need.astype(np.int32))], LISTED.names)
    return run


def _emit_prints(width):
    """Rows (slice, place in it, doc_id, n, print)."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, sizes, prints = _sets(row, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sizes), row["slice"])), pa.array(np.arange(len(sizes))),
                     pa.array(row["ids"], pa.int64()), pa.array(sizes.astype(np.int64)), pa.array(prints)],
                    ["slice", "nth", "doc_id", "n", "print"])
    return run


SETS_SCHEMA = "tile long, side long, diagonal boolean, copies long, n long, print long, hashes binary"


def _emit_sets(width):
    """The sets of the documents asked for, one row per tile."""
    def run(key, texts, asked):
        out = {c: asked.column(c) for c in ("tile", "side", "diagonal", "copies")}
        nth = asked.column("nth").to_numpy()
        if len(nth):
            hashes, sizes, prints = _sets(texts.to_pylist()[0], width)
            ends = np.cumsum(sizes)
            held = {i: hashes[ends[i] - sizes[i]:ends[i]].tobytes() for i in np.unique(nth)}
        else:
            sizes, prints, held = np.zeros(0, np.int64), np.zeros(0, np.int64), {}
        return pa.table(out | {"n": pa.array(sizes[nth].astype(np.int64)), "print": pa.array(prints[nth]),
                               "hashes": pa.array([held[i] for i in nth], pa.binary())})
    return run


def _pairs(percent, longest):
    """Pairs of sets in lists that come sorted by key, with the lists they
    share in a class and the lists they need; a pair that needs none has its
    lists at another cut.  A list has at most ``longest`` entries; only the
    last one of a batch waits for the next batch."""
    def pairs(rows):
        key, print_, n, cls, need = (rows.column(i).to_numpy() for i in range(5))
        found = []
        for d in range(1, longest):
            i = np.flatnonzero(key[:-d] == key[d:])
            if not len(i):
                break
            j = i + d
            fit = (np.minimum(n[i], n[j]) * 100 >= percent * np.maximum(n[i], n[j])) & (np.maximum(need[i], need[j]) > 0)
            i, j = i[fit], j[fit]
            low, high = np.minimum(print_[i], print_[j]), np.maximum(print_[i], print_[j])
            found.append((low, high, cls[i], np.maximum(need[i], need[j])))
        if not found:
            return
        a, b, c, need = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((c, b, a))
        a, b, c, need = a[order], b[order], c[order], need[order]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])]) if len(a) else a
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[first]), pa.array(b[first]), pa.array(c[first].astype(np.int32)),
             pa.array(need[first].astype(np.int32)), pa.array(np.diff(np.r_[first, len(a)]))],
            ["u", "v", "cls", "need", "lists"])

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            key = rows.column(0).to_numpy()
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            yield from pairs(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks()
        if held is not None:
            yield from pairs(held)
    return run


def _count_links(prints, sizes, hashes, side, copies, diagonal, percent):
    """Exact links inside a tile: (link counts, forest edges).  Off the diagonal
    a pair counts only across the sides, also where a side is empty."""
    m = len(prints)
    order = np.argsort(sizes, kind="stable")
    prints, sizes, side, copies = prints[order], sizes[order], side[order], copies[order]
    flat = np.concatenate([hashes[i] for i in order])
    owner = np.repeat(np.arange(m), sizes)
    values, at = np.unique(flat, return_inverse=True)
    often = np.bincount(at, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    keep = often[at]
    owner, at = owner[keep], column[at[keep]]
    width = int(often.sum())
    shared = np.zeros((m, m), np.float32)
    by_column = np.argsort(at, kind="stable")
    owner, at = owner[by_column], at[by_column]
    for lo in range(0, width, 4096):
        a, b = np.searchsorted(at, [lo, lo + 4096])
        ones = np.zeros((m, 4096), np.float32)
        ones[owner[a:b], at[a:b] - lo] = 1
        shared += ones @ ones.T
    both = sizes[:, None] + sizes[None, :]
    linked = (100 + percent) * shared.astype(np.int64) >= percent * both
    np.fill_diagonal(linked, False)
    if not diagonal:
        linked &= side[:, None] != side[None, :]
    links = linked.astype(np.int64) @ copies
    root = np.arange(m)
    i, j = np.nonzero(np.triu(linked))
    while len(i):
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        open_ = low != high
        if not open_.any():
            break
        i, j = i[open_], j[open_]
        np.minimum.at(root, high[open_], low[open_])
        while not (root[root] == root).all():
            root = root[root]
    return prints, links, prints[root]


def _tile(percent):
    def run(key, frame):
        import pandas as pd
        side, diagonal = frame["side"].to_numpy(np.int64), bool(frame["diagonal"].iloc[0])
        if not diagonal and (side == side[0]).all():  # the other part is empty
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("print", "links", "root")})
        hashes = [np.frombuffer(h, U) for h in frame["hashes"]]
        prints, links, roots = _count_links(
            frame["print"].to_numpy(np.int64), frame["n"].to_numpy(np.int64), hashes,
            side, frame["copies"].to_numpy(np.int64), diagonal, percent)
        some = links > 0
        return pd.DataFrame({"print": prints[some], "links": links[some], "root": roots[some]})
    return run


def ngram_jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Link documents whose sets of distinct ``words``-word shingles have a
    Jaccard similarity of at least ``percent`` / 100.

    Returns one row per input row: doc_id, n_shingles, n_links (other rows
    linked directly, copies included), component_id (smallest id reachable),
    set_print.  NULL or empty text has no set and no link and keeps its own
    id; fewer words than ``words`` are one shingle; equal sets always link;
    NULL ids count as links but never as a component's id unless no other is
    there; repeated rows are rows of their own; a text of any length is one
    set, held whole by a task.  Other columns are ignored."""
    slices, buckets = write_slices(docs, id_col, text_col, "join-slices")
    by_slice = slices.groupBy("slice")
    # Most keys belong to one set only and never leave their slice; the others
    # are found by short packets (a false meeting costs a row, no more).
    answers = (slices.mapInArrow(_probe_keys(words, percent, buckets), PACKET_SCHEMA)
               .groupBy("bucket").applyInArrow(shared_places, PLACES_SCHEMA))
    # Dealt by key and set, so that no key is hot.
    emitted = materialise(by_slice.cogroup(answers.groupBy("slice"))
                          .applyInArrow(_emit_keys(words, percent, buckets), LISTED_SCHEMA)
                          .dropDuplicates(["key", "print"]), "emitted-keys")
    # A key that two different sets share; its hub is the least of them.
    shared = materialise(
        emitted.groupBy("key").agg(F.min("print").alias("hub"), F.max("print").alias("far"), F.count(F.lit(1)).alias("m"))
        .where("hub <> far").select("key", "hub", (F.col("m") > LONG_LIST).alias("long")), "shared-keys")
    keyed = materialise(emitted.join(shared, "key"), "listed-keys")
    discard(emitted, shared)
    # Common lists that remain when the long ones are left out; none is certain for a hard set.
    long_of = (keyed.groupBy("print", "cls").agg(F.count(F.when(F.col("long"), 1)).alias("h"),
                                                  F.min("need").alias("base"))
               .select("print", "cls", "base", (F.col("base") - F.col("h")).cast("int").alias("left")))
    listed = keyed.join(long_of, ["print", "cls"])
    light = listed.where(~F.col("long")).select("key", "print", "n", "cls",
                                                F.when(F.col("base") > 0, F.greatest("left", F.lit(1)))
                                                .otherwise(0).cast("int").alias("need"))
    pairs = (light.repartition("key").sortWithinPartitions("key").mapInArrow(_pairs(percent, LONG_LIST),
                                                 "u long, v long, cls int, need int, lists long")
             .groupBy("u", "v", "cls").agg(F.sum("lists").alias("lists"), F.max("need").alias("need"))
             .where("lists >= need").select("u", "v"))
    hard = listed.where(F.col("long") & (F.col("left") <= 0))
    # A long list hangs on its member of the most long lists: the lists of a
    # group then share that hub, and a set gets few edges.
    weight = hard.groupBy("print").agg(F.count(F.lit(1)).alias("w"))
    hubs = (hard.select("key", "print").join(weight, "print").groupBy("key")
            .agg(F.max(F.struct("w", "print"))["print"].alias("v")))
    edges = pairs.unionAll(hard.join(hubs, "key").select(F.col("print").alias("u"), "v").distinct())

    # Families: sets connected by enough common lists.
    family = materialise(connected_components(edges, "families"), "family-of")
    discard(keyed)
    rows = materialise(slices.mapInArrow(_emit_prints(words), "slice long, nth long, doc_id long, n long, print long"),
                       "shingle-sets")
    classes = materialise(
        rows.where("n > 0").groupBy("print")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.min(F.struct("slice", "nth")).alias("at")),
        "set-classes")
    # Sets of families are dealt to parts; parts and families are written, so
    # that the join may split a hot family.
    placed = materialise(family.join(classes, family["node"] == classes["print"])
                         .select(F.col("root").alias("family"), "print", "n", "copies", "at"), "family-sets")
    parts = materialise(
        placed.groupBy("family").agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("m"))
        .select("family", F.greatest(F.ceil(F.col("s") / TILE_SHINGLES), F.ceil(F.col("m") / TILE_SETS))
                .cast("int").alias("parts")), "family-parts")
    dealt = (placed.join(parts, "family")
             .withColumn("part", F.pmod(F.xxhash64(F.lit("tile"), "print"), F.col("parts")).cast("int")))
    # A part meets every part of its family once: tile (i, j) with i <= j.  One
    # key for a tile: else Spark would keep the rows dealt by family.
    asked = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("at.slice", "at.nth", "copies",
                     F.xxhash64("family", F.least("part", "other"), F.greatest("part", "other")).alias("tile"),
                     (F.col("part") > F.col("other")).cast("long").alias("side"),
                     (F.col("part") == F.col("other")).alias("diagonal")))
    # The shingles travel once, from one document of every set to its tiles.
    tiles = by_slice.cogroup(asked.groupBy("slice")).applyInArrow(_emit_sets(words), SETS_SCHEMA)
    links = materialise(tiles.groupBy("tile").applyInPandas(
        _tile(percent), "print long, links long, root long"), "links")
    discard(slices, family, placed, parts)
    roots = connected_components(links.select(F.col("print").alias("u"), F.col("root").alias("v")), "near-copies")
    counts = links.groupBy("print").agg(F.sum("links").alias("links"))
    merged = materialise(
        classes.select("print", "copies").join(counts, "print", "left")
        .join(roots.withColumnRenamed("node", "print"), "print", "left")
        .select("print", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                F.coalesce("root", "print").alias("component"), F.col("copies").alias("c")), "set-results")
    discard(links, classes)
    known = materialise(attach(rows.where("n > 0").select("doc_id", "n", "print"), merged, "print"), "joined")
    least = materialise(known.groupBy("component").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("c")), "least-ids")
    none = rows.where("n = 0").select("doc_id", "n", F.lit(0).cast("long").alias("links"),
                                      F.lit(None).cast("long").alias("least"), "print")
    return (attach(known, least, "component").select("doc_id", "n", "links", "least", "print").unionAll(none)
            .select("doc_id", F.col("n").alias("n_shingles"), F.col("links").cast("long").alias("n_links"),
                    F.coalesce("least", "doc_id").alias("component_id"), F.col("print").alias("set_print")))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
t AS (SELECT r, len(ws) AS n, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM d),
g AS (SELECT r, n, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM t WINDOW o AS (PARTITION BY r ORDER BY i)),
h AS (SELECT r, list_sort(list(DISTINCT concat_ws(' ', w, w2, w3))) AS shingles FROM g WHERE i <= greatest(n - 3, 0) GROUP BY r),
s AS (SELECT d.r, doc_id, coalesce(shingles, []) AS shingles FROM d LEFT JOIN h ON d.r = h.r),
c AS (SELECT shingles, len(shingles) AS n, min(r) AS c FROM s WHERE len(shingles) > 0 GROUP BY shingles),
x AS (SELECT c, n, unnest(shingles) AS shingle FROM c),
pairs AS (SELECT a.c AS u, b.c AS v FROM x a JOIN x b ON a.shingle = b.shingle AND a.c < b.c
            AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
          GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach AS (SELECT c AS u, c AS v FROM c
          UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
member AS (SELECT s.r, s.doc_id, s.shingles, c.c FROM s LEFT JOIN c ON s.shingles = c.shingles),
least_of AS (SELECT c, min(doc_id) AS least, count(*) AS copies FROM member WHERE c IS NOT NULL GROUP BY c),
root AS (SELECT reach.u AS c, min(least_of.least) AS component FROM reach JOIN least_of ON reach.v = least_of.c
         GROUP BY reach.u),
near AS (SELECT links.u AS c, sum(least_of.copies) AS others FROM links JOIN least_of ON links.v = least_of.c GROUP BY links.u)
SELECT m.doc_id, CAST(len(m.shingles) AS BIGINT) AS n_shingles, coalesce(root.component, m.doc_id) AS component_id,
       CAST(coalesce(l.copies - 1, 0) + coalesce(near.others, 0) AS BIGINT) AS n_links
FROM member m LEFT JOIN root ON m.c = root.c LEFT JOIN near ON m.c = near.c LEFT JOIN least_of l ON m.c = l.c
"""


@register("op3_ngram_join", OP3_SQL)
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_jaccard_join(table(spark, sf_dir, "documents"), words=3, percent=90)
    return out.select("doc_id", "n_shingles", "component_id", "n_links")

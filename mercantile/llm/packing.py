"""Best-fit packing by hierarchical residual packing.

Documents are cut into pieces of at most ``capacity`` tokens.  Each partition
packs its pieces best-fit decreasing and emits bins that are nearly full; the
underfull bins become items of the next round, where fewer partitions pack
them again, up a tree, until a round no longer saves bins or one small
partition is left.  Rounds are written tables of bins, a bin carries its
members (at most ``capacity``), and the number of partitions follows the bins
left, so no task ever holds more than about ``PER_TASK`` items.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, register, table
from .tokens import BPE_FILE, RANK_FILE, encode

PER_TASK = 40_000
#: Bins with at most this many free tokens are final.
NEARLY = 2
MEMBER = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>"
BINS = f"bin long, fill long, members array<{MEMBER}>"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    first = n % capacity if n > capacity and n % capacity else min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def _pieces(capacity, end_id, bpe_file, rank_file):
    def run(batches):
        nth = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = [[] for _ in range(6)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text, bpe_file, rank_file), end_id], "<u4")
                for piece, (at, length) in enumerate(cut(len(ids), capacity)):
                    for col, x in zip(out, (nth, doc, piece, at, length, zlib.crc32(ids[at:at + length].tobytes())),
                                      strict=True):
                        col.append(x)
                    nth += 1
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                ["bin", "doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def best_fit(fills: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: items go, largest first, to the open bin that they
    fill best.  Open bins are kept by free room; a bit set finds the least
    room that is large enough."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-fills, kind="stable").tolist():
        size = int(fills[i])
        fit = rooms >> size << size
        if fit:
            room = (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - size
        if left > 0:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


def _pack(capacity):
    def run(batches):
        held = list(batches)
        if not sum(map(len, held)):
            return
        rows = pa.Table.from_batches(held)
        # The order of shuffled rows may differ when a task is run again.
        rows = rows.combine_chunks().sort_by([("fill", "descending"), ("bin", "ascending")])
        fills = rows.column("fill").to_numpy()
        ids = rows.column("bin").to_numpy()
        members = rows.column("members").combine_chunks()
        bounds = members.offsets.to_numpy()
        flat = members.values
        offset = flat.field("offset").to_numpy()
        groups = best_fit(fills, capacity)
        take, shift, sizes = [], [], []
        for group in groups:
            at = count = 0
            for i in group:
                take.append(np.arange(bounds[i], bounds[i + 1]))
                shift.append(np.full(bounds[i + 1] - bounds[i], at))
                count += bounds[i + 1] - bounds[i]
                at += fills[i]
            sizes.append(count)
        take, shift = np.concatenate(take), np.concatenate(shift)
        moved = flat.take(pa.array(take))
        fields = {f.name: moved.field(f.name) for f in flat.type}
        fields["offset"] = pa.array(offset[take] + shift, pa.int64())
        merged = pa.StructArray.from_arrays(list(fields.values()), list(fields))
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([min(ids[i] for i in g) for g in groups], pa.int64()),
             pa.array([int(sum(fills[i] for i in g)) for g in groups], pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends), merged)], ["bin", "fill", "members"])
    return run


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", bpe_file: str = BPE_FILE, rank_file: str = RANK_FILE,
                   per_task: int = PER_TASK) -> DataFrame:
    """Pack all documents: one row per piece with doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.

    A document is the ids of its text followed by ``end_id``; NULL and empty
    text are that id alone.  Documents longer than ``capacity`` are cut into
    whole sequences behind a shorter first piece.  NULL ids stay NULL, repeated
    rows are packed each; an empty table gives an empty result; other columns
    are ignored."""
    pieces = materialise(
        docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
            _pieces(capacity, end_id, bpe_file, rank_file),
            "bin long, doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    bins = pieces.select("bin", F.col("length").alias("fill"), F.array(F.struct(
        "doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))).alias("members"))
    done = bins.where(F.col("fill") >= capacity - NEARLY)
    left = bins.where(F.col("fill") < capacity - NEARLY)
    count, level = left.count(), 0
    while count:
        parts = -(-count // per_task)
        packed = materialise(
            left.repartition(parts, F.xxhash64(F.lit(level), "bin")).mapInArrow(_pack(capacity), BINS),
            f"bins-{level}")
        full = F.col("fill") >= capacity - NEARLY
        after, open_ = packed.agg(F.count(F.lit(1)), F.count(F.when(~full, 1))).first()
        if parts == 1 or (level and after >= count):
            done = done.unionByName(packed)
            break
        done = done.unionByName(packed.where(full))
        left, count, level = packed.where(~full), open_, level + 1
    return (done.select(F.col("bin").alias("sequence_id"), F.explode("members").alias("m"))
            .select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset"))


@register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))

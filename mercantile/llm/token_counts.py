"""Token counts by a separator scan over flat token files.

A token file is one stream of little-endian ids, cut into blocks of a fixed
number of ids without regard to documents, and carries no index.  Each block
is searched at once for the end-of-document id (numpy); a block reports its
length and the places of its separators, and a prefix scan over the blocks of
a file stitches the documents that cross block bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import register, table
from .tokens import BPE_FILE, RANK_FILE, encode

BLOCK_IDS = 1 << 18
#: Blocks whose summaries are scanned in one group before the groups are.
GROUP = 1 << 14
SEPARATOR = 50256
FILES = "file long, block long, ids binary, first long, docs array<long>"


def _write_stream(separator, block_ids, bpe_file, rank_file):
    """Rows of two kinds: blocks of the stream (ids), and the names of the
    documents in stream order (first, docs), which the scan never reads."""
    def rows(file, block=None, ids=None, first=None, docs=None):
        return pa.RecordBatch.from_arrays(
            [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([ids], pa.binary()),
             pa.array([first], pa.int64()), pa.array([docs], pa.list_(pa.int64()))],
            ["file", "block", "ids", "first", "docs"])

    def run(batches):
        file = TaskContext.get().partitionId()
        block = total = 0
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for text in batch.column(1).to_pylist():
                ids = np.array([*encode(text, bpe_file, rank_file), separator], "<u2")
                held.append(ids)
                size += len(ids)
                while size >= block_ids:
                    flat = np.concatenate(held)
                    yield rows(file, block, flat[:block_ids].tobytes())
                    held, size, block = [flat[block_ids:]], size - block_ids, block + 1
            if names:
                yield rows(file, first=total, docs=names)
                total += len(names)
        if size:
            yield rows(file, block, np.concatenate(held).tobytes())
    return run


def _scan(separator, id_bytes):
    def run(batches):
        for batch in batches:
            n, places = [], []
            for blob in batch.column(2):
                ids = np.frombuffer(blob.as_buffer(), f"<u{id_bytes}")
                n.append(len(ids))
                places.append(np.flatnonzero(ids == separator))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(places, pa.list_(pa.int64()))],
                ["file", "block", "n", "seps"])
    return run


def separator_scan(blocks: DataFrame, separator: int, id_bytes: int = 2) -> DataFrame:
    """Documents of token files: file, nth (from 0), start, n_tokens (without
    the separator), closed.

    ``blocks`` has file, block (consecutive from 0) and ids (binary).  Ids
    after the last separator of a file are one document that is not closed;
    a file that ends with a separator has none.  NULL or empty blocks hold no
    ids; an empty table gives an empty result; other columns are ignored.

    The prefix scan has two levels: blocks inside groups of ``GROUP``, then the
    groups of a file, so a file of any size is scanned by many tasks."""
    scanned = blocks.select("file", "block", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(
        _scan(separator, id_bytes), "file long, block long, n long, seps array<long>")
    # One row a block: its length, its separators' places.
    path = scratch_path(blocks.sparkSession, "separators")
    scanned.write.option("compression", "zstd").parquet(path)
    rows = (blocks.sparkSession.read.schema(scanned.schema).parquet(path)
            .withColumn("grp", F.floor(F.col("block") / GROUP))
            .withColumn("k", F.size("seps").cast("long"))
            .withColumn("last", F.element_at(F.when(F.size("seps") > 0, F.col("seps")), -1)))
    inner = Window.partitionBy("file", "grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    local = (rows.withColumn("base", F.coalesce(F.sum("n").over(inner), zero))
             .withColumn("done", F.coalesce(F.sum("k").over(inner), zero))
             .withColumn("prev", F.max(F.col("base") + F.col("last")).over(inner)))
    groups = (local.groupBy("file", "grp").agg(F.sum("n").alias("gn"), F.sum("k").alias("gk"),
                                               F.max(F.col("base") + F.col("last")).alias("glast"))
              .withColumn("gbase", F.coalesce(F.sum("gn").over(outer), zero))
              .withColumn("gdone", F.coalesce(F.sum("gk").over(outer), zero))
              .withColumn("gprev", F.max(F.col("gbase") + F.col("glast")).over(outer))
              .withColumn("end", F.col("gbase") + F.col("gn")))
    placed = (local.join(groups, ["file", "grp"])
              .withColumn("base", F.col("gbase") + F.col("base")).withColumn("done", F.col("gdone") + F.col("done"))
              .withColumn("prev", F.coalesce(F.col("gbase") + F.col("prev"), "gprev", F.lit(-1).cast("long"))))
    ends = F.transform("seps", lambda s: s + F.col("base"))
    starts = F.concat(F.array(F.col("prev") + 1), F.transform(F.slice(ends, 1, F.greatest(F.size("seps") - 1, F.lit(0))),
                                                              lambda e: e + 1))
    closed = (placed.where("k > 0")
              .select("file", "done", F.posexplode(F.arrays_zip(starts.alias("start"), ends.alias("end"))))
              .select("file", (F.col("done") + F.col("pos")).alias("nth"), F.col("col.start").alias("start"),
                      (F.col("col.end") - F.col("col.start")).alias("n_tokens"), F.lit(True).alias("closed")))
    tail = (groups.groupBy("file").agg(F.max("end").alias("end"), F.sum("gk").alias("nth"),
                                       F.max(F.col("gbase") + F.col("glast")).alias("last"))
            .withColumn("start", F.coalesce(F.col("last") + 1, zero)).where("start < end")
            .select("file", "nth", "start", (F.col("end") - F.col("start")).alias("n_tokens"),
                    F.lit(False).alias("closed")))
    return closed.unionByName(tail)


def count_tokens(docs: DataFrame, separator: int = SEPARATOR, block_ids: int = BLOCK_IDS,
                 id_col: str = "doc_id", text_col: str = "text", bpe_file: str = BPE_FILE,
                 rank_file: str = RANK_FILE, path: str | None = None) -> DataFrame:
    """Tokenise documents into flat token files and count each document's
    tokens by the separator scan: doc_id, n_tokens, file, nth, start.

    NULL and empty text count 0; NULL ids and repeated rows keep their rows;
    an empty table gives an empty result; other columns are ignored.  The
    vocabulary must have fewer than 65,536 ids and never produce
    ``separator``.  A file is what one task writes."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    (docs.select(F.col(id_col).cast("long"), F.col(text_col))
     .mapInArrow(_write_stream(separator, block_ids, bpe_file, rank_file), FILES)
     .write.option("compression", "zstd").parquet(path))
    files = spark.read.schema(FILES).parquet(path)
    found = separator_scan(files.where("block IS NOT NULL"), separator)
    names = (files.where("docs IS NOT NULL").select("file", "first", F.posexplode("docs").alias("pos", "doc_id"))
             .select("file", (F.col("first") + F.col("pos")).alias("nth"), "doc_id"))
    return (names.join(found, ["file", "nth"])
            .select("doc_id", "n_tokens", "file", "nth", "start"))


@register("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))

"""Line dedup over levelled sorted runs of line hashes.

A store keeps runs of (line hash, documents, holder), each sorted by hash.  A
new batch is aggregated to one row per line, merge-anti-joined against the
runs to tell lines never seen before, and added as a run of its own on level
0.  A line takes its holder from the batch in which it is new, later batches
only add documents to it, so batches come newest id first.  A level with ``fanout`` runs is merged into one run of the next level, so a
line is rewritten once per level.  Runs are written tables, nothing is kept on
the driver but their paths.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import (ASCII_SPACE, ascii_lower, clean_text, discard, id_or_lowest, materialise, register, remove_folder,
                     table)

KEY = ["h1", "h2"]  # 128 bits of the normalised line
RUN_SCHEMA = "h1 long, h2 long, n_docs long, holder long"


class LineRuns:
    """Levelled runs under ``path``."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = 4):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self.levels: list[list[str]] = []
        self._made = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        """One sorted run; hash-partitioned by the line, sorted inside."""
        self._made += 1
        run = f"{self.path}/level={level}-run={self._made:05d}"
        (rows.select(*KEY, "n_docs", "holder").sortWithinPartitions(*KEY)
         .write.option("compression", "zstd").mode("errorifexists").parquet(run))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    def _read(self, runs: list[str]) -> DataFrame:
        frames = [self.spark.read.schema(RUN_SCHEMA).parquet(r) for r in runs]
        return reduce(DataFrame.unionAll, frames, self.spark.createDataFrame([], RUN_SCHEMA)
                      if not frames else frames.pop(0))

    def merged(self) -> DataFrame:
        """All runs merged: one row per line hash."""
        return (self._read([r for level in self.levels for r in level]).groupBy(*KEY)
                .agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder")))

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch (h1, h2, holder: one row per line of a document).
        Returns the lines of the batch that no run held before, which get their
        largest holder here; lines that a run holds keep theirs.  A document
        must not be split over batches."""
        once = lines.select(*KEY, "holder").distinct()
        batch = materialise(once.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"),
                                                   F.max("holder").alias("holder")), "line-batch")
        fresh = batch.join(self._read([r for level in self.levels for r in level]).select(*KEY),
                           KEY, "left_anti")
        fresh = materialise(fresh, "line-fresh")
        again = (batch.join(fresh.select(*KEY), KEY, "left_anti")
                 .withColumn("holder", F.lit(None).cast("long")))  # the runs have it
        self._write(fresh.unionByName(again).repartition(*KEY), 0)
        discard(batch)
        self.compact()
        return fresh

    def compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                runs, self.levels[level] = self.levels[level], []
                self._write(self._read(runs).groupBy(*KEY)
                            .agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder")), level + 1)
            level += 1


def line_rows(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(row hash, holder, line number, h1, h2) of every line whose key has at
    least ``min_chars`` code points."""
    text = clean_text(text_col)
    key = ascii_lower(F.btrim(F.col("x.line"), F.lit(ASCII_SPACE)))
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda v, i: F.struct(i.alias("at"), v.alias("line"))),
                     lambda x: F.length(x["line"]) >= min_chars)
    return (docs.select(F.xxhash64(id_col, text_col).alias("row"), id_or_lowest(id_col).alias("holder"),
                        F.explode(lines).alias("x"))
            .select("row", "holder", F.col("x.at").alias("at"), key.alias("key"))
            .where(F.length("key") >= min_chars)
            .select("row", "holder", "at", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second"), "key").alias("h2")))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4,
                id_col: str = "doc_id", text_col: str = "text", fanout: int = 2,
                carry: Sequence[str] = ()) -> DataFrame:
    """Drop every line of at least ``min_chars`` code points (white space
    stripped, A-Z lower-cased) found in ``min_docs`` or more documents, except
    in the largest id holding it.

    Returns doc_id, n_lines, n_dropped, kept_text, one row per input row.  NULL
    and empty text are one empty line and stay empty; NULL ids form one
    document below all others; rows sharing an id are one document when lines
    are counted, and repeated rows are treated alike; lines repeated inside the
    holder stay.  The columns named in ``carry`` come back as the fields of a
    struct, so no name clashes; others are ignored."""
    spark = docs.sparkSession
    carried = [F.struct(*carry).alias("carried")] if carry else []
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carried)
    bounds = docs.agg(F.min(id_or_lowest("doc_id")), F.max(id_or_lowest("doc_id")),
                      F.min("doc_id")).first()
    low, high = (bounds[2] if bounds[2] is not None else 0), bounds[1] or 0
    width = max(1, -(-(high - low + 1) // batches))
    lines = line_rows(docs, min_chars, "doc_id", "text")
    # Newest ids first: the run that first holds a line then holds its largest id.
    # Compared as whole numbers: ids may span all 64 bits.
    number = F.lit(batches - 1)
    for b in reversed(range(batches - 1)):
        number = F.when(F.col("holder") >= F.lit(max(high - (b + 1) * width + 1, low)).cast("long"), b).otherwise(number)
    lines = materialise(lines.withColumn("batch", number), "lines")
    store = LineRuns(spark, scratch_path(spark, "line-runs"), fanout)
    for b in range(batches):
        discard(store.add(lines.where(F.col("batch") == b)))
    repeated = materialise(store.merged().where(F.col("n_docs") >= min_docs).select(*KEY, F.col("holder").alias("keeper")),
                           "lines-repeated")
    remove_folder(spark, store.path)
    drops = (lines.join(repeated, KEY).where(F.col("holder") != F.col("keeper"))
             .groupBy("row").agg(F.collect_set("at").alias("drops")))
    marked = (docs.withColumn("row", F.xxhash64("doc_id", "text")).join(drops, "row", "left"))
    parts = F.split(clean_text("text"), "\n", -1)
    kept = F.when(F.col("drops").isNull(), clean_text("text")).otherwise(F.array_join(
        F.filter(parts, lambda v, i: ~F.array_contains("drops", i)), "\n"))
    return marked.select("doc_id", F.size(parts).cast("long").alias("n_lines"),
                         F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
                         kept.alias("kept_text"), *["carried"] * bool(carry))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.i, k.line, (c.key IS NOT NULL AND k.doc_id <> c.keeper) AS gone
      FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS BIGINT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@register("op4_line_dedup", OP4_SQL)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))

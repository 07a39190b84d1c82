"""Corpus pipeline: toxicity, line dedup, near-duplicate documents, mixing,
packing.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before
kept.  All but the last return the columns of ``docs``; ``run`` writes each
result as Parquet in the shared folder, rereads it and removes it once the next
is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercantile.llm.common import discard, materialise, table
from mercantile.llm.line_dedup import dedup_lines
from mercantile.llm.mixing import mix_sources, word_count
from mercantile.llm.ngram_join import ngram_jaccard_join
from mercantile.llm.packing import pack_documents
from mercantile.llm.toxicity import drop_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, fitted on the labelled ones, calls toxic go."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated in three or more documents stay in one; ``n_chars``
    follows the text.  A document may become empty, none goes."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = dedup_lines(docs, carry=others)
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*[made.get(c, F.col("carried")[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a five-word shingle similarity of 0.8 or more the
    one with the smallest id stays.  Rows that share an id stay or go together."""
    joined = ngram_jaccard_join(docs, words=5, percent=80)
    keep = (joined.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("_keep")).distinct())
    return docs.join(keep, F.col("doc_id").eqNullSafe(F.col("_keep")), "left_semi")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, as the mix to target weights takes them.  Rows
    of one id, source and size take the same number of copies."""
    copies = (mix_sources(docs).groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
                                        F.col("size").alias("_size")).agg(F.max("copies").alias("_copies"))
              .where("_copies > 0"))
    same = (F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
            & (word_count("text") == F.col("_size")))
    return (docs.join(copies, same)
            .withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mixing", mixing), ("packing", packing)]

#: A trained network decides in the first stage; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(*before)
        before = [docs]
    return docs

"""Feeding file streams in a fixed order (tests and the named stream queries).

Each slice is written completely as its own Parquet folder under the
stream's input folder, and only then is the query run with an
``availableNow`` trigger on the same checkpoint: it consumes everything that
is there and stops.  No micro-batch can see a half-committed slice (a Parquet
commit moves files into place one by one, and a continuously polling stream
could pick up part of a slice), so micro-batches follow the slice order
exactly.  State and offsets carry over between runs through the checkpoint.

The number of state partitions of a stateful stream is fixed when its
checkpoint is created.  It is taken from the cluster's default parallelism
(one state partition per core) rather than from ``spark.sql.shuffle.partitions``,
which is sized for batch shuffles; the session setting is restored right
after the start (a running stream keeps its own copy of the conf)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

SHUFFLE = "spark.sql.shuffle.partitions"


def run_slices(spark: SparkSession, slices: Sequence[DataFrame], input_dir: str,
               start: Callable[[DataFrame], DataStreamWriter], checkpoint: str,
               state_partitions: int | None = None) -> None:
    schema = slices[0].schema
    for i, part in enumerate(slices):
        part.write.mode("overwrite").parquet(f"{input_dir}/s{i:05d}")
        stream = spark.readStream.schema(schema).parquet(f"{input_dir}/s*")
        writer = start(stream).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        before = spark.conf.get(SHUFFLE)
        spark.conf.set(SHUFFLE, str(state_partitions or spark.sparkContext.defaultParallelism))
        try:
            query = writer.start()
        finally:
            spark.conf.set(SHUFFLE, before)
        query.awaitTermination()

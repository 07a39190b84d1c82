"""Order-line admission on a stream (the M16 greedy rule, live).

Each micro-batch runs the exact distributed batch operator against the stock
left by the micro-batch before, so a hot product never sits in one task and
feeding the lines in order gives exactly the batch result.  A line for an
unknown product is refused, not lost.  Top-up events (``kind = 'topup'``) come
in the same stream; those of a micro-batch raise the stock before its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.admission import admit
from ..operators.changes import add_deltas
from ..session import path_exists


def admission_sink(products: DataFrame, state_path: str, out_path: str, key: str = "product_id",
                   **admit_options):
    """``foreachBatch`` function of R1.

    Lines and the new stock are written partitioned by batch id with dynamic
    overwrite, so a replayed batch rewrites its own output (exactly once).  The
    snapshot holds one row per product per micro-batch; older batch folders
    can be dropped."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stock, last = products, None
        if path_exists(spark, state_path):
            history = spark.read.parquet(state_path)
            last = history.where(F.col("_batch") < batch_id).agg(F.max("_batch")).first()[0]
            if last is not None:
                stock = history.where(F.col("_batch") == last).drop("_batch")
        lines = batch
        if "kind" in batch.columns:
            lines = batch.where(~F.col("kind").eqNullSafe("topup"))
            added = batch.where((F.col("kind") == "topup") & (F.col("quantity") > 0))
            stock = add_deltas(stock, added.select(key, "quantity"), key=key).table
        res = admit(lines, stock, mode="greedy", key=key, **admit_options)
        judged = (res.accepted.withColumn("accepted", F.lit(True)).withColumn("reason", F.lit(None).cast("string"))
                  .unionByName(res.refused.withColumn("accepted", F.lit(False))))
        for df, path in ((judged, out_path), (res.products, state_path)):
            (df.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path))
    return run

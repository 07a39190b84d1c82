"""R2: deletion audit on a stream of delete requests (the M17 trigger, live).

A stream of (employee_id, requested_at) is joined with the employees
snapshot (stream-static inner join: requests for unknown ids match nothing).
Each employee is audited once.  Repeats that arrive within ``delay`` of each
other meet in the state store (``dropDuplicatesWithinWatermark``), which forgets
an id after that time and so stays as small as the recent requests; later
repeats are found in the audit table itself.  The watermark follows the arrival,
not ``requested_at``, so an old request that arrives late is still audited.
Audit ids are assigned per micro-batch in ``foreachBatch``, continuing after the
largest id already in the audit table, in (requested_at, employee_id) order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import dense_keys
from ..schemas import SCHEMAS
from ..session import path_exists, written

AUDIT_COLUMNS = [f.name for f in SCHEMAS["employee_audit"]]


def audit_stream(requests: DataFrame, employees: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Streaming audit rows without ``audit_id`` (see :func:`audit_sink`)."""
    emp = employees.select("employee_id", "name", "role", "store_id", "salary", "manager_id")
    return (requests.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
            .join(emp, "employee_id", "inner")
            .dropDuplicatesWithinWatermark(["employee_id"])
            .select(*[c for c in AUDIT_COLUMNS if c not in ("audit_id", "deleted_at")],
                    F.col("requested_at").cast("timestamp_ntz").alias("deleted_at")))


def audit_sink(table_path: str):
    """``foreachBatch`` function appending the employees of a micro-batch that
    no earlier one audited, with dense audit ids.  Re-running a batch id after a
    failure rewrites the same ids (they depend only on the table before the
    batch and the batch).  Of the table only the ids are read, and those that the
    batch holds are looked up before the anti join, so a small batch is
    broadcast and the table is not shuffled."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        start = 0
        if path_exists(spark, table_path):  # a table that cannot be read is an error
            batch = written(batch)
            existing = spark.read.parquet(table_path).where(F.col("_batch") < batch_id)
            start = existing.select(F.max("audit_id")).scalar()
            seen = existing.select("employee_id").join(batch.select("employee_id"), "employee_id", "left_semi")
            batch = batch.join(written(seen.distinct()), "employee_id", "left_anti")
        rows = dense_keys(batch, ["deleted_at", "employee_id"], start=start, out="audit_id")
        (rows.select(*AUDIT_COLUMNS).withColumn("_batch", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch").parquet(table_path))
    return write

"""Order-dependent numbering without a single-partition window.

``row_number() OVER (ORDER BY ...)`` and ``sum() OVER (PARTITION BY g ORDER BY
...)`` put a whole table, or a whole group, into one task.  Both helpers here
instead range-partition on the ordering (a hot group spans many partitions),
work inside each partition, and add per-partition offsets computed from a
frame with one row per (partition, group) piece.

The range-partitioned input is checkpointed to the reliable checkpoint folder
before it is used twice, so partition ids cannot change between the two uses
(range bounds come from sampling) or after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffle_partitions

PID = "_pid"


def _ranged(df: DataFrame, sort_cols: Sequence[str], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or shuffle_partitions(spark)
    return (df.repartitionByRange(n, *sort_cols)
            .sortWithinPartitions(*sort_cols)
            .withColumn(PID, F.spark_partition_id())
            .withColumn("_mono", F.monotonically_increasing_id())
            .checkpoint(eager=True))


def dense_keys(df: DataFrame, order_cols: Sequence[str], start: Column | int = 0,
               out: str = "key", partitions: int | None = None) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in ``order_cols`` order.

    ``order_cols`` should be unique (add tie-breakers), else ties are numbered
    in an arbitrary but fixed order.  ``start`` may be a scalar subquery
    column such as ``table.select(max(key)).scalar()``."""
    tagged = _ranged(df, order_cols, partitions)
    local = F.col("_mono") - F.shiftleft(F.col(PID).cast("long"), 33)
    counts = tagged.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a bounded frame, safe to order in one task and broadcast.
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(PID, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (tagged.join(F.broadcast(offsets), PID, "inner")
            .withColumn(out, (F.coalesce(start_col, F.lit(0)) + F.col("_off") + local + 1).cast("long"))
            .drop(PID, "_mono", "_off"))


def place(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
          partitions: int | None = None) -> DataFrame:
    """Range-partition by group and order and remember every row's piece
    (``_pid``) and position (``_mono``, ascending in that order).  Any number
    of :func:`placed_totals` may follow on rows of the result."""
    return _ranged(df, [*group_cols, *order_cols], partitions)


def placed_totals(placed: DataFrame, group_cols: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Inclusive running sums per group over rows laid out by :func:`place`;
    ``values`` maps each new column to what it sums.

    Pieces are (partition, group): a hot group is spread over many range
    partitions, each summing its piece locally, and the offsets per piece come
    from a window over the pieces only (at most one row per partition and
    group)."""
    w_local = (Window.partitionBy(PID, *group_cols).orderBy("_mono")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_prev = Window.partitionBy(*group_cols).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"_in_{o}": F.sum(v).over(w_local) for o, v in values.items()})
    pieces = placed.groupBy(PID, *group_cols).agg(*[F.sum(v).alias(f"_sum_{o}") for o, v in values.items()])
    offsets = pieces.select(PID, *group_cols, *[
        F.coalesce(F.sum(f"_sum_{o}").over(w_prev), F.lit(0)).alias(f"_off_{o}") for o in values])
    return (local.join(offsets, [PID, *group_cols], "inner")
            .withColumns({o: F.col(f"_off_{o}") + F.col(f"_in_{o}") for o in values})
            .drop(*[f"_{x}_{o}" for o in values for x in ("in", "off")]))


def running_total(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                  value: str, out: str, partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per group in ``order_cols`` order."""
    return (placed_totals(place(df, group_cols, order_cols, partitions), group_cols, {out: F.col(value)})
            .drop(PID, "_mono"))

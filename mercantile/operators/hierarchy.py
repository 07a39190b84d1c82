"""Employee hierarchy (Q3, Q3b) by pointer doubling.

Every employee keeps an ancestor and the hops to it; a round replaces the
ancestor by the ancestor's ancestor, so a chain of depth d resolves in
ceil(log2 d) rounds.  Only employees that have not reached their root move;
settled ones stay behind as written rows, checkpointed to the shared folder.
(Spark's recursive CTE stops at 100 levels / 1,000,000 rows by default.)

Employees on or below a manager cycle, or under a missing manager, never reach
a root; they come back in a second ``unreachable`` frame instead of being
dropped silently, and :func:`why_unreachable` names the cycle or the missing
manager that each of them hangs on.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import indent
from ..session import ensure_checkpoint_dir


class Hierarchy(NamedTuple):
    levels: DataFrame
    unreachable: DataFrame


def hierarchy(employees: DataFrame, id: str = "employee_id", parent: str = "manager_id",
              columns: tuple[str, ...] = ("name", "role"), max_depth: int | None = None,
              ordered: bool = True) -> Hierarchy:
    """Q3: (id, *columns, parent, level); roots have a NULL parent and level 0.

    Assumes unique ids (rule V1).  ``max_depth`` leaves deeper levels out of
    ``levels``; ``unreachable`` does not depend on it.  The join key of a round
    is the ancestor, so a hot manager is the skewed side of a join that AQE can
    split; the hops are LONG."""
    ensure_checkpoint_dir(employees.sparkSession)
    nodes = employees.select(id, *columns, parent)
    start = nodes.select(F.col(id).alias("_id"), F.col(parent).alias("_anc"),
                         F.when(F.col(parent).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("_hops"))
    start = start.checkpoint(eager=True)
    settled = [start.where(F.col("_anc").isNull())]
    moving = start.where(F.col("_anc").isNotNull())
    # A pointer that is still on its way after log2(n) + 1 doublings is in a loop.
    for _ in range(max(1, start.count()).bit_length() + 1):
        if moving.isEmpty():
            break
        known = reduce(DataFrame.unionByName, [*settled, moving])
        jump = known.select(F.col("_id").alias("_j"), F.col("_anc").alias("_janc"), F.col("_hops").alias("_jhops"))
        moved = F.col("_j").isNotNull()
        state = moving.join(jump, moving["_anc"] == jump["_j"], "left").select(
            "_id", F.when(moved, F.col("_janc")).otherwise(F.col("_anc")).alias("_anc"),
            F.when(moved, F.col("_hops") + F.col("_jhops")).otherwise(F.col("_hops")).alias("_hops"),
        ).checkpoint(eager=True)
        settled.append(state.where(F.col("_anc").isNull()))
        moving = state.where(F.col("_anc").isNotNull())
    done = reduce(DataFrame.unionByName, settled).select(
        F.col("_id").alias(id), F.col("_hops").cast("int").alias("level"))
    unreachable = nodes.join(done.select(id), id, "left_anti")
    if max_depth is not None:
        done = done.where(F.col("level") <= max_depth)
    levels = nodes.join(done, id, "inner").select(id, *columns, parent, "level")
    return Hierarchy(levels.orderBy("level", id) if ordered else levels, unreachable)


# The reasons of :func:`why_unreachable`.
ON_CYCLE, BELOW_CYCLE, NO_MANAGER = "on a cycle", "below a cycle", "below a missing manager"


def why_unreachable(unreachable: DataFrame, id: str = "employee_id", parent: str = "manager_id") -> DataFrame:
    """``unreachable`` rows with ``reason`` and ``cause``: the smallest id of the
    cycle a row is on or below, or the id of the manager who is not there.

    A row keeps a pointer 2^k managers up and the smallest id among the 2^k rows
    it passed.  Once 2^k reaches the number of rows, every pointer that met no
    missing manager is on a cycle and has gone round it, the pointers' targets
    are exactly the cycles' members, and a member's smallest id is its cycle's.
    Rows below a missing manager stop moving when they find it.  Ids are unique
    and not NULL (rules V1, V2); a row that is its own manager is a cycle of one.
    A round joins two written frames, so a hot manager is split."""
    ensure_checkpoint_dir(unreachable.sparkSession)
    start = unreachable.select(F.col(id).alias("_id"), F.col(parent).alias("_up"), F.col(id).alias("_low"))
    moving = start.checkpoint(eager=True)
    lost = []
    for _ in range(max(1, moving.count()).bit_length() + 1):
        if moving.isEmpty():
            break
        ends = F.lit(None).cast(moving.schema["_up"].dataType)
        known = reduce(DataFrame.unionByName, [moving.withColumn("_end", ends), *lost])
        jump = known.select(F.col("_id").alias("_j"), F.col("_up").alias("_jup"), F.col("_low").alias("_jlow"),
                            F.col("_end").alias("_jend"))
        met = F.col("_j").isNotNull()
        state = moving.join(jump, moving["_up"] == jump["_j"], "left").select(
            "_id", F.when(met, F.col("_jup")).otherwise(F.col("_up")).alias("_up"),
            F.least("_low", "_jlow").alias("_low"),
            F.when(met, F.col("_jend")).otherwise(F.col("_up")).alias("_end")).checkpoint(eager=True)
        lost.append(state.where(F.col("_end").isNotNull()))
        moving = state.where(F.col("_end").isNull()).drop("_end")
    members = moving.select(F.col("_up").alias("_m")).distinct().checkpoint(eager=True)
    loops = (moving.join(members, moving["_id"] == members["_m"], "left_semi")
             .select(F.col("_id").alias("_m"), F.col("_low").alias("_loop")).checkpoint(eager=True))
    hung = moving.join(loops, moving["_up"] == loops["_m"], "inner").select("_id", F.col("_loop").alias("_cause"))
    on = loops.select(F.col("_m").alias("_on"))
    hung = hung.join(on, hung["_id"] == on["_on"], "left").select(
        "_id", F.when(F.col("_on").isNotNull(), ON_CYCLE).otherwise(BELOW_CYCLE).alias("reason"), "_cause")
    found = reduce(DataFrame.unionByName, [hung, *[
        gone.select("_id", F.lit(NO_MANAGER).alias("reason"), F.col("_end").alias("_cause")) for gone in lost]])
    return (unreachable.join(found, unreachable[id] == found["_id"], "inner")
            .select(*unreachable.columns, "reason", F.col("_cause").alias("cause")))


def indent_lines(levels: DataFrame, id: str = "employee_id") -> DataFrame:
    """The printed line, two spaces per level."""
    # The labels of the line.
    line = F.concat(
        indent("level"), F.lit("Level "), F.col("level").cast("string"),
        F.lit(": Employee ID: "), F.col(id).cast("string"),
        F.lit(", Name: "), F.coalesce(F.col("name"), F.lit("None")),
        F.lit(", Role: "), F.coalesce(F.col("role"), F.lit("None")),
        F.lit(", Manager ID: "), F.coalesce(F.col("manager_id").cast("string"), F.lit("None")))
    return levels.select(id, "level", line.alias("line"))

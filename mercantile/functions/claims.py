"""First come, first served: who keeps a value that several units claim."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_come(claims: DataFrame, unit: str, few_units: bool = False) -> DataFrame:
    """Units that lose a claim, as if units came one by one in order of
    ``unit``: a unit is refused when an earlier *accepted* unit holds one of its
    values, and a refused unit holds nothing.

    ``claims`` has one row per unit and claimed value (``unit``, ``_rule``,
    ``_value``).  Returns ``unit`` and ``_rules`` (the rules under which it lost,
    sorted), one row per refused unit.  Only values claimed twice are looked at.
    A round refuses the units that share a value with an accepted one and
    accepts those that come first for all their values, so it decides the first
    undecided unit at least; unrelated units are decided side by side.
    With ``few_units`` a round's verdicts, one row per unit, are broadcast, so a
    unit with many values stays in many tasks."""
    value = ["_rule", "_value"]
    claims = claims.select(unit, *value).distinct().checkpoint(eager=True)
    shared = claims.groupBy(*value).agg(F.count(F.lit(1)).alias("_units")).where("_units > 1")
    none = F.lit(None).cast("array<string>")
    open_ = (claims.join(shared, value, "left_semi").withColumn("_in", F.lit(False)).withColumn("_rules", none)
             .checkpoint(eager=True))
    refused = [open_.where("false").select(unit, "_rules")]
    while not open_.where(~F.col("_in")).isEmpty():
        # Written before the join, so that the join may split a hot value.
        state = open_.groupBy(*value).agg(
            F.max("_in").alias("_taken"), F.min(F.when(~F.col("_in"), F.col(unit))).alias("_first")).checkpoint(eager=True)
        seen = (open_.where(~F.col("_in")).join(state, value)
                .groupBy(unit).agg(F.array_sort(F.collect_set(F.when(F.col("_taken"), F.col("_rule")))).alias("_lost"),
                                   F.min(F.col("_first") == F.col(unit)).alias("_next")))
        seen = F.broadcast(seen) if few_units else seen
        lost = F.when(F.size("_lost") > 0, F.col("_lost"))
        after = (open_.drop("_rules").join(seen, unit, "left")
                 .select(unit, *value, (F.col("_in") | (F.coalesce("_next", F.lit(False)) & lost.isNull())).alias("_in"),
                         lost.alias("_rules")).checkpoint(eager=True))
        refused.append(after.where(F.col("_rules").isNotNull()).select(unit, "_rules").distinct())
        open_ = after.where(F.col("_rules").isNull())
    return reduce(DataFrame.unionByName, refused)

"""Changed totals as levelled runs, compacted while readers go on.

A micro-batch's changed totals are a run of level 0.  ``FAN`` neighbouring runs
of a level are merged (newest row of each key) into one run of the next, so
``n`` micro-batches leave at most ``FAN - 1`` live runs a level, about
``FAN * log(n)`` folders, and a total is rewritten once a level.

A run is a folder named after its level and the range of batches it covers; it
counts from the moment its ``_SUCCESS`` file is there, and a run inside the
range of another one no longer counts.  That one file is the atomic switch:
readers see the parts or the merged run, never a mixture.  Replaced runs are
deleted ``keep`` micro-batches later, for readers that planned before the switch.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

#: Runs of a level that are merged into one of the next.
FAN = 4
#: Micro-batches for which a replaced run stays readable.
KEEP = 3

_NAME = re.compile(r"run-(\d+)-(\d+)-(\d+)")


class Run(NamedTuple):
    level: int
    first: int
    last: int

    @property
    def folder(self) -> str:
        return f"run-{self.level}-{self.first}-{self.last}"

    def inside(self, other: Run) -> bool:
        return self != other and other.level > self.level and other.first <= self.first and self.last <= other.last


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def complete_runs(spark: SparkSession, path: str) -> list[Run]:
    """Runs that are written whole, replaced ones included, oldest first."""
    where, files = _files(spark, path)
    if not files.exists(where):
        return []
    found = []
    for entry in files.listStatus(where):
        named = _NAME.fullmatch(entry.getPath().getName())
        if named and path_exists(spark, f"{path}/{named.group(0)}/_SUCCESS"):
            found.append(Run(*map(int, named.groups())))
    return sorted(found, key=lambda r: (r.first, r.level))


def live_runs(runs: list[Run]) -> list[Run]:
    return [r for r in runs if not any(r.inside(o) for o in runs)]


def newest(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each key, its ``_batch`` kept (NULL keys are one key)."""
    rest = [c for c in versions.columns if c not in keys]
    best = F.max_by(F.struct(*rest), "_batch").alias("_row")
    return versions.groupBy(*keys).agg(best).select(*keys, "_row.*")


def compacting_sink(path: str, keys: list[str], fan: int = FAN, keep: int = KEEP):
    """``foreachBatch`` function: add the batch's changed totals, merge full levels.

    A replayed batch whose run is there (or merged away) changes nothing, a run
    that a crash left unfinished is written again, and a merge that a crash cut
    off is made up by the next call.  Batch ids grow."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        runs = complete_runs(spark, path)
        if not any(r.first <= batch_id <= r.last for r in runs):
            new = Run(0, batch_id, batch_id)
            (batch.withColumn("_batch", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").parquet(f"{path}/{new.folder}"))
            runs.append(new)
        while full := _full_level(live_runs(runs), fan):
            merged = Run(full[0].level + 1, full[0].first, full[-1].last)
            parts = spark.read.parquet(*[f"{path}/{r.folder}" for r in full])
            newest(parts, keys).write.mode("overwrite").parquet(f"{path}/{merged.folder}")
            runs.append(merged)
        live = live_runs(runs)
        for old in runs:
            over = [r for r in live if old.inside(r)]
            if over and max(r.last for r in over) + keep <= batch_id:
                where, files = _files(spark, f"{path}/{old.folder}")
                files.delete(where, True)
    return write


def _full_level(live: list[Run], fan: int) -> list[Run] | None:
    for level in sorted({r.level for r in live}):
        same = sorted(r for r in live if r.level == level)
        if len(same) >= fan:
            return same[:fan]
    return None


def current_totals(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest total of every key over the live runs (at least one batch)."""
    folders = [f"{path}/{r.folder}" for r in live_runs(complete_runs(spark, path))]
    return newest(spark.read.parquet(*folders), keys).drop("_batch")

"""Table appends, clustered layout and snapshot versions."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists, shuffle_partitions

LOG_SCHEMA = "name string, version int, written_at timestamp_ntz, folder string"


class Appended(NamedTuple):
    table: DataFrame
    added: DataFrame
    conflicts: DataFrame


def append_new(existing: DataFrame, batch: DataFrame, key: Sequence[str] | str,
               order: Sequence[str], unique: Sequence[str] = ()) -> Appended:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``.

    An existing key wins; within the batch the first row in ``order`` wins.
    The in-batch choice is a partial aggregation (``min_by``), so a key
    repeated in a third of the batch is reduced map-side, not in one task.

    Only the named key is tolerated: a clash on another ``unique`` column
    (with the table or inside the rows to add) and a NULL in the key are errors
    that refuse the whole statement; ``conflicts`` lists the values."""
    key = [key] if isinstance(key, str) else list(key)
    cols = batch.columns
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    first = (batch.where(~no_key).groupBy(*key)
             .agg(F.min_by(F.struct(*cols), F.struct(*[F.col(c) for c in order])).alias("_row"))
             .select("_row.*"))
    added = first.join(existing.select(*key), key, "left_anti").select(*existing.columns)
    conflicts = (batch.where(no_key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 0)
                 .select(F.lit(",".join(key)).alias("column_name"), F.lit(None).cast("string").alias("value"), "rows"))
    for c in unique:
        both = (added.select(F.col(c).alias("_v"), F.lit(1).alias("_new"))
                .unionByName(existing.select(F.col(c).alias("_v"), F.lit(0).alias("_new"))))
        conflicts = conflicts.unionByName(
            both.where(F.col("_v").isNotNull()).groupBy("_v")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("_new").alias("_new"))
            .where((F.col("rows") > 1) & (F.col("_new") > 0))
            .select(F.lit(c).alias("column_name"), F.col("_v").cast("string").alias("value"), "rows"))
    ok = conflicts.select(F.count(F.lit(1)) == 0).scalar()
    kept = added.where(ok)
    return Appended(existing.unionByName(kept), kept, conflicts)


class Checked(NamedTuple):
    table: DataFrame
    duplicates: DataFrame


def append(existing: DataFrame, batch: DataFrame, key: Sequence[str] | str) -> Checked:
    """Plain INSERT; a duplicate key (against the table or inside the
    batch) or a NULL in the key is an error that refuses the whole batch.
    ``duplicates`` lists the offending keys; the decision is a one-row scalar
    flag."""
    key = [key] if isinstance(key, str) else list(key)
    counts = (batch.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
              .join(existing.select(*key).distinct().withColumn("_old", F.lit(1)), key, "left"))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    dups = counts.where((F.col("_n") > 1) | F.col("_old").isNotNull() | no_key).select(
        *key, (F.col("_n") + F.coalesce(F.col("_old"), F.lit(0))).alias("rows"))
    ok = dups.select(F.count(F.lit(1)) == 0).scalar()
    return Checked(existing.unionByName(batch.where(ok).select(*existing.columns)), dups)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None,
                    mode: str = "overwrite") -> str:
    """Range-partition and sort by ``keys`` before writing, so every file
    and row group covers a narrow key range and Parquet min/max statistics
    skip the rest for lookups by those keys (the role of the reference's
    secondary indexes)."""
    n = partitions or shuffle_partitions(df.sparkSession)
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .write.mode(mode).parquet(path))
    return path


#: Views by snapshot root: name -> (tables they read, how they are built).
_views: dict[str, dict[str, tuple[list[str], Callable[..., DataFrame]]]] = {}


class Snapshots:
    """Versioned tables in a shared folder.

    A change writes a new version into a folder of its own and then names that
    folder in the version log (a tiny Parquet table, one row per version), so a
    write that dies in between leaves the table as it was and later writes go
    on.  Readers take the latest version that the log names; views follow."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: dict[tuple[str, int], str] = {}  # a version never moves

    def _log(self) -> str:
        return f"{self.root}/_versions"

    def _folders(self, name: str) -> dict[int, str]:
        """Version -> folder; none only where no log was ever written.  A log
        that cannot be read is an error, never an empty history."""
        if not path_exists(self.spark, self._log()):
            return {}
        log = self.spark.read.schema(LOG_SCHEMA).parquet(self._log())
        rows = log.where(F.col("name") == name).select("version", "folder").collect()
        found = {r.version: f"{self.root}/{name}/{r.folder or f'v={r.version}'}" for r in sorted(rows)}
        self._known.update({(name, v): folder for v, folder in found.items()})
        return found

    def versions(self, name: str) -> list[int]:
        return list(self._folders(name))

    def path(self, name: str, version: int) -> str:
        return self._known.get((name, version)) or self._folders(name)[version]

    def write(self, name: str, df: DataFrame) -> int:
        """Add a version and refresh the views that read this table."""
        v = max(self.versions(name), default=0) + 1
        folder = f"v={v}-{uuid.uuid4().hex[:12]}"
        df.write.mode("errorifexists").parquet(f"{self.root}/{name}/{folder}")
        entry = self.spark.createDataFrame([(name, v, dt.datetime.now(), folder)], LOG_SCHEMA)
        entry.write.mode("append").parquet(self._log())
        self._known[name, v] = f"{self.root}/{name}/{folder}"
        for view, (tables, build) in _views.get(self.root, {}).items():
            if name in tables:
                build(*[self.read(t) for t in tables]).createOrReplaceTempView(view)
        return v

    def read(self, name: str, version: int | None = None) -> DataFrame:
        folders = self._folders(name)
        if not folders:
            raise KeyError(name)
        return self.spark.read.parquet(folders[version or max(folders)])

    def create_if_absent(self, name: str, schema: T.StructType) -> DataFrame:
        """``CREATE TABLE IF NOT EXISTS`` — an existing table stays as is."""
        if not self.versions(name):
            self.write(name, self.spark.createDataFrame([], schema))
        return self.read(name)

    def view(self, name: str, view: str | None = None) -> DataFrame:
        """``CREATE OR REPLACE VIEW`` of a table; it shows each version
        that is written from now on."""
        return self.define_view(view or name, [name], lambda df: df)

    def define_view(self, view: str, tables: Sequence[str], build: Callable[..., DataFrame]) -> DataFrame:
        """A view ``build(*tables)``, such as a report over several
        tables, that follows every write of one of them."""
        _views.setdefault(self.root, {})[view] = (list(tables), build)
        df = build(*[self.read(t) for t in tables])
        df.createOrReplaceTempView(view)
        return df

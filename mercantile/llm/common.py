"""Small helpers shared by the operators: query registration, scratch tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: White space of the word, line and size rules: space, tab, LF, VT, FF, CR.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LONG_MIN = -(1 << 63)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark then removes the shuffle files of a write when it ends, not when the
#: driver happens to collect its garbage.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, and
    a lost executor re-reads files instead of recomputing the branch."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of :func:`materialise` that nothing reads any more."""
    for t in tables:
        remove_folder(t.sparkSession, t.written_to)


def clean_text(col) -> Column:
    """NULL text counts as empty text everywhere in the subpackage."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col) -> Column:
    """Lower-case A-Z only (``lower`` would fold all of Unicode)."""
    return F.translate(col, UPPER, UPPER.lower())


def id_or_lowest(col: str) -> Column:
    """NULL ids order below every other id."""
    return F.coalesce(F.col(col), F.lit(LONG_MIN).cast(LongType()))


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path`` whose write was committed, sorted."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    where = hadoop(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]
    return sorted(n for n in names if files.exists(hadoop(f"{path}/{n}/_SUCCESS")))

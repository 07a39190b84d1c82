"""Named queries over the fixture tables: ``QUERIES[id](spark, sf_dir)``.

Each entry is a thin plan over the library operators; the result contract for
comparison with the SQL twins in :mod:`mercantile.plans.oracle` is: keys
BIGINT, small ints INTEGER, money DOUBLE (nearest double of the exact decimal),
dates ISO ``yyyy-MM-dd`` text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import fixtures
from ..functions.scalar import as_double, iso_date

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return fixtures.load_tables(spark, sf_dir, names)


def doubles(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: as_double(c) for c in cols})


def iso_dates(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: iso_date(c) for c in cols})


AS_OF = fixtures.AS_OF

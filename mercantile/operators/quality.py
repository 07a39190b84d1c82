"""Integrity rules as data-quality operators (V1-V7).

The declared rules of :mod:`mercantile.schemas` are checked set-wise:
row-local rules (NOT NULL, CHECK, length, decimal range) are one projection;
keys and uniqueness are partial aggregations (a hot duplicate collapses
map-side); foreign keys are anti joins against the *distinct* parent keys.
``validate`` splits good rows from quarantined ones in one pass.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RULES, SCHEMAS, foreign_keys_of
from ..session import written

VIOLATION_SCHEMA = "table_name string, rule string, column_name string, key string, detail string"


def _key_text(table: str, columns: list[str] | None = None) -> Column:
    pk = [c for c in RULES[table].primary_key if columns is None or c in columns]
    if not pk:
        return F.lit(None).cast("string")
    return F.concat_ws(",", *[F.col(c).cast("string") for c in pk])


def row_rules(table: str, columns: list[str] | tuple[str, ...]) -> list[tuple[str, str]]:
    """(rule, column) for the row-local rules that apply to ``columns``."""
    r = RULES[table]
    out = [("primary_key_not_null", c) for c in r.primary_key if c in columns]
    out += [("not_null", c) for c in r.not_null if c in columns]
    for name, expr in r.checks.items():
        used = [c for c in columns if c in expr]
        if used:
            out.append((f"check:{name}", used[0]))
    out += [("max_length", c) for c in r.max_length if c in columns]
    out += [("decimal_range", c) for c in r.decimals if c in columns]
    return out


def failing(table: str, rule: str, col: str) -> Column:
    """The predicate that is TRUE for a row breaking ``rule``.  A CHECK that
    evaluates to NULL passes, as in SQL."""
    r = RULES[table]
    if rule in ("primary_key_not_null", "not_null"):
        return F.col(col).isNull()
    if rule.startswith("check:"):
        return ~F.coalesce(F.expr(r.checks[rule[6:]]), F.lit(True))
    if rule == "max_length":
        return F.coalesce(F.length(col) > r.max_length[col], F.lit(False))
    if rule == "decimal_range":
        p, s = r.decimals[col]
        return F.col(col).isNotNull() & F.expr(f"try_cast({col} AS decimal({p},{s}))").isNull()
    raise ValueError(rule)


def row_checks(table: str, columns: list[str]) -> list[tuple[str, str, Column]]:
    """(rule, column, failing predicate) for the row-local rules in ``columns``."""
    return [(rule, col, failing(table, rule, col)) for rule, col in row_rules(table, columns)]


def violations(df: DataFrame, table: str, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """V1-V6: every violation as (table_name, rule, column_name, key, detail).

    ``parents`` maps parent table names to their DataFrames for the foreign
    keys to check (absent parents are skipped)."""
    parents = parents or {}
    spark = df.sparkSession
    frames = []
    key = _key_text(table, df.columns)
    for rule, col, bad in row_checks(table, df.columns):
        frames.append(df.where(bad).select(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(col).alias("column_name"),
            key.alias("key"), F.col(col).cast("string").alias("detail")))
    r = RULES[table]
    if r.primary_key and set(r.primary_key) <= set(df.columns):
        frames.append(_duplicates(df, table, list(r.primary_key), "primary_key_unique"))
    for c in r.unique:
        if c in df.columns:
            frames.append(_duplicates(df, table, [c], "unique"))
    for fk in foreign_keys_of(table):
        if fk.parent in parents and fk.column in df.columns:
            pkeys = written(parents[fk.parent].select(F.col(fk.parent_column).alias("_pk")).distinct())
            orphans = (df.where(F.col(fk.column).isNotNull())
                       .join(pkeys, df[fk.column] == pkeys["_pk"], "left_anti"))
            frames.append(orphans.select(
                F.lit(table).alias("table_name"), F.lit(f"foreign_key:{fk.parent}").alias("rule"),
                F.lit(fk.column).alias("column_name"), key.alias("key"),
                F.col(fk.column).cast("string").alias("detail")))
    if not frames:
        return spark.createDataFrame([], VIOLATION_SCHEMA)
    return reduce(DataFrame.unionByName, frames)


def _duplicates(df: DataFrame, table: str, cols: list[str], rule: str) -> DataFrame:
    """One row per duplicated value (NULLs never collide), detail = count."""
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (df.where(cond).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1)
            .select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
                    F.lit(",".join(cols)).alias("column_name"),
                    F.concat_ws(",", *[F.col(c).cast("string") for c in cols]).alias("key"),
                    F.col("_n").cast("string").alias("detail")))


class Validated(NamedTuple):
    good: DataFrame
    quarantine: DataFrame


def validate(df: DataFrame, table: str, parents: dict[str, DataFrame] | None = None,
             existing: DataFrame | None = None, unique: bool = True) -> Validated:
    """Split rows into good and quarantined (with a ``reason`` text) in one pass.

    Row-local rules are one projection; each foreign key adds a left join with
    the distinct parent keys; duplicate keys (within ``df`` and, if given,
    against ``existing`` rows of the table) add an aggregation joined back,
    unless ``unique`` is off."""
    parents = parents or {}
    reasons = [F.when(bad, F.lit(f"{rule}({col})")) for rule, col, bad in row_checks(table, df.columns)]
    x = df
    for i, fk in enumerate(foreign_keys_of(table)):
        if fk.parent in parents and fk.column in df.columns:
            pk = written(parents[fk.parent].select(F.col(fk.parent_column).alias(f"_fk{i}")).distinct())
            x = x.join(pk.withColumn(f"_fk{i}_hit", F.lit(True)), x[fk.column] == pk[f"_fk{i}"], "left")
            reasons.append(F.when(F.col(fk.column).isNotNull() & F.col(f"_fk{i}_hit").isNull(),
                                  F.lit(f"foreign_key({fk.column})")))
    r = RULES[table]
    uniques = ([list(r.primary_key)] if r.primary_key else []) + [[c] for c in r.unique]
    for j, cols in enumerate(uniques if unique else []):
        if not all(c in df.columns for c in cols):
            continue
        counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(f"_u{j}"))
        if existing is not None:
            counts = (counts.unionByName(existing.groupBy(*cols).agg(F.count(F.lit(1)).alias(f"_u{j}")))
                      .groupBy(*cols).agg(F.sum(f"_u{j}").alias(f"_u{j}")))
        x = x.join(written(counts.where(F.col(f"_u{j}") > 1)), cols, "left")
        reasons.append(F.when(F.col(f"_u{j}").isNotNull(), F.lit(f"duplicate({','.join(cols)})")))
    x = x.withColumn("_why", F.filter(F.array(*reasons), lambda v: v.isNotNull()))
    good = x.where(F.size("_why") == 0).select(*df.columns)
    quarantine = x.where(F.size("_why") > 0).select(*df.columns, F.array_join("_why", "; ").alias("reason"))
    return Validated(good, quarantine)


def apply_defaults(df: DataFrame, table: str, as_of: dt.date | dt.datetime) -> DataFrame:
    """V7: add absent DEFAULT columns (CURRENT_DATE / CURRENT_TIMESTAMP taken
    from ``as_of``) and put the columns in declared order.  An explicit NULL
    stays NULL (NOT NULL then flags it)."""
    schema = SCHEMAS[table]
    for col, kind in RULES[table].defaults.items():
        if col not in df.columns:
            value = as_of if kind == "current_timestamp" else (
                as_of.date() if isinstance(as_of, dt.datetime) else as_of)
            df = df.withColumn(col, F.lit(value).cast(schema[col].dataType))
    present = [f.name for f in schema if f.name in df.columns]
    return df.select(*present, *[c for c in df.columns if c not in present])


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, rule, column_name, violations: one count per declared rule
    and table (zero counts included).

    All row-local rules and foreign keys of a table are counted in ONE pass
    (left joins with the distinct parent keys, one aggregation, unpivoted);
    each key / UNIQUE rule is one partial aggregation."""
    frames = []
    known: dict[tuple[str, str], DataFrame] = {}  # a parent's keys are written once
    for t, df in tables.items():
        if t not in RULES:
            continue
        checks = row_checks(t, df.columns)
        marked = df
        for i, fk in enumerate(foreign_keys_of(t)):
            if fk.parent in tables and fk.column in df.columns:
                if (fk.parent, fk.parent_column) not in known:
                    known[fk.parent, fk.parent_column] = written(
                        tables[fk.parent].select(F.col(fk.parent_column).alias("_p")).distinct())
                parent = known[fk.parent, fk.parent_column].select(
                    F.col("_p").alias(f"_p{i}"), F.lit(True).alias(f"_there{i}"))
                marked = marked.join(parent, marked[fk.column] == parent[f"_p{i}"], "left")
                checks.append((f"foreign_key:{fk.parent}", fk.column,
                               F.col(fk.column).isNotNull() & F.col(f"_there{i}").isNull()))
        if checks:
            sums = marked.agg(*[F.count(F.when(bad, 1)).alias(f"_c{i}") for i, (_, _, bad) in enumerate(checks)])
            cells = [F.struct(F.lit(t).alias("table_name"), F.lit(rule).alias("rule"),
                              F.lit(col).alias("column_name"), F.col(f"_c{i}").alias("violations"))
                     for i, (rule, col, _) in enumerate(checks)]
            frames.append(sums.select(F.explode(F.array(*cells)).alias("_r")).select("_r.*"))
        r = RULES[t]
        has_key = r.primary_key and set(r.primary_key) <= set(df.columns)
        keyed = ([("primary_key_unique", list(r.primary_key))] if has_key else []) + \
                [("unique", [c]) for c in r.unique if c in df.columns]
        for rule, cols in keyed:
            frames.append(_duplicates(df, t, cols, rule).agg(F.count(F.lit(1)).alias("violations"))
                          .select(F.lit(t).alias("table_name"), F.lit(rule).alias("rule"),
                                  F.lit(",".join(cols)).alias("column_name"), "violations"))
    return reduce(DataFrame.unionByName, frames)


def declared_rules(table: str, columns: list[str], parents: set[str]) -> list[tuple[str, str]]:
    r = RULES[table]
    out = row_rules(table, columns)
    if r.primary_key and set(r.primary_key) <= set(columns):
        out.append(("primary_key_unique", ",".join(r.primary_key)))
    out += [("unique", c) for c in r.unique if c in columns]
    out += [(f"foreign_key:{fk.parent}", fk.column) for fk in foreign_keys_of(table)
            if fk.parent in parents and fk.column in columns]
    return out

"""Data changes as snapshot-to-snapshot functions.

Parquet tables cannot be updated in place, so every change takes DataFrames
and returns new DataFrames (plus reports); :mod:`mercantile.sources.tables`
writes a new snapshot version.  One call is one statement: if a statement
would break a rule, ``atomic`` operators return the input unchanged, decided
by a one-row scalar subquery rather than a driver round trip.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keybits
from ..functions.claims import first_come
from ..functions.keys import dense_keys
from ..functions.scalar import scale
from ..schemas import RULES, SCHEMAS, TABLE_ORDER, foreign_keys_of
from ..session import ensure_checkpoint_dir

# ---------------------------------------------------------------- updates


def uplift(df: DataFrame, predicate: Column, col: str, factor: str | Decimal,
           precision: int = 10) -> DataFrame:
    """M1 / M3: ``UPDATE t SET col = col * factor WHERE predicate``.

    The product is exact and stored back into DECIMAL(precision, 2), rounding
    half away from zero; an overflow raises (ANSI).  Running it twice
    compounds, as in SQL."""
    return df.withColumn(col, F.when(predicate, scale(col, factor, precision)).otherwise(F.col(col)))


def backfill(df: DataFrame, patch: DataFrame, key: str, col: str, value: str | None = None) -> DataFrame:
    """M2: ``UPDATE t SET col = v WHERE key = k AND col IS NULL`` for every
    (k, v) of ``patch``.  Duplicate patch keys take the largest value."""
    value = value or col
    p = patch.groupBy(key).agg(F.max(value).alias("_patch"))
    out_type = df.schema[col].dataType
    return (df.join(p, key, "left")
            .withColumn(col, F.coalesce(F.col(col), F.col("_patch").cast(out_type)))
            .drop("_patch").select(*df.columns))


class Deltas(NamedTuple):
    table: DataFrame
    refused: DataFrame


def add_deltas(df: DataFrame, deltas: DataFrame, key: str = "product_id", col: str = "stock",
               delta: str = "quantity", atomic: bool = True) -> Deltas:
    """``col = col + sum(delta)`` per key (all shipments of a
    product are summed; unknown keys change nothing).

    A result below zero breaks ``CHECK (col >= 0)``: with ``atomic`` the whole
    statement is refused (no row changes), else only the offending keys keep
    their old value.  ``refused`` lists the offending keys."""
    d = deltas.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(delta).alias("_delta"))
    j = df.join(d, key, "left")
    new_val = (F.col(col) + F.coalesce(F.col("_delta"), F.lit(0))).cast(df.schema[col].dataType)
    bad = F.coalesce(new_val < 0, F.lit(False))
    refused = j.where(bad).select(key, F.col(col).alias("old_value"), F.col("_delta").alias("delta"))
    if atomic:
        ok = refused.select(F.count(F.lit(1)) == 0).scalar()
        keep_old = ~ok
    else:
        keep_old = bad
    table = j.withColumn(col, F.when(keep_old, F.col(col)).otherwise(new_val)).select(*df.columns)
    return Deltas(table, refused)


def add_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """``ALTER TABLE ADD COLUMN IF NOT EXISTS`` (NULL for old rows)."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(data_type))


def truncate(df: DataFrame) -> DataFrame:
    """Same schema, no rows (folded to an empty relation, nothing read)."""
    return df.where(F.lit(False))


class Upsert(NamedTuple):
    table: DataFrame
    applied: DataFrame
    rejected: DataFrame


def update_by_key(df: DataFrame, patch: DataFrame, key: str, table: str | None = None) -> Upsert:
    """Full overwrite of the patch's columns for matching keys; unknown
    keys change nothing and hinder nobody; a NULL in the patch is a value.  Patch rows whose
    key occurs more than once are rejected (which one would win is unknown),
    and with ``table`` so are rows whose new values break that table's
    row rules (NOT NULL, CHECK, lengths)."""
    from .quality import row_checks
    cols = [c for c in patch.columns if c != key]
    patch = patch.join(df.select(key), key, "left_semi")
    counted = patch.join(patch.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), key, "inner")
    bad = F.col("_n") > 1
    if table is not None:
        for _, _, failing in row_checks(table, cols):
            bad = bad | failing
    rejected = counted.where(bad).drop("_n")
    good = counted.where(~bad).drop("_n")
    if table is not None:
        clashes = []
        for u in RULES[table].unique:
            if u in cols:
                mine = good.where(F.col(u).isNotNull()).select(key, F.col(u).alias("_v"))
                held = df.where(F.col(u).isNotNull()).select(F.col(key).alias("_k"), F.col(u).alias("_v"))
                clashes.append(mine.join(held, "_v").where(F.col("_k") != F.col(key)).select(key))
                twice = mine.groupBy("_v").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                clashes.append(mine.join(twice, "_v", "left_semi").select(key))
        if clashes:
            clash = reduce(DataFrame.unionByName, clashes).distinct()
            rejected = rejected.unionByName(good.join(clash, key, "left_semi"))
            good = good.join(clash, key, "left_anti")
    p = good.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_p_{c}") for c in cols])
    j = df.join(p, key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = j.select(*[
        F.when(hit, F.col(f"_p_{c}").cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in cols else F.col(c) for c in df.columns])
    return Upsert(out, good, rejected)


# ---------------------------------------------------------------- deletes


class Deletion(NamedTuple):
    tables: dict[str, DataFrame]
    counts: DataFrame
    violations: DataFrame


def _key_frame(keys: DataFrame) -> DataFrame:
    return keys.select(F.col(keys.columns[0]).alias("_dk")).where(F.col("_dk").isNotNull()).distinct()


class _Gone(NamedTuple):
    """Deleted keys of a table, written, and their bitmaps."""
    keys: DataFrame
    bits: keybits.KeyBits


def _gone(keys: DataFrame) -> _Gone:
    keys = keys.checkpoint(eager=True)
    return _Gone(keys, keybits.key_bits(keys, "_dk"))


def _pointing(df: DataFrame, column: str, gone: _Gone) -> DataFrame:
    """Rows whose column holds a deleted key."""
    _, rest = keybits.split(df, [(column, gone.bits)])
    return rest.join(gone.keys, rest[column] == gone.keys["_dk"], "left_semi")


def delete_rows(tables: dict[str, DataFrame], root: str, keys: DataFrame,
                enforce: bool = True) -> Deletion:
    """M5-M9: ``DELETE FROM root WHERE pk IN keys`` with the ON DELETE rules.

    Walks the fixed foreign-key graph parents-first: CASCADE deletes child
    rows (anti join on the deleted parent keys), SET NULL clears the child
    column (left join with the keys), NO ACTION reports child rows still
    pointing at a deleted key.  Any violation refuses the statement: with
    ``enforce`` the input tables come back unchanged.  Only tables present in
    ``tables`` take part.  Key sets are distinct, so a hot parent key is one
    row on the build side.  Only rows that pass a bitmap of the deleted keys
    (``functions.keybits``) go to these joins; all others stay where they are."""
    pk = RULES[root].primary_key[0]
    ensure_checkpoint_dir(keys.sparkSession)
    # Every deleted-key set feeds several joins (children, SET NULL, NO
    # ACTION, counts): materialise each once in the checkpoint folder.
    deleted: dict[str, _Gone] = {root: _gone(_key_frame(keys))}
    new = dict(tables)
    hits: dict[str, list[tuple[str, _Gone]]] = {root: [(pk, deleted[root])]}
    for t in TABLE_ORDER:
        if t not in tables:
            continue
        df = tables[t]
        parts = []
        for fk in foreign_keys_of(t):
            if fk.on_delete == "CASCADE" and fk.parent in deleted:
                gone = deleted[fk.parent]
                hits.setdefault(t, []).append((fk.column, gone))
                if t != root and RULES[t].primary_key and any(f.parent == t for f in _all_fks()):
                    parts.append(_pointing(df, fk.column, gone).select(F.col(RULES[t].primary_key[0]).alias("_dk")))
        if parts:
            deleted[t] = _gone(reduce(DataFrame.union, parts).distinct())
        if t in hits:
            clear, rest = keybits.split(df, [(c, gone.bits) for c, gone in hits[t]])
            for column, gone in hits[t]:
                rest = rest.join(gone.keys, rest[column] == gone.keys["_dk"], "left_anti")
            new[t] = clear.unionByName(rest)
    nulled: dict[str, DataFrame] = {}
    violations = []
    for t in TABLE_ORDER:
        if t not in tables:
            continue
        for fk in foreign_keys_of(t):
            if fk.parent not in deleted:
                continue
            gone = deleted[fk.parent]
            if fk.on_delete == "SET NULL":
                pre = new[t]
                lost = _pointing(pre, fk.column, gone)
                nulled[t] = lost if t not in nulled else nulled[t].unionByName(lost).distinct()
                hit = gone.keys.select(F.col("_dk"), F.lit(True).alias("_hit"))
                clear, rest = keybits.split(pre, [(fk.column, gone.bits)])
                j = rest.join(hit, rest[fk.column] == hit["_dk"], "left")
                flag = F.coalesce(F.col("_hit"), F.lit(False))
                new[t] = clear.unionByName(j.select(*[
                    F.when(flag, F.lit(None).cast(tables[t].schema[c].dataType)).otherwise(F.col(c)).alias(c)
                    if c == fk.column else F.col(c) for c in tables[t].columns]))
            elif fk.on_delete == "NO ACTION":
                v = (_pointing(new[t], fk.column, gone)
                     .groupBy(F.col(fk.column).cast("string").alias("key"))
                     .agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(t).alias("table_name"), F.lit(fk.column).alias("column_name"),
                             F.lit(fk.parent).alias("parent"), "key", "rows"))
                violations.append(v)
    spark = next(iter(tables.values())).sparkSession
    viol = (reduce(DataFrame.unionByName, violations) if violations
            else spark.createDataFrame([], "table_name string, column_name string, parent string, "
                                           "key string, rows bigint"))
    if enforce and violations and not viol.isEmpty():
        new = dict(tables)
        nulled, hits = {}, {}
    return Deletion(new, _deletion_counts(tables, hits, nulled), viol)


def _deletion_counts(tables: dict[str, DataFrame], hits: dict[str, list[tuple[str, _Gone]]],
                     nulled: dict[str, DataFrame]) -> DataFrame:
    """The report of :func:`change_counts` for a deletion: one pass per table
    counts its rows and those that point at a deleted key."""
    frames = []
    for t, df in tables.items():
        # One pass: rows are counted by the keys that may be deleted (all others
        # together), and only these counts meet the deleted keys.
        flagged, by, hit = df.select(*{c for c, _ in hits.get(t, [])}), [], F.lit(False)
        for i, (column, gone) in enumerate(hits.get(t, [])):
            flagged = keybits.with_flag(flagged, column, gone.bits, f"_maybe{i}")
            by.append(F.when(F.col(f"_maybe{i}"), F.col(column)).alias(f"_c{i}"))
        marked = flagged.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        for i, (column, gone) in enumerate(hits.get(t, [])):
            keys = gone.keys.select(F.col("_dk").alias(f"_k{i}"), F.lit(True).alias(f"_h{i}"))
            marked = marked.join(keys, F.col(f"_c{i}") == F.col(f"_k{i}"), "left")
            hit = hit | F.coalesce(F.col(f"_h{i}"), F.lit(False))
        total = lambda n: F.coalesce(F.sum(n), F.lit(0)).cast("bigint")
        row = marked.agg(total("_n").alias("rows_before"), total(F.when(hit, F.col("_n"))).alias("rows_deleted"))
        lost = (nulled[t].agg(F.count(F.lit(1))).scalar() if t in nulled else F.lit(0).cast("bigint"))
        frames.append(row.select(F.lit(t).alias("table_name"), "rows_before",
                                 (F.col("rows_before") - F.col("rows_deleted")).alias("rows_after"), "rows_deleted",
                                 lost.alias("rows_nulled")))
    return reduce(DataFrame.unionByName, frames)


def _all_fks():
    from ..schemas import FOREIGN_KEYS
    return FOREIGN_KEYS


def change_counts(before: dict[str, DataFrame], after: dict[str, DataFrame],
                  nulled: dict[str, DataFrame] | None = None) -> DataFrame:
    """Q19: table_name, rows_before, rows_after, rows_deleted, rows_nulled —
    one small aggregate per table, unioned (no driver round trips)."""
    nulled = nulled or {}
    frames = []
    for t in before:
        b = before[t].agg(F.count(F.lit(1)).alias("rows_before"))
        a = after[t].agg(F.count(F.lit(1)).alias("rows_after"))
        n = (nulled[t].agg(F.count(F.lit(1)).alias("rows_nulled")) if t in nulled
             else None)
        row = b.select(F.lit(t).alias("table_name"), "rows_before",
                       a.select("rows_after").scalar().alias("rows_after"),
                       (n.select("rows_nulled").scalar() if n is not None
                        else F.lit(0).cast("bigint")).alias("rows_nulled"))
        frames.append(row)
    out = reduce(DataFrame.unionByName, frames)
    return out.select("table_name", "rows_before", "rows_after",
                      (F.col("rows_before") - F.col("rows_after")).alias("rows_deleted"), "rows_nulled")


class Refusal(NamedTuple):
    tables: dict[str, DataFrame]
    blocked: DataFrame
    counts: DataFrame


# Fixed value: the refusal message of the customer delete procedure.
HAS_ORDERS = "Customer cannot be deleted because they have existing orders."


def delete_customers(tables: dict[str, DataFrame], ids: DataFrame,
                     blocking: Column | None = None) -> Refusal:
    """Delete each requested customer unless an order blocks it.

    M14a: any order blocks.  M14b: only orders matching ``blocking`` (e.g.
    ``order_status != 'F'``; a NULL status does not block) — the customer's
    other orders then go by CASCADE."""
    orders = tables["orders"]
    blockers = (orders if blocking is None else orders.where(blocking)).select("customer_id")
    req = _key_frame(ids).withColumnRenamed("_dk", "customer_id")
    blocked = req.join(blockers, "customer_id", "left_semi").withColumn("reason", F.lit(HAS_ORDERS))
    allowed = req.join(blockers, "customer_id", "left_anti")
    res = delete_rows(tables, "customers", allowed)
    return Refusal(res.tables, blocked, res.counts)


class Audited(NamedTuple):
    tables: dict[str, DataFrame]
    audit: DataFrame
    counts: DataFrame


def delete_employees(tables: dict[str, DataFrame], ids: DataFrame,
                     deleted_at: dt.datetime) -> Audited:
    """Delete employees, copying each old row (with its original
    manager_id) to employee_audit with a new audit_id and ``deleted_at``;
    subordinates and stores lose the reference by SET NULL."""
    emp = tables["employees"]
    req = _key_frame(ids)
    gone = emp.join(req, emp["employee_id"] == req["_dk"], "left_semi")
    audit_cols = [f.name for f in SCHEMAS["employee_audit"] if f.name not in ("audit_id", "deleted_at")]
    existing = tables.get("employee_audit")
    start = existing.select(F.max("audit_id")).scalar() if existing is not None else 0
    rows = dense_keys(gone.select(*audit_cols), ["employee_id"], start=start, out="audit_id")
    rows = rows.withColumn("deleted_at", F.lit(deleted_at).cast("timestamp_ntz")).select(
        *SCHEMAS["employee_audit"].fieldNames())
    res = delete_rows({k: v for k, v in tables.items() if k != "employee_audit"}, "employees", req)
    out = dict(res.tables)
    out["employee_audit"] = existing.unionByName(rows) if existing is not None else rows
    return Audited(out, rows, res.counts)


# ---------------------------------------------------------------- inserts


class Added(NamedTuple):
    table: DataFrame
    added: DataFrame
    rejected: DataFrame


def add_customers(customers: DataFrame, batch: DataFrame, order_by: list[str]) -> Added:
    """Bulk ``sp_AddCustomer``, as if called once per row in ``order_by``
    order: NOT NULL, length and UNIQUE(email), UNIQUE(phone) hold against the
    table and against the rows accepted before; a refused row takes nothing, so
    a later one may have its email or phone.  New keys continue after the
    current maximum (dense, no global window)."""
    ensure_checkpoint_dir(customers.sparkSession)
    rules = RULES["customers"]
    cols = ["name", "email", "phone", "city"]
    reasons = []
    for c in rules.not_null:
        reasons.append(F.when(F.col(c).isNull(), F.lit(f"{c} is null")))
    for c, n in rules.max_length.items():
        reasons.append(F.when(F.length(c) > n, F.lit(f"{c} longer than {n}")))
    b = dense_keys(batch, list(dict.fromkeys([*order_by, *cols])), out="_nth")
    for u in rules.unique:
        # The batch prunes the table before anything of it is shuffled.
        taken = (customers.join(b.select(u).distinct(), u, "left_semi")
                 .select(F.col(u).alias(f"_taken_{u}")).distinct())
        b = b.join(taken, b[u] == taken[f"_taken_{u}"], "left")
        reasons.append(F.when(F.col(f"_taken_{u}").isNotNull(), F.lit(f"{u} already used")))
    b = (b.withColumn("_why", F.filter(F.array(*reasons), lambda x: x.isNotNull()))
         .select(*batch.columns, "_nth", "_why").checkpoint(eager=True))
    sound = b.where(F.size("_why") == 0)
    claims = reduce(DataFrame.unionByName, [
        sound.where(F.col(u).isNotNull()).select("_nth", F.lit(u).alias("_rule"), F.col(u).cast("string").alias("_value"))
        for u in rules.unique])
    b = b.join(first_come(claims, "_nth"), "_nth", "left").withColumn("_why", F.concat("_why", F.coalesce(
        F.transform("_rules", lambda u: F.concat(u, F.lit(" repeated in batch"))), F.array().cast("array<string>"))))
    extra = [c for c in batch.columns if c not in cols]
    rejected = b.where(F.size("_why") > 0).select(*batch.columns, F.array_join("_why", "; ").alias("reason"))
    good = b.where(F.size("_why") == 0).select("_nth", *cols, *extra)
    start = customers.select(F.max("customer_id")).scalar()
    added = dense_keys(good, ["_nth"], start=start, out="customer_id").select("customer_id", *cols)
    return Added(customers.unionByName(added.select(*customers.columns)), added, rejected)


# ---------------------------------------------------------------- reports


def change_report(before: DataFrame, after: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Q18: key, old_<c>, new_<c> for rows present in both snapshots where
    any of ``cols`` changed (NULL-safe comparison)."""
    b = before.select(key, *[F.col(c).alias(f"old_{c}") for c in cols])
    a = after.select(key, *[F.col(c).alias(f"new_{c}") for c in cols])
    changed = reduce(lambda x, y: x | y, [~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in cols])
    return b.join(a, key, "inner").where(changed)

"""File ingest with the reference's all-or-nothing rule per file.

One file is one transaction, and files are taken in path order: a row that
cannot be parsed, breaks a rule of the target table or repeats a key of an
earlier accepted file sends the whole file to quarantine.  Columns are mapped
by the file's header; absent DEFAULT columns are filled.  Rules run set-wise
(:func:`mercantile.operators.quality.validate`); no row reaches the driver.
"""

from __future__ import annotations

import csv
import datetime as dt
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.claims import first_come
from ..operators.quality import validate
from ..schemas import RULES, SCHEMAS
from ..session import ensure_checkpoint_dir, written
from .csv_blocks import csv_records
from .export import CSV_FORMAT
from .workbook import read_workbooks, typed


def _mapped(names: list[str], found: list[str]):
    """A parsed record's fields by name, with what is wrong and what is absent."""
    absent = ",".join(n for n in names if n not in found)
    return lambda r: F.struct(
        *[(r[n] if n in found else F.lit(None).cast("string")).alias(n) for n in names],
        F.when(r["_corrupt"].isNotNull() | ~F.col("whole"), F.lit("malformed line")).alias("_problem"),
        F.lit(absent).alias("_absent"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: CSV files with a header row, columns mapped by name, typed by
    ``schema``; doubled quotes and quoted line breaks as in RFC 4180.  A large
    file is read by many tasks (:mod:`mercantile.sources.csv_blocks`).

    Fields are read as text and cast with ``try_cast``, so a bad value names
    its column instead of nulling the row.  Extra columns: ``_file``, ``_row``
    (None), ``_absent`` (columns the file does not have) and ``_problem``
    (malformed line, bad value, or a header with unknown or repeated names,
    which makes the file one problem row)."""
    ensure_checkpoint_dir(spark)
    names = schema.fieldNames()
    records = csv_records(spark, path)
    headers = [r[0] for r in records.select("layout").distinct().collect()]  # different headers, not files
    fields = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_problem", "_absent"]])
    parsed, wrong = F.lit(None).cast(fields), F.lit(None).cast("string")
    for header in headers:
        here = F.col("layout") == header
        found = [h.strip() for h in next(csv.reader([header]), [])]
        unknown = sorted({h for h in found if h not in names or found.count(h) > 1})
        if unknown:
            wrong = F.when(here, F.lit(f"unknown columns {unknown}")).otherwise(wrong)
            continue
        layout = T.StructType([T.StructField(h, T.StringType()) for h in [*found, "_corrupt"]])
        row = F.from_csv("record", layout.toDDL(), CSV_FORMAT | {"header": "false", "mode": "PERMISSIVE",
                                                                 "columnNameOfCorruptRecord": "_corrupt"})
        row = F.transform(F.array(row), _mapped(names, found))[0]  # transform binds the parsed record once
        parsed = F.when(here, row.cast(fields)).otherwise(parsed)
    rows = records.withColumn("_wrong", wrong)
    good = (rows.where(F.col("_wrong").isNull() & ~F.col("head")).withColumn("r", parsed)
            .select(*[F.col(f"r.{n}") for n in names], F.col("file").alias("_file"), F.lit(None).cast("long").alias("_row"),
                    F.col("r._problem").alias("_problem"), F.col("r._absent").alias("_absent")))
    bad = (rows.where(F.col("_wrong").isNotNull()).groupBy("file").agg(F.first("_wrong").alias("_problem"))
           .select(*[F.lit(None).cast("string").alias(n) for n in names], F.col("file").alias("_file"),
                   F.lit(None).cast("long").alias("_row"), "_problem", F.lit("").alias("_absent")))
    return typed(good.unionByName(bad), schema)


class Ingested(NamedTuple):
    accepted: DataFrame
    quarantine: DataFrame
    bad_files: DataFrame


def ingest(spark: SparkSession, path: str, table: str, fmt: str = "csv",
           parents: dict[str, DataFrame] | None = None, existing: DataFrame | None = None,
           keep_source: bool = False, as_of: dt.date | None = None) -> Ingested:
    """Read a folder of CSV files or workbooks into ``table``'s schema,
    check its rules, and keep only files without a single bad row
    (``keep_source`` keeps the ``_file`` column on the accepted rows).
    ``as_of`` is the value of DEFAULT columns that a file does not have."""
    ensure_checkpoint_dir(spark)
    schema = SCHEMAS[table]
    fmt = fmt.lower()
    if fmt == "csv":
        raw = read_csv(spark, path, schema)
    elif fmt in ("xlsx", "workbook"):
        raw = read_workbooks(spark, path, schema)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    today = F.lit(as_of) if as_of is not None else F.current_date()
    for c in RULES[table].defaults:
        if c in schema.fieldNames():
            lacks = F.array_contains(F.split("_absent", ","), c) & F.col("_problem").isNull()
            raw = raw.withColumn(c, F.when(lacks, today.cast(schema[c].dataType)).otherwise(F.col(c)))
    # Rules, keys and files all look at the parsed rows: read the files once.
    raw = raw.drop("_absent").checkpoint(eager=True)
    parsed = raw.where(F.col("_problem").isNull())
    checked = validate(parsed.drop("_problem"), table, parents, unique=False)
    names = schema.fieldNames()
    bad_rows = (raw.where(F.col("_problem").isNotNull())
                .select(*names, "_file", "_row", F.col("_problem").alias("reason"))
                .unionByName(checked.quarantine.select(*names, "_file", "_row", "reason")))
    bad_files = bad_rows.groupBy("_file").agg(F.count(F.lit(1)).alias("bad_rows"),
                                              F.min("reason").alias("first_reason")).checkpoint(eager=True)
    # File names are no more than the driver's own listing of the folder.  A join
    # by file would send all rows of a file to one task, and the steps after it too.
    clean = checked.good.join(F.broadcast(bad_files.select("_file")), "_file", "left_anti")
    repeats = _repeated_keys(clean, table, existing)
    bad_files = bad_files.unionByName(repeats)
    accepted = checked.good.join(F.broadcast(bad_files.select("_file")), "_file", "left_anti")
    held = checked.good.join(F.broadcast(bad_files.select("_file", F.col("first_reason").alias("_why"))), "_file")
    held = held.withColumn("reason", F.when(F.col("_why").startswith("duplicate"), F.col("_why"))
                           .otherwise(F.lit("file has bad rows")))
    quarantine = bad_rows.unionByName(held.select(*bad_rows.columns))
    keep = [*names, "_file"] if keep_source else names
    return Ingested(accepted.select(*keep), quarantine, bad_files)


def _repeated_keys(rows: DataFrame, table: str, existing: DataFrame | None) -> DataFrame:
    """Files refused because a key (or UNIQUE value) is in the table already,
    twice in the file, or in an earlier accepted file: _file, bad_rows,
    first_reason.

    Files come one by one in path order (:func:`first_come`).  Most values are
    held once; only those whose hash comes again are looked at file by file."""
    r = RULES[table]
    uniques = [c for c in [list(r.primary_key), *[[u] for u in r.unique]]
               if c and all(x in rows.columns for x in c)]
    out = rows.sparkSession.createDataFrame([], "_file string, bad_rows long, first_reason string")
    if not uniques:
        return out
    values = lambda df, *more: reduce(DataFrame.unionByName, [
        df.where(reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in c]))
        .select(*more, F.lit(",".join(c)).alias("_rule"), F.to_json(F.struct(*c)).alias("_value")) for c in uniques])
    hashed = F.xxhash64("_rule", "_value").alias("_h")
    hashes = reduce(DataFrame.unionByName, [values(df).select(hashed) for df in (rows, existing) if df is not None])
    # Written before the join, so that the join may split a hot value.
    again = written(hashes.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h"))
    if again.isEmpty():
        return out
    suspects = values(rows, "_file").select("*", hashed).join(again, "_h", "left_semi")
    held = suspects.groupBy("_file", "_rule", "_value").agg(F.count(F.lit(1)).alias("_n"))
    held = held.withColumn("_old", F.lit(False))
    if existing is not None:
        old = values(existing).distinct().withColumn("_there", F.lit(True))
        held = (held.join(old, ["_rule", "_value"], "left")
                .withColumn("_old", F.col("_there").isNotNull()).drop("_there"))
    held = held.checkpoint(eager=True)
    reason = F.concat(F.lit("duplicate("), F.col("_rule"), F.lit(")")).alias("reason")
    mine = F.when(F.col("_old"), F.col("_n")).otherwise(F.col("_n") - 1).alias("n")
    refused = [held.where((F.col("_n") > 1) | F.col("_old")).select("_file", mine, reason)
               .groupBy("_file").agg(F.sum("n").alias("bad_rows"), F.min("reason").alias("first_reason"))]
    open_ = held.join(F.broadcast(refused[0].select("_file")), "_file", "left_anti")
    lost = first_come(open_, "_file", few_units=True).select(
        "_file", F.size("_rules").cast("long").alias("bad_rows"),
        F.concat(F.lit("duplicate("), F.get("_rules", F.lit(0)), F.lit(")")).alias("first_reason"))
    return reduce(DataFrame.unionByName, [*refused, lost], out)


def load_order_lines(spark: SparkSession, path: str, products: DataFrame, fmt: str = "xlsx",
                     parents: dict[str, DataFrame] | None = None):
    """The ingest-with-trigger path (E2): every file of order lines is one
    transaction.  Files with a bad row are quarantined by :func:`ingest`; the
    rest are admitted file by file in path order against product stock
    (:func:`mercantile.operators.admission.admit_loads`).  Returns
    (ingested, admission)."""
    from ..operators.admission import admit_loads
    got = ingest(spark, path, "order_items", fmt, parents, keep_source=True)
    return got, admit_loads(got.accepted, products, "_file")

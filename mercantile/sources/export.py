"""Report export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .workbook import write_workbooks

SHEET_NAME_LIMIT = 31  # of the workbook format

# Report names, file names and sheet names of the export menu.
REPORTS = {
    "monthly_revenue": ("monthly_revenue_per_store", "Store Revenue"),
    "customer_spending": ("customer_total_spending", "Customer Spending"),
}


# Header row; quotes are doubled, as spreadsheet readers expect.
CSV_FORMAT = {"header": "true", "quote": '"', "escape": '"'}


def export_csv(df: DataFrame, folder: str, order_by: Sequence[str] | None = None) -> str:
    """Header row, NULL as an empty field, rows in ``order_by`` order
    across the part files (range-partitioned sort, written in parallel;
    no single-file funnel)."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").options(**CSV_FORMAT).csv(folder)
    return folder


def export(df: DataFrame, folder: str, fmt: str, order_by: Sequence[str] | None = None,
           sheet: str = "Sheet1", partition_by: Sequence[str] | None = None) -> str | None:
    """Write a report as CSV or workbooks.  ``fmt`` is case-insensitive;
    an unknown format is refused; an empty report writes nothing (None)."""
    kind = fmt.strip().upper()
    if kind not in ("CSV", "XLSX"):
        raise ValueError(f"invalid file format {fmt!r}: choose CSV or XLSX")
    held = not df.is_cached  # computed once: for the emptiness check and the files
    if held:
        df = df.persist()
    try:
        if df.isEmpty():
            return None
        keys = list(partition_by or [])
        # Range-sorted: a hot key spans tasks, each with files of its own.
        out = df.orderBy(*keys, *(order_by or [])) if keys or order_by else df
        if kind == "CSV":
            w = out.write.mode("overwrite").options(**CSV_FORMAT)
            (w.partitionBy(*keys) if keys else w).csv(folder)
            return folder
        return write_workbooks(out, folder, sheet, per_key=keys)
    finally:
        if held:
            df.unpersist()


def export_all(reports: dict[str, DataFrame], base: str,
               formats: Sequence[str] = ("CSV", "XLSX")) -> dict[str, str | None]:
    """Every report in every format; each report is computed once
    (persisted while its files are written)."""
    written = {}
    for key, df in reports.items():
        file_stem, sheet = REPORTS.get(key, (key, key))
        if len(sheet) > SHEET_NAME_LIMIT:
            raise ValueError(f"a sheet name has at most {SHEET_NAME_LIMIT} characters: {sheet!r}")
        df = df.persist()
        try:
            for fmt in formats:
                written[f"{file_stem}.{fmt.lower()}"] = export(
                    df, f"{base}/{file_stem}.{fmt.lower()}", fmt, sheet=sheet)
        finally:
            df.unpersist()
    return written

"""Command line: run named queries and exports without writing Python.

    python -m mercantile list
    python -m mercantile run Q2 --data /root/testdata/sf0.01 [--rows 20]
    python -m mercantile export monthly_revenue --format xlsx --out /shared/exports --data ...

``run`` shows the first rows of a named query (the tasks of the original
menu: hierarchy Q3, pivot Q4, joins Q5-Q9, unions Q10/Q11, changes M*,
procedures P2_*); ``export`` writes a report in parallel as CSV or workbooks.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m mercantile")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the named queries")
    run = sub.add_parser("run", help="run a named query and show rows")
    run.add_argument("query")
    run.add_argument("--data", default="/root/testdata/sf0.01")
    run.add_argument("--rows", type=int, default=20)
    exp = sub.add_parser("export", help="export a report as CSV or XLSX")
    exp.add_argument("report", choices=["monthly_revenue", "customer_spending"])
    exp.add_argument("--format", default="CSV")
    exp.add_argument("--out", required=True)
    exp.add_argument("--data", default="/root/testdata/sf0.01")
    args = parser.parse_args(argv)

    from . import plans
    if args.cmd == "list":
        for name, fn in plans.QUERIES.items():
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{name:18s} {doc[0] if doc else ''}")
        return 0

    from .session import build_session
    spark = build_session()
    try:
        if args.cmd == "run":
            if args.query not in plans.QUERIES:
                print(f"unknown query {args.query!r}; see `list`", file=sys.stderr)
                return 2
            plans.QUERIES[args.query](spark, args.data).show(args.rows, truncate=False)
            return 0
        from . import fixtures
        from .operators import reports
        from .sources import export
        t = fixtures.load_tables(spark, args.data, ["stores", "customers", "orders"])
        if args.report == "monthly_revenue":
            df, order, sheet = reports.store_revenue(t["stores"], t["orders"], ordered=False), \
                ["total_revenue", "store_id"], "Store Revenue"
        else:
            df, order, sheet = reports.customer_spending(t["customers"], t["orders"], ordered=False), \
                ["total_spending", "customer_id"], "Customer Spending"
        written = export.export(df, args.out, args.format, order_by=order, sheet=sheet)
        print(written or "No data to export.")
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())

"""Summarise the executed physical plans of the named queries (PLANS.md).

For each query: scans with their pushed filters and read columns, join
strategies, exchanges, whole-stage codegen spans and Python nodes, taken from
the final adaptive plan after one run on the given data."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct")
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
          "FlatMapGroupsInPandasWithState", "PythonDataSource")


def summarise(plan: str) -> dict:
    # The final adaptive plan only; the initial one is printed below it.
    plan = plan.split("+- == Initial Plan ==")[0]
    joins = {}
    for j in JOINS:
        for m in re.finditer(rf"{j}(?: \[[^\]]*\], \[[^\]]*\],)? ?(\w+)?", plan):
            kind = m.group(1) or ""
            joins[f"{j} {kind}".strip()] = joins.get(f"{j} {kind}".strip(), 0) + 1
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
    return {
        "scans": len(re.findall(r"FileScan parquet|Scan ExistingRDD|Scan \\w+RDD", plan)),
        "exchanges": len(re.findall(r"\bExchange\b", plan)),
        "skew": plan.count("skew=true"),
        "reused": plan.count("ReusedExchange") + plan.count("ReusedSubquery"),
        "joins": joins,
        "codegen": len(re.findall(r"\*\(\d+\)", plan)),
        "python": sorted({p for p in PYTHON if p in plan}),
        "pushed": pushed[:4],
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or ["Q1", "Q2", "Q4", "Q8", "Q9", "Q12", "Q14", "Q15", "Q16", "Q17", "M5",
                         "M16_atomic", "V"]
    from mercantile.session import build_session
    from mercantile import plans
    spark = build_session()
    lines = ["# Executed plans (final adaptive plans)", "",
             f"Data: `{sf}`, local[{os.environ.get('BENCH_CPUS', '8')}], generated by `tools/plan_report.py`.", "",
             "| Query | scans | exchanges (reused) | joins | codegen stages | Python nodes | pushed filters (sample) |",
             "|---|---|---|---|---|---|---|"]
    for name in names:
        df = plans.QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        joins = ", ".join(f"{k} x{v}" for k, v in sorted(s["joins"].items())) or "-"
        pushed = "; ".join(f"`{p[:70]}`" for p in s["pushed"]) or "-"
        lines.append(f"| {name} | {s['scans']} | {s['exchanges']} ({s['reused']}) | {joins} | {s['codegen']} | "
                     f"{', '.join(s['python']) or '-'} | {pushed} |")
    spark.stop()
    print("\n".join(lines))


if __name__ == "__main__":
    main(sys.argv)

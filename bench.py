"""Headline-query benchmark.

Runs the named queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}

Method: every query is planned from Parquet and written to the ``noop`` sink
(a full execution without collecting to the driver); one warm-up run, then
the median of ``$BENCH_REPEAT`` timed runs (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["Q1", "Q2", "Q3", "Q4", "Q8", "Q9", "Q12", "Q14", "Q15", "Q16", "Q17",
            "M5", "M16_atomic", "M16_greedy", "V", "M16_loads", "R1", "S2", "S7"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    from mercantile.session import build_session
    from mercantile import plans

    spark = build_session()
    times: dict[str, float] = {}
    for name in wanted:
        fn = plans.QUERIES[name]

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up
        times[name] = round(statistics.median(run() for _ in range(repeat)), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
        "repeat": repeat,
    }))


if __name__ == "__main__":
    main()

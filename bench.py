"""Headline queries, median of several warm runs; prints one JSON line.

BENCH_SF_DIR   data set (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     measured runs per query after one warm-up (default 2)
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from coffer.session import build_session  # noqa: E402
from testbed.derive import landed  # noqa: E402
from testbed.queries import QUERIES  # noqa: E402

HEADLINE = (
    "deposits_pl",
    "payments_pl",
    "p_l_view",
    "budget_transformed",
    "blend_first_run",
    "blend_refresh",
    "pl_with_comments",
    "profit_by_date",
)


def run(query, spark, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "coffer-bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    data = landed(spark, sf_dir)
    # The loader's part: raw tables, sheets, the previous blend and its comments; and a first refresh.
    for step in (lambda: data.ledger, lambda: data.sheet, lambda: data.comments, lambda: data.reports):
        step()
    landing = time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, sf_dir)
        measured = [run(QUERIES[name], spark, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(measured), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds per headline query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "landing_sec": round(landing, 3),
            }
        )
    )


if __name__ == "__main__":
    main()

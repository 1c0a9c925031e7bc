"""Benchmark the panel queries on the generated tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line: ``{"metric", "value", "unit", "queries", "sf", ...}``. ``value`` is the sum of the
three headline jobs, which mirror the recorded workload (each runs its outputs fully, as the original jobs
write theirs):

* ``q1_daily_change``   -- day-on-day change per supplier in a date range (one output);
* ``q2_peak_month``     -- monthly totals and the peak month per supplier and year, for two measures
  (two outputs; the small monthly table is written once, as the job does);
* ``q3_quarter_leaders`` -- quarter rows and the top-5 of each quarter (two outputs; orders are read
  once into a written customer-month table, as the job does).

Every other registered query is timed too and listed under ``queries``. A query runs fully through the
``noop`` sink (all partitions computed, nothing collected to the driver). Each timing is the median of
``BENCH_REPEAT`` runs (default 3) after one warm-up run of every query; session start-up is reported
apart.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# same data or sink; reported next to ours for reference only.
BASELINE_PROCESS_PLUS_WRITE = {
    "q1_daily_change": 1.010 + 11.559,
    "q2_peak_month": 0.551 + 15.005,
    "q3_quarter_leaders": 0.911 + 10.585,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))

    t0 = time.perf_counter()
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelspark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(cpus * 2))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    startup = time.perf_counter() - t0

    from panelspark import session, sources
    from panelspark.jobs._common import shared
    from panelspark.operators import leaders, periods
    from panelspark.plans import driver

    session.scratch_root(spark)  # checkpoint folder: spark.checkpoint.dir, or a private one when unset

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def q2() -> None:
        # As the job runs it: the small monthly table is written once and feeds both outputs.
        totals = shared(driver.monthly_totals(spark, sf_dir))
        run(periods.peak_period(totals, ["l_suppkey", "year"], "total_quantity"))
        run(periods.peak_period(totals, ["l_suppkey", "year"], "total_price"))

    def q3() -> None:
        # As the job runs it: the (customer, year, month) table is written, so orders are read once,
        # and the quarter rows are written once for both outputs.
        orders = sources.driver_table(spark, sf_dir, "orders")
        prepared = leaders.prepare(orders, "o_custkey", "o_orderdate", "o_totalprice", "o_totalprice")
        monthly = leaders.entity_months(prepared, "o_custkey", "o_totalprice", "o_totalprice", 2, 2)
        rows = shared(leaders.quarter_peak_from_months(shared(monthly), "o_custkey", "cumulative", 2, 2, driver.ORDERS_NAMES))
        run(rows)
        run(leaders.top_n(rows, ["year", "trimester"], "customer_total", driver.TOP_N))

    jobs = {
        "q1_daily_change": lambda: run(driver.lagged_change_panel(spark, sf_dir)),
        "q2_peak_month": q2,
        "q3_quarter_leaders": q3,
    }
    for name, fn in driver.QUERIES.items():
        jobs.setdefault(name, (lambda f=fn: run(f(spark, sf_dir))))

    for fn in jobs.values():  # warm-up: JIT, file listing, metadata caches
        fn()
    times = {}
    for name, fn in jobs.items():
        samples = []
        for _ in range(repeat):
            s = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - s)
        times[name] = round(statistics.median(samples), 4)

    headline = ("q1_daily_change", "q2_peak_month", "q3_quarter_leaders")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "headline_jobs_total_sec",
        "value": round(sum(times[h] for h in headline), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
        "startup_sec": round(startup, 3),
        "baseline_process_plus_write_sec": {k: round(v, 3) for k, v in BASELINE_PROCESS_PLUS_WRITE.items()},
        "baseline_over_ours": {k: round(v / times[k], 2) for k, v in BASELINE_PROCESS_PLUS_WRITE.items()},
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()

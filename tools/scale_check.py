"""Scaling and skew check on data derived from the benchmark tables.

    python tools/scale_check.py --scratch "$(mktemp -d /tmp/run-XXXXXX)" [--src /root/testdata/sf0.1]

Writes two derived copies of ``lineitem``, ``orders`` and ``events`` below ``--scratch``:

* ``x10``: ten copies with shifted keys (10x the suppliers, customers and users), 16 files each;
* ``skew``: ``x10`` with one supplier, one customer and one user holding a third of all rows.

Then times the registered queries on those tables (noop sink, median of 3) and prints the ratios
x10 / src and skew / x10. With ``--oracle`` it also compares each query with its DuckDB oracle on the
skewed copy.
"""

from __future__ import annotations

import argparse
import os
import statistics
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = [
    "lagged_change_panel",
    "lagged_change_events",
    "monthly_totals",
    "peak_month_quantity",
    "running_entity_totals",
    "quarter_peak_rows",
    "quarter_top_customers",
]
SHIFTS = {
    "lineitem": {"l_orderkey": 10**7, "l_suppkey": 10**5},
    "orders": {"o_orderkey": 10**7, "o_custkey": 10**6},
    "events": {"event_id": 10**7, "user_id": 10**6},
}
HOT = {"lineitem": ("l_suppkey", "l_orderkey"), "orders": ("o_custkey", "o_orderkey"), "events": ("user_id", "event_id")}


def derive(spark, src: str, scratch: str) -> tuple[str, str]:
    from pyspark.sql import functions as F

    x10, skew = f"{scratch}/x10", f"{scratch}/skew"
    for name, shifts in SHIFTS.items():
        df = spark.read.parquet(f"{src}/{name}.parquet")
        copies = [df.withColumns({c: F.col(c) + F.lit(i * k) for c, k in shifts.items()}) for i in range(10)]
        reduce(lambda a, b: a.unionByName(b), copies).repartition(16).write.mode("overwrite").parquet(f"{x10}/{name}.parquet")
        key, by = HOT[name]
        hot = spark.read.parquet(f"{x10}/{name}.parquet")
        hot = hot.withColumn(key, F.when(F.col(by) % 3 == 0, F.lit(7)).otherwise(F.col(key)))
        hot.write.mode("overwrite").parquet(f"{skew}/{name}.parquet")
    return x10, skew


def timed(spark, fn, sf_dir: str, repeat: int = 3) -> float:
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    samples = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        samples.append(time.perf_counter() - t)
    return statistics.median(samples)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--scratch", required=True, help="empty folder for the derived tables")
    ap.add_argument("--src", default="/root/testdata/sf0.1")
    ap.add_argument("--oracle", action="store_true")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from panelspark.plans import driver

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    x10, skew = derive(spark, args.src, args.scratch)
    for name in QUERIES:
        fn = driver.QUERIES[name]
        base, big, hot = (timed(spark, fn, d) for d in (args.src, x10, skew))
        print(f"{name:28s} src {base:6.2f}s  x10 {big:6.2f}s ({big / base:.1f}x)  skew {hot:6.2f}s ({hot / big:.1f}x of x10)")
    spark.stop()
    if args.oracle:
        from tools import oracle_check

        return oracle_check.main(["--sf-dir", skew, *QUERIES])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

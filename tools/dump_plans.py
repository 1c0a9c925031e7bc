"""Write the physical plan of every panel query to PLANS.md.

    python tools/dump_plans.py [--sf-dir /root/testdata/sf0.01] [--out PLANS.md]

Plans are taken before execution (adaptive execution may still coalesce partitions or switch a join to
a broadcast at run time). Queries that write as part of building (round trips, timing log) are listed
by the plan of the DataFrame they return.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"))
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from panelspark.plans import driver

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = [
        "# Physical plans",
        "",
        f"Generated by `tools/dump_plans.py` on `{args.sf_dir}` (Spark {spark.version}, AQE on; plans before",
        "execution). Expression ids (`#123`) are removed.",
        "",
    ]
    for name, fn in driver.QUERIES.items():
        plan = fn(spark, args.sf_dir)._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", plan)
        plan = re.sub(r", \[plan_id=\d+\]", "", plan)
        plan = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*\]", "Location: ...", plan)
        lines += [f"## {name}", "", "```", plan.rstrip(), "```", ""]
    with open(args.out, "w") as fh:
        fh.write("\n".join(lines))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

"""Timing report: average of every numeric field of a timing log (a table or exported JSON records)."""

from __future__ import annotations

import argparse
import sys

from panelspark import sources, timings
from panelspark.jobs import _common as C
from panelspark.operators import averages
from panelspark.plans import panel_queries as Q


def main(argv=None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--json", default=None, help="exported records (array of objects)")
    p.add_argument("--root", default=None)
    p.add_argument("--format", default="parquet")
    p.add_argument("--database", default=Q.TIMING_REPORT_DATABASE, help="read <database>.Execution_Times")
    args = p.parse_args(argv)
    spark = C.start("timing_report")
    if args.json:
        # Documents: a field counts by its values, whatever it is in other documents.
        rows = averages.average_of_documents(sources.read_json_texts(spark, args.json)).orderBy("field").collect()  # a row a field
        found = {r["field"]: r["average"] for r in rows}
    else:
        root = args.root or C.session.scratch_root(spark) + "/panelspark-tables"
        log = sources.read_table(spark, root, args.database, timings.TIMING_TABLE, fmt=args.format)
        result = averages.average_numeric(log)
        found = result.first().asDict() if result is not None else {}
        if found and log.isEmpty():
            print("The log is empty.")
            return 0
    if not found:
        print("No numeric field found.")
    for name, value in found.items():
        print(f"{name}: {value}")
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Q1 job: day-on-day change of the county averages in a date range (table ``Q1_TABLE``)."""

from __future__ import annotations

import sys

from panelspark import schemas, sources
from panelspark.jobs import _common as C
from panelspark.plans import panel_queries as Q


def main(argv=None) -> int:
    p = C.parser(__doc__)
    p.add_argument("--start", default=Q.Q1_RANGE[0])
    p.add_argument("--end", default=Q.Q1_RANGE[1])
    args = p.parse_args(argv)
    timed = C.Timed(args)
    with timed.stage("load"):
        spark = C.start("Query1_daily_change", [args.input])
        county = C.load(spark, args, schemas.COUNTY_DAILY)
    with timed.stage("process"):
        result = Q.daily_change(county, args.start, args.end)
    with timed.stage("write"):
        C.write(result, spark, args, *Q.Q1_TABLE)
    timed.log(spark)
    if args.show:
        sources.read_table(spark, C.output_root(spark, args), *Q.Q1_TABLE, fmt=args.format).show(args.show)
    return 0


if __name__ == "__main__":
    sys.exit(main())

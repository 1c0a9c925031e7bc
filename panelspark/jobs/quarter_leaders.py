"""Q3 job: countries in each quarter's chosen month and the top-n of each quarter -> Query3.*."""

from __future__ import annotations

import sys

from panelspark import schemas
from panelspark.jobs import _common as C
from panelspark.plans import panel_queries as Q

def main(argv=None) -> int:
    p = C.parser(__doc__)
    p.add_argument("--top", type=int, default=Q.Q3_TOP_N)
    p.add_argument("--quarter-mode", default="cumulative", choices=["cumulative", "calendar"])
    p.add_argument("--rate-scale", type=int, default=Q.RATE_SCALE, help="sum rates exactly with this many decimals")
    args = p.parse_args(argv)
    timed = C.Timed(args)
    with timed.stage("load"):
        spark = C.start("Query3_quarter_leaders", [args.input])
        weekly = C.load(spark, args, schemas.COUNTRY_WEEKLY)
    with timed.stage("process"):
        monthly = Q.country_months(weekly, args.rate_scale)
    with timed.stage("write"):
        # One row per (country, year, month): the source is read once, and both the country and the
        # all-country month tables are derived from this checkpoint.
        rows = Q.quarter_rows_from_months(C.shared(monthly), args.quarter_mode, args.rate_scale)
        # At most (countries x quarters) rows, read by both outputs.
        rows = C.shared(rows)
        top = Q.leaders.top_n(rows, ["year", "trimester"], "country_covid_deaths", args.top)
        C.write(rows, spark, args, *Q.Q3_ROWS_TABLE)
        C.write(top, spark, args, *Q.Q3_TOP_TABLE)
    timed.log(spark)
    if args.show:
        top.show(args.show)
    return 0


if __name__ == "__main__":
    sys.exit(main())

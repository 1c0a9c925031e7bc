"""Q2 job: month with most cases and month with most deaths per state and year -> Query2.*."""

from __future__ import annotations

import sys

from panelspark import schemas
from panelspark.jobs import _common as C
from panelspark.plans import panel_queries as Q


def main(argv=None) -> int:
    args = C.parser(__doc__).parse_args(argv)
    timed = C.Timed(args)
    with timed.stage("load"):
        spark = C.start("Query2_peak_month", [args.input])
        county = C.load(spark, args, schemas.COUNTY_DAILY)
    with timed.stage("process"):
        totals = Q.state_monthly_totals(county)
    with timed.stage("write"):
        # One row per (state, year, month): small; both outputs read it, so it is computed once.
        cases, deaths = Q.peak_months(C.shared(totals))
        C.write(cases, spark, args, *Q.Q2_CASES_TABLE)
        C.write(deaths, spark, args, *Q.Q2_DEATHS_TABLE)
    timed.log(spark)
    if args.show:
        cases.show(args.show)
        deaths.show(args.show)
    return 0


if __name__ == "__main__":
    sys.exit(main())

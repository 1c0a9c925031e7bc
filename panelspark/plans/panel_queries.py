"""The composite queries on the panel tables (county daily, country weekly), as DataFrame builders.

Each returns lazy DataFrames; the ``jobs`` package runs and writes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark.operators import leaders, panel, periods

# ---------------------------------------------------------------- fixed values of the recorded workload
# Query parameters and output columns.
Q1_RANGE = ("2020-03-30", "2020-04-15")
Q1_MEASURES = ["deaths_avg", "deaths_avg_per_100k", "cases_avg", "cases_avg_per_100k"]
Q1_OUTPUT = ["date", "geoid", "cases_avg", "cases_avg_diff", "cases_avg_per_100k_diff"]
Q3_TOP_N = 5
# Output tables as (database, table); kept so readers of those tables find them.
Q1_TABLE = ("Query1", "Average_Difference")
Q2_CASES_TABLE = ("Query2", "max_cases_per_year")
Q2_DEATHS_TABLE = ("Query2", "max_deaths_per_year")
Q3_ROWS_TABLE = ("Query3", "Max_deaths_year")
Q3_TOP_TABLE = ("Query3", "Countries_Rancking")
WEEKLY_COPY_TABLE = ("Dataset", "all_weekly_excess_deaths")
COUNTY_COPY_TABLE = ("Dataset", "us-counties")
# Rows shown by the county profile, the filtered copy, and the timing log that is averaged.
COUNTY_PROFILE_KEY = ("geoid", "USA-36998")
COPY_SOURCE = ("mydatabase", "customers")
COPY_TARGET = "customers1"
COPY_FILTER = ("address", "Park Lane 38")
TIMING_REPORT_DATABASE = "Query3"
# Output columns of the quarter query.
COVID_NAMES = leaders.LeaderNames(
    quarter="trimester",
    entity_total="country_covid_deaths",
    entity_avg="avg_deaths_per100k",
    period_total="monthly_covid_deaths",
)
# Profiled table: (its copy, columns whose values are listed, columns whose distinct values are counted).
PROFILES = {
    "weekly": (WEEKLY_COPY_TABLE, ["region_code", "days", "year", "country"], ["country", "region", "region_code", "week"]),
    "county": (COUNTY_COPY_TABLE, ["year"], ["county", "state", "geoid"]),
}
# ---------------------------------------------------------------- end of fixed values

RATE_SCALE = 12  # decimal places in which rates are summed, and deaths below; no order of rows changes such sums
DEATHS_SCALE = 6


def daily_change(county: DataFrame, start=Q1_RANGE[0], end=Q1_RANGE[1]) -> DataFrame:
    """Q1: day-on-day change of the four averages per county, shown for ``[start, end]``.

    The deaths differences are defined like the others but not selected; Catalyst removes them.
    """
    out = panel.lagged_change(county, ["geoid"], ["date"], Q1_MEASURES, 3, start, end)
    return out.select(*Q1_OUTPUT)


def state_monthly_totals(county: DataFrame) -> DataFrame:
    """Q2 input: cases and deaths per (state, year, month)."""
    return periods.monthly_totals(county, ["state"], "date", {"total_cases": "cases", "total_deaths": "deaths"})


def peak_months(totals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q2: the month with most cases, and the month with most deaths, per state and year."""
    keys = ["state", "year"]
    return (
        periods.peak_period(totals, keys, "total_cases"),
        periods.peak_period(totals, keys, "total_deaths"),
    )


def country_months(weekly: DataFrame, rate_scale: int | None = RATE_SCALE) -> DataFrame:
    """Q3 input reduced to one row per (country, year, month), positive weeks only."""
    prepared = leaders.prepare(weekly, "country", "start_date", "covid_deaths", "covid_deaths_per_100k")
    return leaders.entity_months(prepared, "country", "covid_deaths", "covid_deaths_per_100k", DEATHS_SCALE, rate_scale)


def quarter_rows_from_months(monthly: DataFrame, mode: str = "cumulative", rate_scale: int | None = RATE_SCALE) -> DataFrame:
    """Q3 quarter rows from :func:`country_months` (which a job materialises once)."""
    return leaders.quarter_peak_from_months(monthly, "country", mode, DEATHS_SCALE, rate_scale, COVID_NAMES)
